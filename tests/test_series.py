"""Time series against their definitions."""
import datetime as dt
import math

import numpy as np
import pytest

from quayside.functions import distributions as D
from quayside.operators import features as X, timeseries as T, windows as N


def series(spark, values, name="s", start=dt.date(2020, 1, 1), days=None):
    days = days or [start + dt.timedelta(i) for i in range(len(values))]
    return spark.createDataFrame([(name, d, None if v is None else float(v)) for d, v in zip(days, values)],
                                 "series string, ds date, y double")


def test_business_days_keep_nulls_then_fill(spark):
    # Thursday 1, Friday missing, Saturday 3, then a week's gap
    days = [dt.date(2020, 1, 2), dt.date(2020, 1, 3), dt.date(2020, 1, 4), dt.date(2020, 1, 14)]
    df = series(spark, [1, None, 3, 9], days=days)
    got = {r.ds: r.y for r in T.business_day_resample(df).collect()}
    assert got[dt.date(2020, 1, 3)] is None and got[dt.date(2020, 1, 6)] == 3.0 and got[dt.date(2020, 1, 14)] == 9.0
    assert len(got) == 9 and all(d.weekday() < 5 for d in got)
    assert {r.ds: r.y for r in T.fill_series(df).collect()}[dt.date(2020, 1, 3)] == 1.0


@pytest.mark.parametrize("model", ["additive", "multiplicative"])
def test_parts_make_the_series(spark, model):
    i = np.arange(60)
    y = 50 + 0.5 * i + np.array([3, -1, -2, 4, -4])[i % 5]
    rows = T.seasonal_decompose(series(spark, y), 5, model).orderBy("ds").collect()
    for r in rows:
        whole = r.trend + r.seasonal + r.resid if model == "additive" else r.trend * r.seasonal * r.resid
        assert whole == pytest.approx(r.y)
    if model == "additive":
        assert max(abs(r.resid) for r in rows) < 1e-9
        assert [r.trend for r in rows] == pytest.approx(list(50 + 0.5 * i))


def test_autocorrelation_of_white_noise_and_pacf_of_ar2(spark):
    rng = np.random.default_rng(1)
    y = np.zeros(3000)
    for t in range(2, 3000):
        y[t] = 0.5 * y[t - 1] + 0.3 * y[t - 2] + rng.normal()
    df = series(spark, y)
    pacf = {r.lag: r.pacf for r in T.partial_autocorrelation(df, 10).collect()}
    assert pacf[2] == pytest.approx(0.3, abs=0.05) and abs(pacf[5]) < 0.06
    runs = T.significant_lags(T.partial_autocorrelation(df, 10), "pacf").filter("in_first_run").collect()
    assert {r.lag for r in runs} == {1, 2}


@pytest.mark.parametrize("block,lags", [(4096, 30), (16, 16), (16, 40), (7, 3)])
def test_autocorrelation_in_blocks(spark, monkeypatch, block, lags):
    monkeypatch.setattr(T, "BLOCK_DAYS", block)
    df, values = odd_series(spark)
    flat = [("flat", dt.date(2020, 1, 1) + dt.timedelta(i), 3.0) for i in range(20)]
    got = {(r.series, r.lag): r for r in T.autocorrelation(
        df.unionByName(spark.createDataFrame(flat, df.schema)), lags).collect()}
    for name, y in values.items():
        x = y - y.mean()
        for k in range(lags + 1):
            assert got[name, k].n == len(y)
            assert got[name, k].acf == pytest.approx(x[k:] @ x[:len(x) - k] / (x @ x), abs=1e-12)
    assert {got["flat", k].acf for k in range(min(lags, 19) + 1)} == {None}
    assert len(got) == 3 * (lags + 1) + min(lags, 19) + 1


def test_unit_root(spark):
    rng = np.random.default_rng(2)
    steps = rng.normal(size=600)
    both = series(spark, np.cumsum(steps), "walk").unionByName(series(spark, steps, "noise"))
    got = {r.series: r for r in T.adf_stationarity(both).collect()}
    assert not got["walk"].stationary and got["noise"].stationary
    assert got["walk"].crit_5 == pytest.approx(-2.87, abs=0.01)
    assert T._adf_p(-2.86) == pytest.approx(0.05, abs=0.001)
    assert T._adf_p(-3.43) == pytest.approx(0.01, abs=0.001)


def test_granger_direction(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=400)
    y = np.r_[0, 0.8 * x[:-1]] + 0.3 * rng.normal(size=400)
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(i), float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "ds date, x double, y double")
    assert T.granger_causality(df, "x", "y", 3).filter("lag = 1").first().p_value < 1e-6
    assert T.granger_causality(df, "y", "x", 3).filter("lag = 1").first().p_value > 0.01


def test_granger_is_that_of_two_regressions(spark):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=60), rng.normal(size=60).cumsum()
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(i), float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame([*rows, (None, 1.0, 1.0), (dt.date(2030, 1, 1), None, 2.0)], "ds date, x double, y double")
    got = {r.lag: r for r in T.granger_causality(df, "x", "y", 4).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    for lag, r in got.items():
        own = np.column_stack([np.ones(60 - lag), lags_of(y, 1, lag, lag)])
        both = np.column_stack([own, lags_of(x, 1, lag, lag)])
        less, full = (ols(z, y[lag:])[1] for z in (own, both))
        rest = 60 - lag - both.shape[1]
        assert (r.df_num, r.df_den) == (lag, rest)
        assert r.f == pytest.approx((less - full) / lag / (full / rest), rel=1e-7)
    assert T.granger_causality(df.limit(0), "x", "y", 2).count() == 0


def test_short_and_constant_series_have_nulls(spark):
    rng = np.random.default_rng(6)
    long = [("long", dt.date(2020, 1, 1) + dt.timedelta(i), float(v)) for i, v in enumerate(rng.normal(size=80))]
    short = [("short", dt.date(2020, 1, 1) + dt.timedelta(i), float(i)) for i in range(2)]
    flat = [("flat", dt.date(2020, 1, 1) + dt.timedelta(i), 1.0) for i in range(80)]
    df = spark.createDataFrame(long + short + flat, "series string, ds date, y double")
    adf = {r.series: r for r in T.adf_stationarity(df).collect()}
    assert adf["long"].stationary and adf["short"].statistic is None and adf["short"].lag is None
    assert adf["short"].stationary is None and adf["flat"].p_value is None
    fit = T.fit_arima(df, (1, 0, 1)).filter("series = 'short'").collect()
    assert {r.term for r in fit} == {"const", "ar.L1", "ma.L1", "sigma2", "aic"} and {r.value for r in fit} == {None}
    grid = T.arima_grid(df, [0, 1], [0], [0, 2]).collect()
    assert len(grid) == 12 and [r.aic for r in grid if r.series == "short" and (r.p, r.q) == (1, 2)] == [None]
    assert sum(r.best for r in grid if r.series == "long") == 1


def lags_of(y, first, last, start):
    """Columns y[t - first] … y[t - last] for t = start … end."""
    return np.column_stack([np.zeros((len(y) - start, 0)), *[y[start - k:len(y) - k] for k in range(first, last + 1)]])


def ols(x, y):
    beta = np.linalg.lstsq(x, y, rcond=None)[0] if x.shape[1] else np.zeros(0)
    return beta, float(((y - x @ beta) ** 2).sum())


def adf_by_hand(y, most, fixed):
    d = np.diff(y)

    def design(lag, start):
        return np.column_stack([y[start:-1], lags_of(d, 1, lag, start), np.ones(len(d) - start)]), d[start:]

    def score(lag):
        x, target = design(most, most)
        x = np.column_stack([x[:, :1 + lag], x[:, -1:]])
        return len(x) * math.log(ols(x, target)[1] / len(x)) + 2 * x.shape[1]

    best = most if fixed else min(range(most + 1), key=score)
    x, target = design(best, best)
    beta, ssr = ols(x, target)
    return beta[0] / math.sqrt(ssr / (len(x) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0]), best, len(x)


def arima_by_hand(y, order, first):
    p, d, q = order
    w = np.diff(y, n=d) if d else y
    x = w - (w.mean() if d == 0 else 0.0)
    long, start = min(max(p + q, int(10 * math.log10(len(x)))), len(x) // 4) if q else 0, first - d
    shocks = np.zeros(len(x))
    if q:
        past = lags_of(x, 1, long, long)
        shocks[long:] = x[long:] - past @ ols(past, x[long:])[0]
    inputs = np.column_stack([lags_of(x, 1, p, start), lags_of(shocks, 1, q, start)])
    beta, ssr = ols(inputs, x[start:])
    n = len(x) - start
    return beta, ssr / n, n * (math.log(2 * math.pi * ssr / n) + 1) + 2 * (p + q + 1 + (d == 0)), n


def odd_series(spark):
    """Two series with several rows a day, missing values, and one without a name."""
    rng = np.random.default_rng(12)
    values = {"a": rng.normal(size=150).cumsum(), None: 50 + rng.normal(size=90), "b": rng.normal(size=200)}
    rows = [(name, dt.date(2020, 1, 1) + dt.timedelta(i), float(v) + e) for name, y in values.items()
            for i, v in enumerate(y) for e in (-0.5, 0.5)]
    rows += [("a", dt.date(2030, 1, 1), None), ("b", dt.date(2030, 1, 1), float("nan"))]
    return spark.createDataFrame(rows, "series string, ds date, y double").repartition(7), values


@pytest.mark.parametrize("most,fixed", [(0, True), (4, True), (6, False), (None, False)])
def test_unit_root_is_that_of_whole_regressions(spark, most, fixed):
    df, values = odd_series(spark)
    got = {r.series: r for r in T.adf_stationarity(df, most, fixed).collect()}
    assert set(got) == set(values)
    for name, y in values.items():
        lags = most if most is not None else math.ceil(12 * (len(y) / 100) ** 0.25)
        statistic, lag, n = adf_by_hand(y, lags, fixed)
        assert (got[name].lag, got[name].n) == (lag, n)
        assert got[name].statistic == pytest.approx(statistic, rel=1e-8)


def test_orders_are_those_of_whole_regressions_on_the_same_days(spark):
    df, values = odd_series(spark)
    orders = [(p, d, q) for p in (0, 2) for d in (0, 1) for q in (0, 1, 3)]
    grid = {(r.series, r.p, r.d, r.q): r for r in T.arima_grid(df, [0, 2], [0, 1], [0, 1, 3]).collect()}
    assert len(grid) == 36
    for name, y in values.items():
        first = max(max(p, long + q) + d for p, d, q in orders
                    for long in [min(max(p + q, int(10 * math.log10(len(y) - d))), (len(y) - d) // 4) if q else 0])
        fits = {o: arima_by_hand(y, o, first) for o in orders}
        assert {n for *_, n in fits.values()} == {len(y) - first}
        for o, (_, _, aic, _) in fits.items():
            assert grid[(name, *o)].aic == pytest.approx(aic, rel=1e-9)
        best = min(fits, key=lambda o: fits[o][2])
        assert [o for o in orders if grid[(name, *o)].best] == [best]
    for order in [(2, 1, 3), (0, 0, 1), (1, 2, 0)]:
        got = {(r.series, r.term): r.value for r in T.fit_arima(df, order).collect()}
        for name, y in values.items():
            p, d, q = order
            m = len(y) - d
            long = min(max(p + q, int(10 * math.log10(m))), m // 4) if q else 0
            beta, sigma2, aic, _ = arima_by_hand(y, order, max(p, long + q) + d)
            names = [*[f"ar.L{i + 1}" for i in range(p)], *[f"ma.L{i + 1}" for i in range(q)]]
            assert [got[name, t] for t in names] == pytest.approx(beta.tolist(), rel=1e-7, abs=1e-9)
            assert (got[name, "sigma2"], got[name, "aic"]) == pytest.approx((sigma2, aic), rel=1e-9)


def test_arima_finds_the_parameters(spark):
    rng = np.random.default_rng(4)
    e = rng.normal(size=6000)
    y = np.zeros(6000)
    for t in range(1, 6000):
        y[t] = 0.6 * y[t - 1] + e[t] + 0.4 * e[t - 1]
    days = [dt.date(1990, 1, 1) + dt.timedelta(i) for i in range(6000)]
    df = series(spark, y + 10, days=days)
    got = {r.term: r.value for r in T.fit_arima(df, (1, 0, 1)).collect()}
    assert got["ar.L1"] == pytest.approx(0.6, abs=0.05) and got["ma.L1"] == pytest.approx(0.4, abs=0.06)
    assert got["const"] == pytest.approx(10, abs=0.2) and got["sigma2"] == pytest.approx(1, abs=0.06)
    grid = T.arima_grid(df, [0, 1], [0], [0, 1]).collect()
    assert [(r.p, r.q) for r in grid if r.best] == [(1, 1)] and len(grid) == 4


def test_forecast_has_a_row_per_test_day_and_covers(spark):
    rng = np.random.default_rng(5)
    walk = 100 + np.cumsum(rng.normal(size=500))
    train, test = X.split_time(series(spark, walk), "ds")
    assert (train.count(), test.count()) == (400, 100)
    rows = T.forecast_arima(train, test, (1, 1, 0)).orderBy("ds").collect()
    assert len(rows) == 100 and all(r.lower < r.mean < r.upper for r in rows)
    widths = [r.upper - r.lower for r in rows]
    assert widths == sorted(widths) and rows[0].mean == pytest.approx(walk[399], abs=2)


def test_lags_and_moving_average(spark):
    df = series(spark, [1, 2, 4, 8, 16, 32])
    got = N.centered_moving_average(df, ["series"], "ds", "y", 4).orderBy("ds").collect()
    assert [r.trend for r in got] == [None, None, pytest.approx((0.5 + 2 + 4 + 8 + 8) / 4),
                                      pytest.approx((1 + 4 + 8 + 16 + 16) / 4), None, None]
    lagged = N.lagged_values(df, ["series"], "ds", "y", 2).orderBy("ds").collect()
    assert [r.y_lag2 for r in lagged] == [None, None, 1, 2, 4, 8]


def test_tail_probabilities():
    assert D.gamma_tail(0.5, 3.841458820694124 / 2) == pytest.approx(0.05, abs=1e-9)
    assert D.gamma_tail(2.0, 9.487729036781154 / 2) == pytest.approx(0.05, abs=1e-9)
    assert D.gamma_tail(0.5, 0.3) == pytest.approx(math.erfc(math.sqrt(0.3)), abs=1e-12)
    assert D.f_tail(4.964602743730711, 1, 10) == pytest.approx(0.05, abs=1e-9)
    assert D.f_tail(3.32583453041301, 5, 10) == pytest.approx(0.05, abs=1e-9)
    assert T._normal_quantile(0.95) == pytest.approx(1.959963984540054, abs=1e-9)


def test_pearson_p_value(spark):
    r = spark.createDataFrame([(0.6319, 10), (0.0, 5), (1.0, 4)], "r double, n long")
    got = [x.p for x in r.select(D.correlation_p("r", "n").alias("p")).collect()]
    assert got[0] == pytest.approx(0.05, abs=1e-4) and got[1:] == [pytest.approx(1.0), 0.0]
