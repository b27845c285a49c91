"""Daily series: calendar, decomposition, autocorrelation, tests, ARIMA.

Input is long: (series, ds, y) with ds a DATE. Rows of one series and day are averaged first, map side, so a
series is bounded by the calendar (36,525 rows a century) whatever the number of rows behind it. Methods that regress on
lags add up products of lagged columns and solve the small systems; correlations go block by block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from quayside.functions.distributions import f_tail, normal_cdf
from quayside.operators.joins import asof_calendar
from quayside.operators.lag_sums import gram_sums, lagged, lags, per_series, solved, square
from quayside.operators.windows import centered_moving_average, forward_fill, require_date
from quayside.plans.blocks import row_rank
from quayside.sources import stored


def daily(df: DataFrame, *more: str) -> DataFrame:
    """One row per series and day (rows of one day are averaged), so that a series fits the calendar."""
    require_date(df, "ds")
    return df.groupBy("series", "ds", *more).agg(F.avg("y").alias("y"))


def _values(pdf: pd.DataFrame) -> np.ndarray:
    return pdf.sort_values("ds")["y"].dropna().to_numpy(dtype=float)


# --- calendar ------------------------------------------------------------------------------------------


def business_days(df: DataFrame) -> DataFrame:
    """Monday to Friday from the first to the last day of each series."""
    require_date(df, "ds")
    ends = df.groupBy("series").agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    return (ends.select("series", F.explode(F.sequence("lo", "hi")).alias("ds"))
            .filter(F.weekday("ds") < 5))


def business_day_resample(df: DataFrame) -> DataFrame:
    """The last row at or before each business day; a missing value there stays missing."""
    return asof_calendar(business_days(df), df, ["series"], "ds")


def fill_series(df: DataFrame) -> DataFrame:
    """Business days with missing values filled by the last known one."""
    return forward_fill(business_day_resample(df), ["series"], "ds", ["y"])


# --- decomposition -------------------------------------------------------------------------------------


def seasonal_decompose(df: DataFrame, period: int, model: str = "additive") -> DataFrame:
    """(series, ds, y, trend, seasonal, resid): y is the sum of the parts, or their product.

    The trend is a centred moving average. Its ends, which have no full window, follow a straight line
    through one period: the first period of trend values, and the period before the last one.
    """
    df = daily(df)
    half = period // 2
    n = F.count(F.lit(1)).over(W.partitionBy("series"))
    rows = (centered_moving_average(df, ["series"], "ds", "y", period)
            .withColumns({"_i": F.row_number().over(W.partitionBy("series").orderBy("ds")) - 1, "_n": n}))
    back = F.col("_n") - 1 - half
    in_front = (F.col("_i") >= half) & (F.col("_i") < F.least(F.lit(half + period), back))
    in_back = (F.col("_i") >= F.greatest(F.lit(half), back - period)) & (F.col("_i") < back)

    def line(inside):
        y, x = F.when(inside, F.col("trend")), F.when(inside, F.col("_i").cast("double"))
        return F.struct(F.regr_slope(y, x).alias("k"), F.regr_intercept(y, x).alias("c"))

    lines = rows.groupBy("series").agg(line(in_front).alias("_f"), line(in_back).alias("_b"))
    i = F.col("_i")
    trend = (F.when(i < half, F.col("_f.k") * i + F.col("_f.c"))
             .when(i > back, F.col("_b.k") * i + F.col("_b.c")).otherwise(F.col("trend")))
    rows = rows.join(lines, "series").withColumns({"trend": trend, "_phase": F.pmod(i, F.lit(period))})
    y, t = F.col("y"), F.col("trend")
    rest = F.try_divide(y, t) if model == "multiplicative" else y - t
    phase = rows.withColumn("_rest", rest).groupBy("series", "_phase").agg(F.avg("_rest").alias("_mean"))
    middle = F.avg("_mean").over(W.partitionBy("series"))  # over one row per phase
    season = F.try_divide(F.col("_mean"), middle) if model == "multiplicative" else F.col("_mean") - middle
    phase = phase.select("series", "_phase", season.alias("seasonal"))
    s = F.col("seasonal")
    resid = F.try_divide(y, t * s) if model == "multiplicative" else y - t - s
    return (rows.join(phase, ["series", "_phase"]).withColumn("resid", resid)
            .select("series", "ds", "y", "trend", "seasonal", "resid"))


# --- autocorrelation -----------------------------------------------------------------------------------


BLOCK_DAYS = 4096


def autocorrelation(df: DataFrame, lags: int) -> DataFrame:
    """(series, lag, acf, n) for lags 0 … ``lags``; the sums are all divided by n. Null for a constant series.

    The days of a series are numbered and cut into blocks, each with the ``lags`` days before it; the products of a
    block's days with those before them are one correlation, and are added up per (series, lag).
    """
    size = max(BLOCK_DAYS, lags)
    days = stored(daily(df).filter(F.nanvl("y", F.lit(None)).isNotNull()), "days")
    kind = days.schema["series"].dataType.simpleString()
    stats = days.groupBy("series").agg(F.avg("y").alias("mean"), F.count(F.lit(1)).alias("n"))
    # A series without a name is one, too.
    numbered = row_rank(days.withColumn("key", F.to_json(F.struct("series"))), ["key"], ["ds"], "t")
    i = F.col("t") - 1
    block = F.floor(i / size)
    own = F.struct(block.alias("block"), F.lit(True).alias("own"))
    before = F.struct((block + 1).alias("block"), F.lit(False).alias("own"))
    rows = numbered.join(stats.withColumnRenamed("series", "_s"), F.col("series").eqNullSafe(F.col("_s"))).select(
        "series", "n", i.alias("i"), (F.col("y") - F.col("mean")).alias("x"),
        F.inline(F.when(F.pmod(i, F.lit(size)) >= size - lags, F.array(own, before)).otherwise(F.array(own))))

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        own = pdf["own"].to_numpy()
        if not own.any():  # the days before a block that there is not
            return pd.DataFrame({"series": [], "lag": [], "s": [], "n": []}).astype({"series": object})
        x, n = pdf["x"].to_numpy(), int(pdf["n"].iloc[0])
        z = np.concatenate([np.zeros(lags - int((~own).sum())), x])
        length = 1 << (len(z) + int(own.sum()) - 1).bit_length()
        cross = np.fft.irfft(np.fft.rfft(z, length) * np.conj(np.fft.rfft(x[own], length)), length)
        s = cross[lags::-1][:min(lags, n - 1) + 1]
        return pd.DataFrame({"series": pdf["series"].iloc[0], "lag": np.arange(len(s)), "s": s, "n": n}
                            ).astype({"series": object})

    parts = rows.groupBy("series", "block").applyInPandas(products, f"series {kind}, lag int, s double, n bigint")
    total = parts.groupBy("series", "lag").agg(F.sum("s").alias("s"), F.max("n").alias("n"))
    whole = F.max(F.when(F.col("lag") == 0, F.col("s"))).over(W.partitionBy("series"))  # over one row per lag
    flat = whole <= F.lit(1e-300)
    return total.select("series", "lag", F.when(~flat, F.col("s") / whole).alias("acf"), "n")


def partial_autocorrelation(df: DataFrame, lags: int, adjusted: bool = True) -> DataFrame:
    """(series, lag, pacf, n) from the autocorrelations by the Durbin-Levinson recursion.

    ``adjusted`` divides the sum at lag k by n - k instead of n.
    """

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        r, n = pdf["acf"].to_numpy(dtype=float), int(pdf["n"].iloc[0])
        if adjusted:
            r = r * n / (n - np.arange(len(r)))
        out, phi, left = [1.0], np.zeros(0), 1.0
        for k in range(1, len(r)):
            a = (r[k] - phi @ r[k - 1:0:-1]) / left
            phi = np.append(phi - a * phi[::-1], a)
            left *= 1 - a * a
            out.append(a)
        return pd.DataFrame({"series": pdf["series"].iloc[0], "lag": np.arange(len(out)), "pacf": out, "n": n})

    return autocorrelation(df, lags).groupBy("series").applyInPandas(
        per_series, "series string, lag int, pacf double, n bigint")


def significant_lags(correlations: DataFrame, value: str = "acf") -> DataFrame:
    """Lags from 1 beyond the band of 1.96 / sqrt(n), and whether they belong to the first unbroken run."""
    band = F.lit(1.96) / F.sqrt("n")
    rows = correlations.filter(F.col("lag") >= 1).withColumn("band", band)
    over = F.abs(value) > F.col("band")
    first_gap = F.min(F.when(~over, F.col("lag"))).over(W.partitionBy("series"))
    run = F.coalesce(F.col("lag") < first_gap, F.lit(True))
    return (rows.withColumns({"in_first_run": run, "_over": over}).filter("_over")
            .select("series", "lag", value, "band", "in_first_run"))


# --- tests ---------------------------------------------------------------------------------------------

# Response surface for the distribution of the unit-root statistic with a constant
# (MacKinnon 1994 for the p-value, 2010 for the critical values).
ADF_MAX, ADF_MIN, ADF_STAR = 2.74, -18.83, -1.61
ADF_SMALL = [2.1659, 1.4412, 0.038269]
ADF_LARGE = [1.7339, 0.93202, -0.12745, -0.010368]
ADF_CRITICAL = {
    "crit_1": [-3.43035, -6.5393, -16.786, -79.433],
    "crit_5": [-2.86154, -2.8903, -4.234, -40.040],
    "crit_10": [-2.56677, -1.5384, -2.809, 0.0],
}


def _adf_p(stat: float) -> float:
    if stat > ADF_MAX:
        return 1.0
    if stat < ADF_MIN:
        return 0.0
    surface = ADF_SMALL if stat <= ADF_STAR else ADF_LARGE
    return normal_cdf(sum(c * stat ** i for i, c in enumerate(surface)))


def _adf_lags(n: int, max_lag: int | None) -> int | None:
    """The most lags of a series of n values; None if it is too short for them."""
    if max_lag is None:
        max_lag = max(0, min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2))
    return max_lag if n - 1 - max_lag > max_lag + 2 else None


def _adf(grams: dict[int, np.ndarray], most: int, fixed: bool) -> tuple[float, int, int] | None:
    """Statistic, lag, number of rows, from the sums for each number of lags; None for a constant series."""
    best = most
    if not fixed:
        gram = grams[most]  # one sample for all, so that the scores compare
        n, scores = round(gram[most + 1, most + 1]), []
        for lag in range(most + 1):
            used = [*range(lag + 1), most + 1]
            scores.append(n * math.log(max(solved(gram, used)[1], 1e-300) / n) + 2 * len(used))
        best = int(np.argmin(scores))
    gram = grams[best]
    n, k = round(gram[best + 1, best + 1]), best + 2
    beta, ssr, inverse = solved(gram, list(range(k)))
    variance = ssr / (n - k) * inverse[0, 0]
    flat = ssr <= 1e-24 * max(1.0, gram[0, 0])
    return (float(beta[0] / math.sqrt(variance)), best, n) if variance > 0 and not flat else None


def adf_stationarity(df: DataFrame, max_lag: int | None = None, fixed_lag: bool = False) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, per series; the lag is the one with the best AIC.

    ``fixed_lag`` uses ``max_lag`` itself. ``stationary`` is the decision at 5 %. A series that is too short for the
    lags, or constant, has a row of nulls. The regressions of all lags are solved from sums over lagged columns.
    """
    names = list(ADF_CRITICAL)
    # A series has at most as many days as the calendar has dates, which bounds the lags that its length allows.
    rows = lagged(stored(daily(df), "days"), 1 + (max_lag if max_lag is not None else _adf_lags(DATES, None)), [0], lambda d: True)

    def design(part: pd.DataFrame, past: np.ndarray):
        most = _adf_lags(int(part["n"].iloc[0]), max_lag)
        if most is None:
            return
        i, x = part["i"].to_numpy(), part["x"].to_numpy()
        for lag in [most] if fixed_lag else range(most + 1):
            here = i > lag
            level = lags(past[here], 1, lag + 1)
            z = np.column_stack([level[:, 0], level[:, :-1] - level[:, 1:], np.ones(here.sum()), x[here] - level[:, 0]])
            yield lag, z

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        grams = {u: square(g) for u, g in zip(pdf["unit"], pdf["gram"]) if u >= 0}
        out = {"series": [pdf["series"].iloc[0]]}
        found = _adf(grams, max(grams), fixed_lag) if grams else None
        if found is None:
            return pd.DataFrame(out).reindex(
                columns=["series", "statistic", "lag", "n", "p_value", *names, "stationary"]).astype(
                {"lag": object, "n": object, "stationary": object})
        stat, lag, n = found
        p = _adf_p(stat)
        critical = {name: [sum(c / n ** i for i, c in enumerate(b))] for name, b in ADF_CRITICAL.items()}
        return pd.DataFrame({**out, "statistic": [stat], "lag": [lag], "n": [n], "p_value": [p], **critical,
                             "stationary": [p < 0.05]})

    kind = rows.schema["series"].dataType.simpleString()
    return _with_every_series(rows, gram_sums(rows, design)).groupBy("series").applyInPandas(
        test, f"series {kind}, statistic double, lag int, n bigint, p_value double, "
              "crit_1 double, crit_5 double, crit_10 double, stationary boolean")


def _with_every_series(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """The sums and, for each series, a row with unit -1, so that one without sums is there too."""
    every = rows.select("series").distinct().select(
        "series", F.lit(-1).alias("unit"), F.array().cast("array<double>").alias("gram"))
    return grams.select("series", "unit", "gram").unionByName(every)


def granger_causality(df: DataFrame, cause: str, effect: str, max_lag: int, ds: str = "ds") -> DataFrame:
    """(lag, f, p_value, df_num, df_den): does the past of ``cause`` help to predict ``effect``?

    Rows of one day are averaged first; days without a date or without both values are left out. Each day meets the
    days before it by its number. Then each task adds up the products of its rows' columns, and the regressions of a lag
    are solved from those sums, of which there are (2 lag + 2) ** 2. A lag with too few days has no row.
    """
    require_date(df, ds)
    days = (df.filter(F.col(ds).isNotNull()).groupBy(ds)
            .agg(F.avg(effect).alias("_y"), F.avg(cause).alias("_x")))
    days = days.filter(F.nanvl("_y", F.lit(None)).isNotNull() & F.nanvl("_x", F.lit(None)).isNotNull())
    means = days.agg(F.struct(F.avg("_y").alias("y"), F.avg("_x").alias("x")).alias("m")).scalar()
    ranked = row_rank(days, [], [ds], "_t").withColumn("_m", means)
    moved = ranked.select((F.col("_y") - F.col("_m.y")).alias("y"), (F.col("_x") - F.col("_m.x")).alias("x"), "_t",
                          F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("k"))
    past = [F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}") for c in "yx" for k in range(max_lag + 1)]
    rows = (moved.groupBy((F.col("_t") + F.col("k")).alias("_t")).agg(*past).filter(F.col("y0").isNotNull())
            .drop("_t", "x0"))
    own = [f"y{k}" for k in range(1, max_lag + 1)]
    other = [f"x{k}" for k in range(1, max_lag + 1)]

    def sums(batches):
        total = {lag: 0.0 for lag in range(1, max_lag + 1)}
        for pdf in batches:
            for lag in total:
                part = pdf[[*own[:lag], *other[:lag], "y0"]].dropna().to_numpy(dtype=float)
                z = np.column_stack([np.ones(len(part)), part])
                total[lag] = total[lag] + z.T @ z
        for lag, gram in total.items():
            if np.ndim(gram):
                yield pd.DataFrame({"lag": lag, "at": np.arange(gram.size), "v": gram.ravel()})

    def left_over(gram: np.ndarray, cols: list[int]) -> float:
        """Sum of squared residuals of the last column on ``cols``."""
        cross = gram[cols, -1]
        return float(gram[-1, -1] - cross @ np.linalg.lstsq(gram[np.ix_(cols, cols)], cross, rcond=None)[0])

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        lag = int(pdf["lag"].iloc[0])
        gram = pdf.sort_values("at")["v"].to_numpy().reshape(2 * lag + 2, 2 * lag + 2)
        rest, out = int(gram[0, 0]) - (2 * lag + 1), []
        if rest >= 1:
            less, full = left_over(gram, list(range(lag + 1))), left_over(gram, list(range(2 * lag + 1)))
            f = (less - full) / lag / (full / rest) if full > 0 else float("inf")
            out.append((lag, f, f_tail(f, lag, rest), lag, rest))
        return pd.DataFrame(out, columns=["lag", "f", "p_value", "df_num", "df_den"])

    grams = rows.mapInPandas(sums, "lag int, at int, v double").groupBy("lag", "at").agg(F.sum("v").alias("v"))
    return grams.groupBy("lag").applyInPandas(test, "lag int, f double, p_value double, df_num int, df_den int")


# --- ARIMA ---------------------------------------------------------------------------------------------

Order = tuple[int, int, int]


def _long(m: int, order: Order) -> int:
    """Lags of the long autoregression on a differenced series of m values."""
    p, _, q = order
    return min(max(p + q, int(10 * math.log10(m))), m // 4) if q and m > 0 else 0


def _arima_start(n: int, order: Order) -> int | None:
    """The first of ``n`` days that all lags reach; None if too few are left."""
    p, d, q = order
    m, long = n - d, _long(n - d, order)
    start = max(p, long + q)
    return start + d if m - start > p + q and (long or not q) else None


def _first(n: int, orders: list[Order]) -> int | None:
    """The first day that the lags of all orders reach; orders that the series is too short for don't count."""
    return max((x for x in (_arima_start(n, o) for o in orders) if x is not None), default=None)


def _shock_columns(past: np.ndarray, beta: np.ndarray, count: int) -> np.ndarray:
    """What the long autoregression left over on the ``count`` days before each row."""
    long = len(beta)
    return np.column_stack([lags(past, j, j)[:, 0] - lags(past, j + 1, j + long) @ beta for j in range(1, count + 1)]
                           ) if count else np.empty((len(past), 0))


def _inputs(past: np.ndarray, order: Order, betas: dict) -> np.ndarray:
    p, d, q = order
    return np.column_stack([lags(past, 1, p), _shock_columns(past, betas, q)])


def _arima_rows(days: DataFrame, orders: list[Order]) -> tuple[DataFrame, DataFrame]:
    """Lagged rows with the coefficients of the long autoregressions of their series, by length; and these rows alone."""
    longest = max(_long(DATES, o) + o[2] for o in orders)
    keep = max(longest, *(o[0] for o in orders))
    rows = lagged(days, keep, sorted({d for _, d, _ in orders}), lambda d: d == 0)

    def design(part: pd.DataFrame, past: np.ndarray):
        m, d = int(part["n"].iloc[0]), int(part["d"].iloc[0])
        i, x = part["i"].to_numpy(), part["x"].to_numpy()
        for long in {_long(m, o) for o in orders if o[1] == d and o[2]} - {0}:
            here = i >= long
            yield d * LONGEST + long, np.column_stack([lags(past[here], 1, long), x[here]])

    @F.pandas_udf("array<double>")
    def coefficients(grams: pd.Series) -> pd.Series:
        return pd.Series([solved(g := square(v), list(range(len(g) - 1)))[0].tolist() for v in grams])

    betas = gram_sums(rows, design).groupBy("series").agg(
        F.collect_list(F.struct("unit", coefficients("gram").alias("beta"))).alias("betas")
    ) if any(q for *_, q in orders) else None
    if betas is None:
        return rows.withColumn("betas", F.lit(None).cast("array<struct<unit:int,beta:array<double>>>")), rows
    matched = betas.withColumnRenamed("series", "_s")
    return rows.join(matched, F.col("series").eqNullSafe(F.col("_s")), "left").drop("_s"), rows


LONGEST = 1000  # more than the lags of any long autoregression
DATES = 3_652_059  # days from year 1 to year 9999


def _beta(betas, d: int, long: int) -> np.ndarray | None:
    """The long autoregression's coefficients among those that come with a row."""
    if not long:
        return np.zeros(0)
    held = [] if betas is None else betas
    return next((np.asarray(b["beta"], float) for b in held if b["unit"] == d * LONGEST + long), None)


def _arima_fits(df: DataFrame, orders: list[Order]) -> tuple[DataFrame, DataFrame]:
    """Two regressions (Hannan-Rissanen) per series and order, both from sums: a long autoregression gives the shocks,
    then the series is regressed on its own lags and on lagged shocks. All orders are fitted to the same days.

    (series, unit, mean, ar, ma, sigma2, n, aic), ``unit`` being the place of the order; nulls for a series that is too
    short. And the rows that the fits are of.
    """
    days = stored(daily(df), "days")  # a row per day, read for each pass
    rows, plain = _arima_rows(days, orders)

    def design(part: pd.DataFrame, past: np.ndarray):
        d, m = int(part["d"].iloc[0]), int(part["n"].iloc[0])
        first = _first(m + d, orders)
        i, x = part["i"].to_numpy(), part["x"].to_numpy()
        for unit, order in enumerate(orders):
            p, _, q = order
            beta = _beta(part["betas"].iloc[0], d, _long(m, order))
            if order[1] != d or _arima_start(m + d, order) is None or beta is None or m + d - first <= p + q:
                continue
            here = i >= first - d
            # The last but one column carries the mean and counts the rows.
            z = np.column_stack([_inputs(past[here], order, beta), np.ones(here.sum()), x[here]])
            yield unit, z

    kind = rows.schema["series"].dataType.simpleString()
    mean = plain.filter("d = 0").groupBy("series").agg(F.first("mean").alias("mean"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        grams, out = {u: square(g) for u, g in zip(pdf["unit"], pdf["gram"]) if u >= 0}, []
        for unit, (p, d, q) in enumerate(orders):
            if unit not in grams:
                out.append((unit, [], [], None, None, None))
                continue
            gram = grams[unit]
            n = round(gram[p + q, p + q])
            beta, ssr, _ = solved(gram, list(range(p + q)))
            sigma2 = max(ssr / n, 1e-300)
            aic = n * (math.log(2 * math.pi * sigma2) + 1) + 2 * (p + q + 1 + (d == 0))
            out.append((unit, beta[:p].tolist(), beta[p:].tolist(), sigma2, n, aic))
        table = pd.DataFrame(out, columns=["unit", "ar", "ma", "sigma2", "n", "aic"])
        table["n"] = table["n"].astype("Int64")
        table.insert(0, "series", pdf["series"].iloc[0])
        return table

    # A series of which differencing leaves nothing is there with nulls, too.
    every = _with_every_series(days.filter(F.nanvl("y", F.lit(None)).isNotNull()), gram_sums(rows, design))
    fits = every.groupBy("series").applyInPandas(
        fit, f"series {kind}, unit int, ar array<double>, ma array<double>, sigma2 double, n bigint, aic double")
    matched = mean.withColumnRenamed("series", "_s")
    fits = fits.join(matched, F.col("series").eqNullSafe(F.col("_s")), "left").drop("_s")
    of_order = F.array(*[F.lit(d == 0) for _, d, _ in orders])[F.col("unit")]
    return fits.withColumn("mean", F.when(F.col("n").isNotNull(), F.when(of_order, F.col("mean")).otherwise(0.0))), rows


def fit_arima(df: DataFrame, order: Order) -> DataFrame:
    """(series, term, value): const, ar.L*, ma.L*, sigma2, aic; null values for a series that is too short."""
    p, d, q = order
    fits, _ = _arima_fits(df, [order])
    terms = [("const", F.col("mean"))] if d == 0 else []
    terms += [(f"ar.L{i + 1}", F.get("ar", F.lit(i))) for i in range(p)]
    terms += [(f"ma.L{i + 1}", F.get("ma", F.lit(i))) for i in range(q)]
    terms += [("sigma2", F.col("sigma2")), ("aic", F.col("aic"))]
    return fits.select("series", F.inline(F.array(*[
        F.struct(F.lit(name).alias("term"), value.alias("value")) for name, value in terms])))


def _forecast(fit, x: list[float], shocks: list[float], ends: list[float], d: int, steps: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard error for each step after the end, from a fit, the last values and shocks, and the last value
    of the series and of each of its differences."""
    ar, ma, q = list(fit.ar), list(fit.ma), len(fit.ma)
    mean = np.empty(steps)
    for h in range(steps):
        value = sum(c * x[-1 - i] for i, c in enumerate(ar))
        value += sum(c * shocks[-1 - i] for i, c in enumerate(ma))
        mean[h] = value + fit.mean
        x.append(value)
        shocks.append(0.0)
    psi = np.zeros(steps)
    psi[:1] = 1.0
    for h in range(1, steps):
        psi[h] = sum(c * psi[h - 1 - i] for i, c in enumerate(ar) if h - 1 - i >= 0)
        psi[h] += ma[h - 1] if h <= q else 0.0
    for back in reversed(range(d)):
        mean, psi = ends[back] + np.cumsum(mean), np.cumsum(psi)
    return mean, np.sqrt(fit.sigma2 * np.cumsum(psi * psi))


def _normal_quantile(level: float) -> float:
    """z with P(|Z| < z) = level, by bisection."""
    lo, hi = 0.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if 2 * normal_cdf(mid) - 1 < level else (lo, mid)
    return (lo + hi) / 2


def forecast_arima(train: DataFrame, test: DataFrame, order: Order, level: float = 0.95) -> DataFrame:
    """(series, ds, mean, lower, upper, actual), one row per test day; only ``train`` is used for the fit.

    The state that a forecast goes on from, the last values and shocks, comes from the last rows of the train part.
    """
    z, (p, d, q) = _normal_quantile(level), order
    fits, rows = _arima_fits(train, [order])
    kind = rows.schema["series"].dataType.simpleString()
    matched = fits.select(F.col("series").alias("_s"), "ar", "ma", "sigma2", F.col("mean").alias("fit_mean"), "aic")
    last = rows.filter((F.col("d") == d) & (F.col("n") - F.col("i") <= max(1, p, q))).drop("mean").join(
        matched, F.col("series").eqNullSafe(F.col("_s"))).filter(F.col("aic").isNotNull())

    def left_over(batches):
        for pdf in batches:
            for series, _, part, past in per_series(pdf):
                one = part.iloc[0]
                beta = _beta(one["betas"], d, _long(int(one["n"]), order))
                columns = _inputs(past, order, beta)
                yield pd.DataFrame({"series": series, "i": part["i"], "x": part["x"],
                                    "e": part["x"].to_numpy() - columns @ np.array([*one["ar"], *one["ma"]], float),
                                    }).astype({"series": object})

    tail = last.mapInPandas(left_over, f"series {kind}, i int, x double, e double").groupBy("series").agg(
        F.array_sort(F.collect_list(F.struct("i", "x", "e"))).alias("tail"))
    ends = None
    for k in range(d):  # the last value of the series and of its differences before the last
        step = lagged(daily(train), 0, [k], lambda _: False).groupBy(F.col("series").alias("_e")).agg(
            F.max_by("y", "i").alias(f"end_{k}"))
        ends = step if ends is None else ends.join(
            step.withColumnRenamed("_e", f"_e{k}"), F.col("_e").eqNullSafe(F.col(f"_e{k}"))).drop(f"_e{k}")
    order_ = W.partitionBy("series").orderBy("ds")
    ahead = daily(test).withColumn("h", F.row_number().over(order_))
    known = (ahead.groupBy("series").agg(F.max("h").alias("steps"))
             .join(tail.withColumnRenamed("series", "_t"), F.col("series").eqNullSafe(F.col("_t"))).drop("_t")
             .join(matched.withColumnRenamed("fit_mean", "mean"), F.col("series").eqNullSafe(F.col("_s"))).drop("_s"))
    if ends is not None:
        known = known.join(ends, F.col("series").eqNullSafe(F.col("_e"))).drop("_e")

    def go_on(batches):
        for pdf in batches:
            for one in pdf.itertuples():
                state = [(t["x"], t["e"]) for t in one.tail]
                mean, se = _forecast(one, [x for x, _ in state], [e for _, e in state],
                                     [getattr(one, f"end_{k}") for k in range(d)], d, int(one.steps))
                yield pd.DataFrame({"series": one.series, "h": np.arange(1, len(mean) + 1), "mean": mean,
                                    "lower": mean - z * se, "upper": mean + z * se}).astype({"series": object})

    ahead_of = known.mapInPandas(go_on, f"series {kind}, h int, mean double, lower double, upper double")
    found = ahead_of.withColumnsRenamed({"series": "_s", "h": "_h"})
    return ahead.join(found, F.col("series").eqNullSafe(F.col("_s")) & (F.col("h") == F.col("_h")), "left").select(
        "series", "ds", "mean", "lower", "upper", F.col("y").alias("actual"))


def arima_grid(df: DataFrame, p, d, q) -> DataFrame:
    """(series, p, d, q, aic, best) for every order of the product; all orders share the passes over the rows.

    All orders are fitted to the same days, those that the longest lags reach; scores of different days don't compare.
    An order that the series is too short for has no score.
    """
    orders = [(a, b, c) for a in p for b in d for c in q]
    fits, _ = _arima_fits(df, orders)
    table = df.sparkSession.createDataFrame([(i, *o) for i, o in enumerate(orders)], "unit int, p int, d int, q int")
    least = F.min("aic").over(W.partitionBy("series"))  # over one row per order
    return (fits.join(F.broadcast(table), "unit").withColumn("best", F.coalesce(F.col("aic") == least, F.lit(False)))
            .select("series", "p", "d", "q", "aic", "best"))
