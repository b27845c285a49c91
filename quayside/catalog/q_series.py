"""Time series."""

from pyspark.sql import functions as F

from quayside.catalog.fixtures import HOLED, SERIES, holed_series, price_series, t_tail_sql
from quayside.catalog.registry import query
from quayside.operators import features as X, timeseries as T
from quayside.sources import read_table

CALENDAR = """
ends AS (SELECT series, min(ds) AS lo, max(ds) AS hi FROM holed GROUP BY 1),
cal AS (SELECT series, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY))
          AS DATE) AS ds FROM ends),
days AS (SELECT cal.series, cal.ds, holed.y FROM cal ASOF JOIN holed ON cal.series = holed.series AND cal.ds >= holed.ds
  WHERE isodow(cal.ds) <= 5)
"""


@query("business_day_resample", f"WITH {HOLED}, {CALENDAR} SELECT * FROM days", {"y": 6})
def _(spark, sf):
    return T.business_day_resample(holed_series(spark, sf))


@query("fill_series", f"""
WITH {HOLED}, {CALENDAR} SELECT series, ds, last_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY ds
  ROWS UNBOUNDED PRECEDING) AS y FROM days""", {"y": 6})
def _(spark, sf):
    return T.fill_series(holed_series(spark, sf))


def _decompose_sql(p: int, model: str) -> str:
    h = p // 2
    total = f"sum(y) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
    if p % 2 == 0:
        total += f" - (lag(y, {h}) OVER w + lead(y, {h}) OVER w) / 2"
    minus, mean = ("/", "/") if model == "multiplicative" else ("-", "-")
    return f"""
WITH {SERIES},
r AS (SELECT series, ds, y, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY series) AS n,
  CASE WHEN count(y) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) = {2 * h + 1} THEN ({total}) / {p} END AS t
  FROM series WINDOW w AS (PARTITION BY series ORDER BY ds)),
l AS (SELECT series, regr_slope(t, i) FILTER (WHERE i >= {h} AND i < {h + p}) AS k1,
  regr_intercept(t, i) FILTER (WHERE i >= {h} AND i < {h + p}) AS c1,
  regr_slope(t, i) FILTER (WHERE i >= n - 1 - {h + p} AND i < n - 1 - {h}) AS k2,
  regr_intercept(t, i) FILTER (WHERE i >= n - 1 - {h + p} AND i < n - 1 - {h}) AS c2 FROM r GROUP BY 1),
f AS (SELECT r.*, CASE WHEN i < {h} THEN k1 * i + c1 WHEN i > n - 1 - {h} THEN k2 * i + c2 ELSE t END AS trend
  FROM r JOIN l USING (series)),
m AS (SELECT series, i % {p} AS phase, avg(y {minus} trend) AS a FROM f GROUP BY 1, 2),
s AS (SELECT series, phase, a {mean} avg(a) OVER (PARTITION BY series) AS seasonal FROM m)
SELECT f.series, ds, y, trend, seasonal, y {minus} trend {minus} seasonal AS resid
FROM f JOIN s ON f.series = s.series AND f.i % {p} = s.phase"""


PARTS = {"y": 5, "trend": 5, "seasonal": 5, "resid": 5}


@query("seasonal_decompose", _decompose_sql(12, "additive"), PARTS)
def _(spark, sf):
    return T.seasonal_decompose(price_series(spark, sf), 12)


@query("seasonal_decompose_multiplicative", _decompose_sql(5, "multiplicative"), PARTS)
def _(spark, sf):
    return T.seasonal_decompose(price_series(spark, sf), 5, "multiplicative")


ACF = SERIES.rstrip() + """,
d AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY ds) AS i,
             y - avg(y) OVER (PARTITION BY series) AS d FROM series),
v AS (SELECT series, sum(d * d) AS v, count(*) AS n FROM d GROUP BY 1),
acf AS (SELECT a.series, CAST(a.i - b.i AS INTEGER) AS lag, sum(a.d * b.d) / any_value(v) AS acf,
  CAST(any_value(n) AS BIGINT) AS n
  FROM d a JOIN d b ON a.series = b.series AND a.i - b.i BETWEEN 0 AND 50 JOIN v ON v.series = a.series GROUP BY 1, 2)
"""


@query("autocorrelation", f"WITH {ACF} SELECT * FROM acf", {"acf": 8})
def _(spark, sf):
    return T.autocorrelation(price_series(spark, sf), 50)


# The recursion step by step: phi holds the coefficients of order k, "rest" the share of variance left.
@query("partial_autocorrelation", f"""
WITH RECURSIVE {ACF},
rs AS (SELECT series, any_value(n) AS n, list(acf * n / (n - lag) ORDER BY lag) AS r FROM acf GROUP BY 1),
steps AS (
  SELECT series, n, r, 0 AS k, []::DOUBLE[] AS phi, 1.0::DOUBLE AS rest, 1.0::DOUBLE AS a FROM rs
  UNION ALL
  SELECT series, n, r, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - b * phi[k + 1 - j]), b),
    rest * (1 - b * b), b
  FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])), 0))
               / rest AS b FROM steps WHERE k < 50))
SELECT series, CAST(k AS INTEGER) AS lag, a AS pacf, n FROM steps""", {"pacf": 8})
def _(spark, sf):
    return T.partial_autocorrelation(price_series(spark, sf), 50)


@query("significant_lags", f"""
WITH {ACF}, b AS (SELECT *, 1.96 / sqrt(n) AS band FROM acf WHERE lag >= 1),
g AS (SELECT *, min(lag) FILTER (WHERE abs(acf) <= band) OVER (PARTITION BY series) AS gap FROM b)
SELECT series, lag, acf, band, coalesce(lag < gap, true) AS in_first_run FROM g WHERE abs(acf) > band""",
       {"acf": 8, "band": 8})
def _(spark, sf):
    return T.significant_lags(T.autocorrelation(price_series(spark, sf), 50))


@query("adf_lag_zero", f"""
WITH {SERIES},
d AS (SELECT series, lag(y) OVER w AS x, y - lag(y) OVER w AS z FROM series WINDOW w AS (PARTITION BY series ORDER BY ds))
SELECT series, regr_slope(z, x) / sqrt((regr_syy(z, x) - regr_slope(z, x) * regr_sxy(z, x)) / (regr_count(z, x) - 2)
  / regr_sxx(z, x)) AS statistic, CAST(regr_count(z, x) AS BIGINT) AS n FROM d WHERE x IS NOT NULL GROUP BY 1""",
       {"statistic": 6})
def _(spark, sf):
    return T.adf_stationarity(price_series(spark, sf), 0, fixed_lag=True).select("series", "statistic", "n")


# Two regressors and a constant, by the sums of squares about the means.
@query("adf_lag_one", f"""
WITH {SERIES},
d AS (SELECT series, ds, lag(y) OVER w AS x, y - lag(y) OVER w AS z FROM series WINDOW w AS (PARTITION BY series ORDER BY ds)),
e AS (SELECT series, x, z, lag(z) OVER (PARTITION BY series ORDER BY ds) AS l FROM d),
s AS (SELECT series, count(*) AS n, var_pop(x) * count(*) AS xx, var_pop(l) * count(*) AS ll, var_pop(z) * count(*) AS zz,
  covar_pop(x, l) * count(*) AS xl, covar_pop(x, z) * count(*) AS xz, covar_pop(l, z) * count(*) AS lz
  FROM e WHERE l IS NOT NULL GROUP BY 1),
b AS (SELECT *, (xz * ll - lz * xl) / (xx * ll - xl * xl) AS bx, (lz * xx - xz * xl) / (xx * ll - xl * xl) AS bl FROM s)
SELECT series, bx / sqrt((zz - bx * xz - bl * lz) / (n - 3) * ll / (xx * ll - xl * xl)) AS statistic, 1 AS lag, n
FROM b""", {"statistic": 6})
def _(spark, sf):
    return T.adf_stationarity(price_series(spark, sf), 1, fixed_lag=True).select("series", "statistic", "lag", "n")


@query("adf_stationarity")
def _(spark, sf):
    return T.adf_stationarity(price_series(spark, sf))


def daily_kinds(spark, sf):
    return (read_table(spark, sf, "events").groupBy(F.to_date("ts").alias("ds"))
            .agg(F.count_if(F.col("event_type") == "click").alias("clicks"),
                 F.count_if(F.col("event_type") == "purchase").alias("purchases")))


@query("granger_causality")
def _(spark, sf):
    return T.granger_causality(daily_kinds(spark, sf), "clicks", "purchases", 5)


# With one lag the test is that of the partial correlation of today and the other's yesterday, given own yesterday.
@query("granger_lag_one", f"""
WITH d AS (SELECT CAST(ts AS DATE) AS ds, count(*) FILTER (WHERE event_type = 'click') AS x,
  count(*) FILTER (WHERE event_type = 'purchase') AS y FROM events GROUP BY 1),
l AS (SELECT y, lag(y) OVER (ORDER BY ds) AS y1, lag(x) OVER (ORDER BY ds) AS x1 FROM d),
r AS (SELECT corr(y, x1) AS a, corr(y, y1) AS b, corr(x1, y1) AS c, count(y1) AS n FROM l WHERE y1 IS NOT NULL),
p AS (SELECT (a - b * c) ** 2 / ((1 - b * b) * (1 - c * c)) AS q, n FROM r)
SELECT 1 AS lag, q / (1 - q) * (n - 3) AS f, 1 AS df_num, CAST(n - 3 AS INTEGER) AS df_den,
  {t_tail_sql("sqrt(q / (1 - q) * (n - 3))", "(n - 3)")} AS p_value FROM p""", {"f": 6, "p_value": 6})
def _(spark, sf):
    return T.granger_causality(daily_kinds(spark, sf), "clicks", "purchases", 1)


@query("fit_arima")
def _(spark, sf):
    return T.fit_arima(price_series(spark, sf), (1, 0, 10))


AR1 = """
m AS (SELECT series, avg(y) AS mean FROM {rows} GROUP BY 1),
x AS (SELECT s.series, ds, y - mean AS x, lag(y - mean) OVER (PARTITION BY s.series ORDER BY ds) AS x1
      FROM {rows} s JOIN m USING (series)),
fit AS (SELECT series, sum(x * x1) / sum(x1 * x1) AS phi, count(x1) AS n, arg_max(x, ds) AS x_last,
  (sum(x * x) FILTER (WHERE x1 IS NOT NULL) - sum(x * x1) ** 2 / sum(x1 * x1)) / count(x1) AS sigma2
  FROM x GROUP BY 1)
"""


@query("fit_arima_ar_one", f"""
WITH {SERIES}, {AR1.format(rows="series")}
SELECT series, 'const' AS term, mean AS value FROM m UNION ALL SELECT series, 'ar.L1', phi FROM fit
UNION ALL SELECT series, 'sigma2', sigma2 FROM fit
UNION ALL SELECT series, 'aic', n * (ln(2 * pi() * sigma2) + 1) + 6 FROM fit""", {"value": 3})
def _(spark, sf):
    return T.fit_arima(price_series(spark, sf), (1, 0, 0))


@query("fit_arima_ar_two", f"""
WITH {SERIES},
m AS (SELECT series, avg(y) AS mean FROM series GROUP BY 1),
x AS (SELECT s.series, y - mean AS x, lag(y - mean, 1) OVER w AS a, lag(y - mean, 2) OVER w AS b
  FROM series s JOIN m USING (series) WINDOW w AS (PARTITION BY s.series ORDER BY ds)),
s AS (SELECT series, count(*) AS n, sum(x * x) AS xx, sum(a * a) AS aa, sum(b * b) AS bb, sum(a * b) AS ab,
  sum(a * x) AS ax, sum(b * x) AS bx FROM x WHERE b IS NOT NULL GROUP BY 1),
f AS (SELECT *, (ax * bb - bx * ab) / (aa * bb - ab * ab) AS one, (bx * aa - ax * ab) / (aa * bb - ab * ab) AS two FROM s),
g AS (SELECT *, (xx - one * ax - two * bx) / n AS sigma2 FROM f)
SELECT series, 'const' AS term, mean AS value FROM m UNION ALL SELECT series, 'ar.L1', one FROM g
UNION ALL SELECT series, 'ar.L2', two FROM g UNION ALL SELECT series, 'sigma2', sigma2 FROM g
UNION ALL SELECT series, 'aic', n * (ln(2 * pi() * sigma2) + 1) + 8 FROM g""", {"value": 6})
def _(spark, sf):
    return T.fit_arima(price_series(spark, sf), (2, 0, 0))


@query("arima_grid_ar", f"""
WITH {SERIES}, {AR1.format(rows="series")},
sized AS (SELECT series, count(*) AS n, sum(x * x) / count(*) AS sigma2 FROM x WHERE x1 IS NOT NULL GROUP BY 1),
scores AS (SELECT series, 0 AS p, 0 AS d, 0 AS q, n * (ln(2 * pi() * sigma2) + 1) + 4 AS aic FROM sized
  UNION ALL SELECT series, 1, 0, 0, n * (ln(2 * pi() * sigma2) + 1) + 6 FROM fit)
SELECT *, aic = min(aic) OVER (PARTITION BY series) AS best FROM scores""", {"aic": 3})
def _(spark, sf):
    return T.arima_grid(price_series(spark, sf), [0, 1], [0], [0])


@query("forecast_arima_ar_one", f"""
WITH {SERIES},
d AS (SELECT ds, row_number() OVER (ORDER BY ds) AS r FROM (SELECT DISTINCT ds FROM series)),
cut AS (SELECT max(ds) AS last FROM d WHERE r <= round((SELECT count(*) FROM d) * 0.8)),
train AS (SELECT series.* FROM series, cut WHERE ds <= last), {AR1.format(rows="train")},
test AS (SELECT series.*, row_number() OVER (PARTITION BY series ORDER BY ds) AS h FROM series, cut WHERE ds > last)
SELECT test.series, ds, mean + phi ** h * x_last AS mean,
  mean + phi ** h * x_last - 1.959963984540054 * sqrt(sigma2 * (1 - phi ** (2 * h)) / (1 - phi * phi)) AS lower,
  mean + phi ** h * x_last + 1.959963984540054 * sqrt(sigma2 * (1 - phi ** (2 * h)) / (1 - phi * phi)) AS upper,
  y AS actual FROM test JOIN fit USING (series) JOIN m USING (series)""",
       {"mean": 4, "lower": 4, "upper": 4, "actual": 4})
def _(spark, sf):
    train, test = X.split_time(price_series(spark, sf), "ds")
    return T.forecast_arima(train, test, (1, 0, 0))


@query("forecast_arima", f"""
WITH {SERIES},
d AS (SELECT ds, row_number() OVER (ORDER BY ds) AS r FROM (SELECT DISTINCT ds FROM series)),
cut AS (SELECT max(ds) AS last FROM d WHERE r <= round((SELECT count(*) FROM d) * 0.8))
SELECT series, ds, y AS actual FROM series, cut WHERE ds > last""", {"actual": 6})
def _(spark, sf):
    train, test = X.split_time(price_series(spark, sf), "ds")
    return T.forecast_arima(train, test, (1, 0, 10)).select("series", "ds", "actual")


@query("forecast_arima_bounds")
def _(spark, sf):
    train, test = X.split_time(price_series(spark, sf), "ds")
    return T.forecast_arima(train, test, (1, 0, 10))


@query("arima_grid")
def _(spark, sf):
    return T.arima_grid(price_series(spark, sf), [1], [0], range(1, 10))
