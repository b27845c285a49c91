"""Chart data."""

from pyspark.sql import functions as F

from quayside.catalog.fixtures import NUMBERS, VISITS, visits
from quayside.catalog.q_aggregates import SEGMENTED, segmented
from quayside.catalog.registry import query
from quayside.operators import charts as H, windows as N
from quayside.sources import read_table


def _bins_sql(col, table, bins, key="", name=None):
    head = f"{key}, " if key else ""
    return (f"SELECT {head}'{name or col}' AS variable, CAST(least(floor({bins} * ({col} - lo) / (hi - lo)) + 1, {bins}) "
            f"AS INTEGER) AS bin, any_value(lo) AS a, any_value(hi) AS b, CAST(count(*) AS BIGINT) AS n FROM {table}, "
            f"(SELECT min({col}) AS lo, max({col}) AS hi FROM {table}) GROUP BY ALL")


def _hist_sql(cols, table, bins, key=""):
    parts = "\nUNION ALL ".join(_bins_sql(c, table, bins, key) for c in cols)
    head = f"{key}, " if key else ""
    return (f"SELECT {head}variable, bin, a + (bin - 1) * (b - a) / {bins} AS lo, a + bin * (b - a) / {bins} AS hi, n "
            f"FROM ({parts})")


EDGES = {"lo": 6, "hi": 6}


@query("histogram", _hist_sql(NUMBERS, "lineitem", 20), EDGES)
def _(spark, sf):
    return H.histogram(read_table(spark, sf, "lineitem"), NUMBERS, 20)


@query("histogram_by_segment", _hist_sql(NUMBERS, "lineitem", 50, "l_returnflag"), EDGES)
def _(spark, sf):
    return H.histogram_by_segment(read_table(spark, sf, "lineitem"), NUMBERS, "l_returnflag", 50)


@query("date_histogram", """
WITH d AS (SELECT date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::DOUBLE AS x FROM orders),
b AS (""" + _bins_sql("x", "d", 20, name="o_orderdate") + """)
SELECT variable, bin, CAST(DATE '1970-01-01' + CAST(ceil(a + (bin - 1) * ((b - a) / 20)) AS INTEGER) AS DATE) AS first_day,
  n FROM b""")
def _(spark, sf):
    return H.date_histogram(read_table(spark, sf, "orders"), ["o_orderdate"], 20)


def _box_sql(cols, table, key):
    return "\nUNION ALL ".join(
        f"SELECT {key}, '{c}' AS variable, min({c}) AS min, any_value(q1) AS q1, any_value(q2) AS median, "
        f"any_value(q3) AS q3, max({c}) AS max, min({c}) FILTER (WHERE {c} >= q1 - 1.5 * (q3 - q1)) AS whisker_lo, "
        f"max({c}) FILTER (WHERE {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_hi, "
        f"CAST(count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers "
        f"FROM {table} JOIN (SELECT {key}, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, "
        f"quantile_cont({c}, 0.75) AS q3 FROM {table} GROUP BY 1) USING ({key}) GROUP BY 1"
        for c in cols)


BOX = {c: 6 for c in ("min", "q1", "median", "q3", "max", "whisker_lo", "whisker_hi")}


@query("box_stats", _box_sql(NUMBERS, "lineitem", "l_returnflag"), BOX)
def _(spark, sf):
    return H.box_stats(read_table(spark, sf, "lineitem"), NUMBERS, ("l_returnflag",))


@query("category_counts", """
SELECT 'o_orderstatus' AS variable, o_orderstatus AS value, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def _(spark, sf):
    return H.category_counts(read_table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("large_categories", """
SELECT 'o_custkey' AS variable, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_distinct FROM orders""")
def _(spark, sf):
    return H.large_categories(read_table(spark, sf, "orders"), ["o_orderstatus", "o_custkey"])


@query("segment_bars", SEGMENTED + "SELECT variable, value, test, conversion_rate FROM by_segment",
       {"conversion_rate": 8})
def _(spark, sf):
    return H.segment_bars(segmented(spark, sf), "conversion_rate", ["variable", "value", "test"])


@query("line_points", "WITH " + VISITS.strip() + """
SELECT CAST(year(ts) AS INTEGER) AS year, test, ts, CAST(sum(converted) OVER (PARTITION BY test ORDER BY ts, o_orderkey
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative FROM visits""")
def _(spark, sf):
    running = N.cumulative_sum_by_group(visits(spark, sf), ["test"], "converted", ["ts", "o_orderkey"])
    return H.line_points(running.withColumn("year", F.year("ts")), "ts", "cumulative", "test", "year")
