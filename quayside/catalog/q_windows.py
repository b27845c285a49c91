"""Windows, order, samples, stacking."""

from pyspark.sql import functions as F

from quayside.catalog.fixtures import HOLED, SERIES, VISITS, holed_series, price_series, visits
from quayside.catalog.registry import query
from quayside.operators import sampling as P, windows as N
from quayside.sources import read_table

VISIT = "WITH " + VISITS.strip()


@query("rolling_count", """
SELECT event_id, count(*) OVER (ORDER BY ts RANGE BETWEEN INTERVAL '6 days 23:59:59.999999' PRECEDING
  AND CURRENT ROW) AS rolling_n FROM events""")
def _(spark, sf):
    return N.rolling_count(read_table(spark, sf, "events"), "ts").select("event_id", "rolling_n")


@query("rolling_count_by_kind", """
SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN
  INTERVAL '6 days 23:59:59.999999' PRECEDING AND CURRENT ROW) AS rolling_n FROM events""")
def _(spark, sf):
    return N.rolling_count(read_table(spark, sf, "events"), "ts", keys=("event_type",)).select(
        "event_id", "rolling_n")


@query("cumulative_count", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS cumulative_n FROM orders""")
def _(spark, sf):
    return N.cumulative_count(read_table(spark, sf, "orders"), "o_orderdate", ["o_orderkey"]).select(
        "o_orderkey", "cumulative_n")


@query("cumulative_count_activated", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS cumulative_n FROM orders
WHERE o_orderstatus = 'F'""")
def _(spark, sf):
    return N.cumulative_count(read_table(spark, sf, "orders"), "o_orderdate", ["o_orderkey"],
                              where=F.col("o_orderstatus") == "F").select("o_orderkey", "cumulative_n")


@query("cumulative_sum_by_group", VISIT + """
SELECT o_orderkey, test, CAST(sum(converted) OVER (PARTITION BY test ORDER BY ts, o_orderkey
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative FROM visits""")
def _(spark, sf):
    return N.cumulative_sum_by_group(visits(spark, sf), ["test"], "converted", ["ts", "o_orderkey"]).select(
        "o_orderkey", "test", "cumulative")


@query("diff_previous", """
SELECT o_orderkey, o_totalprice - lag(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey) AS diff FROM orders""",
       {"diff": 2})
def _(spark, sf):
    return N.diff_previous(read_table(spark, sf, "orders"), "o_totalprice", ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "diff")


@query("diff_previous_by_key", """
SELECT o_custkey, max(d) AS max_gap FROM (SELECT o_custkey, CAST(date_diff('day', lag(o_orderdate) OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS INTEGER) AS d FROM orders) GROUP BY 1""")
def _(spark, sf):
    orders = read_table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    gaps = N.diff_previous(orders, "day", ["day", "o_orderkey"], ("o_custkey",))
    return gaps.groupBy("o_custkey").agg(F.max("diff").alias("max_gap"))


@query("forward_fill", f"""
WITH {HOLED} SELECT series, ds, last_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY ds
  ROWS UNBOUNDED PRECEDING) AS y FROM holed""", {"y": 6})
def _(spark, sf):
    return N.forward_fill(holed_series(spark, sf), ["series"], "ds", ["y"])


@query("rank_results", """
SELECT o_orderpriority, o_orderstatus, round(avg(o_totalprice), 2) AS score,
  CAST(rank() OVER (ORDER BY round(avg(o_totalprice), 2) DESC) AS INTEGER) AS rank FROM orders GROUP BY 1, 2""",
       {"score": 2})
def _(spark, sf):
    scores = read_table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.round(F.avg("o_totalprice"), 2).alias("score"))
    return N.rank_results(scores, "score")


def _cma_sql(p):
    h = p // 2
    total = f"sum(y) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
    if p % 2 == 0:
        total += f" - (lag(y, {h}) OVER w + lead(y, {h}) OVER w) / 2"
    return (f"WITH {SERIES} SELECT series, ds, CASE WHEN count(y) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} "
            f"FOLLOWING) = {2 * h + 1} THEN ({total}) / {p} END AS trend FROM series "
            f"WINDOW w AS (PARTITION BY series ORDER BY ds)")


@query("centered_moving_average", _cma_sql(12), {"trend": 5})
def _(spark, sf):
    return N.centered_moving_average(price_series(spark, sf), ["series"], "ds", "y", 12).drop("y")


@query("centered_moving_average_odd", _cma_sql(5), {"trend": 5})
def _(spark, sf):
    return N.centered_moving_average(price_series(spark, sf), ["series"], "ds", "y", 5).drop("y")


@query("lagged_values", f"""
WITH {SERIES} SELECT series, ds, y, lag(y, 1) OVER w AS y_lag1, lag(y, 2) OVER w AS y_lag2, lag(y, 3) OVER w AS y_lag3
FROM series WINDOW w AS (PARTITION BY series ORDER BY ds)""", {"y": 6, "y_lag1": 6, "y_lag2": 6, "y_lag3": 6})
def _(spark, sf):
    return N.lagged_values(price_series(spark, sf), ["series"], "ds", "y", 3)


@query("sort_by", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey")
def _(spark, sf):
    return P.sort_by(read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
                     ["o_orderdate", "o_orderkey"], [False, True])


@query("head_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50")
def _(spark, sf):
    return P.head_n(read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 50,
                    ["o_totalprice", "o_orderkey"])


@query("tail_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 50")
def _(spark, sf):
    return P.tail_n(read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 50,
                    ["o_totalprice", "o_orderkey"])


@query("top_bottom_k", """
SELECT * FROM (SELECT p_partkey, p_retailprice, 'top' AS "end" FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10)
UNION ALL
SELECT * FROM (SELECT p_partkey, p_retailprice, 'bottom' FROM part ORDER BY p_retailprice, p_partkey LIMIT 10)""")
def _(spark, sf):
    return P.top_bottom_k(read_table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice", 10,
                          ["p_partkey"])


@query("head_fraction", """
SELECT event_id FROM events QUALIFY row_number() OVER (ORDER BY ts, event_id) <=
  floor(0.1 * (SELECT count(*) FROM events))""")
def _(spark, sf):
    return P.head_fraction(read_table(spark, sf, "events"), "ts", 0.1, ["event_id"]).select("event_id")


HASH52 = "('0x' || substr(md5({key} || '|{seed}'), 1, 13))::BIGINT"


@query("sample_n", f"""
SELECT doc_id, lang FROM documents ORDER BY {HASH52.format(key="doc_id", seed=48)}, doc_id LIMIT 25""")
def _(spark, sf):
    return P.sample_n(read_table(spark, sf, "documents"), 25, "doc_id", 48).select("doc_id", "lang")


def _draw(i, col):
    h = HASH52.format(key="o_orderkey", seed=f"48.{i}")
    return (f"(SELECT CAST(row_number() OVER (ORDER BY {h}, o_orderkey) AS INTEGER) AS row, {col} FROM orders "
            f"QUALIFY row_number() OVER (ORDER BY {h}, o_orderkey) <= 40)")


@query("sample_columns_independently", f"""
SELECT row, o_totalprice, o_orderstatus FROM {_draw(0, "o_totalprice")} JOIN {_draw(1, "o_orderstatus")} USING (row)""")
def _(spark, sf):
    return P.sample_columns_independently(read_table(spark, sf, "orders"), ["o_totalprice", "o_orderstatus"], 40,
                                          "o_orderkey", 48)


LANGS = ["de", "en", "es", "fr"]


@query("union_all", """
SELECT doc_id, source FROM documents WHERE lang IN ('de', 'en', 'es', 'fr')
UNION ALL SELECT doc_id, source FROM documents WHERE lang NOT IN ('de', 'en', 'es', 'fr') OR lang IS NULL""")
def _(spark, sf):
    docs = read_table(spark, sf, "documents")
    known = F.coalesce(F.col("lang").isin(*LANGS), F.lit(False))
    parts = [docs.filter(F.col("lang") == lang).select("doc_id", "source") for lang in LANGS]
    return P.union_all(*parts, docs.filter(~known).select("doc_id", "source"))


@query("distinct_pairs", f"""
WITH {SERIES} SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT week(ds), year(ds) FROM series)""")
def _(spark, sf):
    dated = price_series(spark, sf).select(F.weekofyear("ds").alias("week"), F.year("ds").alias("year"))
    return P.distinct_pairs(dated, ["week", "year"])


@query("split_back", """
SELECT lang, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1""")
def _(spark, sf):
    parts = P.split_back(read_table(spark, sf, "documents").select("doc_id", "lang"), "lang", LANGS)
    other = parts.pop(None).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(lang).alias("lang"), "n") for lang, df in parts.items()]
    return P.union_all(*counts).unionByName(other)
