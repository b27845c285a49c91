"""Joins and aggregations."""

from pyspark.sql import functions as F

from quayside.catalog.fixtures import (
    HOLED, NUMBERS, SERIES, SPOILED_CUSTOMER, SPOILED_ORDERS, VIOLATION_ORDER, VIOLATIONS, VISITS, WINDOWS_SQL,
    holed_series, price_series, spoiled_customer, spoiled_orders, t_tail_sql, violations, visits,
)
from quayside.catalog.q_clean import EVENT_KINDS, PAIR_SQL
from quayside.catalog.registry import query
from quayside.functions import scalars as S
from quayside.operators import aggregates as A, joins as J
from quayside.operators.timeseries import business_days
from quayside.sources import read_table

VISIT = "WITH " + VISITS.strip()
ORDER_SQL = "(l_linenumber, l_partkey, l_extendedprice, l_shipdate)"

# --- joins ---------------------------------------------------------------------------------------------


@query("interval_join", f"""
WITH {WINDOWS_SQL}
SELECT event_id, CAST(period_end AS TIMESTAMP) + INTERVAL 9 HOUR AS period_end
FROM events JOIN periods ON ts > CAST(period_start AS TIMESTAMP) + INTERVAL 9 HOUR
  AND ts <= CAST(period_end AS TIMESTAMP) + INTERVAL 9 HOUR""")
def _(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "ts")
    nine = F.expr("interval 9 hours")
    periods = A.daily_windows(events, "ts").select(
        *[(F.col(c).cast("timestamp_ntz") + nine).alias(c) for c in ("period_start", "period_end")])
    return J.interval_join(events, periods, "ts", "period_start", "period_end").select("event_id", "period_end")


@query("asof_calendar", f"""
WITH {HOLED},
ends AS (SELECT series, min(ds) AS lo, max(ds) AS hi FROM holed GROUP BY 1),
cal AS (SELECT series, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY))
          AS DATE) AS ds FROM ends)
SELECT cal.series, cal.ds, holed.y FROM cal ASOF JOIN holed ON cal.series = holed.series AND cal.ds >= holed.ds
WHERE isodow(cal.ds) <= 5""", {"y": 6})
def _(spark, sf):
    series = holed_series(spark, sf)
    return J.asof_calendar(business_days(series), series, ["series"], "ds")


@query("align_on_key", f"""
WITH {WINDOWS_SQL},
j AS (SELECT * FROM events JOIN periods ON ts > period_start AND ts <= period_end)
SELECT period_end, CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicks,
  CAST(count(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS BIGINT) AS viewers
FROM j GROUP BY 1""")
def _(spark, sf):
    events = read_table(spark, sf, "events")
    periods = A.daily_windows(events, "ts")
    views = A.weekly_active(events.filter("event_type = 'view'"), periods, "ts", "user_id", "event_type", ["view"])
    clicks = A.weekly_active(events.filter("event_type = 'click'"), periods, "ts", "user_id", "event_type", ["click"])
    return J.align_on_key(clicks.select("period_end", F.col("event_count").alias("clicks")),
                          views.select("period_end", F.col("engaged_users").alias("viewers")), "period_end")


@query("semi_in", """
SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)""")
def _(spark, sf):
    facts = read_table(spark, sf, "lineitem").filter("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey"))
    return J.semi_in(read_table(spark, sf, "part"), facts, "p_partkey").select("p_partkey", "p_name")


@query("lookup_description", """
WITH first_name AS (SELECT p_brand, arg_min(p_name, p_partkey) AS p_name FROM part GROUP BY 1),
n AS (SELECT p_brand, CAST(count(*) AS BIGINT) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT p_brand, n, p_name FROM n LEFT JOIN first_name USING (p_brand)""")
def _(spark, sf):
    part = read_table(spark, sf, "part")
    sold = read_table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    n = sold.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return J.lookup_description(n, part, "p_brand", "p_name", ["p_partkey"])


@query("join_rounded_geo", """
WITH pts AS (SELECT vec_id, label, round_even(embedding[1]::DOUBLE, 2) AS cell_lat,
                    round_even(embedding[2]::DOUBLE, 2) AS cell_lon FROM embeddings),
places AS (SELECT cell_lat, cell_lon, min(vec_id) AS place_id, CAST(count(*) AS BIGINT) AS n_places
           FROM pts GROUP BY 1, 2)
SELECT vec_id, cell_lat, cell_lon, place_id, n_places FROM pts JOIN places USING (cell_lat, cell_lon)""",
       {"cell_lat": 2, "cell_lon": 2})
def _(spark, sf):
    points = read_table(spark, sf, "embeddings").select(
        "vec_id", "label", F.col("embedding")[0].alias("lat"), F.col("embedding")[1].alias("lon"))
    matched = J.join_rounded_geo(points, points, "lat", "lon", "vec_id")
    return matched.select("vec_id", "cell_lat", "cell_lon", "place_id", "n_places")


# --- counts and profiles -------------------------------------------------------------------------------


@query("value_counts", "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def _(spark, sf):
    return A.value_counts(read_table(spark, sf, "events"), "event_type")


@query("value_counts_with_null", f"""
WITH {SPOILED_CUSTOMER} SELECT segment, CAST(count(*) AS BIGINT) AS n FROM spoiled GROUP BY 1""")
def _(spark, sf):
    return A.value_counts(spoiled_customer(spark, sf), "segment", keep_null=True)


@query("value_counts_all", """
SELECT 'o_orderstatus' AS variable, o_orderstatus AS value, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def _(spark, sf):
    return A.value_counts_all(read_table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("nunique_per_column", """
SELECT 'o_custkey' AS variable, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_distinct FROM orders
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) FROM orders""")
def _(spark, sf):
    return A.nunique_per_column(read_table(spark, sf, "orders"), ["o_custkey", "o_orderstatus", "o_orderdate"])


@query("distinct_values", "SELECT DISTINCT event_type FROM events")
def _(spark, sf):
    return A.distinct_values(read_table(spark, sf, "events"), "event_type")


@query("nunique_per_group", """
SELECT n_distinct, CAST(count(*) AS BIGINT) AS n_groups FROM (
  SELECT p_brand, count(DISTINCT p_name) AS n_distinct FROM part GROUP BY 1) GROUP BY 1""")
def _(spark, sf):
    return A.nunique_per_group(read_table(spark, sf, "part"), "p_brand", "p_name")


@query("duplicate_keys", """
SELECT text, lang, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1, 2 HAVING count(*) > 1""")
def _(spark, sf):
    return A.duplicate_keys(read_table(spark, sf, "documents"), ["text", "lang"])


@query("missing_per_column", f"""
WITH {SPOILED_CUSTOMER}
SELECT 'segment' AS variable, CAST(count(*) FILTER (WHERE segment IS NULL) AS BIGINT) AS n_missing FROM spoiled
UNION ALL SELECT 'balance', count(*) FILTER (WHERE balance IS NULL) FROM spoiled
UNION ALL SELECT 'c_custkey', 0""")
def _(spark, sf):
    return A.missing_per_column(spoiled_customer(spark, sf).select("segment", "balance", "c_custkey"))


@query("rows_with_missing", f"""
WITH {SPOILED_CUSTOMER} SELECT c_custkey FROM spoiled WHERE segment IS NULL OR balance IS NULL""")
def _(spark, sf):
    return A.rows_with_missing(spoiled_customer(spark, sf)).select("c_custkey")


def _describe_sql(cols, table, by=""):
    head = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return "\nUNION ALL ".join(
        f"SELECT {head}'{c}' AS variable, CAST(count({c}) AS BIGINT) AS count, avg({c}) AS mean, "
        f"stddev_samp({c}) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS p25, "
        f"quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM {table}{group}"
        for c in cols)


SIX = {"mean": 6, "std": 6, "min": 6, "p25": 6, "p50": 6, "p75": 6, "max": 6}


@query("describe_numeric", _describe_sql(NUMBERS, "lineitem"), {**SIX, "mean": 5, "std": 5})
def _(spark, sf):
    return A.describe_numeric(read_table(spark, sf, "lineitem"), NUMBERS)


@query("describe_all", """
WITH top AS (SELECT 'o_orderstatus' AS variable, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
  UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2
  UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY 2
  UNION ALL SELECT 'o_day', strftime(o_orderdate, '%Y-%m-%d'), count(*) FROM orders GROUP BY 2),
ends AS (SELECT 'o_custkey' AS variable, CAST(min(o_custkey) AS VARCHAR) AS min, CAST(max(o_custkey) AS VARCHAR) AS max
         FROM orders
         UNION ALL SELECT 'o_day', strftime(min(o_orderdate), '%Y-%m-%d'), strftime(max(o_orderdate), '%Y-%m-%d')
         FROM orders)
SELECT variable, CAST(sum(n) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS unique,
  min(CASE WHEN n = m THEN value END) AS top, max(n) AS freq, any_value(min) AS min, any_value(max) AS max
FROM (SELECT *, max(n) OVER (PARTITION BY variable) AS m FROM top) LEFT JOIN ends USING (variable) GROUP BY 1""")
def _(spark, sf):
    return A.describe_all(read_table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderpriority", "o_custkey", F.to_date("o_orderdate").alias("o_day")))


def _summary_sql(cols, table, by=""):
    head = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return "\nUNION ALL ".join(
        f"SELECT {head}'{c}' AS variable, stddev_samp({c}) AS std, avg({c}) AS mean, median({c}) AS median, "
        f"min({c}) AS min, max({c}) AS max FROM {table}{group}" for c in cols)


@query("summary_stats", _summary_sql(NUMBERS, "lineitem"), {"std": 5, "mean": 5, "median": 6})
def _(spark, sf):
    return A.summary_stats(read_table(spark, sf, "lineitem"), NUMBERS)


@query("summary_by_segment", f"""
SELECT l_returnflag, variable, statistic, value FROM (
  {_summary_sql(NUMBERS, "lineitem", "l_returnflag")}
) UNPIVOT (value FOR statistic IN (std, mean, median, min, max))""", {"value": 5})
def _(spark, sf):
    return A.summary_by_segment(read_table(spark, sf, "lineitem"), "l_returnflag", NUMBERS)


@query("variance_per_column", "\nUNION ALL ".join(
    f"SELECT '{c}' AS variable, var_samp({c}) AS variance FROM lineitem" for c in NUMBERS),
    {"variance": 1})
def _(spark, sf):
    return A.variance_per_column(read_table(spark, sf, "lineitem"), NUMBERS)


@query("column_profile", f"""
WITH {SPOILED_CUSTOMER}
SELECT 'c_custkey' AS variable, count(DISTINCT c_custkey) AS n_distinct, 'bigint' AS dtype,
  count(DISTINCT c_custkey) < 110 AS to_category, count(*) FILTER (WHERE c_custkey IS NULL) AS n_missing FROM spoiled
UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey), 'int', count(DISTINCT c_nationkey) < 110,
  count(*) FILTER (WHERE c_nationkey IS NULL) FROM spoiled
UNION ALL SELECT 'segment', count(DISTINCT segment), 'string', count(DISTINCT segment) < 110,
  count(*) FILTER (WHERE segment IS NULL) FROM spoiled
UNION ALL SELECT 'balance', count(DISTINCT balance), 'double', count(DISTINCT balance) < 110,
  count(*) FILTER (WHERE balance IS NULL) FROM spoiled""")
def _(spark, sf):
    return A.column_profile(spoiled_customer(spark, sf).drop("balance_text"))


@query("date_span", """
SELECT min(ts) AS first, max(ts) AS last,
  CAST(floor(date_diff('second', min(ts), max(ts)) / 86400) AS BIGINT) AS days FROM events""")
def _(spark, sf):
    return A.date_span(read_table(spark, sf, "events"), "ts")


# --- groups --------------------------------------------------------------------------------------------


@query("group_agg_named", VISIT + """
SELECT price, avg(converted) AS rate, CAST(sum(converted) AS BIGINT) AS yes,
  CAST(count(*) - sum(converted) AS BIGINT) AS no, CAST(count(o_custkey) AS BIGINT) AS n
FROM visits GROUP BY 1""", {"rate": 8})
def _(spark, sf):
    return A.group_agg_named(visits(spark, sf), ["price"], rate=F.avg("converted"), yes=F.sum("converted"),
                             no=F.count("*") - F.sum("converted"), n=F.count("o_custkey"))


@query("conversion_by_price", VISIT + """
SELECT price, avg(converted) AS conversion_rate, CAST(sum(converted) AS BIGINT) AS n_converted,
  CAST(count(*) - sum(converted) AS BIGINT) AS n_not_converted, CAST(count(o_custkey) AS BIGINT) AS n_visitors,
  sum(converted) * price / count(o_custkey) AS revenue_per_visitor
FROM visits GROUP BY price""", {"conversion_rate": 8, "revenue_per_visitor": 8})
def _(spark, sf):
    return A.conversion_by_price(visits(spark, sf), "price", "converted", "o_custkey")


SEGMENTED = VISIT + """,
wide AS (SELECT v.*, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS nation
         FROM visits v JOIN customer ON o_custkey = c_custkey),
long AS (SELECT 'c_mktsegment' AS variable, c_mktsegment AS value, test, converted FROM wide
         UNION ALL SELECT 'nation', nation, test, converted FROM wide),
by_segment AS (SELECT variable, value, CASE test WHEN 0 THEN 'control' ELSE 'treated' END AS test,
  avg(converted) AS conversion_rate, CAST(sum(converted) AS BIGINT) AS n_converted,
  CAST(count(*) - sum(converted) AS BIGINT) AS n_not_converted FROM long GROUP BY 1, 2, 3)
"""


def segmented(spark, sf):
    customer = read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation"))
    return A.conversion_by_segment(visits(spark, sf).join(customer, "o_custkey"), ["c_mktsegment", "nation"],
                                   "test", "converted", {0: "control", 1: "treated"})


@query("conversion_by_segment", SEGMENTED + "SELECT * FROM by_segment", {"conversion_rate": 8})
def _(spark, sf):
    return segmented(spark, sf)


@query("group_minmax", VISIT + "SELECT test, converted, min(ts) AS first, max(ts) AS last FROM visits GROUP BY 1, 2")
def _(spark, sf):
    return A.group_minmax(visits(spark, sf), ["test", "converted"], "ts")


@query("group_count", f"""
WITH {HOLED} SELECT series, CAST(year(ds) AS INTEGER) AS year, CAST(count(y) AS BIGINT) AS n FROM holed GROUP BY 1, 2""")
def _(spark, sf):
    return A.group_count(holed_series(spark, sf).withColumn("year", F.year("ds")), ["series", "year"], "y")


@query("first_non_null", f"""
WITH {VIOLATIONS}
SELECT inspection, arg_min(grade, {ORDER_SQL}) FILTER (WHERE grade IS NOT NULL) AS first_grade
FROM violations GROUP BY 1""")
def _(spark, sf):
    return A.first_non_null(violations(spark, sf), ["inspection"], "grade", VIOLATION_ORDER)


@query("first_row_test", f"""
WITH {VIOLATIONS}
SELECT inspection, arg_min(coalesce(grade = 'A', false), {ORDER_SQL}) AS first_row_ok FROM violations GROUP BY 1""")
def _(spark, sf):
    return A.first_row_test(violations(spark, sf), ["inspection"], F.col("grade") == "A", VIOLATION_ORDER)


@query("any_match", f"""
WITH {VIOLATIONS} SELECT inspection, bool_or(flag = 'Y') AS any_match FROM violations GROUP BY 1""")
def _(spark, sf):
    return A.any_match(violations(spark, sf), ["inspection"], F.col("flag") == "Y")


@query("distinct_non_null", f"""
WITH {VIOLATIONS} SELECT inspection, CAST(count(DISTINCT code) AS BIGINT) AS n_distinct FROM violations GROUP BY 1""")
def _(spark, sf):
    return A.distinct_non_null(violations(spark, sf), ["inspection"], "code")


CODE_LIST = "string_agg(code || 'x' || n, ',' ORDER BY code)"


def _code_text(col, value="code"):
    return F.array_join(F.transform(col, lambda v: F.concat(v[value], F.lit("x"), v["n"].cast("string"))), ",")


@query("collect_non_null", f"""
WITH {VIOLATIONS},
c AS (SELECT inspection, code, count(*) AS n FROM violations WHERE code IS NOT NULL GROUP BY 1, 2)
SELECT inspection, 0::BIGINT AS piece, {CODE_LIST} AS codes FROM c GROUP BY 1""")
def _(spark, sf):
    lists = A.collect_non_null(violations(spark, sf), ["inspection"], "code")
    return lists.select("inspection", "piece", _code_text("values", "value").alias("codes"))


ROLLUP = f"""
rolled AS (SELECT inspection, arg_min(coalesce(grade = 'A', false), {ORDER_SQL}) AS passed,
  arg_min(grade, {ORDER_SQL}) FILTER (WHERE grade IS NOT NULL) AS grade,
  bool_or(flag = 'Y') AS has_critical_flag, CAST(count(DISTINCT code) AS BIGINT) AS n_violations,
  bool_or(action = 'closed') AS closed FROM violations GROUP BY 1),
codes AS (SELECT inspection, {CODE_LIST} AS violation_codes
  FROM (SELECT inspection, code, count(*) AS n FROM violations WHERE code IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
"""


def rolled(spark, sf):
    return A.inspection_rollup(violations(spark, sf), ["inspection"], "grade", "flag", "code", VIOLATION_ORDER,
                               action="action", closed=("closed",))


@query("inspection_rollup", f"""
WITH {VIOLATIONS}, {ROLLUP}
SELECT r.*, coalesce(violation_codes, '') AS violation_codes FROM rolled r LEFT JOIN codes USING (inspection)""")
def _(spark, sf):
    return rolled(spark, sf).withColumn("violation_codes", _code_text("violation_codes"))


@query("visit_frequency", """
SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT o_orderdate::DATE) AS BIGINT) AS n_visits,
  CASE WHEN count(DISTINCT o_orderdate::DATE) > 1 THEN CAST(floor(date_diff('day', min(o_orderdate), max(o_orderdate))
    / (count(DISTINCT o_orderdate::DATE) - 1)) AS BIGINT) END AS mean_days_between
FROM orders GROUP BY 1""")
def _(spark, sf):
    return A.visit_frequency(read_table(spark, sf, "orders"), "o_custkey", "o_orderdate")


@query("per_user_mean", """
SELECT day, avg(n) AS mean_per_user FROM (
  SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n FROM events WHERE starts_with(event_type, 's') GROUP BY 1, 2)
GROUP BY 1""", {"mean_per_user": 8})
def _(spark, sf):
    ev = read_table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return A.per_user_mean(ev, ["day"], "user_id", F.col("event_type").startswith("s"))


KIND_SQL = ", ".join(f"nullif(count(*) FILTER (WHERE event_type = '{k}'), 0) AS {k}" for k in EVENT_KINDS)


def weekly(spark, sf):
    events = read_table(spark, sf, "events")
    return A.weekly_active(events, A.daily_windows(events, "ts"), "ts", "user_id", "event_type", EVENT_KINDS)


@query("weekly_active", f"""
WITH {WINDOWS_SQL}
SELECT period_start, period_end, CAST(count(DISTINCT user_id) AS BIGINT) AS engaged_users,
  CAST(count(*) AS BIGINT) AS event_count, {KIND_SQL}
FROM events JOIN periods ON ts > period_start AND ts <= period_end GROUP BY 1, 2""")
def _(spark, sf):
    return weekly(spark, sf)


@query("weekly_messages", f"""
WITH {WINDOWS_SQL},
j AS (SELECT * FROM events JOIN periods ON ts > period_start AND ts <= period_end),
sent AS (SELECT period_end, avg(n) AS sent_per_user FROM (
  SELECT period_end, user_id, count(*) AS n FROM j WHERE starts_with(event_type, 'p') GROUP BY 1, 2) GROUP BY 1)
SELECT period_start, period_end, CAST(count(DISTINCT user_id) AS BIGINT) AS messaged_users,
  CAST(count(*) AS BIGINT) AS message_count, {KIND_SQL}, any_value(sent_per_user) AS sent_per_user
FROM j JOIN sent USING (period_end) GROUP BY 1, 2""", {"sent_per_user": 8})
def _(spark, sf):
    events = read_table(spark, sf, "events")
    return A.weekly_messages(events, A.daily_windows(events, "ts"), "ts", "user_id", "event_type", EVENT_KINDS,
                             sent_prefix="p")


# --- correlation and the rest --------------------------------------------------------------------------


@query("correlation_matrix", "WITH p AS (" + PAIR_SQL + """)
SELECT var1 AS variable, max(CASE WHEN var2 = 'l_quantity' THEN abs(value) END) AS l_quantity,
  max(CASE WHEN var2 = 'l_extendedprice' THEN abs(value) END) AS l_extendedprice,
  max(CASE WHEN var2 = 'l_discount' THEN abs(value) END) AS l_discount,
  max(CASE WHEN var2 = 'l_tax' THEN abs(value) END) AS l_tax FROM p GROUP BY 1""", {c: 8 for c in NUMBERS})
def _(spark, sf):
    return A.correlation_matrix(read_table(spark, sf, "lineitem"), NUMBERS, absolute=True)


@query("correlation_wide", f"SELECT var1, var2, value AS r FROM ({PAIR_SQL}) WHERE "
       + " OR ".join(f"(var1 = '{a}' AND var2 = '{b}')" for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]),
       {"r": 8})
def _(spark, sf):
    return A.correlation_wide(read_table(spark, sf, "lineitem"), NUMBERS)


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "charge"]


@query("correlated_pairs", "WITH l AS (SELECT *, l_quantity * (1 - l_discount) AS charge FROM lineitem), p AS ("
       + "\nUNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, abs(corr({a}, {b})) AS r FROM l"
                             for a in CORR_COLS for b in CORR_COLS if a != b)
       + ") SELECT * FROM p WHERE r > 0.5", {"r": 8})
def _(spark, sf):
    li = read_table(spark, sf, "lineitem").withColumn("charge", F.col("l_quantity") * (1 - F.col("l_discount")))
    return A.correlated_pairs(li, CORR_COLS)


@query("pearson_r", f"""
WITH {WINDOWS_SQL},
w AS (SELECT period_end, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) AS n_events
  FROM events JOIN periods ON ts > period_start AND ts <= period_end GROUP BY 1),
q AS (SELECT corr(clicks, n_events) AS r, CAST(count(*) AS BIGINT) AS n FROM w)
SELECT r, n, {t_tail_sql("(abs(r) * sqrt((n - 2) / (1 - r * r)))", "(n - 2)")} AS p_value FROM q""",
       {"r": 8, "p_value": 6})
def _(spark, sf):
    return A.pearson_r(weekly(spark, sf), "click", "event_count")


@query("baseline_rate", VISIT + """
SELECT avg(converted) AS rate, CAST(count(*) AS BIGINT) AS n FROM visits WHERE test = 0""", {"rate": 8})
def _(spark, sf):
    return A.baseline_rate(visits(spark, sf), "test", 0, "converted")


@query("resample_month_mean", f"""
WITH {SERIES} SELECT series, CAST(date_trunc('month', ds) AS DATE) AS month, avg(y) AS mean_y FROM series
GROUP BY 1, 2""", {"mean_y": 6})
def _(spark, sf):
    return A.resample_month_mean(price_series(spark, sf), ["series"], "ds", "y")


@query("bad_share", f"""
WITH {SPOILED_ORDERS}
SELECT CAST(count(*) FILTER (WHERE ts_text LIKE '%:60%') AS BIGINT) AS n_bad,
  avg(CASE WHEN ts_text LIKE '%:60%' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS bad_share FROM spoiled""",
       {"bad_share": 8})
def _(spark, sf):
    parsed = F.try_to_timestamp("ts_text", F.lit(S.DATE_TEXT))
    return A.bad_share(spoiled_orders(spark, sf), parsed.isNotNull())
