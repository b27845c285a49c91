"""Projections, filters, cleaning, reshape, scalar functions."""

import datetime

from pyspark.sql import functions as F

from quayside.catalog.fixtures import (
    HOLED, NUMBERS, SPOILED_CUSTOMER, VIOLATIONS, holed_series, spoiled_customer, violations,
)
from quayside.catalog.registry import query
from quayside.functions import scalars as S
from quayside.operators import aggregates as A, clean as C, reshape as R
from quayside.sources import read_table

CODES = ["?", "No idea", "#"]


@query("select_columns", "SELECT l_discount, l_linenumber, l_tax FROM lineitem")
def _(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_tax", "l_linenumber", "l_discount", "l_quantity")
    return C.select_columns(li, exclude=("l_quantity",))


@query("select_columns_by_suffix", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def _(spark, sf):
    return C.select_columns(read_table(spark, sf, "lineitem"), prefix="l_", suffix="key")


@query("select_by_type", "SELECT o_orderstatus, o_orderpriority FROM orders")
def _(spark, sf):
    return C.select_by_type(read_table(spark, sf, "orders"), "text")


@query("rename_columns", """
SELECT p_partkey AS part, p_name, p_brand, p_type, p_size AS size, p_retailprice FROM part""")
def _(spark, sf):
    return C.rename_columns(read_table(spark, sf, "part"), {"p_partkey": "part", "p_size": "size"})


@query("drop_columns", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def _(spark, sf):
    return C.drop_columns(read_table(spark, sf, "part"), ["p_name", "p_retailprice"])


@query("filter_eq", "SELECT event_id, user_id FROM events WHERE event_type = 'view'")
def _(spark, sf):
    return C.filter_eq(read_table(spark, sf, "events"), "event_type", "view").select("event_id", "user_id")


@query("filter_range", """
SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-08' AND ts <= TIMESTAMP '2024-01-15'""")
def _(spark, sf):
    return C.filter_range(read_table(spark, sf, "events"), "ts", datetime.datetime(2024, 1, 8),
                          datetime.datetime(2024, 1, 15)).select("event_id", "ts")


@query("filter_in", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')")
def _(spark, sf):
    return C.filter_in(read_table(spark, sf, "orders"), "o_orderstatus", ["F", "P"]).select("o_orderkey")


@query("filter_not_in", f"""
WITH {SPOILED_CUSTOMER}
SELECT c_custkey, segment FROM spoiled
WHERE segment IS NULL OR segment NOT IN ('BUILDING', 'MACHINERY')""")
def _(spark, sf):
    return C.filter_not_in(spoiled_customer(spark, sf), "segment", ["BUILDING", "MACHINERY"]).select(
        "c_custkey", "segment")


@query("filter_null", f"WITH {SPOILED_CUSTOMER} SELECT c_custkey FROM spoiled WHERE segment IS NULL")
def _(spark, sf):
    return C.filter_null(spoiled_customer(spark, sf), "segment").select("c_custkey")


@query("filter_not_null", f"WITH {SPOILED_CUSTOMER} SELECT c_custkey FROM spoiled WHERE segment IS NOT NULL")
def _(spark, sf):
    return C.filter_not_null(spoiled_customer(spark, sf), "segment").select("c_custkey")


@query("drop_any_null", f"""
WITH {SPOILED_CUSTOMER}
SELECT * FROM spoiled WHERE segment IS NOT NULL AND balance IS NOT NULL""")
def _(spark, sf):
    return C.drop_any_null(spoiled_customer(spark, sf))


@query("drop_all_null", f"""
WITH {SPOILED_CUSTOMER}
SELECT * FROM spoiled WHERE segment IS NOT NULL OR balance IS NOT NULL""")
def _(spark, sf):
    return C.drop_any_null(spoiled_customer(spark, sf), how="all", subset=["segment", "balance"])


@query("null_codes", f"""
WITH {SPOILED_CUSTOMER}
SELECT c_custkey, CASE WHEN balance_text NOT IN ('?', 'No idea', '#') THEN balance_text END AS balance_text,
       segment FROM spoiled""")
def _(spark, sf):
    return C.null_codes(spoiled_customer(spark, sf), CODES).select("c_custkey", "balance_text", "segment")


@query("fill_const", f"""
WITH {SPOILED_CUSTOMER}
SELECT c_custkey, coalesce(balance, 0.0) AS balance, coalesce(segment, 'none') AS segment FROM spoiled""")
def _(spark, sf):
    return C.fill_const(spoiled_customer(spark, sf), {"balance": 0.0, "segment": "none"}).select(
        "c_custkey", "balance", "segment")


@query("recode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END
  AS o_orderstatus FROM orders""")
def _(spark, sf):
    return C.recode(read_table(spark, sf, "orders"), "o_orderstatus", {"F": "finished", "O": "open"}).select(
        "o_orderkey", "o_orderstatus")


@query("cast_columns", f"""
WITH {SPOILED_CUSTOMER} SELECT c_custkey, TRY_CAST(balance_text AS INTEGER) AS balance_text FROM spoiled""")
def _(spark, sf):
    return C.cast_columns(spoiled_customer(spark, sf), ["balance_text"], "int").select(
        "c_custkey", "balance_text")


@query("dedup_exact", "SELECT DISTINCT text, lang FROM documents")
def _(spark, sf):
    return C.dedup_exact(read_table(spark, sf, "documents").select("doc_id", "text", "lang"), ("doc_id",))


@query("drop_after_profile", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def _(spark, sf):
    kept, _removed = C.drop_after_profile(read_table(spark, sf, "orders"), "o_orderstatus", ["P"])
    return kept.select("o_orderkey", "o_orderstatus")


@query("drop_after_profile_count", """
SELECT CAST(count(*) AS BIGINT) AS n_removed FROM orders WHERE o_orderstatus = 'P'""")
def _(spark, sf):
    return C.drop_after_profile(read_table(spark, sf, "orders"), "o_orderstatus", ["P"])[1]


@query("row_audit", f"""
WITH {SPOILED_CUSTOMER},
n AS (SELECT count(*) AS n0, count(*) FILTER (WHERE segment IS NOT NULL) AS n1,
  count(*) FILTER (WHERE segment IS NOT NULL AND balance IS NOT NULL) AS n2,
  count(*) FILTER (WHERE segment IS NOT NULL AND balance IS NOT NULL AND balance < 9000) AS n3 FROM spoiled)
SELECT 1 AS step, 'segment' AS name, n0 AS n_before, n1 AS n_after, n0 - n1 AS n_removed FROM n
UNION ALL SELECT 2, 'balance', n1, n2, n1 - n2 FROM n
UNION ALL SELECT 3, 'outlier', n2, n3, n2 - n3 FROM n""")
def _(spark, sf):
    return C.row_audit(spoiled_customer(spark, sf), [
        ("segment", F.col("segment").isNotNull()), ("balance", F.col("balance").isNotNull()),
        ("outlier", F.col("balance") < 9000)])


@query("trim_leading_incomplete", f"""
WITH {HOLED}
SELECT series, ds, y FROM holed WHERE ds >= (SELECT min(ds) FROM holed WHERE y IS NOT NULL)""", {"y": 6})
def _(spark, sf):
    return C.trim_leading_incomplete(holed_series(spark, sf), "ds", ["y"])


@query("add_literal", """
SELECT event_id, DATE '2024-01-01' AS period_start, DATE '2024-01-08' AS period_end FROM events""")
def _(spark, sf):
    return C.add_literal(read_table(spark, sf, "events").select("event_id"), {
        "period_start": datetime.date(2024, 1, 1), "period_end": datetime.date(2024, 1, 8)})


@query("derive_ratio", """
SELECT o_orderpriority, sum(o_totalprice) / count(DISTINCT o_custkey) AS per_customer
FROM orders GROUP BY 1""", {"per_customer": 4})
def _(spark, sf):
    g = read_table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.sum("o_totalprice").alias("total"), F.count_distinct("o_custkey").alias("customers"))
    return C.derive_ratio(g, "per_customer", F.col("total"), F.col("customers")).select(
        "o_orderpriority", "per_customer")


@query("flag_gradeable", """
SELECT o_orderkey, coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')
  AND o_orderdate >= TIMESTAMP '1997-01-01', false) AS is_gradeable FROM orders""")
def _(spark, sf):
    return C.flag_gradeable(read_table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"],
                            "o_orderstatus", ["F", "O"], "o_orderdate", datetime.date(1997, 1, 1)).select(
        "o_orderkey", "is_gradeable")


KINDS = {"is_high": "high", "is_urgent": "URGENT", "is_spec": "specified", "is_low": "^5"}


@query("flag_text_kind", """
SELECT o_orderkey, o_orderpriority ILIKE '%high%' AS is_high, o_orderpriority ILIKE '%urgent%' AS is_urgent,
  o_orderpriority ILIKE '%specified%' AS is_spec, o_orderpriority LIKE '5%' AS is_low FROM orders""")
def _(spark, sf):
    return C.flag_text_kind(read_table(spark, sf, "orders"), "o_orderpriority", KINDS, ignore_case=True).select(
        "o_orderkey", *KINDS)


@query("filter_compound", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE (o_orderpriority LIKE '%HIGH%' OR o_orderpriority LIKE '%URGENT%')
  AND (o_orderstatus = 'F' OR o_orderstatus = 'P') ORDER BY o_orderdate, o_orderkey""")
def _(spark, sf):
    flagged = C.flag_text_kind(read_table(spark, sf, "orders"), "o_orderpriority",
                               {"is_high": "HIGH", "is_urgent": "URGENT"}, regex=False)
    flagged = flagged.withColumns({"done": F.col("o_orderstatus") == "F", "part": F.col("o_orderstatus") == "P"})
    return C.filter_compound(flagged, ["is_high", "is_urgent"], ["done", "part"],
                             ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_orderdate")


@query("melt", """
SELECT l_orderkey, l_linenumber, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""")
def _(spark, sf):
    return R.melt(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                  ["l_quantity", "l_discount", "l_tax"])


@query("melt_mixed_types", """
SELECT o_orderkey, 'o_custkey' AS field, CAST(o_custkey AS VARCHAR) AS text FROM orders
UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus FROM orders""")
def _(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return R.melt(orders, ["o_orderkey"], var="field", val="text")


EVENT_KINDS = ["click", "error", "purchase", "signup", "view"]


@query("pivot_counts", """
SELECT user_id, CAST(ts AS DATE) AS day,
  nullif(count(*) FILTER (WHERE event_type = 'click'), 0) AS click,
  nullif(count(*) FILTER (WHERE event_type = 'error'), 0) AS error,
  nullif(count(*) FILTER (WHERE event_type = 'purchase'), 0) AS purchase,
  nullif(count(*) FILTER (WHERE event_type = 'signup'), 0) AS signup,
  nullif(count(*) FILTER (WHERE event_type = 'view'), 0) AS view
FROM events GROUP BY 1, 2""")
def _(spark, sf):
    ev = read_table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return R.pivot_counts(ev, ["user_id", "day"], "event_type", EVENT_KINDS)


PAIR_SQL = "\nUNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS value FROM lineitem" for a in NUMBERS for b in NUMBERS)


@query("matrix_to_pairs", PAIR_SQL, {"value": 8})
def _(spark, sf):
    return R.matrix_to_pairs(A.correlation_matrix(read_table(spark, sf, "lineitem"), NUMBERS), "variable")


@query("concat_columns", """
SELECT *, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS status_f,
  CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS status_o FROM orders""")
def _(spark, sf):
    status = F.col("o_orderstatus")
    return R.concat_columns(read_table(spark, sf, "orders"), {
        "status_f": (status == "F").cast("int"), "status_o": (status == "O").cast("int")})


@query("strip_prefix", """
SELECT variable, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'quantity' AS variable FROM lineitem UNION ALL SELECT 'tax' FROM lineitem) GROUP BY 1""")
def _(spark, sf):
    long = R.melt(read_table(spark, sf, "lineitem"), ["l_orderkey"], ["l_quantity", "l_tax"])
    return R.strip_prefix(long, "variable", "l_").groupBy("variable").agg(F.count("value").alias("n"))


@query("str_contains", """
SELECT p_partkey, contains(p_name, 'red') AS has_red, regexp_matches(p_name, '^(small|large)') AS by_size,
  contains(lower(p_brand), 'brand#1') AS brand_one FROM part""")
def _(spark, sf):
    return read_table(spark, sf, "part").select(
        "p_partkey", S.str_contains(F.col("p_name"), "red", regex=False).alias("has_red"),
        S.str_contains(F.col("p_name"), "^(small|large)").alias("by_size"),
        S.str_contains(F.col("p_brand"), "BRAND#1", regex=False, ignore_case=True).alias("brand_one"))


@query("str_startswith", "SELECT p_partkey, starts_with(p_name, 'blue') AS hit FROM part")
def _(spark, sf):
    return read_table(spark, sf, "part").select("p_partkey", S.str_startswith(F.col("p_name"), "blue").alias("hit"))


@query("str_endswith", "SELECT p_partkey, suffix(p_name, 'ring') AS hit FROM part")
def _(spark, sf):
    return read_table(spark, sf, "part").select("p_partkey", S.str_endswith(F.col("p_name"), "ring").alias("hit"))


@query("str_replace", "SELECT p_partkey, replace(p_brand, 'Brand#', '') AS brand FROM part")
def _(spark, sf):
    return read_table(spark, sf, "part").select(
        "p_partkey", S.str_replace(F.col("p_brand"), "Brand#", "").alias("brand"))


@query("str_lower", "SELECT p_partkey, lower(p_type) AS kind FROM part")
def _(spark, sf):
    return read_table(spark, sf, "part").select("p_partkey", S.str_lower(F.col("p_type")).alias("kind"))


@query("str_title", """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
  lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM part""")
def _(spark, sf):
    return read_table(spark, sf, "part").select("p_partkey", S.str_title(F.col("p_name")).alias("title"))


@query("str_slice", "SELECT doc_id, text[1:25] AS head FROM documents")
def _(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", S.str_slice(F.col("text"), 25).alias("head"))


@query("format_params", """
SELECT l_orderkey, printf('Discount=%.3f Flag=%s', l_discount, l_returnflag) AS label FROM lineitem""")
def _(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", S.format_params("Discount=%.3f Flag=%s", F.col("l_discount"),
                                      F.col("l_returnflag")).alias("label"))


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(day(o_orderdate) AS INTEGER) AS day, CAST(dayofyear(o_orderdate) AS INTEGER) AS dayofyear,
  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dayofweek, isodow(o_orderdate) <= 5 AS isweekday,
  CAST(week(o_orderdate) AS INTEGER) AS week FROM orders""")
def _(spark, sf):
    parts = S.date_parts(F.col("o_orderdate"))
    return read_table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("date_compare", "SELECT o_orderkey, o_orderdate >= DATE '1998-06-01' AS recent FROM orders")
def _(spark, sf):
    return read_table(spark, sf, "orders").select(
        "o_orderkey", S.date_compare(F.col("o_orderdate"), datetime.date(1998, 6, 1)).alias("recent"))


@query("math_abs_sign_exp_log", """
SELECT l_orderkey, abs(x) AS abs, CAST(sign(x) AS DOUBLE) AS sign, exp(x) AS exp,
  CASE WHEN x = 0 THEN '-Infinity' WHEN x > 0 THEN CAST(round(log10(x), 6) AS VARCHAR) END AS log10
FROM (SELECT l_orderkey, l_tax - l_discount AS x FROM lineitem)""", {"abs": 8, "exp": 8})
def _(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_tax") - F.col("l_discount")).alias("x"))
    parts = S.math_abs_sign_exp_log(F.col("x"))
    parts["log10"] = F.when(F.col("x") >= 0, F.when(F.col("x") == 0, F.lit("-Infinity")).otherwise(
        F.round(parts["log10"], 6).cast("string")))
    return li.select("l_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("scale_and_round", """
SELECT scaled, CAST(count(*) AS BIGINT) AS n FROM (SELECT round_even(l_quantity * 0.5, 0) AS scaled FROM lineitem)
GROUP BY 1""")
def _(spark, sf):
    scaled = S.scale_and_round(F.col("l_quantity"), 0.5)
    return read_table(spark, sf, "lineitem").groupBy(scaled.alias("scaled")).agg(F.count(F.lit(1)).alias("n"))


WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


@query("array_filter_len", f"""
SELECT doc_id, array_to_string(list_filter({WORDS}, lambda t: length(t) >= 4 AND
  NOT regexp_full_match(t, '\\p{{N}}+') AND t NOT IN ('with', 'that')), ' ') AS kept FROM documents""")
def _(spark, sf):
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_]+)"))
    return read_table(spark, sf, "documents").select(
        "doc_id", F.array_join(S.array_filter_len(tokens, 4, ["with", "that"]), " ").alias("kept"))


@query("array_extend", """
SELECT doc_id, array_to_string(list_concat(string_split(lang, 'r'), string_split(source, 'e')), '|') AS joined
FROM documents""")
def _(spark, sf):
    a, b = F.split("lang", "r"), F.split("source", "e")
    return read_table(spark, sf, "documents").select("doc_id", F.array_join(S.array_extend(a, b), "|").alias("joined"))


@query("array_size_distinct", f"""
WITH {VIOLATIONS}
SELECT inspection, CAST(count(code) AS INTEGER) AS size, CAST(count(DISTINCT code) AS INTEGER) AS n_distinct
FROM violations GROUP BY 1 HAVING count(code) > 0""")
def _(spark, sf):
    lists = A.collect_non_null(violations(spark, sf), ["inspection"], "code")
    flat = F.flatten(F.transform("values", lambda v: F.array_repeat(v["value"], v["n"].cast("int"))))
    return lists.select("inspection", *[c.alias(n) for n, c in S.array_size_distinct(flat).items()])
