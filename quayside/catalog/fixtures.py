"""Inputs derived from the test tables, in Spark and in SQL.

No test column has a null, so "spoiled" tables put missing codes and bad clock texts in by expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quayside.operators.features import z_score
from quayside.sources import read_table, spread, stored


def spoiled_customer(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    text = (F.when(k % 7 == 0, "?").when(k % 11 == 0, "No idea").when(k % 13 == 0, "#")
            .otherwise(F.floor("c_acctbal").cast("string")))
    return read_table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", text.alias("balance_text"),
        F.when(k % 5 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(k % 9 != 0, F.col("c_acctbal")).alias("balance"))


SPOILED_CUSTOMER = """
spoiled AS (
  SELECT c_custkey, c_nationkey,
    CASE WHEN c_custkey % 7 = 0 THEN '?' WHEN c_custkey % 11 = 0 THEN 'No idea'
         WHEN c_custkey % 13 = 0 THEN '#' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR)
    END AS balance_text,
    CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment,
    CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS balance
  FROM customer)
"""


def spoiled_orders(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    clock = F.concat_ws(
        ":", F.lpad((k % 24).cast("string"), 2, "0"),
        F.when(k % 17 == 0, "60").otherwise(F.lpad((k % 59).cast("string"), 2, "0")),
        F.when(k % 19 == 0, "60").otherwise(F.lpad((k % 58).cast("string"), 2, "0")))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return read_table(spark, folder, "orders").select(
        "o_orderkey", F.concat_ws(" ", day, clock).alias("ts_text"))


SPOILED_ORDERS = """
spoiled AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' '
    || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':'
    || CASE WHEN o_orderkey % 17 = 0 THEN '60' ELSE lpad(CAST(o_orderkey % 59 AS VARCHAR), 2, '0') END || ':'
    || CASE WHEN o_orderkey % 19 = 0 THEN '60' ELSE lpad(CAST(o_orderkey % 58 AS VARCHAR), 2, '0') END
    AS ts_text
  FROM orders)
"""


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a price test: two prices by priority, converted when the status is F."""
    return read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").alias("ts"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 59).otherwise(39).alias("price"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("test"),
        (F.col("o_orderstatus") == "F").cast("int").alias("converted"))


VISITS = """
visits AS (
  SELECT o_orderkey, o_custkey, o_orderdate AS ts,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 59 ELSE 39 END AS price,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS test,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS converted
  FROM orders)
"""


def violations(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as violation rows: order = inspection, return flag = code (missing for tax 0)."""
    return spread(read_table(spark, folder, "lineitem")).select(
        F.col("l_orderkey").alias("inspection"),
        F.when(F.col("l_tax") > 0, F.col("l_returnflag")).alias("code"),
        F.when(F.col("l_discount") > 0.02, F.when(F.col("l_quantity") < 25, "A").otherwise("B")).alias("grade"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("flag"),
        F.when(F.col("l_quantity") > 45, "closed").otherwise("open").alias("action"),
        "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")


VIOLATION_ORDER = ["l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"]

VIOLATIONS = """
violations AS (
  SELECT l_orderkey AS inspection,
    CASE WHEN l_tax > 0 THEN l_returnflag END AS code,
    CASE WHEN l_discount > 0.02 THEN CASE WHEN l_quantity < 25 THEN 'A' ELSE 'B' END END AS grade,
    CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS flag,
    CASE WHEN l_quantity > 45 THEN 'closed' ELSE 'open' END AS action,
    l_linenumber, l_partkey, l_extendedprice, l_shipdate
  FROM lineitem)
"""


def price_series(spark: SparkSession, folder: str) -> DataFrame:
    """Mean log unit price per return flag and ship day: one row per (series, ds).

    Logs, because means of plain prices often end in an exact 5 at the last digit that is compared.
    """
    return (read_table(spark, folder, "lineitem")
            .groupBy(F.col("l_returnflag").alias("series"), F.to_date("l_shipdate").alias("ds"))
            .agg(F.avg(F.log(F.col("l_extendedprice") / F.col("l_quantity"))).alias("y")))


SERIES = """
series AS (
  SELECT l_returnflag AS series, CAST(l_shipdate AS DATE) AS ds, avg(ln(l_extendedprice / l_quantity)) AS y
  FROM lineitem GROUP BY 1, 2)
"""


def holed_series(spark: SparkSession, folder: str) -> DataFrame:
    """The series with the price missing on every day of the month divisible by 4."""
    return price_series(spark, folder).withColumn("y", F.when(F.dayofmonth("ds") % 4 != 0, F.col("y")))


HOLED = SERIES.rstrip() + """,
holed AS (SELECT series, ds, CASE WHEN day(ds) % 4 <> 0 THEN y END AS y FROM series)
"""

def t_tail_sql(t: str, dof: str) -> str:
    """Two-sided t probability by the midpoint rule: with t = sqrt(dof) tan(a) the density is cos(a)^(dof-1)."""
    steps = "(SELECT (i + 0.5) / 20000 AS u FROM range(20000) r(i))"
    part = f"(SELECT sum(cos(atan({t} / sqrt({dof})) * u) ** ({dof} - 1)) * atan({t} / sqrt({dof})) FROM {steps})"
    whole = f"(SELECT sum(cos(pi() / 2 * u) ** ({dof} - 1)) * pi() / 2 FROM {steps})"
    return f"1 - {part} / {whole}"


def normal_tail_sql(z: str) -> str:
    """Two-sided normal probability by the midpoint rule."""
    steps = "(SELECT (i + 0.5) / 20000 AS u FROM range(20000) r(i))"
    return f"1 - (SELECT sum(exp(-(({z} * u) ** 2) / 2)) * {z} / 20000 * sqrt(2 / pi()) FROM {steps})"


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

WINDOWS_SQL = """
span AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events),
periods AS (
  SELECT CAST(e - INTERVAL 7 DAY AS DATE) AS period_start, CAST(e AS DATE) AS period_end
  FROM (SELECT unnest(generate_series(lo + INTERVAL 7 DAY, hi::TIMESTAMP, INTERVAL 1 DAY)) AS e FROM span))
"""


FEATURES = ["n_chars", "n_words", "word_length", "digit_share", "upper_share", "space_share"]


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with a few numbers about their text."""
    def share(pattern):
        return F.try_divide(F.regexp_count("text", F.lit(pattern)), F.char_length("text"))
    docs = spread(read_table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars", "text")).select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
        F.coalesce(share("[0-9]"), F.lit(0.0)).alias("digit_share"),
        F.coalesce(share(r"\p{Lu}"), F.lit(0.0)).alias("upper_share"),
        F.coalesce(share(r"\s"), F.lit(0.0)).alias("space_share"))
    docs = docs.withColumn("word_length", F.col("n_chars") / F.col("n_words"))
    return read_table(spark, folder, "labels").join(docs, "doc_id")


def labelled_once(spark: SparkSession, folder: str) -> DataFrame:
    """The same, computed once: the texts are read for the features and not again."""
    return stored(labelled(spark, folder), "labelled")


def scaled_labelled(spark: SparkSession, folder: str) -> DataFrame:
    return z_score(labelled_once(spark, folder), FEATURES).fillna(0.0, subset=FEATURES)


def judged(spark: SparkSession, folder: str) -> DataFrame:
    """Labels with a rule-based score (with ties) and a prediction from it."""
    docs = read_table(spark, folder, "documents").select("doc_id", "n_chars")
    score = F.least(F.floor(F.col("n_chars") / 50) / 100, F.lit(1.0))
    return (read_table(spark, folder, "labels").join(docs, "doc_id")
            .select("doc_id", "quality", score.alias("score"))
            .withColumn("prediction", (F.col("score") >= 0.2).cast("int")))


JUDGED = """
scored AS (SELECT doc_id, quality, least(floor(n_chars / 50) / 100, 1.0) AS score
           FROM labels JOIN documents USING (doc_id)),
judged AS (SELECT *, CASE WHEN score >= 0.2 THEN 1 ELSE 0 END AS prediction FROM scored)
"""

# Common words of the four languages of the test documents, enough to have something to take out.
STOP_WORDS = ["the", "and", "for", "with", "that", "this", "from", "was", "are", "not", "you", "les", "des", "une",
              "est", "que", "der", "die", "das", "und", "ist", "los", "las", "una", "por", "para", "del"]

TOKENS = r"""
toks AS (SELECT doc_id, lang, source, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'),
  lambda t: length(t) >= 3 AND NOT regexp_full_match(t, '\p{N}+') AND NOT list_contains([""" + ", ".join(
    f"'{w}'" for w in STOP_WORDS) + r"""], t)) AS tokens FROM documents)
"""

VOCAB = TOKENS.rstrip() + """,
dfs AS (SELECT term, count(*) AS df, sum(n) AS cf FROM (
  SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS term FROM toks) GROUP BY 1, 2) GROUP BY 1),
kept AS (SELECT * FROM dfs WHERE df >= 30 AND df <= 0.5 * (SELECT count(*) FROM toks)
         ORDER BY df DESC, term LIMIT 20000),
vocab AS (SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS id, term, CAST(df AS BIGINT) AS df,
          CAST(cf AS BIGINT) AS cf FROM kept),
bow AS (SELECT doc_id, id, term, CAST(count(*) AS BIGINT) AS tf
        FROM (SELECT doc_id, unnest(tokens) AS term FROM toks) JOIN vocab USING (term) GROUP BY 1, 2, 3)
"""
