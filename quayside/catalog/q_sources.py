"""Sources and cleaning of raw text times."""

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F, types as T

from quayside.catalog.fixtures import SPOILED_ORDERS, spoiled_orders
from quayside.catalog.registry import query
from quayside.functions import scalars as S
from quayside.operators.models import fit_linear, linear_table
from quayside.sources import (
    fit_or_load, name_blank_header, new_path, parse_ts_permissive, read_delimited, read_table, to_features,
)


@query("read_table", "SELECT * FROM nation")
def _(spark, sf):
    return read_table(spark, sf, "nation")


@query("read_delimited", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate,
  TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority FROM orders""")
def _(spark, sf):
    path = new_path(spark, "orders")
    read_table(spark, sf, "orders").write.option("header", True).option("sep", "\t").csv(path)
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, " \
             "o_orderpriority int"
    orders = read_delimited(spark, path, T.StructType.fromDDL(schema), "\t", ("o_orderdate",))
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("read_delimited_reordered", "SELECT n_nationkey, n_name, CAST(NULL AS VARCHAR) AS n_flag FROM nation")
def _(spark, sf):
    path = new_path(spark, "nation")
    read_table(spark, sf, "nation").select("n_name", "n_regionkey", "n_nationkey").write.option("header", True).csv(path)
    schema = T.StructType.fromDDL("n_nationkey int, n_name string, n_flag string")
    return read_delimited(spark, path, schema)


@query("name_blank_header", "SELECT CAST(n_nationkey AS VARCHAR) AS Date, n_name FROM nation")
def _(spark, sf):
    path = new_path(spark, "nation")
    lines = F.concat_ws(",", "n_nationkey", "n_name")
    read_table(spark, sf, "nation").select(lines.alias(",n_name")).write.option("header", True).option(
        "sep", "\x01").csv(path)  # a separator that does not occur, so the line stays as it is
    return name_blank_header(spark.read.option("header", True).csv(path), "Date")


@query("fit_or_load", """
SELECT 'intercept' AS term, regr_intercept(l_extendedprice, l_quantity) AS value FROM lineitem
UNION ALL SELECT 'l_quantity', regr_slope(l_extendedprice, l_quantity) FROM lineitem""", {"value": 3})
def _(spark, sf):
    path, lines = new_path(spark, "model"), read_table(spark, sf, "lineitem")
    for _turn in range(2):  # fitted and saved the first time, loaded the second
        model = fit_or_load(spark, path, lambda: fit_linear(lines, ["l_quantity"], "l_extendedprice"),
                            LinearRegressionModel.load)
    return linear_table(model, ["l_quantity"])


@query("parse_ts_permissive", f"""
WITH {SPOILED_ORDERS}
SELECT CAST(count(*) FILTER (WHERE t IS NULL) AS BIGINT) AS n_bad,
       avg(CASE WHEN t IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS bad_share
FROM (SELECT CASE WHEN ts_text LIKE '%:60%' THEN NULL ELSE ts_text END AS t FROM spoiled)
""", {"bad_share": 8})
def _(spark, sf):
    _, bad = parse_ts_permissive(spoiled_orders(spark, sf), "ts_text", S.DATE_TEXT)
    return bad


@query("fix_sixty", f"""
WITH {SPOILED_ORDERS}
SELECT o_orderkey, CAST(replace(replace(ts_text, ':60:', ':59:') || '|', ':60|', ':59|')[:19] AS TIMESTAMP) AS ts
FROM spoiled
""")
def _(spark, sf):
    return spoiled_orders(spark, sf).select(
        "o_orderkey", S.fix_sixty(F.col("ts_text")).cast("timestamp_ntz").alias("ts"))


@query("to_features", "SELECT l_orderkey, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2 FROM lineitem")
def _(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    return to_features(read_table(spark, sf, "lineitem"), cols).select(
        "l_orderkey", *[vector_to_array("features")[i].alias(f"f{i}") for i in range(3)])
