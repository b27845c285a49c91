"""Null, tie, rounding and calendar rules on literal rows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from quayside import sources
from quayside.functions import scalars as S
from quayside.operators import aggregates as A, charts, clean as C, features as X, joins as J, reshape as R
from quayside.operators import sampling as P, windows as N


def rows_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_groups_drop_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", None)], "k string, v int")
    assert rows_of(A.group_agg_named(df, ["k"], n=F.count("v")), "k", "n") == [("a", 1)]
    assert rows_of(A.value_counts(df, "k"), "k", "n") == [("a", 2)]
    assert len(A.value_counts(df, "k", keep_null=True).collect()) == 2


def test_flags_are_never_null(spark):
    df = spark.createDataFrame([("t", "a", dt.date(2020, 1, 1)), (None, "a", dt.date(2020, 1, 1)),
                                ("t", None, dt.date(2020, 1, 1)), ("t", "a", None)], "t string, a string, d date")
    got = C.flag_gradeable(df, "t", ["t"], "a", ["a"], "d", dt.date(2019, 1, 1))
    assert [r.is_gradeable for r in got.collect()] == [True, False, False, False]
    assert [r.x for r in df.select(S.str_contains(F.col("t"), "t").alias("x")).collect()] == [True, False, True, True]
    assert C.filter_not_in(df, "t", ["t"]).count() == 1
    assert [r.x for r in df.select(S.date_compare(F.col("d"), dt.date(2020, 1, 1)).alias("x")).collect()][-1] is False


def test_first_row_and_first_value(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, "A"), ("k", 3, "B"), ("n", 1, None)],
                               "k string, o int, g string")
    assert rows_of(A.first_non_null(df, ["k"], "g", ["o"]), "k", "first_g") == [("k", "A"), ("n", None)]
    assert rows_of(A.first_row_test(df, ["k"], F.col("g") == "A", ["o"]), "k", "first_row_ok") == [
        ("k", False), ("n", False)]
    assert rows_of(A.any_match(df, ["k"], F.col("g") == "A"), "k", "any_match") == [("k", True), ("n", False)]


def test_calendar_parts(spark):
    days = [dt.date(2021, 1, 3), dt.date(2021, 1, 4), dt.date(2021, 1, 1), dt.date(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(*[c.alias(n) for n, c in S.date_parts(F.col("d")).items()]).collect()
    assert [(r.dayofweek, r.week, r.isweekday) for r in got] == [(6, 53, False), (0, 1, True), (4, 53, True),
                                                                (3, 53, True)]


def test_rounding_and_log(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r.y for r in df.select(S.scale_and_round(F.col("x"), 1.0).alias("y")).collect()] == [0.0, 2.0, 2.0, 0.0]
    logs = spark.createDataFrame([(0.0,), (100.0,)], "x double").select(
        S.math_abs_sign_exp_log(F.col("x"))["log10"].alias("y")).collect()
    assert [r.y for r in logs] == [float("-inf"), 2.0]


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("1",), ("?",), (None,)], "x string")
    assert [r.x for r in C.cast_columns(df, ["x"], "int").collect()] == [1, None, None]
    times = spark.createDataFrame([("2015-03-01 10:60:05",), ("2015-03-01 10:10:60",), ("2015-03-01 10:10:10",),
                                   ("no",)], "s string")
    parsed, bad = sources.parse_ts_permissive(times, "s", S.DATE_TEXT)
    assert bad.first().n_bad == 3 and bad.first().bad_share == 0.75
    fixed = times.select(S.fix_sixty(F.col("s")).cast("string").alias("t")).collect()
    assert [r.t for r in fixed] == ["2015-03-01 10:59:05", "2015-03-01 10:10:59", "2015-03-01 10:10:10", None]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert C.nan_to_null(df).filter("x IS NULL").count() == 2
    row = A.describe_numeric(df, ["x"]).first()
    assert (row["count"], row.mean, row.p50) == (1, 1.0, 1.0)


def test_describe_approx(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    row = A.describe_numeric(df, ["x"], approx=True).first()
    assert (row.p25, row.p50, row.p75) == (250.0, 500.0, 750.0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 3.0), (10.0, 3.0), (5.0, 3.0), (None, 3.0)], "x double, same double")
    got = charts.histogram(df, ["x", "same"], 4)
    assert rows_of(got.filter("variable = 'x'"), "bin", "n") == [(1, 1), (3, 1), (4, 1)]
    assert rows_of(got.filter("variable = 'same'"), "bin", "lo", "hi", "n") == [(3, 3.0, 3.25, 4)]


def test_visits(spark):
    d = dt.date
    df = spark.createDataFrame([(1, d(2020, 1, 1)), (2, d(2020, 1, 1)), (2, d(2020, 1, 1)), (2, d(2020, 1, 8)),
                                (2, d(2020, 1, 11)), (3, None)], "k int, d date")
    assert rows_of(A.visit_frequency(df, "k", "d"), "k", "n_rows", "n_visits", "mean_days_between")[:2] == [
        (1, 1, 1, None), (2, 4, 3, 5)]


def test_pivot_leaves_absent_kind_null(spark):
    df = spark.createDataFrame([("p", "a"), ("p", "a"), ("q", "b")], "k string, kind string")
    assert rows_of(R.pivot_counts(df, ["k"], "kind", ["a", "b"]).filter("k = 'p'"), "a", "b") == [(2, None)]
    assert rows_of(R.pivot_counts(df, ["k"], "kind", ["a", "b"], fill_zero=True).filter("k = 'p'"), "a", "b") == [(2, 0)]


def test_collect_non_null_in_pieces(spark):
    df = spark.createDataFrame([("k", str(i % 40)) for i in range(100)] + [("k", None), ("one", "z")],
                               "k string, v string")
    whole = A.collect_non_null(df, ["k"], "v").collect()
    assert [len(r["values"]) for r in whole if r.k == "k"] == [40]
    parts = A.collect_non_null(df, ["k"], "v", piece=7).collect()
    back = sorted(v.value for r in parts if r.k == "k" for v in r["values"] for _ in range(v.n))
    assert back == sorted(str(i % 40) for i in range(100))
    assert len([r for r in parts if r.k == "k"]) > 1


def test_rollup_of_one_inspection(spark):
    rows = [("i", 1, None, "N", "02A"), ("i", 2, "A", "Y", "02A"), ("i", 3, "B", "N", None), ("j", 1, "A", "N", None)]
    df = spark.createDataFrame(rows, "k string, o int, grade string, flag string, code string")
    got = {r.k: r for r in A.inspection_rollup(df, ["k"], "grade", "flag", "code", ["o"]).collect()}
    assert (got["i"].passed, got["i"].grade, got["i"].has_critical_flag, got["i"].n_violations) == (False, "A", True, 1)
    assert [(v.code, v.n) for v in got["i"].violation_codes] == [("02A", 2)]
    assert (got["j"].passed, got["j"].n_violations, got["j"].violation_codes) == (True, 0, [])


def test_interval_join_bounds(spark):
    ts = "cast(s as timestamp_ntz)"
    events = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:01"), (3, "2024-01-02 00:00:00"),
                                    (4, "2024-01-02 00:00:01")], "id int, s string").selectExpr("id", f"{ts} ts")
    periods = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS a, TIMESTAMP_NTZ'2024-01-02 00:00:00' AS b")
    assert rows_of(J.interval_join(events, periods, "ts", "a", "b"), "id") == [(2,), (3,)]
    days = periods.selectExpr("cast(a as date) period_start", "cast(b as date) period_end")
    wide = A.weekly_active(events.selectExpr("id", "ts", "'x' AS kind"), days, "ts", "id", "kind", ["x", "y"])
    assert rows_of(wide, "engaged_users", "event_count", "x", "y") == [(2, 2, 2, None)]
    times = periods.selectExpr("a period_start", "b period_end")
    same = A.weekly_active(events.selectExpr("id", "ts", "'x' AS kind"), times, "ts", "id", "kind", ["x", "y"])
    assert rows_of(same, "engaged_users", "event_count", "x", "y") == [(2, 2, 2, None)]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0)], "a double, b double, c double")
    got = {(r.var1, r.var2): r.r for r in A.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "c")] is None


def test_scaling_with_kept_parameters(spark):
    old = spark.createDataFrame([(0.0, 1.0), (10.0, 1.0)], "x double, same double")
    scaled, params = X.min_max_scale(old, ["x", "same"])
    assert rows_of(scaled, "x", "same") == [(0.0, 0.0), (1.0, 0.0)]
    new = spark.createDataFrame([(20.0, 1.0)], "x double, same double")
    assert rows_of(X.min_max_scale(new, ["x", "same"], params)[0], "x") == [(2.0,)]


def test_union_needs_equal_columns(spark):
    a, b = spark.range(1), spark.range(1).selectExpr("cast(id as int) id")
    with pytest.raises(ValueError):
        P.union_all(a, b)


def test_small_results(spark):
    df = spark.createDataFrame([(3, "x"), (1, "y"), (2, None)], "a int, b string")
    assert [r.a for r in P.head_n(df, 2, ["a"]).collect()] == [1, 2]
    assert [r.a for r in P.tail_n(df, 2, ["a"]).collect()] == [2, 3]
    assert [r.b for r in P.sort_by(df, ["b"], False).collect()] == ["y", "x", None]
    assert C.select_columns(df, exclude=("a",)).columns == ["b"]
    assert C.select_by_type(df, "text", invert=True).columns == ["a"]
    assert R.melt(df, []).dtypes[1] == ("value", "string")
    assert C.null_codes(df, ["x"]).filter("b IS NULL").count() == 2
    assert C.recode(df, "b", {"x": "z"}, default="other").filter("b = 'other'").count() == 2
    assert [r["rank"] for r in N.rank_results(df, "a").collect()] == [1, 2, 3]
    assert df.select(S.format_params("C=%d %s", F.col("a"), F.col("b")).alias("s")).first().s == "C=3 x"
    assert A.nunique_per_column(df, ["a", "b"], approx=True).count() == 2


def test_series_windows_need_a_date(spark):
    df = spark.sql("SELECT 'a' AS series, TIMESTAMP'2020-01-01' AS ds, 1.0 AS y")
    with pytest.raises(TypeError):
        N.centered_moving_average(df, ["series"], "ds", "y", 3)


def test_delimited_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Index,name,when,x\n1,"b, c",2020-01-02 03:04:05,1.5\n2,"say ""hi""",bad,?\n')
    schema = T.StructType([T.StructField("Index", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("when", T.TimestampType()), T.StructField("x", T.DoubleType())])
    rows = sources.read_delimited(spark, str(tmp_path / "a.csv"), schema, ts_cols=("when",)).orderBy("Index").collect()
    assert (rows[0].name, rows[0].x, rows[0].when) == ("b, c", 1.5, dt.datetime(2020, 1, 2, 3, 4, 5))
    assert (rows[1].name, rows[1].x, rows[1].when) == ('say "hi"', None, None)
    (tmp_path / "b.tsv").write_text("Index\tname\twhen\tx\n1\tq\t\t2\n")
    assert sources.read_delimited(spark, str(tmp_path / "b.tsv"), schema, "\t").first().x == 2.0
    (tmp_path / "c.csv").write_text(",y\n2020-01-01,3\n")
    blank = spark.read.option("header", True).csv(str(tmp_path / "c.csv"))
    assert sources.name_blank_header(blank, "Date").columns == ["Date", "y"]


def test_spread_leaves_large_tables_alone(spark):
    many = spark.range(0, 100, 1, 50)
    assert sources.spread(many) is many
    assert sources.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() > 1


def test_split_back_loses_no_row(spark):
    from quayside.operators import sampling as P
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, kind string")
    parts = P.split_back(df, "kind", ["a"])
    assert [tuple(r) for r in parts["a"].collect()] == [(1,)]
    assert sorted(tuple(r) for r in parts[None].collect()) == [(2, None), (3, "z")]
