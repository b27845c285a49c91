"""Ordered blocks against pandas, with a key, a time or a value that holds a third of the rows."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quayside.operators import aggregates, features, sampling, windows
from quayside.plans import blocks as B
from quayside.plans.levels import category_levels, fetch_small
from quayside.plans import quantiles
from quayside.plans.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows have key 'hot'; a third, others, share one time; some keys and values are missing."""
    rng = np.random.default_rng(5)
    n = 900
    key = np.where(np.arange(n) % 3 == 0, "hot", rng.choice(list("abcde"), n)).astype(object)
    key[7] = None
    t = np.where(np.arange(n) % 3 == 1, 500, rng.integers(0, 1000, n))
    v = rng.integers(-50, 50, n).astype(object)
    v[rng.random(n) < 0.3] = None
    return pd.DataFrame({"id": np.arange(n), "key": key, "t": t, "v": v, "w": rng.integers(0, 9, n)})


@pytest.fixture(scope="module")
def frame(spark, skewed):
    return spark.createDataFrame(list(skewed.itertuples(index=False, name=None)),
                                 "id long, key string, t long, v long, w long")


def without_key(skewed, keys):
    """Rows without a key stay, and what is computed is null."""
    return {(i, None) for i in skewed[skewed["key"].isna()]["id"]} if keys else set()


@pytest.mark.parametrize("blocks", [1, 2, 7, None])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_running_total(frame, skewed, keys, blocks):
    got = B.running_total(frame, keys, ["t", "id"], {"s": F.col("w")}, blocks)
    want = skewed.dropna(subset=keys).sort_values(["t", "id"])
    want = want.assign(s=want.groupby(keys)["w"].cumsum() if keys else want["w"].cumsum())
    assert {(r.id, r.s) for r in got.collect()} == set(zip(want["id"], want["s"])) | without_key(skewed, keys)


@pytest.mark.parametrize("blocks", [1, 2, 7])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_previous_value(frame, skewed, keys, blocks):
    got = B.previous_value(frame, keys, ["t", "id"], "w", "p", blocks)
    want = skewed.dropna(subset=keys).sort_values(["t", "id"])
    p = want.groupby(keys)["w"].shift() if keys else want["w"].shift()
    want = {(i, None if np.isnan(x) else int(x)) for i, x in zip(want["id"], p)}
    assert {(r.id, r.p) for r in got.collect()} == want | without_key(skewed, keys)


@pytest.mark.parametrize("blocks", [1, 2, 7])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_last_known(frame, skewed, keys, blocks):
    got = B.last_known(frame, keys, ["t", "id"], ["v"], blocks)
    want = skewed.dropna(subset=keys).sort_values(["t", "id"])
    v = want["v"].astype(float)
    filled = v.groupby(want["key"]).ffill() if keys else v.ffill()
    want = {(i, None if np.isnan(x) else int(x)) for i, x in zip(want["id"], filled)}
    want |= {(r.id, r.v) for r in frame.filter("key IS NULL").collect()} if keys else set()
    assert {(r.id, r.v) for r in got.collect()} == want


def test_blocks_follow_order_and_stay_small(frame, skewed):
    rows = B.ordered_blocks(frame, ["t", "id"], 6).orderBy("t", "id").collect()
    numbers = [r["_block"] for r in rows]
    assert numbers == sorted(numbers)
    assert max(numbers.count(b) for b in set(numbers)) < len(rows) / 3  # the hot time alone is a third


@pytest.mark.parametrize("bins", [2, 16, quantiles.BINS])
@pytest.mark.parametrize("keys", [[], ["key"]])
def test_exact_quantiles(frame, skewed, keys, bins, monkeypatch):
    monkeypatch.setattr(quantiles, "BINS", bins)
    got = exact_quantiles(frame, keys, "v", {"a": 0.25, "b": 0.5, "c": 0.9, "lo": 0.0, "hi": 1.0})
    rows = skewed.dropna(subset=[*keys, "v"]).assign(v=lambda d: d["v"].astype(float))
    for r in got.collect():
        mine = rows if not keys else rows[rows["key"] == r.key]
        want = mine["v"].quantile([0.25, 0.5, 0.9, 0.0, 1.0]).tolist()
        assert [r.a, r.b, r.c, r.lo, r.hi] == pytest.approx(want)


@pytest.mark.parametrize("bins", [8, quantiles.BINS])
def test_exact_quantiles_of_odd_values(spark, bins, monkeypatch):
    """Heavy tails, tiny numbers of both signs, infinities, a hot value, one row, no row."""
    monkeypatch.setattr(quantiles, "BINS", bins)
    rng = np.random.default_rng(3)
    spread = np.exp(rng.normal(0, 40, 400)) * rng.choice([-1.0, 1.0], 400)
    parts = {"tails": spread, "tiny": spread * 1e-290, "hot": np.where(np.arange(300) % 3 == 0, 7.0, rng.random(300)),
             "ends": np.array([-np.inf, 1.0, 2.0, 1e308, -1e308, np.inf, np.inf]), "one": np.array([3.5])}
    rows = [(k, float(x)) for k, values in parts.items() for x in values] + [("none", float("nan")), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    shares = {"a": 0.0, "b": 1 / 3, "c": 0.5, "d": 0.75, "e": 1.0}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "x", shares, also={"n": F.count("x"), "top": F.max("x")}).collect()}
    assert set(got) == set(parts)
    for k, values in parts.items():
        ordered, last = np.sort(values), len(values) - 1
        assert (got[k].n, got[k].top) == (len(values), ordered[-1])
        for name, share in shares.items():
            lo, hi = ordered[math.floor(last * share)], ordered[math.ceil(last * share)]
            want = lo + (hi - lo) * (last * share % 1)
            assert got[k][name] == pytest.approx(want, rel=1e-12, abs=0, nan_ok=True), (k, name)
    empty = exact_quantiles(df.filter("k = 'none'"), [], "x", {"a": 0.5}).collect()
    assert [tuple(r) for r in empty] == [(None,)]
    assert exact_quantiles(df.filter("k = 'none'"), ["k"], "x", {"a": 0.5}).collect() == []


@pytest.mark.parametrize("blocks", [1, 5])
def test_rolling_count_is_open_on_the_left(spark, blocks):
    rows = [(1, "2024-01-01 00:00:00"), (2, "2024-01-08 00:00:00"), (3, "2024-01-07 23:59:59.999999"),
            (4, "2024-01-08 00:00:00")]
    df = spark.createDataFrame(rows, "id int, s string").select("id", F.col("s").cast("timestamp_ntz").alias("ts"))
    got = {r.id: r.rolling_n for r in windows.rolling_count(df, "ts", blocks=blocks).collect()}
    assert got == {1: 1, 3: 2, 2: 3, 4: 3}  # rows of one time see each other; the first is 7 days back and out


@pytest.mark.parametrize("blocks", [1, 4])
def test_rolling_count_per_key(frame, skewed, blocks):
    start = pd.Timestamp("2024-01-01")
    df = frame.withColumn("ts", (F.lit(start.to_pydatetime()) + F.make_dt_interval(F.col("t").cast("int"))
                                 ).cast("timestamp_ntz"))
    got = {r.id: r.rolling_n for r in windows.rolling_count(df, "ts", "7 days", ("key",), blocks=blocks).collect()}
    rows = skewed.dropna(subset=["key"])
    want = {i: int(((rows["key"] == k) & (rows["t"] > t - 7) & (rows["t"] <= t)).sum())
            for i, k, t in zip(rows["id"], rows["key"], rows["t"])}
    assert got == want | dict(without_key(skewed, ["key"]))


@pytest.mark.parametrize("blocks", [1, 5])
def test_head_fraction_and_diff(frame, skewed, blocks):
    got = {r.id for r in sampling.head_fraction(frame, "t", 0.1, ["id"], blocks).collect()}
    assert got == set(skewed.sort_values(["t", "id"]).head(90)["id"])
    gaps = windows.diff_previous(frame, "t", ["t", "id"], blocks=blocks)
    assert gaps.agg(F.sum("diff")).first()[0] == skewed["t"].max() - skewed["t"].min()


def test_order_column_types(spark):
    df = spark.sql("SELECT 'x' AS s, DATE'1970-01-03' AS d, TIMESTAMP_NTZ'1970-01-01 00:00:01.5' AS n, 2.5 AS x")
    got = df.select(*[B.as_position(df, c).alias(c) for c in ("d", "n", "x")]).first()
    assert (got.d, got.n, got.x) == (2.0, 1_500_000.0, 2.5)
    with pytest.raises(TypeError):
        B.as_position(df.withColumn("a", F.array(F.lit(1))), "a")


@pytest.mark.parametrize("blocks", [1, 3, None])
def test_text_and_nan_in_the_order(spark, blocks):
    words = ["", "a", "same prefix 1", "same prefix 2", "b", "é", None]
    df = spark.createDataFrame([(i, w, float("nan") if i == 3 else float(-i)) for i, w in enumerate(words)],
                               "id int, w string, x double")
    got = {r.id: r.r for r in B.row_rank(df, [], ["w"], "r", blocks).collect()}
    assert got == {0: 1, 1: 2, 4: 3, 2: 4, 3: 5, 5: 6, 6: None}
    got = {r.id: r.r for r in B.row_rank(df, [], ["x"], "r", blocks).collect()}
    assert got[3] == 7 and got[6] == 1


def test_splits_and_folds_lose_no_row(spark):
    df = spark.range(60).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 2).alias("label"))
    train, test = features.split_random(df, "id", 0.25, label="label")
    assert sorted(r.id for r in train.unionByName(test).collect()) == list(range(60))
    folds = features.fold_assign(df, "id", 5, "label").collect()
    assert len(folds) == 60 and all(sum(r.label is None and r.fold == f for r in folds) == 3 for f in range(5))
    weights = features.class_weights(df, "label").collect()
    assert len(weights) == 60 and all((r.weight is None) == (r.label is None) for r in weights)


def test_periods_of_short_spans(spark):
    events = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00' AS ts, 1 AS u, 'x' AS k UNION ALL "
                       "SELECT TIMESTAMP_NTZ'2024-01-03 10:00:00', NULL, 'x'")
    assert aggregates.daily_windows(events, "ts").collect() == []
    empty = spark.sql("SELECT DATE'2024-01-02' AS period_start, DATE'2024-01-02' AS period_end")
    assert aggregates.weekly_active(events, empty, "ts", "u", "k", ["x"]).collect() == []
    mean = aggregates.per_user_mean(events.withColumn("p", F.lit(1)), ["p"], "u", F.lit(True)).first()
    assert mean.mean_per_user == 1.0


def test_missing_values_include_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert aggregates.missing_per_column(df).first().n_missing == 2
    assert aggregates.variance_per_column(df, ["x"]).first().variance == 2.0
    assert aggregates.rows_with_missing(df).count() == 2


def test_bounded_tables(frame):
    with pytest.raises(ValueError):
        category_levels(frame, "id", 10)
    with pytest.raises(ValueError):
        fetch_small(frame, 10)


def test_number_of_blocks(spark, frame):
    assert B.blocks_for(frame) == 8  # the shuffle width of the session


def test_empty_table(frame):
    none = frame.filter("id < 0")
    for blocks in (None, 1, 3):
        assert B.row_rank(none, ["key"], ["t", "id"], "r", blocks).count() == 0
        assert exact_quantiles(none, ["key"], "v", {"a": 0.5}, blocks).count() == 0
