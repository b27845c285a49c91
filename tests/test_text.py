"""Words, phrases, topics against word-by-word Python."""
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.operators import text as X, word_pairs as WP
from quayside.sources.tables import new_path


def docs(spark, lists):
    return spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "doc long, tokens array<string>")


def greedy(tokens, phrases):
    out, i = [], 0
    while i < len(tokens):
        if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in phrases:
            out.append(f"{tokens[i]}_{tokens[i + 1]}")
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out


def test_tokenize(spark):
    df = spark.createDataFrame([("Café_x 12 it's THE 2024 a1b2 ½½½ ab the1",)], "text string")
    assert X.tokenize(df, "text", ["the"]).first().tokens == ["café_x", "a1b2", "the1"]
    short = X.tokenize(df, "text", ["th"], transform=lambda w: F.substring(w, 1, 2)).first().tokens
    assert short == ["ca", "a1"]  # the transform comes before the stop words


@pytest.mark.parametrize("sent", [X.MAX_PHRASES, 0])
def test_phrases_match_word_by_word(spark, monkeypatch, sent):
    monkeypatch.setattr(X, "MAX_PHRASES", sent)  # 0: joined, not sent
    cases = [["a", "b", "a", "b"], ["a", "b", "c"], ["a", "a", "a", "a"], ["x"], [], ["a_b", "c", "a", "b"],
             ["b", "a", "b", "c", "a"], ["a", "b", "b", "c"]]
    pairs = [("a", "b"), ("b", "c"), ("a", "a"), ("c", "a")]
    phrases = spark.createDataFrame(pairs, "a string, b string")
    got = {r.doc: r.tokens for r in X.apply_phrases(docs(spark, cases), "doc", "tokens", phrases).collect()}
    assert got == {i: greedy(t, set(pairs)) for i, t in enumerate(cases)}  # a document without words stays
    same = spark.createDataFrame([(0, ["a", "b"]), (0, ["c", "d"]), (0, None), (None, ["a", None, "b"])],
                                 "doc long, tokens array<string>")
    got = X.apply_phrases(same, "doc", "tokens", phrases).collect()  # rows with one id stay rows
    assert sorted((r.doc is None, r.tokens) for r in got) == [
        (False, []), (False, ["a_b"]), (False, ["c", "d"]), (True, ["a_b"])]


def test_found_phrases_and_score(spark):
    lists = [["new", "york", w] for w in ("p", "q", "r", "s")] + [["york", "new"]]
    got = {(r.a, r.b): (r.n, r.score) for r in X.find_phrases(docs(spark, lists), "tokens", 2, 0.5).collect()}
    words = Counter(w for t in lists for w in t)
    pairs = Counter(p for t in lists for p in zip(t, t[1:]))
    size = len(words) + len(pairs)
    assert got == {("new", "york"): (4, pytest.approx((4 - 2) / 5 / 5 * size))}


def test_three_word_phrases_are_appended(spark):
    lists = [["big", "red", "dog", f"w{i}"] for i in range(30)] + [[f"v{i}", f"u{i}"] for i in range(300)] + [[]]
    got = {r.doc: r.tokens for r in X.add_phrases(docs(spark, lists), "doc", "tokens", 5, 2.0).collect()}
    assert got[0] == ["big", "red", "dog", "w0", "big_red_dog"] and got[40] == ["v10", "u10"] and got[330] == []


def test_vocabulary_counts_documents_and_words(spark):
    lists = [["a", "b", "a"], ["a", "c"], ["b"], ["d"]]
    vocab = X.build_vocabulary(docs(spark, lists), "tokens", no_below=1, no_above=0.5, keep_n=3)
    assert [(r.id, r.term, r.df, r.cf) for r in vocab.orderBy("id").collect()] == [
        (0, "a", 2, 3), (1, "b", 2, 2), (2, "c", 1, 1)]


def test_tfidf_has_unit_length(spark):
    lists = [["a", "b", "a"], ["a", "c"], ["b"], ["zzz"]]
    df = docs(spark, lists)
    vocab = X.build_vocabulary(df, "tokens", 1, 1.0, 3)
    rows = X.tfidf(df, "doc", "tokens", vocab).collect()
    raw = {"a": 2 * math.log2(4 / 2), "b": math.log2(4 / 2)}
    size = math.hypot(*raw.values())
    assert {r.term: r.weight for r in rows if r.doc == 0} == {t: pytest.approx(w / size) for t, w in raw.items()}
    assert {r.doc for r in rows} == {0, 1, 2}
    bow = X.bag_of_words(df, "doc", "tokens", vocab)
    assert {(r.doc, r.term): r.tf for r in bow.collect()}[(0, "a")] == 2
    assert tuple(X.corpus_size(bow, "doc").first()) == (3, 3)


def test_coherence(spark):
    df = docs(spark, [["a", "b"], ["a", "b"], ["a"], ["c"]])
    vocab = X.build_vocabulary(df, "tokens", 1, 1.0, 10)
    ids = {r.term: r.id for r in vocab.collect()}
    topics = spark.createDataFrame([(0, 1, ids["a"]), (0, 2, ids["b"]), (1, 1, ids["a"]), (1, 2, ids["c"])],
                                   "topic int, rank int, id int")
    got = {r.topic: r.coherence for r in X.topic_coherence(
        X.bag_of_words(df, "doc", "tokens", vocab), "doc", topics, 4).collect()}
    assert got == {0: pytest.approx(math.log((2 / 4 + 1e-12) / (3 / 4))), 1: pytest.approx(math.log(1e-12 / (3 / 4)))}


def test_topics(spark):
    lists = [["cat", "dog", "cat", "pet"]] * 20 + [["car", "road", "car", "fuel"]] * 20
    df = docs(spark, lists).withColumns({"grp": F.when(F.col("doc") < 20, "x").otherwise("y"),
                                         "good": (F.col("doc") % 2).cast("int")})
    vocab = X.build_vocabulary(df, "tokens", 1, 1.0, 10)
    vectors = X.tfidf_vectors(df, "tokens", vocab)
    model = X.fit_lda(vectors, topics=2, batches=1, passes=30)
    heads = {r.topic: r.term for r in X.top_terms(model, vocab, 1).collect()}
    assert set(heads.values()) <= {"cat", "car"} and len(set(heads.values())) == 2
    best = {r.grp: r.topic for r in X.topics_by_group(model, vectors, "grp").filter("weight > 0.5").collect()}
    assert set(best) == {"x", "y"} and best["x"] != best["y"]
    by = X.topics_by_sentiment(model, vectors, "grp", "good").groupBy("grp", "good").agg(F.sum("weight").alias("w"))
    assert [r.w for r in by.collect()] == [pytest.approx(1.0)] * 4


def test_rows_without_words_have_empty_vectors(spark):
    df = spark.createDataFrame([(0, ["a", "b", "a"]), (1, None), (2, []), (3, [None, "b"])], "doc long, tokens array<string>")
    vocab = X.build_vocabulary(df, "tokens", no_below=1, no_above=1.0)
    assert sorted(tuple(r) for r in X.bag_of_words(df, "doc", "tokens", vocab).select("doc", "term", "tf").collect()) == [
        (0, "a", 2), (0, "b", 1), (3, "b", 1)]
    assert {r.doc for r in X.tfidf(df, "doc", "tokens", vocab).collect()} == {0, 3}
    assert X.tfidf_vectors(df, "tokens", vocab).count() == 4
    none = X.build_vocabulary(df, "tokens", no_below=9)
    assert none.count() == 0
    assert X.bag_of_words(df, "doc", "tokens", none).count() == X.tfidf(df, "doc", "tokens", none).count() == 0
    assert [r.features.size for r in X.tfidf_vectors(df, "tokens", none).collect()] == [0] * 4


def test_phrases_of_large_batches_take_little_memory():
    """The words of a batch of 10,000 rows are never Python objects, which take some 300 MB."""
    import tracemalloc
    words = pa.array([f"w{i % 5000}" for i in range(4_000_000)], pa.string())
    lists = pa.ListArray.from_arrays(pa.array(range(0, 4_000_001, 400), pa.int32()), words)
    tracemalloc.start()
    try:
        got = X._merged_in_slices(lists, pa.array(["w7", "w8", "w9"]), np.array([1, 5]))
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
    assert len(got) == 10_000 and got[0].as_py()[6:9] == ["w6", "w7_w8", "w9"]


def test_merging_lists_as_word_by_word():
    import random
    rng = random.Random(5)
    for _ in range(60):
        pairs = {(rng.choice("abcd"), rng.choice("abcd")) for _ in range(rng.randrange(6))}
        lists = [[rng.choice(["a", "b", "c", "d", "x", None]) for _ in range(rng.randrange(12))] for _ in range(9)]
        names = pa.array(sorted({w for p in pairs for w in p}), pa.string())
        place = {w: i for i, w in enumerate(names.to_pylist())}
        keys = np.array(sorted(place[a] * len(names) + place[b] for a, b in pairs), np.int64)
        got = X._merged(pa.array([["z"], *lists], pa.list_(pa.string())).slice(1), names, keys).to_pylist()
        assert got == [greedy([w for w in t if w is not None], pairs) for t in lists]


def counted_literally(lists, least):
    words = Counter(w for t in lists for w in t or [] if w is not None)
    pairs = Counter((a, b) for t in lists for a, b in zip(t or [], (t or [])[1:]) if a is not None and b)
    return len(words) + len(pairs), {k: n for k, n in [*(((w, None), n) for w, n in words.items()), *pairs.items()] if n >= least}


@pytest.mark.parametrize("at_once, usual", [(1, []), (7, ["nowhere", "b", "", "w5"]), (1_000_000, ["é", "a", "c"])])
def test_packed_counts_as_counted_literally(spark, monkeypatch, at_once, usual):
    import random
    rng = random.Random(at_once)
    odd = ["", "é", "x" * 400, "a_b", "日本", *"abcde", *(f"w{i}" for i in range(300))]
    lists = [None, [], [None], [""], ["", ""], ["a", None, "b"], ["a", "", "b"], ["a"] * 300] + [
        [rng.choice([*odd, None]) if rng.random() < 0.5 else rng.choice("abc") for _ in range(rng.randrange(30))]
        for _ in range(150)]
    kind = pa.list_(pa.string())
    cut = pa.array([["zz"], *lists], kind).slice(1)
    monkeypatch.setattr(WP, "COUNTED_WORDS", at_once)
    blocks, usual = {}, pa.array(usual, pa.string())
    for words, row in WP._chunks(iter([cut.slice(0, 40), cut.slice(40)])):
        for bucket, *fields in WP._blocks(words, row, 5, usual):
            blocks.setdefault(bucket, []).append(fields)
    rows = [r for b in blocks.values() for r in WP._counted(
        pa.table([pa.array(c, pa.binary()) for c in zip(*b)], names=list(WP.FIELDS)), 3, usual).to_pylist()]
    size, want = counted_literally(lists, 3)
    assert {(r["a"], r["b"]): r["n"] for r in rows if r["a"] is not None} == want
    assert sum(r["n"] for r in rows if r["a"] is None) == size
    if at_once == 7:
        got = WP.count_pairs(docs(spark, lists), "tokens", 3).collect()
        assert {(r.a, r.b): r.n for r in got if r.a is not None} == want and sum(r.n for r in got if r.a is None) == size


def test_blocks_of_counts_are_small():
    """A pair of a corpus of mostly different pairs takes a few bytes, not a row with both its words."""
    rng = np.random.default_rng(3)
    words = [f"{'aeiou'[i % 5]}{i * 2654435761 % 99991:x}ing" for i in range(20_000)]
    text = pa.array([words[i] for i in np.minimum(rng.zipf(1.2, 400_000) - 1, 19_999)])
    usual = WP._usual(pa.ListArray.from_arrays(pa.array([0, 100_000], pa.int32()), text))
    blocks = list(WP._blocks(text, np.arange(400_000) // 400, 32, usual))
    pairs = sum(len(WP._unpacked(b[3])) for b in blocks)
    assert pairs > 100_000 and sum(len(f) for b in blocks for f in b[1:]) < 5 * pairs


def test_phrases_after_phrases_are_those_of_merged_words(spark, monkeypatch):
    lists = [["big", "red", "dog", f"w{i}", None] for i in range(30)] + [[f"v{i}", f"u{i}"] for i in range(300)] + [[], None]
    df = docs(spark, lists)
    first = X.find_phrases(df, "tokens", 5, 2.0)
    want = sorted(X.find_phrases(X.apply_phrases(df, "doc", "tokens", first), "tokens", 5, 2.0).collect())
    assert [(r.a, r.b) for r in want] == [("big_red", "dog")]
    assert sorted(X.find_phrases(df, "tokens", 5, 2.0, after=first).collect()) == want
    monkeypatch.setattr(X, "MAX_PHRASES", 0)
    assert sorted(X.find_phrases(df, "tokens", 5, 2.0, after=first).collect()) == want
    monkeypatch.undo()
    none = X.apply_phrases(df, "doc", "tokens", first.filter("n < 0")).collect()  # without phrases words stay
    assert {r.doc: r.tokens for r in none} == {i: [w for w in t or [] if w is not None] for i, t in enumerate(lists)}


def test_added_phrases_store_the_rows_once(spark, tmp_path):
    """Not their words twice beside them, and again when they are merged."""
    import os
    import random
    rng = random.Random(8)
    lists = [[f"w{rng.randrange(90_000)}" for _ in range(100)] for _ in range(1_000)]
    df = docs(spark, lists).withColumn("other", F.array_join("tokens", "-"))
    df.write.parquet(f"{tmp_path}/rows")
    size = lambda folder: sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names)
    scratch = os.path.dirname(new_path(spark, "x")).removeprefix("file:")
    before = size(scratch)
    got = X.add_phrases(df, "doc", "tokens")
    assert size(scratch) - before < 1.2 * size(f"{tmp_path}/rows")
    assert got.columns == df.columns and {r.doc: r.tokens for r in got.collect()} == dict(enumerate(lists))
