"""Katz backoff, the n-gram join and the pipeline, against brute force."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import QUERIES, graph, katz, ngram_join
from tests.llm.helpers import SCHEMA, documents, odd_documents, prose, table, with_clashing_columns

# ---- Katz


class Katz:
    """The model by hand, over dictionaries."""

    def __init__(self, texts):
        self.c, self.pairs, self.context = Counter(), Counter(), Counter()
        for t in texts:
            w = self.tokens(t)
            self.c.update(w)
            self.pairs.update(zip([b"<s>", *w[:-1]], w))
            self.context.update([b"<s>", *w[:-1]])
        self.n, self.v = sum(self.c.values()), len(self.c)
        one, two = katz.discounts(Counter(self.c.values())), katz.discounts(Counter(self.pairs.values()))
        self.p = {w: one[min(c, 6)] * c / self.n for w, c in self.c.items()}
        self.unknown = 1 - sum(self.p.values())
        self.kept = {k: two[min(c, 6)] * c for k, c in self.pairs.items()}
        left, seen = Counter(), defaultdict(float)
        for (h, w), x in self.kept.items():
            left[h] += x
            seen[h] += self.p[w]
        self.alpha = {h: (n - left[h]) / n / (1 - seen[h]) for h, n in self.context.items()}

    @staticmethod
    def tokens(text):
        return [*(text or "").encode().lower().split(), b"\n"]

    def prob(self, h, w):
        if (h, w) in self.kept:
            return self.kept[h, w] / self.context[h]
        return self.alpha.get(h, 1.0) * self.p.get(w, self.unknown)

    def row(self, text):
        w = self.tokens(text)
        base = sum(math.log10((self.c[x] + 0.5) / (self.n + 0.5 * (self.v + 1))) for x in w)
        return (len(w), sum(self.c[x] > 0 for x in w), self.n, base,
                sum(math.log10(self.prob(h, x)) for h, x in zip([b"<s>", *w[:-1]], w)))


def check_katz(rows, texts, held):
    model = Katz([texts[i] for i in texts if not held[i]])
    assert len(rows) == len(texts)
    for r in rows:
        want = model.row(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], *want[:3])
        assert (r.base_score, r.score) == pytest.approx(want[3:], rel=1e-8, abs=1e-8)
    return model


@pytest.mark.parametrize("common", [1 << 18, 200])
def test_scores_are_those_of_brute_force(spark, folder, monkeypatch, common):
    monkeypatch.setattr(katz, "MAX_COMMON", common)
    monkeypatch.setattr(katz, "MAX_PAIRS", common)
    monkeypatch.setattr(katz, "LEAST_PAIR", 3)
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 5000)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    model = check_katz(QUERIES["op3_katz_scores"](spark, folder).collect(), texts, held)
    words = [*model.c, b"a word that is not there"]
    for h in [b"<s>", b"the", b"of", next(iter(model.context)), b"unseen"]:
        total = sum(model.prob(h, w) for w in words)
        assert total == pytest.approx(1.0)


def test_katz_of_odd_rows(spark):
    docs = odd_documents(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    for rule in (F.col("doc_id") % 3 == 0, F.lit(True), F.lit(None).cast("boolean")):
        rows = katz.score_texts(with_clashing_columns(docs, ["score", "base"]).withColumn("held_out", rule)).collect()
        check_katz(rows, texts, {r.doc_id: r.held_out for r in rows})
    again = katz.score_texts(odd_documents(spark).withColumn("held_out", F.lit(False)))
    assert again.count() == odd_documents(spark).count()
    empty = table(spark, [], SCHEMA + ", held_out boolean")
    assert katz.score_texts(empty).collect() == []


def test_discounts_stay_between_zero_and_one():
    rng = np.random.default_rng(0)
    for _ in range(200):
        times = {r: int(rng.integers(0, 30)) for r in range(1, 7)}
        assert ((katz.discounts(times)[1:] > 0) & (katz.discounts(times)[1:] < 1)).all()


# ---- n-gram join


def grams(text, n=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_components(rows, n=4, percent=85):
    """(doc_id, size, smallest id) by testing all pairs that share a shingle."""
    sets, by = [grams(t, n) for _, t in rows], defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    common = Counter((i, j) for found in by.values() for a, i in enumerate(found) for j in found[a + 1:])
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, j), k in common.items():
        if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
            parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min((x for x in (least.get(root(i)), doc_id) if x is not None), default=None)
    return Counter((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def edited(words, rng, n):
    words = list(words)
    for i in rng.integers(0, len(words), n):
        words[i] = f"edit{rng.integers(1 << 30)}"
    return " ".join(words)


def planted():
    """Chains of edits, a large group of near copies, a passage that dissimilar texts share, short texts, copies."""
    rng = np.random.default_rng(1)
    texts = []
    for g in range(6):
        words = prose(60 + 30 * g, 1000 * g).split()
        for _ in range(8):
            words = edited(words, rng, 1).split()
            texts.append(" ".join(words))
    hot = prose(120, 77).split()
    texts += [edited(hot, rng, int(rng.integers(0, 4))) for _ in range(120)] + [" ".join(hot)] * 20
    passage = prose(60, 5000)
    texts += [f"{prose(40, 9000 + 50 * i)} {passage}" for i in range(60)]
    texts += ["a b", "A  b", "a b c", "", None, " ", "x"]
    return texts


@pytest.mark.parametrize("least, rows, most, n, percent", [
    (8, 1024, 1 << 18, 4, 85), (2, 16, 1 << 18, 5, 80), (8, 16, 0, 1, 50), (2, 16, 40, 4, 85)])
def test_join_loses_no_link(spark, monkeypatch, least, rows, most, n, percent):
    monkeypatch.setattr(ngram_join, "LEAST_COMMON", least)
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", rows)
    monkeypatch.setattr(ngram_join, "MAX_COMMON", most)
    texts = planted()
    docs = documents(spark, texts)
    got = Counter(tuple(r) for r in ngram_join.ngram_components(docs, n, percent).collect())
    assert got == brute_components(list(enumerate(texts)), n, percent)


@pytest.mark.parametrize("times", [1000, 1_000_000])
def test_join_of_salted_lists(spark, monkeypatch, times):
    """Very common n-grams are dealt over salts, and their lists still hang together: also where most salts have no
    text, since many equal texts are one node."""
    real = ngram_join.first_grams

    def many(*args):
        found, seen = real(*args)
        return found, np.where(seen > 0, seen * times, 0)

    monkeypatch.setattr(ngram_join, "first_grams", many)
    texts = planted()
    for g in range(20):  # two nodes each, all of whose n-grams are common
        words = prose(50 + 30 * g, 20_000 + 1000 * g)
        texts += [words] * 8 + [words.rsplit(" ", 1)[0]] * 8
    got = Counter(tuple(r) for r in ngram_join.ngram_components(documents(spark, texts)).collect())
    assert got == brute_components(list(enumerate(texts)))


def test_join_of_odd_rows(spark):
    docs = with_clashing_columns(odd_documents(spark), ["node", "size", "text_hash", "component_id"])
    got = Counter(tuple(r) for r in ngram_join.ngram_components(docs).collect())
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert ngram_join.ngram_components(table(spark, [], SCHEMA)).collect() == []


def test_join_of_all_test_documents(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op6_ngram_join"](spark, folder).collect())
    assert got == brute_components(docs)


def test_keep_one_keeps_one(spark):
    docs = with_clashing_columns(odd_documents(spark), ["_id", "_hash", "id", "hash", "row", "node"])
    kept = ngram_join.keep_one(docs, n=5, percent=80)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert all({r._id, r._hash, r.id, r.hash, r.row, r.node} == {"clash"} for r in rows)
    worded = [r for r in rows if (r.text or "").split()]
    assert len({frozenset(grams(r.text, 5)) for r in worded}) == len(worded)
    assert len(rows) - len(worded) == sum(not (r.text or "").split() for r in docs.collect())
    texts = planted()
    out = ngram_join.keep_one(documents(spark, texts), 5, 80).collect()
    assert sorted(r.doc_id for r in out if (r.text or "").split()) == sorted(
        {c for (d, k, c) in brute_components(list(enumerate(texts)), 5, 80) if k})


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in graph.components(table(spark, links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert graph.components(table(spark, [], "a long, b long")).collect() == []


# ---- pipeline


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == columns
        rows = {r.doc_id: r.text for r in out.collect()}
        assert set(rows) <= set(kept) and all(rows[i] == kept[i] for i in rows)
        gone = [i for i in kept if i not in rows]
        if name == "near copies":
            want = {c for _, k, c in brute_components(list(kept.items()), 5, 80)}
            assert set(rows) == want
        else:
            assert gone or name == "quality classifier"
            clean = [i for i in gone if labels.get(i) == 1 and len((kept[i] or "").split()) >= 10]
            assert len(clean) <= 0.05 * sum(labels.get(i) == 1 for i in kept)
        docs, kept = spark.createDataFrame(out.collect(), out.schema), rows
    final = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in final} == set(kept)


def test_pipeline_of_odd_and_empty_tables(spark, tmp_path):
    for i, docs in enumerate((odd_documents(spark), table(spark, [], SCHEMA))):
        docs = with_clashing_columns(docs, ["score", "rules", "kept", "row"])
        at = str(tmp_path / str(i))
        docs.write.parquet(f"{at}/documents.parquet")
        table(spark, [], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, at).columns == docs.columns
        corpus_pipeline.run(spark, at).collect()


def test_components_without_enough_rounds(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="2 rounds"):
        graph.components(chain, rounds=2)
