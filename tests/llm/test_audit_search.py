"""Source audit, SimHash near copies and ranked search, against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quayside.llm import QUERIES, bitslice_search, simhash_pivots, source_audit
from quayside.sources import read_table
from tests.llm.helpers import ODD, SCHEMA, documents, odd_documents, prose, table, with_clashing_columns

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# ---- Source audit


def audit_by_hand(rows, least=3, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]  # lang, source, text
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(SMALL)) for _, _, t in rows]
    docs, of_lang, of_source = Counter(), defaultdict(Counter), defaultdict(Counter)
    for (lang, source, _), found in zip(rows, terms):
        docs.update((lang, t) for t in set(found))
        of_lang[lang].update(found)
        of_source[lang, source].update(found)
    out = []
    for lang in {r[0] for r in rows}:
        kept = [t for t in of_lang[lang] if docs[lang, t] >= least]
        sources = {r[1] for r in rows if r[0] == lang}

        def shares(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 1) // total for t in kept}

        whole, each = shares(of_lang[lang]), {s: shares(of_source[lang, s]) for s in sources}
        for s, p in each.items():
            pairs = [(o, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)) for o, q in each.items() if o != s]
            found = [(t, (p[t] - whole[t]) ** 2 // whole[t]) for t in kept
                     if of_source[lang, s][t] and p[t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", found, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, i + 1) for i, (t, v) in enumerate(items[:most])]
    return Counter(out)


def audited(df, **more):
    return Counter(tuple(r) for r in source_audit.audit_sources(df, **more).select(
        "lang", "source", "part", "item", "value", "rank").collect())


def text_of_terms(rng, n):
    return " ".join(f"t{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in (rng.random(n) ** 3 * 60).astype(int))


def test_audit_agrees_with_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), text_of_terms(rng, int(rng.integers(0, 60))), ["en", "de", None][i % 3],
             ["a", "b", "é", None, "e", "f", "g"][int(rng.integers(0, 7))], None) for i in range(150)]
    rows += [(1, None, "en", "empty", None), (2, "", "xx", "only", None), (2, "rare words", "xx", "other", None)]
    rows += [(3, "Mixed CASE-words 42 é東京 and\x00more" * 3, "en", "a", None)] * 4
    df = table(spark, rows)
    want = audit_by_hand([(r[2], r[3], r[1]) for r in rows])
    assert audited(df) == want
    assert audited(with_clashing_columns(df, ["place", "cells", "term", "n", "none", "q", "rank", "value"])) == want
    assert audited(df, least_docs=1, top=5) == audit_by_hand([(r[2], r[3], r[1]) for r in rows], 1, 5)
    assert audited(df.limit(0)) == Counter()
    assert audited(table(spark, rows[-7:-5])) == Counter()  # a language with one source has no pairs
    assert {r[4] for r in audited(table(spark, rows[-6:-4]))} == {0}  # one without kept terms has pairs of value 0


def test_audit_of_odd_texts(spark):
    df = odd_documents(spark)
    df = df.unionByName(df.withColumn("source", F.lit("second"))).unionByName(df.withColumn("lang", F.lit(None)))
    assert audited(df) == audit_by_hand([(r.lang, r.source, r.text) for r in df.collect()])


@pytest.mark.parametrize("at_once", [1, 7, 10 ** 6])
def test_branches_combine_each_node_with_its_ancestors(monkeypatch, at_once):
    monkeypatch.setattr(source_audit, "COMBINED", at_once)
    rng = np.random.default_rng(at_once)
    none = rng.integers(1, 9, 6)
    paths = sorted({(lang, tuple((i, int(rng.integers(9, 12)), int(none[i])) for i in range(6) if rng.random() < 0.6))
                    for lang in "ab" for _ in range(60)})
    times = rng.integers(1, 5, len(paths))
    cell = pa.struct([("place", pa.int32()), ("p", pa.int64()), ("none", pa.int64())])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in paths]), pa.array([[dict(zip(("place", "p", "none"), c)) for c in p[1]] for p in paths],
                                                   pa.list_(cell)), pa.array(times)], names=["lang", "path", "times"])
    want = Counter()

    def f(x, y):
        return (x - y) ** 2 // y

    for (lang, path), n in zip(paths, times.tolist()):
        for a, p, za in path:
            for b, q, zb in path:
                if a != b:
                    want[lang, a, b] += n * (f(p, q) - f(p, zb) - f(za, q) + f(za, zb))
    got = source_audit.branch_corrections(batch.slice(0)).to_pylist()
    assert {(r["lang"], r["a"], r["b"]): r["value"] for r in got if r["value"]} == {k: v for k, v in want.items() if v}


# ---- SimHash


def print_by_hand(text, width=3):
    words = (text or "").translate(SMALL).encode().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    values = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in values) > len(values))


def classes_by_hand(ids, prints, differ):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= differ:
                root[find(i)] = find(j)
    least = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [least.get(find(i)) for i in range(len(ids))]


def check_near_copies(df, differ=3):
    rows = df.select("doc_id", "text").collect()
    prints = [print_by_hand(r.text) for r in rows]
    want = Counter(zip([r.doc_id for r in rows], [f"{p:016x}" for p in prints],
                       classes_by_hand([r.doc_id for r in rows], prints, differ)))
    assert Counter(tuple(r) for r in simhash_pivots.near_copies(df, differ=differ).collect()) == want


def test_simhash_is_spark_s_hash(spark):
    text = "One two  THREE\tfour é"
    hashes = spark.sql("SELECT xxhash64('one two three') a, xxhash64('two three four') b, xxhash64('three four é') c").first()
    bits = [sum(h >> k & 1 for h in hashes) > 1 for k in range(64)]
    assert simhash_pivots.simhash(text.translate(SMALL).encode().split(), 3) == sum(1 << k for k in range(64) if bits[k])
    assert simhash_pivots.simhash([], 3) == 0


def test_near_copies_agree_with_brute_force(spark):
    check_near_copies(odd_documents(spark))
    check_near_copies(with_clashing_columns(odd_documents(spark), ["print", "root", "place", "unit", "least", "node"]))
    base = [prose(200, start) for start in range(0, 40, 8)]
    edited = [" ".join("edit" if k == i else w for k, w in enumerate(t.split())) for t in base for i in range(0, 200, 25)]
    check_near_copies(documents(spark, [*base, *edited, *base, None, ""], first=100))
    check_near_copies(documents(spark, [*base, *edited]), differ=6)
    assert simhash_pivots.near_copies(documents(spark, []).limit(0)).count() == 0


def test_near_copies_with_text_ids(spark):
    df = documents(spark, [prose(50), prose(50), prose(60, 5)]).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    got = {r.doc_id: r.component_id for r in simhash_pivots.near_copies(df).collect()}
    assert got == {"d0": "d0", "d1": "d0", "d2": "d2"}


@pytest.mark.parametrize("alike,most", [(2, 2048), (2, 40), (3, 10), (5, 2048)])
def test_pivot_links_lose_none(spark, alike, most):
    """Random prints, chains of flips, and a place with very many prints, dealt in blocks."""
    rng = np.random.default_rng(alike * most)

    def flipped(x, n):
        for k in rng.choice(64, n, replace=False):
            x ^= 1 << int(k)
        return x

    centre = [int(x) for x in rng.integers(0, 1 << 63, 30)]
    prints = {*centre, 0, *[flipped(x, int(rng.integers(1, 5))) for x in centre for _ in range(3)]}
    prints |= {flipped(centre[0], int(rng.integers(1, 6))) for _ in range(300)}
    prints = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    df = spark.createDataFrame([(p,) for p in prints], "print long").repartition(5)
    links = simhash_pivots.pivot_links(df, 3, alike, most).collect()
    number = {p: i for i, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        root[find(number[a])] = find(number[b])
    want = classes_by_hand(list(range(len(prints))), [p & (1 << 64) - 1 for p in prints], 3)
    by_root = defaultdict(set)
    for i in range(len(prints)):
        by_root[find(i)].add(i)
    assert sorted(map(sorted, by_root.values())) == sorted(
        [i for i, w in enumerate(want) if w == c] for c in set(want))


def test_blocks_alike_grow_with_the_prints():
    sizes = [simhash_pivots.blocks_alike(n, 3) for n in (0, 10 ** 6, 10 ** 9, 10 ** 11, 10 ** 13)]
    assert sizes == sorted(sizes) and sizes[0] == 2 and 2 ** (64 * sizes[-1] / (sizes[-1] + 3)) >= 10 ** 13


def test_near_copies_of_the_test_table(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text").collect()
    prints = {r.doc_id: print_by_hand(r.text) for r in docs}
    want = dict(zip(prints, classes_by_hand(list(prints), list(prints.values()), 3)))
    got = QUERIES["op12_simhash_pivots"](spark, folder).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {
        i: (prints[i], want[i]) for i in prints}


# ---- Ranked search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def search_by_hand(docs, items, top=10):
    """docs: (doc_id, text); items: (item_id, text)."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_words = len(counts), sum(c.total() for _, c in counts)
    out = []
    for item, text in items:
        found = []
        for doc_id, c in counts:
            m = 25 + 75 * c.total() * n_docs // n_words
            score = 0
            for t in terms(text):
                df = sum(t in x for _, x in counts)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += w * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
            if score:
                found.append((-score, doc_id is not None, doc_id or 0, doc_id))
        out += [(item, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(found)[:top])]
    return Counter(out)


def searched(docs, items, **more):
    return Counter(tuple(r) for r in bitslice_search.search(docs, items, **more).select(
        "item_id", "rank", "doc_id", "score").collect())


ITEMS = [(0, "the river MILL and the mill"), (1, "nobody"), (2, None), (3, ""), (4, "zzz unseen"), (1, "naïve 東京 café"),
         (5, "river1x0 old2y0 42 license"), (6, "x" * 30_000), (7, "one two words a b")]


def random_documents(spark, n=300):
    rng = np.random.default_rng(3)
    vocabulary = ODD[8].split()[:40] + ["the", "river", "mill", "nobody", "one", "two", "a", "b"]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 80)))) for _ in range(n)]
    return documents(spark, [*texts, *texts[:40], "mill " * 5000, "the mill, the mill"], first=1000)


def test_search_agrees_with_brute_force(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    df = odd_documents(spark).unionByName(random_documents(spark))
    want = search_by_hand([(r.doc_id, r.text) for r in df.collect()], ITEMS)
    assert searched(df, items) == want
    clashing = ["item", "ids", "sizes", "rows", "bits", "items", "wanted_id", "rank", "score", "bound", "item_id"]
    assert searched(with_clashing_columns(df, clashing), with_clashing_columns(items.union(items), ["doc_id", "block"])
                    ) == want
    assert searched(df, items, top=3) == search_by_hand([(r.doc_id, r.text) for r in df.collect()], ITEMS, 3)
    assert searched(df.limit(0), items) == searched(df, items.limit(0)) == Counter()
    assert searched(table(spark, [(1, None, None, None, None)]), items) == Counter()


def test_search_in_small_blocks(spark, monkeypatch):
    for name, value in (("ITEMS_AT_ONCE", 2), ("MOST_ENTRIES", 300), ("BLOCK_DOCS", 10), ("BLOCK_CELLS", 5000)):
        monkeypatch.setattr(bitslice_search, name, value)
    df = random_documents(spark, 80).withColumn("doc_id", F.col("doc_id").cast("string"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    counted = search_by_hand([(int(i), t) for i, t in docs], ITEMS)
    want = Counter({(i, rank, str(d), s): n for (i, rank, d, s), n in counted.items()})
    assert searched(df, items) == want
    monkeypatch.setattr(bitslice_search, "MOST_SENT", 0)  # the ids are joined, not sent
    assert searched(df, items) == want


def test_bounds_are_never_below_the_scores(spark):
    df = random_documents(spark)
    index = bitslice_search.build_index(df).cache()
    queries = bitslice_search.Queries([t for _, t in ITEMS], index)
    texts = {r.doc_id: r.text for r in df.collect()}
    exact = excess = 0
    for r in index.select("ids", "sizes", "rows", "bits").collect():
        bounds = queries.bounds(r["sizes"], r["rows"], bytes(r["bits"]))
        for d, doc_id in enumerate(r["ids"]):
            scores = queries.score(texts[doc_id], range(len(ITEMS)))
            assert (bounds[:, d] >= scores).all()
            exact, excess = exact + sum(scores), excess + int(bounds[:, d].sum()) - sum(scores)
    assert 0 <= excess < 0.2 * exact  # the slices are tight enough to exclude


def test_only_documents_that_reach_the_floor_are_read_again(spark, folder):
    docs, items = read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    index = bitslice_search.build_index(docs).cache()
    queries = bitslice_search.Queries([r.text for r in items.orderBy("item_id").collect()], index)
    best = QUERIES["op13_lexical_search"](spark, folder).filter("rank = 10").collect()
    floors = [1] * items.count()
    for r in best:
        floors[r.item_id] = r.score
    wanted = bitslice_search.bound_rows(index, queries, "long", None, floors).count()
    assert 10 * len(best) <= wanted < 0.2 * docs.count() * len(best)
