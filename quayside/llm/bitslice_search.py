"""Ranked lexical search over bit-sliced Bloom signatures.

The index cuts the documents into blocks of similar size. A block is a bit matrix with a column per document: the rows
that a term's hashes name have a bit for every document that has the term, and further rows for every document that
has it 2, 4, 8 ... times. Rows ANDed for a term show each document that has it, and a few that don't, so a term's
occurrences are never underestimated; weighted sums of the rows over an item's terms are upper bounds of its scores.

A search finds, from the bounds, some documents per item that look best and scores them exactly. The worst of the best
exact scores is then a floor: every document whose bound reaches it is scored exactly from its text, all others are
proven not to be among the best.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from quayside.llm.common import mix
from quayside.llm.terms import separators, terms_of
from quayside.sources.tables import stored

BITS_PER_ENTRY, HASHES = 12, 4
BLOCK_DOCS, BLOCK_CELLS = 1024, 1 << 25
MOST_ENTRIES = 1_000_000  # entries that a task holds before it cuts blocks
ITEMS_AT_ONCE = 256  # items that one job searches for
MOST_SENT = 200_000  # pairs of an item and an id that are sent to all tasks
SCALE = 1_000_000_000
WORDS = separators(digits=True)


def entry_hashes(terms: np.ndarray, level: int) -> np.ndarray:
    """The hash of "this term, at least 2 ** level times" for each hash of a term."""
    return mix(terms + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1))


def bit_rows(entries: np.ndarray, rows: int) -> np.ndarray:
    """The rows (entry, hash) that an entry sets in a matrix with so many rows."""
    low, high = entries & np.uint64(0xFFFFFFFF), (entries >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + high[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(rows)).astype(np.int64)


def hashed(terms: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t) for t in terms], np.uint64)


class _Held:
    """Documents of a task that are not yet in a block."""

    def __init__(self):
        self.ids, self.sizes, self.terms, self.times, self.of, self.docs = [], [], [], [], [], Counter()

    def add(self, doc_id, text: str | None) -> int:
        """Take a document, if it has a term; the number of its different terms."""
        counts = Counter(terms_of(text, WORDS))
        if counts:
            self.of.append(len(counts))
            self.ids.append(doc_id)
            self.sizes.append(counts.total())
            self.terms.append(hashed(list(counts)))
            self.times.append(np.fromiter(counts.values(), np.int64, len(counts)))
            self.docs.update(counts.keys())
        return len(counts)

    def blocks(self):
        """(numbers of documents, rows, packed bits) of blocks of documents with similar numbers of entries."""
        terms, times = np.concatenate(self.terms), np.concatenate(self.times)
        doc = np.repeat(np.arange(len(self.of)), self.of)
        entries, owner, level = [], [], 0
        while len(terms):
            entries.append(entry_hashes(terms, level))
            owner.append(doc)
            level += 1
            more = times >= 1 << level
            terms, times, doc = terms[more], times[more], doc[more]
        entries, owner = np.concatenate(entries), np.concatenate(owner)
        size = np.bincount(owner, minlength=len(self.of))
        order = np.argsort(size, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at = np.argsort(place[owner], kind="stable")
        entries, owner = entries[at], place[owner][at]
        cuts = np.concatenate([[0], np.cumsum(size[order])])
        first = 0
        while first < len(order):
            last = min(first + BLOCK_DOCS, int(np.searchsorted(size[order], 2 * size[order[first]], "right")))
            while last - first > 8 and (last - first) * size[order[last - 1]] * BITS_PER_ENTRY > BLOCK_CELLS:
                last = first + (last - first) // 2
            rows = max(64, BITS_PER_ENTRY * int(size[order[last - 1]]))
            bits = np.zeros((rows, last - first), bool)
            some = slice(cuts[first], cuts[last])
            bits[bit_rows(entries[some], rows).ravel(), np.repeat(owner[some] - first, HASHES)] = True
            yield order[first:last], rows, np.packbits(bits, axis=1)
            first = last


def build_index(docs: DataFrame) -> DataFrame:
    """The signature table of all rows of ``docs`` that have a term: a row per block, and with the first block of a
    run of blocks its terms with the number of its documents that have them. Store it to search it more than once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(held: _Held, doc_type: pa.DataType):
        ids, sizes = pa.array(held.ids, doc_type), np.array(held.sizes, np.int64)
        vocabulary = list(held.docs)
        for k, (docs_, rows, bits) in enumerate(held.blocks()):
            seen = [] if k else vocabulary
            ends = [0, len(docs_)]
            yield pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(ends, ids.take(pa.array(docs_))),
                pa.ListArray.from_arrays(ends, pa.array(sizes[docs_])),
                pa.array([rows], pa.int32()), pa.array([bits.tobytes()], pa.binary()),
                pa.ListArray.from_arrays([0, len(seen)], pa.array(seen, pa.binary()).cast(pa.string())),
                pa.ListArray.from_arrays([0, len(seen)], pa.array([held.docs[t] for t in seen], pa.int64()))],
                names=["ids", "sizes", "rows", "bits", "terms", "docs"])

    def run(batches):
        held, entries = _Held(), 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                entries += held.add(doc_id, text)
                if entries > MOST_ENTRIES:
                    yield from cut(held, b.column(0).type)
                    held, entries = _Held(), 0
            doc_type = b.column(0).type
        if held.of:
            yield from cut(held, doc_type)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"ids array<{kind}>, sizes array<long>, rows int, bits binary, terms array<string>, docs array<long>")


class Queries:
    """A bounded number of items with their terms, weights and the sizes of the corpus; goes to all tasks."""

    def __init__(self, texts: list[str | None], index: DataFrame):
        found = [Counter(terms_of(t, WORDS)) for t in texts]
        self.terms = sorted(set().union(*found))
        at = {t: i for i, t in enumerate(self.terms)}
        self.hashes = hashed(self.terms)
        spark = index.sparkSession
        n_docs, n_words = index.agg(
            F.coalesce(F.sum(F.size("sizes").cast("bigint")), F.lit(0)),
            F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)), F.lit(0))).first()
        self.docs, self.words = int(n_docs), int(n_words)
        asked = spark.createDataFrame(pa.table({"term": pa.array(self.terms, pa.binary()).cast(pa.string())}))
        met = index.select(F.explode(F.arrays_zip("terms", "docs")).alias("x")).select(
            F.col("x.terms").alias("term"), F.col("x.docs").alias("n"))
        counts = (met.join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("n").alias("n"))).collect()
        of = {r.term.encode(): r.n for r in counts}  # a row per term of the items
        weight = [math.floor(1000 * math.log((2 * self.docs + 2) / (2 * of.get(t, 0) + 1))) for t in self.terms]
        self.weights = np.array(weight, np.int64)
        self.items = [(np.array([at[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in found]

    def length(self, size: int) -> int:
        """A document's m."""
        return 25 + 75 * size * self.docs // self.words

    def score(self, text: str | None, items) -> list[int]:
        """Exact scores of a text for the items with these numbers."""
        counts = Counter(terms_of(text, WORDS))
        m = self.length(counts.total()) if counts else 1
        out = []
        for i in items:
            total = 0
            for t, n in zip(*(x.tolist() for x in self.items[i])):
                tf = counts.get(self.terms[t], 0)
                if tf:
                    total += n * int(self.weights[t]) * (SCALE * tf // (1000 * tf + 8 * m))
            out.append(total)
        return out

    def bounds(self, sizes: list[int], rows: int, bits: bytes) -> np.ndarray:
        """Upper bounds (item, document) of the scores in a block, worked out for so many terms at once."""
        matrix = np.frombuffer(bits, np.uint8).reshape(rows, -1)
        size, m = np.array(sizes, np.int64), np.array([self.length(n) for n in sizes], np.int64)
        out = np.zeros((len(self.items), len(sizes)), np.int64)
        step = max(1, BLOCK_CELLS // 16 // len(sizes))
        for first in range(0, len(self.terms), step):
            part = self._term_bounds(matrix, size, m, slice(first, first + step))
            for i, (t, n) in enumerate(self.items):
                here = (t >= first) & (t < first + step)
                out[i] += (part[t[here] - first] * n[here, None]).sum(axis=0)
        return out

    def _term_bounds(self, matrix: np.ndarray, size: np.ndarray, m: np.ndarray, some: slice) -> np.ndarray:
        """What each term adds at most to the score of each document."""
        hashes = self.hashes[some]
        most = np.zeros((len(hashes), len(m)), np.int64)  # the most occurrences that the slices allow
        left, level = np.arange(len(hashes)), 0
        alive = np.full((len(hashes), matrix.shape[1]), 255, np.uint8)
        while len(left):
            at = bit_rows(entry_hashes(hashes[left], level), len(matrix))
            for k in range(HASHES):
                alive = alive & matrix[at[:, k]]
            met = alive.any(axis=1)
            left, alive, level = left[met], alive[met], level + 1
            has = np.unpackbits(alive, axis=1, count=len(m)).astype(bool)
            most[left] = np.where(has, (1 << level) - 1, most[left])
        out = np.zeros_like(most)
        t, d = np.nonzero(most)
        tf = np.minimum(most[t, d], size[d])
        out[t, d] = self.weights[some][t] * (SCALE * tf // (1000 * tf + 8 * m[d]))
        return out


def bound_rows(index: DataFrame, queries: Queries, kind: str, most: int | None, floors: list[int] | None) -> DataFrame:
    """(item, doc_id, bound): the documents whose bound reaches an item's floor, or, without floors, for each task the
    ``most`` with the largest bounds."""
    def run(batches):
        floor = np.array(floors if floors is not None else [1] * len(queries.items), np.int64)
        for b in batches:
            for ids, sizes, rows, bits in zip(b.column(0), b.column(1), b.column(2).to_pylist(), b.column(3)):
                bound = queries.bounds(sizes.as_py(), rows, bits.as_py())
                found = bound >= floor[:, None]
                if most is not None and bound.shape[1] > most:
                    best = np.argpartition(bound, -most, axis=1)[:, -most:]
                    among = np.zeros_like(found)
                    np.put_along_axis(among, best, True, axis=1)
                    # So many of what this task has are as good as the worst of these.
                    floor = np.maximum(floor, np.take_along_axis(bound, best, axis=1).min(axis=1))
                    found &= among
                item, doc = np.nonzero(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item.astype(np.int32)), ids.values.take(pa.array(doc)), pa.array(bound[item, doc])],
                    names=["item", "doc_id", "bound"])

    return index.select("ids", "sizes", "rows", "bits").mapInArrow(run, f"item int, doc_id {kind}, bound long")


def exact_scores(docs: DataFrame, wanted: DataFrame, queries: Queries, kind: str) -> DataFrame:
    """(item, doc_id, score) of all rows with the wanted ids, from their whole texts. ``wanted`` is stored."""
    ids = wanted.groupBy(F.col("doc_id").alias("wanted_id")).agg(F.collect_set("item").alias("items"))
    if wanted.count() <= MOST_SENT:  # as a rule; more of them are joined as Spark sees fit, which moves the texts
        ids = F.broadcast(ids)
    rows = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("doc_id", "text", "items")

    def run(batches):
        for b in batches:
            item, row, score = [], [], []
            for i, (text, items) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                item += items
                row += [i] * len(items)
                score += queries.score(text, items)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), b.column(0).take(pa.array(row, pa.int64())), pa.array(score, pa.int64())],
                names=["item", "doc_id", "score"])

    return rows.mapInArrow(run, f"item int, doc_id {kind}, score long").filter("score > 0")


def search_block(docs: DataFrame, index: DataFrame, texts: list[str | None], top: int) -> DataFrame:
    """(item, rank, doc_id, score) for a bounded number of item texts; ``item`` is the place in the list."""
    queries, kind = Queries(texts, index), docs.schema["doc_id"].dataType.simpleString()
    by_bound = W.partitionBy("item").orderBy(F.desc("bound"), "doc_id")
    best = (bound_rows(index, queries, kind, top, None).withColumn("at", F.row_number().over(by_bound))
            .filter(F.col("at") <= 2 * top).select("item", "doc_id"))
    best = stored(best, "best-bounds")
    by_score = W.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    first = exact_scores(docs, best, queries, kind).withColumn("rank", F.row_number().over(by_score))
    floors = [1] * len(texts)
    for r in first.filter(F.col("rank") == top).select("item", "score").collect():  # a row per item
        floors[r.item] = r.score
    wanted = stored(bound_rows(index, queries, kind, None, floors).select("item", "doc_id"), "wanted")
    return (exact_scores(docs, wanted, queries, kind).withColumn("rank", F.row_number().over(by_score))
            .filter(F.col("rank") <= top))


def search(docs: DataFrame, items: DataFrame, top: int = 10, index: DataFrame | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: for each item its ``top`` rows of ``docs`` with the highest scores above 0.

    Scores are those of the query's contract: whole-number BM25 over maximal runs of letters and digits. ``index`` is
    that of ``build_index`` on the same rows; without one it is built. Items are searched for in blocks of a bounded
    number, dealt by hash, each against all rows.

    Equal scores rank by id, a null id first. A null or empty text has no terms and is not counted; a text of any
    length is read whole. Rows with the same id are all ranked. Items equal in id and text are one item, items with
    the same id and other texts are ranked each; an item without terms, an empty table of items or of documents give
    no rows. Other columns are ignored, whatever their names.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    index = stored(build_index(docs), "signatures") if index is None else index
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    blocks = max(1, -(-asked.count() // ITEMS_AT_ONCE))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    spark, out = docs.sparkSession, None
    for block in range(blocks):
        some = asked.filter(F.col("block") == block).select("item_id", "text").toArrow()
        names = pa.table({"item": pa.array(range(len(some)), pa.int32()), "item_id": some.column("item_id")})
        found = search_block(docs, index, some.column("text").to_pylist(), top)
        found = found.join(F.broadcast(spark.createDataFrame(names)), "item").select(
            "item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out
