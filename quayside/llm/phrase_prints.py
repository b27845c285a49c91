"""Document fingerprints from Lempel-Ziv phrases.

A text's bytes are parsed into the phrases of an LZ78 dictionary: each phrase is the shortest run that is not yet in
it. Texts that compress each other well share phrases, so the likeness of two texts is the Jaccard likeness of their
phrase sets, estimated from the smallest hashes of each set.
"""

from __future__ import annotations

import hashlib
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F, types as T

from quayside.llm.common import mix

SIZE = 64  # hashes kept; the likeness is off by about 1 / sqrt(SIZE) / 2 at most


ONE = [bytes([byte]) for byte in range(256)]


class Parse:
    """The state of a parse: the dictionary as a trie in the order of the phrases, their CRCs, the node reached.

    Nodes are multiples of 256, so that node + byte is the key of a child; a phrase's CRC goes on from its parent's.
    """

    def __init__(self):
        self.trie: dict[int, int] = {}
        self.crcs, self.node = [0], 0

    def copy(self) -> Parse:
        out = Parse()
        out.trie, out.crcs, out.node = self.trie.copy(), self.crcs.copy(), self.node
        return out

    def read(self, data: bytes, start: int) -> Parse:
        """Go on from byte ``start`` to the end. What comes before it has been read."""
        trie, crcs, node = self.trie, self.crcs, self.node
        step, add, size = trie.get, crcs.append, len(trie) << 8
        for byte in data[start:] if start else data:
            key = node + byte
            node = step(key, 0)
            if not node:
                size += 256
                trie[key] = size
                add(crc32(ONE[byte], crcs[key >> 8]))
        self.node = node
        return self

    def back_to(self, phrases: int, node: int) -> None:
        """Forget all but the first phrases; ``node`` is where the parse stood then."""
        for _ in range(len(self.trie) - phrases):
            self.trie.popitem()
        del self.crcs[phrases + 1:]
        self.node = node

    @property
    def phrases(self) -> list[bytes]:
        found = [b""]
        for key in self.trie:
            found.append(found[key >> 8] + ONE[key & 255])
        return found[1:]

    def smallest(self, k: int = SIZE, after: int = 0) -> np.ndarray:
        """The k smallest hashes of the phrases, but for the first ``after``, in order."""
        h = np.array(self.crcs[after + 1:], np.uint64)
        return np.unique((mix(h) >> np.uint64(32)).astype(np.uint32))[:k]


def as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def fingerprint(text: str | None, k: int = SIZE) -> str:
    """Hex digits of the smallest phrase hashes; empty for a text without characters."""
    return as_text(Parse().read((text or "").encode(), 0).smallest(k))


def likeness(a: np.ndarray, b: np.ndarray, k: int = SIZE) -> float:
    """Estimated share of common phrases (0 to 1); two empty texts are alike."""
    a, b = set(a.tolist()), set(b.tolist())
    union = sorted(a | b)[:k]
    return len(a & b & set(union)) / len(union) if union else 1.0


def print_documents(docs: DataFrame, k: int = SIZE) -> DataFrame:
    """One row per row: doc_id, fingerprint. A null text is empty; other columns are ignored."""
    def run(batches):
        for b in batches:
            found = [fingerprint(t.as_py(), k) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())],
                                             names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(
        run, T.StructType([docs.schema["doc_id"], T.StructField("fingerprint", T.StringType())]))


def in_descending_blocks(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows (doc_id, text, block, guest) sorted by falling doc_id inside blocks, each of which is one partition.

    The blocks are ranges of doc_id at its approximate quantiles. The first rows of the next block are copied into each
    block as guests at its end, and the very first into the last, so that every row but the guests has its successor
    in its partition. One row per block, a number bounded by the shuffle partitions, comes to the driver.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = float(-(1 << 63)) * 2  # a null id comes last
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(-F.col("doc_id").cast("double"), F.lit(-least)).alias("_at"))
    cuts = rows.agg(F.percentile_approx("_at", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] or []
    splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) < 3:
        splits.insert(1, 0.0)
    rows = (Bucketizer(splits=splits, inputCol="_at", outputCol="_block").transform(rows)
            .withColumn("block", F.col("_block").cast("int")))
    heads = rows.groupBy("block").agg(F.min("_at").alias("_at")).orderBy("block").collect()
    found = [(h["_at"], heads[i - 1]["block"]) for i, h in enumerate(heads)]
    hosts = spark.createDataFrame(found, "_at double, host int")
    placed = rows.join(F.broadcast(hosts), "_at", "left")
    spots = F.array_compact(F.array(
        F.struct("block", F.lit(False).alias("guest")),
        F.when(F.col("host").isNotNull(), F.struct(F.col("host").alias("block"), F.lit(True).alias("guest")))))
    return (placed.select("doc_id", "text", F.explode(spots).alias("_spot"))
            .select("doc_id", "text", "_spot.block", "_spot.guest")
            .repartitionById(parts, F.col("block")).sortWithinPartitions("block", "guest", F.desc_nulls_last("doc_id"), "text"))


def compare_neighbours(docs: DataFrame, k: int = SIZE, parts: int | None = None) -> DataFrame:
    """Fingerprint each text and its edited text, whose last half is replaced by the beginning of the next text.

    One row per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Rows are in
    the order of falling doc_id (null last), rows with the same id in that of their texts, and the first follows the
    last. A null text is empty; the only row of a table is its own successor; an empty table gives no rows.
    """
    names = [("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()),
             ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, t) for n, t in names]])
    arrow = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                       ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                       ("near_edited", pa.float64()), ("near_next", pa.float64())])

    class Row:
        def __init__(self, doc_id, text: str):
            self.doc_id, self.text = doc_id, text
            self.half = len(text) // 2
            self.head = text[:len(text) - self.half]
            self.kept = self.head.encode()
            self.parse = Parse().read(self.kept, 0)
            self.mark, self.node = len(self.parse.trie), self.parse.node
            self.least = self.parse.smallest(k)
            self.print = self.with_tail(text[len(self.head):].encode())

        def with_tail(self, tail: bytes) -> np.ndarray:
            """Smallest hashes of the kept half and this tail; the parse goes back to the end of the kept half."""
            if not tail:
                return self.least
            more = self.parse.read(tail, 0).smallest(k, self.mark)
            self.parse.back_to(self.mark, self.node)
            return np.union1d(self.least, more)[:k]

        def beside(self, after: Row) -> tuple:
            tail = after.text[:self.half].encode()
            edited, other = self.kept + tail, self.with_tail(tail)
            return (self.doc_id, len(self.text), hashlib.sha256(edited).hexdigest(), as_text(self.print),
                    as_text(other), likeness(self.print, other, k), likeness(self.print, after.print, k))

    def run(batches):
        block, last = None, None
        for b in batches:
            out = []
            for doc_id, text, at, guest in zip(*[c.to_pylist() for c in b.columns]):
                if at != block:
                    block, last = at, None
                if guest and last is None:
                    continue  # a further guest
                row = Row(doc_id, text)
                if last is not None:
                    out.append(last.beside(row))
                last = None if guest else row
            columns = list(zip(*out)) or [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    wide = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    out = in_descending_blocks(wide, parts).mapInArrow(run, T.StructType(
        [T.StructField("doc_id", T.LongType()), *schema.fields[1:]]))
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
