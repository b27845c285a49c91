"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Texts with equal n-gram sets are one row of the matrix. N-grams that many texts have come last in one global order
(their counts are over all texts; a bounded number of them is kept), and two sets that are alike enough must share one
of their first few n-grams, so only these are posted. Sets in the same posting list, of sizes near enough, hang
together; such clusters are cut into blocks, and each pair of blocks that can hold a link goes to one task. There the
product's overlap counts are added up column by column over the size-sorted rows whose size allows a link, pairs below
the bound that their sizes set are discarded, and of the links only a spanning forest leaves the task. No pair of a
large group is ever a row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from quayside.llm.common import joined, list_column, list_sizes, mix, most_frequent
from quayside.llm.graph import components
from quayside.llm.word_hashes import column_words
from quayside.sources.tables import stored

MAX_COMMON = 1 << 18  # n-grams whose counts are kept and sent to all tasks
LEAST_COMMON = 8
BLOCK_ROWS, BLOCK_GRAMS = 1024, 2_000_000
NO_ID = (1 << 63) - 1  # stands for a null doc_id, after all others


def gram_sets(column, n: int):
    """For each text of an Arrow column the sorted distinct 64-bit hashes of its n-word shingles; of a shorter text the
    whole; of no words, none."""
    for _, _, h, counts in column_words(column):
        m = max(0, len(h) - n + 1)
        windows = h[:m] + np.uint64(n)
        for i in range(1, n):
            windows = mix(windows) + h[i:i + m]
        windows = mix(windows)
        start = 0
        for k in counts.tolist():
            if k >= n:
                yield np.unique(windows[start:start + k - n + 1])
            else:
                whole = h[start:start + min(k, 1)] + np.uint64(k)
                for i in range(1, k):
                    whole = mix(whole) + h[start + i:start + i + 1]
                yield mix(whole)
            start += k


def set_name(grams: np.ndarray) -> int:
    """One 64-bit name for a set (signed)."""
    return int(mix(mix(grams + np.uint64(len(grams))).sum(keepdims=True)).astype(np.int64)[0]) if len(grams) else 0


def fold(grams: np.ndarray) -> np.ndarray:
    """32 bits of each hash. Counts are by these; a clash only moves an n-gram in the global order, for all texts."""
    return (grams >> np.uint64(32)).astype(np.uint32)


def common_grams(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that most texts have, at most MAX_COMMON, with the number of texts; sorted by n-gram.

    Each task counts its own texts and ships sorted counts by bucket; a bucket's task adds them up. The cut is the
    smallest count that leaves few enough.
    """
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def count(batches):
        for b in batches:
            sets = [fold(grams) for grams in gram_sets(b.column(0), n)]
            if not sum(map(len, sets)):
                continue
            grams, times = np.unique(np.concatenate(sets), return_counts=True)
            at = grams % buckets
            order = np.argsort(at, kind="stable")
            cuts = np.searchsorted(at[order], np.arange(buckets + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(buckets, dtype=np.int32)),
                 list_column(grams[order].view(np.int32), cuts),
                 list_column(times[order].astype(np.int32), cuts)], names=["bucket", "grams", "times"])

    def add(table: pa.Table) -> pa.Table:
        grams, times = joined(table.column("grams")).view(np.uint32), joined(table.column("times"))
        found, at = np.unique(grams, return_inverse=True)
        total = np.bincount(at, times, len(found)).astype(np.int64)
        keep = total >= LEAST_COMMON
        return pa.table({"gram": found[keep].astype(np.int64), "n": total[keep]})

    parts = docs.select("text").mapInArrow(count, "bucket int, grams array<int>, times array<int>")
    counts = stored(parts.groupBy("bucket").applyInArrow(add, "gram long, n long"), "common")
    rows = most_frequent(counts, MAX_COMMON)  # two numbers a row
    gram, times = rows.column("gram").to_numpy().astype(np.uint32), rows.column("n").to_numpy()
    order = np.argsort(gram)
    return gram[order], times[order]


def least_overlap(size, percent: int):
    """The fewest common n-grams with which a set of this size can be linked to any other."""
    return -(-percent * size // 100)


def least_shared(size):
    """How many n-grams of the longer beginnings that are posted two linked sets share, by the smaller set's size."""
    return np.maximum(1, size // 20) if isinstance(size, np.ndarray) else max(1, size // 20)


def first_grams(grams: np.ndarray, percent: int, common: np.ndarray, times: np.ndarray):
    """The n-grams that are posted, rare ones first, and the counts of the common ones (0 for the others).

    All but ``overlap - k`` of a set are posted, so at least k of any ``overlap`` common n-grams are. Of two linked sets
    the one whose last posted n-gram comes first has these k among the other's posted ones too.
    """
    take = len(grams) - least_overlap(len(grams), percent) + least_shared(len(grams))
    take = min(take, len(grams))
    if not len(common):
        return grams[:take], np.zeros(take, np.int64)
    folded = fold(grams)
    at = np.minimum(np.searchsorted(common, folded), len(common) - 1)
    seen = np.where(common[at] == folded, times[at], 0)
    order = np.argsort(seen, kind="stable")[:take]
    return grams[order], seen[order]


def posted_sets(docs: DataFrame, n: int, percent: int, common, times) -> DataFrame:
    """One row per row: doc_id, text_hash, node (the name of its set), size, grams (those posted), salts.

    A very common n-gram's list is dealt over one salt per 10,000 texts, from 1 on, by the set's name; the salt of
    another list is 0.
    """
    def run(batches):
        for b in batches:
            nodes, sizes, grams, salts = [], [], [], []
            for found in gram_sets(b.column(1), n):
                node = set_name(found)
                first, seen = first_grams(found, percent, common, times) if len(found) else (found, found)
                nodes.append(node)
                sizes.append(len(found))
                grams.append(first.astype(np.int64))
                parts = seen.astype(np.int64) // 10_000
                salts.append(np.where(parts > 0, 1 + node % 1_000_003 % (1 + parts), 0).astype(np.int32))
            cuts = np.cumsum([0, *map(len, grams)])
            none = [np.zeros(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                 list_column(np.concatenate(grams + none), cuts),
                 list_column(np.concatenate(salts + [np.zeros(0, np.int32)]), cuts)],
                names=["doc_id", "text_hash", "node", "size", "grams", "salts"])

    return docs.select("doc_id", "text", "text_hash").mapInArrow(
        run, "doc_id long, text_hash long, node long, size long, grams array<long>, salts array<int>")


def postings(sets: DataFrame) -> DataFrame:
    """gram, salt, size, node, sorted inside partitions that hold whole lists."""
    posts = sets.select("node", "size", F.explode(F.arrays_zip("grams", "salts")).alias("p")).select(
        F.col("p.grams").alias("gram"), F.col("p.salts").alias("salt"), "size", "node")
    width = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return posts.repartition(width, "gram", "salt").sortWithinPartitions("gram", "salt", "size", "node")


def runs(batches, percent: int):
    """Columns of sorted postings with the last row of the batch before, and which rows stand near the one before:
    in the same list, with a size that allows a link."""
    last = [np.zeros(0, np.int64)] * 4
    for b in batches:
        columns = [np.concatenate([x, c.to_numpy(zero_copy_only=False)]) for x, c in zip(last, b.columns)]
        gram, salt, size, _ = columns
        if len(gram):
            near = ((gram[1:] == gram[:-1]) & (salt[1:] == salt[:-1]) & (100 * size[:-1] >= percent * size[1:]))
            yield len(last[0]), near, columns
            last = [x[-1:] for x in columns]


def sharing_nodes(sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``sets`` that share enough posted n-grams with others of a size near enough to have any link."""
    def run(batches):
        for _, near, (gram, salt, size, node) in runs(batches, percent):
            shared = np.zeros(len(node), np.int64)
            shared[1:] += near
            shared[:-1] += near  # a row at the edge of two batches counts twice, which only lets more nodes pass
            found, at = np.unique(node, return_inverse=True)
            n = np.bincount(at, (shared > 0) | (salt > 0), len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[n > 0]), pa.array(n[n > 0])], names=["node", "n"])

    counts = postings(sets).mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    # A dealt list: a row may be alone in its salt, so all rows of such lists count.
    salted = F.size(F.filter("salts", lambda s: s > 0)) > 0
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("size") * percent / 100) / 20))
    return sets.join(counts, "node", "left").filter(salted | (F.coalesce("n", F.lit(0)) >= least)).drop("n")


def cluster_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that hold together all nodes that might be alike.

    In a posting list sorted by size, each node is linked to the one before it if their sizes allow a link; where they
    don't, no earlier node can be linked either. The parts of a dealt list are linked through the first nodes of all
    their runs, whichever salts have any.
    """
    def run(batches):
        for old, near, (gram, salt, size, node) in runs(batches, percent):
            pairs = np.unique(np.stack([node[:-1][near], node[1:][near]]), axis=1)
            starts = np.flatnonzero(~near) + 1
            if not old:
                starts = np.concatenate([[0], starts])
            starts = starts[salt[starts] > 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([pairs[0], node[starts]])),
                 pa.array(np.concatenate([pairs[1], node[starts]])),
                 pa.array(np.concatenate([np.zeros(pairs.shape[1], np.int64), gram[starts]]),
                          mask=np.arange(pairs.shape[1] + len(starts)) < pairs.shape[1])], names=["a", "b", "gram"])

    found = stored(postings(sets).mapInArrow(run, "a long, b long, gram long").distinct(), "clusters")
    heads = found.filter(F.col("gram").isNotNull()).select("gram", "a")
    first = heads.groupBy("gram").agg(F.min("a").alias("b"))
    return found.filter(F.col("gram").isNull()).select("a", "b").union(heads.join(first, "gram").select("a", "b"))


def block_keys(nodes: DataFrame, percent: int) -> DataFrame:
    """Rows (node, size, root) with ``keys``: the block pairs of its cluster that a node takes part in.

    A cluster is cut into bands of sizes, such that a link joins the same band or neighbours, and each band into as
    many blocks as its rows or n-grams ask for. A small cluster is one block.
    """
    step = math.log(100 / percent) * 1.0001 if percent < 100 else 1e-9
    rows = nodes.withColumn("band", F.floor(F.log(F.col("size")) / step))
    all_ = nodes.groupBy("root").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("grams"))

    def blocks():
        return F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")

    large = all_.filter((F.col("rows") > BLOCK_ROWS) | (F.col("grams") > BLOCK_GRAMS)).select("root")
    bands = (rows.join(large, "root").groupBy("root", "band")
             .agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("grams")).withColumn("k", blocks()))
    along = W.partitionBy("root").orderBy("band")
    bands = bands.select(
        "root", "band", "k",
        F.when(F.lead("band").over(along) == F.col("band") + 1, F.lead("k").over(along)).otherwise(0).alias("up"),
        F.when(F.lag("band").over(along) == F.col("band") - 1, F.lag("k").over(along)).otherwise(0).alias("down"))
    mine = F.pmod(F.col("node"), F.col("k")).cast("int")

    def upto(name: str):
        return F.slice(F.sequence(F.lit(0), F.greatest(F.col(name), F.lit(1)) - 1), 1, F.col(name))

    def key(band, i, j, higher):
        return F.concat_ws(":", band.cast("string"), i.cast("string"), j.cast("string"), F.lit(higher))

    keys = F.concat(
        F.transform(upto("k"), lambda j: key(F.col("band"), F.least(mine, j), F.greatest(mine, j), "=")),
        F.transform(upto("up"), lambda j: key(F.col("band"), mine, j, "+")),
        F.transform(upto("down"), lambda i: key(F.col("band") - 1, i, mine, "+")))
    cut = rows.join(bands, ["root", "band"], "left")
    return cut.select("node", "size", "root", F.when(F.col("k").isNull(), F.array(F.lit("all"))).otherwise(keys)
                      .alias("keys"))


class Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True


def block_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of all links among the sets, as row numbers.

    Rows are taken in order of size. A row's overlaps with all larger rows near enough in size are its line of the
    sparse product, added up over its columns; a pair is kept if the overlap reaches the bound of its two sizes.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets = [sets[i] for i in order]
    size = np.array([len(s) for s in sets], np.int64)
    rows = np.repeat(np.arange(len(sets)), size)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    rows, column = rows[shared], column[shared]
    cuts = np.searchsorted(rows, np.arange(len(sets) + 1))  # each row's columns
    by = np.argsort(column, kind="stable")
    posting, at = rows[by], np.searchsorted(column[by], np.arange(len(times) + 1))
    spot = np.empty(len(by), np.int64)
    spot[by] = np.arange(len(by))  # where a cell stands in its column's list, so that what follows are larger rows
    last = np.searchsorted(size, 100 * size // percent, "right")
    forest, links = Forest(len(sets)), []
    for i in range(len(sets)):
        cells = slice(cuts[i], cuts[i + 1])
        start, end = spot[cells] + 1, at[column[cells] + 1]
        n = end - start
        total = int(n.sum())
        if not total:
            continue
        shift = np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        other = posting[shift + np.arange(total)]
        other = other[other < last[i]]
        overlap = np.bincount(other, minlength=1)
        near = np.flatnonzero(overlap)
        bound = 100 * overlap[near] >= percent * (size[i] + size[near] - overlap[near])
        for j in near[bound].tolist():
            if forest.join(i, j):
                links.append((int(order[i]), int(order[j])))
    return links


def verified_links(docs: DataFrame, blocks: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes, a spanning forest per block pair. ``blocks`` has doc_id and text_hash of one text of
    each node, node, root and keys."""
    def sets_of(batches):
        for b in batches:
            grams = [found.view(np.int64) for found in gram_sets(b.column(0), n)]
            cuts = np.cumsum([0, *map(len, grams)])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], list_column(np.concatenate([*grams, np.zeros(0, np.int64)]), cuts)],
                names=["node", "root", "keys", "grams"])

    texts = docs.select("doc_id", "text_hash", "text").join(blocks, ["doc_id", "text_hash"])
    rows = texts.select("text", "node", "root", "keys").mapInArrow(
        sets_of, "node long, root long, keys array<string>, grams array<long>")
    rows = rows.select("node", "grams", "root", F.explode("keys").alias("key"))

    def product(table: pa.Table) -> pa.Table:
        node, first = np.unique(table.column("node").to_numpy(), return_index=True)
        values, cuts = joined(table.column("grams")), np.concatenate([[0], np.cumsum(list_sizes(
            table.column("grams")))])
        sets = [values[cuts[i]:cuts[i + 1]] for i in first]
        found = block_links(sets, percent)
        a, b = ([node[i] for i in side] for side in (zip(*found) if found else ((), ())))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("root", "key").applyInArrow(product, "a long, b long")


def ngram_classes(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """One row per row: doc_id, text_hash, n_shingles, and the class's first text by id and hash: first_id, first_hash.

    A null id is NO_ID here. Texts without words are classes of their own.
    """
    common, times = common_grams(docs, n)
    sets = stored(posted_sets(docs, n, percent, common, times), "sets")
    words = sets.filter(F.col("size") > 0)
    pick = F.min(F.struct("doc_id", "text_hash")).alias("pick")
    nodes = stored(words.groupBy("node").agg(pick, F.max("size").alias("size")).select("node", "pick.*", "size"), "nodes")
    least = sets.join(nodes.select("node", "doc_id", "text_hash"), ["node", "doc_id", "text_hash"])
    able = stored(sharing_nodes(least.dropDuplicates(["node"]), percent), "able")
    clusters = components(cluster_links(able, percent), "clusters")
    # Small tables are stored between the steps, so that no plan has the ones before in it several times.
    rooted = stored(nodes.select("node", "size").join(clusters, "node"), "rooted")
    blocks = block_keys(rooted, percent).select("node", "root", "keys").join(
        nodes.select("node", "doc_id", "text_hash"), "node")
    links = stored(verified_links(docs, blocks, n, percent), "verified")
    found = components(links, "components").join(nodes.select("node", "doc_id", "text_hash"), "node")
    firsts = found.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    linked = found.select("node", "root").join(firsts, "root").select("node", "first")
    of_node = stored(nodes.select("node", F.struct("doc_id", "text_hash").alias("own")).join(linked, "node", "left")
                     .select("node", F.coalesce("first", "own").alias("first")), "classes")
    rows = sets.select("doc_id", "text_hash", "node", F.col("size").alias("n_shingles")).join(of_node, "node", "left")
    first = F.when(F.col("n_shingles") > 0, F.col("first")).otherwise(F.struct("doc_id", "text_hash"))
    return rows.select("doc_id", "text_hash", "n_shingles", first["doc_id"].alias("first_id"),
                       first["text_hash"].alias("first_hash"))


def keyed_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), "text",
                       F.xxhash64("text").alias("text_hash"))


def ngram_components(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id, the smallest doc_id that links lead to.

    A link joins two texts whose sets of n-word shingles have a Jaccard likeness of ``percent`` or more. A text with
    fewer words is one shingle; a null text or one without words is linked with nothing and its own component. Equal
    texts are one node, however many; a row without doc_id has no part in the smallest id. Other columns are
    ignored, an empty table gives no rows.
    """
    found = ngram_classes(keyed_texts(docs), n, percent)
    return found.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_shingles",
                        F.nullif("first_id", F.lit(NO_ID)).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` with one row of each component, that of the smallest id. Texts without words all stay."""
    found = ngram_classes(keyed_texts(docs), n, percent)
    firsts = found.filter("n_shingles > 0 AND doc_id = first_id AND text_hash = first_hash").select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    keyed = docs.filter(has_word).select(
        F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.xxhash64("text").alias("hash"))
    kept = keyed.join(firsts, ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"])
    return kept.select("row.*").union(docs.filter(~has_word))
