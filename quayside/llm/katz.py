"""Katz backoff: Good-Turing discounted counts of words and word pairs, and weights that make each context sum to one.

Words are 64-bit hashes, but for the most frequent ones, at most MAX_COMMON, which every task knows with their counts
and which have small numbers. What isn't known to every task travels as sorted arrays by bucket: pairs whose second
word is rare go by that word, so that its count and its probability are at hand; pairs with a frequent second word go
by their first word, or by both if that is very frequent. Two such exchanges are made. The first counts pairs per
task, and gives the numbers of pairs by count, the most frequent pairs, and the backoff table. The second brings each
text's other pairs to their counts and sums up per text; the most frequent pairs are scored where the text is. A text
costs two exchanges of its rarer pairs, whatever the size of the tables.

For a pair seen c times after a context seen C times, P = d(c) * c / C. Else P = alpha * P(word), where alpha is what
the seen pairs leave over, divided by the probability of the words not seen after the context. d is Good and Turing's
for counts to 5; larger counts keep all but a thousandth, so that something is left in every context. Words that
are not in the table share what the discounted word counts leave over.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from quayside.llm.common import joined, list_column, list_sizes, mix, most_frequent
from quayside.llm.word_hashes import column_words
from quayside.sources.tables import stored

MAX_COMMON, MAX_PAIRS = 1 << 18, 1 << 20
LEAST_PAIR = 8  # a pair seen less often is never among the most frequent ones
CHUNK_TOKENS = 600_000  # what a task sorts at once
TOP, LARGE = 5, 0.999
END, START = 0, 1  # numbers of the end, a word, and of the beginning, a context only
END_HASH = np.uint64(0x6A09E667F3BCC908)  # the end among the counted words
RARE = np.uint64(1 << 63)  # set in the codes of rare words


def discounts(times: dict[int, int]) -> np.ndarray:
    """d for counts 0 to 5 (0 is unused), then for larger ones. ``times`` has how many items have each count.

    Where Good and Turing's value is not between 0 and 1, as in a small table, half a count is taken off.
    """
    out = np.array([1.0, *[(r - 0.5) / r for r in range(1, TOP + 1)], LARGE])
    if times.get(1):
        rest = (TOP + 1) * times.get(TOP + 1, 0) / times[1]
        for r in range(1, TOP + 1):
            if times.get(r) and times.get(r + 1) and rest < 1:
                d = ((r + 1) * times[r + 1] / times[r] / r - rest) / (1 - rest)
                if 0 < d < 1:
                    out[r] = d
    return out


@dataclass
class Words:
    """What each task knows about words: totals, discounts, and the frequent words with their counts."""

    total: int  # training tokens
    distinct: int
    texts: int  # training texts
    d: np.ndarray
    unknown: float  # probability of all unknown words together
    hashes: np.ndarray  # of the frequent words, by number from 2 on
    counts: np.ndarray  # by number: the end, the beginning (texts), the frequent words

    def p(self, counts: np.ndarray) -> np.ndarray:
        """The probability of a word seen so often."""
        d = self.d[np.minimum(counts, TOP + 1)]
        return np.where(counts > 0, d * counts / max(self.total, 1), self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


class Codes:
    """Codes of word hashes: the number of a frequent word, else the hash with the top bit set."""

    def __init__(self, words: Words):
        order = np.argsort(words.hashes)
        self.keys, self.numbers = words.hashes[order], (order + 2).astype(np.uint64)
        self.slots = np.searchsorted(self.keys >> np.uint64(44), np.arange((1 << 20) + 1, dtype=np.uint64))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = hashes | RARE
        if not len(self.keys):
            return out
        slot = (hashes >> np.uint64(44)).astype(np.int64)
        at, end, left = self.slots[slot], self.slots[slot + 1], np.arange(len(hashes))
        while True:
            open_ = at < end
            at, end, left = at[open_], end[open_], left[open_]
            if not len(left):
                return out
            hit = self.keys[at] == hashes[left]
            out[left[hit]] = self.numbers[at[hit]]
            at, end, left = at[~hit] + 1, end[~hit], left[~hit]


def chunks(column, codes: Codes):
    """Runs of texts with about CHUNK_TOKENS tokens: the first text, tokens per text, the codes of all tokens, each
    text's last being the end, and of the token before each."""
    parts, counts, first, size, past = [], [], 0, 0, 0

    def whole():
        n = np.concatenate(counts)
        ends = np.cumsum(n + 1) - 1
        w = np.empty(int(n.sum()) + len(n), np.uint64)
        inner = np.ones(len(w), bool)
        inner[ends] = False
        w[inner], w[ends] = codes(np.concatenate(parts)), END
        h = np.empty_like(w)
        h[1:], h[0] = w[:-1], START
        h[ends[:-1] + 1] = START
        return first, n + 1, w, h

    for _, past, hashes, n in column_words(column):
        for at in range(0, len(n), 10_000):
            some = n[at:at + 10_000]
            begin = int(n[:at].sum())
            parts.append(hashes[begin:begin + int(some.sum())])
            counts.append(some)
            size += int(some.sum())
            done = past - len(n) + at + len(some)
            if size >= CHUNK_TOKENS or done - first > 10_000:
                yield whole()
                parts, counts, first, size = [], [], done, 0
    if counts:
        yield whole()


def bucket_order(at: np.ndarray, w: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by bucket and then, roughly, by word, and where each bucket begins."""
    near = np.where(is_rare(w), w >> np.uint64(24), w)  # 40 bits, words keep together
    order = np.argsort(at << np.uint64(40) | near)
    return order, np.searchsorted(at[order], np.arange(buckets + 1, dtype=np.uint64))


def pair_key(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(h) + w)


def is_rare(codes: np.ndarray) -> np.ndarray:
    return codes >= RARE


def code_lists(codes: np.ndarray, cuts: np.ndarray) -> list[pa.ListArray]:
    """Codes as two list columns: numbers (-1 for a rare word), and the hashes of the rare words in order."""
    rare = is_rare(codes)
    small = np.where(rare, np.uint64(0), codes).astype(np.int32)
    small[rare] = -1
    return [list_column(small, cuts), list_column(codes[rare].view(np.int64), np.concatenate([[0], np.cumsum(rare)])[cuts])]


def from_lists(small, large) -> np.ndarray:
    small = joined(small)
    out = small.astype(np.uint64)
    out[small < 0] = joined(large).view(np.uint64)
    return out


def word_counts(train: DataFrame) -> DataFrame:
    """word (hash, signed) and n over all tokens; each task ships its counts as arrays by bucket."""
    buckets = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches):
        for b in batches:
            for first, last, hashes, _ in column_words(b.column(0)):
                h, n = np.unique(hashes, return_counts=True)
                yield from dealt(np.append(h, END_HASH), np.append(n, last - first))

    def dealt(h, n):
        at = mix(h) % np.uint64(buckets)
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(buckets + 1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets, dtype=np.int32)),
                                          list_column(h[order].view(np.int64), cuts), list_column(n[order], cuts)],
                                         names=["bucket", "words", "times"])

    def add(table: pa.Table) -> pa.Table:
        word, at = np.unique(joined(table.column("words")), return_inverse=True)
        return pa.table({"word": word, "n": np.bincount(at, joined(table.column("times")), len(word)).astype(np.int64)})

    parts = train.select("text").mapInArrow(count, "bucket int, words array<long>, times array<long>")
    return parts.groupBy("bucket").applyInArrow(add, "word long, n long")


def known_words(counts: DataFrame, texts: int) -> Words:
    by_count = [F.count_if(F.col("n") == r).alias(f"n{r}") for r in range(1, TOP + 2)]
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("n").alias("v"), *by_count).first()
    d = discounts({r: total[f"n{r}"] for r in range(1, TOP + 2)})
    kept = counts.agg(F.sum(F.element_at(F.array(*map(F.lit, d.tolist())),
                                         F.least("n", F.lit(TOP + 1)).cast("int") + 1) * F.col("n"))).first()[0] or 0.0
    rows = most_frequent(counts.filter(F.col("word") != int(END_HASH.astype(np.int64))), MAX_COMMON)
    hashes, n = rows.column("word").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    return Words(total["n"], total["v"], texts, d, 1.0 - kept / total["n"] if total["n"] else 1.0, hashes,
                 np.concatenate([[texts, texts], n]).astype(np.int64))


PAIRS = ", ".join(["kind int", "h long", "w long", "n long", "s double", *[f"n{r} long" for r in range(1, TOP + 1)]])
CONTEXT, TIMES, PAIR = 0, 1, 2


def pair_counts(train: DataFrame, words: Words) -> DataFrame:
    """Pairs counted: rows of kind CONTEXT (h, n, s, n1 to n5: a part of what follows h), TIMES (n pairs that have the
    count h) and PAIR (h, w, n, if n is LEAST_PAIR or more)."""
    buckets = 3 * int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = words.total / buckets  # a context so frequent is dealt by its pairs

    def count(batches):
        codes = Codes(words)
        for b in batches:
            for _, _, w, h in chunks(b.column(0), codes):
                key, first, n = np.unique(pair_key(h, w), return_index=True, return_counts=True)
                w, h = w[first], h[first]
                often = ~is_rare(h)
                often[often] = words.counts[h[often].astype(np.int64)] >= hot
                at = np.where(is_rare(w), mix(w), np.where(often, key, mix(h))) % np.uint64(buckets)
                order, cuts = bucket_order(at, w, buckets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(buckets, dtype=np.int32)), *code_lists(w[order], cuts),
                     *code_lists(h[order], cuts), list_column(n[order].astype(np.int32), cuts)],
                    names=["bucket", "w32", "w64", "h32", "h64", "n"])

    def add(t: pa.Table) -> pa.Table:
        w, h = from_lists(t["w32"], t["w64"]), from_lists(t["h32"], t["h64"])
        _, first, at = np.unique(pair_key(h, w), return_index=True, return_inverse=True)
        n = np.bincount(at, joined(t["n"]), len(first)).astype(np.int64)
        w, h = w[first], h[first]
        rare = is_rare(w)
        seen = np.zeros(len(w), np.int64)
        seen[~rare] = words.counts[w[~rare].astype(np.int64)]
        _, by_word = np.unique(w[rare], return_inverse=True)
        seen[rare] = np.bincount(by_word, n[rare]).astype(np.int64)[by_word] if rare.any() else 0
        context, by = np.unique(h, return_inverse=True)
        k = len(context)
        much = n >= LEAST_PAIR
        times = np.bincount(np.minimum(n, TOP + 2), minlength=TOP + 3)[1:TOP + 2]
        zeros, m = np.zeros(len(times) + int(much.sum()), np.int64), len(times)
        return pa.table({
            "kind": np.repeat(np.int32([CONTEXT, TIMES, PAIR]), [k, m, int(much.sum())]),
            "h": np.concatenate([context.view(np.int64), np.arange(1, m + 1), h[much].view(np.int64)]),
            "w": np.concatenate([np.zeros(k + m, np.int64), w[much].view(np.int64)]),
            "n": np.concatenate([np.bincount(by, n, k).astype(np.int64), times.astype(np.int64), n[much]]),
            "s": np.concatenate([np.bincount(by, words.p(seen), k), zeros.astype(float)]),
            **{f"n{r}": np.concatenate([np.bincount(by[n == r], minlength=k).astype(np.int64), zeros])
               for r in range(1, TOP + 1)}})

    schema = "bucket int, w32 array<int>, w64 array<long>, h32 array<int>, h64 array<long>, n array<int>"
    return train.select("text").mapInArrow(count, schema).groupBy("bucket").applyInArrow(add, PAIRS)


def backoff_table(pairs: DataFrame, d: np.ndarray) -> DataFrame:
    """h, n (how often it was seen), alpha: its backoff weight."""
    sums = (pairs.filter(F.col("kind") == CONTEXT).groupBy("h")
            .agg(*[F.sum(c).alias(c) for c in ["n", "s", *[f"n{r}" for r in range(1, TOP + 1)]]]))
    low = sum((F.col(f"n{r}") * r for r in range(1, TOP + 1)), F.lit(0))
    kept = sum((F.col(f"n{r}") * (r * float(d[r])) for r in range(1, TOP + 1)), (F.col("n") - low) * LARGE)
    return sums.select("h", "n", ((F.col("n") - kept) / F.col("n") / (F.lit(1.0) - F.col("s"))).alias("alpha"))


@dataclass
class Pairs:
    """What each task knows about pairs: discounts, the frequent pairs, and backoff weights of frequent contexts."""

    d: np.ndarray
    keys: np.ndarray  # sorted
    counts: np.ndarray
    log_alpha: np.ndarray  # by the context's number; 0 where it was never seen

    def log_seen(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the discounted count."""
        return np.log10(self.d[np.minimum(counts, TOP + 1)] * counts)


def known_pairs(pairs: DataFrame, backoff: DataFrame, d: np.ndarray, words: Words) -> Pairs:
    rows = most_frequent(pairs.filter((F.col("kind") == PAIR) & (F.col("w") >= 0)).select("h", "w", "n"), MAX_PAIRS)
    key = pair_key(rows.column("h").to_numpy().view(np.uint64), rows.column("w").to_numpy().view(np.uint64))
    order = np.argsort(key)
    near = backoff.filter(F.col("h") >= 0).select("h", "alpha").toArrow()  # frequent contexts, at most MAX_COMMON + 2
    log_alpha = np.zeros(len(words.counts))
    log_alpha[near.column("h").to_numpy()] = np.log10(near.column("alpha").to_numpy())
    return Pairs(d, key[order], rows.column("n").to_numpy()[order], log_alpha)


PARTS = ("base long, idx array<short>, x array<double>, y array<double>, known array<int>, far array<long>, "
         "far_idx array<short>, doc_id array<long>, tokens array<long>, held array<boolean>")


def text_parts(docs: DataFrame, words: Words, pairs: Pairs) -> DataFrame:
    """Parts of the texts' sums. ``base`` names an Arrow batch of texts, ``idx`` a text in it; x is the model's part, y
    the base score's, known the known tokens'; far are the rare contexts of unseen pairs, whose weights are missing.
    One row per batch has doc_id, tokens and held of its texts."""
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    log_count = np.log10(np.maximum(words.counts, 1))

    def cut(batches):
        codes, number = Codes(words), 0
        for b in batches:
            for first, tokens, w, h in chunks(b.column(1), codes):
                base = TaskContext.get().partitionId() << 32 | number
                number += 1
                yield from one(b.slice(first, len(tokens)), base, tokens, w, h)

    def one(b, base, tokens, w, h):
        doc = np.repeat(np.arange(b.num_rows), tokens)
        held = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
        near = ~is_rare(w)
        count = np.zeros(len(w), np.int64)
        count[near] = words.counts[w[near].astype(np.int64)]
        context = near & (w != END)
        x = -np.bincount(doc[context], log_count[w[context].astype(np.int64)], b.num_rows) - log_count[START]
        y = np.bincount(doc[near], words.base(count[near]), b.num_rows)
        known = np.bincount(doc[near & (count > 0)], minlength=b.num_rows).astype(np.int32)
        # Frequent pairs are scored here.
        key = pair_key(h, w)
        if len(pairs.keys):
            at = np.minimum(np.searchsorted(pairs.keys, key), len(pairs.keys) - 1)
            here = near & (pairs.keys[at] == key)
            x += np.bincount(doc[here], pairs.log_seen(pairs.counts[at[here]]), b.num_rows)
            w, h, doc, key = w[~here], h[~here], doc[~here], key[~here]
        order, cuts = bucket_order(np.where(is_rare(w), mix(w), key) % np.uint64(buckets), w, buckets)
        mark = np.where(held[doc], doc, -1 - doc).astype(np.int16)[order]  # texts that the counts are from: below 0
        none = pa.nulls(buckets, pa.list_(pa.int64()))
        names = ["bucket", "base", "w32", "w64", "h32", "h64", "mark", "x", "y", "known", "doc_id", "tokens", "held"]
        empty = [pa.nulls(buckets, pa.list_(t)) for t in (pa.float64(), pa.float64(), pa.int32())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(buckets, dtype=np.int32)), pa.array(np.full(buckets, base)),
             *code_lists(w[order], cuts), *code_lists(h[order], cuts), list_column(mark, cuts), *empty,
             none, none, pa.nulls(buckets, pa.list_(pa.bool_()))], names=names)
        one_list = np.array([0, b.num_rows])
        lists = [pa.nulls(1, pa.list_(t)) for t in (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int16())]
        ids = pa.ListArray.from_arrays(pa.array(one_list.astype(np.int32)), b.column(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([base % buckets], pa.int32()), pa.array([base], pa.int64()), *lists, list_column(x, one_list),
             list_column(y, one_list), list_column(known, one_list), ids, list_column(tokens, one_list),
             list_column(held, one_list)], names=names)

    def meet(t: pa.Table) -> pa.Table:
        whole = t.filter(t["doc_id"].is_valid())
        t = t.filter(t["mark"].is_valid())
        w, h = from_lists(t["w32"], t["w64"]), from_lists(t["h32"], t["h64"])
        mark, base = joined(t["mark"]).astype(np.int64), t["base"].to_numpy()
        bases, place = np.unique(base, return_inverse=True)
        place = np.repeat(place, list_sizes(t["mark"]))
        train = mark < 0
        doc = np.where(train, -1 - mark, mark)
        _, at = np.unique(pair_key(h, w), return_inverse=True)
        pair = np.bincount(at[train], minlength=int(at.max()) + 1 if len(at) else 0)[at]
        rare = is_rare(w)
        count = np.zeros(len(w), np.int64)
        count[~rare] = words.counts[w[~rare].astype(np.int64)]
        _, by_word = np.unique(w[rare], return_inverse=True)
        if len(by_word):
            count[rare] = np.bincount(by_word[train[rare]], minlength=int(by_word.max()) + 1)[by_word]
        x = np.where(pair > 0, pairs.log_seen(np.maximum(pair, 1)), np.log10(words.p(count)))
        x -= np.where(rare & (count > 0), np.log10(np.maximum(count, 1)), 0.0)  # the word is the next one's context
        near = (pair == 0) & ~is_rare(h)
        number = h[near].astype(np.int64)
        x[near] += pairs.log_alpha[number] + log_count[number]
        y, far = np.where(rare, words.base(count), 0.0), (pair == 0) & is_rare(h)
        # One row per batch of texts.
        slot, by = np.unique(place << 16 | doc, return_inverse=True)
        cuts = np.searchsorted(slot >> 16, np.arange(len(bases) + 1))
        far_cuts, order = None, np.argsort(place[far], kind="stable")
        far_cuts = np.searchsorted(place[far][order], np.arange(len(bases) + 1))
        k = len(slot)
        out = pa.table([
            pa.array(bases), list_column((slot & 0xFFFF).astype(np.int16), cuts), list_column(np.bincount(by, x, k), cuts),
            list_column(np.bincount(by, y, k), cuts),
            list_column(np.bincount(by[rare & (count > 0)], minlength=k).astype(np.int32), cuts),
            list_column(h[far][order].view(np.int64), far_cuts),
            list_column(doc[far][order].astype(np.int16), far_cuts),
            pa.nulls(len(bases), pa.list_(pa.int64())), pa.nulls(len(bases), pa.list_(pa.int64())),
            pa.nulls(len(bases), pa.list_(pa.bool_()))], names=NAMES)
        sizes = list_sizes(whole["x"])
        idx = np.concatenate([np.arange(n) for n in sizes] or [np.zeros(0)]).astype(np.int16)
        none = [pa.nulls(len(whole), pa.list_(pa.int64())), pa.nulls(len(whole), pa.list_(pa.int16()))]
        more = pa.table([whole["base"], list_column(idx, np.concatenate([[0], np.cumsum(sizes)])), whole["x"], whole["y"],
                         whole["known"], *none, whole["doc_id"], whole["tokens"], whole["held"]], names=NAMES)
        return pa.concat_tables([out, more.cast(out.schema)])

    schema = ("bucket int, base long, w32 array<int>, w64 array<long>, h32 array<int>, h64 array<long>, "
              "mark array<short>, x array<double>, y array<double>, known array<int>, doc_id array<long>, "
              "tokens array<long>, held array<boolean>")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "held_out")
    return rows.mapInArrow(cut, schema).groupBy("bucket").applyInArrow(meet, PARTS)


NAMES = ["base", "idx", "x", "y", "known", "far", "far_idx", "doc_id", "tokens", "held"]


def sum_texts(t: pa.Table) -> pa.Table:
    """The sums of one batch of texts."""
    whole = t.filter(t["doc_id"].is_valid()).combine_chunks()
    n = int(list_sizes(whole["x"]).sum())
    idx = joined(t["idx"]).astype(np.int64)
    x, y, known = (np.bincount(idx, joined(t[c]), n) for c in ("x", "y", "known"))
    flat = {c: whole[c].combine_chunks().flatten() for c in ("doc_id", "tokens", "held")}
    return pa.table({"base": pa.array(np.full(n, t["base"][0].as_py(), np.int64)), "idx": np.arange(n, dtype=np.int16),
                     "doc_id": flat["doc_id"], "held_out": flat["held"], "n_tokens": flat["tokens"],
                     "n_known": known.astype(np.int64), "base_score": y, "part": x})


@dataclass
class KatzModel:
    words: Words
    pairs: Pairs
    backoff: DataFrame


def fit_katz(train: DataFrame) -> KatzModel:
    """Count words and pairs over all rows of ``train``; the tables are written to the shared folder."""
    texts = train.count()
    words = known_words(stored(word_counts(train), "words"), texts)
    pairs = stored(pair_counts(train, words), "pairs")
    times = {r["h"]: r["n"] for r in pairs.filter(F.col("kind") == TIMES).groupBy("h").agg(F.sum("n").alias("n")).collect()}
    d = discounts(times)
    backoff = stored(backoff_table(pairs, d), "backoff")
    return KatzModel(words, known_pairs(pairs, backoff, d, words), backoff)


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, held_out): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score. The model learns from the rows that are not held out.

    Tokens are the words, A-Z lower-cased, and one end. A null or empty text is the end alone. Equal rows have equal
    scores and all count. Without any training text all words are unknown, with probability one. Other columns are
    ignored, an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))
    model = fit_katz(docs.filter(~F.col("held_out")))
    parts = stored(text_parts(docs, model.words, model.pairs), "parts")
    rows = parts.groupBy("base").applyInArrow(
        sum_texts, "base long, idx short, doc_id long, held_out boolean, n_tokens long, n_known long, "
                   "base_score double, part double")
    far = parts.select("base", F.explode(F.arrays_zip("far", "far_idx")).alias("p")).select(
        "base", F.col("p.far_idx").alias("idx"), F.col("p.far").alias("h"))
    weights = (far.groupBy("h", "base", "idx").agg(F.count(F.lit(1)).alias("k")).join(model.backoff, "h")
               .groupBy("base", "idx").agg(F.sum((F.log10("alpha") + F.log10("n")) * F.col("k")).alias("more")))
    return rows.join(weights, ["base", "idx"], "left").select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "held_out", "n_tokens", "n_known",
        F.lit(model.words.total).cast("bigint").alias("train_tokens"), "base_score",
        (F.col("part") + F.coalesce("more", F.lit(0.0))).alias("score"))
