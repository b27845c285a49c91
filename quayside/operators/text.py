"""Review text: tokens, phrases, vocabulary, TF-IDF, topics.

A document is one row with an id of its own, so work per document is bounded by that row. Everything over the
corpus is a group-by on terms or pairs with map-side counts.

Computed arrays are unfolded with the ``_outer`` generators and the empty rows filtered after: for the plain
ones the optimizer adds a filter on the array's size, which computes the array (the regex over every text) again.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quayside.functions.scalars import stable_hash
from quayside.operators.sampling import top_bottom_k
from quayside.operators.word_pairs import count_pairs
from quayside.plans.levels import fetch_small
from quayside.sources import stored

MAX_TERMS = 1_000_000
MAX_PHRASES = 4_000_000  # that are sent to the tasks, as 8 bytes each beside their words
MERGED_ROWS = 1_000  # whose words are merged at once


def _words(min_len: int) -> str:
    """Runs of at least ``min_len`` letters, digits or underscores that are not digits only."""
    char = r"[\p{L}\p{N}_]"
    return rf"((?!\p{{N}}+(?!{char})){char}{{{min_len},}})"


def tokenize(df: DataFrame, text_col: str, stop_words: list[str], min_len: int = 3,
             transform: Callable[[Column], Column] | None = None, out: str = "tokens") -> DataFrame:
    """Add the words of a text: lower case, no numbers, no short words, no stop words.

    ``transform`` maps one word (a Column) before the stop words are taken out, as a stemmer would.
    """
    words = F.regexp_extract_all(F.lower(text_col), F.lit(_words(min_len)))
    if transform is not None:
        words = F.transform(words, transform)
    if stop_words:
        words = F.filter(words, lambda t: ~t.isin(list(stop_words)))
    return df.withColumn(out, words)


# --- phrases -------------------------------------------------------------------------------------------


def _pairs(df: DataFrame, tokens: str, *keep: str) -> DataFrame:
    """(pos, token, next) for each word; the last word of a document has no next."""
    t = F.col(tokens)
    zipped = F.arrays_zip(t.alias("token"), F.slice(t, 2, F.greatest(F.size(t), F.lit(1))).alias("next"))
    return df.select(*keep, F.posexplode_outer(zipped).alias("pos", "_p")).select(
        *keep, "pos", F.col("_p.token").alias("token"), F.col("_p.next").alias("next")
    ).filter(F.col("token").isNotNull())


def find_phrases(df: DataFrame, tokens: str, min_count: int = 20, threshold: float = 10.0,
                 after: DataFrame | None = None) -> DataFrame:
    """(a, b, n, score) of adjacent (non-empty) words with n >= min_count and a score above the threshold.

    score = (n - min_count) * V / (n_a * n_b), V being the number of different words and pairs. With phrases to come
    ``after``, the words are counted as ``apply_phrases`` merges them, in the task that counts.
    """
    merge = None if after is None else _merger(after)
    if after is not None and merge is None:
        df = apply_phrases(df.select(F.lit(0).alias("_doc"), F.col(tokens)), "_doc", tokens, after)
    counted = stored(count_pairs(df, tokens, min_count, merge), "pairs")
    size = counted.filter(F.col("a").isNull()).agg(F.sum("n")).scalar()
    frequent = counted.filter(F.col("b").isNotNull())
    words = counted.filter(F.col("b").isNull() & F.col("a").isNotNull()).select("a", F.col("n").alias("n_word"))
    left = words.withColumnRenamed("n_word", "n_a")
    right = words.select(F.col("a").alias("b"), F.col("n_word").alias("n_b"))
    score = (F.col("n") - min_count) / F.col("n_a") / F.col("n_b") * F.col("_size")
    return (frequent.join(left, "a").join(right, "b").withColumn("_size", size)
            .select("a", "b", "n", score.alias("score")).filter(F.col("score") > threshold))


def apply_phrases(df: DataFrame, doc: str, tokens: str, phrases: DataFrame) -> DataFrame:
    """(doc, tokens) with phrase pairs merged to ``a_b``, greedily from the left; a document without words keeps none.

    Words are merged inside each row, by the set of the phrases, if there are at most MAX_PHRASES of them; more are
    joined word by word. Rows stay rows, also those with the same id.
    """
    merged = _merger(phrases)
    if merged is None:
        return stored(_apply_by_join(df.select(doc, tokens), doc, tokens, phrases), "merged", "zstd")

    @F.arrow_udf("array<string>")
    def merge(lists: pa.Array) -> pa.Array:
        return merged(lists)

    return df.select(doc, merge(F.col(tokens).cast("array<string>")).alias(tokens))


def _merger(phrases: DataFrame) -> Callable[[pa.Array], pa.Array] | None:
    """What merges lists of words; None for more than MAX_PHRASES."""
    known = phrases.select("a", "b").limit(MAX_PHRASES + 1).toArrow()
    if known.num_rows > MAX_PHRASES:
        return None
    names = pc.unique(pa.chunked_array([*known["a"].chunks, *known["b"].chunks], known["a"].type)).cast(pa.string())
    a, b = [_numbers(pc.index_in(known[c].cast(pa.string()), value_set=names)) for c in ("a", "b")]
    pairs = np.unique(a * len(names) + b)
    return lambda lists: _merged_in_slices(lists, names, pairs)


def _numbers(places: pa.Array) -> np.ndarray:
    """The place of each word among the names, -1 for another word."""
    return pc.fill_null(places, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _merged_in_slices(lists: pa.Array, names: pa.Array, pairs: np.ndarray) -> pa.Array:
    """``_merged`` slice by slice, so that the numbers beside the words stay few; the names are indexed once."""
    places = pc.index_in(lists.flatten().cast(pa.string()), value_set=names)
    merged, start = [], 0
    for i in range(0, len(lists), MERGED_ROWS):
        part = lists.slice(i, MERGED_ROWS)
        end = start + (pc.sum(pc.list_value_length(part)).as_py() or 0)
        merged.append(_merged(part, names, pairs, places.slice(start, end - start)))
        start = end
    return pa.concat_arrays(merged) if merged else pa.array([], pa.list_(pa.string()))


def _merged(lists: pa.Array, names: pa.Array, pairs: np.ndarray, places: pa.Array | None = None) -> pa.Array:
    """Lists of words with the pairs merged; ``pairs`` are sorted, the first word's number times the names and the second's.

    In a row of pairs that overlap, greedy merging takes the 1st, 3rd, 5th … ``places`` are those of the words among the
    names, if they are known.
    """
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    words = lists.flatten()
    code = _numbers(pc.index_in(words.cast(pa.string()), value_set=names) if places is None else places)
    if words.null_count:
        there = words.is_valid().to_numpy(zero_copy_only=False)
        row, code, words = row[there], code[there], words.drop_null()
    hit = np.zeros(len(words), bool)
    if len(words) > 1 and len(pairs):
        key = np.where((code[:-1] >= 0) & (code[1:] >= 0) & (row[:-1] == row[1:]), code[:-1] * len(names) + code[1:], -1)
        hit[:-1] = pairs[np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)] == key
    at = np.arange(len(words))
    start = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), at, 0)) if len(words) else at
    merges = hit & ((at - start) % 2 == 0)
    kept = ~np.append(False, merges[:-1])[:len(words)]
    first = np.flatnonzero(merges)
    out = words.cast(pa.string()).filter(pa.array(kept))
    if len(first):
        joined = pc.binary_join_element_wise(words.take(first).cast(pa.string()), words.take(first + 1).cast(pa.string()), "_")
        out = pc.replace_with_mask(out, pa.array(merges[kept]), joined)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(lists)))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), out)


def _apply_by_join(df: DataFrame, doc: str, tokens: str, phrases: DataFrame) -> DataFrame:
    """The same for any number of phrases, a row per word.

    Where phrase pairs overlap in a row (a b c with both a b and b c), greedy merging takes the 1st, 3rd,
    5th … pair of the run, so the position within the run decides; no word-by-word loop is needed.
    """
    # Numbered and stored, so that the numbers are the same wherever a row is read again.
    df = stored(df.select(F.monotonically_increasing_id().alias("_row"), doc, tokens), "numbered-words")
    words = F.filter(F.coalesce(tokens, F.array().cast("array<string>")), lambda t: t.isNotNull())
    df = df.withColumn(tokens, words)
    known = phrases.select(F.col("a").alias("token"), F.col("b").alias("next"), F.lit(True).alias("_hit"))
    rows = _pairs(df, tokens, "_row").join(known, ["token", "next"], "left")
    order = W.partitionBy("_row").orderBy("pos")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    rows = rows.withColumn("_hit", hit)
    opens = F.col("_hit") & ~F.coalesce(F.lag("_hit").over(order), F.lit(False))
    start = F.last(F.when(opens, F.col("pos")), ignorenulls=True).over(order)
    rows = rows.withColumn("_merge", F.col("_hit") & (F.pmod(F.col("pos") - start, F.lit(2)) == 0))
    rows = rows.withColumn("_used", F.coalesce(F.lag("_merge").over(order), F.lit(False)))
    word = F.when(F.col("_merge"), F.concat_ws("_", "token", "next")).otherwise(F.col("token"))
    merged = F.array_sort(F.collect_list(F.struct("pos", word.alias("w"))))
    found = rows.filter(~F.col("_used")).groupBy("_row").agg(merged.alias("_m"))
    return df.select("_row", doc).join(found, "_row", "left").select(
        doc, F.coalesce("_m.w", F.array().cast("array<string>")).alias(tokens))


def add_phrases(df: DataFrame, doc: str, tokens: str, min_count: int = 20, threshold: float = 10.0) -> DataFrame:
    """Append the two- and three-word phrases found to each document's words.

    A first pass merges pairs; a second pass, counted on the merged words, merges again (``a_b_c``). The rows are written
    out once, and merged anew each time they are read: that is cheap, and merged words take as much room as the words.
    """
    rows = stored(df, "words", "zstd")
    words = rows.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(tokens).alias("words"))
    first = stored(find_phrases(words, "words", min_count, threshold), "phrases")
    second = find_phrases(words, "words", min_count, threshold, after=first)
    again = apply_phrases(apply_phrases(words, "row", "words", first), "row", "words", second)
    extra = F.filter("words", lambda t: t.contains("_"))
    return again.select(*[(F.concat(F.col("row")[c], extra) if c == tokens else F.col("row")[c]).alias(c)
                          for c in df.columns])


# --- vocabulary and weights ----------------------------------------------------------------------------


def build_vocabulary(df: DataFrame, tokens: str, no_below: int = 30, no_above: float = 0.5,
                     keep_n: int = 20_000) -> DataFrame:
    """(id, term, df, cf): terms in at least ``no_below`` documents and at most a share of them.

    At most ``keep_n`` terms, those in most documents (ties by term). Ids follow the terms in order. The table
    is small by definition and used several times, so it is computed here, once.
    """
    # Sorting a document's words puts repeats side by side, so one pass counts words and documents.
    ordered = F.sort_array(tokens)
    before = F.concat(F.array(F.lit(None).cast("string")), ordered)
    rows = df.select(F.explode_outer(F.arrays_zip(ordered.alias("term"), before.alias("before"))).alias("w"))
    term, first = F.col("w.term"), ~F.col("w.term").eqNullSafe(F.col("w.before"))
    counted = (rows.filter(term.isNotNull()).groupBy(term.alias("term"))
               .agg(F.count_if(first).alias("df"), F.count(F.lit(1)).alias("cf")))
    docs = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    kept = (counted.withColumn("_n", docs)
            .filter((F.col("df") >= no_below) & (F.col("df") <= F.col("_n") * F.lit(no_above)))
            .orderBy(F.desc("df"), "term").limit(keep_n))
    # At most keep_n rows are numbered here.
    numbered = kept.withColumn("id", (F.row_number().over(W.orderBy("term")) - 1).cast("int"))
    return fetch_small(numbered.select("id", "term", "df", "cf"), keep_n)


def token_counts(vocab: DataFrame, n: int = 50) -> DataFrame:
    """The n least and the n most frequent terms."""
    return top_bottom_k(vocab.select("id", "term", "cf"), "cf", n, ["term"])


def _vocabulary_rows(vocab: DataFrame) -> list:
    """The terms, in id order, behind a size check; there may be none."""
    rows = vocab.select("id", "term", "df").limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError(f"a vocabulary has at most {MAX_TERMS} terms")
    return sorted(rows, key=lambda r: r.id)


def _long(vectors: DataFrame, doc: str, col: str, terms: list, out: str) -> DataFrame:
    """(doc, id, term, <out>) for the filled places of a sparse vector."""
    v = F.unwrap_udt(col)
    filled = F.arrays_zip(v["indices"].alias("id"), v["values"].alias(out))
    names = vectors.sparkSession.createDataFrame([(t.id, t.term) for t in terms], "id int, term string")
    return (vectors.select(doc, F.inline_outer(filled)).filter(F.col("id").isNotNull())
            .join(F.broadcast(names), "id").select(doc, "id", "term", out))


def _count_vectors(df: DataFrame, tokens: str, terms: list, out: str) -> DataFrame:
    """Add the counts of the terms; a row without words (a null text has none) has an empty vector."""
    if not terms:
        return df.withColumn(out, array_to_vector(F.array().cast("array<double>")))
    held = F.filter(F.coalesce(tokens, F.array().cast("array<string>")), lambda t: t.isNotNull())
    counter = CountVectorizerModel.from_vocabulary([t.term for t in terms], "_held", out)
    return counter.transform(df.withColumn("_held", held)).drop("_held")


def bag_of_words(df: DataFrame, doc: str, tokens: str, vocab: DataFrame) -> DataFrame:
    """(doc, id, term, tf) over the vocabulary, counted where the documents are, without a shuffle."""
    terms = _vocabulary_rows(vocab)
    counted = _long(_count_vectors(df, tokens, terms, "_tf"), doc, "_tf", terms, "tf")
    return counted.withColumn("tf", F.col("tf").cast("bigint"))


def _weigh(df: DataFrame, tokens: str, terms: list, out: str) -> DataFrame:
    if not terms:
        return _count_vectors(_count_vectors(df, tokens, terms, "_w"), tokens, terms, out)
    n = df.count()
    idf = Vectors.dense([math.log2(n / t.df) for t in terms])
    scale = ElementwiseProduct(scalingVec=idf, inputCol="_tf", outputCol="_w")
    unit = Normalizer(p=2.0, inputCol="_w", outputCol=out)
    return unit.transform(scale.transform(_count_vectors(df, tokens, terms, "_tf"))).drop("_tf")


def tfidf(df: DataFrame, doc: str, tokens: str, vocab: DataFrame) -> DataFrame:
    """(doc, id, term, weight): tf * log2(N / df), each document scaled to length 1, zero weights left out."""
    terms = _vocabulary_rows(vocab)
    weights = _long(_weigh(df, tokens, terms, "features"), doc, "features", terms, "weight")
    return weights.filter(F.abs("weight") > 1e-12)


def tfidf_vectors(df: DataFrame, tokens: str, vocab: DataFrame, out: str = "features") -> DataFrame:
    """Add the TF-IDF weights of ``tfidf`` as a sparse vector, and the same before scaling as ``_w``."""
    return _weigh(df, tokens, _vocabulary_rows(vocab), out)


def corpus_size(bow: DataFrame, doc: str) -> DataFrame:
    """Documents with a term of the vocabulary, and terms that occur."""
    terms = bow.select("id").distinct().agg(F.count(F.lit(1)).alias("n_terms"))
    docs = bow.select(doc).distinct().agg(F.count(F.lit(1)).alias("n_docs"))
    return docs.withColumn("n_terms", terms.scalar())


# --- topics --------------------------------------------------------------------------------------------


def fit_lda(vectors: DataFrame, topics: int = 10, batches: int = 5, passes: int = 4, seed: int = 48,
            features: str = "features"):
    """Online variational LDA: ``batches`` mini-batches in each of ``passes`` times over the corpus.

    Every mini-batch is drawn by a scan of all vectors, so their number is the same at every size.
    """
    data = vectors.select(features).cache()
    try:
        lda = LDA(k=topics, optimizer="online", subsamplingRate=1.0 / batches, maxIter=passes * batches,
                  featuresCol=features, seed=seed)
        return lda.fit(data)
    finally:
        data.unpersist()


def top_terms(model, vocab: DataFrame, n: int = 20) -> DataFrame:
    """(topic, rank, id, term, weight) of the n heaviest terms of each topic."""
    pairs = F.arrays_zip(F.col("termIndices").alias("id"), F.col("termWeights").alias("weight"))
    rows = model.describeTopics(n).select("topic", F.posexplode(pairs).alias("_r", "_p"))
    rows = rows.select("topic", (F.col("_r") + 1).alias("rank"), F.col("_p.id").alias("id"),
                       F.col("_p.weight").alias("weight"))
    return rows.join(vocab.select("id", "term"), "id").select("topic", "rank", "id", "term", "weight")


def topic_coherence(bow: DataFrame, doc: str, topic_terms: DataFrame, n_docs: int) -> DataFrame:
    """UMass coherence per topic: mean over term pairs of log((D_ij / N + 1e-12) / (D_j / N)), j above i.

    ``topic_terms`` has (topic, rank, id), a few terms per topic, each of which occurs somewhere. A document is
    cut down to the topic terms it holds, and yields one row per wanted pair among them.
    """
    t = topic_terms.select("topic", "rank", "id")
    upper = t.select("topic", F.col("rank").alias("rank_j"), F.col("id").alias("id_j"))
    # A term paired with itself gives D_j in the same count.
    pairs = (t.withColumnsRenamed({"rank": "rank_i", "id": "id_i"}).join(upper, "topic")
             .filter(F.col("rank_j") <= F.col("rank_i")))
    wanted = pairs.select("id_i", "id_j").distinct()
    # At most one entry per topic term, of which there are a few per topic.
    held = (bow.select(doc, "id").join(t.select("id").distinct(), "id", "left_semi")
            .groupBy(doc).agg(F.collect_set("id").alias("ids")))
    met = (held.select(F.explode("ids").alias("id_i"), "ids").join(wanted, "id_i")
           .filter(F.array_contains("ids", F.col("id_j")))
           .groupBy("id_i", "id_j").agg(F.count(F.lit(1)).alias("d")))
    counted = pairs.join(met, ["id_i", "id_j"], "left").withColumn("d", F.coalesce("d", F.lit(0)))
    alone = (counted.filter(F.col("rank_i") == F.col("rank_j"))
             .select("topic", "rank_j", F.col("d").alias("d_j")))
    n = F.lit(n_docs)
    term = F.log((F.col("d") / n + F.lit(1e-12)) / (F.col("d_j") / n))
    return (counted.filter(F.col("rank_j") < F.col("rank_i")).join(alone, ["topic", "rank_j"])
            .groupBy("topic").agg(F.avg(term).alias("coherence")).orderBy(F.desc("coherence")))


def mean_coherence(coherence: DataFrame) -> DataFrame:
    return coherence.agg(F.avg("coherence").alias("mean_coherence"))


def _topic_rows(scored: DataFrame, keys: list[str]) -> DataFrame:
    share = vector_to_array("topicDistribution")
    return scored.select(*keys, F.posexplode(share).alias("topic", "weight"))


def topics_by_group(model, vectors: DataFrame, group: str, weights: str = "_w") -> DataFrame:
    """(group, topic, weight) of each group's joined texts.

    Joining texts adds their word weights, so the vectors are summed per group (map side first) and the
    texts themselves are never brought together.
    """
    joined = vectors.groupBy(group).agg(Summarizer.sum(F.col(weights)).alias("_sum"))
    unit = Normalizer(p=2.0, inputCol="_sum", outputCol="features").transform(joined)
    return _topic_rows(model.transform(unit), [group])


def topics_by_sentiment(model, vectors: DataFrame, group: str, label: str) -> DataFrame:
    """(group, label, topic, weight): mean topic weight of the group's texts with that label."""
    rows = _topic_rows(model.transform(vectors), [group, label])
    return rows.groupBy(group, label, "topic").agg(F.avg("weight").alias("weight"))


def before_after_sample(df: DataFrame, raw: str, tokens: str, key: str, label: str, seed: int = 48) -> DataFrame:
    """One random row per class, raw text beside its words.

    The keys are drawn first, without the texts; only the drawn rows are then read and split into words.
    """
    drawn = (df.filter(F.col(label).isNotNull()).groupBy(label)
             .agg(F.min(F.struct(stable_hash(F.col(key), seed).alias("h"), F.col(key).alias("k"))).alias("_d")))
    keys = [r[0] for r in fetch_small(drawn.select("_d.k")).collect()]
    return df.filter(F.col(key).isin(keys)).select(label, key, raw, tokens)
