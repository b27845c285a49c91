"""Text and topics."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from quayside.catalog.fixtures import STOP_WORDS, TOKENS, VOCAB
from quayside.catalog.registry import query
from quayside.operators import text as X
from quayside.sources import read_table, spread, stored


def tokens(spark, sf) -> DataFrame:
    docs = spread(read_table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))
    return X.tokenize(docs, "text", STOP_WORDS)


def bow_of(spark, sf):
    docs = stored(tokens(spark, sf).drop("text"), "tokens")  # read for the vocabulary and for the vectors
    vocab = X.build_vocabulary(docs, "tokens")
    return docs, vocab, X.bag_of_words(docs, "doc_id", "tokens", vocab)


@query("tokenize", f"WITH {TOKENS} SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM toks")
def _(spark, sf):
    return tokens(spark, sf).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


def _phrases_sql(toks: str, n: str = "") -> str:
    """Scored pairs of a table with a token list, as s<n>."""
    return f"""
w{n} AS (SELECT term, count(*) AS n FROM (SELECT unnest(tokens) AS term FROM {toks}) GROUP BY 1),
p{n} AS (SELECT z[1] AS a, z[2] AS b, count(*) AS n FROM (SELECT unnest(list_zip(tokens, tokens[2:])) AS z FROM {toks})
      WHERE z[2] IS NOT NULL GROUP BY 1, 2),
s{n} AS (SELECT a, b, p.n, (p.n - 20) / wa.n / wb.n * ((SELECT count(*) FROM w{n}) + (SELECT count(*) FROM p{n})) AS score
      FROM p{n} p JOIN w{n} wa ON wa.term = a JOIN w{n} wb ON wb.term = b WHERE p.n >= 20)
"""


PHRASES = _phrases_sql("toks")


@query("find_phrases", f"""
WITH {TOKENS}, {PHRASES} SELECT a, b, CAST(n AS BIGINT) AS n, score FROM s WHERE score > 10""", {"score": 8})
def _(spark, sf):
    return X.find_phrases(tokens(spark, sf), "tokens")


# Word by word: a word joins the one before it if the two are a phrase and that one is not a merged pair (marked
# with a character that no word holds).
def _merged_sql(toks: str, n: str = "") -> str:
    return f"""
known{n} AS (SELECT list(a || ' ' || b) AS k FROM s{n} WHERE score > 10),
steps{n} AS (SELECT doc_id, list_reduce(list_transform(tokens, lambda t: {{'done': '', 'open': t}}),
  lambda acc, x: CASE WHEN NOT contains(acc.open, '|') AND list_contains(k, acc.open || ' ' || x.open)
    THEN {{'done': acc.done, 'open': acc.open || '|' || x.open}}
    ELSE {{'done': acc.done || acc.open || ' ', 'open': x.open}} END) AS r FROM {toks}, known{n} WHERE len(tokens) > 0),
merged{n} AS (SELECT doc_id, string_split(replace(r.done || r.open, '|', '_'), ' ') AS tokens FROM steps{n}
  UNION ALL SELECT doc_id, [] AS tokens FROM {toks} WHERE len(tokens) = 0)
"""


MERGED = _merged_sql("toks")


@query("apply_phrases", f"""
WITH {TOKENS}, {PHRASES}, {MERGED} SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM merged""")
def _(spark, sf):
    docs = tokens(spark, sf)
    merged = X.apply_phrases(docs, "doc_id", "tokens", X.find_phrases(docs, "tokens"))
    return merged.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query("add_phrases", f"""
WITH {TOKENS}, {PHRASES}, {MERGED}, {_phrases_sql("merged", "2")}, {_merged_sql("merged", "2")}
SELECT doc_id, array_to_string(list_concat(toks.tokens, list_filter(coalesce(merged2.tokens, []),
  lambda t: contains(t, '_'))), ' ') AS tokens FROM toks LEFT JOIN merged2 USING (doc_id)""")
def _(spark, sf):
    return X.add_phrases(tokens(spark, sf).drop("text"), "doc_id", "tokens").select(
        "doc_id", F.array_join("tokens", " ").alias("tokens"))


@query("build_vocabulary", f"WITH {VOCAB} SELECT * FROM vocab")
def _(spark, sf):
    return X.build_vocabulary(tokens(spark, sf), "tokens")


@query("token_counts", f"""
WITH {VOCAB}
SELECT * FROM (SELECT id, term, cf, 'top' AS "end" FROM vocab ORDER BY cf DESC, term LIMIT 50)
UNION ALL SELECT * FROM (SELECT id, term, cf, 'bottom' FROM vocab ORDER BY cf, term LIMIT 50)""")
def _(spark, sf):
    return X.token_counts(X.build_vocabulary(tokens(spark, sf), "tokens"))


@query("bag_of_words", f"WITH {VOCAB} SELECT * FROM bow")
def _(spark, sf):
    return bow_of(spark, sf)[2]


TFIDF = """
raw AS (SELECT doc_id, bow.id, bow.term, tf * log2((SELECT count(*) FROM toks) / d) AS w
  FROM bow JOIN (SELECT id, count(*) AS d FROM bow GROUP BY 1) q ON q.id = bow.id),
weights AS (SELECT doc_id, id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw WHERE abs(w) > 1e-12)
"""


# Rows without a text have no words and stay documents.
@query("bag_of_words_null_text", f"""
WITH {VOCAB.replace("FROM documents", "FROM (SELECT * REPLACE (CASE WHEN doc_id % 7 <> 0 THEN text END AS text) FROM documents)")}
SELECT doc_id, id, term, tf FROM bow""")
def _(spark, sf):
    rows = read_table(spark, sf, "documents").withColumn("text", F.when(F.col("doc_id") % 7 != 0, F.col("text")))
    docs = stored(X.tokenize(rows.select("doc_id", "text"), "text", STOP_WORDS), "tokens")
    return X.bag_of_words(docs, "doc_id", "tokens", X.build_vocabulary(docs, "tokens"))


@query("tfidf", f"WITH {VOCAB}, {TFIDF} SELECT * FROM weights", {"weight": 8})
def _(spark, sf):
    docs = tokens(spark, sf)
    return X.tfidf(docs, "doc_id", "tokens", X.build_vocabulary(docs, "tokens"))


@query("corpus_size", f"""
WITH {VOCAB} SELECT CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs, CAST(count(DISTINCT id) AS BIGINT) AS n_terms FROM bow""")
def _(spark, sf):
    return X.corpus_size(bow_of(spark, sf)[2], "doc_id")


@query("tfidf_vectors", f"""
WITH {VOCAB}, n AS (SELECT count(*) AS n FROM toks),
raw AS (SELECT doc_id, tf * log2((SELECT n FROM n) / df) AS w FROM bow JOIN vocab USING (id))
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_terms, sum(w) / sqrt(sum(w * w)) AS weight_sum FROM raw GROUP BY 1""",
       {"weight_sum": 8})
def _(spark, sf):
    docs, vocab, _bow = bow_of(spark, sf)
    weights = F.filter(vector_to_array("features"), lambda w: w > 0)
    rows = X.tfidf_vectors(docs, "tokens", vocab).select("doc_id", weights.alias("w"))
    return rows.filter(F.size("w") > 0).select(
        "doc_id", F.size("w").alias("n_terms"), F.aggregate("w", F.lit(0.0), lambda a, w: a + w).alias("weight_sum"))


def topics(spark, sf):
    docs = tokens(spark, sf)
    vocab = X.build_vocabulary(docs, "tokens")
    vectors = X.tfidf_vectors(docs, "tokens", vocab)
    return X.fit_lda(vectors, topics=10, passes=4), vectors, vocab


@query("fit_lda")
def _(spark, sf):
    model, vectors, _vocab = topics(spark, sf)
    share = F.col("topicDistribution").cast("string")
    return model.transform(vectors).select("doc_id", share.alias("topics"))


@query("fit_lda_shares", "SELECT doc_id, 10 AS n_topics, true AS adds_up FROM documents")
def _(spark, sf):
    model, vectors, _vocab = topics(spark, sf)
    share = vector_to_array("topicDistribution")
    total = F.aggregate(share, F.lit(0.0), lambda a, w: a + w)
    return model.transform(vectors).select(
        "doc_id", F.size(share).alias("n_topics"), ((F.abs(total - 1) < 1e-9) | (total == 0)).alias("adds_up"))


@query("top_terms")
def _(spark, sf):
    model, _vectors, vocab = topics(spark, sf)
    return X.top_terms(model, vocab, 20)


@query("topic_coherence", f"""
WITH {VOCAB},
ranked AS (SELECT id % 3 AS topic, id, row_number() OVER (PARTITION BY id % 3 ORDER BY df DESC, term) AS r FROM vocab),
t AS (SELECT * FROM ranked WHERE r <= 8),
p AS (SELECT i.topic, i.id AS a, j.id AS b FROM t i JOIN t j ON i.topic = j.topic AND j.r < i.r),
d AS (SELECT id, count(*)::DOUBLE AS d FROM bow GROUP BY 1),
c AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM bow x JOIN bow y USING (doc_id) WHERE x.id IN (SELECT id FROM t)
  AND y.id IN (SELECT id FROM t) GROUP BY 1, 2),
n AS (SELECT count(*)::DOUBLE AS n FROM documents)
SELECT topic, avg(ln((coalesce(c, 0) / n + 1e-12) / (d / n))) AS coherence
FROM p LEFT JOIN c USING (a, b) JOIN d ON d.id = p.b, n GROUP BY 1""", {"coherence": 8})
def _(spark, sf):
    from pyspark.sql import Window as W
    docs, vocab, bow = bow_of(spark, sf)
    topic = F.col("id") % 3
    ranked = vocab.select(topic.alias("topic"), "id", F.row_number().over(
        W.partitionBy(topic).orderBy(F.desc("df"), "term")).alias("rank"))
    return X.topic_coherence(bow, "doc_id", ranked.filter("rank <= 8"), docs.count())


@query("mean_coherence")
def _(spark, sf):
    model, _vectors, vocab = topics(spark, sf)
    docs = tokens(spark, sf)
    bow = X.bag_of_words(docs, "doc_id", "tokens", vocab)
    return X.mean_coherence(X.topic_coherence(bow, "doc_id", X.top_terms(model, vocab, 20), docs.count()))


@query("topics_by_group")
def _(spark, sf):
    model, vectors, _vocab = topics(spark, sf)
    return X.topics_by_group(model, vectors, "source")


@query("topics_by_sentiment")
def _(spark, sf):
    model, vectors, _vocab = topics(spark, sf)
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    return X.topics_by_sentiment(model, vectors.join(labels, "doc_id"), "source", "quality")


@query("before_after_sample", """
WITH h AS (SELECT doc_id, quality, text, row_number() OVER (PARTITION BY quality ORDER BY
  ('0x' || substr(md5(doc_id || '|48'), 1, 13))::BIGINT, doc_id) AS r FROM documents JOIN labels USING (doc_id))
SELECT quality, doc_id, text FROM h WHERE r = 1""")
def _(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    rows = tokens(spark, sf).join(labels, "doc_id")
    return X.before_after_sample(rows, "text", "tokens", "doc_id", "quality").drop("tokens")
