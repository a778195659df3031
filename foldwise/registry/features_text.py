"""Check queries for text stages (X1-X6) and the word-vector source."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.text import (PUNCT_CLASS, TOKEN_RE, WHITESPACE_CLASS, CountVectorizer, TextStatistics,
                              TfidfVectorizer, WordVectorPool, embed_batches, hashed_trigram_encoder,
                              pool_token_embeddings, words)
from ..session import scratch_path
from ..sources.io import read_word_vectors, table, write_word_vectors
from . import register, tidy

WS = WHITESPACE_CLASS + "+"


def _q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _stats_sql(c):
    t = f"coalesce({c}, '')"
    w = f"list_filter(regexp_split_to_array({t}, {_q(WS)}), lambda x: x <> '')"
    return ",\n  ".join([
        f"CAST(length({t}) AS BIGINT) AS {c}_text_length",
        f"CAST(len({w}) AS BIGINT) AS {c}_word_count",
        f"CAST(len(list_distinct({w})) AS BIGINT) AS {c}_unique_word_count",
        f"round(length(regexp_replace({t}, {_q(WS)}, '', 'g')) / (len({w}) + 1e-6), 6) AS {c}_avg_word_length",
        f"CAST(len(regexp_extract_all({t}, '[.!?]')) + 1 AS BIGINT) AS {c}_sentence_count",
        f"CAST(len(regexp_extract_all({t}, {_q(PUNCT_CLASS)})) AS BIGINT) AS {c}_punctuation_count",
        f"CAST(len(regexp_extract_all({t}, '[A-Z]')) AS BIGINT) AS {c}_uppercase_count"])


@register("text_stats", f"SELECT doc_id,\n  {_stats_sql('text')}\nFROM documents")
def q_text_stats(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return tidy(TextStatistics("x1", ["text"]).transform(d).drop("text"))


@register("text_stats_conversations", f"""
SELECT conv_id, CAST(turn AS BIGINT) AS turn,\n  {_stats_sql('text')}\nFROM conversations""")
def q_text_stats_conversations(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return tidy(TextStatistics("x1c", ["text"]).transform(c).drop("text"))


def _bow_sql(kind: str, min_df: int, max_df: float, max_features: int) -> str:
    value = ("CAST(tc.tf AS DOUBLE)" if kind == "countvec" else
             "tc.tf * (ln((1.0 + n.n) / (vk.df + 1)) + 1) / sqrt(sum(power(tc.tf * (ln((1.0 + n.n) / (vk.df + 1)) + 1), 2)) "
             "OVER (PARTITION BY tc.doc_id))")
    return f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), {_q(TOKEN_RE)})) AS term FROM documents),
tc AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
n AS (SELECT count(*) AS n FROM documents),
v AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tc GROUP BY term),
vk AS (SELECT term, df FROM v, n WHERE df >= {min_df} AND df <= floor({max_df} * n.n)
       ORDER BY cf DESC, term LIMIT {max_features})
SELECT tc.doc_id, '{kind}_text_' || tc.term AS feature, round({value}, 6) AS value
FROM tc JOIN vk ON tc.term = vk.term, n"""


@register("count_vectorize", _bow_sql("countvec", 2, 0.9, 2000))
def q_count_vectorize(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    st = CountVectorizer("x2", "text", "doc_id", min_df=2, max_df=0.9, max_features=2000)
    return tidy(st.fit(d).transform(d))


@register("tfidf", _bow_sql("tfidf", 2, 0.9, 2000))
def q_tfidf(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    st = TfidfVectorizer("x3", "text", "doc_id", min_df=2, max_df=0.9, max_features=2000)
    return tidy(st.fit(d).transform(d))


@register("count_vectorize_bigrams", f"""
WITH k AS (SELECT conv_id * 1000 + turn AS msg_id, regexp_extract_all(lower(coalesce(text, '')), {_q(TOKEN_RE)}) AS w
           FROM conversations),
t AS (SELECT msg_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM k),
tc AS (SELECT msg_id, term, count(*) AS tf FROM t GROUP BY msg_id, term),
vk AS (SELECT term FROM tc GROUP BY term HAVING count(*) >= 2 ORDER BY sum(tf) DESC, term LIMIT 5000)
SELECT msg_id, 'countvec_text_' || term AS feature, CAST(tf AS DOUBLE) AS value FROM tc JOIN vk USING (term)""")
def q_count_vectorize_bigrams(spark, sf):
    """Unigrams + bigrams over conversation turns."""
    c = (table(spark, sf, "conversations")
         .select((F.col("conv_id") * 1000 + F.col("turn")).alias("msg_id"), "text"))
    st = CountVectorizer("x2b", "text", "msg_id", ngram_range=(1, 2), min_df=2, max_features=5000)
    return tidy(st.fit(c).transform(c))


@register("feature_build_text", f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), {_q(TOKEN_RE)})) AS term FROM documents),
vk AS (SELECT term FROM t GROUP BY term ORDER BY count(*) DESC, term LIMIT 50),
s AS (SELECT doc_id, count(*) AS n FROM t JOIN vk USING (term) GROUP BY doc_id)
SELECT d.doc_id, d.source, CAST(coalesce(s.n, 0) AS DOUBLE) AS total, CAST(length(d.text) AS BIGINT) AS n_text
FROM documents d LEFT JOIN s USING (doc_id)""")
def q_feature_build_text(spark, sf):
    """P1 with a bag of words: every row and column stays, one vector column
    is added, and the next stage still finds its input."""
    from pyspark.ml.functions import vector_to_array

    from ..operators.custom import ExpressionStage
    from ..plans.flows import FeatureSetBuilder

    d = table(spark, sf, "documents").select("doc_id", "source", "text")
    stages = [CountVectorizer("x2", "text", "doc_id", max_features=50),
              ExpressionStage("n", {"n_text": "char_length(text)"})]
    out, _ = FeatureSetBuilder(stages).run(d)
    total = F.aggregate(vector_to_array("countvec_text"), F.lit(0.0), lambda a, x: a + x)
    return tidy(out.select("doc_id", "source", total.alias("total"), "n_text"))


# ------------------------------------------------------------------ word vectors
DIM = 8


def word_vectors_from(docs):
    """A (word, vec) table derived from the documents' vocabulary: each
    lower-case whitespace token gets an 8-dim vector from its md5 bytes."""
    from ..session import spread

    vocab = spread(docs.select("text")).select(F.explode(words(F.lower(F.col("text")))).alias("word")).distinct()
    h = F.md5(F.col("word"))
    vec = F.array(*[((F.conv(F.substring(h, 2 * i + 1, 2), 16, 10).cast("int") - 128) / 128.0).cast("float")
                    for i in range(DIM)])
    return vocab.select("word", vec.alias("vec"))


def _vec_sql():
    dims = ", ".join(f"(CAST(('0x' || substr(md5(word), {2 * i + 1}, 2)) AS INTEGER) - 128) / 128.0 AS v{i}"
                     for i in range(DIM))
    return f"""vocab AS (SELECT DISTINCT word FROM (SELECT unnest(regexp_split_to_array(lower(text), {_q(WS)})) AS word
                                           FROM documents) WHERE word <> ''),
vec AS (SELECT word, {dims} FROM vocab)"""


@register("read_word_vectors", f"WITH {_vec_sql()}\nSELECT word, " + ", ".join(
    f"round(v{i}, 6) AS v{i}" for i in range(DIM)) + " FROM vec")
def q_read_word_vectors(spark, sf):
    """Write the derived vectors in word2vec text form, read them back."""
    path = scratch_path(spark, "wordvec")
    write_word_vectors(word_vectors_from(table(spark, sf, "documents")), path)
    back = read_word_vectors(spark, path)
    return tidy(back.select("word", *[F.col("vec")[i].alias(f"v{i}") for i in range(DIM)]))


def _pool_sql():
    aggs = ", ".join([f"avg(v{i}) AS m{i}" for i in range(DIM)] + [f"max(v{i}) AS x{i}" for i in range(DIM)])
    outs = ", ".join([f"round(coalesce(g.m{i}, 0), 6) AS text_mean_dim_{i}" for i in range(DIM)]
                     + [f"round(coalesce(g.x{i}, 0), 6) AS text_max_dim_{i}" for i in range(DIM)])
    return f"""
WITH {_vec_sql()},
tok AS (SELECT conv_id * 1000 + turn AS msg_id, unnest(regexp_split_to_array(lower(text), {_q(WS)})) AS word
        FROM conversations),
g AS (SELECT msg_id, {aggs} FROM tok JOIN vec ON tok.word = vec.word GROUP BY msg_id)
SELECT c.conv_id * 1000 + c.turn AS msg_id, {outs}
FROM conversations c LEFT JOIN g ON c.conv_id * 1000 + c.turn = g.msg_id"""


@register("word_vector_pool", _pool_sql())
def q_word_vector_pool(spark, sf):
    """Conversation turns pooled with vectors derived from the documents."""
    vec = word_vectors_from(table(spark, sf, "documents"))
    c = (table(spark, sf, "conversations")
         .select((F.col("conv_id") * 1000 + F.col("turn")).alias("msg_id"), "text"))
    st = WordVectorPool("x4", ["text"], vec, "msg_id", agg_methods=("mean", "max"))
    return tidy(st.fit(c).transform(c))


# ------------------------------------------------------------------ X5, X6
@register("token_embedding_pool", """
WITH e AS (SELECT label, vec_id, CAST(embedding[1] >= 0 AS DOUBLE) AS m, embedding FROM embeddings),
x AS (SELECT label, m, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding) AS v FROM e)
SELECT CAST(label AS BIGINT) AS label, CAST(dim AS BIGINT) AS dim, round(sum(v * m) / greatest(sum(m), 1e-9), 6) AS value
FROM x GROUP BY label, dim""")
def q_token_embedding_pool(spark, sf):
    """X5 mean pooling: each label is a sequence, its rows the tokens (ordered
    by vec_id); mask = first component ≥ 0."""
    e = table(spark, sf, "embeddings").withColumn("mask", (F.col("embedding")[0] >= 0).cast("int"))
    p = pool_token_embeddings(e, "label", "vec_id", "embedding", "mask", "mean", "pooled")
    return tidy(p.select("label", F.posexplode("pooled").alias("dim", "value")))


@register("token_embedding_cls", """
WITH f AS (SELECT label, arg_min(embedding, vec_id) AS emb FROM embeddings GROUP BY label)
SELECT CAST(label AS BIGINT) AS label, CAST(generate_subscripts(emb, 1) - 1 AS BIGINT) AS dim,
  round(CAST(unnest(emb) AS DOUBLE), 6) AS value FROM f""")
def q_token_embedding_cls(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("mask", F.lit(1))
    p = pool_token_embeddings(e, "label", "vec_id", "embedding", "mask", "cls", "pooled")
    return tidy(p.select("label", F.posexplode("pooled").alias("dim", "value")))


@register("embed_batches")
def q_embed_batches(spark, sf):
    """Whole documents through a caller-supplied batch encoder (rows-only)."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    out = embed_batches(d, "text", hashed_trigram_encoder(16), 16)
    return out.select("doc_id", F.size("embedding").alias("dim"),
                      F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), 6).alias("sq_norm"))
