"""Check queries of this subpackage: one `opN_<name>` per operator, run over its
whole tables, and the equivalent DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe_chunks, cover_tree, decontam, importance, langid, line_dedup, mixing, ngram_join, preference, rlz, suffix_dedup, toxicity
from .common import is_held_out, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


# ------------------------------------------------------------------ 9
_WORDS9 = ("list_filter(regexp_split_to_array(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           "'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')")
OP9_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS9.format(t='text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS9.format(t='text')} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, i, dw.n AS n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@register("op9_benchmark_decontamination", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark items."""
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                      "contaminated")


# ------------------------------------------------------------------ 2
_WORDS = "list_filter(regexp_split_to_array({t}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
OP2_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format(t='text')}, []) AS w FROM documents),
g AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN f USING (g) WHERE doc_id > low),
w AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d WHERE len(w) > 0),
k AS (SELECT w.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept
      FROM w ANTI JOIN r ON w.doc_id = r.doc_id AND w.p = r.p GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@register("op2_substring_dedup_rlz", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document after removing what smaller documents hold."""
    return rlz.factor(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


# ------------------------------------------------------------------ 8
@register("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document after removing repeated 200-byte strings."""
    return suffix_dedup.repeats_removed(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


# ------------------------------------------------------------------ 6
@register("op6_source_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 7
@register("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a network trained on the rows not held out."""
    docs = table(spark, sf_dir, "documents")
    fit = docs.where(~is_held_out("doc_id")).select(F.col("doc_id").alias("id"), "text", "lang")
    return langid.predict(docs, langid.train(fit)).select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score")


# ------------------------------------------------------------------ 1
TOXIC_AT = 0.3


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the rows not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~is_held_out("doc_id")))
    return toxicity.score(docs, model).select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), F.size("segments").cast("long").alias("n_segments"))


# ------------------------------------------------------------------ 5
_LOW = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP5_SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, coalesce({_WORDS.format(t=_LOW.format(t='text'))}, []) AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(list_slice(w, i, i + 4)) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
                    FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 75 * (na.n + nb.n - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""


@register("op5_ngram_jaccard_join", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of 5-word shingles."""
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))[0]


# ------------------------------------------------------------------ 10
@register("op10_line_dedup_minhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text left of every document when one line of each group of similar lines stays."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


# ------------------------------------------------------------------ 3
OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
  coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""


@register("op3_embedding_near_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors of one label with a cosine of 0.98."""
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"))


# ------------------------------------------------------------------ 4
_RENDER = ("array_to_string(list_transform({t}, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>'"
           " || chr(10)), '')")
_SPANS = ("array_to_string(list_filter(list_transform(range(1, len({t}) + 1), lambda i: CASE WHEN {t}[i].role = 'assistant' THEN "
          "CAST(length(prompt) + coalesce(list_sum(list_transform({t}[1:i - 1], lambda y: length(y.role) + length(y.text) + 24)), 0)"
          " + length({t}[i].role) + 13 AS BIGINT) || ':' || (length({t}[i].text) + 10) END), lambda z: z IS NOT NULL), ',')")
OP4_SQL = f"""
WITH p AS (
  SELECT conv_id // 2 AS pair_id,
    coalesce(list({{'role': role, 'text': text}} ORDER BY turn, role, text) FILTER (conv_id % 2 = 0), []) AS a,
    coalesce(list({{'role': role, 'text': text}} ORDER BY turn, role, text) FILTER (conv_id % 2 = 1), []) AS b
  FROM conversations GROUP BY 1),
n AS (
  SELECT *, coalesce(nullif(list_position(list_transform(range(1, least(len(a), len(b)) + 1),
    lambda i: a[i] = b[i]), false), 0) - 1, least(len(a), len(b))) AS k FROM p),
r AS (SELECT pair_id, k, {_RENDER.format(t='a[1:k]')} AS prompt, a[k + 1:] AS ca, b[k + 1:] AS cb FROM n)
SELECT pair_id, CAST(k AS BIGINT) AS n_common, prompt, {_RENDER.format(t='ca')} AS chosen_completion,
  {_RENDER.format(t='cb')} AS rejected_completion, {_SPANS.format(t='ca')} AS chosen_mask,
  {_SPANS.format(t='cb')} AS rejected_mask
FROM r
"""


@register("op4_preference_formatting", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt, completions and masks of every pair of conversations."""
    out = preference.format_pairs(preference.conversation_pairs(table(spark, sf_dir, "conversations")))
    spans = (lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["at"], s["n"])), ","))
    return out.select("pair_id", F.col("n_common").cast("long").alias("n_common"), "prompt", "chosen_completion",
                      "rejected_completion", spans("chosen_mask").alias("chosen_mask"),
                      spans("rejected_mask").alias("rejected_mask"))


# ------------------------------------------------------------------ 12
OP12_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce({_WORDS9.format(t='text')}, []) AS w FROM documents),
e AS (SELECT {_WORDS9.format(t='text')} AS w FROM benchmark WHERE text IS NOT NULL),
fd AS MATERIALIZED (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
fb AS MATERIALIZED (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM e),
c AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
    CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END)) AS crc),
b AS MATERIALIZED (
  SELECT f, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(range(1, len(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT)),
    lambda x, y: xor(x >> 8, crc[(xor(x, y) & 255) + 1]))) % 10000 AS b
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM fd UNION SELECT f FROM fb)), c),
s AS (SELECT b, count(*) AS s FROM fd JOIN b USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM fb JOIN b USING (f) GROUP BY b),
g AS (SELECT s.b AS b, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM fd) + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT count(*) FROM fb) + 10000)::DOUBLE))) AS BIGINT) AS g FROM s LEFT JOIN t ON s.b = t.b),
w AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(g) AS BIGINT) AS z
      FROM fd JOIN b USING (f) JOIN g USING (b) GROUP BY doc_id),
o AS (SELECT d.doc_id, len(w) >= 20 AS fit, coalesce(n, 0) AS n_features,
        coalesce((z - ((z % n) + n) % n) // n, 0) AS weight,
        CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
          / 4294967296::DOUBLE))) AS BIGINT) AS noise FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY weight + noise DESC, doc_id) AS k FROM o)
SELECT doc_id, n_features, weight, weight + noise AS score,
  CASE WHEN fit AND k <= (SELECT 25 * count(*) // 100 FROM o WHERE fit) THEN k END AS rank
FROM r
"""


@register("op12_importance_resampling", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and noisy score of every document, and the ranks of those drawn."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])


# ------------------------------------------------------------------ 11
@register("op11_cross_tokenizer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and corpus-wide link counts of every document's tokens."""
    import public_tokenizers

    aligned = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    aligned = stored(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.link_scores(aligned).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                                 "groups_sha256")


# ------------------------------------------------------------------ 13
@register("op13_bpe_chunk_reuse")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text that they decode to."""
    import public_tokenizers

    vocab = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe_chunks.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocab)
    return bpe_chunks.decode(ids, vocab).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
