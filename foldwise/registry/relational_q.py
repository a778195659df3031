"""Check queries for sources / sinks (S1-S5), projections and predicates
(R1-R12), joins and set operations (J1-J6, J8) and the meta-table /
pseudo-label plumbing (P5, P7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.base import require_columns
from ..operators.categorical import WoEEncoder, CountFrequencyEncoder, RareCategoryCombiner
from ..operators.groups import GroupStats
from ..operators.numeric import BoxCoxTransformer, NumCatInteraction
from ..operators.text import TextStatistics
from ..plans.flows import build_meta_table, confident_rows, prediction_columns, pseudo_label_round
from ..session import scratch_path
from ..sources.io import (read_csv, read_feature_list, read_parquet, table, write_feature_list,
                          write_feature_set, write_predictions)
from . import register, tidy

# ------------------------------------------------------------------ S1-S5
_CUSTOMER_SCHEMA = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@register("read_csv", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, "
                      "round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer")
def q_read_csv(spark, sf):
    """The customer table written as header CSV, scanned back with a schema."""
    path = scratch_path(spark, "csv")
    table(spark, sf, "customer").write.option("header", "true").csv(path)
    return tidy(read_csv(spark, path, _CUSTOMER_SCHEMA))


@register("read_parquet", "SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders "
                          "WHERE o_orderstatus = 'F'")
def q_read_parquet(spark, sf):
    """Pruned, filtered scan (the filter reaches the parquet reader)."""
    o = read_parquet(spark, f"{sf}/orders.parquet")
    return tidy(o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice"))


@register("write_feature_set", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS text_text_length,
       CAST(len(regexp_extract_all(text, '[A-Z]')) AS BIGINT) AS text_uppercase_count, 'train' AS split
FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
UNION ALL
SELECT doc_id, CAST(length(text) AS BIGINT), CAST(len(regexp_extract_all(text, '[A-Z]')) AS BIGINT), 'test'
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_write_feature_set(spark, sf):
    """S3: labelled documents = train, the rest = test; features written as
    `<set>/split=train|test` parquet and read back (split from the path)."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    lab = table(spark, sf, "labels").select("doc_id")
    train, test = d.join(lab, "doc_id", "left_semi"), d.join(lab, "doc_id", "left_anti")
    st = TextStatistics("s3", ["text"], ["text_length", "uppercase_count"])
    out = scratch_path(spark, "features")
    write_feature_set(st.transform(train).drop("text"), st.transform(test).drop("text"), out, "docs_v1")
    return tidy(read_parquet(spark, f"{out}/docs_v1"))


@register("write_predictions", """
SELECT d.doc_id, round(least(d.n_chars / 20000.0, 1.0), 6) AS quality FROM documents d""")
def q_write_predictions(spark, sf):
    """An `(id, prediction)` submission CSV written and read back."""
    d = table(spark, sf, "documents").withColumn("p", F.least(F.col("n_chars") / 20000.0, F.lit(1.0)))
    path = scratch_path(spark, "preds")
    write_predictions(d, "doc_id", "p", path, out_name="quality")
    return tidy(read_csv(spark, path, "doc_id BIGINT, quality DOUBLE"))


@register("write_feature_list", """
WITH c AS (SELECT 'l_quantity' AS feature, abs(corr(l_quantity, l_extendedprice)) AS v FROM lineitem
           UNION ALL SELECT 'l_discount', abs(corr(l_discount, l_extendedprice)) FROM lineitem
           UNION ALL SELECT 'l_tax', abs(corr(l_tax, l_extendedprice)) FROM lineitem)
SELECT feature FROM c ORDER BY v DESC, feature LIMIT 2""")
def q_write_feature_list(spark, sf):
    """The top-2 features by |corr| written one per line, read back."""
    li = table(spark, sf, "lineitem")
    imp = li.select(*[F.abs(F.corr(c, "l_extendedprice")).alias(c) for c in ("l_quantity", "l_discount", "l_tax")])
    longf = imp.unpivot([], ["l_quantity", "l_discount", "l_tax"], "feature", "v")
    top = longf.orderBy(F.desc("v"), F.asc("feature")).limit(2)
    path = scratch_path(spark, "featlist")
    write_feature_list(top, path)
    names = read_feature_list(spark, path)
    return spark.createDataFrame([(n,) for n in names], "feature string")


# ------------------------------------------------------------------ R1-R12
@register("select_features_cols", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
                                  "round(l_quantity, 6) AS l_quantity, round(l_discount, 6) AS l_discount FROM lineitem")
def q_select_features_cols(spark, sf):
    """R1 (+R12): project a configured list after checking it exists."""
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount"]
    li = table(spark, sf, "lineitem")
    require_columns(li, cols, "select")
    return tidy(li.select(*cols))


@register("all_but_id_target", "SELECT CAST(n_chars AS BIGINT) AS n_chars, lang, source FROM documents")
def q_all_but_id_target(spark, sf):
    """R2 + R4: everything except the id and the (text) target."""
    return tidy(table(spark, sf, "documents").drop("doc_id", "text"))


_META_SQL = """
a AS (SELECT doc_id, least(n_chars / 20000.0, 1.0) AS pred_a FROM documents),
b AS (SELECT d.doc_id, 1 / (1 + exp(-(d.n_chars - 2000) / 1000.0)) AS pred_b FROM documents d
      JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT doc_id, CAST(('0x' || substr(md5(text), 1, 4)) AS INTEGER) / 65535.0 AS pred_c FROM documents),
m AS (SELECT a.doc_id, pred_a, pred_b, pred_c, l.quality FROM a LEFT JOIN b ON a.doc_id = b.doc_id
      LEFT JOIN c ON a.doc_id = c.doc_id LEFT JOIN labels l ON a.doc_id = l.doc_id)"""


def _model_predictions(spark, sf):
    """Three synthetic model outputs keyed by doc_id (model b only scored the
    labelled documents, so the chain join leaves NULLs)."""
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels")
    a = d.select("doc_id", F.least(F.col("n_chars") / 20000.0, F.lit(1.0)).alias("p"))
    b = d.join(lab.select("doc_id"), "doc_id").select(
        "doc_id", (1 / (1 + F.exp(-(F.col("n_chars") - 2000) / 1000.0))).alias("p"))
    c = d.select("doc_id", (F.conv(F.substring(F.md5("text"), 1, 4), 16, 10).cast("int") / 65535.0).alias("p"))
    return {"a": a, "b": b, "c": c}, lab


@register("build_meta_table", f"WITH {_META_SQL}\nSELECT doc_id, round(pred_a, 6) AS pred_a, round(pred_b, 6) AS pred_b, "
                              "round(pred_c, 6) AS pred_c, CAST(quality AS BIGINT) AS quality FROM m")
def q_build_meta_table(spark, sf):
    """P5 = J4 chain left join + R5 renames + J5 target."""
    preds, lab = _model_predictions(spark, sf)
    return tidy(build_meta_table(preds, "doc_id", "p", lab, "quality"))


@register("prefix_projection", f"WITH {_META_SQL}\nSELECT round(pred_a, 6) AS pred_a, round(pred_b, 6) AS pred_b, "
                               "round(pred_c, 6) AS pred_c FROM m")
def q_prefix_projection(spark, sf):
    """Only the `pred_` columns of the meta table."""
    preds, lab = _model_predictions(spark, sf)
    meta = build_meta_table(preds, "doc_id", "p", lab, "quality")
    return tidy(meta.select(*prediction_columns(meta)))


@register("rename_prediction", "SELECT doc_id, round(least(n_chars / 20000.0, 1.0), 6) AS pred_lgbm FROM documents")
def q_rename_prediction(spark, sf):
    """R5."""
    preds, _ = _model_predictions(spark, sf)
    return tidy(preds["a"].withColumnRenamed("p", "pred_lgbm"))


@register("confident_filter", """
SELECT doc_id, round(p, 6) AS p, CAST(p > 0.5 AS BIGINT) AS pseudo_label
FROM (SELECT doc_id, least(n_chars / 20000.0, 1.0) AS p FROM documents) WHERE p > 0.3 OR p < 0.05""")
def q_confident_filter(spark, sf):
    """R6."""
    preds, _ = _model_predictions(spark, sf)
    return tidy(confident_rows(preds["a"], "p", 0.3, 0.05))


@register("date_cutoff_filter", "SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1995-06-30'")
def q_date_cutoff_filter(spark, sf):
    """Literal predicate, pushed to the parquet scan."""
    return table(spark, sf, "orders").where(F.col("o_orderdate") <= F.lit("1995-06-30")).select("o_orderkey")


@register("range_filter", """
SELECT CAST(event_id AS BIGINT) AS event_id FROM events
WHERE date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) > 10
  AND date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) <= 17""")
def q_range_filter(spark, sf):
    """(start, end] on a day number."""
    from ..functions.exprs import day_number

    d = day_number("ts", "2024-01-01")
    return tidy(table(spark, sf, "events").where((d > 10) & (d <= 17)).select("event_id"))


@register("isin_semi", """
WITH k AS (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) >= 35)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN l_partkey IN (SELECT l_partkey FROM k) THEN CAST(l_partkey AS VARCHAR) ELSE 'Other' END AS l_partkey
FROM lineitem""")
def q_isin_semi(spark, sf):
    """R9 via the state-table join."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    st = RareCategoryCombiner("r9", ["l_partkey"], min_count=35)
    return tidy(st.fit(li).transform(li))


@register("binary_only_assert", """
WITH e AS (SELECT event_type, CAST(value > 50 AS INT) AS y FROM events)
SELECT 'kept' AS target, CAST(count(*) AS BIGINT) AS n_rows FROM e WHERE y IN (0, 1)
UNION ALL SELECT 'three values', CAST(-1 AS BIGINT)""")
def q_binary_only_assert(spark, sf):
    """The weight-of-evidence fit takes a 0/1 target (rows encoded) and
    refuses one of three values (-1)."""
    e = table(spark, sf, "events").select("event_type", (F.col("value") > 50).cast("int").alias("y"), "value")
    good = WoEEncoder("r10", ["event_type"], "y").fit(e).transform(e)
    out = good.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("kept").alias("target"), "n_rows")
    three = e.withColumn("y", F.col("y") + (F.col("value") > 75).cast("int"))
    return tidy(out.union(_refused(spark, lambda: WoEEncoder("r10", ["event_type"], "y").fit(three), "three values")))


@register("positive_only_assert", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
                                  "round(ln(l_extendedprice), 6) AS log_price FROM lineitem")
def q_positive_only_assert(spark, sf):
    """The Box-Cox fit takes positive values and refuses a column with
    zeros; then the log of every row is safe."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    zeros = bool(li.where(F.col("l_discount") <= 0).take(1))
    refused = _refused(spark, lambda: BoxCoxTransformer("r11", ["l_discount"]).fit(li), "with zeros").first()["n_rows"] < 0
    if refused != zeros:
        raise ValueError("the check of positive values let zeros pass" if zeros else "positive values were refused")
    good = BoxCoxTransformer("r11", ["l_extendedprice"]).fit(li).transform(li)
    return tidy(good.select("l_orderkey", "l_linenumber", F.log("l_extendedprice").alias("log_price")))


def _refused(spark, fit, name):
    """One row (target, n_rows): -1 when the fit raises ValueError, else 0."""
    try:
        fit()
    except ValueError:
        return spark.createDataFrame([(name, -1)], "target string, n_rows long")
    return spark.createDataFrame([(name, 0)], "target string, n_rows long")


# ------------------------------------------------------------------ J1-J3, J6, J8
@register("left_equi_join", """
WITH g AS (SELECT user_id, event_type, avg(value) AS m, count(value) AS n FROM events
           WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY user_id, event_type)
SELECT CAST(e.event_id AS BIGINT) AS event_id, round(g.m, 9) AS user_id_event_type_mean_value,
       CAST(g.n AS BIGINT) AS user_id_event_type_count_value
FROM events e LEFT JOIN g ON e.user_id = g.user_id AND e.event_type = g.event_type""")
def q_left_equi_join(spark, sf):
    """Two-key group statistics joined back."""
    ev = table(spark, sf, "events")
    st = GroupStats("j1", ["user_id", "event_type"], ["value"], ["mean", "count"])
    out = st.fit(ev).transform(ev.select("event_id", "user_id", "event_type", "value"))
    return tidy(out.select("event_id", "user_id_event_type_mean_value", "user_id_event_type_count_value"),
                overrides={"user_id_event_type_mean_value": 9})


@register("lookup_join", """
WITH g AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey)
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, CAST(coalesce(g.n, 0) AS BIGINT) AS l_partkey_count
FROM lineitem l LEFT JOIN g ON l.l_partkey = g.l_partkey""")
def q_lookup_join(spark, sf):
    """J2 through the state-table join."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    st = CountFrequencyEncoder("j2", ["l_partkey"])
    return tidy(st.fit(li).transform(li).drop("l_partkey"))


@register("lookup_join_two_defaults", """
WITH f AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1994-01-01'),
g AS (SELECT l_partkey, avg(l_extendedprice) AS gm FROM f WHERE l_partkey IS NOT NULL GROUP BY l_partkey),
o AS (SELECT avg(l_extendedprice) AS om FROM f)
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber,
  round(l.l_extendedprice / (coalesce(g.gm, o.om) + 1e-6), 6) AS l_extendedprice_div_by_l_partkey_mean,
  round(l.l_extendedprice - coalesce(g.gm, o.om), 6) AS l_extendedprice_sub_by_l_partkey_mean
FROM lineitem l LEFT JOIN g ON l.l_partkey = g.l_partkey, o""")
def q_lookup_join_two_defaults(spark, sf):
    """Group mean fitted on lines shipped before 1994; parts never seen
    then fall back to the overall mean."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                                              "l_shipdate")
    st = NumCatInteraction("j3", {"l_partkey": ["l_extendedprice"]})
    f = st.fit(li.where(F.col("l_shipdate") < F.lit("1994-01-01")))
    return tidy(f.transform(li).drop("l_partkey", "l_extendedprice", "l_shipdate"))


@register("inner_equi_join", """
WITH t AS (SELECT d.doc_id, d.n_chars FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)),
s AS (SELECT doc_id, least(n_chars / 20000.0, 1.0) AS p FROM t)
SELECT t.doc_id, t.n_chars, CAST(s.p > 0.5 AS BIGINT) AS pseudo_label
FROM t JOIN s ON t.doc_id = s.doc_id WHERE s.p > 0.3 OR s.p < 0.05""")
def q_inner_equi_join(spark, sf):
    """Confident predictions joined back to their unlabelled rows."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    test = d.join(table(spark, sf, "labels"), "doc_id", "left_anti")
    scored = test.select("doc_id", F.least(F.col("n_chars") / 20000.0, F.lit(1.0)).alias("p"))
    conf = confident_rows(scored, "p", 0.3, 0.05)
    return tidy(test.join(conf.select("doc_id", "pseudo_label"), "doc_id", "inner"))


@register("union_by_name", """
SELECT doc_id, n_chars, CAST(quality AS BIGINT) AS quality FROM documents JOIN labels USING (doc_id)
UNION ALL
SELECT doc_id, n_chars, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_union_by_name(spark, sf):
    """Train (with target) ∪ test (without) — missing column → NULL."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    train = d.join(lab, "doc_id")
    test = d.join(lab, "doc_id", "left_anti")
    return tidy(train.unionByName(test, allowMissingColumns=True))


@register("pseudo_label", """
WITH tr AS (SELECT d.doc_id, d.n_chars, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
te AS (SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
s AS (SELECT doc_id, least(n_chars / 20000.0, 1.0) AS p FROM te)
SELECT doc_id, n_chars, CAST(quality AS BIGINT) AS quality FROM tr
UNION ALL
SELECT te.doc_id, te.n_chars, CAST(s.p > 0.5 AS BIGINT) FROM te JOIN s ON te.doc_id = s.doc_id
WHERE s.p > 0.3 OR s.p < 0.05""")
def q_pseudo_label(spark, sf):
    """P7, one round from given scores: confident test rows labelled and
    appended to the original train rows (checkpointed)."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    train = d.join(lab, "doc_id")
    test = d.join(lab, "doc_id", "left_anti")
    scored = test.select("doc_id", F.least(F.col("n_chars") / 20000.0, F.lit(1.0)).alias("p"))
    return tidy(pseudo_label_round(train, test, scored, "doc_id", "p", "quality", 0.3, 0.05))


# ------------------------------------------------------------------ named entries of single operators
@register("drop_cols", "SELECT doc_id, lang, source, CAST(n_chars AS BIGINT) AS n_chars FROM documents")
def q_drop_cols(spark, sf):
    """Drop consumed inputs (the text column)."""
    return tidy(table(spark, sf, "documents").drop("text"))


@register("column_exists_assert", "SELECT o_orderkey, o_orderstatus FROM orders")
def q_column_exists_assert(spark, sf):
    """A schema check before use (no job); a missing column raises."""
    o = table(spark, sf, "orders")
    require_columns(o, ["o_orderkey", "o_orderstatus"], "r12")
    try:
        require_columns(o, ["no_such_column"], "r12")
        raise AssertionError("missing column not detected")
    except ValueError:
        pass
    return o.select("o_orderkey", "o_orderstatus")


@register("chain_left_join", f"WITH {_META_SQL}\nSELECT doc_id, round(pred_a, 6) AS pred_a, round(pred_b, 6) AS pred_b, "
                             "round(pred_c, 6) AS pred_c FROM m")
def q_chain_left_join(spark, sf):
    """N prediction tables folded with left joins on the id."""
    preds, _ = _model_predictions(spark, sf)
    return tidy(build_meta_table(preds, "doc_id", "p"))


@register("attach_target", "SELECT d.doc_id, CAST(l.quality AS BIGINT) AS quality, round(least(d.n_chars / 20000.0, 1.0), 6)"
                           " AS pred_a FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def q_attach_target(spark, sf):
    """Meta table ⟕ raw target."""
    preds, lab = _model_predictions(spark, sf)
    return tidy(build_meta_table({"a": preds["a"]}, "doc_id", "p", lab, "quality"))


@register("read_csv_infer", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, "
                            "round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer")
def q_read_csv_infer(spark, sf):
    """S1 with schema inference (the reference's raw-file scan)."""
    path = scratch_path(spark, "csvinfer")
    table(spark, sf, "customer").write.option("header", "true").csv(path)
    return tidy(read_csv(spark, path))
