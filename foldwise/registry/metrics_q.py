"""Check queries for metrics (M1-M15). Each returns one row (or one row per
group) with a `score` column."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.metrics import (QWK, F1, Accuracy, AveragePrecision, LogLoss, Mae, MapAtK, Mape, Precision,
                                 R2, Recall, Rmse, Rmsle, RocAuc, TopKAccuracy)
from ..sources.io import table
from . import register, tidy

EPS = "2.220446049250313e-16"


def scored_docs(spark, sf):
    """Labelled documents with a score derived from their length."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    j = d.join(table(spark, sf, "labels"), "doc_id")
    return j.withColumn("p", F.least(F.col("n_chars") / 20000.0, F.lit(1.0)))


_DOCS = """b AS (SELECT d.doc_id, d.lang, l.quality AS y, least(d.n_chars / 20000.0, 1.0) AS p
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def _one(m, df, y, p, by=None):
    return tidy(m.frame(df, y, p, by=by))


@register("accuracy", f"WITH {_DOCS} SELECT round(avg(CAST(CAST(p > 0.5 AS INTEGER) = y AS DOUBLE)), 6) AS score FROM b")
def q_accuracy(spark, sf):
    return _one(Accuracy(0.5), scored_docs(spark, sf), "quality", "p")


_CONF = f"""{_DOCS},
q AS (SELECT y, CAST(p > 0.5 AS INTEGER) AS q FROM b),
c AS (SELECT y AS c FROM q UNION SELECT q FROM q),
s AS (SELECT c.c, CAST(count_if(q.y = c.c AND q.q = c.c) AS DOUBLE) AS tp,
             CAST(count_if(q.q = c.c AND q.y <> c.c) AS DOUBLE) AS fp,
             CAST(count_if(q.y = c.c AND q.q <> c.c) AS DOUBLE) AS fn,
             CAST(count_if(q.y = c.c) AS DOUBLE) AS sup FROM c, q GROUP BY c.c)"""


def _ratio(a, b):
    return f"(CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0.0 END)"


@register("precision", f"WITH {_CONF} SELECT round(coalesce(max(CASE WHEN c = 1 THEN {_ratio('tp', 'tp + fp')} END), 0), 6)"
                       " AS score FROM s")
def q_precision(spark, sf):
    return _one(Precision(0.5), scored_docs(spark, sf), "quality", "p")


@register("recall", f"WITH {_CONF} SELECT round(coalesce(max(CASE WHEN c = 1 THEN {_ratio('tp', 'tp + fn')} END), 0), 6)"
                    " AS score FROM s")
def q_recall(spark, sf):
    return _one(Recall(0.5), scored_docs(spark, sf), "quality", "p")


@register("f1", f"WITH {_CONF} SELECT round(coalesce(max(CASE WHEN c = 1 THEN {_ratio('2 * tp', '2 * tp + fp + fn')} END), 0), 6)"
                " AS score FROM s")
def q_f1(spark, sf):
    return _one(F1(0.5), scored_docs(spark, sf), "quality", "p")


@register("f1_macro", f"WITH {_CONF} SELECT round(avg({_ratio('2 * tp', '2 * tp + fp + fn')}), 6) AS score FROM s")
def q_f1_macro(spark, sf):
    return _one(F1(0.5, "macro"), scored_docs(spark, sf), "quality", "p")


@register("precision_weighted", f"WITH {_CONF} SELECT round({_ratio('sum(' + _ratio('tp', 'tp + fp') + ' * sup)', 'sum(sup)')}, 6)"
                                " AS score FROM s")
def q_precision_weighted(spark, sf):
    return _one(Precision(0.5, "weighted"), scored_docs(spark, sf), "quality", "p")


@register("recall_micro", f"WITH {_CONF} SELECT round({_ratio('sum(tp)', 'sum(tp) + sum(fn)')}, 6) AS score FROM s")
def q_recall_micro(spark, sf):
    return _one(Recall(0.5, "micro"), scored_docs(spark, sf), "quality", "p")


@register("log_loss", f"""WITH {_DOCS}, c AS (SELECT y, greatest(least(p, 1 - {EPS}), {EPS}) AS q FROM b)
SELECT round(-avg(y * ln(q) + (1 - y) * ln(1 - q)), 6) AS score FROM c""")
def q_log_loss(spark, sf):
    return _one(LogLoss(), scored_docs(spark, sf), "quality", "p")


@register("roc_auc", f"""WITH {_DOCS},
r AS (SELECT y, (rank() OVER (ORDER BY p) * 2 + count(*) OVER (PARTITION BY p) - 1) / 2.0 AS rk FROM b)
SELECT round((sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)), 6) AS score
FROM r""")
def q_roc_auc(spark, sf):
    return _one(RocAuc(), scored_docs(spark, sf), "quality", "p")


@register("roc_auc_by_group", f"""WITH {_DOCS},
r AS (SELECT lang, y, (rank() OVER (PARTITION BY lang ORDER BY p) * 2 + count(*) OVER (PARTITION BY lang, p) - 1) / 2.0 AS rk
      FROM b)
SELECT lang, round(CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN
  (sum(CASE WHEN y = 1 THEN rk ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) END, 6) AS score
FROM r GROUP BY lang""")
def q_roc_auc_by_group(spark, sf):
    """AUC per document language (grouped distributed running sums)."""
    return _one(RocAuc(), scored_docs(spark, sf), "quality", "p", by=["lang"])


@register("average_precision", f"""WITH {_DOCS},
s AS (SELECT p AS s, sum(y) AS pos, sum(1 - y) AS neg FROM b GROUP BY p),
c AS (SELECT pos, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp FROM s)
SELECT round(CASE WHEN sum(pos) > 0 THEN sum(pos * tp / (tp + fp)) / sum(pos) ELSE 0 END, 6) AS score FROM c""")
def q_average_precision(spark, sf):
    return _one(AveragePrecision(), scored_docs(spark, sf), "quality", "p")


# ------------------------------------------------------------------ regression
def _li(spark, sf):
    return table(spark, sf, "lineitem").withColumn("p", F.col("l_quantity") * 1500.0)


_Y, _P = "l_extendedprice", "(l_quantity * 1500.0)"


@register("mae", f"SELECT round(avg(abs({_Y} - {_P})), 6) AS score FROM lineitem")
def q_mae(spark, sf):
    return _one(Mae(), _li(spark, sf), "l_extendedprice", "p")


@register("mape", f"SELECT round(avg(abs({_Y} - {_P}) / greatest(abs({_Y}), {EPS})), 6) AS score FROM lineitem")
def q_mape(spark, sf):
    return _one(Mape(), _li(spark, sf), "l_extendedprice", "p")


@register("rmse", f"SELECT round(sqrt(avg(power({_Y} - {_P}, 2))), 6) AS score FROM lineitem")
def q_rmse(spark, sf):
    return _one(Rmse(), _li(spark, sf), "l_extendedprice", "p")


@register("rmsle", f"SELECT round(sqrt(avg(power(ln(1 + {_Y}) - ln(1 + greatest({_P}, 0)), 2))), 6) AS score FROM lineitem")
def q_rmsle(spark, sf):
    return _one(Rmsle(), _li(spark, sf), "l_extendedprice", "p")


@register("r2", f"""SELECT round(CASE WHEN var_pop({_Y}) * count({_Y}) > 0
  THEN 1 - sum(power({_Y} - {_P}, 2)) / (var_pop({_Y}) * count({_Y}))
  WHEN sum(power({_Y} - {_P}, 2)) = 0 THEN 1 ELSE 0 END, 6) AS score FROM lineitem""")
def q_r2(spark, sf):
    return _one(R2(), _li(spark, sf), "l_extendedprice", "p")


# ------------------------------------------------------------------ M13, M14
def _part_classes(spark, sf):
    return (table(spark, sf, "part")
            .withColumn("y", F.floor(F.col("p_size") / 10).cast("int"))
            .withColumn("p", F.col("p_retailprice") / 400.0))


@register("qwk", """
WITH b AS (SELECT CAST(p_size // 10 AS BIGINT) AS y, CAST(round_even(p_retailprice / 400.0, 0) AS BIGINT) AS q FROM part),
l AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS i FROM (SELECT y AS v FROM b UNION SELECT q FROM b)),
x AS (SELECT ly.i AS iy, lq.i AS iq FROM b JOIN l ly ON b.y = ly.v JOIN l lq ON b.q = lq.v),
n AS (SELECT count(*) AS n FROM x),
hy AS (SELECT iy AS i, count(*) AS a FROM x GROUP BY iy),
hq AS (SELECT iq AS j, count(*) AS b FROM x GROUP BY iq),
e AS (SELECT sum(power(hy.i - hq.j, 2) * hy.a * hq.b) / max(n.n) AS e FROM hy, hq, n),
o AS (SELECT sum(power(iy - iq, 2)) AS o FROM x)
SELECT round(1 - o.o / e.e, 6) AS score FROM o, e""")
def q_qwk(spark, sf):
    return _one(QWK(), _part_classes(spark, sf), "y", "p")


@register("top_k_accuracy", """
WITH b AS (SELECT CAST(p_size // 10 AS INTEGER) AS y,
                  list_transform(range(6), lambda c: -abs(c - p_retailprice / 400.0)) AS s FROM part)
SELECT round(avg(CAST(len(list_filter(range(6), lambda c: s[c + 1] > s[y + 1] OR (s[c + 1] = s[y + 1] AND c > y))) < 2
                 AS DOUBLE)), 6) AS score FROM b""")
def q_top_k_accuracy(spark, sf):
    """Six size classes, class scores −|c − price/400|, k = 2."""
    p = _part_classes(spark, sf)
    p = p.withColumn("scores", F.array(*[-F.abs(F.lit(float(c)) - F.col("p")) for c in range(6)]))
    return _one(TopKAccuracy(2), p, "y", "scores")


@register("map_at_k", """
WITH b AS (SELECT user_id, event_id, CAST(event_type = 'purchase' AS DOUBLE) AS r, value AS s FROM events),
t AS (SELECT user_id, sum(r) AS tot FROM b GROUP BY user_id),
k AS (SELECT user_id, r, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, event_id) AS pos FROM b),
h AS (SELECT user_id, r, pos, sum(r) OVER (PARTITION BY user_id ORDER BY pos) AS hits FROM k WHERE pos <= 10),
a AS (SELECT user_id, sum(hits / pos * r) AS a FROM h GROUP BY user_id)
SELECT round(avg(CASE WHEN t.tot > 0 THEN a.a / t.tot ELSE 0 END), 6) AS score FROM a JOIN t ON a.user_id = t.user_id""")
def q_map_at_k(spark, sf):
    ev = table(spark, sf, "events").withColumn("rel", (F.col("event_type") == "purchase").cast("double"))
    return _one(MapAtK(10, "user_id", "event_id"), ev, "rel", "value")
