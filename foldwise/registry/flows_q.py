"""Check queries for the feature-set build (P1), learners (L1-L6), training
flows (P2-P4, P6, P8, P9), streaming apply (K1) and custom stages (U1-U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.categorical import CountFrequencyEncoder
from ..operators.custom import ExpressionStage, RatioStage, RegexExtractStage
from ..operators.groups import GroupStats
from ..operators.metrics import Rmse, RocAuc
from ..operators.numeric import StandardScaler
from ..operators.temporal import DatetimeFeatures
from ..operators.text import TextStatistics
from ..plans.flows import (FeatureSetBuilder, PseudoLabelling, build_meta_table, rank_features, sample_params,
                           score_batch, search_params, stack, train_full, train_oof)
from ..plans.folds import KFold, RollingTime, StratifiedKFold
from ..plans.models import FittedModel, KeyMeanLearner, Learner
from ..session import scratch_path
from ..streaming.apply import apply_stream, run_to_table
from ..sources.io import table
from . import register, tidy

# ------------------------------------------------------------------ P1
_CUT = "TIMESTAMP '1996-01-01'"


@register("feature_build", f"""
WITH tr AS (SELECT * FROM orders WHERE o_orderdate < {_CUT}),
te AS (SELECT * FROM orders WHERE o_orderdate >= {_CUT}),
cnt AS (SELECT o_orderpriority, count(*) AS n FROM tr WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority),
sc AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM tr),
g AS (SELECT o_custkey, avg(o_totalprice) AS gm, count(o_totalprice) AS gn FROM orders
      WHERE o_custkey IS NOT NULL GROUP BY o_custkey),
u AS (SELECT *, 'train' AS split FROM tr UNION ALL SELECT *, 'test' FROM te)
SELECT u.o_orderkey, u.split, CAST(month(u.o_orderdate) AS BIGINT) AS o_orderdate_month,
  CAST(isodow(u.o_orderdate) - 1 AS BIGINT) AS o_orderdate_weekday,
  CAST(coalesce(cnt.n, 0) AS BIGINT) AS o_orderpriority_count,
  round((u.o_totalprice - sc.m) / sc.s, 6) AS o_totalprice_standard_scaled,
  round(g.gm, 6) AS o_custkey_mean_o_totalprice, CAST(g.gn AS BIGINT) AS o_custkey_count_o_totalprice
FROM u LEFT JOIN cnt ON u.o_orderpriority = cnt.o_orderpriority LEFT JOIN g ON u.o_custkey = g.o_custkey, sc""")
def q_feature_build(spark, sf):
    """Orders before 1996 = train, the rest = test; date parts, a count
    encoder and a scaler fitted on train, per-customer statistics fitted on
    train ∪ test."""
    o = table(spark, sf, "orders")
    cut = F.col("o_orderdate") < F.lit("1996-01-01")
    train, test = o.where(cut), o.where(~cut)
    stages = [DatetimeFeatures("d", ["o_orderdate"], ["month", "weekday"]),
              CountFrequencyEncoder("c", ["o_orderpriority"]),
              StandardScaler("s", ["o_totalprice"]),
              GroupStats("g", ["o_custkey"], ["o_totalprice"], ["mean", "count"])]
    tr, te = FeatureSetBuilder(stages).run(train, test)
    cols = ["o_orderkey", "o_orderdate_month", "o_orderdate_weekday", "o_orderpriority_count",
            "o_totalprice_standard_scaled", "o_custkey_mean_o_totalprice", "o_custkey_count_o_totalprice"]
    out = tr.select(*cols, F.lit("train").alias("split")).unionByName(te.select(*cols, F.lit("test").alias("split")))
    return tidy(out)


# ------------------------------------------------------------------ training data
_FEATS = ["text_text_length", "text_word_count", "text_unique_word_count", "text_avg_word_length",
          "text_sentence_count", "text_punctuation_count", "text_uppercase_count"]


def _doc_features(spark, sf):
    """Text statistics of every document (one pass over the texts, kept for
    the learner passes), split into labelled train and unlabelled test."""
    from pyspark import StorageLevel

    d = table(spark, sf, "documents").select("doc_id", "text")
    f = TextStatistics("x", ["text"]).transform(d).drop("text").persist(StorageLevel.MEMORY_AND_DISK)
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return f.join(lab, "doc_id"), f.join(lab, "doc_id", "left_anti")


def _fold5():
    return StratifiedKFold(5, y_col="quality", id_col="doc_id")


@register("train_oof")
def q_train_oof(spark, sf):
    """5-fold stratified out-of-fold GBT on document text statistics;
    every labelled document gets exactly one OOF prediction."""
    train, test = _doc_features(spark, sf)
    res = train_oof(train, _FEATS, "quality", "doc_id", _fold5(),
                    Learner("gbt", early_stopping=True, maxIter=10, maxDepth=3), RocAuc(), test=test)
    return tidy(res.oof.select("doc_id", "fold", "oof_pred"))


@register("train_oof_time")
def q_train_oof_time(spark, sf):
    """P2 with rolling time folds (rows may train in several folds) on
    events: ridge regression of value on calendar parts."""
    ev = table(spark, sf, "events").withColumn("day", F.datediff(F.to_date("ts"), F.lit("2024-01-01")))
    ev = DatetimeFeatures("t", ["ts"], ["hour", "weekday"]).transform(ev)
    split = RollingTime("day", n_splits=3, valid_duration=5, gap_duration=1)
    res = train_oof(ev, ["ts_hour", "ts_weekday", "user_id"], "value", "event_id", split,
                    Learner("ridge", "regression", regParam=0.1), Rmse())
    return tidy(res.fold_scores)


@register("train_full")
def q_train_full(spark, sf):
    """One forest on all labelled documents, scoring the unlabelled ones."""
    train, test = _doc_features(spark, sf)
    _, pred = train_full(train, _FEATS, "quality", Learner("forest", numTrees=20, maxDepth=5, seed=42), test)
    return tidy(pred.select("doc_id", "prediction"))


@register("fit_gbt")
def q_fit_gbt(spark, sf):
    """L1: gradient-boosted trees (regression on lineitem)."""
    li = table(spark, sf, "lineitem")
    m = Learner("gbt", "regression", maxIter=10, maxDepth=4, seed=42).fit(li, ["l_quantity", "l_discount", "l_tax"],
                                                                            "l_extendedprice")
    return tidy(m.predict(li).select("l_orderkey", "l_linenumber", "prediction"))


@register("fit_forest")
def q_fit_forest(spark, sf):
    """L2: random forest classifier on documents."""
    train, _ = _doc_features(spark, sf)
    m = Learner("forest", numTrees=20, seed=42).fit(train, _FEATS, "quality")
    return tidy(m.predict(train).select("doc_id", "prediction"))


@register("fit_logit")
def q_fit_logit(spark, sf):
    """L3: L2 logistic regression."""
    train, _ = _doc_features(spark, sf)
    m = Learner("logit", regParam=0.1).fit(train, _FEATS, "quality")
    return tidy(m.predict(train).select("doc_id", "prediction"))


@register("fit_ridge")
def q_fit_ridge(spark, sf):
    """L4: ridge regression."""
    li = table(spark, sf, "lineitem")
    m = Learner("ridge", "regression", regParam=1.0).fit(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return tidy(m.predict(li).select("l_orderkey", "l_linenumber", "prediction"))


@register("fit_linear_svm")
def q_fit_linear_svm(spark, sf):
    """Linear SVM (margin output)."""
    train, _ = _doc_features(spark, sf)
    m = Learner("linear_svm", regParam=0.1, maxIter=20).fit(train, _FEATS, "quality")
    return tidy(m.predict(train).select("doc_id", "prediction"))


@register("save_load_model")
def q_save_load_model(spark, sf):
    """A fitted model saved to shared storage and loaded back."""
    train, _ = _doc_features(spark, sf)
    m = Learner("logit", regParam=0.1).fit(train, _FEATS, "quality")
    path = m.save(scratch_path(spark, "model"))
    back = FittedModel.load(path, _FEATS, "logit", "classification")
    return tidy(back.predict(train).select("doc_id", "prediction"))


@register("rank_features")
def q_rank_features(spark, sf):
    """Mean fold importance of the text statistics (forest learner)."""
    train, _ = _doc_features(spark, sf)
    return tidy(rank_features(train, _FEATS, "quality", _fold5(), Learner("forest", numTrees=10, seed=42), top_n=5))


@register("stack")
def q_stack(spark, sf):
    """Logistic meta model over three models' out-of-fold predictions
    (3 stratified folds)."""
    train, test = _doc_features(spark, sf)
    folds = StratifiedKFold(3, y_col="quality", id_col="doc_id")
    preds, tests = {}, {}
    for name, lr in (("gbt", Learner("gbt", maxIter=5, maxDepth=3)), ("rf", Learner("forest", numTrees=10, seed=42)),
                     ("lr", Learner("logit", regParam=0.1))):
        r = train_oof(train, _FEATS, "quality", "doc_id", folds, lr, test=test)
        preds[name], tests[name] = r.oof, r.test_pred
    meta_tr = build_meta_table(preds, "doc_id", "oof_pred", train, "quality")
    meta_te = build_meta_table(tests, "doc_id", "oof_pred")
    cv, _, pred = stack(meta_tr, meta_te, "doc_id", "quality", folds, metric=RocAuc())
    return tidy(pred.select("doc_id", "prediction"))


_SEARCH = {"smoothing": ("float", 0.5, 500.0, "log")}
_TRIALS, _SEARCH_FOLDS = 8, 4


def _search_sql() -> str:
    """Fold scores of all trials (RMSE of smoothed key means on hash folds) and
    the halving: folds 0, 0-1, 0-3, half of the trials left each time."""
    trials = ", ".join(f"({t}, {p['smoothing']!r}::DOUBLE)" for t, p in enumerate(sample_params(_SEARCH, _TRIALS, 7)))
    return f"""
WITH t(trial, smoothing) AS (VALUES {trials}),
e AS (SELECT event_type, hour(ts) AS h, value, (('0x' || substr(md5('42|' || event_id), 1, 8))::BIGINT % {_SEARCH_FOLDS}) AS fold
      FROM events),
f AS (SELECT unnest(range({_SEARCH_FOLDS})) AS fold),
g AS (SELECT f.fold, avg(value) AS m FROM f JOIN e ON e.fold <> f.fold GROUP BY f.fold),
k AS (SELECT f.fold, event_type, h, sum(value) AS s, count(value) AS n FROM f JOIN e ON e.fold <> f.fold GROUP BY ALL),
p AS (SELECT t.trial, e.fold, sqrt(avg(power(e.value - coalesce((k.s + t.smoothing * g.m) / (k.n + t.smoothing), g.m), 2))) AS score
      FROM e CROSS JOIN t JOIN g ON g.fold = e.fold
      LEFT JOIN k ON k.fold = e.fold AND k.event_type = e.event_type AND k.h = e.h GROUP BY ALL),
r1 AS (SELECT trial FROM p WHERE fold < 1 GROUP BY trial ORDER BY avg(score), trial LIMIT {_TRIALS // 2}),
r2 AS (SELECT trial FROM p WHERE fold < 2 AND trial IN (FROM r1) GROUP BY trial ORDER BY avg(score), trial LIMIT {_TRIALS // 4}),
u AS (SELECT trial, CASE WHEN trial IN (FROM r2) THEN {_SEARCH_FOLDS} WHEN trial IN (FROM r1) THEN 2 ELSE 1 END AS folds FROM t)
SELECT CAST(u.trial AS BIGINT) AS trial, round(any_value(t.smoothing), 6) AS smoothing,
  CASE WHEN u.folds = {_SEARCH_FOLDS} THEN 'complete' ELSE 'pruned' END AS status, CAST(u.folds AS BIGINT) AS folds,
  round(avg(score), 6) AS mean_score,
  CAST(u.folds = {_SEARCH_FOLDS} AND avg(score) <= min(CASE WHEN u.folds = {_SEARCH_FOLDS} THEN avg(score) END) OVER () AS BIGINT) AS best
FROM u JOIN p ON p.trial = u.trial AND p.fold < u.folds JOIN t ON t.trial = u.trial GROUP BY u.trial, u.folds"""


@register("search_params", _search_sql())
def q_search_params(spark, sf):
    """Successive halving of eight smoothing values for key means of the
    event value, over four hash folds."""
    ev = table(spark, sf, "events").select("event_id", "event_type", F.hour("ts").alias("h"), "value")
    res = search_params(ev, ["event_type", "h"], "value", KFold(_SEARCH_FOLDS, id_col="event_id", exact=False),
                        KeyMeanLearner, _SEARCH, Rmse(), _TRIALS, seed=7)
    return tidy(res.trials.select("trial", "smoothing", "status", "folds", "mean_score",
                                  (F.col("smoothing") == F.lit(res.best_params["smoothing"])).alias("best")))


@register("search_params_boosted")
def q_search_params_boosted(spark, sf):
    """P8 over boosted trees: depth, step size and rounds (rows-only)."""
    train, _ = _doc_features(spark, sf)
    space = {"maxDepth": ("int", 2, 4), "stepSize": ("float", 0.05, 0.3, "log"), "maxIter": ("cat", [5, 10])}
    res = search_params(train, _FEATS, "quality", KFold(3, id_col="doc_id"), lambda **p: Learner("gbt", **p), space,
                        RocAuc(), n_trials=3)
    return tidy(res.trials)


# ------------------------------------------------------------------ P7
_ROUNDS = [(0.47, 0.43), (0.48, 0.42)]


def _pseudo_sql() -> str:
    """Every round by SQL: key means over the train rows of each of two hash
    folds, averaged over the folds, then thresholds."""
    def scored(n, rows):
        return f"""
m{n} AS (SELECT f.fold, avg(y) AS m FROM (SELECT unnest(range(2)) AS fold) f JOIN {rows} r ON r.fold <> f.fold GROUP BY f.fold),
k{n} AS (SELECT f.fold, k1, k2, (sum(y) + 20 * any_value(m)) / (count(y) + 20) AS p
  FROM m{n} f JOIN {rows} r ON r.fold <> f.fold GROUP BY f.fold, k1, k2),
p{n} AS (SELECT id, t.k1, t.k2, t.fold, avg(coalesce(k.p, f.m)) AS p
  FROM te t CROSS JOIN m{n} f LEFT JOIN k{n} k ON k.fold = f.fold AND k.k1 = t.k1 AND k.k2 = t.k2 GROUP BY ALL),
s{n} AS (SELECT r.fold, avg((y - coalesce(k.p, f.m)) * (y - coalesce(k.p, f.m))) AS mse
  FROM {rows} r JOIN m{n} f ON f.fold = r.fold LEFT JOIN k{n} k ON k.fold = r.fold AND k.k1 = r.k1 AND k.k2 = r.k2 GROUP BY r.fold)"""

    ctes = [f"""o AS (SELECT o_orderkey AS id, o_orderpriority AS k1, month(o_orderdate) AS k2, (o_orderstatus = 'F')::INT::DOUBLE AS y,
  o_orderdate < {_CUT} AS tr, (('0x' || substr(md5('42|' || o_orderkey), 1, 8))::BIGINT % 2) AS fold FROM orders),
te AS (SELECT id, k1, k2, fold FROM o WHERE NOT tr), d0 AS (SELECT id, k1, k2, y, fold FROM o WHERE tr)""", scored(0, "d0")]
    for n, (high, low) in enumerate(_ROUNDS, 1):
        ctes.append(f"l{n} AS (SELECT id, k1, k2, (p > 0.5)::INT::DOUBLE AS y, fold FROM p{n - 1} WHERE p > {high} OR p < {low}), "
                    f"d{n} AS (FROM d0 UNION ALL FROM l{n})")
        ctes.append(scored(n, f"d{n}"))
    rows = ["SELECT 0 AS round, 0 AS added, 0 AS positives, (SELECT count(*) FROM d0) AS n_train, "
            "(SELECT avg(sqrt(mse)) FROM s0) AS mean_score"]
    rows += [f"SELECT {n}, (SELECT count(*) FROM l{n}), (SELECT coalesce(sum(y), 0) FROM l{n}), (SELECT count(*) FROM d{n}), "
             f"(SELECT avg(sqrt(mse)) FROM s{n})" for n in range(1, len(_ROUNDS) + 1)]
    return (f"WITH {', '.join(ctes)} SELECT CAST(round AS BIGINT) AS round, CAST(added AS BIGINT) AS added, "
            "CAST(positives AS BIGINT) AS positives, CAST(n_train AS BIGINT) AS n_train, round(mean_score, 6) AS mean_score "
            f"FROM ({' UNION ALL '.join(rows)})")


@register("pseudo_label_rounds", _pseudo_sql())
def q_pseudo_label_rounds(spark, sf):
    """Two rounds on orders (before 1996 = train, the rest = test), a key-mean
    learner on priority and month, rebuilt features, own thresholds a round."""
    o = table(spark, sf, "orders").withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))
    cut = F.col("o_orderdate") < F.lit("1996-01-01")
    flow = PseudoLabelling(lambda: [DatetimeFeatures("d", ["o_orderdate"], ["month"])], ["o_orderpriority", "o_orderdate_month"],
                           "y", "o_orderkey", KFold(2, id_col="o_orderkey", exact=False), KeyMeanLearner(20.0), Rmse(), _ROUNDS)
    out = flow.run(o.where(cut), o.where(~cut).drop("y"))
    return tidy(out.select("round", "added", "positives", "n_train", "mean_score"))


@register("score_batch")
def q_score_batch(spark, sf):
    """The fold models of a stratified run averaged over unlabelled documents."""
    train, test = _doc_features(spark, sf)
    res = train_oof(train, _FEATS, "quality", "doc_id", _fold5(), Learner("logit", regParam=0.1))
    return tidy(score_batch(res.models, test, "doc_id"))


# ------------------------------------------------------------------ L3-L6, P9 by certificate
_LI_FEATS = ["l_quantity", "l_discount", "l_tax"]
_RIDGE = 1.0


def _ridge_sql() -> str:
    """Normal equations of three standardised features, solved by Cramer's rule.
    Spark scales features and label by their sample deviations and adds
    regParam / (label deviation) to the diagonal of the scaled system."""
    v = dict(zip("abc", _LI_FEATS))
    cor = [f"covar_pop({x}, {z}) / (stddev_samp({x}) * stddev_samp({z})) AS s_{i}{j}"
           for i, x in v.items() for j, z in v.items() if i <= j]
    rhs = [f"covar_pop({x}, l_extendedprice) / (stddev_samp({x}) * stddev_samp(l_extendedprice)) AS r_{i}" for i, x in v.items()]
    stat = [f"avg({x}) AS m_{i}, stddev_samp({x}) AS d_{i}" for i, x in v.items()]
    g = {(i, j): f"s_{min(i, j)}{max(i, j)}" + (f" + {_RIDGE} / d_y" if i == j else "") for i in v for j in v}

    def det(m):
        (a, b, c), (d, e, f), (h, i, k) = m
        return (f"(({a}) * (({e}) * ({k}) - ({f}) * ({i})) - ({b}) * (({d}) * ({k}) - ({f}) * ({h})) "
                f"+ ({c}) * (({d}) * ({i}) - ({e}) * ({h})))")

    full = det([[g[i, j] for j in v] for i in v])
    w = {z: det([[f"r_{i}" if j == z else g[i, j] for j in v] for i in v]) + f" / {full}" for z in v}
    lin = " + ".join(f"(({w[i]}) * d_y / d_{i}) * ({x} - m_{i})" for i, x in v.items())
    return (f"WITH s AS (SELECT {', '.join(cor + rhs + stat)}, avg(l_extendedprice) AS m_y, stddev_samp(l_extendedprice) AS d_y "
            f"FROM lineitem) SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(m_y + {lin}, 1) AS prediction "
            "FROM lineitem, s")


@register("fit_ridge_solved", _ridge_sql())
def q_fit_ridge_solved(spark, sf):
    """L4 by value: the ridge predictions against the normal equations."""
    return tidy(q_fit_ridge(spark, sf), digits=1)


@register("fit_logit_gradient", """
SELECT name, CAST(0 AS DOUBLE) AS gradient FROM (VALUES ('text_text_length'), ('text_word_count'),
  ('text_unique_word_count'), ('text_avg_word_length'), ('text_sentence_count'), ('text_punctuation_count'),
  ('text_uppercase_count'), ('intercept')) t(name)""")
def q_fit_logit_gradient(spark, sf):
    """L3 by certificate: the penalised log-loss is convex, so a zero gradient
    (by standardised feature) shows that the fitted coefficients are its minimum."""
    train, _ = _doc_features(spark, sf)
    m = Learner("logit", regParam=0.1, tol=1e-10, maxIter=500).fit(train, _FEATS, "quality")
    w = dict(zip(_FEATS, m.model.coefficients.toArray().tolist()))
    p = m.predict(train, "p").withColumn("r", F.col("p") - F.col("quality"))
    std = p.agg(*[F.stddev_samp(c).alias(c) for c in _FEATS]).first()
    grad = p.agg(*[(F.avg(F.col("r") * F.col(c)) / std[c] + 0.1 * w[c] * std[c]).alias(c) for c in _FEATS],
                 F.avg("r").alias("intercept"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("gradient")) for c in [*_FEATS, "intercept"]]))
    return tidy(grad.select(pairs.alias("x")).select("x.*"), digits=4)


@register("save_load_difference", "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS DOUBLE) AS largest_difference "
                                  "FROM documents JOIN labels USING (doc_id)")
def q_save_load_difference(spark, sf):
    """A model that was saved and loaded predicts what it did before."""
    train, _ = _doc_features(spark, sf)
    m = Learner("logit", regParam=0.1).fit(train, _FEATS, "quality")
    back = FittedModel.load(m.save(scratch_path(spark, "model")), _FEATS, "logit", "classification")
    both = m.predict(train, "a").select("doc_id", "a").join(back.predict(train, "b").select("doc_id", "b"), "doc_id")
    return tidy(both.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("largest_difference")))


@register("score_batch_difference", "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS DOUBLE) AS largest_difference "
                                    "FROM documents ANTI JOIN labels USING (doc_id)")
def q_score_batch_difference(spark, sf):
    """Scoring with the saved fold models gives the flow's own test predictions."""
    train, test = _doc_features(spark, sf)
    res = train_oof(train, _FEATS, "quality", "doc_id", _fold5(), Learner("logit", regParam=0.1), test=test)
    saved = [FittedModel.load(m.save(scratch_path(spark, "model")), _FEATS, "logit", "classification") for m in res.models]
    both = (score_batch(saved, test, "doc_id", "a")
            .join(res.test_pred.select("doc_id", F.col("oof_pred").alias("b")), "doc_id"))
    return tidy(both.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("largest_difference")))


# ------------------------------------------------------------------ K1
@register("apply_stream", """
WITH g AS (SELECT user_id, avg(value) AS m FROM events WHERE user_id IS NOT NULL GROUP BY user_id),
c AS (SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type)
SELECT CAST(e.event_id AS BIGINT) AS event_id, CAST(hour(e.ts) AS BIGINT) AS ts_hour,
  round(g.m, 9) AS user_id_mean_value, CAST(coalesce(c.n, 0) AS BIGINT) AS event_type_count
FROM events e LEFT JOIN g ON e.user_id = g.user_id LEFT JOIN c ON e.event_type = c.event_type""")
def q_apply_stream(spark, sf):
    """K1: stages fitted on the events table, applied to the same file read
    as a stream (availableNow) into a memory table."""
    ev = table(spark, sf, "events")
    fitted = [DatetimeFeatures("t", ["ts"], ["hour"]).fit(ev),
              GroupStats("g", ["user_id"], ["value"], ["mean"]).fit(ev),
              CountFrequencyEncoder("c", ["event_type"]).fit(ev)]
    stream = spark.readStream.schema(ev.schema).parquet(f"{sf}/events*.parquet")
    out = apply_stream(stream, fitted).select("event_id", "ts_hour", "user_id_mean_value", "event_type_count")
    name = "k1_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    res = run_to_table(out, name, scratch_path(spark, "stream-ckpt"))
    return tidy(res, overrides={"user_id_mean_value": 9})


# ------------------------------------------------------------------ U1-U3
@register("custom_stage", """
SELECT o_orderkey, round(o_totalprice / 1000.0, 6) AS price_k, upper(o_orderpriority) AS prio FROM orders""")
def q_custom_stage(spark, sf):
    """A user stage defined by SQL expressions."""
    o = table(spark, sf, "orders")
    st = ExpressionStage("u1", {"price_k": "o_totalprice / 1000.0", "prio": "upper(o_orderpriority)"})
    return tidy(st.transform(o).select("o_orderkey", "price_k", "prio"))


@register("regex_extract_stage", r"""
SELECT conv_id, CAST(turn AS BIGINT) AS turn, nullif(regexp_extract(text, ' ([A-Za-z]+)\.', 1), '') AS text_title
FROM conversations""")
def q_regex_extract_stage(spark, sf):
    """First ` <word>.` in each conversation turn."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return tidy(RegexExtractStage("u2", "text").transform(c).drop("text"))


@register("ratio_stage", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  round(l_extendedprice / (l_quantity + 1e-6), 6) AS l_extendedprice_per_l_quantity FROM lineitem""")
def q_ratio_stage(spark, sf):
    """Price per unit."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return tidy(RatioStage("u3", "l_extendedprice", "l_quantity").transform(li).drop("l_extendedprice", "l_quantity"))
