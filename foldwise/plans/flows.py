"""Training flows (P2-P9) and their summaries.

Every flow keeps data in Spark: folds are lazy filters, predictions are
DataFrames keyed by an id column, per-fold results are unioned tables. The
driver only loops over folds / rounds / trials (a handful of jobs each).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path


# ------------------------------------------------------------------ A11-A13
def fold_summary(scores: DataFrame, score_col: str = "score") -> DataFrame:
    """Mean and population std of per-fold scores, plus the fold count."""
    return scores.agg(F.avg(score_col).alias("mean_score"), F.stddev_pop(score_col).alias("std_score"),
                      F.count(F.lit(1)).alias("n_folds"))


def feature_ranking(importances: DataFrame, top_n: int | None = None, feature_col: str = "feature",
                    value_col: str = "importance") -> DataFrame:
    """A12 + A11: mean importance per feature over folds (long table
    `(feature, fold, importance)`), sorted descending (ties by name), top N."""
    m = importances.groupBy(feature_col).agg(F.avg(value_col).alias("mean_importance"))
    m = m.orderBy(F.desc("mean_importance"), F.asc(feature_col))
    return m.limit(top_n) if top_n else m


# ------------------------------------------------------------------ P5
def build_meta_table(predictions: dict[str, DataFrame], id_col: str, pred_col: str,
                     target: DataFrame | None = None, target_col: str | None = None) -> DataFrame:
    """P5 (J4 + J5 + R5): left-join every model's `(id, pred)` table on the id,
    renaming each prediction to `pred_<model>`, then attach the target."""
    tables = [p.select(F.col(id_col), F.col(pred_col).alias(f"pred_{m}")) for m, p in predictions.items()]
    meta = reduce(lambda a, b: a.join(b, id_col, "left"), tables)
    if target is not None:
        meta = meta.join(target.select(id_col, target_col), id_col, "left")
    return meta


def prediction_columns(df: DataFrame, prefix: str = "pred_") -> list[str]:
    """Columns whose name starts with the prefix."""
    return [c for c in df.columns if c.startswith(prefix)]


# ------------------------------------------------------------------ P7 helpers
def confident_rows(scored: DataFrame, pred_col: str, high: float, low: float) -> DataFrame:
    """Keep predictions above `high` or below `low`, labelled `p > 0.5`."""
    p = F.col(pred_col)
    return scored.where((p > F.lit(high)) | (p < F.lit(low))).withColumn("pseudo_label", (p > 0.5).cast("int"))


def pseudo_label_round(train: DataFrame, test: DataFrame, scored: DataFrame, id_col: str, pred_col: str,
                       target_col: str, high: float, low: float, checkpoint: bool = True) -> DataFrame:
    """P7, one round: confident test predictions (J6 back to their test rows)
    take their rounded label as target and are appended to the original
    train rows (J8, missing columns → NULL). The result is checkpointed so
    later rounds start from a short lineage."""
    conf = confident_rows(scored.select(id_col, pred_col), pred_col, high, low)
    rows = test.join(conf.select(id_col, F.col("pseudo_label").alias(target_col)), id_col, "inner")
    out = train.unionByName(rows, allowMissingColumns=True)
    return cut_lineage(out) if checkpoint else out


class PseudoLabelling:
    """Rounds of pseudo-labelling with a state that outlives the session.

    Round 0 builds features from the original rows, trains over the folds and
    scores the test rows. Every further round has its own thresholds (high, low):
    confident predictions of the round before become labels, their test rows
    join the original train rows (never those of earlier rounds), features are
    built and the model trained anew, and the test rows are scored again.

    `stages` is called once a round and returns unfitted stages; `features` are
    the model's columns. A round writes the pseudo-labelled ids, the test
    predictions and the fold scores under `path` (shared storage), the scores
    last; a later run with the same path goes on after the last round that has
    them. Without a path the checkpoint folder is used."""

    def __init__(self, stages, features, target: str, id_col: str, split, learner, metric, thresholds,
                 path: str | None = None, pred_col: str = "prediction"):
        self.stages, self.features, self.target, self.id_col = stages, list(features), target, id_col
        self.split, self.learner, self.metric = split, learner, metric
        self.thresholds, self.path, self.pred_col = list(thresholds), path, pred_col
        for high, low in self.thresholds:
            if not low <= high:
                raise ValueError(f"thresholds are (high, low) with low <= high, not {(high, low)}")

    def _at(self, n: int, table: str) -> str:
        return f"{self.path}/round={n}/{table}"

    def done(self, spark, n: int) -> bool:
        """Whether a round is complete."""
        p = spark._jvm.org.apache.hadoop.fs.Path(self._at(n, "scores") + "/_SUCCESS")
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    def labels(self, spark, n: int) -> DataFrame:
        """(id, target) of the rows that round n took over from the test set."""
        return spark.read.parquet(self._at(n, "labels"))

    def predictions(self, spark, n: int) -> DataFrame:
        """(id, prediction) of all test rows after round n."""
        return spark.read.parquet(self._at(n, "predictions"))

    def scores(self, spark, n: int) -> DataFrame:
        return spark.read.parquet(self._at(n, "scores"))

    def _train_rows(self, train: DataFrame, test: DataFrame, labels: DataFrame) -> DataFrame:
        kind = train.schema[self.target].dataType
        rows = test.drop(self.target).join(labels.select(self.id_col, F.col(self.target).cast(kind)), self.id_col, "inner")
        return train.unionByName(rows, allowMissingColumns=True)

    def _round(self, n: int, train: DataFrame, test: DataFrame) -> None:
        spark = train.sparkSession
        if n:
            high, low = self.thresholds[n - 1]
            sure = confident_rows(self.predictions(spark, n - 1), self.pred_col, high, low)
            labels = sure.select(self.id_col, F.col("pseudo_label").alias(self.target))
        else:
            labels = test.select(self.id_col, F.lit(None).cast("int").alias(self.target)).limit(0)
        labels.write.mode("overwrite").parquet(self._at(n, "labels"))
        builder = FeatureSetBuilder(self.stages())
        rows, scored = builder.run(self._train_rows(train, test, self.labels(spark, n)), test.drop(self.target))
        res = train_oof(rows, self.features, self.target, self.id_col, self.split, self.learner, self.metric, test=scored,
                        pred_col=self.pred_col)
        res.test_pred.write.mode("overwrite").parquet(self._at(n, "predictions"))
        res.fold_scores.write.mode("overwrite").parquet(self._at(n, "scores"))
        builder.release()

    def run(self, train: DataFrame, test: DataFrame) -> DataFrame:
        """One row a round: round, added (pseudo-labelled rows), positives (of
        them), n_train, mean_score, std_score, n_folds."""
        spark = train.sparkSession
        if self.path is None:
            self.path = scratch_path(spark, "pseudo-labels")
        for n in range(len(self.thresholds) + 1):
            if not self.done(spark, n):
                self._round(n, train, test)
        return self.rounds(train)

    def rounds(self, train: DataFrame) -> DataFrame:
        spark, out = train.sparkSession, []
        own = train.agg(F.count(F.lit(1)).alias("own"))
        for n in range(len(self.thresholds) + 1):
            took = self.labels(spark, n).agg(F.count(F.lit(1)).alias("added"),
                                             F.coalesce(F.sum(F.col(self.target).cast("long")), F.lit(0)).alias("positives"))
            one = own.join(took, F.lit(True)).join(fold_summary(self.scores(spark, n)), F.lit(True))
            out.append(one.select(F.lit(n).alias("round"), "added", "positives", (F.col("own") + F.col("added")).alias("n_train"),
                                  "mean_score", "std_score", "n_folds"))
        return reduce(DataFrame.unionByName, out)


# ------------------------------------------------------------------ P1
class FeatureSetBuilder:
    """Ordered stages, each fitted on the current train rows (or on
    train ∪ test for `combined` stages), applied to both. The plans stay lazy.

    Fit fusion: a run of consecutive stages whose fit is one global aggregate
    (`AggregateFit`), with the same fit scope and inputs already present
    before the run, is fitted with ONE `agg` job. Every `checkpoint_every`
    stages the two frames are checkpointed to the shared folder so lineage
    stays short."""

    def __init__(self, stages, checkpoint_every: int = 8):
        self.stages, self.checkpoint_every = list(stages), checkpoint_every
        self.fitted = []
        self.fit_jobs = 0  # aggregate jobs spent on fused fits (inspection)

    @staticmethod
    def _scope(st, train, test):
        from ..operators.base import COMBINED

        if test is None or st.fit_scope != COMBINED:
            return train
        return train.unionByName(test, allowMissingColumns=True)

    def _fusible_run(self, i, train):
        from ..operators.base import AggregateFit

        run = []
        for st in self.stages[i:]:
            if not isinstance(st, AggregateFit) or (run and st.fit_scope != run[0].fit_scope):
                break
            if any(c not in train.columns for c in st.fit_inputs()):
                break
            run.append(st)
        return run

    def run(self, train: DataFrame, test: DataFrame | None = None):
        i, n = 0, 0
        while i < len(self.stages):
            group = self._fusible_run(i, train)
            if len(group) > 1:
                scope = self._scope(group[0], train, test)
                aggs = [e for j, st in enumerate(group) for e in st.fit_aggs(f"f{j}__")]
                row = scope.agg(*aggs).first()
                self.fit_jobs += 1
                fits = [st.from_row(row, f"f{j}__") for j, st in enumerate(group)]
            else:
                group = [self.stages[i]]
                fits = [group[0].fit(self._scope(group[0], train, test))]
            for f in fits:
                self.fitted.append(f)
                if test is not None and getattr(f.stage, "transform_scope", "split") == "combined":
                    train, test = self._transform_combined(f, train, test)
                else:
                    # bag-of-words fits give a vector column here, not their long form
                    apply = getattr(f, "add_to", f.transform)
                    train = apply(train)
                    test = apply(test) if test is not None else None
                n += 1
                if self.checkpoint_every and n % self.checkpoint_every == 0:
                    train = cut_lineage(train)
                    test = cut_lineage(test) if test is not None else None
            i += len(group)
        return train, test

    @staticmethod
    def _transform_combined(f, train, test):
        """Transform train ∪ test in one plan, then split back (each side
        keeps its own columns plus the new ones)."""
        tr_cols, te_cols = list(train.columns), list(test.columns)
        u = train.withColumn("__split", F.lit(0)).unionByName(test.withColumn("__split", F.lit(1)),
                                                                allowMissingColumns=True)
        out = f.transform(u)
        new = [c for c in out.columns if c not in set(tr_cols) | set(te_cols) | {"__split"}]
        tr = out.where(F.col("__split") == 0).select(*tr_cols, *new)
        te = out.where(F.col("__split") == 1).select(*te_cols, *new)
        return tr, te

    def release(self) -> None:
        """Unpersist the state held by every fitted stage."""
        for f in self.fitted:
            f.release()


# ------------------------------------------------------------------ P2, P3
class OofResult:
    def __init__(self, oof: DataFrame, test_pred: DataFrame | None, fold_scores: DataFrame, models: list):
        self.oof, self.test_pred, self.fold_scores, self.models = oof, test_pred, fold_scores, models

    def summary(self) -> DataFrame:
        return fold_summary(self.fold_scores)


def train_oof(train: DataFrame, features, target: str, id_col: str, split, learner, metric=None,
              test: DataFrame | None = None, pred_col: str = "oof_pred") -> OofResult:
    """Per fold fit on the train rows, predict the valid rows. Out-of-fold
    predictions are the union of the valid-row predictions (rows never
    validated get none); test predictions are averaged over the folds that
    were actually trained; per-fold metric scores form a small table."""
    spark = train.sparkSession
    oofs, tests, scores, models = [], [], [], []
    for fold, tr, va in split.pairs(train):
        model = learner.fit(tr, features, target, valid=va)  # valid = eval set (early stopping)
        models.append(model)
        pv = model.predict(va, pred_col).select(id_col, target, pred_col).withColumn("fold", F.lit(fold))
        oofs.append(pv)
        if metric is not None:
            scores.append(metric.frame(pv, target, pred_col).withColumn("fold", F.lit(fold)))
        if test is not None:
            tests.append(model.predict(test, "__p").select(id_col, "__p"))
    if not oofs:
        raise ValueError("the split produced no folds")
    oof = reduce(lambda a, b: a.unionByName(b), oofs)
    test_pred = None
    if tests:
        test_pred = reduce(lambda a, b: a.unionByName(b), tests).groupBy(id_col).agg(F.avg("__p").alias(pred_col))
    fs = reduce(lambda a, b: a.unionByName(b), scores) if scores else \
        spark.createDataFrame([], "score double, fold int")
    return OofResult(oof, test_pred, fs.select("fold", "score"), models)


def train_full(train: DataFrame, features, target: str, learner, test: DataFrame | None = None,
               pred_col: str = "prediction"):
    """One fit on all train rows; score the test rows."""
    model = learner.fit(train, features, target)
    return model, (model.predict(test, pred_col) if test is not None else None)


# ------------------------------------------------------------------ P4
def rank_features(train: DataFrame, features: list[str], target: str, split, learner, top_n: int | None = None):
    """Per-fold feature importances of a tree learner → long table →
    mean per feature → sorted (top N)."""
    spark = train.sparkSession
    rows = []
    for fold, tr, _ in split.pairs(train):
        imp = learner.fit(tr, features, target).feature_importances() or [0.0] * len(features)
        rows += [(f, int(fold), float(v)) for f, v in zip(features, imp)]
    long_t = spark.createDataFrame(rows, "feature string, fold int, importance double")
    return feature_ranking(long_t, top_n)


# ------------------------------------------------------------------ P6
def stack(meta_train: DataFrame, meta_test: DataFrame | None, id_col: str, target: str, split, learner=None,
          metric=None, prefix: str = "pred_"):
    """Cross-validate a meta model on the `pred_` columns of the meta
    table, then refit it on all rows and score the test meta table."""
    from .models import Learner

    learner = learner or Learner("logit", regParam=1.0)
    feats = prediction_columns(meta_train, prefix)
    filled = meta_train.fillna(0.0, subset=feats)
    cv = train_oof(filled, feats, target, id_col, split, learner, metric)
    model, pred = train_full(filled, feats, target, learner,
                             meta_test.fillna(0.0, subset=feats) if meta_test is not None else None)
    return cv, model, pred


# ------------------------------------------------------------------ P8
def sample_params(space: dict, n_trials: int, seed: int = 42) -> list[dict]:
    """Seeded random parameters. `space` maps a parameter to ("float", lo, hi[,
    "log"]), ("int", lo, hi[, step]) or ("cat", [choices])."""
    import math
    import random

    rnd, out = random.Random(seed), []
    for _ in range(n_trials):
        params = {}
        for name, spec in space.items():
            if spec[0] == "float":
                lo, hi = spec[1], spec[2]
                params[name] = (math.exp(rnd.uniform(math.log(lo), math.log(hi))) if len(spec) > 3 and spec[3] == "log"
                                else rnd.uniform(lo, hi))
            elif spec[0] == "int":
                params[name] = rnd.randrange(spec[1], spec[2] + 1, spec[3] if len(spec) > 3 else 1)
            elif spec[0] == "cat":
                params[name] = rnd.choice(spec[1])
            else:
                raise ValueError(f"parameter {name!r}: unknown kind {spec[0]!r}; choose float, int or cat")
        out.append(params)
    return out


class SearchResult:
    """`trials`: one row a trial (trial, one column a parameter, status, folds,
    mean_score, std_score, error), best first; `best_params` with their own
    types; `best_score`; `scores`: (trial, fold, score) of every fold run."""

    def __init__(self, trials: DataFrame, scores: DataFrame, best_params: dict | None, best_score: float | None):
        self.trials, self.scores, self.best_params, self.best_score = trials, scores, best_params, best_score

    def learner(self, kind: str, task: str = "classification", **fixed):
        """A learner with the best parameters."""
        from .models import Learner

        return Learner(kind, task, **{**fixed, **(self.best_params or {})})


def search_params(train: DataFrame, features, target: str, split, make, space: dict, metric, n_trials: int = 10,
                  seed: int = 42, keep: float = 0.5, first_folds: int = 1) -> SearchResult:
    """Seeded random search with successive halving over the folds.

    Folds are assigned once. All trials run `first_folds` folds; then the best
    `keep` share of those still running (by mean score so far, ties by trial)
    runs as many folds again, and so on until all folds are done: bad trials
    stop after their first folds ("pruned"). A trial that raises is "failed" and
    left out, the search goes on. `make(**params)` gives a learner. Only trials
    with all folds compete for the best parameters."""
    import math

    spark = train.sparkSession
    params = sample_params(space, n_trials, seed)
    folds = list(split.pairs(train))
    scores: dict[int, list] = {t: [] for t in range(n_trials)}
    status, errors = dict.fromkeys(scores, "running"), dict.fromkeys(scores)
    mean = (lambda t: sum(s for _, s in scores[t]) / len(scores[t]))
    order = (lambda t: (-mean(t) if metric.greater_is_better else mean(t), t))
    done, live = 0, list(scores)
    while live and done < len(folds):
        upto = min(max(done * 2, first_folds), len(folds))
        for t in live:
            try:
                learner = make(**params[t])
                for fold, tr, va in folds[done:upto]:
                    pred = learner.fit(tr, features, target, valid=va).predict(va, "__p")
                    score = metric.frame(pred, target, "__p").first()["score"]
                    if score is None or not math.isfinite(score):
                        raise ValueError(f"no score on fold {fold}")
                    scores[t].append((int(fold), float(score)))
            except Exception as e:  # noqa: BLE001 - a failed trial must not end the search
                status[t], errors[t] = "failed", f"{type(e).__name__}: {e}".split("\n")[0][:200]
        live = sorted((t for t in live if status[t] == "running"), key=order)
        done = upto
        if done < len(folds):
            stay = max(1, math.ceil(len(live) * keep))
            for t in live[stay:]:
                status[t] = "pruned"
            live = live[:stay]
    for t in live:
        status[t] = "complete"
    kinds = {k: "double" if v[0] == "float" else "long" if v[0] == "int" else _choice_type(v[1]) for k, v in space.items()}
    rows = []
    for t in sorted(scores, key=lambda t: (status[t] != "complete", not scores[t], order(t) if scores[t] else (0, t))):
        got = [s for _, s in scores[t]]
        m = sum(got) / len(got) if got else None
        sd = math.sqrt(sum((x - m) ** 2 for x in got) / len(got)) if got else None
        rows.append((t, *[str(params[t][k]) if kinds[k] == "string" else params[t][k] for k in space],
                     status[t], len(got), m, sd, errors[t]))
    schema = ", ".join(["trial int", *[f"`{k}` {kinds[k]}" for k in space],
                        "status string, folds int, mean_score double, std_score double, error string"])
    long_t = spark.createDataFrame([(t, f, s) for t in scores for f, s in scores[t]], "trial int, fold int, score double")
    best = live[0] if live else None
    return SearchResult(spark.createDataFrame(rows, schema), long_t, None if best is None else params[best],
                        None if best is None else mean(best))


def _choice_type(choices) -> str:
    if all(isinstance(c, bool) for c in choices):
        return "boolean"
    if all(isinstance(c, int) for c in choices):
        return "long"
    return "double" if all(isinstance(c, (int, float)) for c in choices) else "string"


# ------------------------------------------------------------------ P9
def score_batch(models: list, df: DataFrame, id_col: str, pred_col: str = "prediction") -> DataFrame:
    """Score a feature table with saved fold models and average."""
    preds = [m.predict(df, "__p").select(id_col, "__p") for m in models]
    return reduce(lambda a, b: a.unionByName(b), preds).groupBy(id_col).agg(F.avg("__p").alias(pred_col))
