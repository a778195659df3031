"""Learners (L1-L6) on Spark ML.

One `Learner` covers the reference's model wrappers: gradient-boosted trees
(the three booster wrappers re-aimed at Spark's GBT), random forest, L2
logistic regression, ridge regression and a linear SVM. `predict` adds a
`prediction` column: P(class 1) for probabilistic classifiers, the margin for
the SVM, the value for regressors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.learned import assemble, without_summary
from ..operators.state import StateTable
from ..session import cut_lineage, spread

KINDS = ("gbt", "forest", "logit", "ridge", "linear_svm")


def _estimator(kind: str, task: str, params: dict):
    from pyspark.ml import classification as C
    from pyspark.ml import regression as R

    p = dict(params)
    common = {"featuresCol": "__features", "labelCol": "__label"}
    if kind == "gbt":
        cls = C.GBTClassifier if task == "classification" else R.GBTRegressor
    elif kind == "forest":
        cls = C.RandomForestClassifier if task == "classification" else R.RandomForestRegressor
    elif kind == "logit":
        cls, task = C.LogisticRegression, "classification"
        p.setdefault("elasticNetParam", 0.0)
    elif kind == "ridge":
        cls, task = R.LinearRegression, "regression"
        p.setdefault("elasticNetParam", 0.0)
    elif kind == "linear_svm":
        cls, task = C.LinearSVC, "classification"
    else:
        raise ValueError(f"unknown learner {kind!r}; choose from {KINDS}")
    return cls(**common, **p)


# rows above which a regression's equal feature rows are merged before boosting
MERGE_ROWS = 1 << 20
# parameters under which only sums over a node's rows decide
SUMS_DECIDE = {"maxIter", "maxDepth", "maxBins", "stepSize", "seed", "minInfoGain", "maxMemoryInMB", "cacheNodeIds",
               "checkpointInterval"}


def _merged(data: DataFrame, features) -> DataFrame | None:
    """Rows of features and label as weighted rows that boosting with squared
    loss can't tell from them: rows of equal features meet in every node, where
    only their number, sum and sum of squares count. Two rows of half the weight
    at mean plus and minus standard deviation have the same three. None where few
    rows are given or merging would leave more than a quarter of them."""
    names = [features] if isinstance(features, str) else list(features)
    if not all(isinstance(data.schema[c].dataType, T.AtomicType) for c in names):
        return None
    keys = data.select(F.xxhash64(*names).alias("k"))
    kinds, rows = keys.agg(F.approx_count_distinct("k"), F.count(F.lit(1))).first()
    if rows <= MERGE_ROWS or 8 * kinds > rows:
        return None
    y = F.col("__label")
    cell = data.groupBy(*names).agg(F.avg(y).alias("__m"), F.stddev_pop(y).alias("__s"), F.count(y).cast("double").alias("__n"))
    two = F.when(F.col("__s") > 0, F.array(F.lit(-1.0), F.lit(1.0))).otherwise(F.array(F.lit(0.0)))
    return cut_lineage(
        cell.withColumn("__two", two).withColumn("__side", F.explode("__two"))
            .select(*names, (F.col("__m") + F.col("__side") * F.col("__s")).alias("__label"),
                    (F.col("__n") / F.size("__two")).alias("__weight")))


class Learner:
    """`early_stopping=True` (GBT only): when the flow passes a validation
    frame (the fold's valid rows, like an eval set), boosting stops once the
    validation error stops improving (`validationIndicatorCol`)."""

    def __init__(self, kind: str = "gbt", task: str = "classification", early_stopping: bool = False, **params):
        if kind not in KINDS:
            raise ValueError(f"unknown learner {kind!r}; choose from {KINDS}")
        self.kind, self.task, self.params, self.early_stopping = kind, task, params, early_stopping

    def fit(self, df: DataFrame, features, label: str, valid: DataFrame | None = None) -> "FittedModel":
        params, label = dict(self.params), F.col(label).try_cast("double")
        if (self.kind, self.task) == ("gbt", "regression") and set(params) <= SUMS_DECIDE and (
                valid is None or not self.early_stopping):
            few = _merged(df.withColumn("__label", label).where(F.col("__label").isNotNull()), features)
            if few is not None:
                model = _estimator(self.kind, self.task, params | {"weightCol": "__weight"}).fit(assemble(few, features))
                return FittedModel(without_summary(model), features, self.kind, self.task)
        # learners keep a task's rows in one block: a large scan is cut into small ones
        src = spread(df, always=False).withColumn("__valid", F.lit(False))
        if valid is not None and self.early_stopping and self.kind == "gbt":
            src = src.unionByName(valid.withColumn("__valid", F.lit(True)))
            params["validationIndicatorCol"] = "__valid"
        data = assemble(src, features).withColumn("__label", label)
        model = _estimator(self.kind, self.task, params).fit(data.where(F.col("__label").isNotNull()))
        return FittedModel(without_summary(model), features, self.kind, self.task)


class KeyMeanLearner:
    """Baseline learner: the prediction is the mean label of the rows with the
    same keys, drawn towards the overall mean by `smoothing` rows of it; unseen
    and NULL keys get the overall mean. One aggregate to fit, one join to apply."""

    def __init__(self, smoothing: float = 0.0):
        if smoothing < 0:
            raise ValueError("smoothing is a number of rows, 0 or more")
        self.smoothing = float(smoothing)

    def fit(self, df: DataFrame, features, label: str, valid: DataFrame | None = None) -> "KeyMeanModel":
        y, keys = F.col(label).try_cast("double"), list(features)
        rows = df.where(y.isNotNull())
        overall = rows.agg(F.avg(y)).first()[0]
        known = rows.dropna(subset=keys).groupBy(*keys).agg(F.sum(y).alias("__s"), F.count(y).alias("__n"))
        m = F.lit(self.smoothing)
        mean = (F.col("__s") + m * F.lit(overall).cast("double")) / (F.col("__n") + m)
        return KeyMeanModel(StateTable.build(known.select(*keys, mean.alias("__mean"))), keys, overall)


class KeyMeanModel:
    def __init__(self, state: StateTable, keys: list[str], overall: float | None):
        self.state, self.keys, self.overall = state, keys, overall

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        keep = [F.col(f"`{c}`") for c in df.columns if c != out]
        joined = df.join(self.state.side(), self.keys, "left")
        return joined.select(*keep, F.coalesce("__mean", F.lit(self.overall).cast("double")).alias(out))


class FittedModel:
    def __init__(self, model, features, kind: str, task: str):
        self.model, self.features, self.kind, self.task = model, features, kind, task

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        res = self.model.transform(assemble(df, self.features))
        if self.kind == "linear_svm":
            pred = vector_to_array("rawPrediction")[1]
        elif self.task == "classification" or self.kind == "logit":
            pred = vector_to_array("probability")[1]
        else:
            pred = F.col("prediction")
        keep = [F.col(f"`{c}`") for c in df.columns if c != out]
        return res.select(*keep, pred.cast("double").alias(out))

    def feature_importances(self) -> list[float] | None:
        fi = getattr(self.model, "featureImportances", None)
        return fi.toArray().tolist() if fi is not None else None

    # L6
    def save(self, path: str) -> str:
        self.model.write().overwrite().save(path)
        return path

    @classmethod
    def load(cls, path: str, features, kind: str, task: str) -> "FittedModel":
        from pyspark.ml import classification as C
        from pyspark.ml import regression as R

        loaders = {("gbt", "classification"): C.GBTClassificationModel, ("gbt", "regression"): R.GBTRegressionModel,
                   ("forest", "classification"): C.RandomForestClassificationModel,
                   ("forest", "regression"): R.RandomForestRegressionModel,
                   ("logit", "classification"): C.LogisticRegressionModel,
                   ("ridge", "regression"): R.LinearRegressionModel,
                   ("linear_svm", "classification"): C.LinearSVCModel}
        key = (kind, "classification" if kind in ("logit", "linear_svm") else
               ("regression" if kind == "ridge" else task))
        return cls(loaders[key].load(path), features, kind, task)
