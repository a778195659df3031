"""Metrics (M1-M15) as aggregations.

Every metric is `metric.frame(df, y, p, by=None)` → a DataFrame with one row
per group of `by` (one row overall) and a `score` column; `metric(df, y, p)`
collects the single number. Scores are computed with aggregates, never by
collecting rows: rank metrics (AUC, AP) work on the distinct-score table with
distributed running sums, mAP@k on the per-group top k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import group_sort_topk, running_totals

DOUBLE_EPS = 2.220446049250313e-16  # machine epsilon of float64 (fixed value)


def _c(x):
    return F.col(x) if isinstance(x, str) else x


class Metric:
    name = "metric"
    greater_is_better = True

    def frame(self, df: DataFrame, y, p, by=None) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def __call__(self, df: DataFrame, y, p, **kw) -> float:
        return self.frame(df, y, p, **kw).first()["score"]

    @staticmethod
    def _agg(df, by, expr):
        by = list(by or [])
        return df.groupBy(*by).agg(expr.alias("score")) if by else df.agg(expr.alias("score"))


# ------------------------------------------------------------------ classification
class Accuracy(Metric):
    """M1: mean((p > threshold) == y)."""

    name = "accuracy"

    def __init__(self, threshold: float = 0.5):
        self.threshold = threshold

    def frame(self, df, y, p, by=None):
        hit = ((_c(p) > F.lit(self.threshold)).cast("int") == _c(y).cast("int")).cast("double")
        return self._agg(df, by, F.avg(hit))


class _Confusion(Metric):
    """Per-class TP/FP/FN on thresholded predictions, then averaged:
    binary (class 1), micro, macro (classes present in y or prediction),
    weighted (by true support). Empty denominators give 0."""

    def __init__(self, threshold: float = 0.5, average: str = "binary"):
        if average not in ("binary", "micro", "macro", "weighted"):
            raise ValueError(f"unsupported average {average!r}")
        self.threshold, self.average = threshold, average

    def _score(self, tp, fp, fn):  # pragma: no cover - abstract
        raise NotImplementedError

    @staticmethod
    def _ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    def frame(self, df, y, p, by=None):
        by = list(by or [])
        pred = (_c(p) > F.lit(self.threshold)).cast("long")
        conf = df.groupBy(*by, _c(y).cast("long").alias("__y"), pred.alias("__q")).agg(F.count(F.lit(1)).alias("n"))
        same = F.col("__y") == F.col("__q")
        per = conf.select(*by, F.explode(F.array(
            F.struct(F.col("__y").alias("c"), F.when(same, F.col("n")).otherwise(0).alias("tp"),
                     F.lit(0).cast("long").alias("fp"), F.when(same, 0).otherwise(F.col("n")).alias("fn"),
                     F.col("n").alias("sup")),
            F.struct(F.col("__q").alias("c"), F.lit(0).cast("long").alias("tp"),
                     F.when(same, 0).otherwise(F.col("n")).alias("fp"), F.lit(0).cast("long").alias("fn"),
                     F.lit(0).cast("long").alias("sup")))).alias("s")).select(*by, "s.*")
        cls = per.groupBy(*by, "c").agg(*[F.sum(k).cast("double").alias(k) for k in ("tp", "fp", "fn", "sup")])
        cls = cls.withColumn("sc", self._score(F.col("tp"), F.col("fp"), F.col("fn")))
        if self.average == "binary":
            expr = F.coalesce(F.max(F.when(F.col("c") == 1, F.col("sc"))), F.lit(0.0))
        elif self.average == "macro":
            expr = F.avg("sc")
        elif self.average == "weighted":
            expr = self._ratio(F.sum(F.col("sc") * F.col("sup")), F.sum("sup"))
        else:
            expr = self._score(F.sum("tp"), F.sum("fp"), F.sum("fn"))
        return self._agg(cls, by, expr)


class Precision(_Confusion):
    """M2: TP / (TP + FP)."""

    name = "precision"

    def _score(self, tp, fp, fn):
        return self._ratio(tp, tp + fp)


class Recall(_Confusion):
    """M3: TP / (TP + FN)."""

    name = "recall"

    def _score(self, tp, fp, fn):
        return self._ratio(tp, tp + fn)


class F1(_Confusion):
    """M4: 2TP / (2TP + FP + FN)."""

    name = "f1"

    def _score(self, tp, fp, fn):
        return self._ratio(2 * tp, 2 * tp + fp + fn)


class LogLoss(Metric):
    """M5: −mean(y ln p + (1 − y) ln(1 − p)), p clipped to [eps, 1 − eps]."""

    name = "log_loss"
    greater_is_better = False

    def __init__(self, eps: float = DOUBLE_EPS):
        self.eps = eps

    def frame(self, df, y, p, by=None):
        q = F.least(F.greatest(_c(p).cast("double"), F.lit(self.eps)), F.lit(1 - self.eps))
        t = _c(y).cast("double")
        return self._agg(df, by, -F.avg(t * F.log(q) + (1 - t) * F.log(1 - q)))


def _score_table(df, y, p, by):
    """Distinct-score table: per (group, score) the positive and negative counts."""
    t = _c(y).cast("double")
    return df.groupBy(*by, _c(p).cast("double").alias("s")).agg(F.sum(t).alias("pos"), F.sum(1 - t).alias("neg"))


class RocAuc(Metric):
    """M6: rank-sum AUC with tied scores counted half —
    Σ_s pos_s·(neg below s + neg_s/2) / (P·N). NULL when a class is absent."""

    name = "roc_auc"

    def frame(self, df, y, p, by=None):
        by = list(by or [])
        st = _score_table(df, y, p, by)
        cum = running_totals(st, by, [F.col("s").asc()], {"cneg": F.col("neg")})
        part = cum.select(*by, (F.col("pos") * (F.col("cneg") - F.col("neg") + F.col("neg") / 2)).alias("a"),
                          "pos", "neg")
        expr = F.sum("a") / (F.sum("pos") * F.sum("neg"))
        return self._agg(part, by, F.when((F.sum("pos") > 0) & (F.sum("neg") > 0), expr))


class AveragePrecision(Metric):
    """M7: Σ over distinct thresholds (descending) of (R_n − R_{n−1})·P_n."""

    name = "average_precision"

    def frame(self, df, y, p, by=None):
        by = list(by or [])
        st = _score_table(df, y, p, by)
        cum = running_totals(st, by, [F.col("s").desc()], {"tp": F.col("pos"), "fp": F.col("neg")})
        part = cum.select(*by, (F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("a"), "pos")
        return self._agg(part, by, F.when(F.sum("pos") > 0, F.sum("a") / F.sum("pos")).otherwise(F.lit(0.0)))


# ------------------------------------------------------------------ regression
class Mae(Metric):
    """M8: mean |y − p|."""

    name = "mae"
    greater_is_better = False

    def frame(self, df, y, p, by=None):
        return self._agg(df, by, F.avg(F.abs(_c(y) - _c(p))))


class Mape(Metric):
    """M9: mean(|y − p| / max(|y|, eps)) as a fraction."""

    name = "mape"
    greater_is_better = False

    def frame(self, df, y, p, by=None):
        return self._agg(df, by, F.avg(F.abs(_c(y) - _c(p)) / F.greatest(F.abs(_c(y)), F.lit(DOUBLE_EPS))))


class Rmse(Metric):
    """sqrt(mean (y − p)²)."""

    name = "rmse"
    greater_is_better = False

    def frame(self, df, y, p, by=None):
        return self._agg(df, by, F.sqrt(F.avg(F.pow(_c(y) - _c(p), 2))))


class Rmsle(Metric):
    """RMSE of ln(1 + ·), predictions clipped at 0."""

    name = "rmsle"
    greater_is_better = False

    def frame(self, df, y, p, by=None):
        d = F.log1p(_c(y)) - F.log1p(F.greatest(_c(p), F.lit(0.0)))
        return self._agg(df, by, F.sqrt(F.avg(d * d)))


class R2(Metric):
    """1 − SS_res / SS_tot (constant y: 1 if perfect else 0)."""

    name = "r2"

    def frame(self, df, y, p, by=None):
        ssr = F.sum(F.pow(_c(y) - _c(p), 2))
        sst = F.var_pop(_c(y)) * F.count(_c(y))
        return self._agg(df, by, F.when(sst > 0, 1 - ssr / sst).when(ssr == 0, F.lit(1.0)).otherwise(F.lit(0.0)))


class QWK(Metric):
    """Quadratic weighted kappa of y against half-even rounded p. Weights
    are squared differences of the label *positions* in the sorted union of
    labels. The expected-agreement term Σ w·a_i·b_j / n expands into moments of
    the two marginals, so no label × label table is built."""

    name = "qwk"

    def frame(self, df, y, p, by=None):
        by = list(by or [])
        # one row a pair of label and prediction from here on
        pairs = (df.groupBy(*by, _c(y).cast("long").alias("__y"), F.bround(_c(p)).cast("long").alias("__q"))
                 .agg(F.count(F.lit(1)).cast("double").alias("__n")).where("__y is not null and __q is not null"))
        labels = (pairs.select(*by, F.col("__y").alias("v")).unionByName(pairs.select(*by, F.col("__q").alias("v")))
                       .distinct())
        labels = labels.withColumn("i", F.dense_rank().over(Window.partitionBy(*by).orderBy("v")) - 1)
        li = labels.select(*by, F.col("v").alias("__y"), F.col("i").alias("iy"))
        lj = labels.select(*by, F.col("v").alias("__q"), F.col("i").alias("iq"))
        x = pairs.join(li, [*by, "__y"]).join(lj, [*by, "__q"])
        iy, iq, k = F.col("iy").cast("double"), F.col("iq").cast("double"), F.col("__n")
        n = F.sum(k)
        obs = F.sum(k * (iy - iq) * (iy - iq))
        exp = (F.sum(k * iy * iy) * n + n * F.sum(k * iq * iq) - 2 * F.sum(k * iy) * F.sum(k * iq)) / n
        return self._agg(x, by, F.when(exp != 0, 1 - obs / exp).otherwise(F.lit(0.0)))


class TopKAccuracy(Metric):
    """The true class is among the k highest scores. `p` is an array of
    class scores (index = class); a plain probability becomes [1 − p, p].
    Equal scores rank the higher class index first."""

    name = "top_k_accuracy"

    def __init__(self, k: int = 5):
        self.k = k

    def frame(self, df, y, p, by=None):
        dt = df.select(_c(p).alias("__p")).schema["__p"].dataType.simpleString()
        scores = _c(p) if dt.startswith("array") else F.array(1 - _c(p), _c(p))
        yy = _c(y).cast("int")
        st = F.try_element_at(scores, yy + 1)  # a label outside the vector → NULL, not an error
        idx = F.sequence(F.lit(0), F.size(scores) - 1)
        ahead = F.size(F.filter(F.arrays_zip(scores.alias("s"), idx.alias("i")),
                                lambda e: (e["s"] > st) | ((e["s"] == st) & (e["i"] > yy))))
        hit = F.when(st.isNull(), F.lit(0.0)).otherwise((ahead < self.k).cast("double"))
        return self._agg(df, by, F.avg(hit))


class MapAtK(Metric):
    """Mean over groups of AP@k = Σ_{i≤k} precision@i · rel_i divided by
    ALL relevant items of the group (0 when it has none). Ranking by score
    descending, ties by `tie`. Only the top k rows of each group move."""

    name = "map_at_k"

    def __init__(self, k: int, group_col: str, tie: str):
        self.k, self.group_col, self.tie = k, group_col, tie

    def frame(self, df, y, p, by=None):
        by = list(by or [])
        g = self.group_col
        rel = _c(y).cast("double")
        base = df.select(*by, g, self.tie, rel.alias("__r"), _c(p).alias("__s"))
        tot = base.groupBy(*by, g).agg(F.sum("__r").alias("__tot"))
        top = group_sort_topk(base, [*by, g], "__s", self.k, tie=self.tie, rank_col="__pos")
        w = Window.partitionBy(*by, g).orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
        hits = top.withColumn("__h", F.sum("__r").over(w))
        ap = (hits.groupBy(*by, g).agg(F.sum(F.col("__h") / F.col("__pos") * F.col("__r")).alias("__a"))
                  .join(tot, [*by, g]))
        ap = ap.select(*by, F.when(F.col("__tot") > 0, F.col("__a") / F.col("__tot")).otherwise(0.0).alias("ap"))
        return self._agg(ap, by, F.avg("ap"))


REGISTRY = {"accuracy": Accuracy, "precision": Precision, "recall": Recall, "f1": F1, "log_loss": LogLoss,
            "roc_auc": RocAuc, "average_precision": AveragePrecision, "mae": Mae, "mape": Mape, "rmse": Rmse,
            "rmsle": Rmsle, "r2": R2, "qwk": QWK, "top_k_accuracy": TopKAccuracy, "map_at_k": MapAtK}


def get_metric(name: str, **params) -> Metric:
    return REGISTRY[name](**params)
