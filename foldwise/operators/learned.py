"""Model-based features (B1-B3, B5, B6) on Spark ML estimators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import cosine, dot
from .base import COMBINED, Fitted, Stage, require_columns
from .indexing import global_index
from .state import StateTable


def assemble(df: DataFrame, cols, out: str = "__features") -> DataFrame:
    """Feature vector from one array or vector column, or from any mix of
    numeric (NULL → 0), array and vector columns."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import VectorUDT

    names = [cols] if isinstance(cols, str) else list(cols)
    kind = {c: df.schema[c].dataType for c in names if c in df.columns}
    if any(isinstance(k, (VectorUDT, T.ArrayType)) for k in kind.values()) and not (
            isinstance(cols, str) and isinstance(kind.get(cols), T.ArrayType)):
        made = {}
        for i, c in enumerate(names):
            if isinstance(kind[c], T.ArrayType):
                made[f"__part{i}"] = array_to_vector(F.col(c).cast("array<double>"))
            elif not isinstance(kind[c], VectorUDT):
                made[f"__part{i}"] = F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
        parts = [f"__part{i}" if f"__part{i}" in made else c for i, c in enumerate(names)]
        return VectorAssembler(inputCols=parts, outputCol=out).transform(df.withColumns(made)).drop(*made)

    if isinstance(cols, str):
        return df.withColumn(out, array_to_vector(F.col(cols).cast("array<double>")))
    arr = F.array(*[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in cols])
    return df.withColumn(out, array_to_vector(arr))


def without_summary(model):
    """The fitted model without its training summary. The summary holds the
    session; a model that is sent to executors takes it along, which fails once
    the session has had an `Observation`."""
    if getattr(model, "hasSummary", False):
        jvm = SparkSession.getActiveSession()._jvm
        model._java_obj.setSummary(jvm.scala.Option.apply(None))
    return model


def vector_pair_similarity(df: DataFrame, u: str, v: str, prefix: str, eps: float = 1e-6) -> DataFrame:
    """`<prefix>_dot_product` and `<prefix>_cosine_similarity` =
    dot / (‖u‖·‖v‖ + eps) of two array columns."""
    return (df.withColumn(f"{prefix}_dot_product", dot(u, v))
              .withColumn(f"{prefix}_cosine_similarity", cosine(u, v, eps)))


class KMeansFeature(Stage):
    """B1: `<name>_cluster_id` = nearest centroid of a seeded k-means fit;
    `n_init` runs with successive seeds keep the lowest training cost."""

    def __init__(self, name: str, cols, n_clusters: int = 8, seed: int = 42, n_init: int = 1, max_iter: int = 20):
        super().__init__(name)
        self.cols, self.k, self.seed, self.n_init, self.max_iter = cols, n_clusters, seed, n_init, max_iter

    def fit(self, df):
        from pyspark.ml.clustering import KMeans

        data = assemble(df, self.cols).select("__features")
        best = None
        for i in range(self.n_init):
            m = KMeans(k=self.k, seed=self.seed + i, maxIter=self.max_iter, featuresCol="__features").fit(data)
            if best is None or m.summary.trainingCost < best.summary.trainingCost:
                best = m
        return _ModelFitted(self, best, lambda out: out.withColumn(
            f"{self.name}_cluster_id", F.col("prediction").cast("int")).drop("prediction"))


class PCAFeature(Stage):
    """B2: `<name>_pca_i`: projection of the centred features (NULL → 0) on
    the first components; each component's sign makes its largest-magnitude
    loading positive."""

    def __init__(self, name: str, cols, n_components: int = 2):
        super().__init__(name)
        self.cols, self.n = cols, n_components

    def fit(self, df):
        from pyspark.ml.feature import PCA, StandardScaler
        from pyspark.ml.functions import vector_to_array

        data = assemble(df, self.cols)
        sc = StandardScaler(withMean=True, withStd=False, inputCol="__features", outputCol="__centred").fit(data)
        pca = PCA(k=self.n, inputCol="__centred", outputCol="__pca").fit(sc.transform(data))
        pc = pca.pc.toArray()
        signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(self.n)]

        def build(out):
            arr = vector_to_array("__pca")
            return out.select("*", *[(arr[j] * F.lit(signs[j])).alias(f"{self.name}_pca_{j}")
                                     for j in range(self.n)]).drop("__pca", "__centred")

        return _ModelFitted(self, [sc, pca], build)


class TreeLeafFeature(Stage):
    """`<name>_tree_i_leaf` — the leaf each row reaches in every tree of a
    supervised ensemble: a forest or boosted trees (`ensemble`), for
    classification (two classes when boosted) or regression."""

    def __init__(self, name: str, feature_cols, target_col: str, task: str = "classification",
                 n_trees: int = 10, max_depth: int = 5, seed: int = 42, ensemble: str = "forest"):
        super().__init__(name)
        if ensemble not in ("forest", "boosted"):
            raise ValueError(f"unknown ensemble {ensemble!r}; choose forest or boosted")
        self.cols, self.target, self.task, self.ensemble = feature_cols, target_col, task, ensemble
        self.n_trees, self.max_depth, self.seed = n_trees, max_depth, seed

    def fit(self, df):
        from pyspark.ml import classification as C
        from pyspark.ml import regression as R
        from pyspark.ml.functions import vector_to_array

        data = assemble(df, self.cols).withColumn("__label", F.col(self.target).try_cast("double"))
        where, trees = (C, "Classifier") if self.task == "classification" else (R, "Regressor")
        kind, size = ("RandomForest", "numTrees") if self.ensemble == "forest" else ("GBT", "maxIter")
        est = getattr(where, kind + trees)(maxDepth=self.max_depth, seed=self.seed, featuresCol="__features",
                                           labelCol="__label", leafCol="__leaf", **{size: self.n_trees})
        m = without_summary(est.fit(data.where(F.col("__label").isNotNull())))
        n = m.getNumTrees if isinstance(m.getNumTrees, int) else m.getNumTrees()

        def build(out):
            arr = vector_to_array("__leaf")
            keep = [c for c in out.columns if c not in ("__leaf", "prediction", "rawPrediction", "probability")]
            return out.select(*keep, *[arr[i].cast("int").alias(f"{self.name}_tree_{i}_leaf") for i in range(n)])

        return _ModelFitted(self, m, build)


class _ModelFitted(Fitted):
    def __init__(self, stage, model, finish):
        super().__init__(stage)
        self.model, self.finish = model, finish

    def transform(self, df):
        data = assemble(df, self.stage.cols)
        models = self.model if isinstance(self.model, list) else [self.model]
        for m in models:
            data = m.transform(data)
        return self.finish(data).drop("__features", "__label")


# ratings that one block of a factorisation should have; ALS makes 10 blocks at least
BLOCK_RATINGS, LEAST_BLOCKS, MOST_BLOCKS = 1 << 20, 10, 1000


class ALSFactors(Stage):
    """Implicit-feedback matrix factorisation of user × item interaction
    counts (repeated pairs add up). Adds `<name>_user_i`, `<name>_item_i`,
    `<name>_dot_product` and `<name>_cosine_similarity`; ids never seen in
    the fit get zero vectors. Ids are mapped to dense integer codes through
    state tables (ALS needs int ids).

    A task of ALS holds the ratings of one block of users (or items) and the
    factors of all items (users) that they rate, so the number of blocks grows
    with the ratings: a block has `BLOCK_RATINGS` or so. The shuffles of an
    iteration are deleted behind its checkpoint."""

    fit_scope = COMBINED

    def __init__(self, name: str, user_col: str, item_col: str, factors: int = 32, reg: float = 0.01,
                 iterations: int = 10, alpha: float = 1.0, seed: int = 42, wide: bool = True):
        super().__init__(name)
        self.u, self.i, self.rank, self.reg, self.iters = user_col, item_col, factors, reg, iterations
        self.alpha, self.seed, self.wide = alpha, seed, wide

    def fit(self, df):
        from pyspark.ml.recommendation import ALS

        require_columns(df, [self.u, self.i], self.name)
        codes = {}
        for c in (self.u, self.i):
            d = df.select(c).where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__rows"))
            codes[c] = StateTable.build(global_index(d, [c], "__code").select(
                c, F.col("__code").cast("int").alias("__code"), "__rows"))
        inter = (df.where(F.col(self.u).isNotNull() & F.col(self.i).isNotNull())
                   .groupBy(self.u, self.i).agg(F.count(F.lit(1)).cast("float").alias("__n")))
        ratings = min(s.df.agg(F.sum("__rows")).first()[0] or 0 for s in codes.values())  # or fewer, if pairs repeat
        blocks = min(max(LEAST_BLOCKS, -(-ratings // BLOCK_RATINGS)), MOST_BLOCKS)
        inter = (inter.join(codes[self.u].side().select(self.u, F.col("__code").alias("__uc")), self.u)
                      .join(codes[self.i].side().select(self.i, F.col("__code").alias("__ic")), self.i))
        als = ALS(rank=self.rank, regParam=self.reg, maxIter=self.iters, alpha=self.alpha, implicitPrefs=True,
                  userCol="__uc", itemCol="__ic", ratingCol="__n", seed=self.seed, nonnegative=False,
                  numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1)
        model = als.fit(inter)
        uf = codes[self.u].df.join(model.userFactors.withColumnRenamed("id", "__code"), "__code") \
                             .select(self.u, F.col("features").alias("__uf"))
        itf = codes[self.i].df.join(model.itemFactors.withColumnRenamed("id", "__code"), "__code") \
                              .select(self.i, F.col("features").alias("__if"))
        return _ALSFitted(self, StateTable.build(uf), StateTable.build(itf))


class _ALSFitted(Fitted):
    def __init__(self, stage, uf, itf):
        super().__init__(stage)
        self.uf, self.itf = uf, itf

    def transform(self, df):
        s = self.stage
        zero = F.array_repeat(F.lit(0.0).cast("float"), s.rank)
        out = df.join(self.uf.side(), s.u, "left").join(self.itf.side(), s.i, "left")
        out = out.withColumn("__uf", F.coalesce("__uf", zero)).withColumn("__if", F.coalesce("__if", zero))
        out = vector_pair_similarity(out, "__uf", "__if", s.name)
        if s.wide:
            out = out.select("*", *[F.col("__uf")[j].alias(f"{s.name}_user_{j}") for j in range(s.rank)],
                             *[F.col("__if")[j].alias(f"{s.name}_item_{j}") for j in range(s.rank)])
            return out.drop("__uf", "__if")
        return out.withColumnRenamed("__uf", f"{s.name}_user").withColumnRenamed("__if", f"{s.name}_item")
