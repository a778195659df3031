"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one test table (pruning / pushdown by Catalyst)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Feature-set scan."""
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV scan. With a schema there is no inference pass over the
    data; without one Spark samples the files to infer types (small inputs)."""
    r = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", "true").csv(path)


def write_feature_set(train: DataFrame, test: DataFrame | None, out_dir: str, name: str) -> dict:
    """S3: `<out>/<name>/split=train|test` parquet. Returns the written paths."""
    base = f"{out_dir.rstrip('/')}/{name}"
    paths = {"train": f"{base}/split=train"}
    train.write.mode("overwrite").parquet(paths["train"])
    if test is not None:
        paths["test"] = f"{base}/split=test"
        test.write.mode("overwrite").parquet(paths["test"])
    return paths


def write_predictions(df: DataFrame, id_col: str, pred_col: str, path: str, out_name: str | None = None,
                      fmt: str = "csv") -> str:
    """`(id, prediction)` file — out-of-fold or submission."""
    out = df.select(F.col(id_col), F.col(pred_col).alias(out_name or pred_col))
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.parquet(path)
    return path


def write_feature_list(features: DataFrame, path: str, col: str = "feature") -> str:
    """Ranked feature names, one per line (single ordered text file; the
    list is already reduced to the chosen top-N)."""
    features.select(F.col(col).cast("string")).coalesce(1).write.mode("overwrite").text(path)
    return path


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    return [r[0] for r in spark.read.text(path).collect()]


def read_word_vectors(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """word2vec / GloVe text format `word v1 … vN` → (word, vec array<float>).
    A header line `count dim` is left out: two integers that are the number and
    the width of the file's other lines."""
    parts = F.split(F.trim(F.col("value")), " ")
    lines = spark.read.text(path).select(F.input_file_name().alias("f"), parts.alias("p")).where("p[0] <> ''")
    if header:
        # one row a file
        whole = lines.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("p") - 1).alias("dim"))
        head = ((F.size("p") == 2) & (F.col("p")[0] == (F.col("n") - 1).cast("string"))
                & (F.col("p")[1] == F.col("dim").cast("string")))
        lines = lines.join(whole, "f").where(~head)
    return lines.select(F.col("p")[0].alias("word"),
                        F.transform(F.expr("slice(p, 2, size(p) - 1)"), lambda x: x.cast("float")).alias("vec"))


def write_word_vectors(vectors: DataFrame, path: str, word_col: str = "word", vec_col: str = "vec") -> str:
    """Text form of a (word, vector) table (no header line)."""
    line = F.concat_ws(" ", F.col(word_col), F.array_join(F.transform(vec_col, lambda x: x.cast("string")), " "))
    vectors.select(line.alias("value")).write.mode("overwrite").text(path)
    return path
