"""Physical-plan properties the scale design relies on."""

import pytest
from pyspark.sql import functions as F

from foldwise.operators.neighbors import knn_join
from foldwise.operators.ranking import group_sort_topk
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_has_partial_group_limit_before_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS g", "rand(1) AS s", "id")
    p = plan(group_sort_topk(df, ["g"], "s", 3, tie="id"))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    p = plan(o.where(F.col("o_orderstatus") == "F").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p


def test_knn_plan_has_no_cartesian_product(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    p = plan(knn_join(e, e, "vec_id", "embedding", 3, exclude_self=True))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
