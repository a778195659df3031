"""The registered check queries: every key runs, and the cheap SQL-checked
ones agree with DuckDB on the small test tables."""

import os

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

CHEAP = ["group_stats", "rolling_stats", "quantile_bin", "hash_encode", "target_encode", "date_parts",
         "text_stats", "tfidf", "roc_auc", "average_precision", "qwk", "map_at_k", "split_kfold",
         "split_stratified", "knn_join", "lookup_join_two_defaults", "feature_build", "apply_stream"]


def test_every_query_has_a_callable_and_oracles_are_subset():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 100
    assert set(o) <= set(q)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "user_id_mean_value" in df.columns


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
def test_cheap_queries_match_duckdb(spark):
    import duckdb

    from tools.oracle_check import TABLES, digest

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    q, o = E.queries(), E.oracle_sql()
    for k in CHEAP:
        sdf = q[k](spark, SF_SMALL)
        res = con.execute(o[k])
        dcols = [d[0] for d in res.description]
        assert sorted(sdf.columns) == sorted(dcols), k
        assert digest([tuple(r) for r in sdf.collect()], sdf.columns)[0] == digest(res.fetchall(), dcols)[0], k
