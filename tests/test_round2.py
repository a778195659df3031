"""Cases that small, well-behaved tables do not show: rows far from the origin,
ties, repeated and NULL ids, one value in most rows, narrow vector files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators.metrics import RocAuc
from foldwise.operators.neighbors import knn_join
from foldwise.operators.numeric import BoxCoxTransformer
from foldwise.operators.quantiles import global_quantiles, grouped_quantiles
from foldwise.operators.text import CountVectorizer, TfidfVectorizer
from foldwise.plans.flows import FeatureSetBuilder, train_oof
from foldwise.plans.folds import KFold, StratifiedKFold
from foldwise.plans.models import Learner
from foldwise.session import spread
from foldwise.sources.io import read_word_vectors, write_word_vectors


@pytest.mark.parametrize("shift,step", [(0.0, 1.0), (1e6, 1e-3), (1e8, 1e-2)])
def test_knn_far_from_origin(spark, shift, step):
    r = np.random.default_rng(3)
    x = shift + step * r.permutation(400)[:300]
    x[:20] = x[20]  # ties
    df = spark.createDataFrame([(i, [float(v)]) for i, v in enumerate(x)], "id long, v array<double>")
    got = {}
    for row in knn_join(df, df, "id", "v", 5, exclude_self=True).collect():
        got.setdefault(row["id"], {})[row["rank"]] = row["neighbor_id"]
    for i in range(len(x)):
        d = np.abs(x - x[i])
        d[i] = np.inf
        assert [got[i][k] for k in range(1, 6)] == np.lexsort((np.arange(len(x)), d))[:5].tolist()


def test_quantiles_with_a_hot_value(spark):
    v = [7.0] * 900 + list(np.linspace(0, 50, 100))
    df = spark.createDataFrame([(float(x), "a" if i % 3 else "b") for i, x in enumerate(v)], "v double, g string")
    probs = [0.0, 0.03, 0.5, 0.95, 1.0]
    assert np.allclose(global_quantiles(df, "v", probs), np.quantile(v, probs))
    got = {r["g"]: [r[f"q{k}"] for k in range(5)]
           for r in grouped_quantiles(df, "v", probs, ["g"], [f"q{k}" for k in range(5)]).df.collect()}
    for g in "ab":
        own = [x for i, x in enumerate(v) if ("a" if i % 3 else "b") == g]
        assert np.allclose(got[g], np.quantile(own, probs))
    assert global_quantiles(df.limit(0), "v", [0.5]) == [None]


@pytest.mark.parametrize("split", [KFold(4, id_col="id"), KFold(4, id_col="id", exact=False),
                                   KFold(4, id_col="id", shuffle=False), StratifiedKFold(4, y_col="y", id_col="id"),
                                   StratifiedKFold(4, y_col="y", id_col="id", exact=False)])
def test_folds_keep_every_row(spark, split):
    rows = [(i % 40, i % 3, i) for i in range(120)] + [(None, 1, 1000), (None, None, 1001), (5, None, 1002)]
    df = spark.createDataFrame(rows, "id long, y int, row long")
    out = split.assign(df)
    assert sorted(out.columns) == ["fold", "id", "row", "y"]
    got = out.collect()
    assert sorted(r["row"] for r in got) == sorted(r[2] for r in rows)
    assert all(r["fold"] in range(4) for r in got)


def test_power_search_beyond_two(spark):
    u = np.random.default_rng(0).uniform(0.05, 1, 2000)
    x = u ** (1 / 8)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    lam = BoxCoxTransformer("p", ["x"]).fit(df).state["x"]
    def llf(k):
        return (k - 1) * np.log(x).sum() - len(x) / 2 * np.log(np.var((x ** k - 1) / k))
    assert llf(lam) >= max(llf(k) for k in np.arange(0.01, 30, 0.01)) - 1e-4


def test_word_vector_files(spark, tmp_path):
    one = spark.createDataFrame([("a", [1.0]), ("12", [7.0])], "word string, vec array<float>")
    write_word_vectors(one, str(tmp_path / "one"))
    assert sorted(tuple(r) for r in read_word_vectors(spark, str(tmp_path / "one")).collect()) == [("12", [7.0]), ("a", [1.0])]
    (tmp_path / "two.txt").write_text("2 3\nx 1 2 3\ny 4 5 6\n")
    got = read_word_vectors(spark, str(tmp_path / "two.txt")).collect()
    assert sorted(r["word"] for r in got) == ["x", "y"]


def test_bag_of_words_in_features_and_learner(spark):
    rows = [(i, "the good fine day" if i % 2 else "a bad poor night", i % 2, float(i % 5)) for i in range(60)] + [(60, "?", 0, 1.0)]
    df = spark.createDataFrame(rows, "id long, t string, y int, x double")
    out, _ = FeatureSetBuilder([TfidfVectorizer("f", "t", "id", stop_words="english")]).run(df)
    assert out.columns == ["id", "t", "y", "x", "tfidf_t"] and out.count() == 61
    vocab = {r["term"] for r in CountVectorizer("c", "t", "id", stop_words="english").fit(df).vocab.df.collect()}
    assert vocab == {"good", "fine", "day", "bad", "poor", "night"}
    res = train_oof(out, ["x", "tfidf_t"], "y", "id", StratifiedKFold(3, y_col="y", id_col="id"),
                    Learner("logit"), RocAuc())
    assert res.oof.count() == 61
    assert res.oof.where((F.col("oof_pred") > 0.5) == (F.col("y") == 1)).count() >= 60


def test_spread_runs_no_job(spark):
    sc = spark.sparkContext
    g = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
    sc.setJobGroup("spread-test", "spread")
    spread(g)
    assert not list(sc.statusTracker().getJobIdsForGroup("spread-test"))
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_metrics_cache_nothing(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.createDataFrame([(i, i % 2, float(i % 7)) for i in range(50)], "id long, y int, s double")
    RocAuc().compute(df, "y", "s") if hasattr(RocAuc(), "compute") else None
    assert 0 <= RocAuc()(df, "y", "s") <= 1
    StratifiedKFold(3, y_col="y", id_col="id").assign(df).count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
