import math
import string

import numpy as np
import pytest

from foldwise.operators.neighbors import NearestNeighborFeatures, knn_join
from foldwise.operators.text import CountVectorizer, TextStatistics, TfidfVectorizer, pool_token_embeddings

TEXTS = ["Hello World. Is it ok?", "  two  spaces\tand\nnewline ", "", None, "Ünïcode wörds, ÉTÉ été!"]


def test_text_stats_match_python(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    out = {r["id"]: r for r in TextStatistics("s", ["t"]).transform(df).collect()}
    for i, t in enumerate(TEXTS):
        t = t or ""
        w = t.split()
        r = out[i]
        assert r["t_text_length"] == len(t)
        assert r["t_word_count"] == len(w)
        assert r["t_unique_word_count"] == len(set(w))
        assert r["t_avg_word_length"] == pytest.approx(len("".join(t.split())) / (len(w) + 1e-6))
        assert r["t_sentence_count"] == sum(t.count(c) for c in ".!?") + 1
        assert r["t_punctuation_count"] == sum(1 for c in t if c in string.punctuation)
        assert r["t_uppercase_count"] == sum(1 for c in t if "A" <= c <= "Z")


def test_tfidf_matches_manual(spark):
    docs = ["a cat sat", "the cat", "dog dog cat", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    st = TfidfVectorizer("tf", "t", "id")
    got = {(r["id"], r["feature"]): r["value"] for r in st.fit(df).transform(df).collect()}
    n = len(docs)
    toks = [[w for w in d.lower().split() if len(w) >= 2] for d in docs]
    vocab = sorted({w for t in toks for w in t})
    dfreq = {w: sum(w in t for t in toks) for w in vocab}
    for i, t in enumerate(toks):
        raw = {w: t.count(w) * (math.log((1 + n) / (1 + dfreq[w])) + 1) for w in set(t)}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        for w, v in raw.items():
            assert got[(i, f"tfidf_t_{w}")] == pytest.approx(v / norm)
    counts = {(r["id"], r["feature"]): r["value"] for r in CountVectorizer("c", "t", "id", max_features=2).fit(df).transform(df).collect()}
    assert {f for _, f in counts} == {"countvec_t_cat", "countvec_t_dog"}


def test_mean_pool_masked(spark):
    df = spark.createDataFrame([("s", 0, [1.0, 2.0], 1), ("s", 1, [3.0, 6.0], 1), ("s", 2, [100.0, 100.0], 0)],
                               "g string, pos int, v array<double>, m int")
    assert pool_token_embeddings(df, "g", "pos", "v", "m").first()["pooled"] == [2.0, 4.0]
    assert pool_token_embeddings(df, "g", "pos", "v", "m", "cls").first()["pooled"] == [1.0, 2.0]


@pytest.mark.parametrize("clustered,block", [(False, 2048), (True, 2048), (True, 16)])
def test_knn_join_exact_against_brute_force(spark, clustered, block):
    rng = np.random.default_rng(7)
    n, d = 300, 6
    x = rng.normal(size=(n, d))
    if clustered:
        x = np.vstack([x[:200] * 0.01 + 5, x[200:]])  # one crowded cell
        x[10] = x[11]  # exact duplicate
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(n)], "id int, v array<double>")
    got = knn_join(df, df, "id", "v", 4, exclude_self=True, n_pivots=8, block=block).toPandas()
    dist = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    for i in range(n):
        order = sorted((dist[i, j], j) for j in range(n) if j != i)[:4]
        mine = got[got["id"] == i].sort_values("rank")
        assert list(mine["neighbor_id"]) == [j for _, j in order]
        assert np.allclose(mine["dist"], [dd for dd, _ in order])


def test_knn_features_population_std(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 1.0, 3.0), (3, 3.0, 5.0), (4, None, 7.0)],
                               "id int, x double, t double")
    out = NearestNeighborFeatures("nn", ["x"], ["t"], "id", 2, ["mean", "std"]).fit(df).transform(df)
    r = {row["id"]: row for row in out.collect()}
    # id 1 (x=0): neighbours id 4 (x=NULL→0, d=0) and id 2 (d=1)
    assert r[1]["nn_dist_mean"] == pytest.approx(0.5) and r[1]["nn_dist_std"] == pytest.approx(0.5)
    assert r[1]["nn_t_neighbor_mean"] == pytest.approx(5.0)


def test_vector_form_equals_long_form(spark):
    docs = ["a cat sat", "the cat", "dog dog cat", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    for cls, prefix in ((CountVectorizer, "countvec"), (TfidfVectorizer, "tfidf")):
        f = cls("v", "t", "id").fit(df)
        longf = {(r["id"], r["feature"]): r["value"] for r in f.transform(df).collect()}
        vocab = sorted({feat[len(prefix) + 3:] for _, feat in longf})
        for r in f.to_vectors(df).collect():
            v = r["features"].toArray()
            for j, term in enumerate(vocab):
                assert v[j] == pytest.approx(longf.get((r["id"], f"{prefix}_t_{term}"), 0.0))
