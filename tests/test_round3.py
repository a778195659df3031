"""Selection, linear windows, exact trees, power search, pseudo-label rounds,
halving search, term vectors and pooling against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from foldwise.operators import quantiles as Q
from foldwise.operators.categorical import OrdinalEncoder, WoEEncoder
from foldwise.operators.groups import RollingStats
from foldwise.operators.learned import TreeLeafFeature
from foldwise.operators.metrics import Rmse, RocAuc
from foldwise.operators.neighbors import knn_join
from foldwise.operators.numeric import BoxCoxTransformer, DecisionTreeBinner, OutlierIndicator, YeoJohnsonTransformer
from foldwise.operators.text import CountVectorizer, TfidfVectorizer, WordVectorPool
from foldwise.plans.flows import PseudoLabelling, search_params
from foldwise.plans.folds import KFold
from foldwise.plans.models import KeyMeanLearner, Learner
from foldwise.session import scratch_path

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def _values(seed, n):
    r = random.Random(seed)
    pick = [lambda: r.gauss(0, 1), lambda: 10.0 ** r.randint(-4, 6), lambda: 7.0, lambda: float(r.randint(0, 9))]
    return [r.choice(pick)() for _ in range(n)]


@pytest.mark.parametrize("small", [4096, 8])
def test_column_quantiles(spark, monkeypatch, small):
    monkeypatch.setattr(Q, "SMALL", small)
    monkeypatch.setattr(Q, "BINS", 256 if small < 10 else 4096)
    v, w = _values(1, 500), _values(2, 500)
    rows = [(a, b if i % 3 else None, None) for i, (a, b) in enumerate(zip(v, w))] + [(float("nan"), 1.0, None)]
    got = Q.column_quantiles(spark.createDataFrame(rows, "v double, w double, z double"),
                             {"v": PROBS, "w": PROBS, "z": PROBS})
    for c, have in (("v", v), ("w", [b for _, b, _ in rows if b is not None])):
        assert np.allclose(got[c], np.quantile(have, PROBS), rtol=1e-12, atol=1e-300)
    assert got["z"] == [None] * len(PROBS)


def test_quantiles_of_extremes(spark):
    big = [1.7e308, -1.7e308, 5e-324, 0.0, -0.0, 1.0, float("inf"), float("-inf")] * 3
    got = Q.global_quantiles(spark.createDataFrame([(x,) for x in big], "v double"), "v", [0.0, 0.5, 1.0])
    assert got[0] == float("-inf") and got[2] == float("inf") and abs(got[1]) <= 5e-324
    one = spark.createDataFrame([(3.0,)], "v double")
    assert Q.global_quantiles(one, "v", [0.0, 0.3, 1.0]) == [3.0] * 3
    assert Q.global_quantiles(one.limit(0), "v", [0.5]) == [None]


@pytest.mark.parametrize("limit", [16384, 20])
def test_grouped_quantiles(spark, monkeypatch, limit):
    monkeypatch.setattr(Q, "SMALL_GROUP", limit)
    monkeypatch.setattr(Q, "BINS", 256)
    r = random.Random(5)
    rows = [(r.choice(["hot", "hot", "a", "b", None]), x if i % 7 else None) for i, x in enumerate(_values(3, 400))]
    rows += [("one", 4.0), ("same", 2.0)] + [("same", 2.0)] * 50
    st = Q.grouped_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", PROBS, ["g"],
                             [f"q{i}" for i in range(len(PROBS))])
    got = {x["g"]: [x[f"q{i}"] for i in range(len(PROBS))] for x in st.df.collect()}
    assert set(got) == {"hot", "a", "b", "one", "same"}
    for g, q in got.items():
        assert np.allclose(q, np.quantile([v for k, v in rows if k == g and v is not None], PROBS), rtol=1e-12, atol=1e-300)


def test_outliers_of_an_empty_column(spark):
    d = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    st = OutlierIndicator("o", ["a", "b"])
    assert [r["b_is_outlier"] for r in st.fit(d).transform(d).collect()] == [0, 0]


@pytest.mark.parametrize("bucket", [None, "7s"])
def test_rolling_against_brute_force(spark, bucket):
    r = random.Random(8)
    rows = [(i, r.choice(["a", "a", "a", "b", None]), r.choice([None, *range(0, 200, 3), *range(150, 160)]),
             r.choice([None, 5.0, 5.0, r.gauss(1e6, 1), r.uniform(-3, 3)])) for i in range(300)]
    d = spark.createDataFrame(rows, "id long, k string, s long, v double").withColumn("t", F.timestamp_seconds("s"))
    funcs = list(RollingStats.FUNCS)
    st = RollingStats("w", ["k"], "t", ["v"], ["30s", "7s"], funcs, order_col="id", bucket=bucket)
    got = {x["id"]: x for x in st.transform(d).collect()}
    assert len(got) == len(rows)
    for g in ("a", "b"):
        own = sorted((s, i, v) for i, k, s, v in rows if k == g and s is not None)
        before = None
        for s, i, v in own:
            for w, name in ((30, "30s"), (7, "7s")):
                for f in funcs:
                    have = got[i][f"k_v_rolling_{name}_{f}"]
                    if before is None:
                        assert have is None
                        continue
                    x = [q for p, _, q in own if before - w < p <= before and q is not None]
                    want = {"count": lambda: len(x), "sum": lambda: sum(x), "mean": lambda: np.mean(x), "min": lambda: min(x),
                            "max": lambda: max(x), "std": lambda: np.std(x, ddof=1) if len(x) > 1 else None}[f]
                    want = want() if x or f == "count" else None
                    assert (have is None) == (want is None), (i, name, f)
                    if want is not None:
                        assert math.isclose(have, want, rel_tol=1e-9, abs_tol=1e-9), (i, name, f, have, want)
            before = s
    for i, k, s, _ in rows:
        if k is None or s is None:
            assert got[i]["k_v_rolling_30s_count"] is None


def _tree_cuts(xs, ys, depth):
    own = sorted((x, y) for x, y in zip(xs, ys) if x is not None and y is not None)
    kinds = sorted({y for _, y in own})
    if depth == 0 or len(kinds) < 2:
        return set()
    best = None
    for i in range(1, len(own)):
        if own[i - 1][0] == own[i][0]:
            continue
        score = sum(sum(sum(1 for _, y in part if y == k) ** 2 for k in kinds) / len(part) for part in (own[:i], own[i:]))
        if best is None or score > best[0] + 1e-9:
            best = (score, i)
    if best is None:
        return set()
    i = best[1]
    rest = [_tree_cuts([x for x, _ in p], [y for _, y in p], depth - 1) for p in (own[:i], own[i:])]
    return {own[i - 1][0] / 2 + own[i][0] / 2} | rest[0] | rest[1]


def test_exact_tree_bins(spark):
    r = random.Random(4)
    rows = [(x, r.choice([x, None]), r.choice("abc") if x > 3 else r.choice("ab")) for x in (r.uniform(0, 9) for _ in range(700))]
    rows.append((5.0, 1.0, None))
    d = spark.createDataFrame(rows, "x double, z double, y string")
    st = DecisionTreeBinner("t", ["x", "z"], "y", max_depth=3)
    edges = st.fit(d).state
    for j, c in enumerate("xz"):
        want = _tree_cuts([q[j] for q in rows], [q[2] for q in rows], 3)
        assert np.allclose(edges[c][1:-1], sorted(want))
    assert st.fit(d.where("y = 'a'")).state["x"] == [d.where("y = 'a'").agg(F.min("x")).first()[0],
                                                     d.where("y = 'a'").agg(F.max("x")).first()[0]]


def _llf(x, lam, jac, t):
    v = np.var(t(np.asarray(x), lam))
    return (lam - 1) * jac - len(x) / 2 * math.log(v)


def test_power_search(spark):
    r = np.random.default_rng(3)
    a, b = np.exp(r.normal(2, 0.7, 400)), r.beta(8, 1, 400) + 0.01
    c = r.normal(0, 1, 400) ** 3
    d = spark.createDataFrame([tuple(map(float, x)) for x in zip(a, b, c)], "a double, b double, c double")
    bc = (lambda x, lam: np.log(x) if lam == 0 else (x ** lam - 1) / lam)

    def yj(x, lam):
        up = np.log1p(np.abs(x)) if lam == 0 else ((np.abs(x) + 1) ** lam - 1) / lam
        down = np.log1p(np.abs(x)) if lam == 2 else ((np.abs(x) + 1) ** (2 - lam) - 1) / (2 - lam)
        return np.where(x >= 0, up, -down)

    lam = BoxCoxTransformer("p", ["a", "b"]).fit(d).state
    for name, x in (("a", a), ("b", b)):
        at = (lambda z: _llf(x, z, np.log(x).sum(), bc))
        assert at(lam[name]) >= max(at(lam[name] + e) for e in (-0.01, -0.0002, 0.0002, 0.01))
    lam = YeoJohnsonTransformer("p", ["c"]).fit(d).state["c"]
    at = (lambda z: _llf(c, z, (np.sign(c) * np.log1p(np.abs(c))).sum(), yj))
    assert at(lam) >= max(at(lam + e) for e in (-0.01, -0.0002, 0.0002, 0.01))
    flat = spark.createDataFrame([(2.0,), (2.0,)], "a double")
    assert BoxCoxTransformer("p", ["a"]).fit(flat).state["a"] is None
    with pytest.raises(ValueError):
        BoxCoxTransformer("p", ["c"]).fit(d)


def test_woe_refuses_three_values(spark):
    d = spark.createDataFrame([("a", 0), ("a", 1), ("b", 2)], "c string, y int")
    with pytest.raises(ValueError):
        WoEEncoder("w", ["c"], "y").fit(d)


def test_ordinal_by_first_appearance(spark):
    d = spark.createDataFrame([("b", 1), ("a", 5), ("b", 9), ("c", 1), (None, 0), ("d", None)], "c string, t int")
    out = OrdinalEncoder("o", ["c"], order_col="t").fit(d).transform(d.withColumn("k", F.col("c"))).select("k", "c_ordinal").distinct()
    assert {r["k"]: r["c_ordinal"] for r in out.collect()} == {"b": 0, "c": 1, "a": 2, "d": 3, None: -1}


@pytest.fixture(scope="module")
def classes(spark):
    r = random.Random(6)
    rows = [(i, r.gauss(0, 1), r.gauss(0, 1)) for i in range(200)]
    return spark.createDataFrame([(i, a, b, int(a + 0.3 * b + r.gauss(0, 0.3) > 0)) for i, a, b in rows],
                                 "id long, a double, b double, y int")


@pytest.mark.parametrize("kind", ["logit", "forest", "linear_svm", "gbt"])
def test_learners_predict_after_an_observation(spark, classes, kind):
    seen = Observation()
    classes.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 200
    m = Learner(kind, **({"maxIter": 3} if kind == "gbt" else {})).fit(classes, ["a", "b"], "y")
    assert len(m.predict(classes).select("prediction").collect()) == 200


def _leaf(node, x, number=0):
    """Leaf ids are counted from left to right."""
    if node.subtreeDepth() == 0:
        return number
    split = node.split()
    left = node.leftChild()
    if x[split.featureIndex()] <= split.threshold():
        return _leaf(left, x, number)
    return _leaf(node.rightChild(), x, number + (left.numDescendants() + 2) // 2)


@pytest.mark.parametrize("ensemble", ["forest", "boosted"])
def test_tree_leaves_follow_the_nodes(spark, classes, ensemble):
    st = TreeLeafFeature("l", ["a", "b"], "y", n_trees=3, max_depth=3, ensemble=ensemble)
    f = st.fit(classes)
    roots = [t._java_obj.rootNode() for t in f.model.trees]
    for r in f.transform(classes).limit(40).collect():
        assert [r[f"l_tree_{i}_leaf"] for i in range(3)] == [_leaf(n, (r["a"], r["b"])) for n in roots]


def test_pseudo_label_rounds_resume(spark):
    rows = [(i, "ab"[i % 2], i % 5, int(i % 2 == 0 or i % 5 == 1)) for i in range(60)]
    train = spark.createDataFrame(rows, "id long, k string, j int, y int")
    test = spark.createDataFrame([(100 + i, "abc"[i % 3], i % 7) for i in range(40)], "id long, k string, j int")
    path, built = scratch_path(spark, "rounds"), []

    def stages():
        built.append(1)
        return []

    flow = (lambda: PseudoLabelling(stages, ["k"], "y", "id", KFold(2, id_col="id", exact=False), KeyMeanLearner(1.0), Rmse(),
                                    [(0.8, 0.3), (0.7, 0.4)], path))
    first = [tuple(r) for r in flow().run(train, test).collect()]
    assert len(built) == 3 and [r[0] for r in first] == [0, 1, 2]
    again = [tuple(r) for r in flow().run(train, test).collect()]
    assert again == first and len(built) == 3  # nothing is done twice
    f = flow()
    for n, (high, low) in enumerate([(0.8, 0.3), (0.7, 0.4)], 1):
        p = {r["id"]: r["prediction"] for r in f.predictions(spark, n - 1).collect()}
        took = {r["id"]: r["y"] for r in f.labels(spark, n).collect()}
        assert took == {i: int(v > 0.5) for i, v in p.items() if v > high or v < low}
        assert first[n][1:4] == (len(took), sum(took.values()), 60 + len(took))
    # a round that did not finish is done anew
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/round=2/scores")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    assert [tuple(r) for r in flow().run(train, test).collect()] == first and len(built) == 4


def test_search_halves_and_survives_failures(spark):
    r = random.Random(2)
    d = spark.createDataFrame([(i, i % 6, float(i % 6) + r.gauss(0, 0.1)) for i in range(240)], "id long, k int, y double")
    runs = []

    def make(smoothing, mode):
        if mode == "broken":
            raise RuntimeError("no such mode")
        runs.append(smoothing)
        return KeyMeanLearner(smoothing)

    space = {"smoothing": ("float", 0.01, 1000.0, "log"), "mode": ("cat", ["ok", "ok", "ok", "broken"])}
    res = search_params(d, ["k"], "y", KFold(4, id_col="id", exact=False), make, space, Rmse(), n_trials=10, seed=3)
    t = {x["trial"]: x for x in res.trials.collect()}
    broken = {i for i, x in t.items() if x["mode"] == "broken"}
    assert broken and all(t[i]["status"] == "failed" and t[i]["folds"] == 0 and "no such mode" in t[i]["error"] for i in broken)
    full = [x for x in t.values() if x["status"] == "complete"]
    assert full and all(x["folds"] == 4 for x in full)
    assert any(x["status"] == "pruned" and x["folds"] < 4 for x in t.values())
    assert isinstance(res.best_params["smoothing"], float) and res.best_score == min(x["mean_score"] for x in full)
    assert res.best_params["smoothing"] == min(full, key=lambda x: x["mean_score"])["smoothing"]
    assert res.scores.count() == sum(x["folds"] for x in t.values())


def test_term_vectors(spark):
    r = random.Random(9)
    words = [f"w{i:05d}" for i in range(3000)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 60)))) for i in range(100)]
    rows += [(200, None), (201, ""), (202, "never seen"), (203, rows[0][1])]
    d = spark.createDataFrame(rows, "id long, text string")
    for cls in (CountVectorizer, TfidfVectorizer):
        f = cls("v", "text", "id", min_df=1).fit(d.where("id < 100"))
        terms = [x["term"] for x in f.vocab.df.orderBy("term").collect()]
        long_form: dict = {}
        for x in f.transform(d).collect():
            long_form.setdefault(x["id"], {})[x["feature"].split("_text_")[1]] = x["value"]
        got = {x["id"]: x["features"] for x in f.to_vectors(d).collect()}
        assert len(got) == len(rows)
        for i, v in got.items():
            assert v.size == len(terms)
            have = {terms[j]: w for j, w in zip(v.indices, v.values)}
            want = long_form.get(i, {})
            assert have.keys() == want.keys() and all(math.isclose(have[t], want[t]) for t in want)


def test_word_vector_pool(spark):
    vec = spark.createDataFrame([("a", [1.0, -2.0]), ("b", [3.0, -5.0])], "word string, vec array<double>")
    d = spark.createDataFrame([(1, "a A b"), (2, "none"), (3, None)], "id long, text string")
    out = WordVectorPool("p", ["text"], vec, "id", agg_methods=("mean", "max")).fit(d).transform(d)
    got = {r["id"]: tuple(r[f"text_{a}_dim_{i}"] for a in ("mean", "max") for i in (0, 1)) for r in out.collect()}
    assert np.allclose(got[1], (5 / 3, -3.0, 3.0, -2.0)) and got[2] == got[3] == (0.0,) * 4


def test_metric_direction(spark, classes):
    res = search_params(classes, ["a", "b"], "y", KFold(2, id_col="id", exact=False), lambda **p: Learner("logit", **p),
                        {"regParam": ("cat", [0.01, 10.0])}, RocAuc(), n_trials=2, seed=1)
    done = [x["mean_score"] for x in res.trials.where("status = 'complete'").collect()]
    assert res.best_score == max(done)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev"])
def test_knn_metrics_with_equal_rows(spark, metric):
    r = random.Random(11)
    rows = [(i, [float(r.randint(0, 3)), r.choice([0.0, -0.0, r.gauss(0, 1)]), 1e7]) for i in range(150)]
    d = spark.createDataFrame(rows, "id long, v array<double>")
    got: dict = {}
    for x in knn_join(d, d, "id", "v", 4, exclude_self=True, block=16, n_pivots=5, metric=metric).collect():
        got.setdefault(x["id"], {})[x["rank"]] = (x["neighbor_id"], x["dist"])
    how = {"euclidean": lambda a, b: math.dist(a, b), "manhattan": lambda a, b: sum(abs(x - y) for x, y in zip(a, b)),
           "chebyshev": lambda a, b: max(abs(x - y) for x, y in zip(a, b))}[metric]
    for i, v in rows:
        want = sorted((round(how(v, w), 9), j) for j, w in rows if j != i)[:4]
        assert [got[i][k][0] for k in (1, 2, 3, 4)] == [j for _, j in want]
        assert np.allclose([got[i][k][1] for k in (1, 2, 3, 4)], [x for x, _ in want])


def test_knn_of_many_equal_rows(spark):
    d = spark.range(20000).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    got = knn_join(d, d, "id", "v", 3, exclude_self=True)
    assert got.groupBy("neighbor_id").count().collect().__len__() == 4
    assert got.where("dist <> 0").isEmpty() and got.count() == 60000
