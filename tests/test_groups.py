import numpy as np
import pandas as pd
import pytest

from foldwise.operators.groups import GroupStats, RollingStats
from foldwise.operators.indexing import global_index
from foldwise.operators.quantiles import global_quantiles, grouped_quantiles
from foldwise.operators.ranking import running_hits, running_totals
from tests.conftest import rows


def test_group_stats_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": range(60), "k": rng.integers(0, 4, 60), "v": rng.normal(size=60).round(3)})
    pdf.loc[[3, 7], "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("k", __import__("pyspark.sql.functions", fromlist=["col"]).col("k").cast("int"))
    funcs = ["mean", "std", "sum", "median", "min", "max", "count", "nunique", "skew", "kurt"]
    out = GroupStats("g", ["k"], ["v"], funcs).fit(df).transform(df).toPandas().sort_values("id")
    grp = pdf.groupby("k")["v"]
    ref = {f: (grp.apply(lambda s: s.kurt()) if f == "kurt" else grp.agg(f)) for f in funcs}
    for f in funcs:
        want = pdf["k"].map(ref[f]).to_numpy(dtype=float)
        assert np.allclose(out[f"k_{f}_v"].to_numpy(dtype=float), want, equal_nan=True), f


def test_group_stats_null_key_gets_null(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 5.0)], "id int, k string, v double")
    out = GroupStats("g", ["k"], ["v"], ["mean"]).fit(df).transform(df)
    assert rows(out, "id", "k_mean_v") == [(1, 1.0), (2, None)]


def _rolling_reference(pdf, window_us, func):
    out = {}
    for _, g in pdf.sort_values(["ts", "id"]).groupby("k"):
        t = g["ts"].astype("int64").to_numpy() // 1000
        v, ids = g["v"].to_numpy(), g["id"].to_numpy()
        vals = []
        for j in range(len(g)):
            m = (t > t[j] - window_us) & (t <= t[j])
            vals.append({"mean": v[m].mean(), "sum": v[m].sum(), "count": float(m.sum())}[func])
        prev = [None] + vals[:-1]
        out.update(dict(zip(ids, prev)))
    return out


@pytest.mark.parametrize("func,bucket", [("mean", None), ("sum", None), ("count", None), ("mean", "5h")])
def test_rolling_matches_brute_force_across_buckets(spark, func, bucket):
    rng = np.random.default_rng(2)
    n = 200
    ts = pd.to_datetime("2024-01-01") + pd.to_timedelta(rng.integers(0, 10 * 24 * 3600, n), unit="s")
    pdf = pd.DataFrame({"id": range(n), "k": rng.integers(0, 3, n), "ts": ts, "v": rng.normal(size=n)})
    pdf.loc[5, "ts"] = pdf.loc[6, "ts"]  # a timestamp tie
    pdf.loc[5, "k"] = pdf.loc[6, "k"]
    df = spark.createDataFrame(pdf)
    st = RollingStats("r", ["k"], "ts", ["v"], ["1D"], [func], order_col="id", bucket=bucket)
    got = dict(rows(st.transform(df), "id", f"k_v_rolling_1D_{func}"))
    want = _rolling_reference(pdf, 86_400_000_000, func)
    for i in range(n):
        if want[i] is None:
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(want[i])


def test_quantiles_match_numpy(spark):
    vals = [5.0, 1.0, 3.0, 3.0, 9.0, 2.0, 8.0]
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    assert global_quantiles(df, "x", probs) == pytest.approx(np.quantile(vals, probs).tolist())
    g = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 2.0), ("a", 2.0)], "k string, x double")
    st = grouped_quantiles(g, "x", [0.5], ["k"], ["med"])
    assert rows(st.df, "k", "med") == [("a", 2.0), ("b", 2.0)]


def test_running_sums_and_positions(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": range(300), "g": rng.integers(0, 2, 300), "s": rng.integers(0, 20, 300).astype(float),
                        "r": rng.integers(0, 2, 300)})
    df = spark.createDataFrame(pdf).repartition(7)
    got = running_hits(df, ["g"], "s", "r", tie="id").toPandas().set_index("id")
    ref = pdf.sort_values(["g", "s", "id"], ascending=[True, False, True])
    ref["hits"] = ref.groupby("g")["r"].cumsum()
    ref["pos"] = ref.groupby("g").cumcount() + 1
    ref = ref.set_index("id")
    assert (got.loc[ref.index, "hits"] == ref["hits"]).all() and (got.loc[ref.index, "pos"] == ref["pos"]).all()
    from pyspark.sql import functions as F

    tot = running_totals(df, [], [F.col("s").asc(), F.col("id").asc()], {"c": F.lit(1)}).toPandas()
    assert sorted(tot["c"]) == list(range(1, 301))


def test_global_index_dense(spark):
    df = spark.range(0, 1000).withColumn("k", (1000 - __import__("pyspark.sql.functions", fromlist=["col"]).col("id")))
    idx = global_index(df.repartition(5), ["k"], "i").toPandas()
    assert sorted(idx["i"]) == list(range(1000))
    assert (idx.sort_values("k")["i"].to_numpy() == np.arange(1000)).all()


def test_approx_options_close_to_exact(spark):
    from foldwise.operators.numeric import QuantileBinner, RobustScaler

    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"id": range(2000), "k": rng.integers(0, 3, 2000), "v": rng.normal(size=2000)})
    df = spark.createDataFrame(pdf)
    ex = GroupStats("g", ["k"], ["v"], ["median"]).fit(df).state.df.toPandas().set_index("k")
    ap = GroupStats("g", ["k"], ["v"], ["median"], approx_median=True).fit(df).state.df.toPandas().set_index("k")
    assert np.allclose(ex["k_median_v"], ap.loc[ex.index, "k_median_v"], atol=0.05)
    e1 = QuantileBinner("q", ["v"], 4).fit(df).state["v"]
    e2 = QuantileBinner("q", ["v"], 4, approx=True).fit(df).state["v"]
    assert np.allclose(e1, e2, atol=0.05)
    assert RobustScaler("r", ["v"], approx=True).fit(df).state["v"][1] > 0


def test_state_table_broadcast_caps(spark):
    from foldwise.operators.state import StateTable

    st = StateTable.build(spark.range(100).selectExpr("id", "array_repeat(cast(id as double), 32) as v"))
    assert st.rows == 100 and st.size and st.size > 0 and st.broadcastable()
    spark.conf.set("foldwise.broadcast.maxBytes", "10")
    try:
        assert not st.broadcastable()
    finally:
        spark.conf.unset("foldwise.broadcast.maxBytes")
    spark.conf.set("foldwise.broadcast.maxRows", "10")
    try:
        assert not st.broadcastable()
    finally:
        spark.conf.unset("foldwise.broadcast.maxRows")
