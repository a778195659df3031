import math

import numpy as np
import pytest

from foldwise.operators.numeric import (BoxCoxTransformer, EqualWidthBinner, IsNullIndicator, LogTransformer,
                                        MinMaxScaler, NumCatInteraction, NumericalInteraction, OutlierIndicator,
                                        QuantileBinner, RobustScaler, SqrtTransformer, StandardScaler,
                                        ValueIndicator, YeoJohnsonTransformer)
from tests.conftest import rows


def frame(spark, data, schema="id int, x double"):
    return spark.createDataFrame(data, schema)


def test_equal_width_bins_edges_null_and_out_of_range(spark):
    train = frame(spark, [(1, 0.0), (2, 10.0), (3, 5.0)])
    test = frame(spark, [(1, 0.0), (2, 1.0), (3, 2.0), (4, 10.0), (5, -1.0), (6, 11.0), (7, None)])
    out = EqualWidthBinner("b", ["x"], 5).fit(train).transform(test)
    # edges 0,2,4,6,8,10 — right-closed, lowest included
    assert rows(out, "id", "x_ew_binned") == [(1, 0), (2, 0), (3, 0), (4, 4), (5, -1), (6, -1), (7, -1)]


def test_equal_width_constant_column_is_bin_zero(spark):
    df = frame(spark, [(1, 3.0), (2, 3.0)])
    out = EqualWidthBinner("b", ["x"], 4).fit(df).transform(df)
    assert [r[1] for r in rows(out, "id", "x_ew_binned")] == [0, 0]


def test_quantile_bins_drop_duplicate_edges(spark):
    df = frame(spark, [(i, float(v)) for i, v in enumerate([0, 0, 0, 0, 1, 2, 3, 4])])
    st = QuantileBinner("q", ["x"], 4)
    f = st.fit(df)
    edges = sorted(set(np.quantile([0, 0, 0, 0, 1, 2, 3, 4], [0, .25, .5, .75, 1]).tolist()))
    assert f.state["x"] == pytest.approx(edges)


def test_flags_null_is_zero(spark):
    df = frame(spark, [(1, 0.0), (2, None), (3, float("nan")), (4, -1.0)])
    out = ValueIndicator("v", ["x"], -1).transform(df)
    assert [r[1] for r in rows(out, "id", "x_is_neg1")] == [0, 0, 0, 1]
    out = IsNullIndicator("n", ["x"]).transform(df)
    assert [r[1] for r in rows(out, "id", "x_is_null")] == [0, 1, 1, 0]


def test_outlier_flag_matches_iqr_rule(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = frame(spark, list(enumerate(vals)) + [(9, None)])
    out = OutlierIndicator("o", ["x"]).fit(df).transform(df)
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    hi = q3 + 1.5 * (q3 - q1)
    want = [int(v > hi) for v in vals] + [0]
    assert [r[1] for r in rows(out, "id", "x_is_outlier")] == want


def test_standard_scaler_population_std_and_zero_std(spark):
    df = frame(spark, [(1, 1.0), (2, 2.0), (3, 3.0), (4, None)])
    out = StandardScaler("s", ["x"]).fit(df).transform(df)
    got = [r[1] for r in rows(out, "id", "x_standard_scaled")]
    sd = np.std([1, 2, 3])
    assert got[:3] == pytest.approx([(1 - 2) / sd, 0.0, (3 - 2) / sd]) and got[3] is None
    const = frame(spark, [(1, 5.0), (2, 5.0)])
    out = StandardScaler("s", ["x"]).fit(const).transform(const)
    assert [r[1] for r in rows(out, "id", "x_standard_scaled")] == [0.0, 0.0]


def test_minmax_and_robust(spark):
    df = frame(spark, [(1, 2.0), (2, 4.0), (3, 6.0), (4, 10.0)])
    mm = MinMaxScaler("m", ["x"]).fit(df).transform(df)
    assert [r[1] for r in rows(mm, "id", "x_minmax_scaled")] == pytest.approx([0.0, 0.25, 0.5, 1.0])
    rb = RobustScaler("r", ["x"]).fit(df).transform(df)
    med, q1, q3 = np.median([2, 4, 6, 10]), *np.quantile([2, 4, 6, 10], [0.25, 0.75])
    assert [r[1] for r in rows(rb, "id", "x_robust_scaled")] == pytest.approx(
        [(v - med) / (q3 - q1) for v in [2, 4, 6, 10]])
    const = frame(spark, [(1, 7.0), (2, 7.0)])
    assert [r[1] for r in rows(MinMaxScaler("m", ["x"]).fit(const).transform(const), "id", "x_minmax_scaled")] \
        == [0.0, 0.0]


def test_log1p_and_sqrt_edges(spark):
    df = frame(spark, [(1, -1.0), (2, -2.0), (3, 0.0), (4, None)])
    lg = [r[1] for r in rows(LogTransformer("l", ["x"]).transform(df), "id", "x_log1p")]
    assert lg[0] is None and lg[1] is None and lg[2] == 0.0 and lg[3] is None
    sq = [r[1] for r in rows(SqrtTransformer("s", ["x"]).transform(df), "id", "x_sqrt")]
    assert sq == [0.0, 0.0, 0.0, None]


def _boxcox_llf(x, lam):
    y = np.log(x) if lam == 0 else (x ** lam - 1) / lam
    return (lam - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())


def test_box_cox_lambda_maximises_likelihood(spark):
    rng = np.random.default_rng(0)
    x = rng.lognormal(1.0, 0.6, 400)
    df = frame(spark, [(i, float(v)) for i, v in enumerate(x)])
    lam = BoxCoxTransformer("b", ["x"]).fit(df).state["x"]
    dense = max(np.linspace(-2, 2, 40001), key=lambda l: _boxcox_llf(x, l))
    assert abs(lam - dense) < 2e-4
    with pytest.raises(ValueError):
        BoxCoxTransformer("b", ["x"]).fit(frame(spark, [(1, 1.0), (2, 0.0)]))


def test_yeo_johnson_handles_negatives(spark):
    df = frame(spark, [(i, float(v)) for i, v in enumerate([-3.0, -1.0, 0.0, 2.0, 5.0, 9.0])])
    out = YeoJohnsonTransformer("y", ["x"]).fit(df).transform(df)
    assert all(r[1] is not None and math.isfinite(r[1]) for r in rows(out, "id", "x_yeojohnson"))


def test_pairwise_names_and_epsilon(spark):
    df = spark.createDataFrame([(1, 2.0, 0.0)], "id int, a double, b double")
    out = NumericalInteraction("p", ["a", "b"]).transform(df).first().asDict()
    assert out["a_add_b"] == 2.0 and out["a_sub_b"] == 2.0 and out["b_sub_a"] == -2.0 and out["a_mul_b"] == 0.0
    assert out["a_div_b"] == pytest.approx(2.0 / 1e-6) and out["b_div_a"] == pytest.approx(0.0)
    with pytest.raises(ValueError):
        NumericalInteraction("p", ["a"])


def test_group_deviation_unseen_uses_overall_mean(spark):
    train = spark.createDataFrame([(1, "a", 2.0), (2, "a", 4.0), (3, "b", 10.0)], "id int, c string, x double")
    test = spark.createDataFrame([(1, "a", 3.0), (2, "z", 6.0), (3, None, 6.0)], "id int, c string, x double")
    out = NumCatInteraction("n", {"c": ["x"]}).fit(train).transform(test)
    got = [r[1] for r in rows(out, "id", "x_sub_by_c_mean")]
    assert got == pytest.approx([0.0, 6.0 - 16.0 / 3, 6.0 - 16.0 / 3])
