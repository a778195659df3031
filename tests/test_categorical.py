import hashlib

import pytest

from foldwise.operators.categorical import (CategoricalInteraction, CountFrequencyEncoder, HashingEncoder,
                                            OneHotEncoder, OrdinalEncoder, RareCategoryCombiner, TargetEncoder,
                                            WoEEncoder)
from tests.conftest import rows

DATA = [(1, "a", 1), (2, "a", 0), (3, "a", 1), (4, "b", 0), (5, "c", 1), (6, None, 0)]


def cat(spark, data=DATA):
    return spark.createDataFrame(data, "id int, c string, y int")


@pytest.mark.parametrize("literal_max", [10_000, 0])
def test_rare_combiner_literal_and_join_paths(spark, literal_max):
    df = cat(spark)
    st = RareCategoryCombiner("r", ["c"], min_count=2)
    st.literal_max = literal_max
    out = st.fit(df).transform(df)
    assert [r[1] for r in rows(out, "id", "c")] == ["a", "a", "a", "Other", "Other", "Other"]


def test_rare_combiner_by_share(spark):
    df = cat(spark)
    out = RareCategoryCombiner("r", ["c"], min_freq=0.2).fit(df).transform(df)
    # shares of non-NULL rows: a 3/5, b 1/5, c 1/5
    assert [r[1] for r in rows(out, "id", "c")] == ["a", "a", "a", "b", "c", "Other"]


def test_one_hot_top_with_other_including_null(spark):
    df = cat(spark)
    out = OneHotEncoder("o", ["c"], max_categories=1).fit(df).transform(df)
    assert "c" not in out.columns
    assert rows(out, "id", "c_ohe_a", "c_ohe_other") == [
        (1, 1, 0), (2, 1, 0), (3, 1, 0), (4, 0, 1), (5, 0, 1), (6, 0, 1)]


def test_count_and_freq_unseen_zero(spark):
    df = cat(spark)
    test = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "id int, c string")
    out = CountFrequencyEncoder("c", ["c"]).fit(df).transform(test)
    assert [r[1] for r in rows(out, "id", "c_count")] == [3, 0, 0]
    out = CountFrequencyEncoder("c", ["c"], normalize=True).fit(df).transform(test)
    assert [r[1] for r in rows(out, "id", "c_freq")] == pytest.approx([0.6, 0.0, 0.0])


def test_hash_encoder_matches_python_md5(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "id int, c string, d string")
    out = HashingEncoder("h", ["c", "d"], 8).transform(df)
    for rid, vals in ((1, ["a", "x"]), (2, ["nan", "y"])):
        want = [0] * 8
        for v in vals:
            want[int(hashlib.md5(v.encode()).hexdigest(), 16) % 8] += 1
        got = out.where(f"id = {rid}").select(*[f"h_hash_{i}" for i in range(8)]).first()
        assert list(got) == want


@pytest.mark.parametrize("literal_max", [10_000, 0])
def test_ordinal_sorted_codes_unseen_minus_one(spark, literal_max):
    df = cat(spark)
    st = OrdinalEncoder("o", ["c"])
    st.literal_max = literal_max
    test = spark.createDataFrame([(1, "c"), (2, "a"), (3, "q"), (4, None)], "id int, c string")
    out = st.fit(df).transform(test)
    assert [r[1] for r in rows(out, "id", "c_ordinal")] == [2, 0, -1, -1]


def test_target_encoding_formula(spark):
    df = cat(spark)
    f = TargetEncoder("t", ["c"], "y", smoothing_strength=2.0).fit(df)
    gm = 3 / 6
    out = f.transform(spark.createDataFrame([(1, "a"), (2, "new")], "id int, c string"))
    got = [r[1] for r in rows(out, "id", "c_te")]
    assert got == pytest.approx([(2 / 3 * 3 + gm * 2) / (3 + 2), gm])


def test_woe_formula_and_binary_check(spark):
    df = cat(spark)
    out = WoEEncoder("w", ["c"], "y").fit(df).transform(spark.createDataFrame([(1, "a"), (2, "q")], "id int, c string"))
    import math

    P, N, e = 3, 3, 1e-6
    want = math.log(((2 + e) / P) / ((1 + e) / N))
    assert [r[1] for r in rows(out, "id", "c_woe")] == pytest.approx([want, 0.0])
    bad = spark.createDataFrame([(1, "a", 2)], "id int, c string, y int")
    with pytest.raises(ValueError):
        WoEEncoder("w", ["c"], "y").fit(bad)


def test_concat_null_as_nan(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, None, None)], "id int, c string, n int")
    out = CategoricalInteraction("x", [["c", "n"]]).transform(df)
    assert [r[1] for r in rows(out, "id", "c_n")] == ["a_3", "nan_nan"]


def test_target_encoding_out_of_fold(spark):
    df = spark.createDataFrame([(1, "a", 1, 0), (2, "a", 0, 1), (3, "b", 1, 0), (4, "b", 1, 1), (5, "a", 1, None)],
                               "id int, c string, y int, fold int")
    out = TargetEncoder("t", ["c"], "y", smoothing_strength=0.0, fold_col="fold").fit(df).transform(df)
    got = dict(rows(out, "id", "c_te"))
    # id 1 (fold 0) sees only fold-1 and fold-less rows of "a": ids 2 and 5 → (0 + 1) / 2
    assert got[1] == pytest.approx(0.5) and got[2] == pytest.approx(1.0)
    assert got[5] == pytest.approx(2 / 3)  # no fold: full-data mean of "a"
