import numpy as np
import pytest

from foldwise.operators.metrics import (QWK, F1, Accuracy, AveragePrecision, LogLoss, Mae, MapAtK, Mape, Precision,
                                        R2, Recall, Rmse, Rmsle, RocAuc, TopKAccuracy)


def yp(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")


def test_auc_with_ties_and_ap(spark):
    df = yp(spark, [0, 0, 1, 1], [0.1, 0.5, 0.5, 0.9])
    assert RocAuc()(df, "y", "p") == pytest.approx(0.875)
    tie = yp(spark, [0, 1], [0.5, 0.5])
    assert RocAuc()(tie, "y", "p") == pytest.approx(0.5)
    # AP: thresholds 0.9 (P=1, R=.5), 0.5 (P=2/3, R=1)
    assert AveragePrecision()(df, "y", "p") == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)


def test_threshold_metrics(spark):
    y = [1, 1, 0, 0, 1]
    p = [0.9, 0.4, 0.6, 0.1, 0.8]
    df = yp(spark, y, p)
    q = [int(v > 0.5) for v in p]
    tp = sum(a == b == 1 for a, b in zip(y, q))
    fp = sum(a == 0 and b == 1 for a, b in zip(y, q))
    fn = sum(a == 1 and b == 0 for a, b in zip(y, q))
    assert Accuracy()(df, "y", "p") == pytest.approx(np.mean([a == b for a, b in zip(y, q)]))
    assert Precision()(df, "y", "p") == pytest.approx(tp / (tp + fp))
    assert Recall()(df, "y", "p") == pytest.approx(tp / (tp + fn))
    assert F1()(df, "y", "p") == pytest.approx(2 * tp / (2 * tp + fp + fn))
    # macro F1: class 0 → tp0=1 (y0,q0 at idx 3), fp0=1 (idx1), fn0=1 (idx2)
    assert F1(average="macro")(df, "y", "p") == pytest.approx((2 * tp / (2 * tp + fp + fn) + 2 / 4) / 2)


def test_log_loss_clips(spark):
    df = yp(spark, [1, 0], [1.0, 0.2])
    eps = np.finfo(float).eps
    want = -np.mean([np.log(1 - eps), np.log(0.8)])
    assert LogLoss()(df, "y", "p") == pytest.approx(want)


def test_regression_metrics(spark):
    y, p = np.array([3.0, -0.5, 2.0, 7.0]), np.array([2.5, 0.0, 2.0, 8.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    assert Mae()(df, "y", "p") == pytest.approx(np.mean(abs(y - p)))
    assert Rmse()(df, "y", "p") == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert Mape()(df, "y", "p") == pytest.approx(np.mean(abs(y - p) / np.maximum(abs(y), np.finfo(float).eps)))
    assert R2()(df, "y", "p") == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    yy, pp = np.array([1.0, 2.0, 3.0]), np.array([1.0, -1.0, 4.0])
    d2 = spark.createDataFrame([(float(a), float(b)) for a, b in zip(yy, pp)], "y double, p double")
    assert Rmsle()(d2, "y", "p") == pytest.approx(np.sqrt(np.mean((np.log1p(yy) - np.log1p(np.clip(pp, 0, None))) ** 2)))


def _qwk_ref(y, q):
    labels = sorted(set(y) | set(q))
    ix = {v: i for i, v in enumerate(labels)}
    k = len(labels)
    O = np.zeros((k, k))
    for a, b in zip(y, q):
        O[ix[a], ix[b]] += 1
    W = np.array([[(i - j) ** 2 for j in range(k)] for i in range(k)], dtype=float)
    E = np.outer(O.sum(1), O.sum(0)) / O.sum()
    return 1 - (W * O).sum() / (W * E).sum()


def test_qwk_half_even_rounding(spark):
    y = [0, 1, 2, 2, 3, 1]
    p = [0.5, 1.5, 2.4, 2.6, 2.5, 0.4]
    df = yp(spark, y, p)
    assert QWK()(df, "y", "p") == pytest.approx(_qwk_ref(y, [int(np.round(v)) for v in p]))


def test_top_k_accuracy_ties_and_binary(spark):
    df = spark.createDataFrame([(0, [0.2, 0.5, 0.3]), (2, [0.1, 0.1, 0.8]), (1, [0.4, 0.4, 0.2])],
                               "y int, s array<double>")
    assert TopKAccuracy(1)(df, "y", "s") == pytest.approx(2 / 3)  # row 3: tie → higher index first
    assert TopKAccuracy(2)(df, "y", "s") == pytest.approx(2 / 3)  # row 1: true class scores lowest
    assert TopKAccuracy(3)(df, "y", "s") == pytest.approx(1.0)
    assert TopKAccuracy(1)(yp(spark, [1, 0], [0.7, 0.7]), "y", "p") == pytest.approx(0.5)


def test_map_at_k_divides_by_all_relevant(spark):
    data = [("u1", 1, 1, 0.9), ("u1", 2, 0, 0.8), ("u1", 3, 1, 0.1), ("u2", 4, 0, 0.5)]
    df = spark.createDataFrame(data, "g string, id int, y int, s double")
    # u1 top-2: [1, 0] → AP = (1/1) / 2 relevant = 0.5 ; u2 has none → 0
    assert MapAtK(2, "g", "id")(df, "y", "s") == pytest.approx(0.25)


def test_top_k_label_outside_scores_is_a_miss(spark):
    df = spark.createDataFrame([(5, [0.2, 0.8]), (1, [0.1, 0.9])], "y int, s array<double>")
    assert TopKAccuracy(1)(df, "y", "s") == pytest.approx(0.5)
