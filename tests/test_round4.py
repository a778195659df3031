"""Whole rows, bounded tasks and bounded memory of the round's findings."""

import math

import __spark_entry__ as E


def test_positive_only_assert_gives_every_row(spark, tmp_path):
    """one row a line, with its log, and no zeros let through."""
    rows = [(1, 1, 10.0, 0.0), (1, 2, 20.5, 0.1), (1, 2, 20.5, 0.1), (2, 1, None, 0.0), (None, 3, 4.0, 0.2)]
    (spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_extendedprice double, l_discount double")
     .write.parquet(str(tmp_path / "lineitem.parquet")))
    got = E.queries()["positive_only_assert"](spark, str(tmp_path)).collect()
    assert got and got[0].asDict().keys() == {"l_orderkey", "l_linenumber", "log_price"}
    key = (lambda t: tuple((x is None, x or 0) for x in t))
    want = sorted(((o, n, None if p is None else math.floor(math.log(p) * 1e6 + 0.5) / 1e6) for o, n, p, _ in rows), key=key)
    assert sorted(map(tuple, got), key=key) == want


def test_spread_bounds_the_share_of_a_task(spark, tmp_path, monkeypatch):
    """F10 (F5, F6, F9): one row group, cut into many splits, is dealt evenly."""
    from foldwise import session

    path = str(tmp_path / "t.parquet")
    spark.range(20000).selectExpr("id", "repeat(md5(cast(id as string)), 4) AS t").coalesce(1).write.parquet(path)
    monkeypatch.setattr(session, "SPREAD_BYTES", 64 * 1024)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        sizes = [len(p) for p in session.spread(spark.read.parquet(path)).rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sum(sizes) == 20000 and max(sizes) < 20000 / 8 and len(sizes) > 8


def test_text_statistics_bound_the_rows_of_a_task(spark, tmp_path, monkeypatch):
    """texts that compress to almost nothing are dealt by their number."""
    from foldwise.operators import text

    path = str(tmp_path / "t.parquet")
    spark.range(4000).selectExpr("id", "repeat('ab cd ', 200) AS t").coalesce(1).write.parquet(path)
    n = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(text, "TEXT_ROWS", 4000 // (4 * n))
    out = text.TextStatistics("x", ["t"]).transform(spark.read.parquet(path))
    sizes = [len(p) for p in out.rdd.glom().collect()]
    assert sum(sizes) == 4000 and len(sizes) >= 4 * n and max(sizes) < 4000 / n
    assert out.where("t_word_count = 400").count() == 4000


def test_ngrams_of_a_long_text_cost_its_length(spark):
    """bigrams of 30000 words, and counts as Python makes them; ids repeat
    and are null."""
    from collections import Counter

    from foldwise.operators.text import CountVectorizer

    long = " ".join(f"w{i % 7001}" for i in range(30000))
    rows = [(1, long), (2, "aa bb aa bb"), (2, "bb aa é"), (None, "aa bb"), (None, "AA"), (3, None), (4, "zz")]
    df = spark.createDataFrame(rows, "id int, t string")
    want = Counter()
    for i, t in rows:
        w = [x for x in (t or "").lower().split() if len(x) > 1]
        want.update((i, g) for g in w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    st = CountVectorizer("c", "t", "id", ngram_range=(1, 2))
    got = {(r["id"], r["feature"][len("countvec_t_"):]): r["value"] for r in st.fit(df).transform(df).collect()}
    assert got == dict(want)
    df_of_aa = [r["df"] for r in st.fit(df).vocab.df.where("term = 'aa'").collect()]
    assert df_of_aa == [2]


def test_terms_of_different_ids_are_not_shuffled(spark):
    """The counts of a row are made within it."""
    from foldwise.operators.text import CountVectorizer

    df = spark.createDataFrame([(i, f"word{i % 3} and more") for i in range(30)], "id int, t string")
    tc = CountVectorizer("c", "t", "id")._term_counts(df)
    plan = tc._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and tc.count() == 90


def test_vectors_of_copies_and_texts_without_terms(spark):
    """texts are not shuffled to tell copies apart; copies get one vector."""
    from foldwise.operators.text import CountVectorizer

    df = spark.createDataFrame([(1, "aa bb aa"), (2, "aa bb aa"), (2, "aa bb aa"), (3, None), (4, ""), (5, "bb")], "id int, t string")
    f = CountVectorizer("c", "t", "id").fit(df)
    got = sorted((r["id"], r["features"].toArray().tolist()) for r in f.to_vectors(df).collect())
    two = [2.0, 1.0]
    assert got == [(1, two), (2, two), (2, two), (3, [0.0, 0.0]), (4, [0.0, 0.0]), (5, [0.0, 1.0])]
    plan = f.to_vectors(df.select("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "first(t" not in plan


def test_knn_pieces_do_not_grow_with_rows_or_pivots(spark, monkeypatch):
    """F3 (F7, F8, F13, F14): distances are held for a bounded number of rows."""
    import numpy as np
    import pytest

    from foldwise.operators import neighbors as N

    assert len(list(N._pieces(__import__("pandas").DataFrame({"a": range(N.PIECE_ROWS + 1)})))) == 2
    x = np.random.default_rng(3).integers(0, 40, (1500, 2)).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    for metric, p in (("euclidean", 2), ("manhattan", 1)):
        got = N.knn_join(df, df, "id", "v", 3, exclude_self=True, metric=metric, n_pivots=40).toPandas().sort_values(["id", "rank"])
        dist = np.linalg.norm(x[:, None] - x[None], ord=p, axis=2)
        np.fill_diagonal(dist, np.inf)
        want = np.argsort(dist, axis=1, kind="stable")[:, :3]
        assert (got["neighbor_id"].to_numpy().reshape(-1, 3) == want).all()
        assert got["dist"].to_numpy() == pytest.approx(np.take_along_axis(dist, want, 1).ravel())


def test_learners_cut_large_scans_into_small_blocks(spark, tmp_path, monkeypatch):
    """rows of one row group aren't one cached block; small scans stay."""
    from foldwise import session

    path = str(tmp_path / "t.parquet")
    spark.range(50000).selectExpr("cast(id as double) AS x", "xxhash64(id) AS y").coalesce(1).write.parquet(path)
    t = spark.read.parquet(path)
    assert session.spread(t, always=False) is t
    monkeypatch.setattr(session, "SPREAD_BYTES", 8 * 1024)
    sizes = [len(p) for p in session.spread(t, always=False).rdd.glom().collect()]
    assert sum(sizes) == 50000 and max(sizes) < 50000 / 8
