"""Operators on texts against brute force, with nulls, empty and odd texts,
repeated rows and clashing column names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import decontam, line_dedup, ngram_join, rlz, suffix_dedup
from foldwise.llm.common import components, group_links, stored
from foldwise.llm.suffix_sort import long_repeats, packed, suffix_array

from .helpers import (brute_bytes, brute_contamination, brute_factor, brute_lines, brute_similar, corpus, ordered, sha,
                      union_find, words)

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    # extra columns with the names that operators use inside
    d = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"d": F.lit("x"), "th": F.lit(1), "rows": F.lit(None).cast("string"), "copies": F.lit(2), "_d": F.lit(0)})
    return rows, d


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_factor(docs, empty):
    rows, d = docs
    got = rlz.factor(d)
    have = got.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256)).collect()
    assert ordered(have) == ordered(brute_factor(rows))
    text = {}
    for i, t in rows:
        text.setdefault(i, []).append(words(t))
    for r in got.where(F.size("factors") > 0).collect():  # every factor stands in its reference
        for f in r["factors"]:
            part = next(w for w in text[r["doc_id"]] if len(w) == r["n_words"])[f["at"]:f["at"] + f["n"]]
            assert f["ref"] < r["doc_id"] and f["n"] >= 13
            assert any(w[k:k + 13] == part[:13] for w in text[f["ref"]] for k in range(len(w)))
    assert rlz.factor(empty).count() == 0


@pytest.mark.parametrize("size,crowd", [(200, 2048), (40, 2048), (40, 1)])
def test_bytes(docs, empty, size, crowd):
    rows, d = docs
    got = suffix_dedup.repeats_removed(d, size=size, crowd=crowd).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert ordered(got) == ordered(brute_bytes(rows, size))
    if size == 200:
        assert suffix_dedup.repeats_removed(empty).count() == 0


def test_suffix_array_order():
    r = np.random.default_rng(4)
    for _ in range(40):
        x = np.concatenate([np.append(r.integers(1, r.integers(2, 5), r.integers(0, 40)), 0) for _ in range(4)]).astype(np.int16)
        sa = suffix_array(x, packed(x), 200)
        assert sorted(sa) == list(range(len(x)))
        seq = [tuple(x[i:]) for i in sa]
        assert seq == sorted(seq)
    x = np.array([5] * 300 + [0], np.int16)
    left = np.arange(300, -1, -1)
    assert long_repeats(x, left, 200).sum() == 101


ITEMS = [(7, "Aa bb, CC dd ee ff gg hh ii jj kk ll mm nn oo"), (3, "solo"), (12, "zwei Wörter"), (4, None), (5, ""),
         (None, "null id"), (6, "p q r s t"), (8, "Aa bb CC dd ee ff gg hh ii jj kk ll mm zz")]


@pytest.mark.parametrize("block", [32 << 20, 30])
def test_contamination(spark, empty, block):
    base = "aa bb cc dd ee ff gg hh ii jj kk ll mm"
    rows = [(1, "x " + base.upper() + " nn y"), (2, base[:-3]), (3, "SOLO"), (4, "solo " * 3 + "w " * 100), (5, None), (6, ""),
            (7, "zwei wörter zwei Wörter"), (None, "solo"), (1, "p q r s t solo"), (1, "p q r s t solo"),
            (9, "w " * 300 + "p-q.r,s;t"), (10, base + " " + base)]
    d = spark.createDataFrame(rows, SCHEMA).withColumn("_key", F.lit(1)).withColumn("item_id", F.lit(1))
    b = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.contamination(d, b, block_bytes=block).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ",").cast("binary"), 256), "contaminated")
    want = brute_contamination(rows, ITEMS)
    assert ordered(got.collect()) == ordered(want)
    left = decontam.drop_contaminated(d, b, block_bytes=block)
    assert left.columns == d.columns
    assert ordered(r[:2] for r in left.collect()) == ordered(r for r, w in zip(rows, want) if not w[5])
    assert decontam.contamination(empty, b).count() == 0
    assert decontam.contamination(d, b.limit(0)).where("contaminated or n_hit > 0").count() == 0


def test_longest_matches(spark):
    item = " ".join(f"w{k}" for k in range(30))
    d = spark.createDataFrame([(1, "a b " + " ".join(f"w{k}" for k in range(5, 25)) + " c")], SCHEMA)
    b = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert [tuple(r) for r in decontam.matches(d, b).collect()] == [(1, 2, 20, "9", 5)]


def test_similar_documents(docs, empty):
    rows, d = docs
    got, pairs = ngram_join.similar_documents(d)
    want = brute_similar(rows)
    assert ordered(got.collect()) == ordered(want)
    assert pairs.where("a >= b").count() in (0, pairs.where("a > b").count())
    left = ngram_join.one_of_each(d)
    assert left.columns == d.columns
    assert ordered(r[:2] for r in left.collect()) == ordered(
        r for r, w in zip(rows, want) if w[2] is None or w[2] == w[0])
    assert ngram_join.similar_documents(empty)[0].count() == 0


def test_chain_of_similar_documents(spark):
    """Neighbours are similar, the ends are not: one component."""
    w = [f"v{k}" for k in range(300)]
    rows = [(k, " ".join(w[k * 8:k * 8 + 100])) for k in range(12)]
    got = ngram_join.similar_documents(spark.createDataFrame(rows, SCHEMA))[0].collect()
    assert ordered(got) == ordered(brute_similar(rows))
    assert {r["component_id"] for r in got} == {0}


def line_rows():
    r = np.random.default_rng(8)
    vocab = ["".join(r.choice(list("abcdefghij"), 6)) for _ in range(300)]
    base = [" ".join(r.choice(vocab, 12)) for _ in range(30)]
    rows = []
    for i in range(40):
        part = []
        for k in r.integers(0, 30, r.integers(1, 6)):
            x = base[k]
            if r.random() < 0.4:
                x = x[:20] + "Z" + x[21:]
            part.append(x.upper() if r.random() < 0.2 else x)
        part += ["", "  ", f"own line {i} é ß"][:r.integers(0, 4)]
        rows.append((int(i * 7 % 40), "\n".join(part) + ("\n" if i % 3 else "")))
    return rows + [(100, None), (101, ""), (102, "\n\n"), rows[0], (None, rows[1][1]), (103, "ab"), (104, "ab\nabc\nab")]


def test_lines(spark, empty):
    rows = line_rows()
    d = spark.createDataFrame(rows, SCHEMA).withColumns({"_rows": F.lit(1), "d": F.lit(2), "at": F.lit("x")})
    got = line_dedup.dedup_lines(d).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256))
    want = brute_lines(rows)
    assert ordered(got.collect()) == ordered(want)
    left = line_dedup.keep_lines(d)
    assert left.columns == d.columns
    assert ordered((r["doc_id"], sha(r["text"] or "")) for r in left.collect()) == ordered(
        (w[0], w[3]) for w in want if w[1] == 0 or w[2] < w[1])
    assert left.where("doc_id = 100 and text is null").count() == 1
    assert line_dedup.dedup_lines(empty).count() == 0


def crowded_lines(n: int = 120):
    """Lines with one common passage, below the threshold among each other, and
    each with a longer copy: a unique tail makes the similarity exactly 0.80."""
    r = random.Random(21)
    text = (lambda k: "".join(r.choice("abcdefghijklmnop") for _ in range(k)))
    passage, out = text(150), []
    for _ in range(n):
        size = r.choice([200, 240, 320])
        line = text(size - 143) + passage  # `size` shingles
        out += [line, line + text(size // 4)]
    return out


def test_crowded_band_is_compared_whole(spark):
    """All lines in one band: every similar pair is in one component."""
    line = dict(enumerate(crowded_lines()))
    texts = spark.createDataFrame([(k, x.encode()) for k, x in line.items()], "c long, line binary")
    sets = {k: {x[j:j + 8] for j in range(len(x) - 7)} for k, x in line.items()}
    links = [(a, b) for a in sets for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(links) == len(line) // 2
    met = texts.select(F.lit(1).cast("long").alias("t"), "c", F.lit(1).alias("n"))
    found = group_links(met, lambda pairs: line_dedup._verified(pairs, texts, 80), 80, 4,
                        lambda wanted: line_dedup._rare_shingles(texts.join(wanted, "c"), 80), line_dedup._rare_common)
    got = {x["node"]: x["component"] for x in components(found).collect()}
    assert {k: got.get(k, k) for k in line} == union_find(line, links)


def test_lone_shingles_of_many_lines_are_left_out(spark):
    """op10: five million shingles, nearly all of them in one line only, are not
    dealt out as groups."""
    r = np.random.default_rng(5)
    rows = [(k, r.integers(97, 123, 310, dtype=np.uint8).tobytes()) for k in range(16000)]
    texts = spark.createDataFrame([*rows, (16000, rows[0][1][:-2] + b"??")], "c long, line binary").repartition(4)
    got = line_dedup._rare_shingles(texts, 80)
    assert got.count() < 200_000
    both = got.where("c in (0, 16000)").groupBy("t").count().where("count = 2").count()
    assert both >= 303 // 20


def test_a_small_group_is_no_set_of_all_pairs(spark):
    """op5, op10: a star comes first at every size; similar things that it joins
    are not compared with each other."""
    rows = spark.createDataFrame([(t, c, 10, 0) for t in range(5) for c in range(6 * t, 6 * t + 6)],
                                 "t long, c long, n int, i int")
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return stored(pairs, "pairs")

    comp = {x["node"]: x["component"] for x in components(group_links(rows, verify, 75, 4)).collect()}
    assert comp == {c: c - c % 6 for c in range(30)}
    assert sum(seen) == 25
