"""Mixing, models, embeddings, preference pairs, components and the pipeline."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import cover_tree, langid, mixing, preference, toxicity
from foldwise.llm.common import components, merged

from .helpers import ordered, union_find, words


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(500, 560)]
    links += [(900, k) for k in range(901, 960)] + [(7, 7), (3, 4), (4, 3)]
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find({x for p in links for x in p}, links)
    assert all(got.get(x, x) == c for x, c in want.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_targets(size: dict) -> dict:
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [s for s in size if s is None]
    w = {s: 1 + k % 3 for k, s in enumerate(names)}
    full, total = set(), sum(size.values())
    while True:
        left = total - sum(3 * size[s] for s in full)
        weight = sum(w[s] for s in size if s not in full)
        t = {s: 3.0 * size[s] if s in full else left * w[s] / weight for s in size}
        over = {s for s in size if t[s] > 3 * size[s]}
        if not over - full:
            return t
        full |= over


def test_merged_stars(spark):
    """A star is one component after one call, a later star joins it by any of
    its nodes, and nothing unconnected shares a component."""
    frame = (lambda e: spark.createDataFrame(e, "a long, b long"))
    first = merged(None, frame([(k, 50) if k < 50 else (50, k) for k in range(40, 60) if k != 50] + [(100, 101)]))
    got = {r["node"]: r["component"] for r in first.collect()}
    assert got == {**dict.fromkeys(range(40, 60), 40), 100: 100, 101: 100}
    after = merged(first, frame([(3, 55), (55, 70), (40, 59), (200, 201)]))
    got = {r["node"]: r["component"] for r in after.collect()}
    assert got == {**dict.fromkeys([3, *range(40, 60), 70], 3), 100: 100, 101: 100, 200: 200, 201: 200}


def test_mixing(spark):
    r = random.Random(2)
    rows = [(i, " ".join("w" * (1 + j % 3) for j in range(r.randint(0, 30))), r.choice(["b", "a", "é", "B", None, "rare"][: 5]))
            for i in range(600)]
    rows += [(700, "one two three", "rare"), (701, None, "a"), (702, "", "none"), (None, "x y", "b"), (5, rows[5][1], rows[5][2])]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    out = mixing.mix(d).collect()
    size: dict = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(words(t))
    want = brute_targets(size)
    assert ordered((x["doc_id"], x["size"]) for x in out) == ordered((i, len(words(t))) for i, t, _ in rows)
    source = {i: s for i, _, s in rows}
    taken: dict = {}
    for x in out:
        s = source[x["doc_id"]] if x["doc_id"] is not None else "b"
        assert x["source_size"] == size[s] and math.isclose(x["target"], want[s], abs_tol=1e-6)
        assert x["taken"] <= 3 * x["size"]
        taken[s] = taken.get(s, 0) + x["taken"]
    assert all(abs(taken[s] - want[s]) <= 60 for s in size)  # repeated rows are taken together
    assert ordered(x[:5] for x in mixing.mix(d).collect()) == ordered(x[:5] for x in out)
    mixed = mixing.mixed(d.withColumn("copies", F.lit(9)))
    assert mixed.columns[:5] == ["doc_id", "text", "source", "size", "copies"] and len(mixed.columns) == 6
    assert mixed.agg(F.sum(mixed.columns[5] + "" if False else F.col(mixed.columns[5]) *
                           F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)))).first()[0] == sum(taken.values())
    assert mixing.mix(d.limit(0)).count() == 0


def test_larger_budget_keeps_smaller(spark):
    d = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"))
    small, large = (mixing.mix(d, weights=w).where("doc_id % 2 = 0 and taken > 0") for w in ((1, 4), (1, 2)))
    ids = [{r["doc_id"] for r in x.collect()} for x in (small, large)]
    assert ids[0] < ids[1]


def test_language(spark):
    r = random.Random(3)
    speak = {"aa": "abcde ", "bb": "uvwxyz ", "cc": "ñéßö "}
    rows = [(i, "".join(r.choice(speak[k]) for _ in range(r.choice([20, 200, 700]))), k)
            for i, k in enumerate(r.choice(list(speak)) for _ in range(150))]
    fit = spark.createDataFrame(rows[:100], "id long, text string, lang string")
    net = langid.train(fit, steps=200)
    odd = [(1000, None), (1001, ""), (1002, "12 -- 3"), (None, "abcab cdea abde")]
    d = spark.createDataFrame([x[:2] for x in rows[100:]] + odd, "doc_id long, text string").withColumn("letter", F.lit(1))
    got = {x["doc_id"]: x for x in langid.predict(d, net).collect()}
    assert np.mean([got[i]["lang_pred"] == k for i, _, k in rows[100:]]) > 0.95
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[None]["lang_pred"] == "aa" and all(0 <= x["score"] <= 1 for x in got.values())
    assert langid.train(fit.limit(0)) is None
    assert {x["lang_pred"] for x in langid.predict(d, None).collect()} == {"und"}
    tables, w = net.tables(), np.frombuffer(bytes(range(128)) * 2, np.uint8).reshape(2, 128)
    assert np.allclose(net.logits(w, tables), net._forward(w)[2], atol=1e-3)


def brute_segments(s):
    """All maximal segments by the recursive definition."""
    def rec(lo, hi):
        best = None
        for a in range(lo, hi):
            t = 0.0
            for b in range(a + 1, hi + 1):
                t += s[b - 1]
                if t > 1e-12 and (best is None or t > best[2] + 1e-12 or (abs(t - best[2]) <= 1e-12 and b - a < best[1] - best[0])):
                    best = (a, b, t)
        return [] if best is None else rec(lo, best[0]) + [best] + rec(best[1], hi)
    return rec(0, len(s))


def test_maximal_segments():
    r = np.random.default_rng(5)
    for _ in range(150):
        s = r.normal(-0.3, 1, r.integers(0, 14))
        got = toxicity.maximal_segments(s)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute_segments(s)]


def test_toxicity(spark):
    r = random.Random(6)
    calm = ["".join(r.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    bad = ["zzgrim", "zzfoul", "zzvile"]
    rows, labels = [], []
    for i in range(800):
        w = [r.choice(calm) for _ in range(r.choice([10, 60]))]
        toxic = i % 5 == 0
        if toxic:
            at = r.randrange(len(w))
            w[at:at] = [r.choice(bad) for _ in range(4)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(rows + [(2000, None), (2001, ""), (None, "zzgrim zzfoul zzvile zzgrim"), (7, rows[7][1])],
                              "doc_id long, text string").withColumn("label_id", F.lit(1)).withColumn("kind", F.lit(9))
    lab = spark.createDataFrame(labels[:600] + [(None, 1), (3, None), (4, 0)], "doc_id long, toxic int")
    model = toxicity.fit(d, lab)
    got = {x["doc_id"]: x for x in toxicity.score(d, model).collect()}
    right = [(got[i]["score"] >= 0.3) == bool(y) for i, y in labels[600:]]
    assert np.mean(right) > 0.97
    assert got[None]["score"] >= 0.3 and got[2000]["score"] == got[2001]["score"] < 0.3
    hit = got[0]["segments"]
    assert hit and all(w.startswith("zz") for w in rows[0][1].split()[hit[0]["at"]:hit[0]["at"] + hit[0]["n"]])
    left = toxicity.keep_clean(d, model, 0.3)
    assert left.columns == d.columns and left.where("doc_id % 5 = 0 and doc_id < 800").count() < 8
    assert toxicity.fit(d, lab.where("toxic = 0")) is None
    assert {x["score"] for x in toxicity.score(d, None).collect()} == {0.0}
    assert toxicity.score(d.limit(0), model).count() == 0


def vectors():
    r = np.random.default_rng(9)
    rows, k = [], 0
    for label in (1, 2, None):
        centre = r.normal(size=(6, 16))
        for c in centre:
            for _ in range(15):
                rows.append((k, (c + r.normal(scale=r.choice([0.02, 0.12, 0.3]), size=16)).tolist(), label))
                k += 1
    rows += [(k + j, rows[3][1], 1) for j in range(20)]  # copies
    k += 20
    rows += [(k, None, 1), (k + 1, [0.0] * 16, 1), (k + 2, [float("nan")] * 16, 1), (k + 3, [1.0, None] * 8, 1),
             (k + 4, [], 1), (k + 5, [1.0, 2.0], 1), (k + 6, [1e-200] * 16, 2), (k + 7, [1e200] * 16, 2),
             (k + 8, [float("inf")] + [1.0] * 15, 1)]
    return rows


def brute_vectors(rows, cosine=0.98):
    ok = {}
    for i, v, label in rows:
        if label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v) / np.abs(v).max()
        ok[i] = (label, x / np.sqrt((x * x).sum()))
    links = [(a, b) for a in ok for b in ok if a != b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1])
             and (ok[a][1] * ok[b][1]).sum() >= cosine]
    comp = union_find([i for i, *_ in rows], links)
    n = {i: 0 for i, *_ in rows}
    for a, _ in links:
        n[a] += 1
    return [(i, n[i], comp[i], comp[i] == i) for i, *_ in rows]


@pytest.mark.parametrize("leaf,fan", [(1024, 16), (8, 3)])
def test_vectors(spark, leaf, fan):
    rows = vectors()
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("cell", F.lit(1))
    got = cover_tree.near_vectors(d, leaf=leaf, fan=fan)
    assert ordered(got.collect()) == ordered(brute_vectors(rows))


def shapes(r):
    """Unit vectors on arcs and patches: rows of few dimensions whose cells
    reach far beside the cells of their centres."""
    for d in (2, 3, 4):
        for n, wide in ((6, 0.4), (12, 0.8), (40, 1.5), (90, 3.0)):
            arc = np.zeros((n, d))
            angle = np.sort(r.uniform(-wide, wide, n))
            arc[:, 0], arc[:, 1] = np.cos(angle), np.sin(angle)
            patch = np.concatenate([r.uniform(-wide, wide, (n, d - 1)), np.ones((n, 1))], 1)
            for u in (arc, patch):
                u = u / np.sqrt((u * u).sum(1))[:, None]
                for order in (np.arange(n), np.arange(n)[::-1], r.permutation(n), r.permutation(n)):
                    yield u[order]


def test_linked_is_whole():
    flat = np.array([(-.33, 0), (-.13, 0), (-.03, 0), (-.03, .19), (.33, 0), (.16, 0)])
    u = np.concatenate([flat, np.sqrt(1 - (flat * flat).sum(1))[:, None]], 1)
    cases = [u] + list(shapes(np.random.default_rng(11)))
    for a, b in [(x, x) for x in cases] + list(zip(cases[1:-4], cases[5:])):
        if a.shape[1] == b.shape[1]:
            for cosine in (0.9, 0.98, 0.999):
                cos = a @ b.T
                got, sure = cover_tree.linked(a, b, cosine), np.abs(cos - cosine) > 1e-12
                assert (got == (cos >= cosine))[sure].all()


def test_levels_are_nested():
    for u in shapes(np.random.default_rng(12)):
        levels = list(cover_tree._levels(u))
        for (_, above, _), (net, of, _) in zip(levels, levels[1:]):
            assert (above[net[of]] == above).all() and (of[net] == np.arange(len(net))).all()


def test_no_vectors(spark):
    d = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert cover_tree.near_vectors(d).count() == 0
    one = spark.createDataFrame([(1, None, 3)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in cover_tree.near_vectors(one).collect()] == [(1, 0, 1, True)]


def test_preference(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"),
            (2, 0, "user", "same"), (3, 0, "user", "same"), (3, 1, "assistant", None), (4, 0, "user", "alone"),
            (7, 0, None, "x"), (6, 0, None, "x"), (6, 2, "assistant", "late"), (6, 1, "assistant", "early"),
            (None, 0, "user", "lost")]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pair_id", F.lit("clash"))
    got = {r["pair_id"]: r for r in preference.format_pairs(preference.conversation_pairs(t)).collect()}
    assert sorted(got) == [0, 1, 2, 3]
    x = got[0]
    assert x["n_common"] == 1 and x["prompt"] == "<|im_start|>user\nhi<|im_end|>\n"
    assert x["chosen_completion"] == "<|im_start|>assistant\nyes<|im_end|>\n"
    for side in ("chosen", "rejected"):
        whole = x["prompt"] + x[f"{side}_completion"]
        assert [whole[s["at"]:s["at"] + s["n"]] for s in x[f"{side}_mask"]] == [
            {"chosen": "yes", "rejected": "no"}[side] + "<|im_end|>"]
    assert got[1]["n_common"] == 1 and got[1]["chosen_completion"] == "" and got[1]["chosen_mask"] == []
    assert got[2]["n_common"] == 0 and got[2]["rejected_completion"] == ""
    assert got[3]["n_common"] == 1
    whole = got[3]["prompt"] + got[3]["chosen_completion"]
    assert [whole[s["at"]:s["at"] + s["n"]] for s in got[3]["chosen_mask"]] == ["early<|im_end|>", "late<|im_end|>"]
    assert preference.conversation_pairs(t.limit(0)).count() == 0
