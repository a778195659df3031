"""Token alignment, importance resampling and chunked encoding against brute
force, with nulls, empty and very long texts, ties, repeated rows, empty tables
and extra columns of clashing names."""

import hashlib
import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foldwise.llm import alignment, bpe_chunks, importance
from foldwise.llm.common import components
from foldwise.llm.cover_tree import near_vectors
from foldwise.llm.preference import conversation_pairs
from foldwise.llm.vocab import ByteVocab, PieceVocab, SliceIds, byte_alphabet
from foldwise.plans.models import Learner

from .helpers import ALNUM, LOWER, ordered

BYTE, PIECE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def texts(seed: int, n: int) -> list[tuple]:
    r = random.Random(seed)
    alpha = [" ", " ", "  ", "\n", "\t", "a", "be", "'s", "'ll", "'", "é", "ß ", "漢", "😀", "1", "23", "!", "...", "▁", "</s>",
             "<|endoftext|>", "<|endof", "text|>", "\x1c", "\x85", "\u3000", "the", " of", " word", "\x00"]
    mk = (lambda k: "".join(r.choice(alpha) for _ in range(k)))
    shared = [mk(150) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [r.choice([mk(r.randint(0, 40)), r.choice(shared), r.choice(shared)[r.randint(0, 200):]])
                 for _ in range(r.randint(0, 4))]
        rows.append((i, "".join(parts)))
    rows += [(1000, None), (1001, ""), (1002, "x" * 90000), (1003, "x" * 90000), (1004, " " * 70000 + "b"), (None, "no id"),
             (1005, "漢" * 40000), *rows[:4]]
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    rows = texts(5, 150)
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"ids": F.lit("x"), "pairs": F.lit(1), "rank": F.lit(None).cast("string"), "key": F.lit(2), "_t": F.lit(0), "n_words": F.lit(0)})
    return rows, d.repartition(4)


def brute_alignment(rows):
    t = Tokenizer.from_file(BYTE)
    t.encode_special_tokens = True
    m = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    alphabet, out, df = byte_alphabet(), [], Counter()
    for i, text in rows:
        rec = [i, 0, 0, "", Counter()]
        if text:
            raw = (" " + text).encode()
            a, b = t.encode(" " + text, add_special_tokens=False).ids, m.encode(text)
            ab = [bytes(alphabet[c] for c in t.id_to_token(x)) for x in a]
            bb = [bytes([int(m.id_to_piece(x)[3:5], 16)]) if m.is_byte(x) else m.id_to_piece(x).replace("▁", " ").encode() for x in b]
            if b"".join(ab) == raw == b"".join(bb):
                ea, eb = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
                x = y = 0
                groups, links = [], Counter()
                for e in sorted(set(ea) & set(eb)):
                    x2, y2 = ea.index(e, x) + 1, eb.index(e, y) + 1
                    groups.append(",".join(map(str, a[x:x2])) + "|" + ",".join(map(str, b[y:y2])))
                    for p, n in Counter(a[x:x2]).items():
                        for q, k in Counter(b[y:y2]).items():
                            links[p, q] += n * k
                    x, y = x2, y2
                rec = [i, len(a), len(b), ";".join(groups), links]
                df.update(links.keys())
        out.append(rec)
    best: dict = {}
    for (p, _), c in df.items():
        best[p] = max(best.get(p, 0), c)
    return [(i, na, nb, g.count(";") + bool(g), sum(ln.values()), sum(w for k, w in ln.items() if df[k] == best[k[0]]),
             sum(w * df[k] for k, w in ln.items()), g) for i, na, nb, g, ln in out]


@pytest.mark.parametrize("frequent", [1 << 20, 10])
def test_alignment(spark, corpus, frequent):
    rows, d = corpus
    al = alignment.align(d, BYTE, PIECE).cache()
    groups = al.select("doc_id", "groups", "n_groups")
    got = alignment.link_scores(al.drop("groups"), frequent=frequent).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    want = brute_alignment(rows)
    assert ordered(got.collect()) == ordered([w[:7] for w in want])
    assert ordered(groups.select("doc_id", "groups").collect()) == ordered([(w[0], w[7]) for w in want])
    al.unpersist()
    none = alignment.align(d.limit(0), BYTE, PIECE)
    assert none.count() == 0 and alignment.link_scores(none.drop("groups")).count() == 0


def test_gallop():
    r = np.random.default_rng(2)
    for _ in range(50):
        x, y = (np.unique(r.integers(0, 400, r.integers(0, 150))) for _ in range(2))
        for lanes in (1, 3, 4096):
            assert (alignment.gallop(x, y, lanes) == np.searchsorted(y, x)).all()


def test_slices_of_texts_are_encoded_like_texts():
    va, vb = ByteVocab.of(BYTE), PieceVocab.of(PIECE)
    own = [t for _, t in texts(8, 300)]
    x = SliceIds(own, [va, vb])
    cut = (lambda ids, n: [c.tolist() for c in np.split(ids, np.cumsum(n)[:-1])])
    a, b = cut(x.ids[0], x.n[0]), cut(x.ids[1], x.n[1])
    for t, i, j in zip(own, a, b):
        if t and "▁" not in t:
            assert i == va.plain(" " + t) and j == vb.model.encode(t)
        else:
            assert i == j == []


def brute_resample(rows, target, share=25, min_words=20, buckets=10000):
    feats = (lambda t: (w := ALNUM.findall((t or "").translate(LOWER)), w + [f"{a} {b}" for a, b in zip(w, w[1:])]))
    hash_ = (lambda f: crc32(f.encode()) % buckets)
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(map(hash_, feats(x)[1]))
    for x in target:
        t.update(map(hash_, feats(x)[1]))
    over, under = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for i, x in rows:
        w, f = feats(x)
        gain = sum(math.floor(1000 * math.log((t[hash_(y)] + 1) * over / ((s[hash_(y)] + 1) * under))) for y in f)
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = gain // len(f) if f else 0
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= min_words])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return out, [(r[0], r[3]) for r in fit[:len(fit) * share // 100]]


@pytest.mark.parametrize("pivots", [16, 1])
def test_resampling(spark, pivots):
    r = random.Random(3)
    vocab = ["Aa", "bb", "cc", "ÉÉ", "x1", "zz", "q", "dd"]
    rows = [(i, "-".join(r.choice(vocab) for _ in range(r.choice([3, 19, 20, 40])))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "aa " * 30), (502, "bb cc " * 20000)] + rows[:10] + [rows[3]] * 30
    target = ["aa bb", None, "", "cc dd aa", "x1 x1"]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rank": F.lit("old"), "key": F.lit(1), "n_words": F.lit(7)})
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = importance.resample(d.repartition(3), t, pivots=pivots).collect()
    want, drawn = brute_resample(rows, target)
    assert ordered([(x["doc_id"], x["n_features"], x["weight"], x["score"]) for x in got]) == ordered([x[:4] for x in want])
    won = sorted((x for x in got if x["rank"] is not None), key=lambda x: x["rank"])
    assert [x["rank"] for x in won] == list(range(1, len(drawn) + 1))
    assert [(x["doc_id"], x["score"]) for x in won] == drawn
    assert set(got[0].asDict()) == {"doc_id", "text", "key", "n_words", "n_features", "weight", "score", "rank"}
    assert importance.resample(d.limit(0), t).count() == 0
    few = importance.resample(d.where("doc_id in (500, 501)"), t.limit(0)).collect()
    assert [x["rank"] for x in few] == [None, None]


def test_long_texts_in_pieces():
    text = "Ab cD,ef  " * 500 + "x" * 3000 + " tail"
    whole = [sum((x[k] for x in importance._hashes(text, 1 << 20)), []) for k in (0, 1)]
    for piece in (1, 7, 100):
        assert [sum((x[k] for x in importance._hashes(text, piece)), []) for k in (0, 1)] == whole


@pytest.mark.parametrize("zeros,bits", [(4, 26), (6, 6), (9, 26)])
def test_chunked_encoding(spark, corpus, zeros, bits):
    rows, d = corpus
    t = Tokenizer.from_file(BYTE)
    e = bpe_chunks.encode(d, BYTE, zeros=zeros, bloom_bits=bits)
    got = e.select("doc_id", "ids").collect()
    assert ordered([(x["doc_id"], tuple(x["ids"])) for x in got]) == ordered(
        [(i, tuple(t.encode(s or "", add_special_tokens=False).ids)) for i, s in rows])
    if zeros == 9:
        back = bpe_chunks.decode(e, BYTE).select("doc_id", "text").collect()
        assert ordered(back) == ordered([(i, s or "") for i, s in rows])
        assert bpe_chunks.encode(d.limit(0), BYTE).count() == 0


def test_decode_odd_ids(spark):
    t = Tokenizer.from_file(BYTE)
    rows = [(1, [50256, 15496]), (2, [447]), (3, [447, 447, 10]), (4, []), (5, None), (6, [60000, -1, 15496])]
    got = {r["k"]: r["text"] for r in bpe_chunks.decode(spark.createDataFrame(rows, "k int, ids array<int>"), BYTE).collect()}
    for k, ids in rows[:4]:
        assert got[k] == t.decode(ids, skip_special_tokens=False)
    assert got[5] is None and got[6] == "Hello"


def test_chunks_are_cut_alike():
    r = random.Random(1)
    passage = "".join(r.choice("abcdef ghij") for _ in range(4000))
    own = [x for x, _ in bpe_chunks.chunks(passage, None, 6)]
    for before in ("", "z", "some other words "):
        got = [x for x, _ in bpe_chunks.chunks(before + passage, None, 6)]
        assert got[-len(own) + 1:] == own[1:] and b"".join(got).decode() == before + passage


@pytest.mark.parametrize("kind", ["logit", "forest", "linear_svm"])
def test_learners_predict_after_components(spark, kind):
    links = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a long, b long")
    assert components(links).count() == 5
    r = random.Random(6)
    d = spark.createDataFrame([(r.gauss(0, 1), i % 2) for i in range(100)], "a double, y int")
    assert len(Learner(kind).fit(d, ["a"], "y").predict(d).collect()) == 100


def test_vectors_with_repeated_ids_and_multiples(spark):
    v = (lambda *rows: spark.createDataFrame(list(rows), "vec_id long, embedding array<double>, label int"))
    got = near_vectors(v((1, [1.0, 0.0], 1), (1, None, 1), (2, [0.0, 1.0], 1), (3, [0.0, 0.0], 1))).collect()
    assert ordered([tuple(x) for x in got]) == ordered([(1, 0, 1, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)])
    many = near_vectors(v(*[(k, [k * 1.0, k * 0.1, k / 3], 1) for k in range(1, 301)]), leaf=16, fan=4).collect()
    assert len(many) == 300 and {(x["n_links"], x["component_id"]) for x in many} == {(299, 1)}


def test_pairs_of_large_ids(spark):
    top = 1 << 60
    turns = spark.createDataFrame([(top + i, 0, "user", f"t{i}") for i in range(4)], "conv_id long, turn long, role string, text string")
    assert {r["pair_id"] for r in conversation_pairs(turns).collect()} == {top // 2, top // 2 + 1}
