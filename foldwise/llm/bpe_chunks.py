"""BPE encoding and decoding with content-defined chunk reuse (operator 13).

Texts are cut where a rolling hash of the last `WINDOW` bytes ends in zeros, so
equal passages are cut alike wherever they stand. Chunks that occur more than
once are shipped once a slice, brought together by a 128-bit hash, encoded once
and kept in a dictionary; the stretches between them are encoded in place. A
Bloom filter of fixed size tells the tasks which chunks may be in the
dictionary; a chunk that it takes by mistake is there too, since the dictionary
is filled through the same filter.

Joins are repaired: a space behind a character that is not white space starts a
token in every text, so the tokens from the last such place before a join to the
first one behind it are encoded again as one text. Both sides then agree with
the encoding of the whole text; where a piece has no such place, the repair goes
on through the whole piece into the next one until they do. Special tokens are
walls: nothing is joined across them.

Only documents that hold dictionary chunks are put together by a shuffle, each
different text once. A null text is an empty one and has no ids. Rows that
repeat an id or a text are encoded alike. An empty table gives an empty result.
Chunks hold at most `LONGEST` bytes."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored
from .kernels import slices
from .vocab import KIND, ByteVocab, joined

WINDOW = 16
ZEROS = 9
LONGEST = 1 << 16
BLOOM_BITS = 26
SLICE = 1 << 20
ROWS = 256
_FACTOR = 0x9E3779B1  # odd, for a hash modulo 2^32


def cuts(raw: bytes, zeros: int = ZEROS) -> list[int]:
    """Where chunks end: at a character whose last WINDOW bytes hash to a number
    that ends in `zeros` zero bits, or after LONGEST bytes without one."""
    n = len(raw)
    if not n:
        return []
    data = np.frombuffer(raw, np.uint8)
    at = np.zeros(0, np.int64)
    if n > WINDOW:
        # hash of 2, 4, 8 ... bytes from the hashes of their halves
        h, width, power = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B), 1, _FACTOR
        while width < WINDOW:
            h = h[:-width] * np.uint32(power) + h[width:]
            width, power = width * 2, power * power & 0xFFFFFFFF
        h ^= h >> np.uint32(15)
        at = np.flatnonzero((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - zeros) == 0) + WINDOW
        at = at[at < n]
        at = at[(data[at] & 0xC0) != 0x80]  # a character starts there
    out, before = [], 0
    for x in [*at.tolist(), n]:
        while x - before > LONGEST:
            before += LONGEST
            while data[before] & 0xC0 == 0x80:
                before -= 1
            out.append(before)
        out.append(x)
        before = x
    return out


def chunks(text: str, special, zeros: int = ZEROS):
    """The pieces of a text in order: (bytes, is a special token)."""
    out = []
    for i, s in enumerate(special.split(text) if special else [text]):
        if i % 2:
            out.append((s.encode(), True))
            continue
        raw, a = s.encode(), 0
        for b in cuts(raw, zeros):
            out.append((raw[a:b], False))
            a = b
    return out


def chunk_key(raw: bytes) -> tuple[int, int]:
    h = hashlib.blake2b(raw, digest_size=16).digest()
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _places(h1: int, h2: int, bits: int):
    m = (1 << bits) - 1
    return h1 & m, (h1 >> 32) & m, h2 & m


def _specials(vocab: ByteVocab):
    names = sorted(vocab.special, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None


class Filter:
    """A Bloom filter of 2^bits bits."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def __contains__(self, key) -> bool:
        return all(self.words[p >> 5] >> (p & 31) & 1 for p in _places(*key, self.bits))

    @classmethod
    def of(cls, keys: DataFrame, bits: int) -> "Filter":
        """From (h1, h2): the bits are put together by Spark, their words, a fixed
        number at most, come to the driver."""
        m = (1 << bits) - 1
        place = F.explode(F.array(F.col("h1").bitwiseAND(m), F.shiftright("h1", 32).bitwiseAND(m),
                                  F.col("h2").bitwiseAND(m)))
        got = (keys.select(place.alias("p")).groupBy(F.shiftright("p", 5).cast("int").alias("w"))
               .agg(F.expr("bit_or(shiftleft(1L, cast(p & 31 AS int)))").alias("b"))
               .toPandas())
        words = np.zeros(max(1 << bits >> 5, 1), np.uint32)
        words[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64).astype(np.uint32)
        return cls(words, bits)


def repeated_chunks(docs: DataFrame, vocab: str, text: str = "text", zeros: int = ZEROS) -> DataFrame:
    """(h1, h2): keys of the chunks that occur more than once."""

    def run(batches):
        special = _specials(ByteVocab.of(vocab))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                n: dict = {}
                for t in part.column(0).to_pylist():
                    for raw, wall in chunks(t or "", special, zeros):
                        if not wall:
                            k = chunk_key(raw)
                            n[k] = n.get(k, 0) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in n], pa.int64()), pa.array([k[1] for k in n], pa.int64()),
                     pa.array(list(n.values()), pa.int64())], names=["h1", "h2", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "h1 long, h2 long, n long")
    return rows.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where("n > 1").select("h1", "h2")


def dictionary(docs: DataFrame, vocab: str, known, text: str = "text", zeros: int = ZEROS) -> DataFrame:
    """(h1, h2, ids): every different chunk that the filter `known` (broadcast)
    holds, encoded once; ids are 16-bit integers side by side."""

    def ship(batches):
        special, keep = _specials(ByteVocab.of(vocab)), known.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = {}
                for t in part.column(0).to_pylist():
                    for raw, wall in chunks(t or "", special, zeros):
                        if not wall and (k := chunk_key(raw)) not in found and k in keep:
                            found[k] = raw
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in found], pa.int64()), pa.array([k[1] for k in found], pa.int64()),
                     pa.array([r.decode() for r in found.values()], pa.string())], names=["h1", "h2", "text"])

    def encode_each(batches):
        own = ByteVocab.of(vocab)
        for batch in _few(batches):
            ids = [np.array(own.plain(t), KIND).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), pa.array(ids, pa.binary())],
                                             names=["h1", "h2", "ids"])

    once = docs.select(F.col(text).alias("text")).mapInArrow(ship, "h1 long, h2 long, text string")
    return once.dropDuplicates(["h1", "h2"]).mapInArrow(encode_each, "h1 long, h2 long, ids binary")


def _held(text: str, special, keep, zeros: int) -> bool:
    """Whether a text has a dictionary chunk."""
    return any(not wall and chunk_key(raw) in keep for raw, wall in chunks(text, special, zeros))


def _plain(text: str, own: ByteVocab, special) -> np.ndarray:
    """Ids of a text encoded whole."""
    out = []
    for i, s in enumerate(special.split(text) if special else [text]):
        out += [own.special[s]] if i % 2 else own.plain(s)
    return np.array(out, KIND)


def pieces(text: str, own: ByteVocab, special, keep, zeros: int = ZEROS):
    """A text as [(key of a dictionary chunk, None) or (None, ids)], special
    tokens and the stretches between dictionary chunks being ids."""
    out, run = [], []

    def close():
        if run:
            out.append((None, np.array(own.plain(b"".join(run).decode()), KIND)))
            run.clear()

    for raw, wall in chunks(text, special, zeros):
        if wall:
            close()
            out.append((None, np.array([own.special[raw.decode()]], KIND)))
        elif (k := chunk_key(raw)) in keep:
            close()
            out.append((k, None))
        else:
            run.append(raw)
    close()
    return out


_OPEN = re.compile(r"(?<=\S) ")  # a token starts at this space


def put_together(parts: list[np.ndarray], own: ByteVocab) -> np.ndarray:
    """Ids of the text whose pieces, one after the other, have these ids."""
    done: list[np.ndarray] = []  # right in the whole text
    tail: bytes | None = None  # text behind them that is to be encoded again

    def again():
        nonlocal tail
        if tail:
            done.append(np.array(own.plain(tail.decode()), KIND))
        tail = None

    walls = set(own.special.values())
    for x in parts:
        if len(x) == 1 and int(x[0]) in walls:
            again()
            done.append(x)
            continue
        raw = joined(own.table, x)
        text = raw.decode()
        first, last = _OPEN.search(text), None
        if first is not None:
            last = text.rfind(" ", first.start())
            while text[last - 1].isspace():
                last = text.rfind(" ", first.start(), last)
        if first is None:  # no place to agree in this piece: all of it joins the repair
            tail = (tail or b"") + raw
            continue
        ends = np.cumsum(own.size[x])
        a, b = len(text[:first.start()].encode()), len(text[:last].encode())
        i, j = np.searchsorted(ends, (a, b), "left") + 1
        if tail is not None:
            tail += raw[:a]
            again()
        else:
            i = 0  # the piece starts the text or follows a wall
        done.append(x[i:j])
        tail = raw[b:]
    again()
    return np.concatenate(done) if done else np.zeros(0, KIND)


def encode(docs: DataFrame, vocab: str, text: str = "text", out: str = "ids", zeros: int = ZEROS,
           bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """The rows of docs without `text`, with their ids (array<int>). `vocab` is a
    `tokenizers` JSON file that every machine has at this place."""
    t, key = fresh(docs, "_t"), fresh(docs, "_k")
    carry = [c for c in docs.columns if c not in (text, out)]
    keys = stored(repeated_chunks(docs, vocab, text, zeros), "repeated")
    known = docs.sparkSession.sparkContext.broadcast(Filter.of(keys, bloom_bits))
    words = stored(dictionary(docs, vocab, known, text, zeros), "dictionary")
    # two independent 64-bit hashes name a text
    name = F.struct(F.xxhash64(F.col(text)).alias("a"), F.xxhash64(F.lit(1), F.col(text)).alias("b"))
    src = docs.select(*carry, name.alias(key), F.coalesce(F.col(text), F.lit("")).alias(t))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name in carry]
    kind = "struct<a: bigint, b: bigint>"

    def whole(batches):
        own = ByteVocab.of(vocab)
        special, keep = _specials(own), known.value
        for batch in batches:
            for part in slices(batch, t, SLICE):
                rows, ids = [], []
                for i, s in enumerate(part.column(t).to_pylist()):
                    if not _held(s, special, keep, zeros):
                        rows.append(i)
                        ids.append(_plain(s, own, special))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(rows, pa.int64())) for c in carry), _lists(ids)], names=[*carry, out])

    def held(batches, with_pieces):
        own = ByteVocab.of(vocab)
        special, keep = _specials(own), known.value
        for batch in batches:
            for part in slices(batch, t, SLICE):
                rows, got, seen = [], [], set()
                for i, (s, k) in enumerate(zip(part.column(t).to_pylist(), part.column(key).to_pylist())):
                    k = (k["a"], k["b"])
                    if with_pieces and k in seen:
                        continue
                    seen.add(k)
                    if _held(s, special, keep, zeros):
                        rows.append(i)
                        if with_pieces:
                            got.append([{"h1": h and h[0], "h2": h and h[1], "ids": None if x is None else x.tobytes()}
                                        for h, x in pieces(s, own, special, keep, zeros)])
                yield part.take(pa.array(rows, pa.int64())).drop_columns([t]) if not with_pieces else (
                    pa.RecordBatch.from_arrays(
                        [part.column(key).take(pa.array(rows, pa.int64())),
                         pa.array(got, pa.list_(pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("ids", pa.binary())])))],
                        names=["k", "p"]))

    def finish(batches):
        own = ByteVocab.of(vocab)
        for batch in _few(batches):
            ids = [put_together([np.frombuffer(y["ids"], KIND) for y in p], own).tobytes()
                   for p in batch.column("p").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(ids, pa.binary())], names=["k", "ids"])

    def listed(batches):
        for batch in _few(batches):
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry),
                 _lists([np.frombuffer(x, KIND) for x in batch.column("ids").to_pylist()])], names=[*carry, out])

    final = ", ".join([*fields, f"`{out}` array<int>"])
    holes = src.mapInArrow(lambda b: held(b, True), f"k {kind}, p array<struct<h1: bigint, h2: bigint, ids: binary>>")
    holes = stored(holes.dropDuplicates(["k"]).select("k", F.posexplode("p").alias("i", "x")).select("k", "i", "x.*"), "pieces")
    filled = (holes.where("ids is null").drop("ids").join(words, ["h1", "h2"]).select("k", "i", "ids")
              .union(holes.where("ids is not null").select("k", "i", "ids")))
    texts = (filled.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("i", "ids"))).alias("p"))
             .mapInArrow(finish, f"k {kind}, ids binary"))
    texts = stored(texts, "texts")
    rows = src.mapInArrow(lambda b: held(b, False), ", ".join([*fields, f"`{key}` {kind}"]))
    back = rows.join(texts, rows[key] == texts["k"]).select(*carry, "ids").mapInArrow(listed, final)
    return src.mapInArrow(whole, final).union(back)


def _few(batches, rows: int = ROWS):
    """The batches in parts of a few rows, so that a worker holds little output."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    off = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int32)
    flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat))


def decode(encoded: DataFrame, vocab: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """The rows of `encoded` with the text of their ids; special tokens are
    written out, bytes that are no UTF-8 become U+FFFD, ids that the vocabulary
    doesn't have are left out. Null ids give a null text."""
    carry = [c for c in encoded.columns if c != out]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name in carry]

    def run(batches):
        table = ByteVocab.of(vocab).text_table()
        for batch in _few(batches):
            got = []
            for row in batch.column(ids):
                if not row.is_valid:
                    got.append(None)
                    continue
                x = row.values.to_numpy(zero_copy_only=False)
                got.append(joined(table, x[(x >= 0) & (x < len(table))]).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(got, pa.string())],
                                             names=[*carry, out])

    return encoded.select(*carry).mapInArrow(run, ", ".join([*fields, f"`{out}` string"]))
