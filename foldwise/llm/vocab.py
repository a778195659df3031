"""Public tokenizers inside tasks: vocabularies are read once a worker, and of a
slice of texts every different part is encoded once.

A space behind a character that is neither white space nor U+2581 starts a token
in both kinds of vocabulary: the byte-level pattern has no token that goes on
from non-space to space, and the piece vocabulary has no piece with U+2581
behind another character (checked when it is read). A text may therefore be cut
there, its parts encoded alone and the ids put together."""

from __future__ import annotations

import json
import re
import sys
import types

import numpy as np
import pyarrow as pa

from .kernels import _MASK, Texts, ragged

#: fixed values: the byte-level pre-tokenizer's pattern
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KIND = np.uint16
CALL = 512  # parts encoded at a time


def once(key, make):
    """A value kept as long as the worker process lives."""
    kept = sys.modules.setdefault("_foldwise_once", types.ModuleType("_foldwise_once")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable
    Latin-1 characters for themselves, the other bytes from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def joined(table: list[bytes], ids: np.ndarray) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


class ByteVocab:
    """A byte-level BPE vocabulary (`tokenizers` JSON file)."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in k): v for k, v in spec["model"]["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        size = max([*ranks.values(), *self.special.values()]) + 1
        if size > 1 << 16:
            raise ValueError("ids above 65535 are not supported")
        self.table = [b""] * size
        for k, v in ranks.items():
            self.table[v] = k
        self.size = np.array([len(x) for x in self.table], np.int64)
        self.plain = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @classmethod
    def of(cls, path: str) -> "ByteVocab":
        return once(("byte", path), lambda: cls(path))

    def spaced_all(self, texts: list[str]) -> list[int]:
        """Ids of the texts one after the other, each with a space before it;
        special tokens in them are plain text."""
        return [i for t in texts for i in self.plain(" " + t)]

    def text_table(self) -> list[bytes]:
        """Bytes of every id, special tokens included."""
        out = list(self.table)
        for k, v in self.special.items():
            out[v] = k.encode()
        return out


class PieceVocab:
    """A sentencepiece BPE model with byte fallback that adds a space."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        if len(pieces) > 1 << 16 or any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a vocabulary with more than 65536 pieces or with spaces inside pieces")
        self.table = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]
        self.size = np.array([len(x) for x in self.table], np.int64)
        self.model = m

    @classmethod
    def of(cls, path: str) -> "PieceVocab":
        return once(("piece", path), lambda: cls(path))

    def spaced_all(self, texts: list[str]) -> list[int]:
        """Ids of the texts one after the other; the model adds the space before
        each."""
        return [i for x in self.model.encode(texts, num_threads=1) for i in x]


def _closed(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the characters that end before the places `at` of UTF-8 bytes are
    surely neither white space nor U+2581."""
    pad = np.concatenate([np.full(3, 0x20, np.uint8), data])
    last, mid, lead = pad[at + 2], pad[at + 1], pad[at]
    ascii_ = (last > 0x20) & (last < 0x80)
    # wide white space: U+0085, U+00A0, and characters from U+1000 to U+3FFF
    wide = ((mid == 0xC2) & ((last == 0x85) | (last == 0xA0))) | ((lead >= 0xE1) & (lead <= 0xE3))
    return ascii_ | ((last >= 0x80) & ~wide)


def _same(v: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> bool:
    """Whether the bytes at a and b are the same, eight at a time."""
    k, at = 0, np.arange(len(a))
    while len(at):
        keep = _MASK[np.minimum(size[at] - k, 8)]
        if ((v[a[at] + k] ^ v[b[at] + k]) & keep).any():
            return False
        k += 8
        at = at[size[at] > k]
    return True


class SliceIds:
    """Ids of a slice of texts in several vocabularies, each text with a space
    before it. Every different part of the slice is encoded once, and compared
    byte by byte with the parts that take its ids. `ids` holds each vocabulary's
    ids of all texts, one after the other, `n` how many a text has: none where
    the text is null or empty or a vocabulary doesn't give it back."""

    def __init__(self, texts: list, vocabs: list):
        self.n = np.zeros((len(vocabs), len(texts)), np.int64)
        rows = [i for i, t in enumerate(texts) if t and "▁" not in t]
        self.ids = [np.zeros(0, KIND)] * len(vocabs)
        if rows and not self._by_parts([texts[i] for i in rows], rows, vocabs):
            self._one_by_one(texts, rows, vocabs)

    def _by_parts(self, texts, rows, vocabs) -> bool:
        raw = [b" " + t.encode() for t in texts]
        begin = np.cumsum([0, *map(len, raw)])
        t = Texts(pa.array([b"".join(raw)], pa.binary()))
        data, v = t.data, t.load8()
        space = np.flatnonzero(data == 0x20)
        start = np.union1d(space[_closed(data, space)], begin[:-1])
        stop = np.append(start[1:], len(data))
        size = stop - start
        # the last part of a text that ends with white space is encoded alone
        odd = np.isin(stop, begin) & ~_closed(data, stop)
        plain, alone = np.flatnonzero(~odd), np.flatnonzero(odd)
        _, first, inv = np.unique(t.word_hash(start[plain], stop[plain]), return_index=True, return_inverse=True)
        first = plain[first]
        if (size[plain] != size[first[inv]]).any() or not _same(v, start[plain], start[first[inv]], size[plain]):
            return False
        which = np.empty(len(start), np.int64)
        which[plain], which[alone] = inv, len(first) + np.arange(len(alone))
        part = np.concatenate([first, alone])
        own = data[ragged(start[part], size[part])].tobytes()
        ends = np.cumsum(size[part])
        calls = np.concatenate([np.arange(0, len(first), CALL), len(first) + np.arange(len(alone)), [len(part)]])
        at = np.concatenate([[0], ends])[calls].tolist()
        pieces = [own[i:j].decode()[1:] for i, j in zip(at, at[1:])]
        text_of = np.searchsorted(begin, start, "right") - 1
        for k, vocab in enumerate(vocabs):
            flat = np.array(vocab.spaced_all(pieces), KIND)
            token_ends = np.cumsum(vocab.size[flat])
            last = np.searchsorted(token_ends, ends)
            if not len(flat) or token_ends[-1] != ends[-1] or (token_ends[last] != ends).any() or joined(vocab.table, flat) != own:
                return False
            off = np.concatenate([[0], last + 1])
            count = np.diff(off)[which]
            self.ids[k] = flat[ragged(off[which], count)]
            self.n[k, rows] = np.bincount(text_of, weights=count, minlength=len(texts)).astype(np.int64)
        return True

    def _one_by_one(self, texts, rows, vocabs) -> None:
        self.n[:] = 0
        found = [[np.zeros(0, KIND)] for _ in vocabs]
        for i in rows:
            got = [np.array(x.spaced_all([texts[i]]), KIND) for x in vocabs]
            if all(joined(x.table, g) == (" " + texts[i]).encode() for x, g in zip(vocabs, got)):
                for k, g in enumerate(got):
                    found[k].append(g)
                    self.n[k, i] = len(g)
        self.ids = [np.concatenate(f) for f in found]
