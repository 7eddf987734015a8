"""BPE encoding and decoding by per-prefix dynamic programming.

A piece of text is encoded by finding, for each of its prefixes, the last
token of that prefix's encoding. Candidates are the tokens that end there (an
automaton over the vocabulary with suffix links lists them); a candidate is
the one if the last token of the prefix before it is compatible with it. The
compatible candidate is unique, so back-pointers give exactly the ids that
merging in rank order gives, in time linear in the piece.

The vocabulary is read on each Python worker from a ``tokenizers`` JSON file
of a byte-level BPE; its path is a parameter.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of

# Fixed value: the pre-tokenizer pattern of byte-level BPE vocabularies.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CACHE_ENTRIES = 400_000  # a worker's memory of recent words; it only saves time


def byte_letters() -> dict[str, int]:
    """The letter of each byte in a byte-level vocabulary -> the byte.

    Printable Latin-1 stands for itself; the others follow from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Memory(dict):
    """Values by key, made by ``make``; holds the most recent one or two ``limit``s."""

    def __init__(self, make, limit: int = CACHE_ENTRIES // 2):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Irregular(Exception):
    """A word that cannot be encoded apart from the white space around it."""


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        spell = lambda token: bytes(letters[c] for c in token)
        ids = {spell(t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = dict((i, t) for t, i in ids.items()) | {i: t.encode() for t, i in self.added.items()}
        self.merges: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token -> (rank, left, right)
        for rank, pair in enumerate(model["merges"]):
            left, right = (spell(t) for t in (pair.split(" ") if isinstance(pair, str) else pair))
            a, b = ids[left], ids[right]
            self.merges.setdefault((a, b), rank)
            self.made.setdefault(ids[left + right], (rank, a, b))
        self.automaton = ahocorasick.Automaton()
        for t, i in ids.items():
            if len(t) == 1 or i in self.made:
                self.automaton.add_word(t.decode("latin-1"), (len(t), i))
        self.automaton.make_automaton()
        whole = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.split_added = regex.compile(f"({whole})") if whole else None
        self.compatible = Memory(self._compatible, 150_000)
        self.pieces = Memory(self._ids, CACHE_ENTRIES // 10)
        self.words = Memory(self._word)

    def _compatible(self, pair: int) -> bool:
        """Would merging leave the border between the two tokens alone?

        Merges are undone from the last to the first. While the two pieces at
        the border are x and y, until ``until``, their own merge must not come
        sooner. Of equal ranks the left one is merged first.
        """
        x, y = pair >> 32, pair & 0xFFFFFFFF
        until, ties = len(self.merges), False
        never = (-1, None, None)
        while True:
            rank = self.merges.get((x, y))
            if rank is not None and (rank < until or ties and rank == until):
                return False
            mx, my = self.made.get(x, never), self.made.get(y, never)
            if max(mx[0], my[0]) < 0:
                return True
            if mx[0] > my[0]:
                until, ties, x = mx[0], False, mx[2]
            else:
                until, ties, y = my[0], True, my[1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the last token of every prefix, then back."""
        last: list = [None] * (len(piece) + 1)
        compatible = self.compatible
        for at, (size, token) in self.automaton.iter(piece.decode("latin-1")):
            if last[at + 1] is None and (size > at or compatible[last[at + 1 - size] << 32 | token]):
                last[at + 1] = token
        out, at = [], len(piece)
        while at:
            out.append(last[at])
            at -= len(self.bytes[last[at]])
        return out[::-1]

    def _ids(self, piece: str) -> bytes:
        return array("i", self.encode_piece(piece.encode())).tobytes()

    def _cut(self, text: str) -> bytes:
        """Piece by piece; a blank and letters are a word."""
        words, pieces = self.words, self.pieces
        return b"".join([words[p[1:]] if p[0] == " " and p[1:].isalpha() else pieces[p] for p in PIECES.findall(text)])

    def _word(self, word: str) -> bytes:
        """A word and the blank before it; white space at its ends needs its neighbours."""
        if word.isalpha():
            return self._ids(" " + word)
        if not word or word[0].isspace() or word[-1].isspace():
            raise Irregular
        return self._cut(" " + word)

    def _plain(self, text: str) -> bytes:
        # a blank between two words always begins a pre-token
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            try:
                words = self.words
                return self._cut(first) + b"".join([words[w] for w in rest])
            except Irregular:
                pass
        return self._cut(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if self.split_added is None or not any(t in text for t in self.added):
            return self._plain(text)
        parts = self.split_added.split(text)
        return b"".join([np.array([self.added[p]], "<i4").tobytes() if i % 2 else self._plain(p)
                         for i, p in enumerate(parts)])

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def _encode(path: str, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            ids = [bpe.encode(t or "") for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *[len(i) // 4 for i in ids]])
            values = np.frombuffer(b"".join(ids), "<i4")
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            out = {"row": batch.column("row"), "ids": lists}
            if decoded:
                out["decoded"] = pa.array([bpe.decode(np.frombuffer(i, "<i4").tolist()) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*out.values()], [*out])

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [None if i is None else bpe.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("ids"), pa.array(texts, pa.string())], ["row", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None,
           decoded: bool = False) -> DataFrame:
    """``row`` (the input row, or its columns in ``carry``) and ``ids`` of the whole text.

    With ``decoded``, the text that the ids decode to follows, from the same
    pass. A NULL or empty text has no ids. An empty table gives no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row")
    whole = small_batches(docs).select(row, text_of(text).alias("text"))
    kind = whole.schema["row"].dataType.simpleString()
    return whole.mapInArrow(_encode(path, decoded), f"row {kind}, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``row, ids, decoded`` for ``row, ids``; bytes that are not UTF-8 become U+FFFD."""
    kind = encoded.schema["row"].dataType.simpleString()
    return encoded.select("row", "ids").mapInArrow(_decode(path), f"row {kind}, ids array<int>, decoded string")
