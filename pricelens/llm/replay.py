"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct pieces of a batch of documents are laid out in one flat sequence
of tokens. An inverted index holds, for each token that a pair would make, the
places of those pairs; merges are applied to the whole batch in rank order and
only the two neighbours of a merge are looked at again. Each distinct piece is
thus merged once, however often it occurs, and a long piece costs no more than
its merges.

The ranks are read on each Python worker from a ``tiktoken`` file; its path
and the pre-tokenizer pattern are parameters.
"""

from __future__ import annotations

import base64
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of

REMEMBERED = 200_000  # a worker remembers one or two times as many words; they only save time
LONG = 100  # characters; longer texts are not remembered
PAIRS = 300_000  # and so many pairs of tokens
# A blank before a character that is not white space always begins a piece, so
# a text may be cut there. ``re`` counts a few more characters as white space
# than the pattern does; not to cut is always right.
BORDER = re.compile(r" (?=\S)")
NO_BORDER = re.compile(r" (?:\s|\Z)")


class Recent(dict):
    """Ids by text; a batch's texts are all in it, the older half is dropped when it is full."""

    old: dict = {}

    def learn(self, texts: list, ids: list) -> None:
        self.update(zip(texts, ids))
        self.long = [t for t in texts if len(t) > LONG]

    def trim(self) -> None:
        """Long texts stay for their batch only."""
        for t in self.long:
            self.pop(t, None)
        self.long = []

    long: list = []

    def unknown(self, texts: set) -> set:
        """The texts that have to be learnt, after those of the older half have been taken over."""
        if len(self) > REMEMBERED:
            self.old = dict(self)
            self.clear()
        texts = texts - self.keys()
        again = texts & self.old.keys()
        self.update((t, self.old[t]) for t in again)
        return texts - again


class Replay:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            lines = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.pieces = regex.compile(pattern)
        self.bytes = {rank: token for token, rank in self.ranks.items()}
        spelled = [self.bytes.get(i, b"") for i in range(max(self.bytes, default=-1) + 1)]
        self.spelled = pa.array(spelled, pa.large_binary())
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        two = [self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.two = np.array(two, np.int32)
        self.pairs: dict[tuple[int, int], int] = {}
        self.known = Recent()  # pieces
        self.heads = Recent()  # texts up to their first border
        self.words = Recent()  # what lies between two borders, for its blank and itself

    def _pair(self, a: int, b: int) -> int:
        """Rank of the token that two tokens make, -1 if there is none."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        rank = -1 if a < 0 or b < 0 else self.ranks.get(self.bytes[a] + self.bytes[b], -1)
        self.pairs[a, b] = rank
        return rank

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian, 32 bits) of each piece, all merged together in rank order.

        A piece that is a token is that token. In the others the pair of the
        lowest rank is merged first, the leftmost of equal ones. A merge may
        make a pair of a lower rank than its own; the rest of its piece then
        waits until that pair has been merged.
        """
        out = [array("i", [self.ranks[p]]).tobytes() if p in self.ranks else b"" for p in pieces]
        rest = [i for i, p in enumerate(pieces) if p and not out[i]]
        if not rest:
            return out
        sizes = np.array([len(pieces[i]) for i in rest])
        # one slot of -1 ahead of every piece and one at the end
        starts = np.concatenate(([0], np.cumsum(sizes + 1)))
        raw = np.frombuffer(b"".join([b"\0" + pieces[i] for i in rest]) + b"\0", np.uint8)
        flat = self.single[raw]
        flat[starts] = -1
        rank = self.two[raw[:-1].astype(np.int32) * 256 + raw[1:]]
        rank[starts[:-1]] = -1
        rank[starts[1:] - 1] = -1
        at = np.nonzero(rank >= 0)[0]
        at = at[np.argsort(rank[at], kind="stable")]
        values, first = np.unique(rank[at], return_index=True)
        places = {int(v): p.tolist() for v, p in zip(values, np.split(at, first[1:]))}
        token, n = array("i", flat.tobytes()), len(flat)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        known, pair, heads = self.pairs.get, self._pair, starts.tolist()
        heap = list(places)
        heapify(heap)

        while heap:
            r = heappop(heap)
            waiting, again = set(), []
            for p in sorted(places.pop(r)):
                q, t = after[p], token[p]
                if t < 0 or q >= n:
                    continue
                made = known((t, token[q]))
                if (pair(t, token[q]) if made is None else made) != r:
                    continue
                if waiting and bisect_right(heads, p) in waiting:
                    again.append(p)
                    continue
                token[p], token[q] = r, -2
                right = after[p] = after[q]
                before[right] = p
                left = before[p]
                for place, a, b in ((left, token[left], r), (p, r, token[right])):
                    made = known((a, b))
                    if made is None:
                        made = pair(a, b)
                    if made >= 0:
                        if made in places:
                            places[made].append(place)
                        else:
                            places[made] = [place]
                            heappush(heap, made)
                        if made < r:
                            waiting.add(bisect_right(heads, p))
            if again:
                if r not in places:
                    heappush(heap, r)
                places[r] = again + places.get(r, [])
        ids = np.frombuffer(token, np.int32)
        alive = ids >= 0
        ends = np.cumsum(alive)[starts[1:] - 1].tolist()
        data, low = ids[alive].astype("<u4").tobytes(), 0
        for i, high in zip(rest, ends):
            out[i], low = data[4 * low:4 * high], high
        return out

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of texts that stand between borders; pieces not yet known are merged together."""
        cut = [self.pieces.findall(w) for w in words]
        new = list(self.known.unknown({p for pieces in cut for p in pieces}))
        self.known.learn(new, self.merge([p.encode() for p in new]))
        out = [b"".join([self.known[p] for p in pieces]) for pieces in cut]
        self.known.trim()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of a batch of texts as little-endian 32-bit integers."""
        heads, rest, new = [], [], set()
        for text in texts:
            words = BORDER.split(text) if NO_BORDER.search(text) else text.split(" ")
            heads.append(words.pop(0))
            rest.append(words)
            new.update(words)
        new = list(self.words.unknown(new))
        self.words.learn(new, self._learn([" " + w for w in new]))
        first = list(self.heads.unknown(set(heads)))
        self.heads.learn(first, self._learn(first))
        word = self.words.__getitem__
        out = [self.heads[h] + b"".join(map(word, w)) for h, w in zip(heads, rest)]
        self.words.trim()
        self.heads.trim()
        return out

    def decode(self, ids: list[bytes]) -> pa.Array:
        """The bytes that each list of ids spells."""
        ends = np.cumsum([0, *[len(i) // 4 for i in ids]])
        tokens = self.spelled.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        if not len(tokens):
            return pa.array([b""] * len(ids), pa.binary())
        _, offsets, data = tokens.buffers()
        at = np.frombuffer(offsets, np.int64)[tokens.offset:][ends]
        data = memoryview(data)
        return pa.array([bytes(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Replay:
    return Replay(path, pattern)


def _encode(path: str, pattern: str, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = load(path, pattern)
        for batch in batches:
            ids = replay.encode([t or "" for t in batch.column("text").to_pylist()])
            out = {"row": batch.column("row"), "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
                   "ids": pa.array(ids, pa.binary())}
            if decoded:
                out["decoded"] = replay.decode(ids)
            yield pa.RecordBatch.from_arrays([*out.values()], [*out])

    return run


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = load(path, pattern)
        for batch in batches:
            decoded = replay.decode([i or b"" for i in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", carry: list[str] | None = None,
           decoded: bool = False) -> DataFrame:
    """``row`` (the input row, or its columns in ``carry``), ``n_tokens`` and ``ids`` of the whole text.

    ``ids`` are little-endian unsigned 32-bit integers. With ``decoded``, the
    bytes that they spell follow, from the same pass. A NULL or empty text has
    no ids; an empty table gives no rows; repeated rows stay.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row")
    whole = small_batches(docs).select(row, text_of(text).alias("text"))
    kind = whole.schema["row"].dataType.simpleString()
    return whole.mapInArrow(_encode(path, pattern, decoded),
                            f"row {kind}, n_tokens bigint, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``row, n_tokens, ids`` and ``decoded``, the bytes that the ids spell (NULL ids: none)."""
    slim = encoded.select("row", "n_tokens", "ids")
    kind = slim.schema["row"].dataType.simpleString()
    return slim.mapInArrow(_decode(path, pattern), f"row {kind}, n_tokens bigint, ids binary, decoded binary")
