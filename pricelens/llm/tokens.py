"""Token ids in compressed shard files: one wavelet matrix a shard.

Texts are encoded by the ``tokenizers`` library; the ids are range-partitioned
by document id and each task packs its documents, in order, into shards of
about ``SHARD_TOKENS`` ids. A shard file holds its documents' ids and lengths
and the wavelet matrix of the ids: one bit plane per bit of an id, from the
top, with rank counts per superblock. Token access, counting and the place of
the k-th occurrence are answered from the file alone.

The files are written by Spark as a table of one binary value per shard (so
commits, retries and any file system are Spark's business); ``file`` can be
copied out as it is. A shard's place in the whole is its task's total before
it plus the totals of the tasks before, one row per task.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import lots, small_batches, staged, text_of

SHARD_TOKENS = 1 << 20
MAGIC = b"WVM1"
SUPERBLOCK = 512  # bits between stored rank counts
END_ID = 1
WORDS = 1_000_000  # a worker remembers one or two times as many words
LONG = 100  # bytes; longer words are not remembered
# Fixed value: the pre-tokenizer pattern of the word-level vocabulary.
WORD_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# The same pattern where all characters are ASCII letters in lower case, digits and signs.
ASCII_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
LATIN = regex.compile(r"[!-@\[-~\u00C0-\u024F]*")  # letters whose case and class every Unicode version shares


def _kind(levels: int) -> type:
    return np.uint16 if levels <= 16 else np.uint32


class WaveletMatrix:
    """Succinct sequence of small integers.

    ``planes[l]``: packed bits of level l (top bit first) in that level's
    order, in which the zeros of level l - 1 come first, then its ones.
    """

    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.planes, self.ranks = n, planes, ranks
        self.zeros = [n - int(r[-1]) for r in ranks]

    @staticmethod
    def build(values: np.ndarray, levels: int | None = None) -> "WaveletMatrix":
        levels = levels or max(1, int(np.max(values, initial=0)).bit_length())
        v = np.asarray(values).astype(_kind(levels))
        planes, ranks = [], []
        for l in range(levels):
            bit = (v & v.dtype.type(1 << (levels - 1 - l))) != 0
            plane = np.zeros(-(-len(v) // SUPERBLOCK) * SUPERBLOCK // 8, np.uint8)
            plane[:-(-len(v) // 8)] = np.packbits(bit)
            per = np.bitwise_count(plane).reshape(-1, SUPERBLOCK // 8).sum(axis=1, dtype=np.uint32)
            planes.append(plane)
            ranks.append(np.concatenate(([0], np.cumsum(per, dtype=np.uint32))).astype(np.uint32))
            v = np.concatenate([np.compress(~bit, v), np.compress(bit, v)])
        return WaveletMatrix(len(v), planes, ranks)

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.n).view(bool)

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each position: the superblock's count and a popcount inside it."""
        plane, block = self.planes[level], at // SUPERBLOCK
        out = self.ranks[level][block].astype(np.int64)
        inside = np.nonzero(at % SUPERBLOCK)[0]
        if len(inside):
            size = SUPERBLOCK // 8
            own = plane.reshape(-1, size)[block[inside]]
            rest = (at[inside] % SUPERBLOCK)[:, None] - np.arange(0, SUPERBLOCK, 8)[None, :]
            mask = (0xFF00 >> np.clip(rest, 0, 8) & 0xFF).astype(np.uint8)
            out[inside] += np.bitwise_count(own & mask).sum(axis=1, dtype=np.int64)
        return out

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return self.planes[level][at // 8] >> (7 - at % 8).astype(np.uint8) & 1

    def access(self, at) -> np.ndarray:
        """The values at positions ``at``."""
        at = np.asarray(at, np.int64).copy()
        out = np.zeros(len(at), np.uint32)
        for l in range(len(self.planes)):
            bit, ones = self._bit(l, at), self._ones(l, at)
            out = out << np.uint32(1) | bit
            at = np.where(bit == 1, self.zeros[l] + ones, at - ones)
        return out

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        """``value``'s places in [lo, hi) as a range of the order below the last level."""
        if value >> len(self.planes):
            return 0, 0
        ends = np.array([lo, hi])
        for l in range(len(self.planes)):
            ones = self._ones(l, ends)
            ends = self.zeros[l] + ones if value >> (len(self.planes) - 1 - l) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``value`` in [lo, hi)."""
        a, b = self._range(value, lo, self.n if hi is None else hi)
        return b - a

    def select(self, value: int, k: int) -> int:
        """Position of the k-th occurrence of ``value`` (from 0), -1 if there is none."""
        a, b = self._range(value, 0, self.n)
        if not 0 <= k < b - a:
            return -1
        at = a + k
        for l in reversed(range(len(self.planes))):
            one = value >> (len(self.planes) - 1 - l) & 1
            nth = at - self.zeros[l] if one else at  # the nth one (zero) of this level
            counts = self.ranks[l].astype(np.int64)
            if not one:
                counts = np.arange(len(counts)) * SUPERBLOCK - counts
            block = int(np.searchsorted(counts, nth, "right")) - 1
            size = SUPERBLOCK // 8
            bits = np.unpackbits(self.planes[l][block * size:(block + 1) * size])
            at = block * SUPERBLOCK + int(np.nonzero(bits == one)[0][nth - int(counts[block])])
        return at

    def values(self) -> np.ndarray:
        """All values: the levels are undone from the bottom, each by one merge."""
        v = np.zeros(self.n, _kind(len(self.planes)))
        for l in reversed(range(len(self.planes))):
            bit = self._bits(l)
            v[self.zeros[l]:] |= v.dtype.type(1 << (len(self.planes) - 1 - l))
            up = np.empty_like(v)
            up[~bit] = v[:self.zeros[l]]
            up[bit] = v[self.zeros[l]:]
            v = up
        return v.astype(np.uint32)


def write_shard(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A shard file: magic, counts, then one zstd frame of index, planes and ranks."""
    w = WaveletMatrix.build(ids)
    body = b"".join([np.asarray(doc_ids, "<i8").tobytes(), np.asarray(lengths, "<i8").tobytes(),
                     *[p.tobytes() for p in w.planes], *[r.astype("<u4").tobytes() for r in w.ranks]])
    head = MAGIC + struct.pack("<qqi", len(doc_ids), len(ids), len(w.planes))
    return head + zstandard.ZstdCompressor(level=1).compress(body)


def read_shard(file: bytes) -> tuple[np.ndarray, np.ndarray, WaveletMatrix]:
    """Document ids, lengths and the wavelet matrix of a shard file."""
    if file[:4] != MAGIC:
        raise ValueError("not a token shard")
    docs, n, levels = struct.unpack("<qqi", file[4:24])
    body = memoryview(zstandard.ZstdDecompressor().decompress(file[24:]))
    at = 0

    def take(count: int, kind: str) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    blocks = -(-n // SUPERBLOCK)
    doc_ids, lengths = take(docs, "<i8"), take(docs, "<i8")
    planes = [take(blocks * SUPERBLOCK // 8, "u1") for _ in range(levels)]
    ranks = [take(blocks + 1, "<u4") for _ in range(levels)]
    return doc_ids, lengths, WaveletMatrix(n, planes, ranks)


class WordEncoder:
    """Ids by the ``tokenizers`` library, a batch's new words at a time.

    The vocabulary's pieces never hold white space, so a text's ids are its
    words' ids in a row; a word is encoded when it is first met. Words of Latin
    letters are cut by the vocabulary's own pattern; the pieces that are new
    go through the library's model in one call, spelled in its letters and
    apart by blanks. All other words go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.code = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.kind = np.dtype(f"<u{array(self.code).itemsize}")
        self.plain = Tokenizer(self.library.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.spelling = {b: c for c, b in byte_letters().items() if b != 0x20}
        suffix = self.library.model.end_of_word_suffix
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.is_last = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a piece
        self.is_last[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.words: dict[bytes, bytes] = {}  # pieces are words too
        self.old_words: dict[bytes, bytes] = {}
        self.long: set[bytes] = set()

    def _learn_pieces(self, new: list[bytes]) -> None:
        if not new:
            return
        spelled = b" ".join(new).decode("latin-1").translate(self.spelling)
        ids = np.array(self.plain.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, self.kind)
        ends = (np.nonzero(self.is_last[ids])[0] + 1) * self.kind.itemsize
        raw, at = ids.tobytes(), 0
        for piece, end in zip(new, ends.tolist()):
            self.words[piece] = raw[at:end]
            at = end
        self.long.update(p for p in new if len(p) > LONG)

    def _learn(self, words: set[bytes]) -> None:
        """Ids of words that are not remembered."""
        known = self.words
        letters = [w for w in words if w.isalpha() and w.islower()]  # of ASCII; they are one piece each
        cut, accented, whole = [], [], []
        for word in words.difference(letters):
            text = word.decode("utf-8")
            if b"<|" in word or not LATIN.fullmatch(text):
                whole.append(word)
            elif text.isascii():
                cut.append(ASCII_PIECES.findall(word))
            else:
                accented.append(word)
        mixed = [b"".join(pieces) for pieces in cut] + accented
        if accented:  # a blank keeps words apart, whatever is done to their letters
            normal = self.library.normalizer.normalize_str(b" ".join(accented).decode("utf-8")).split(" ")
            cut += [[p.encode() for p in WORD_PIECES.findall(t)] for t in normal]
        self._learn_pieces(letters + list({p for pieces in cut for p in pieces}.difference(letters, known.keys())))
        for word, pieces in zip(mixed, cut):
            known[word] = b"".join([known[p] for p in pieces])
        for word in whole:
            ids = self.library.encode(word.decode("utf-8"), add_special_tokens=False).ids
            known[word] = array(self.code, ids).tobytes()
        self.long.update(w for w in words if len(w) > LONG)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (UTF-8 strings) as little-endian integers of ``kind``.

        Arrow cuts the texts and numbers their words, so Python sees each
        distinct word of the batch once.
        """
        if len(self.words) > WORDS:
            self.old_words, self.words = self.words, {}
        texts = texts.cast(pa.large_string())
        # the vocabulary is of lower case; special tokens are not
        if pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        else:
            texts = pc.ascii_lower(texts)
        split = pc.ascii_split_whitespace(texts)
        numbered = split.flatten().dictionary_encode()
        distinct = numbered.dictionary.cast(pa.large_binary()).to_pylist()
        new = set(distinct) - self.words.keys()
        again = new & self.old_words.keys()
        self.words.update((w, self.old_words[w]) for w in again)
        self._learn(new - again)
        ids = pa.array([*map(self.words.__getitem__, distinct)], pa.large_binary()).take(numbered.indices)
        if not len(ids):
            return [b""] * len(texts)
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, np.int64)[ids.offset:][np.asarray(split.offsets) - split.offsets[0].as_py()].tolist()
        data = memoryview(data) if data is not None else b""
        for w in self.long:
            del self.words[w]
        self.long.clear()
        return [bytes(data[low:high]) for low, high in zip(at[:-1], at[1:])]


@lru_cache(maxsize=2)
def load(path: str) -> WordEncoder:
    return WordEncoder(path)


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        end = array(encoder.code, [end_id]).tobytes()
        for batch in lots(batches):
            ids = [i + end for i in encoder.encode(batch.column("text"))]
            width = pa.array([encoder.kind.itemsize] * len(ids), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), width, pa.array(ids, pa.binary())],
                                             ["id", "width", "ids"])

    return run


def _pack(shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, base, docs, texts, size = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def shard():
            lengths = np.array([len(t) // width for t in texts], np.int64)
            file = write_shard(np.array(docs, np.int64), lengths, np.frombuffer(b"".join(texts), f"<u{width}"))
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "base": pa.array([base], pa.int64()),
                 "n_docs": pa.array([len(docs)], pa.int64()), "n_tokens": pa.array([size // width], pa.int64()),
                 "file": pa.array([file], pa.binary())})

        for batch in batches:
            width = batch.column("width")[0].as_py() if len(batch) else 4
            for doc, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                docs.append(NO_ID if doc is None else doc)
                texts.append(ids)
                size += len(ids)
                if size >= shard_tokens * width:
                    yield shard()
                    seq, base, docs, texts, size = seq + 1, base + size // width, [], [], 0
        if docs:
            yield shard()

    return run


NO_ID = -(1 << 63)  # stands for a NULL document id in a file
SHARD_SCHEMA = "part int, seq int, base bigint, n_docs bigint, n_tokens bigint, file binary"


def write_tokens(docs: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS, end_id: int = END_ID,
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Encode every whole text, add ``end_id`` and write the shard files in order of id.

    Returns the table of shards as written to the shared folder. A NULL or
    empty text has the end id only; a NULL id comes first; rows of one id are
    ordered by their ids. An empty table gives no shards.
    """
    slim = small_batches(docs).select(F.col(doc_id).cast("bigint").alias("id"), text_of(text).alias("text"))
    ids = staged(slim.mapInArrow(_encode(path, end_id), "id bigint, width int, ids binary"), "token-ids")
    ordered = ids.repartitionByRange("id").sortWithinPartitions("id", "ids")
    return staged(ordered.mapInArrow(_pack(shard_tokens), SHARD_SCHEMA), "token-shards")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, file in zip(batch.column("base").to_pylist(), batch.column("file").to_pylist()):
            docs, lengths, w = read_shard(file)
            raw = w.values().astype("<u4").tobytes()
            ends = np.concatenate(([0], np.cumsum(lengths)))
            ids = [raw[4 * a:4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, mask=docs == NO_ID), pa.array(base + ends[:-1]), pa.array(lengths), pa.array(ids, pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"])


def read_tokens(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, from the shard files.

    ``ids`` are little-endian unsigned 32-bit integers, ``start`` counts the
    ids of all documents before.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row per writing task
    # written, so that its size is known and the files need not be shuffled to meet it
    parts = staged(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "token-parts")
    placed = shards.join(parts, "part").select((F.col("base") + F.col("before")).alias("base"), "file")
    return placed.mapInArrow(_unpack, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
