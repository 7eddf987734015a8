"""SimHash near-dedup by bit-sliced comparison.

Fingerprints are 64-bit majority votes over XXH64 hashes of word shingles.
Equal fingerprints are joined first (map-side combine). Different ones are
compared inside buckets: the 64 bits are cut into five bands, and two
fingerprints that differ in at most three bits agree on two whole bands at
least, so the ten tables keyed by two bands each miss no link. A bucket over
``BLOCK_ROWS`` is cut into blocks, and every pair of its blocks meets.

Inside a bucket the fingerprints are stored as vertical bit planes; distances
to many rows grow together in carry-save bit counters, and a block is left as
soon as all its distances exceed the radius. A bucket returns a spanning
forest of its links (no more edges than rows), never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_of, utf8
from .components import components, local_labels

SHINGLE = 3
RADIUS = 3
SEED = 42
BLOCK_ROWS = 8192
SHORT_RUN = 32


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a UTF-8 text (no words: 0)."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) > shingle:
        whole, digest = b" ".join(words), xxhash.xxh64_intdigest
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        stops = (ends[shingle - 1:] - 1).tolist()
        hashes = [digest(whole[s:e], seed) for s, e in zip(starts, stops)]
    else:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int.from_bytes(np.packbits(votes, bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in utf8(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(fps.view(np.int64))], ["id", "text_hash", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED,
                 text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``id, text_hash, fp`` (the 64 bits as a signed bigint) of every row."""
    kind = docs.schema[doc_id].dataType.simpleString()
    whole = text_of(text)
    slim = docs.select(F.col(doc_id).alias("id"), whole.alias("text"), F.xxhash64(whole).alias("text_hash"))
    return slim.mapInArrow(_fingerprints(shingle, seed), f"id {kind}, text_hash bigint, fp bigint")


def bit_planes(x: np.ndarray) -> np.ndarray:
    """``x`` (uint64) as 64 planes of packed row bits: ``[bit, byte]``."""
    bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(bits.T, axis=1)
    pad = -planes.shape[1] % 8
    return np.ascontiguousarray(np.pad(planes, ((0, 0), (0, pad))))


def near_rows(planes: np.ndarray, queries: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """``[query, row]``: rows within ``radius`` bits of each query.

    ``planes`` come from ``bit_planes``. ``counters[k]`` holds bit k of every
    distance; a carry out of the last sets ``over`` for good.
    """
    words = planes.view(np.uint64)
    width = max(1, radius.bit_length())
    counters = np.zeros((width, len(queries), words.shape[1]), np.uint64)
    over = np.zeros_like(counters[0])
    ones = ~np.uint64(0)
    for bit in range(64):
        flip = np.where((queries >> np.uint64(bit)) & np.uint64(1), ones, np.uint64(0))[:, None]
        carry = words[bit] ^ flip
        for c in counters:
            c ^= carry  # the sum bit; the carry is where it fell back to 0
            carry &= ~c
        over |= carry
        if bit % 8 == 7 and (over == ones).all():
            break
    # distance > radius, from the top counter bit down
    equal, greater = np.full_like(over, ones), np.zeros_like(over)
    for k in reversed(range(width)):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            greater |= equal & counters[k]
            equal &= ~counters[k]
    far = over | greater
    return ~np.unpackbits(far.view(np.uint8), axis=1).astype(bool)


def bucket_forest(x: np.ndarray, left: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links of ``x``: row labels, as (row, label) pairs.

    ``left`` rows come from one block and the rest from another; 0: one block.
    """
    n = len(x)
    rows, queries = (x[left:], np.arange(left)) if left else (x, np.arange(n))
    planes, lab = bit_planes(rows), np.arange(n)
    step = max(1, (1 << 21) // max(8, planes.shape[1]))
    for at in range(0, len(queries), step):
        q = queries[at:at + step]
        i, j = np.nonzero(near_rows(planes, x[q], radius)[:, :len(rows)])
        lab = local_labels(n, q[i], j + left, lab)
    away = np.nonzero(lab != np.arange(n))[0]
    return x[away], x[lab[away]]


def _run_edges(x: np.ndarray, run: np.ndarray, side: np.ndarray, radius: int):
    """Edges of sorted buckets: short ones by shifted rows, all at once; long ones as blocks."""
    starts = np.concatenate(([0], np.nonzero(run[1:] != run[:-1])[0] + 1, [len(x)]))
    lengths = np.diff(starts)
    per_row = np.repeat(lengths, lengths)
    short = np.nonzero((per_row > 1) & (per_row <= SHORT_RUN))[0]
    for d in range(1, SHORT_RUN):
        short = short[short + d < len(x)]
        short = short[run[short] == run[short + d]]
        if not len(short):
            break
        planes = bit_planes(x[short] ^ x[short + d])
        hit = short[near_rows(planes, np.zeros(1, np.uint64), radius)[0, :len(short)]]
        if len(hit):
            yield x[hit], x[hit + d]
    for k in np.nonzero(lengths > SHORT_RUN)[0]:
        own = slice(starts[k], starts[k + 1])
        left = int((side[own] == 0).sum())
        yield bucket_forest(x[own], 0 if left == lengths[k] else left, radius)


def _bucket_edges(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            part = [np.asarray(batch.column(c)) for c in ("run", "side", "fp")]
            if rest is not None:
                part = [np.concatenate(p) for p in zip(rest, part)]
            if not len(part[0]):
                continue
            cut = int(np.searchsorted(part[0], part[0][-1]))  # the last bucket may go on
            rest = [p[cut:] for p in part]
            yield from out([p[:cut] for p in part])
        if rest is not None:
            yield from out(rest)

    def out(part):
        if len(part[0]) < 2:
            return
        found = list(_run_edges(part[2].view(np.uint64), part[0], part[1], radius))
        if found:
            a, b = (np.concatenate(s).view(np.int64) for s in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def band_masks(radius: int) -> list[int]:
    """Masks of two whole bands out of ``radius + 2``: equal on one of them at least."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    bands = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(bands, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(distinct: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Forest edges ``a, b`` between different fingerprints within ``radius`` bits."""
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("m"))
                     for k, m in enumerate(band_masks(radius))])
    rows = distinct.select("fp", F.explode(keys).alias("key")).select("fp", "key.k", "key.m")
    large = (rows.groupBy("k", "m").agg(F.count("*").alias("n")).filter(F.col("n") > block_rows)
             .select("k", "m", F.ceil(F.col("n") / block_rows).cast("int").alias("nb")))
    large = staged(large, "simhash-large")
    met = rows.join(large, ["k", "m"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int")
    met = met.select("fp", "k", "m", "nb", F.when(F.col("nb").isNotNull(), own).otherwise(0).alias("g"))
    met = met.withColumn("o", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("nb"), F.lit(1)) - 1)))
    met = met.select("fp", F.xxhash64("k", "m", F.least("g", "o"), F.greatest("g", "o")).alias("run"),
                     (F.col("g") > F.col("o")).cast("int").alias("side"),
                     "k", "m", F.least("g", "o").alias("i"), F.greatest("g", "o").alias("j"))
    met = met.repartition("k", "m", "i", "j").sortWithinPartitions("run", "side", "fp")
    return met.select("run", "side", "fp").mapInArrow(_bucket_edges(radius), "a bigint, b bigint")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                   text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``id, text_hash, fp, component_id, kept`` of every row.

    ``component_id`` is the smallest id of the group of linked documents. Texts
    without words have fingerprint 0 and link like others. A NULL id comes last:
    it never names a group that has another id. ``kept`` marks the document that
    stays for its group, by id and XXH64 of its text (so that documents without
    ids are told apart); rows that repeat it are marked too. An empty table
    gives no rows.
    """
    fps = staged(fingerprints(docs, shingle, seed, text, doc_id), "simhash")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("text_hash")))
    distinct = staged(fps.groupBy("fp").agg(first.alias("first")), "simhash-distinct")
    labels = components(links(distinct, radius))
    named = distinct.join(labels, distinct["fp"] == labels["id"], "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label"))
    named = staged(named, "simhash-labels")
    smallest = staged(named.groupBy("label").agg(F.min("first").alias("stays")), "simhash-smallest")
    groups = staged(named.join(smallest, "label").select("fp", "stays"), "simhash-groups")
    kept = F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("text_hash") == F.col("stays.text_hash"))
    return fps.join(groups, "fp").select("id", "text_hash", "fp", F.col("stays.id").alias("component_id"), kept.alias("kept"))
