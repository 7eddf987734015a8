"""Suffix-array dedup of byte passages repeated across documents.

Every ``WINDOW``-byte string is sent to the place of its minimizer, the
smallest hash of its ``GRAM``-byte substrings: equal strings have the same one
and meet, whatever document they stand in. Neighbouring strings with the same
minimizer travel as one segment, first as a hash only:

1. Segments that are equal as a whole need no suffix array: all but those of
   the smallest document are covered. This is combined in lots of segments
   before the shuffle, so a passage that is everywhere sends one row a lot.
   The segments meet in buckets, as many as the bytes of the texts ask for.
2. Segments of one minimizer that differ, in different documents, are fetched
   in shards bounded by segments and by bytes. What surrounds the minimizer in
   them tells windows that can stand in one document only; the rest is sorted:
   a suffix array by induced sorting, permuted common prefixes, and the smallest
   document of every run of suffixes that share ``WINDOW`` bytes.
3. A minimizer with more segments than a shard holds is cut into single
   windows. Equal ones (by their bytes) collapse to their smallest document,
   per batch and then before the shuffle, and that document is joined back to
   the windows left: no group grows with the documents of a window. Windows
   that differ share no ``WINDOW`` bytes, so nothing is left to sort.

The covered spans go back to their documents, which are cut once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, small_batches, staged, text_of, utf8
from .suffixes import common_prefixes, suffix_array

WINDOW = 50
GRAM = 24  # longer: more segments, fewer that share a minimizer by chance
BATCH_BYTES = 1 << 20
HASH_BLOCK = 1 << 15  # places hashed at once, they stay in the processor's cache
LOT_SEGMENTS = 400_000  # combined at once before the shuffle, whatever the batches
BUCKETS_PER_PARTITION = 4
BUCKET_BYTES = 8 << 20  # of segments, on average
SHARD_SEGMENTS = 12_000
SHARD_BYTES = 1 << 19  # of segments, on average
TASKS_PER_PARTITION = 10
CONTEXTS = 4  # parts of the places a minimizer can have in a window
LAST_ID = (1 << 63) - 1  # a document without an id comes after all others
COVER, CANDIDATE = 0, 1
ODD = np.uint64(0x9E3779B97F4A7C15)
HIGH, LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
PART = np.dtype([("mh", "<u8"), ("sh", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("n", "<i4")])


def gram_hashes(data: bytes, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` (at least 8) bytes from each position."""
    n = len(data) - 7
    words = np.empty(n, np.uint64)
    for o in range(8):
        part = np.frombuffer(data, "<u8", (len(data) - o) // 8, o)
        words[o::8] = part[:len(words[o::8])]
    size = len(data) - gram + 1
    out = np.zeros(size, np.uint64)
    for at in range(0, size, HASH_BLOCK):
        h = out[at:at + HASH_BLOCK]
        for o in [*range(0, gram - 8, 8), gram - 8]:  # eight bytes at a time, the last ones from the end
            h += words[at + o:at + o + len(h)]
            h *= ODD
            h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return out


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    m, size = h, 1
    while size * 2 <= width:
        m, size = np.minimum(m[:-size], m[size:]), size * 2
    rest = width - size
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def segments(texts: list[bytes], docs: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Segments of the texts: runs of windows of one text that share their minimizer."""
    data = b"".join(texts)
    if len(data) < window:
        return np.zeros(0, PART)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    h = gram_hashes(data, gram)
    least = sliding_min(h, window - gram + 1)
    new = np.ones(len(least) + 1, bool)
    np.not_equal(least[1:], least[:-1], out=new[1:-1])
    # a text's first window, and the first that runs over its end
    for edge in (ends - sizes, np.maximum(ends - window + 1, ends - sizes)):
        new[edge[edge < len(new)]] = True
    bounds = np.nonzero(new)[0]
    first, n = bounds[:-1], np.diff(bounds)
    owner = np.searchsorted(ends, first, "right")
    keep = first + window <= ends[owner]
    first, n, owner = first[keep], n[keep], owner[keep]
    out = np.empty(len(first), PART)
    out["mh"] = least[first]
    out["sh"] = span_hashes(h, first, n + window - 1, gram)
    out["doc"] = docs[owner]
    out["start"] = first - (ends - sizes)[owner]
    out["n"] = n
    return out


def span_hashes(h: np.ndarray, first: np.ndarray, size: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``size`` (at least ``gram``) bytes from each place, out of the hashes of their grams."""
    if not len(first):
        return np.zeros(0, np.uint64)
    count = size // gram  # side by side from the start, and one that ends with the span
    at = np.cumsum(count) - count
    k = np.arange(count.sum()) - np.repeat(at, count)
    powers = np.multiply.accumulate(np.full(int(count.max()), ODD))
    out = np.add.reduceat(h[np.repeat(first, count) + k * gram] * powers[k], at)
    out += h[first + size - gram]
    out ^= out >> np.uint64(32)
    out += size.astype(np.uint64)
    out *= ODD
    return out


def covered_by_equal(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the segments, equal ones side by side; which are not of the smallest document of those equal to them."""
    key = (p["mh"] * ODD & HIGH) | (p["sh"] & LOW)
    by = np.argsort(key)
    key, p = key[by], p[by]
    new = np.ones(len(p), bool)
    new[1:] = (p["sh"][1:] != p["sh"][:-1]) | (p["mh"][1:] != p["mh"][:-1])
    if (new[1:] & (key[1:] == key[:-1])).any():  # one key, different segments: equal ones may be apart
        p = p[np.lexsort((p["sh"], p["mh"], p["mh"] * ODD & HIGH))]
        new[1:] = (p["sh"][1:] != p["sh"][:-1]) | (p["mh"][1:] != p["mh"][:-1])
    at = np.nonzero(new)[0]
    if not len(at):
        return p, np.zeros(0, bool)
    first = np.repeat(np.minimum.reduceat(p["doc"], at), np.diff(np.append(at, len(p))))
    return p, p["doc"] > first


def bucket_of(mh: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of minimizers; they grow in the order of ``covered_by_equal``."""
    return (mh * ODD >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def joined(docs: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (doc, start, size) that overlap or touch become one."""
    if not len(docs):
        return docs, starts, sizes
    by = np.lexsort((starts, docs))
    docs, starts, ends = docs[by], starts[by].astype(np.int64), (starts[by] + sizes[by]).astype(np.int64)
    new = np.ones(len(docs), bool)
    new[1:] = docs[1:] != docs[:-1]
    offset = np.cumsum(new) << 32  # keeps the documents' ends apart
    reach = np.maximum.accumulate(ends + offset)
    new[1:] |= starts[1:] + offset[1:] > reach[:-1]
    at = np.nonzero(new)[0]
    return docs[at], starts[at], np.append(reach[at[1:] - 1], reach[-1]) - offset[at] - starts[at]


def _text_lots(batches: Iterator[pa.RecordBatch]):
    """The texts and their documents in lots of about BATCH_BYTES."""
    lot, ids, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column("doc").to_pylist(), utf8(batch.column("text"))):
            lot.append(t)
            ids.append(i)
            size += len(t)
            if size >= BATCH_BYTES:
                yield lot, np.array(ids, np.int64)
                lot, ids, size = [], [], 0
    if lot:
        yield lot, np.array(ids, np.int64)


def _parts(buckets: int, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for texts, docs in _text_lots(batches):
            held.append(segments(texts, docs, window, gram))
            size += len(held[-1])
            if size >= LOT_SEGMENTS:
                yield from sent(held, int(docs[0]))
                held, size = [], 0
        if size:
            yield from sent(held, int(docs[0]))

    def sent(held: list[np.ndarray], any_doc: int) -> Iterator[pa.RecordBatch]:
        p, covered = covered_by_equal(np.concatenate(held))
        held.clear()
        # the lot's own covers ride along in any bucket, neighbours as one
        doc, start, size = joined(p["doc"][covered], p["start"][covered], p["n"][covered] + window - 1)
        covers = np.zeros(len(doc), PART)
        covers["doc"], covers["start"], covers["n"] = doc, start, size - window + 1
        yield _rows([hash(any_doc) % buckets], [COVER], [covers])
        p = p[~covered]
        bucket = bucket_of(p["mh"], buckets)
        at = np.nonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))[0] if len(p) else []
        yield _rows([int(bucket[a]) for a in at], [CANDIDATE] * len(at),
                    [p[a:b] for a, b in zip(at, [*at[1:], len(p)])])

    return run


def _rows(bucket: list[int], kind: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
    """Segments column by column, as bytes (they compress better so)."""
    body = [b"".join(np.ascontiguousarray(p[c]).tobytes() for c in PART.names) for p in parts]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(body, pa.binary())],
        ["bucket", "kind", "body"])


def _unpack(bodies: list[pa.Scalar]) -> np.ndarray:
    """The segments of all the bodies."""
    buffers = [b.as_buffer() for b in bodies]
    out, at = np.empty(sum(b.size for b in buffers) // PART.itemsize, PART), 0
    for b in buffers:
        n, offset = b.size // PART.itemsize, 0
        for c in PART.names:
            out[c][at:at + n] = np.frombuffer(b, PART[c], n, offset)
            offset += n * PART[c].itemsize
        at += n
    return out


FOUND = "kind int, mh bigint, doc bigint, start int, n int"


def _meet(table: pa.Table) -> pa.Table:
    """Covers among equal segments, and segments whose minimizer has others in other documents."""
    kinds, bodies = table.column("kind").to_pylist(), table.column("body")
    covers = _unpack([b for k, b in zip(kinds, bodies) if k == COVER])
    p, covered = covered_by_equal(_unpack([b for k, b in zip(kinds, bodies) if k == CANDIDATE]))
    c = np.concatenate([covers, p[covered]])
    p = p[~covered]
    if len(p):
        p = p[np.argsort(p["mh"])]
        at = np.nonzero(np.concatenate(([True], p["mh"][1:] != p["mh"][:-1])))[0]
        size = np.diff(np.append(at, len(p)))
        several = np.minimum.reduceat(p["doc"], at) != np.maximum.reduceat(p["doc"], at)
        p = p[np.repeat(several, size)]
    both = np.concatenate([c, p])
    kind = np.repeat(np.array([COVER, CANDIDATE], np.int32), [len(c), len(p)])
    return pa.table({"kind": kind, "mh": both["mh"].astype(np.int64), "doc": both["doc"], "start": both["start"], "n": both["n"]})


def _listed(column: pa.ListArray, names: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The row of every struct in the column's lists, and the structs' fields."""
    count = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), count), [flat.field(c).to_numpy(zero_copy_only=False) for c in names]


def _fetch(window: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, (mh, start, n) = _listed(batch.column("wanted"), ["mh", "start", "n"])
            shard = (mh.astype(np.uint64) * ODD >> np.uint64(20)) % np.uint64(shards)
            texts = utf8(batch.column("text"))
            body = [texts[i][a:b] for i, a, b in zip(row.tolist(), start.tolist(), (start + n + window - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.astype(np.int64)), pa.array(batch.column("doc").to_numpy()[row]), pa.array(start, pa.int32()),
                 pa.array(body, pa.binary())], ["shard", "doc", "start", "body"])

    return run


def _collapse(window: int):
    """The batch's smallest document of each distinct window; other windows are covered (NULL)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least: dict[bytes, tuple[int, list[int]]] = {}
            covered: dict[int, list[int]] = {}
            for i, text, wanted in zip(batch.column("doc").to_pylist(), utf8(batch.column("text")),
                                       batch.column("wanted").to_pylist()):
                for at in (w["start"] + k for w in wanted for k in range(w["n"])):
                    piece = text[at:at + window]
                    first, starts = least.setdefault(piece, (i, []))
                    if i == first:
                        starts.append(at)
                    elif i > first:
                        covered.setdefault(i, []).append(at)
                    else:
                        covered.setdefault(first, []).extend(starts)
                        least[piece] = i, [at]
            docs, starts = zip(*least.values(), *covered.items()) if least else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*least, *[None] * len(covered)], pa.binary()), pa.array(docs, pa.int64()),
                 pa.array(starts, pa.list_(pa.int32()))], ["piece", "doc", "starts"])

    return run


def shard_covers(docs: np.ndarray, starts: np.ndarray, bodies: list[bytes], window: int = WINDOW):
    """Spans (doc, start, length) of windows that also start in a smaller document of the shard."""
    sizes = np.array([len(b) for b in bodies])
    text = np.frombuffer(b"".join(bodies), np.uint8).astype(np.int32) + 2
    ends = np.cumsum(sizes)
    s = np.zeros(len(text) + len(bodies) + 1, np.int32)  # every segment ends with 1, all with 0
    owner = np.repeat(np.arange(len(bodies)), sizes)
    place = np.arange(len(text)) + owner
    s[place] = text
    s[ends + np.arange(len(bodies))] = 1
    sa = suffix_array(s)
    shared = common_prefixes(s, sa, window)
    row = np.full(len(s), -1)
    row[place] = owner
    left = np.zeros(len(s), np.int64)
    left[place] = (ends[owner] - np.arange(len(text)))
    run = np.cumsum(shared[sa] < window) - 1
    doc = np.where((row[sa] >= 0) & (left[sa] >= window), docs[row[sa]], LAST_ID)
    least = np.minimum.reduceat(doc, np.nonzero(shared[sa] < window)[0])
    hit = np.zeros(len(s) + 1, bool)
    hit[sa] = (left[sa] >= window) & (doc > least[run])
    edges = np.diff(np.concatenate(([0], hit.astype(np.int8))))
    a, b = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
    owner = row[a]
    first = ends - sizes + np.arange(len(bodies))
    return docs[owner], starts[owner] + a - first[owner], b - a + window - 1


def narrowed(docs: np.ndarray, starts: np.ndarray, bodies: list[bytes], window: int = WINDOW,
             gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The segments, without windows whose minimizer has other surroundings in all other documents.

    A window's minimizer stands in one of ``CONTEXTS`` parts of its places, so
    the window holds all bytes that the windows of that part have in common.
    Windows of two documents can be equal only if those bytes are (by the
    hashes of their grams). What stays of a segment is one piece.
    """
    sizes = np.array([len(b) for b in bodies])
    if (sizes < window).any():  # other texts of the same id may be shorter
        long = np.nonzero(sizes >= window)[0]
        docs, starts, bodies, sizes = docs[long], starts[long], [bodies[i] for i in long.tolist()], sizes[long]
    if not bodies:
        return docs, starts, bodies
    ends = np.cumsum(sizes)
    first = ends - sizes
    h = gram_hashes(b"".join(bodies), gram)
    least = np.minimum.reduceat(h, np.column_stack((first, ends - gram + 1)).ravel()[:-1])[::2]
    at = np.nonzero(h == np.repeat(least, sizes)[:len(h)])[0]
    owner = np.searchsorted(ends, at, "right")
    inside = at + gram <= ends[owner]
    at, owner = at[inside], owner[inside]
    low, high = ends.copy(), first - 1
    places = np.linspace(0, window - gram + 1, CONTEXTS + 1).astype(int).tolist()
    for lo, hi in zip(places, [p - 1 for p in places[1:]]):
        right = window - gram - hi
        whole = (at - lo >= first[owner]) & (at + gram + right <= ends[owner])
        g, o = at[whole], owner[whole]
        if not len(g):
            continue
        key = ((least[o] * ODD ^ h[g - lo]) * ODD ^ h[g + right]) * ODD
        by = np.argsort(key)
        g, o, key = g[by], o[by], key[by]
        new = np.nonzero(np.append(True, key[1:] != key[:-1]))[0]
        several = np.minimum.reduceat(docs[o], new) != np.maximum.reduceat(docs[o], new)
        several = np.repeat(several, np.diff(np.append(new, len(key))))
        g, o = g[several], o[several]
        np.minimum.at(low, o, np.maximum(g - hi, first[o]))
        np.maximum.at(high, o, np.minimum(g - lo, ends[o] - window))
    keep = np.nonzero(low <= high)[0]
    a, b = (low - first)[keep], (high - first)[keep] + window
    return docs[keep], starts[keep] + a, [bodies[i][x:y] for i, x, y in zip(keep.tolist(), a.tolist(), b.tolist())]


def _narrow(window: int, gram: int, then):
    """``then`` on what is left of a shard."""
    def run(table: pa.Table) -> pa.Table:
        docs, starts, bodies = narrowed(table.column("doc").to_numpy(), table.column("start").to_numpy(),
                                        table.column("body").to_pylist(), window, gram)
        if not bodies:
            return pa.schema([("doc", pa.int64()), ("start", pa.int32()), ("size", pa.int32())]).empty_table()
        return then(pa.table({"doc": docs, "start": starts.astype(np.int32), "body": pa.array(bodies, pa.binary())}))

    return run


def _sort_shard(window: int):
    def run(table: pa.Table) -> pa.Table:
        doc, start, n = joined(*shard_covers(table.column("doc").to_numpy(), table.column("start").to_numpy(),
                                             table.column("body").to_pylist(), window))
        return pa.table({"doc": doc, "start": start.astype(np.int32), "size": n.astype(np.int32)})

    return run


def merged(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Maximal runs of the spans (start, end), within ``size``."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        b = min(b, size)
        if a >= b:
            continue
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column("text"))
        sizes = np.array([len(t) for t in texts], np.int64)
        owner, (starts, lengths) = _listed(batch.column("spans"), ["start", "size"])
        owner, starts, lengths = joined(owner, starts.astype(np.int64), lengths.astype(np.int64))
        ends = np.minimum(starts + lengths, sizes[owner])
        there = starts < ends
        owner, starts, ends = owner[there], starts[there], ends[there]
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        kept, cuts, at = [], list(zip(starts.tolist(), ends.tolist())), bounds.tolist()
        for text, i, j in zip(texts, at, at[1:]):
            done, rest = 0, []
            for a, b in cuts[i:j]:
                rest.append(text[done:a])
                done = b
            kept.append(b"".join(rest) + text[done:] if rest else text)
        spans = pa.ListArray.from_arrays(
            pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(starts), pa.array(ends)], ["start", "end"]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(sizes), spans, pa.array(kept, pa.binary())],
            ["row", "n_bytes", "spans", "kept"])


def repeat_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text",
                 doc_id: str = "doc_id") -> DataFrame:
    """``doc, start, size``: spans of bytes inside windows that also start in a smaller document.

    Spans may overlap. ``doc`` is the id, ``LAST_ID`` for NULL.
    """
    spark = docs.sparkSession
    slim = small_batches(docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST_ID)).alias("doc"), text_of(text).alias("text")))
    n_bytes = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # two in (width + 1) places begin a segment on average
    segment_bytes = PART.itemsize * 2 * n_bytes // (window - gram + 2)
    buckets = max(BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-segment_bytes // BUCKET_BYTES))
    parts = slim.mapInArrow(_parts(buckets, window, gram), "bucket int, kind int, body binary")
    found = staged(parts.groupBy("bucket").applyInArrow(_meet, FOUND), "repeat-segments")
    covers = found.filter(F.col("kind") == COVER).select("doc", "start", (F.col("n") + window - 1).alias("size"))
    asked = found.filter(F.col("kind") == CANDIDATE).select("doc", "mh", "start", "n")
    per = asked.groupBy("mh").agg(F.count("*").alias("c")).filter(F.col("c") > SHARD_SEGMENTS)
    large = staged(per.select("mh", F.lit(True).alias("large")), "repeat-large")
    asked = asked.join(large, "mh", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    size = F.when(~F.col("large"), F.col("n") + window - 1)
    n = asked.agg(F.count(size).alias("small"), F.count_if("large").alias("large"), F.sum(size).alias("bytes")).first()
    shards = max(1, -(-n["small"] * 2 // SHARD_SEGMENTS), -(-(n["bytes"] or 0) // SHARD_BYTES))
    fetched = _with_wanted(slim, asked.filter(~F.col("large"))).mapInArrow(
        _fetch(window, shards), "shard bigint, doc bigint, start int, body binary")
    # by number: AQE would join shards by their bytes, which tell little of the work in them
    tasks = min(shards, TASKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    sorted_ = fetched.repartition(tasks, "shard").groupBy("shard").applyInArrow(
        _narrow(window, gram, _sort_shard(window)), "doc bigint, start int, size int")
    covers = covers.unionAll(sorted_)
    if n["large"]:
        covers = covers.unionAll(_large_covers(_with_wanted(slim, asked.filter("large")), window))
    return staged(covers, "repeat-spans")


def _with_wanted(slim: DataFrame, asked: DataFrame) -> DataFrame:
    wanted = asked.groupBy("doc").agg(F.collect_list(F.struct("mh", "start", "n")).alias("wanted"))
    return slim.join(wanted, "doc")


def _large_covers(asked: DataFrame, window: int) -> DataFrame:
    """``doc, start, size`` of the windows asked for that also start in a smaller document."""
    found = staged(asked.mapInArrow(_collapse(window), "piece binary, doc bigint, starts array<int>"), "repeat-windows")
    least = found.filter("piece IS NOT NULL").groupBy("piece").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    # written, so that its size is known: a join on a hot window is broadcast or split
    least = staged(least.filter("least < most").select("piece", "least"), "repeat-least")
    met = found.join(least, "piece").filter(F.col("doc") > F.col("least")).select("doc", "starts")
    met = met.unionAll(found.filter("piece IS NULL").select("doc", "starts"))
    return met.select("doc", F.explode("starts").alias("start"), F.lit(window).alias("size"))


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text",
                 doc_id: str = "doc_id") -> DataFrame:
    """``row, n_bytes, spans, kept``: the removed runs (start, end) and the bytes that stay.

    A NULL text is empty. A NULL id comes after all others and is smaller than
    none. Rows that share an id are taken for copies of one document: they
    never remove from each other, and if their texts differ, a span found in
    one is removed from all. ``kept`` may cut a character. An empty table
    gives no rows.
    """
    spans = repeat_spans(docs, window, gram, text, doc_id)
    per_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST_ID)).alias("key")
    whole = packed(docs, key, text_of(text).alias("text"))
    met = whole.join(per_doc, whole["key"] == per_doc["doc"], "left").select("row", "text", "spans")
    kind = met.schema["row"].dataType.simpleString()
    return met.mapInArrow(
        _cut, f"row {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")

