"""Line dedup: drop lines whose normalised form occurs in many documents.

Method: every line is normalised (ASCII white space stripped at both ends,
A-Z lower-cased) and hashed to 128 bits; a document's distinct hashes are
exploded, documents are counted per hash with a map-side combine, and the
lines of hashes at or over the threshold are dropped. A document is rebuilt
from its remaining lines in their old positions.

Only (row, hash) pairs are shuffled by hash; the frequent-hash join is a plain
join that AQE may split on a hot line. Texts are shuffled once, to meet their
own list of frequent hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, staged, text_of, utf8

MIN_DOCS = 10
MIN_CHARS = 1
SPACE = b" \t\n\x0b\x0c\r"


def _key(line: bytes, min_chars: int) -> bytes | None:
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or (min_chars > 1 and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, hashes = batch.column("id"), [], []
            for text in utf8(batch.column("text")):
                own = {_key(x, min_chars) for x in text.split(b"\n")} - {None}
                counts.append(len(own))
                hashes.extend(own)
            take = pa.array([i for i, n in enumerate(counts) for _ in range(n)], pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(take), pa.array(hashes, pa.binary())], ["id", "h"])

    return run


def _rebuild(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, drop in zip(utf8(batch.column("text")), batch.column("drop").to_pylist()):
                lines = text.split(b"\n")
                stay = lines
                if drop:
                    gone = set(drop)
                    stay = [x for x in lines if _key(x, min_chars) not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            out = [batch.column("row"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                   pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(out, ["row", "n_lines", "n_dropped", "kept_text"])

    return run


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
               text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows ``row`` (the input row), ``n_lines``, ``n_dropped``, ``kept_text``.

    Each input row counts as one document, also if its id is NULL or repeats.
    A NULL or empty text is one empty line; a line shorter than ``min_chars``
    code points after stripping is never dropped. An empty table gives no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text"))
    keys = staged(slim.mapInArrow(_hashes(min_chars), f"id {kind}, h binary"), "line-keys")
    # written, so that the join below is a plain one: small, or split where a line is hot
    frequent = staged(keys.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs).select("h"),
                      "frequent-lines")
    # a hash is dropped everywhere, so the lists of repeated ids may be merged
    drops = (keys.join(frequent, "h").groupBy("id").agg(F.collect_set("h").alias("drop")))
    whole = packed(docs, F.col(doc_id).alias("doc_key"), text_of(text).alias("text"))
    met = whole.join(drops, whole["doc_key"].eqNullSafe(drops["id"]), "left").select("row", "text", "drop")
    row_type = met.schema["row"].dataType.simpleString()
    return met.mapInArrow(_rebuild(min_chars),
                          f"row {row_type}, n_lines bigint, n_dropped bigint, kept_text string")
