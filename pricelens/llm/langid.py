"""Language ID by rank-order n-gram profiles.

A profile is the list of the most frequent letter n-grams (one to three
letters, words padded with a blank) in order of frequency. A document's
profile is compared with each language's by the out-of-place distance: the
sum, over the document's n-grams, of how far each stands from its place there,
with the longest distance for one that is missing. The nearest language wins.

Profiles are learned from a bounded sample of labelled rows (``SAMPLE_DOCS`` a
language are drawn by the hash of their id, give or take the draw's chance);
every document is then compared whole. The profiles (``PROFILE`` n-grams a language)
are the only thing that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, staged

PROFILE = 400
SAMPLE_DOCS = 2000
UNDETERMINED = "und"
FOLDS = 5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Letter n-grams of a text, packed 21 bits a letter, and their counts (by n-gram)."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    points[~_letters()[points]] = 0
    points = np.concatenate(([0], points, [0]))
    points = points[(points != 0) | np.concatenate(([True], points[:-1] != 0))]  # one blank between words
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one, two = points[points != 0], points[:-1] << 21 | points[1:]
    if points[-1] != 0:
        two = np.concatenate((two, [points[-1] << 21]))
    three = two[:len(points) - 2] << 21 | points[2:]
    three = three[points[1:-1] != 0]
    grams = np.sort(np.concatenate((one, two, three)))
    first = np.concatenate(([True], grams[1:] != grams[:-1]))
    at = np.nonzero(first)[0]
    return grams[at], np.diff(np.concatenate((at, [len(grams)])))


def ranked(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by n-gram."""
    if len(grams) > size:  # whatever ties with the last is kept for the sort
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.argsort(-counts, kind="stable")][:size]


class Profiles:
    """Language profiles: n-gram -> place in each language (``size`` where missing)."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.languages, self.size = sorted(profiles), size
        self.grams = np.unique(np.concatenate([np.zeros(0, np.int64), *[np.array(p, np.int64) for p in profiles.values()]]))
        self.places = np.full((len(self.grams) + 1, len(self.languages)), -1, np.int64)
        for k, name in enumerate(self.languages):
            own = np.array(profiles[name], np.int64)
            self.places[np.searchsorted(self.grams, own), k] = np.arange(len(own))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 for the very profile, 0 for nothing in common."""
        grams, counts = ngram_counts(text or "")
        if not len(grams) or not self.languages:
            return UNDETERMINED, 0.0
        own = ranked(grams, counts, self.size)
        at = np.searchsorted(self.grams, own)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != own)] = len(self.grams)
        places = self.places[at]
        apart = np.where(places < 0, self.size, np.abs(places - np.arange(len(own))[:, None]))
        distance = apart.sum(axis=0)
        best = int(distance.argmin())  # ties: the first language by name
        return self.languages[best], float(1 - distance[best] / (self.size * len(own)))


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts by language, summed over each batch."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = batch.column("text").to_pylist()
        for lang in sorted(set(langs)):
            parts = [ngram_counts(texts[i] or "") for i in np.nonzero(langs == lang)[0]]
            grams, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.zeros(len(grams), np.int64)
            np.add.at(counts, where, np.concatenate([p[1] for p in parts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])


def learn(labelled: DataFrame, size: int = PROFILE, sample_docs: int = SAMPLE_DOCS) -> dict[str, list[int]]:
    """Profiles by language from ``id, text, lang`` (rows without text or language are skipped)."""
    known = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not rows:
        return {}
    # a row is drawn by the hash of its id, so no rows need to be ranked or moved
    share = F.create_map(*[F.lit(x) for lang, n in rows.items() for x in (lang, min(1.0, sample_docs / n))])
    draw = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 32)) / float(1 << 32)
    sample = known.filter(draw < F.element_at(share, F.col("lang")))
    counts = sample.select("lang", "text").mapInArrow(_count_rows, "lang string, gram bigint, n bigint")
    counts = staged(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "ngrams")
    out: dict[str, list[int]] = {}
    for lang in sorted(rows):  # a distributed top-k each
        top = counts.filter(F.col("lang") == lang).orderBy(F.desc("n"), "gram").limit(size)
        out[lang] = [r["gram"] for r in top.select("gram").collect()]
    return out


def _predict(profiles: dict[str, list[int]], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(profiles, size)
        for batch in batches:
            found = [known.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["row", "lang_pred", "score"])

    return run


def held_out(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """Is the document kept away from learning?"""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, size: int = PROFILE, sample_docs: int = SAMPLE_DOCS, text: str = "text",
             lang: str = "lang", doc_id: str = "doc_id", profiles: dict[str, list[int]] | None = None) -> DataFrame:
    """``row`` (the input row), ``held_out``, ``lang_pred`` and ``score`` of every row.

    Learns from the rows that are not held out unless ``profiles`` are given.
    A NULL text or one without a letter is ``und`` with score 0, as is all if
    there is nothing to learn from. A NULL id is not held out. An empty table
    gives no rows.
    """
    if profiles is None:
        profiles = learn(docs.filter(~held_out(doc_id)).select(
            F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")),
            size, sample_docs)
    whole = packed(docs, F.col(text).cast("string").alias("text"))
    kind = whole.schema["row"].dataType.simpleString()
    out = whole.mapInArrow(_predict(profiles, size), f"row {kind}, lang_pred string, score double")
    return out.select("row", held_out(f"row.{doc_id}").alias("held_out"), "lang_pred", "score")
