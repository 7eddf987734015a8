"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time.

The items are the queries; they are taken in blocks of bounded size, each in
one pass over all documents:

1. Each task indexes its documents in shards: for every term of the block's
   items the documents that hold it, in order, and how often. A shard is
   bounded by its documents and its postings.
2. The counts of the whole corpus (documents, terms, documents a term) are
   added up from the shards.
3. Each shard is searched for every item. Postings lists that are short are
   summed term at a time into accumulators; these then act as one more
   iterator, whose bound is their largest sum. Document at a time, that
   iterator and the long lists are merged: lists whose bounds together stay
   below the item's current threshold cannot make a result, so only the
   documents of the others are candidates, and they skip through the long
   lists (a shard's candidates move together), dropping out as soon as the
   bounds left cannot lift them to the threshold. The threshold, the score of
   the lowest of the best documents so far, lasts for all shards of a task.
4. The best of the tasks meet: at most ``top`` rows an item and task.

All arithmetic is in 64-bit integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, staged, text_of, utf8

TOP = 50
BLOCK_BYTES = 4 << 20  # text of the items that one pass takes; these, and counts of their terms, go by the driver
SHARD_DOCS = 8192
SHARD_POSTINGS = 2_000_000
SHORT_SHARE = 16  # a list is short if it holds less than this part of a shard's documents
NO_ID = (1 << 63) - 1  # a document without an id comes after all others

# Terms are runs of ASCII letters and digits and of all other characters
# beyond ASCII: on UTF-8 bytes, everything else becomes a blank.
_TERM = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
LETTERS = bytes(b if b in _TERM else 0x20 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def _shard(docs: list, lengths: list, owner: list, term: list, tf: list, n_terms: int, n_docs: int) -> pa.RecordBatch:
    """One row: the postings of a shard, by term and then by document."""
    owner, term, tf = (np.array(x, np.int32) for x in (owner, term, tf))
    by = np.argsort(term, kind="stable")
    known, sizes = np.unique(term, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()),
         pa.array([known], pa.list_(pa.int32())), pa.array([sizes], pa.list_(pa.int32())),
         pa.array([docs], pa.list_(pa.int64())), pa.array([np.array(lengths, np.int64).tobytes()], pa.binary()),
         pa.array([owner[by].tobytes()], pa.binary()), pa.array([tf[by].tobytes()], pa.binary())],
        ["n_docs", "n_terms", "terms", "sizes", "docs", "lengths", "owners", "tfs"])


SHARD = ("n_docs bigint, n_terms bigint, terms array<int>, sizes array<int>, docs array<bigint>, "
         "lengths binary, owners binary, tfs binary")


def _index(vocabulary: dict[bytes, int]):
    """Documents -> shards. Documents that hold no term of the items are only counted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.__contains__
        new = lambda: ([], [], [], [], [])
        parts, n_terms, n_docs = new(), 0, 0
        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), utf8(batch.column("text"))):
                words = terms(text)
                n_terms, n_docs = n_terms + len(words), n_docs + bool(words)
                found = Counter(filter(known, words))
                if not found:
                    continue
                docs, lengths, owner, term, tf = parts
                owner.extend([len(docs)] * len(found))
                docs.append(doc)
                lengths.append(len(words))
                term.extend([vocabulary[w] for w in found])
                tf.extend(found.values())
                if len(docs) >= SHARD_DOCS or len(tf) >= SHARD_POSTINGS:
                    yield _shard(*parts, n_terms, n_docs)
                    parts, n_terms, n_docs = new(), 0, 0
        if n_docs:
            yield _shard(*parts, n_terms, n_docs)

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gains(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What an occurrence count adds to a score, before the term's weight."""
    if len(length) and 50 * int(length.max()) * n_docs >= 1 << 63:
        m = np.array([50 + 50 * n * n_docs // n_terms for n in length.tolist()], np.int64)
    else:
        m = 50 + 50 * length * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class Shard:
    """Postings of a shard with what each of them adds to a score."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_terms: int):
        self.ids = np.array([NO_ID if d is None else d for d in row["docs"]], np.int64)
        self.missing = np.array([d is None for d in row["docs"]], bool)
        terms, sizes = np.array(row["terms"], np.int64), np.array(row["sizes"], np.int64)
        self.owners = np.frombuffer(row["owners"], np.int32)
        tf = np.frombuffer(row["tfs"], np.int32).astype(np.int64)
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.adds = gains(tf, lengths[self.owners], n_docs, n_terms) * np.repeat(weights[terms], sizes)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.sizes = sizes
        self.bounds = np.maximum.reduceat(self.adds, self.starts) if len(sizes) else np.zeros(0, np.int64)
        self.slot = np.full(len(weights), -1)
        self.slot[terms] = np.arange(len(terms))

    def postings(self, slot: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[slot], self.ends[slot]
        return self.owners[a:b], self.adds[a:b]

    def search(self, query: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (places in the shard) whose score is at least ``floor``, and those scores."""
        none = np.zeros(0, np.int64)
        slots = self.slot[query]
        slots = slots[slots >= 0]
        slots = slots[self.bounds[slots] > 0]
        if not len(slots) or int(self.bounds[slots].sum()) < floor:
            return none, none
        total = np.zeros(len(self.ids), np.int64)  # of what a document has met so far
        is_short = self.sizes[slots] * SHORT_SHARE <= len(self.ids)
        # term at a time: the short lists become accumulators
        for slot in slots[is_short].tolist():
            docs, adds = self.postings(slot)
            total[docs] += adds
        summed = np.nonzero(total)[0]
        # document at a time: the accumulators and the long lists, the lowest bound first
        lists = [(int(self.bounds[s]), s) for s in slots[~is_short].tolist()]
        if len(summed):
            lists.append((int(total[summed].max()), -1))
        lists.sort()
        bounds = np.cumsum([b for b, _ in lists]).tolist()
        essential = next((i for i, b in enumerate(bounds) if b >= floor), len(lists))
        if essential == len(lists):
            return none, none
        # the accumulators' sums are known: they are in ``total`` whether essential or not
        passive = sum(b for b, s in lists[:essential] if s >= 0)
        is_candidate = np.zeros(len(self.ids), bool)
        for _, slot in lists[essential:]:
            if slot < 0:
                is_candidate[summed] = True
            else:
                docs, adds = self.postings(slot)
                total[docs] += adds
                is_candidate[docs] = True
        live = np.nonzero(is_candidate)[0]
        for bound, slot in reversed(lists[:essential]):
            if slot < 0:
                continue
            live = live[total[live] + passive >= floor]
            docs, adds = self.postings(slot)
            at = np.searchsorted(docs, live)
            at[at == len(docs)] = 0
            met = docs[at] == live
            total[live[met]] += adds[at[met]]
            passive -= bound
        live = live[total[live] >= floor]
        return live, total[live]


def _search(queries: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in queries]
        floor = [1] * len(queries)  # a score of 0 is no result
        for batch in batches:
            for i in range(len(batch)):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], weights, n_docs, n_terms)
                for q, query in enumerate(queries):
                    live, score = shard.search(query, floor[q])
                    if not len(live):
                        continue
                    score = np.concatenate([best[q][0], score])
                    ids = np.concatenate([best[q][1], shard.ids[live]])
                    missing = np.concatenate([best[q][2], shard.missing[live]])
                    by = np.lexsort((missing, ids, -score))[:top]
                    best[q] = score[by], ids[by], missing[by]
                    if len(by) == top:
                        floor[q] = int(score[by[-1]])
        for q, (score, ids, missing) in enumerate(best):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), q, np.int32)), pa.array(score), pa.array(ids, mask=missing)],
                    ["query", "score", "doc_id"])

    return run


def _search_block(slim: DataFrame, block: list, kind: str, top: int) -> DataFrame:
    """All documents against one block of items (``item_id``, ``text``)."""
    spark = slim.sparkSession
    wanted = [sorted(set(terms((r["text"] or "").encode()))) for r in block]
    vocabulary = {t: i for i, t in enumerate(sorted({t for w in wanted for t in w}))}
    shards = staged(slim.mapInArrow(_index(vocabulary), SHARD), "search-shards")
    n = shards.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    n_docs, n_terms = n["docs"] or 0, n["terms"] or 1
    counts = shards.select(F.explode(F.arrays_zip("terms", "sizes")).alias("t")).groupBy("t.terms").agg(
        F.sum("t.sizes").alias("df")).collect()  # at most a row a term of the block
    weights = np.zeros(len(vocabulary), np.int64)
    for c in counts:
        weights[c["terms"]] = weight(n_docs, c["df"])
    queries = [np.array([vocabulary[t] for t in w], np.int64) for w in wanted]
    found = shards.mapInArrow(_search(queries, weights, n_docs, n_terms, top),
                              "query int, score bigint, doc_id bigint")
    by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    first = found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"query int, item_id {kind}")
    return first.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, text: str = "text", doc_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0.

    Equal scores go by ascending ``doc_id``, NULL ids last. Every row of
    ``docs`` is a document, also where ids or whole rows repeat; NULL and empty
    texts have no terms and are not counted. Items equal in id and text are
    one item, items that share only the id are ranked each for itself; an item
    without terms has no results. Empty tables give no rows.
    """
    slim = small_batches(docs).select(F.col(doc_id).cast("bigint").alias("id"), text_of(text).alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), text_of(item_text).alias("text")).distinct()
    asked = staged(asked, "search-items")
    kind = asked.schema["item_id"].dataType.simpleString()
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = None
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        found = _search_block(slim, rows, kind, top)
        out = found if out is None else out.unionAll(found)
    return out
