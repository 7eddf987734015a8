"""Mixing sources to target weights.

Sizes are counted in words. Each source's target is its weight's share of the
whole, cut at ``MAX_REPEATS`` times its own size, the excess shared again by
weight. A source's documents are put in a random order that depends only on
the seed and the id (their MD5), cut into 4,096 blocks by its first three hex
digits. ``floor(target / size)`` whole passes are taken, and for the rest a
prefix of that order: whole blocks first, then single documents of the one
block on the boundary. The decision is thus a threshold on the MD5 per source,
evaluated where the document is; no text is shuffled for it.

The taken blocks are dealt over the output shards by a splitting tree: the
shards are halved again and again, and at each node the number of blocks that
go left is drawn per source from the multivariate hypergeometric distribution,
so the shards' quotas are exact and add up. Blocks then fall to the shards by
their rank, and each shard is shuffled by its own order key.

The plan holds one row per source (driver, as are the weights); everything
that grows with documents stays in Spark.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, packed, staged, text_of

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SHARDS = 16
SEED = 20240607
BLOCK_DIGITS = 3  # 16 ** 3 blocks a source
BLOCKS = 16 ** BLOCK_DIGITS


def word_count(column):
    """Number of words: runs of anything but ASCII white space."""
    return F.size(F.filter(F.split(column, SPACE_CLASS + "+"), lambda w: w != "")).cast("bigint")


def order_hash(doc_id, text, seed: int):
    """A document's place in its source's order; the text tells rows that share an id apart."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(text)))


def source_targets(sources: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size`` -> with ``weight`` and ``target``.

    Water filling in closed form: in the order of cap / weight a source is cut
    to its cap if its share of what the sources before it leave exceeds the
    cap. One row per source, so the windows run over that small table.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.select("source", "source_size", pick.alias("weight"),
                       (F.col("source_size") * max_repeats).alias("cap"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = (Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    s = s.select("*", F.sum("source_size").over(everything).alias("total"),
                 F.sum("weight").over(everything).alias("weights"),
                 F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
                 F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"))
    left, share = F.col("total") - F.col("cap_before"), F.col("weights") - F.col("weight_before")
    s = s.withColumn("capped", left * F.col("weight") > F.col("cap") * share)
    s = s.select("*", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything).alias("cap_sum"),
                 F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0)).over(everything).alias("cap_weight"))
    free = F.col("weight") * (F.col("total") - F.col("cap_sum")) / (F.col("weights") - F.col("cap_weight"))
    return s.select("source", "source_size", "weight",
                    F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(free.cast("double")).alias("target"))


def splitting_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Deal ``quotas[source]`` blocks over ``shards``: counts ``[source, shard]``.

    Every node gives its left half a share of all blocks in proportion to its
    shards, composed per source by a multivariate hypergeometric draw.
    """
    out = np.zeros((len(quotas), shards), np.int64)

    def split(have: np.ndarray, first: int, n: int) -> None:
        if n == 1 or not have.sum():
            out[:, first] = have
            return
        half = n // 2
        rng = np.random.default_rng([seed, first, n])
        m = int(have.sum()) * half // n
        left = np.zeros_like(have)
        rest, todo = int(have.sum()), m
        for i, h in enumerate(have.tolist()):  # conditional hypergeometric draws, exact in integers
            rest -= h
            left[i] = h if rest == 0 and todo >= h else rng.hypergeometric(h, rest, todo) if h and todo else 0
            todo -= int(left[i])
        split(left, first, half)
        split(have - left, first + half, n - half)

    if len(quotas):
        split(np.asarray(quotas, np.int64), 0, shards)
    return out


def mixing_plan(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: size, target, whole passes and the cut of the last.

    ``sized``: source, size, h. A document is in the last, partial pass if
    ``h <= cut`` (NULL: none is). Ties in ``h`` (repeated rows) go together.
    """
    sources = staged(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                                    weights, max_repeats), "mix-sources")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = sources.select("*", passes.cast("bigint").alias("passes"),
                          (F.col("target") - passes * F.col("source_size")).alias("rest"))
    block = F.substring("h", 1, BLOCK_DIGITS)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    # at most BLOCKS rows a source, whatever the number of documents
    blocks = sized.groupBy("source", block.alias("block")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.select("*", F.sum("words").over(upto).alias("upto"))
    met = blocks.join(plan.select(F.col("source").alias("s"), "rest"),
                      F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # the first block that the rest does not cover whole
    edge = staged(met.filter(F.col("upto") > F.col("rest")).groupBy("source").agg(
        F.min(F.struct("block", (F.col("rest") - F.col("upto") + F.col("words")).alias("room"))).alias("e"))
        .select("source", "e.block", "e.room"), "mix-edges")
    inside = sized.join(edge.select(F.col("source").alias("s"), F.col("block").alias("b"), "room"),
                        F.col("source").eqNullSafe(F.col("s")) & (block == F.col("b"))).drop("s")
    by_hash = inside.groupBy("source", "h", "room").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    by_hash = by_hash.select("*", F.sum("words").over(run).alias("upto"))
    # a document belongs to the mix if at least half of it fits
    last = (by_hash.filter(F.col("upto") - F.col("words") / 2 <= F.col("room"))
            .groupBy("source").agg(F.max("h").alias("last")))
    edge = edge.select(F.col("source").alias("es"), "block")
    last = last.select(F.col("source").alias("ls"), "last")
    out = (plan.join(edge, F.col("source").eqNullSafe(F.col("es")), "left")
           .join(last, F.col("source").eqNullSafe(F.col("ls")), "left"))
    # no edge: a rest of a whole source (rounding); else all blocks before it
    cut = (F.when(F.col("rest") <= 0, F.lit(None).cast("string"))
           .when(F.col("block").isNull(), F.lit("g"))
           .otherwise(F.coalesce("last", "block")))
    return staged(out.select("source", "source_size", "weight", "target",
                             "passes", cut.alias("cut")), "mix-plan")


def sized_documents(docs: DataFrame, seed: int = SEED, source: str = "source",
                    text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    return docs.select(F.col(doc_id).alias("id"), F.col(source).cast("string").alias("source"),
                       word_count(text_of(text)).alias("size"),
                       order_hash(F.col(doc_id), text_of(text), seed).alias("h"))


def mix_copies(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED,
               source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``id, size, source_size, target, copies`` for each document.

    The mix is made and written as ``mix`` says; ``copies`` counts the rows of
    a document that were dealt to a shard. Rows of one source that share id and
    text are taken together and have the same number.

    A NULL text has size 0; NULL is a source of its own, ordered last. A
    source without words takes nothing. An empty table gives no rows.
    """
    sized, plan = _planned(docs, weights, max_repeats, seed, source, text, doc_id)
    mixed = staged(_dealt(docs, plan, SHARDS, seed, source, text, doc_id), "mix-rows")
    there = sized.select("h", "source", F.lit(1).alias("n"), F.lit(0).alias("dealt"))
    dealt = mixed.select("h", F.col(f"row.`{source}`").cast("string").alias("source"),
                         F.lit(0).alias("n"), F.lit(1).alias("dealt"))
    per = there.unionAll(dealt).groupBy("h", "source").agg(F.sum("n").alias("n"), F.sum("dealt").alias("dealt"))
    per = staged(per.select(F.col("h").alias("k"), F.col("source").alias("s"),
                            F.expr("dealt div n").alias("copies")), "mix-counts")
    met = sized.join(per, (F.col("h") == F.col("k")) & F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = plan.select(F.col("source").alias("s"), "source_size", "target")
    met = met.join(plan, F.col("source").eqNullSafe(F.col("s")))
    return met.select("id", "source", "size", "source_size", "target", "copies")


def _copies():
    return F.col("passes") + F.when(F.col("h") <= F.col("cut"), 1).otherwise(0)


def _planned(docs: DataFrame, weights, max_repeats: int, seed: int, source: str, text: str,
             doc_id: str) -> tuple[DataFrame, DataFrame]:
    sized = staged(sized_documents(docs, seed, source, text, doc_id), "mix-sizes")
    return sized, mixing_plan(sized, weights, max_repeats)


def _dealt(docs: DataFrame, plan: DataFrame, shards: int, seed: int, source: str, text: str, doc_id: str) -> DataFrame:
    rows = plan.collect()  # one row per source, like the weights
    edges = [int(r["cut"][:BLOCK_DIGITS], 16) if r["cut"] not in (None, "g") else -1 for r in rows]
    quotas = [BLOCKS * r["passes"] + (BLOCKS if r["cut"] == "g" else e + 1) for r, e in zip(rows, edges)]
    dealt = splitting_tree(np.array(quotas, np.int64), shards, seed)
    ends = [(r["source"], [int(x) for x in c]) for r, c in zip(rows, np.cumsum(dealt, axis=1))]
    spark = docs.sparkSession
    tree = spark.createDataFrame(ends, "t string, ends array<bigint>")
    # written, so that its size is known and the texts need not be shuffled by source
    plan = staged(plan.join(tree, F.col("source").eqNullSafe(F.col("t"))).select(
        F.col("source").alias("s"), "passes", "cut", "ends"), "mix-tree")
    whole = packed(docs, F.col(source).cast("string").alias("source"),
                   order_hash(F.col(doc_id), text_of(text), seed).alias("h"))
    met = whole.join(plan, F.col("source").eqNullSafe(F.col("s"))).filter(_copies() > 0)
    met = met.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), _copies() - 1)))
    rank = F.col("copy") * BLOCKS + F.conv(F.substring("h", 1, BLOCK_DIGITS), 16, 10).cast("bigint")
    met = met.withColumn("rank", rank)
    shard = F.size(F.filter("ends", lambda e: e <= F.col("rank"))).cast("int")
    met = met.select("row", "h", F.col("copy").cast("int").alias("copy"), shard.alias("shard"),
                     F.xxhash64("h", "copy", F.lit(seed)).alias("order_key"))
    # a shard is cut into ranges of its (uniform) order keys: more tasks than shards, no sampling
    ranges = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
    high = F.shiftright("order_key", 32) + F.lit(1 << 31)
    place = F.col("shard") * ranges + F.shiftright(high * ranges, 32).cast("int")
    return met.repartitionById(shards * ranges, place).sortWithinPartitions("shard", "order_key")


def mix(docs: DataFrame, shards: int = SHARDS, weights=WEIGHTS, max_repeats: int = MAX_REPEATS,
        seed: int = SEED, source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The mixed rows: ``row`` once per copy, with ``h`` (its place in the order), ``copy``, ``shard`` and ``order_key``.

    Every partition holds one shard, or one range of its order keys, sorted by
    them; partitions are in the order of shards and ranges, so the files of a
    plain write are the shuffled shards one after another.
    """
    _, plan = _planned(docs, weights, max_repeats, seed, source, text, doc_id)
    return _dealt(docs, plan, shards, seed, source, text, doc_id)
