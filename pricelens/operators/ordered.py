"""Order-sensitive operators that stay balanced when one key is hot.

* ``skew_safe_lag``: ``lag(value) over (partition by key order by ...)``
  without sending a whole hot key to one task.
* ``latest_by``: one row per group, the one with the greatest ordering key,
  as a ``max_by`` aggregate (map-side combine) instead of a window.
* ``rank_top_k``: ``rank() <= k`` per group; each task keeps its first ranks
  and their counts are merged, so a long tie is never gathered.
* ``number_rows``: each row's place in a total order, from its place in its
  range and the sizes of the ranges before.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens import config


def _num_parts(df: DataFrame, num_parts: int | None) -> int:
    if num_parts:
        return int(num_parts)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


BOUNDS = "__bounds"
SAMPLES_PER_RANGE = 64
RANK_SLICES = 16


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` in ``left`` and ``prefix + key`` in ``right``."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[prefix + k])
    return cond


def _hot_bounds(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
                min_rows: int) -> DataFrame | None:
    """Hot keys (``__h_<key>``) with the bounds of their ranges, as values.

    A key is hot when it holds more rows than an average partition of ``df``
    (``total / n``) and more than ``min_rows`` (smaller keys fit one task), so
    fewer than ``n`` keys are. Each is cut into about as many ranges as it
    holds average partitions; the bounds are ``order`` tuples, picked from a
    random sample of the key's rows. They are fixed by a checkpoint: whatever
    the sample, a row's range is a function of the row and of these values,
    so every use of it agrees. Returns ``None`` when no key is hot.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt"))
    worst = counts.agg(F.max("__cnt").alias("m"), F.sum("__cnt").alias("t")).first()  # one narrow scan
    if not worst["m"] or worst["m"] * n <= worst["t"] or worst["m"] <= min_rows:
        return None
    total = F.lit(worst["t"])
    per_range = F.greatest(total / n, F.lit(float(min_rows)))
    hot = counts.filter((F.col("__cnt") * n > total) & (F.col("__cnt") > min_rows)).select(
        *[F.col(k).alias(f"__h_{k}") for k in keys], F.col("__cnt"),
        F.ceil(F.col("__cnt") / per_range).alias("__ranges"))
    config.checkpoint_dir(df.sparkSession)
    hot = hot.checkpoint()  # fewer than n rows
    rows = df.select(*keys, *[F.col(c).alias(f"__o_{c}") for c in order])
    rows = rows.join(F.broadcast(hot), _match(rows, hot, keys, "__h_"))
    share = F.col("__ranges") * SAMPLES_PER_RANGE / F.col("__cnt")
    tuple_ = F.struct(*[F.col(f"__o_{c}").alias(f"o{i}") for i, c in enumerate(order)])
    sample = rows.filter(F.rand(seed=11) < share).groupBy(*[f"__h_{k}" for k in keys], "__ranges").agg(
        F.array_sort(F.collect_list(tuple_)).alias("__s"))
    cut = F.transform(F.sequence(F.lit(1).cast("bigint"), F.greatest(F.col("__ranges") - 1, F.lit(1))),
                      lambda i: F.get("__s", F.floor(i * F.size("__s") / F.col("__ranges")).cast("int")))
    return sample.select(*[f"__h_{k}" for k in keys], cut.alias(BOUNDS)).checkpoint()


def has_hot_group(df: DataFrame, keys: Sequence[str], num_parts: int | None = None,
                  min_rows: int = config.HOT_KEY_MIN_ROWS) -> bool:
    """Does a group hold more rows than an average partition and ``min_rows``? (one narrow scan)"""
    n = _num_parts(df, num_parts)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt"))
    worst = counts.agg(F.max("__cnt").alias("m"), F.sum("__cnt").alias("t")).first()
    return bool(worst["m"]) and worst["m"] * n > worst["t"] and worst["m"] > min_rows


def count_below(bounds: Column, own: Column) -> Column:
    """How many of the sorted ``bounds`` lie below ``own``: found by halving, not by comparing with each."""
    def step(a: Column, _: Column) -> Column:
        mid = F.floor((a["low"] + a["high"]) / 2).cast("int")
        below = F.get(bounds, mid) < own
        open_ = a["low"] < a["high"]
        return F.struct(F.when(open_ & below, mid + 1).otherwise(a["low"]).alias("low"),
                        F.when(open_ & ~below, mid).otherwise(a["high"]).alias("high"))

    halvings = F.sequence(F.lit(0), F.length(F.bin(F.size(bounds))))
    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))
    return F.aggregate(halvings, start, step, lambda a: a["low"])


def _ranged(df: DataFrame, bounds: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: str) -> DataFrame:
    """``df`` with each row's range: how many of its key's bounds lie below it
    (NULL for the rows of other keys). Rows equal in ``order`` stay together."""
    own = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    joined = df.join(F.broadcast(bounds), _match(df, bounds, keys, "__h_"), "left")
    below = count_below(F.col(BOUNDS), own)
    return joined.select(*df.columns, F.when(F.col(BOUNDS).isNotNull(), below).cast("long").alias(chunk))


def skew_safe_lag(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    out: str,
    num_parts: int | None = None,
    min_rows: int = config.HOT_KEY_MIN_ROWS,
) -> DataFrame:
    """Add ``out = lag(value, 1) over (partition by key order by order)``.

    A plain window sends every row of a key to one task, so a key holding a
    third of the data would run in a single task. Here:

    1. hot keys and the bounds of their ranges come from ``_hot_bounds``
       (fewer than ``num_parts`` rows); with none, this is a plain window;
    2. every row gets its range from those values, and one window runs per
       (key, range): one shuffle;
    3. the first row of a range takes the last value of the range before it,
       from a table of one row per range (broadcast).
    """
    n = _num_parts(df, num_parts)
    chunk, first, carry = "__lag_chunk", "__lag_first", "__lag_carry"
    order_cols = [F.col(c) for c in order]
    bounds = _hot_bounds(df, [key], order, n, min_rows)
    if bounds is None:  # no hot key: a plain window, one shuffle
        return df.withColumn(out, F.lag(F.col(value)).over(Window.partitionBy(key).orderBy(*order_cols)))

    rows = _ranged(df, bounds, [key], order, chunk)
    w = Window.partitionBy(key, chunk).orderBy(*order_cols)
    within = rows.select(
        "*", F.lag(F.col(value)).over(w).alias(out),
        (F.col(chunk).isNotNull() & (F.row_number().over(w) == 1)).alias(first))

    # last value of each range, moved onto the next range of the key
    sort_key = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate([*order, value])])
    last = F.max_by(F.struct(F.col(value).alias("v")), sort_key)
    tails = rows.filter(F.col(chunk).isNotNull()).groupBy(key, chunk).agg(last.alias("__tail"))
    carries = tails.select(
        F.col(key).alias("__c_key"), F.col(chunk).alias("__c_chunk"),
        F.lag(F.col("__tail")["v"]).over(Window.partitionBy(key).orderBy(chunk)).alias(carry))
    joined = within.join(
        F.broadcast(carries),
        within[key].eqNullSafe(carries["__c_key"]) & (within[chunk] == carries["__c_chunk"]) & within[first], "left")
    fixed = F.when(F.col(first), F.col(carry)).otherwise(F.col(out))
    return joined.select(*df.columns, fixed.alias(out))


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Keep, per ``keys`` group, the row with the greatest ``order`` tuple.

    Written as ``max_by(struct(row), struct(order))``: partial aggregation
    runs before the shuffle, so a hot group ships one row per map task rather
    than all of its rows. The aggregate of whole rows is sort-based: each map
    task sorts its rows by the keys first (spilling if need be).
    """
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    row = F.struct(*[F.col(c) for c in columns])
    sort_key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_cols)])
    best = df.groupBy(*keys).agg(F.max_by(row, sort_key).alias("__best"))
    return best.select(*keys, *[F.col("__best")[c].alias(c) for c in columns])


def rank_top_k(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    k: int,
    out: str,
    slices: int = RANK_SLICES,
) -> DataFrame:
    """Rows whose ``rank()`` within ``partition``, by ``order`` values
    descending (NULLs last), is at most ``k`` (ties kept).

    A partition's rows are dealt by a hash of the row over ``slices``; in each
    slice, and in each task before anything is shuffled, only the first ``k``
    ranks stay (Spark's window group limit). A row that fewer than ``k`` rows
    precede is among them, and so are all rows before it: counts of the rows
    left give its rank. They are written once, so that ``df`` is computed once,
    and their ranks are joined to them: a long tie stays dealt over its slices.
    """
    key, tie = [f"__p{i}" for i in range(len(partition))], [f"__t{i}" for i in range(len(order))]
    named = df.select("*", *[v.alias(a) for v, a in zip(order, tie)])
    dealt = named.withColumn("__slice", F.pmod(F.xxhash64(*df.columns), F.lit(slices)))
    down = [F.col(a).desc_nulls_last() for a in tie]
    near = F.rank().over(Window.partitionBy(*partition, "__slice").orderBy(*down))
    left = dealt.withColumn("__near", near).filter(F.col("__near") <= k).drop("__near", "__slice")
    target = f"{config.checkpoint_dir(df.sparkSession).rstrip('/')}/ranked-{uuid.uuid4().hex}"
    left.write.parquet(target)
    left = df.sparkSession.read.schema(left.schema).parquet(target)

    counts = left.groupBy(*[F.col(p).alias(a) for p, a in zip(partition, key)], *tie).agg(F.count(F.lit(1)).alias("__n"))
    by = Window.partitionBy(*key).orderBy(*down)
    # at most k values a partition pass the (pushed-down) row number limit
    firsts = counts.withColumn("__i", F.row_number().over(by)).filter(F.col("__i") <= k)
    before = F.coalesce(F.sum("__n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = firsts.withColumn(out, (before + 1).cast("bigint")).filter(F.col(out) <= k)
    ranks = ranks.select(*key, *[F.col(a).alias(f"{a}r") for a in tie], out)
    cond = F.lit(True)
    for x, y in [*zip(partition, key), *[(a, f"{a}r") for a in tie]]:
        cond = cond & left[x].eqNullSafe(ranks[y])
    return left.join(ranks, cond).select(*df.columns, out)


def number_rows(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """Add each row's 1-based place in ``order``; rows equal in it are numbered in any order.

    The rows are sorted by range and written with their place in their
    partition, so that every later reading agrees; one row a partition then
    tells how many rows come before it. No task sees more than a range.
    """
    width = 33  # bits of the row's place in ``monotonically_increasing_id``
    target = f"{config.checkpoint_dir(df.sparkSession).rstrip('/')}/numbered-{uuid.uuid4().hex}"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("__id", F.monotonically_increasing_id()).write.parquet(target)
    rows = df.sparkSession.read.parquet(target)
    rows = rows.withColumn("__part", F.shiftright("__id", width)).withColumn(
        "__at", F.col("__id").bitwiseAND(F.lit((1 << width) - 1)))
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row a partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    placed = rows.join(offsets, "__part")
    return placed.select(*df.columns, (F.col("__before") + F.col("__at") + 1).alias(out))


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    value: Column | str,
    out: str,
    num_parts: int | None = None,
    min_rows: int = config.HOT_KEY_MIN_ROWS,
) -> DataFrame:
    """Exact 0.5 continuous percentile of an integral ``value`` per ``keys``
    group, as the mean of the two middle values (one row per group).

    A ``percentile`` aggregate merges every distinct value of a group in one
    task. Here no task holds more than about an average partition:

    1. value frequencies per (group, value), combined map-side;
    2. groups with more distinct values than an average partition of that
       table are *hot* (``_hot_bounds``); with none, a weighted ``percentile``
       over the frequencies finishes it (each group's buffer is bounded by the
       same average partition);
    3. running counts are taken per group, or for a hot group per range of
       values; each range is offset by the rows of the ranges below it (one
       row per range, broadcast);
    4. the values at the two middle positions are picked with an aggregate.
    """
    n = _num_parts(df, num_parts)
    v = F.col(value) if isinstance(value, str) else value
    chunk, f = "__med_chunk", "__med_f"
    freq = df.select(*keys, v.cast("long").alias("__v")).filter(F.col("__v").isNotNull()) \
        .groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias(f))
    bounds = _hot_bounds(freq, keys, ["__v"], n, min_rows)
    if bounds is None:
        # No hot group: every group has at most an average partition (or
        # ``min_rows``) of distinct values, so one weighted percentile over the
        # frequency table keeps a bounded buffer per group.
        return freq.groupBy(*keys).agg(F.percentile("__v", F.lit(0.5), F.col(f)).alias(out))
    rows = _ranged(freq, bounds, keys, ["__v"], chunk)

    w_run = Window.partitionBy(*keys, chunk).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys, chunk)
    local = rows.select(*keys, "__v", f, chunk, F.sum(f).over(w_run).alias("__cum"),
                        F.sum(f).over(whole).alias("__chunk_rows"))

    # per hot range: rows below it and rows of the whole group; the other
    # groups are one range each
    range_rows = rows.filter(F.col(chunk).isNotNull()).groupBy(*keys, chunk).agg(F.sum(f).alias("__rr"))
    below = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = range_rows.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], F.col(chunk).alias("__r_chunk"),
        F.coalesce(F.sum("__rr").over(below), F.lit(0)).alias("__offset"),
        F.sum("__rr").over(Window.partitionBy(*keys)).alias("__hot_rows"),
    )
    placed = local.join(F.broadcast(offsets),
                        _match(local, offsets, keys, "__r_") & (local[chunk] == offsets["__r_chunk"]), "left")
    placed = placed.select("*", F.coalesce("__hot_rows", "__chunk_rows").alias("__rows"))

    last = F.coalesce(F.col("__offset"), F.lit(0)) + F.col("__cum")  # 1-based last position of the value
    first = last - F.col(f) + 1
    lo = F.floor((F.col("__rows") - 1) / 2) + 1
    hi = F.floor(F.col("__rows") / 2) + 1
    picked = placed.groupBy(*keys).agg(
        F.max(F.when((first <= lo) & (lo <= last), F.col("__v"))).alias("__lo"),
        F.max(F.when((first <= hi) & (hi <= last), F.col("__v"))).alias("__hi"),
    )
    return picked.select(*keys, ((F.col("__lo") + F.col("__hi")) / 2).alias(out))
