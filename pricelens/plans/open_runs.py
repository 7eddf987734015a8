"""The page cap over runs whose pages land bit by bit (S2 on the stream).

A page counts once all pages before it have landed. A load sees some of a run's
pages only, so each load writes how far every open (run, keyword) has come, and
its pages that wait for an earlier one; the next load goes on from there. Both
are tables of the load and become visible with its commit: a load that is tried
again starts from the same state.

A run is closed once no page of it has landed for ``patience`` seconds; the
pages that still wait are then left out as the batch job would leave them out,
and recorded like those. A page that lands after that starts its run anew.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.plans.ingest import AFTER_GAP, BEYOND_CAP, NOT_CHOSEN, chosen
from pricelens.schema import PAGE
from pricelens.sources import landed, store

c = F.col
WAITS = "waits for an earlier page"
PROGRESS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("keyword", T.StringType()),
                         T.StructField("reached", T.IntegerType()), T.StructField("seen", T.TimestampType()),
                         T.StructField("open", T.BooleanType())])
CUT = T.StructType(PAGE.fields + [T.StructField("reason", T.StringType()), T.StructField("fate", T.StringType())])


def left_by(spark: SparkSession, record: dict | None) -> tuple[DataFrame, DataFrame]:
    """The pages that wait and the progress of the open runs, as a load left them (None: nothing)."""
    if record is None or store.PROGRESS_TABLE not in record["tables"]:
        return spark.createDataFrame([], PAGE), spark.createDataFrame([], PROGRESS)
    cut = spark.read.schema(CUT).parquet(record["tables"][store.CUT_TABLE])
    progress = spark.read.schema(PROGRESS).parquet(record["tables"][store.PROGRESS_TABLE])
    return cut.filter(c("fate") == landed.HELD).select(*PAGE.names), progress.filter("open")


def progress(new: DataFrame, held: DataFrame, before: DataFrame, max_pages: int, patience: float,
             now: dt.datetime, keywords: Sequence[str] | None = None) -> DataFrame:
    """One row per open or just closed (run, keyword): the last page ``reached`` without a gap.

    ``new`` and ``held`` are pages with items. At most ``max_pages`` numbers
    are gathered per group, and they combine map-side.
    """
    none = F.lit(None)
    number = F.when(c("page").between(1, max_pages), c("page"))
    parts = new.filter(chosen(keywords)).select("run_id", "keyword", number.alias("page"), F.lit(0).alias("reached"),
                                                F.lit(now).alias("seen"))
    for more in (held.select("run_id", "keyword", number.alias("page"), F.lit(0).alias("reached"),
                             none.cast("timestamp").alias("seen")),
                 before.select("run_id", "keyword", none.cast("int").alias("page"), "reached", "seen")):
        parts = parts.unionAll(more)
    groups = parts.groupBy("run_id", "keyword").agg(
        F.collect_set("page").alias("pages"), F.max("reached").alias("reached"), F.max("seen").alias("seen"))
    reached = F.aggregate(F.sequence(F.lit(1), F.lit(max_pages)), c("reached"),
                          lambda k, p: F.when((k == p - 1) & F.array_contains(c("pages"), p), p).otherwise(k))
    still = c("seen") + F.make_dt_interval(secs=F.lit(patience)) >= F.lit(now)
    return groups.select("run_id", "keyword", reached.alias("reached"), "seen", still.alias("open"))


def page_fates(pages: DataFrame, progress: DataFrame, max_pages: int,
               keywords: Sequence[str] | None = None) -> DataFrame:
    """Pages with the ``reason`` why they are left out or wait (NULL: kept)."""
    at = progress.select(c("run_id").alias("__r"), c("keyword").alias("__k"), "reached", "open")
    out = pages.join(at, pages["run_id"].eqNullSafe(at["__r"]) & pages["keyword"].eqNullSafe(at["__k"]), "left")
    countable = F.coalesce(c("page") >= 1, F.lit(False))
    reason = (F.when(~chosen(keywords), NOT_CHOSEN)
              .when(c("page") > max_pages, BEYOND_CAP)
              .when(countable & (c("page") <= c("reached")), F.lit(None).cast("string"))
              .when(countable & c("open"), WAITS)
              .otherwise(AFTER_GAP))
    return out.select(*pages.columns, reason.alias("reason"))
