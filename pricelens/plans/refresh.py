"""Price history by the days that changed.

A day's history needs, beyond the day's own snapshots, only the price that
each item had before that day. The carry table holds it: per item and day the
last price (``close``) and the last price before the day (``prev_close``). A
late load changes the rows of its own days and, of each of its items, the
first row of the next day that the item was seen; the days of those rows are
found by linking the carry rows of the touched items anew. History is then
read for these days alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens import config
from pricelens.operators.ordered import latest_by, skew_safe_lag
from pricelens.plans import marts
from pricelens.schema import CARRY_COLUMNS, STG_TIE

KEYS = ["item_id", "snapshot_date"]


def closes(stg: DataFrame) -> DataFrame:
    """Each item's last price of a day: ``item_id, snapshot_date, close``."""
    last = latest_by(stg, KEYS, ["scraped_at", *STG_TIE], ["current_price"])
    return last.withColumnRenamed("current_price", "close")


def chained(days: DataFrame) -> DataFrame:
    """``prev_close``, the item's close of the day before that it was seen (one row an item and day)."""
    before = F.lag("close").over(Window.partitionBy("item_id").orderBy("snapshot_date"))
    return days.withColumn("prev_close", before)


def new_links(stg: DataFrame, other: DataFrame, gone: DataFrame, folder: str) -> DataFrame:
    """Carry rows of the touched days (``is_new``), and those of other days whose ``prev_close`` changes.

    ``stg`` has all rows of the touched days, ``other`` the carry table of the
    other days, ``gone`` that of the touched days as it was. Written to the
    shared ``folder``, as it is read several times.
    """
    new = closes(stg)
    items = new.select("item_id").unionAll(gone.select("item_id")).distinct()
    near = other.join(items, "item_id", "left_semi")  # only these items can change
    null = F.lit(None).cast("decimal(12,2)")
    rows = new.select(*KEYS, "close", null.alias("was"), F.lit(True).alias("is_new")).unionAll(
        near.select(*KEYS, "close", F.col("prev_close").alias("was"), F.lit(False).alias("is_new")))
    links = chained(rows).filter(F.col("is_new") | ~F.col("prev_close").eqNullSafe(F.col("was")))
    links = links.select(*CARRY_COLUMNS, "is_new")
    target = f"{folder.rstrip('/')}/refresh-{uuid.uuid4().hex}"
    links.write.parquet(target)
    return stg.sparkSession.read.schema(links.schema).parquet(target)


def days_in(rows: DataFrame) -> list[str]:
    """The days (ISO dates) that rows fall on."""
    return sorted(str(r["d"]) for r in rows.select(F.to_date("snapshot_date").alias("d")).distinct().collect())


def merged(links: DataFrame, old: DataFrame) -> DataFrame:
    """Carry rows of the rebuilt days: the new links, and the ``old`` rows they leave as they were."""
    rest = old.join(links.select(*KEYS), KEYS, "left_anti")
    return links.select(*CARRY_COLUMNS).unionAll(rest.select(*CARRY_COLUMNS))


def history(stg: DataFrame, carry: DataFrame, num_parts: int | None = None,
            min_rows: int = config.HOT_KEY_MIN_ROWS) -> DataFrame:
    """M2 for whole days: ``stg`` holds all their rows, ``carry`` their rows of the carry table.

    A row follows the item's row before it on the same day, else the close
    that the item brought into the day.
    """
    here = stg.withColumn("__seen", F.struct("current_price", "snapshot_date"))
    lagged = skew_safe_lag(here, key="item_id", order=["scraped_at", *STG_TIE], value="__seen", out="__prev",
                           num_parts=num_parts, min_rows=min_rows)
    met = lagged.join(carry.select(*KEYS, "prev_close"), KEYS, "left")
    same_day = F.col("__prev.snapshot_date") == F.col("snapshot_date")
    prev = F.when(same_day, F.col("__prev.current_price")).otherwise(F.col("prev_close"))
    return marts.with_changes(met.withColumn("prev_price", prev))
