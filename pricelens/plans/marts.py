"""Staging dataset and marts as DataFrame -> DataFrame functions.

Lineage::

    price_snapshots -> stg_prices -> price_history -> price_movers
                                  |                -> daily_deals
                                  -> category_summary
    price_snapshots -> latest_snapshot -> status
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens import config
from pricelens.functions import columns as X
from pricelens.operators.ordered import exact_median, has_hot_group, latest_by, rank_top_k, skew_safe_lag
from pricelens.schema import (
    CATEGORY_COLUMNS,
    DEALS_COLUMNS,
    HISTORY_COLUMNS,
    ITEM_DAY_COLUMNS,
    LATEST_COLUMNS,
    MOVERS_COLUMNS,
    RAW_TIE,
    STG_COLUMNS,
    STG_TIE,
)

c = F.col


def stg_prices(snapshots: DataFrame) -> DataFrame:
    """M1: cleaned, typed view; one row per valid snapshot."""
    kept = snapshots.filter(
        (c("current_price") > 0) & c("item_id").isNotNull() & c("name").isNotNull()
    )
    return kept.select(
        "item_id",
        X.utrim("name").alias("product_name"),
        "current_price",
        "original_price",
        F.coalesce(c("discount_pct"), F.lit(0.0)).alias("discount_pct"),
        X.blank_to_null("brand").alias("brand"),
        X.blank_to_null("category").alias("category"),
        "item_url",
        "rating",
        F.coalesce(c("review_count"), F.lit(0)).alias("review_count"),
        X.blank_to_null("location").alias("location"),
        F.lower(X.utrim("keyword")).alias("keyword"),
        "page",
        "scraped_at",
        F.date_trunc("DAY", c("scraped_at")).alias("snapshot_date"),
        F.hour(c("scraped_at")).cast("bigint").alias("snapshot_hour"),
        # the tier reads the raw discount (NULL -> full_price), not the default
        X.price_tier(snapshots["discount_pct"]).alias("price_tier"),
    ).select(*STG_COLUMNS)


def price_history(stg: DataFrame, num_parts: int | None = None,
                  min_rows: int = config.HOT_KEY_MIN_ROWS) -> DataFrame:
    """M2: every snapshot with its change versus the item's previous snapshot.

    ``lag`` spans keywords and days (partition is the item only) and uses
    the staging rows, so dropped zero-price captures are skipped.
    """
    lagged = skew_safe_lag(
        stg, key="item_id", order=["scraped_at", *STG_TIE], value="current_price",
        out="prev_price", num_parts=num_parts, min_rows=min_rows,
    )
    return with_changes(lagged)


def with_changes(rows: DataFrame) -> DataFrame:
    """The history's columns from staging rows with their ``prev_price``."""
    changed = rows.withColumn("price_change_abs", c("current_price") - c("prev_price"))
    return changed.select(
        *[
            X.pct_change("current_price", "prev_price").alias(n) if n == "price_change_pct"
            else X.price_direction("price_change_abs").alias(n) if n == "price_direction"
            else c(n)
            for n in HISTORY_COLUMNS
        ]
    )


def price_movers(history: DataFrame, top_k: int = config.MOVERS_TOP_K) -> DataFrame:
    """M3: per day and direction, the ``top_k`` largest absolute changes
    (``rank``, so ties may return more rows)."""
    moved = history.filter(
        c("price_change_abs").isNotNull() & c("price_direction").isin(*config.MOVER_DIRECTIONS)
    )
    ranked = rank_top_k(
        moved, ["snapshot_date", "price_direction"], [F.abs(c("price_change_abs"))],
        top_k, "rank_within_direction",
    )
    return ranked.select(*MOVERS_COLUMNS)


CATEGORY_KEYS = ["snapshot_date", "category", "keyword"]


def category_summary(stg: DataFrame, num_parts: int | None = None,
                     min_rows: int = config.HOT_KEY_MIN_ROWS) -> DataFrame:
    """M4: price statistics per (day, category, keyword).

    Averages are exact decimal sums divided once; the median is the exact
    0.5 percentile over cents, computed by ``exact_median`` so that no task
    gathers a whole group's values. Everything but ``unique_items`` counts
    snapshots, so an item captured twice weighs twice.
    """
    base = stg.filter(c("category").isNotNull())
    stats = [
        # The FILTER clause (a no-op: distinct counts skip NULLs) makes Spark
        # plan the distinct count with an Expand rewrite, so the other
        # aggregates keep one partial per group rather than per (group, item).
        F.expr("count(DISTINCT item_id) FILTER (WHERE item_id IS NOT NULL)").alias("unique_items"),
        X.round2(X.exact_avg("current_price", 2)).alias("avg_price"),
        F.min("current_price").alias("min_price"),
        F.max("current_price").alias("max_price"),
        X.round2(X.exact_avg("discount_pct", 2)).alias("avg_discount_pct"),
        F.count_if(c("price_tier") == "deep_discount").alias("deep_discount_count"),
        F.count_if(c("price_tier") == "on_sale").alias("on_sale_count"),
        X.round2(X.exact_avg(X.nan_to_null("rating"), 6)).alias("avg_rating"),
        F.sum("review_count").cast("bigint").alias("total_reviews"),
    ]
    cents = X.cents("current_price")
    if not has_hot_group(base, CATEGORY_KEYS, num_parts, min_rows):
        # every group fits a task: the median rides in the same pass
        median = F.percentile(cents, F.lit(0.5)).alias("median_cents")
        joined = base.groupBy(*CATEGORY_KEYS).agg(*stats, median)
    else:
        joined = base.groupBy(*CATEGORY_KEYS).agg(*stats)
        med = exact_median(base, CATEGORY_KEYS, cents, "median_cents", num_parts, min_rows)
        med = med.select(*[c(k).alias(f"__m_{k}") for k in CATEGORY_KEYS], "median_cents")
        cond = F.lit(True)
        for k in CATEGORY_KEYS:
            cond = cond & joined[k].eqNullSafe(med[f"__m_{k}"])
        joined = joined.join(med, on=cond, how="left")
    # half cents round up (see functions.columns.median_price)
    return joined.withColumn("median_price", F.round(c("median_cents")) / 100).select(*CATEGORY_COLUMNS)


# Deterministic order among snapshots of one item and day captured at the same
# instant (the reference leaves it undefined).
DEAL_ORDER = ["scraped_at", "keyword", "current_price", "item_url", "product_name",
              "discount_pct", "review_count", "rating", "original_price", "brand",
              "category", "location"]


def daily_deals(history: DataFrame, top_k: int = config.DEALS_TOP_K) -> DataFrame:
    """M5: per day, the ``top_k`` deepest qualifying discounts.

    Filter first, then keep each item's latest *qualifying* snapshot of the
    day, then rank by discount and reviews.
    """
    qualifying = history.filter(
        (c("discount_pct") >= config.DEAL_MIN_DISCOUNT_PCT)
        & (c("review_count") >= config.DEAL_MIN_REVIEWS)
        & (c("current_price") > 0)
    )
    keep = [n for n in HISTORY_COLUMNS if n not in ("snapshot_date", "item_id")]
    latest = latest_by(qualifying, ["snapshot_date", "item_id"], DEAL_ORDER, keep)
    ranked = rank_top_k(
        latest, ["snapshot_date"], [c("discount_pct"), c("review_count")],
        top_k, "deal_rank",
    )
    fresh = (c("price_direction") == "decreased") & (c("price_change_pct") <= config.FRESH_DROP_PCT)
    return ranked.withColumn(
        "is_fresh_drop", F.coalesce(fresh, F.lit(False))
    ).select(*DEALS_COLUMNS)


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """M6: the latest raw snapshot per item (no staging filter), 8 columns."""
    return latest_by(
        snapshots, ["item_id"], ["scraped_at", *RAW_TIE], LATEST_COLUMNS[1:]
    ).select(*LATEST_COLUMNS)


def item_days(snapshots: DataFrame) -> DataFrame:
    """Each item's latest raw snapshot of a day with the number of its snapshots there.

    A day's rows depend on that day's snapshots alone, so it is kept up to date
    by touched days; ``latest_of_days`` and ``status_of_days`` read nothing else.
    """
    columns = ["snapshot_date", *LATEST_COLUMNS]
    dated = snapshots.withColumn("snapshot_date", F.date_trunc("DAY", c("scraped_at")))
    row = F.struct(*[c(n) for n in columns if n not in ("item_id", "snapshot_date")])
    order = F.struct(*[c(n).alias(f"o{i}") for i, n in enumerate(["scraped_at", *RAW_TIE])])
    days = dated.groupBy("item_id", "snapshot_date").agg(
        F.max_by(row, order).alias("__best"), F.count(F.lit(1)).alias("n_snapshots"))
    return days.select("item_id", "snapshot_date", "__best.*", "n_snapshots").select(*ITEM_DAY_COLUMNS)


def latest_of_days(days: DataFrame) -> DataFrame:
    """M6 from ``item_days``: the row of each item's last day."""
    return latest_by(days, ["item_id"], ["snapshot_date"], LATEST_COLUMNS[1:]).select(*LATEST_COLUMNS)


def status_of_days(days: DataFrame) -> DataFrame:
    """M7 from ``item_days``."""
    return days.agg(F.coalesce(F.sum("n_snapshots"), F.lit(0)).cast("bigint").alias("total_snapshots"),
                    F.count_distinct("item_id").alias("unique_items"))


def status(snapshots: DataFrame) -> DataFrame:
    """M7: total snapshots and unique items (= rows of latest_snapshot,
    since item_id is never NULL in the table)."""
    return snapshots.agg(
        F.count(F.lit(1)).alias("total_snapshots"),
        F.count_distinct("item_id").alias("unique_items"),
    )


def build_all(snapshots: DataFrame, num_parts: int | None = None) -> dict[str, DataFrame]:
    stg = stg_prices(snapshots)
    history = price_history(stg, num_parts)
    return {
        "stg_prices": stg,
        "price_history": history,
        "price_movers": price_movers(history),
        "category_summary": category_summary(stg),
        "daily_deals": daily_deals(history),
        "latest_snapshot": latest_snapshot(snapshots),
        "status": status(snapshots),
    }
