"""Analyst reports over the marts.

"Today" is a parameter; by default it is the latest snapshot day in the data
(``days``, e.g. the staging dataset, else the mart itself), taken as a scalar
subquery so no data passes through the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens import config

c = F.col


def _day(mart: DataFrame, as_of: dt.date | str | None, days: DataFrame | None = None) -> Column:
    if as_of is not None:
        return F.to_timestamp(F.lit(str(as_of)))
    return (mart if days is None else days).agg(F.max("snapshot_date")).scalar()


def _on_day(mart: DataFrame, day: Column) -> Column:
    """``snapshot_date = day``, plus the partition column when the mart was
    read with it, so only that day's files are scanned."""
    cond = c("snapshot_date") == day
    if "snapshot_day" in mart.columns:
        cond = cond & (c("snapshot_day") == F.to_date(day))
    return cond


def todays_drops(movers: DataFrame, as_of=None, limit: int = config.REPORT_LIMIT,
                 days: DataFrame | None = None) -> DataFrame:
    """The day's decreases, steepest percent drop first (a top-k report).

    Extra sort keys after the percent make the cut at ``limit`` stable.
    """
    day = movers.filter(
        _on_day(movers, _day(movers, as_of, days)) & (c("price_direction") == "decreased")
    )
    return (
        day.select("product_name", "prev_price", "current_price", "price_change_pct", "item_url")
        .orderBy(c("price_change_pct").asc(), "item_url", "product_name", "prev_price", "current_price")
        .limit(limit)
    )


def todays_deals(deals: DataFrame, as_of=None, days: DataFrame | None = None) -> DataFrame:
    """R2: the day's deals in rank order."""
    day = deals.filter(_on_day(deals, _day(deals, as_of, days)))
    return day.select(
        "deal_rank", "product_name", "category", "current_price", "discount_pct", "is_fresh_drop"
    ).orderBy("deal_rank", "product_name")


def category_trend(summary: DataFrame) -> DataFrame:
    """Average and median price per category over time."""
    return summary.select("snapshot_date", "category", "avg_price", "median_price").orderBy(
        c("snapshot_date").desc(), "category"
    )


def fresh_drops(deals: DataFrame) -> DataFrame:
    """Alert feed, deals flagged as fresh drops."""
    return deals.filter(c("is_fresh_drop"))


# Presentation order of the stored marts (O3-O5), newest day first; what
# follows the first keys only makes the order of ties stable.
PRESENTATION = {
    "price_movers": "snapshot_date DESC, price_direction, rank_within_direction, item_id, keyword, current_price",
    "daily_deals": "snapshot_date DESC, deal_rank, item_id",
    "category_summary": "snapshot_date DESC, total_reviews DESC, category, keyword",
}


def presentation(name: str) -> list[Column]:
    parts = [p.split() for p in PRESENTATION[name].split(", ")]
    return [c(p[0]).desc() if p[1:] else c(p[0]).asc() for p in parts]


def presented(name: str, mart: DataFrame) -> DataFrame:
    """A mart in its presentation order (a range-partitioned sort)."""
    return mart.orderBy(*presentation(name))
