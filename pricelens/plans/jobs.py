"""User entry points as Spark jobs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from pricelens import config
from pricelens.plans import ingest, marts, open_runs, quality, refresh, reports
from pricelens.sources import landed, store

MART_NAMES = ["price_history", "price_movers", "category_summary", "daily_deals"]


def load_pages(spark: SparkSession, pages: DataFrame, warehouse: str,
               keywords: Sequence[str] | None = None, max_pages: int | None = None,
               load_id: str | None = None, owner: str = "", resume: str | None = None,
               patience: float | None = None) -> dict:
    """Validate page documents and append valid records (+ rejects), as one load.

    The pages are parsed once and written with the one fate each of them has
    (full, empty, malformed; full ones are then kept or skipped, if a cut was
    asked for); everything else is read from there. So every landed item is
    accounted for: appended, rejected, on a page that was asked to be left out
    (``raw/skipped_pages``, with the reason), or on a page that could not be
    read (``raw/malformed_pages``, the line itself), whatever the cut. The
    commit is written last: before it, nothing of the load is visible.

    With ``patience`` (seconds) the cap holds for runs whose pages come in
    several loads: a page that waits for an earlier one is held, and the load
    goes on from the one named by ``resume`` (see ``plans.open_runs``).
    """
    if patience is not None and max_pages is None:
        raise ValueError("patience is for a page cap")
    load = store.Load(spark, warehouse, load_id, owner)
    obs = Observation(f"landed_{uuid.uuid4().hex[:8]}")
    seen = landed.fated(pages).observe(obs, F.count_if(F.col("fate") == landed.MALFORMED).alias("malformed"),
                                       F.sum(ingest.item_count()).alias("items"))
    stored = load.write(seen, store.PAGES_TABLE, "fate")
    of = lambda df, fate: df.filter(F.col("fate") == fate)
    kept = of(stored, landed.FULL)
    items_of = lambda df: int(df.agg(F.sum(ingest.item_count())).first()[0] or 0)
    skipped_items = resumed_items = held_items = 0
    if keywords is not None or max_pages is not None:
        cut = kept.drop("line", "fate")
        if patience is None:
            cut = ingest.page_fates(cut, keywords, max_pages)
        else:
            held, before = open_runs.left_by(spark, store.commits(spark, warehouse)[resume] if resume else None)
            now = dt.datetime.now(dt.timezone.utc)
            progress = open_runs.progress(cut, held, before, max_pages, patience, now, keywords)
            progress = load.write(progress, store.PROGRESS_TABLE)
            cut = open_runs.page_fates(cut.unionByName(held), progress, max_pages, keywords)
            resumed_items = items_of(held)
        fate = F.when(F.col("reason").isNull(), landed.FULL).when(F.col("reason") == open_runs.WAITS, landed.HELD)
        cut = load.write(cut.withColumn("fate", fate.otherwise(landed.SKIPPED)), store.CUT_TABLE, "fate")
        kept = of(cut, landed.FULL)
        held_items = items_of(of(cut, landed.HELD)) if patience is not None else 0
        skipped = of(cut, landed.SKIPPED).select("run_id", "keyword", "page", ingest.item_count().alias("n_items"), "reason")
        skipped = load.write(skipped, store.SKIPPED_TABLE)
        skipped_items = int(skipped.agg(F.sum("n_items")).first()[0] or 0)
    checked = load.write(ingest.ingest(kept), store.CHECKED_TABLE)
    written = load.append(ingest.valid_snapshots(checked))
    rejected = load.write(ingest.rejects(checked), store.REJECTS_TABLE).count()
    load.write(ingest.page_counts(checked), store.PAGE_COUNTS_TABLE)
    load.write(of(stored, landed.MALFORMED).select("line"), store.MALFORMED_TABLE)
    landed_items = int(obs.get["items"] or 0) + resumed_items
    if landed_items != written + rejected + skipped_items + held_items:
        raise RuntimeError(f"{landed_items} items landed or held before, "
                           f"{written} + {rejected} + {skipped_items} + {held_items} accounted for")
    counts = {"appended": written, "rejected": rejected, "malformed_pages": int(obs.get["malformed"] or 0),
              "skipped_items": skipped_items, "held_items": held_items}
    load.commit(**counts)
    return {"load_id": load.load_id, **counts}


def run(spark: SparkSession, landed_dir: str, warehouse: str,
        keywords: Sequence[str] | None = None, transforms: bool = True,
        max_pages: int | None = None, load_id: str | None = None) -> dict:
    """Landed pages -> validate -> append -> count -> marts -> checks.

    Loads all that landed unless ``keywords`` or ``max_pages`` ask for less.
    Ends normally, without touching the marts, when nothing valid came in.
    """
    config.configure(spark)
    store.bootstrap(spark, warehouse)
    result = load_pages(spark, landed.read_pages(spark, landed_dir), warehouse, keywords, max_pages, load_id)
    result["total"] = store.row_count(spark, warehouse)
    if transforms and result["appended"]:
        result["quality"] = transform(spark, warehouse)
    return result


def _changes(spark: SparkSession, warehouse: str, old: dict) -> tuple[dict, list[str]]:
    """The committed loads, and the days of those that are new, replaced or gone since ``old``."""
    loads = {i: {"attempt": r["attempt"], "days": r["days"]} for i, r in store.commits(spark, warehouse).items()}
    changed = [r[i] for i in old.keys() | loads.keys() if old.get(i) != loads.get(i) for r in (old, loads) if i in r]
    return loads, sorted({d for r in changed for d in r["days"]})


def transform(spark: SparkSession, warehouse: str, full: bool = False) -> list:
    """Bring the marts up to date with the committed loads, check them, then publish them.

    Only the days that changed are rebuilt (all of them the first time, or
    with ``full``): those that a new, replaced or vanished load touches, and
    those in which an item's first snapshot follows another one than before
    (see ``plans.refresh``). The rules are counted over what is rebuilt. If one
    fails, nothing is published and readers stay with the marts they had.
    """
    config.configure(spark)
    before = store.published(spark, warehouse)
    full = full or not before["n"]
    loads, touched = _changes(spark, warehouse, {} if full else before["loads"])
    if not full and not touched:
        return [Row(**r) for r in before["checks"]]

    version, made, rows = before["n"] + 1, {}, []
    days_of = {} if full else before["marts"]
    snap = store.read_snapshots(spark, warehouse, None if full else touched)
    stg = marts.stg_prices(snap)
    rows += quality.quality_report({"price_snapshots": snap, "stg_prices": stg}).collect()

    def write(name: str, mart: DataFrame, replaced: list[str]) -> DataFrame:
        if name in quality.RULES:
            mart, counted = quality.observed(name, mart)
        fresh = store.write_days(mart, warehouse, name, version)
        made[name] = {d: v for d, v in days_of.get(name, {}).items() if d not in replaced} | fresh
        if name in quality.RULES:
            rows.extend(counted())
        return store.read_days(spark, warehouse, name, fresh).drop(store.DAY)

    if full:
        days = touched
        write("price_carry", refresh.chained(refresh.closes(stg)), days)
        history = write("price_history", marts.price_history(stg), days)
    else:
        known = days_of.get("price_carry", {})
        carry = lambda of: store.read_days(spark, warehouse, "price_carry", of).drop(store.DAY)
        other = {d: v for d, v in known.items() if d not in touched}
        gone = carry({d: v for d, v in known.items() if d in touched})
        links = refresh.new_links(stg, carry(other), gone, config.checkpoint_dir(spark))
        followers = refresh.days_in(links.filter("NOT is_new"))
        days = sorted({*touched, *followers})
        fresh = write("price_carry", refresh.merged(links, carry({d: other[d] for d in followers})), days)
        again = marts.stg_prices(store.read_snapshots(spark, warehouse, days))
        history = write("price_history", refresh.history(again, fresh), days)
    write("item_days", marts.item_days(snap), touched)
    write("price_movers", marts.price_movers(history), days)
    write("category_summary", marts.category_summary(stg), touched)
    write("daily_deals", marts.daily_deals(history), days)
    quality.assert_rows(rows)
    store.publish(spark, warehouse, before, made, loads, [r.asDict() for r in rows])
    return rows  # 29, one per rule


def item_days(spark: SparkSession, warehouse: str) -> DataFrame:
    """``marts.item_days`` over all committed loads: as published, and from the
    snapshots for the days that changed since."""
    config.configure(spark)
    before = store.published(spark, warehouse)
    _, touched = _changes(spark, warehouse, before["loads"])
    known = {d: v for d, v in before["marts"].get("item_days", {}).items() if d not in touched}
    out = store.read_days(spark, warehouse, "item_days", known).drop(store.DAY)
    if touched:
        out = out.unionAll(marts.item_days(store.read_snapshots(spark, warehouse, touched)).select(*out.columns))
    return out


def status(spark: SparkSession, warehouse: str) -> DataFrame:
    """Total snapshots and unique items (latest rows); no raw snapshots are read of published days."""
    return marts.status_of_days(item_days(spark, warehouse))


def latest_snapshot(spark: SparkSession, warehouse: str) -> DataFrame:
    return marts.latest_of_days(item_days(spark, warehouse))


def register_views(spark: SparkSession, warehouse: str) -> list[str]:
    """Expose the warehouse to SQL: temp views over the snapshot table, the
    staging dataset, the latest snapshot and every mart (empty until it is built), so analyst
    SQL runs through ``spark.sql``. Mart views carry the partition column
    ``snapshot_day`` (DATE): filters on it prune whole day partitions."""
    config.configure(spark)
    snap = store.read_snapshots(spark, warehouse)
    views = {"price_snapshots": snap, "stg_prices": marts.stg_prices(snap),
             "latest_snapshot": latest_snapshot(spark, warehouse)}
    views |= {name: store.read_mart(spark, warehouse, name, keep_partition=True) for name in MART_NAMES}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def report(spark: SparkSession, warehouse: str, name: str, as_of=None) -> DataFrame:
    """R1-R4 over the stored marts: ``todays_drops``, ``todays_deals``,
    ``category_trend`` or ``fresh_drops``. "Today" is ``as_of`` or the newest
    day that was built, known from the publication record; only that day's
    files are read."""
    mart = lambda n: store.read_mart(spark, warehouse, n, keep_partition=True)
    if name == "category_trend":
        return reports.category_trend(mart("category_summary"))
    if name == "fresh_drops":
        return reports.fresh_drops(mart("daily_deals").drop("snapshot_day"))
    as_of = as_of or max(store.published(spark, warehouse)["marts"].get("price_history", {}), default=None)
    if name == "todays_drops":
        return reports.todays_drops(mart("price_movers"), as_of)
    if name == "todays_deals":
        return reports.todays_deals(mart("daily_deals"), as_of)
    raise ValueError(f"no such report: {name}")
