"""Snapshot table: bootstrap, append, counts, latest (store tests)."""

import datetime as dt
from decimal import Decimal

from helpers import T0, snapshot, snapshots_df, ten_records

from pricelens.plans import jobs
from pricelens.sources import store


def test_bootstrap_is_empty(spark, warehouse):
    store.bootstrap(spark, warehouse)
    assert store.row_count(spark, warehouse) == 0
    assert store.read_snapshots(spark, warehouse).columns[-1] == "scraped_at"


def test_insert_one_ten_empty_and_cumulative(spark, warehouse):
    assert store.append_snapshots(snapshots_df(spark, [snapshot()]), warehouse) == 1
    assert store.row_count(spark, warehouse) == 1
    assert store.append_snapshots(snapshots_df(spark, ten_records()), warehouse) == 10
    assert store.row_count(spark, warehouse) == 11
    assert store.append_snapshots(snapshots_df(spark, []), warehouse) == 0
    assert store.row_count(spark, warehouse) == 11


def test_latest_snapshot_one_row_per_item(spark, warehouse):
    store.append_snapshots(snapshots_df(spark, ten_records()), warehouse)
    assert jobs.latest_snapshot(spark, warehouse).count() == 10
    later = snapshot(at=T0 + dt.timedelta(days=1), price="1799")
    store.append_snapshots(snapshots_df(spark, [snapshot(), later]), warehouse)
    latest = jobs.latest_snapshot(spark, warehouse).filter("item_id = 'SKU-7'").collect()
    assert len(latest) == 1 and latest[0].current_price == Decimal("1799.00")
    st = jobs.status(spark, warehouse).first()
    assert (st.total_snapshots, st.unique_items) == (12, 10)  # SKU-7 is among the ten


def test_cents_kept(spark, warehouse):
    store.append_snapshots(snapshots_df(spark, [snapshot(price="1849.05", original="2466.10")]), warehouse)
    row = store.read_snapshots(spark, warehouse).first()
    assert row.current_price == Decimal("1849.05") and row.original_price == Decimal("2466.10")


def test_retried_load_is_not_duplicated(spark, warehouse):
    batch = snapshots_df(spark, ten_records())
    store.append_snapshots(batch, warehouse, load_id="load-1")
    store.append_snapshots(batch, warehouse, load_id="load-1")  # same load retried
    assert store.row_count(spark, warehouse) == 10
    store.append_snapshots(batch, warehouse, load_id="load-2")  # a new capture adds rows
    assert store.row_count(spark, warehouse) == 20


def test_retry_with_fewer_days_leaves_no_stale_day(spark, warehouse):
    two_days = [snapshot(), snapshot(at=T0 + dt.timedelta(days=1))]
    store.append_snapshots(snapshots_df(spark, two_days), warehouse, load_id="L1")
    assert store.append_snapshots(snapshots_df(spark, two_days[:1]), warehouse, load_id="L1") == 1
    assert [r.scraped_at.day for r in store.read_snapshots(spark, warehouse).collect()] == [T0.day]
    assert store.append_snapshots(snapshots_df(spark, []), warehouse, load_id="L1") == 0
    assert store.row_count(spark, warehouse) == 0


def test_mart_versions(spark, warehouse):
    from pricelens.plans import marts

    assert store.read_mart(spark, warehouse, "price_history").count() == 0  # never built
    for rows in (ten_records(), ten_records()[:3], []):
        history = marts.price_history(marts.stg_prices(snapshots_df(spark, rows)))
        store.write_mart(history, warehouse, "price_history")
        assert store.read_mart(spark, warehouse, "price_history").count() == len(rows)
    # a rebuild that fails midway changes nothing
    from pyspark.sql import functions as F
    import pytest
    bad = marts.price_history(marts.stg_prices(snapshots_df(spark, ten_records()))).withColumn(
        "item_id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception):
        store.write_mart(bad, warehouse, "price_history")
    assert store.read_mart(spark, warehouse, "price_history").count() == 0
