"""Analyst reports: explicit day, default day, top-k cut and ordering."""

import datetime as dt
from decimal import Decimal

from helpers import T0, snapshot, snapshots_df

from pricelens.plans import marts, reports


def at(days, hours=0):
    return T0 + dt.timedelta(days=days, hours=hours)


def build(spark):
    rows = []
    # day 0 baseline, day 1 drops of 1..12 %, day 2 one drop
    for i in range(12):
        rows.append(snapshot(item_id=f"I{i:02d}", price="100", at=at(0)))
        rows.append(snapshot(item_id=f"I{i:02d}", price=str(100 - (i + 1)), at=at(1)))
    rows.append(snapshot(item_id="I00", price="50", at=at(2)))
    stg = marts.stg_prices(snapshots_df(spark, rows))
    hist = marts.price_history(stg)
    return stg, marts.price_movers(hist), marts.daily_deals(hist)


def test_todays_drops_explicit_day_and_top_k(spark):
    stg, movers, _ = build(spark)
    got = reports.todays_drops(movers, as_of="2024-06-02").collect()
    assert len(got) == 10
    assert [r.price_change_pct for r in got] == [-float(p) for p in range(12, 2, -1)]
    assert got[0].current_price == Decimal("88.00")


def test_default_day_is_latest_snapshot_day(spark):
    stg, movers, _ = build(spark)
    got = reports.todays_drops(movers, days=stg).collect()
    assert len(got) == 1 and got[0].current_price == Decimal("50.00")
    # without a day source the mart's own latest day is used
    assert reports.todays_drops(movers).count() == 1


def test_category_trend_and_fresh_drops(spark):
    stg, _, deals = build(spark)
    trend = reports.category_trend(marts.category_summary(stg))
    assert trend.columns == ["snapshot_date", "category", "avg_price", "median_price"]
    assert trend.first().snapshot_date == dt.datetime(2024, 6, 3)  # newest first
    assert reports.fresh_drops(deals).count() == deals.filter("is_fresh_drop").count()
