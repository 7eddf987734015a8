"""Marts: history, movers, category summary, deals (edge corpus + invariants)."""

import datetime as dt
from decimal import Decimal

import pytest
from helpers import SF_SMALL, T0, snapshot, snapshots_df
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricelens.plans import marts, reports
from pricelens.sources.driver_tables import snapshots_from_events


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def history_of(spark, rows, num_parts=None):
    return marts.price_history(marts.stg_prices(snapshots_df(spark, rows)), num_parts)


def test_history_directions_skip_zero_and_span_keywords(spark):
    rows = [
        snapshot(price="100", at=at(0)),
        snapshot(price="100", at=at(1)),                 # unchanged
        snapshot(price="0", at=at(2)),                   # dropped by staging, skipped by lag
        snapshot(price="90", at=at(3)),                  # decreased vs 100
        snapshot(price="95", keyword="notebook", at=at(3) + dt.timedelta(microseconds=1)),  # twin keyword
    ]
    h = history_of(spark, rows).orderBy("scraped_at").collect()
    assert [r.price_direction for r in h] == ["first_seen", "unchanged", "decreased", "increased"]
    assert h[2].prev_price == Decimal("100.00") and h[2].price_change_abs == Decimal("-10.00")
    assert h[2].price_change_pct == -10.0
    assert h[3].prev_price == Decimal("90.00")


def test_equal_timestamps_have_a_fixed_order(spark):
    rows = [snapshot(price="20", page=2, at=at(0)), snapshot(price="10", page=1, at=at(0))]
    h = history_of(spark, rows).collect()
    by_price = {r.current_price: r for r in h}
    assert by_price[Decimal("10.00")].price_direction == "first_seen"
    assert by_price[Decimal("20.00")].prev_price == Decimal("10.00")


def test_skew_safe_lag_with_hot_item(spark):
    # one item holds most rows; with many parts it is cut into chunks
    rows = [snapshot(item_id="HOT", price=str(100 + (i % 7)), at=at(0) + dt.timedelta(minutes=i))
            for i in range(300)]
    rows += [snapshot(item_id=f"C{i}", price="50", at=at(i)) for i in range(10)]
    stg = marts.stg_prices(snapshots_df(spark, rows))
    plain = stg.withColumn(
        "prev_price",
        F.lag("current_price").over(
            Window.partitionBy("item_id").orderBy("scraped_at", "page")),
    ).select("item_id", "scraped_at", "prev_price")
    for parts in (4, 64):
        got = marts.price_history(stg, parts, min_rows=1).select("item_id", "scraped_at", "prev_price")
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_movers_ties_all_kept(spark):
    rows = []
    for i in range(25):
        rows.append(snapshot(item_id=f"I{i:02d}", price="100", at=at(0)))
        rows.append(snapshot(item_id=f"I{i:02d}", price="90", at=at(1)))
    rows += [snapshot(item_id="UP", price="10", at=at(0)), snapshot(item_id="UP", price="11", at=at(1))]
    movers = marts.price_movers(history_of(spark, rows))
    dec = movers.filter("price_direction = 'decreased'").collect()
    assert len(dec) == 25 and {r.rank_within_direction for r in dec} == {1}
    assert movers.filter("price_direction = 'increased'").count() == 1


def test_deals_filter_then_latest_and_fresh_flag(spark):
    rows = [
        # qualifies early in the day, the later snapshot does not: the earlier is kept
        snapshot(item_id="A", price="60", original="100", discount=40.0, reviews=80, at=at(0)),
        snapshot(item_id="A", price="99", original="100", discount=1.0, reviews=80, at=at(5)),
        # discount just under 30 / reviews just under 50: excluded
        snapshot(item_id="B", price="70.01", original="100", discount=29.99, reviews=80, at=at(1)),
        snapshot(item_id="C", price="60", original="100", discount=40.0, reviews=49, at=at(1)),
        # fresh drop: -10 exactly qualifies, -9.99 does not
        snapshot(item_id="D", price="100", original="200", discount=50.0, reviews=60, at=at(0)),
        snapshot(item_id="D", price="90", original="200", discount=55.0, reviews=60, at=at(2)),
        snapshot(item_id="E", price="100", original="200", discount=50.0, reviews=60, at=at(0)),
        snapshot(item_id="E", price="90.01", original="200", discount=54.99, reviews=60, at=at(2)),
    ]
    deals = {r.item_id: r for r in marts.daily_deals(history_of(spark, rows)).collect()}
    assert set(deals) == {"A", "D", "E"}
    assert deals["A"].current_price == Decimal("60.00")
    assert deals["D"].is_fresh_drop is True and deals["E"].is_fresh_drop is False
    assert deals["D"].deal_rank == 1 and deals["E"].deal_rank == 2 and deals["A"].deal_rank == 3


def test_category_summary_values(spark):
    rows = [
        snapshot(item_id="A", price="1.00", discount=None, rating=4.0, reviews=10, at=at(0)),
        snapshot(item_id="A", price="1.01", discount=60.0, rating=float("nan"), reviews=None, at=at(1)),
        snapshot(item_id="B", price="3.00", discount=25.0, rating=None, reviews=5, at=at(2)),
        snapshot(item_id="Z", price="5.00", category="  ", at=at(2)),  # blank category dropped
    ]
    cat = marts.category_summary(marts.stg_prices(snapshots_df(spark, rows))).collect()
    assert len(cat) == 1
    r = cat[0]
    assert r.unique_items == 2 and r.median_price == 1.01 and r.avg_price == 1.67
    assert (r.min_price, r.max_price) == (Decimal("1.00"), Decimal("3.00"))
    assert r.avg_discount_pct == 28.33 and r.deep_discount_count == 1 and r.on_sale_count == 1
    assert r.avg_rating == 4.0 and r.total_reviews == 15


def test_invariants_on_driver_tables(spark):
    snap = snapshots_from_events(spark, SF_SMALL)
    stg = marts.stg_prices(snap)
    hist = marts.price_history(stg)
    assert hist.count() == stg.count() == 989
    first = hist.filter("price_direction = 'first_seen'").groupBy("item_id").count()
    assert first.filter("count != 1").count() == 0
    assert first.count() == stg.select("item_id").distinct().count()
    movers = marts.price_movers(hist)
    assert movers.count() == 946
    assert movers.groupBy("snapshot_date", "price_direction").agg(F.min("rank_within_direction").alias("m")) \
        .filter("m != 1").count() == 0
    assert marts.daily_deals(hist).count() == 238
    assert marts.category_summary(stg).count() == 531
    tiers = stg.groupBy("price_tier").count().agg(F.sum("count")).first()[0]
    assert tiers == stg.count()
    assert marts.latest_snapshot(snap).count() == 15
    assert reports.todays_drops(movers).count() <= 10


def test_staging_text_rules(spark):
    rows = [
        snapshot(item_id="A", name="  Laptop X  ", brand="  ", category=" Electronics ",
                 location="", keyword="  Gaming Monitor ", discount=None, reviews=None),
        snapshot(item_id="B", name="\tTabbed\t", brand="BrandB", price="0", at=at(1)),
        snapshot(item_id="C", name="C", price="-5", at=at(2)),
    ]
    stg = marts.stg_prices(snapshots_df(spark, rows)).collect()
    assert [r.item_id for r in stg] == ["A"]  # zero and negative prices dropped
    r = stg[0]
    assert r.product_name == "Laptop X" and r.brand is None and r.category == "Electronics"
    assert r.location is None and r.keyword == "gaming monitor"
    assert r.discount_pct == 0.0 and r.review_count == 0 and r.price_tier == "full_price"
    assert r.snapshot_date == dt.datetime(2024, 6, 1) and r.snapshot_hour == 10
    tab = marts.stg_prices(snapshots_df(spark, [snapshot(name="\tTabbed\t")])).first()
    assert tab.product_name == "\tTabbed\t"  # tabs are not trimmed


def _hot_snapshots(spark, n):
    """One item has three quarters of the captures; some share a capture time."""
    from pyspark.sql import functions as F

    i = F.col("id")
    price = (100 + F.pmod(F.xxhash64("id"), F.lit(5000)) / 100).cast("decimal(12,2)")
    return spark.range(0, n, 1, 8).select(
        F.when(i % 4 > 0, F.lit("HOT")).otherwise(F.concat(F.lit("I"), (i % 97).cast("string"))).alias("item_id"),
        F.lit("x").alias("name"), price.alias("current_price"), F.lit(None).cast("decimal(12,2)").alias("original_price"),
        F.lit(0.0).alias("discount_pct"), F.lit("b").alias("brand"), F.lit("cat").alias("category"),
        i.cast("string").alias("item_url"), F.lit(1.0).alias("rating"), F.lit(1).alias("review_count"),
        F.lit("l").alias("location"), F.lit("k").alias("keyword"), F.lit(1).alias("page"),
        F.timestamp_seconds(1717200000 + F.floor(i / 3) % 250000).alias("scraped_at"))


def _wrong_lags(history, plain):
    pairs = history.join(plain, ["item_url"])
    return pairs.filter(~pairs["prev_price"].eqNullSafe(pairs["want"])).count()


@pytest.mark.parametrize("rows, min_rows, reuse", [
    (300_000, 1, "true"), (300_000, 1, "false"), (4_000_000, marts.config.HOT_KEY_MIN_ROWS, "true")])
def test_hot_item_equals_the_plain_window(spark, rows, min_rows, reuse):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    stg = marts.stg_prices(_hot_snapshots(spark, rows))
    w = Window.partitionBy("item_id").orderBy("scraped_at", *marts.STG_TIE)
    plain = stg.select("item_url", F.lag("current_price").over(w).alias("want"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        history = marts.price_history(stg, num_parts=8, min_rows=min_rows)
        assert "chunk" in history._jdf.queryExecution().analyzed().toString()  # the split plan
        assert _wrong_lags(history.select("item_url", "prev_price"), plain) == 0  # pruned
        if rows <= 300_000:
            assert _wrong_lags(history, plain) == 0
            cats = [marts.category_summary(stg, 8, m).orderBy("snapshot_date").collect() for m in (min_rows, 10**9)]
            assert cats[0] == cats[1]
            movers = marts.price_movers(history)
            want = marts.price_movers(marts.price_history(stg, 8, 10**9))
            assert movers.exceptAll(want).isEmpty() and movers.count() == want.count()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_a_hot_null_key_is_split_too(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from pricelens.operators.ordered import exact_median, skew_safe_lag

    df = spark.range(5000).select(F.when(F.col("id") % 5 == 0, F.lit("a")).alias("k"),
                                  F.xxhash64("id").alias("t"), F.col("id").alias("v"))
    got = skew_safe_lag(df, "k", ["t"], "v", "p", 8, min_rows=1)
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    assert got.exceptAll(want).isEmpty()
    med = exact_median(df, ["k"], "v", "m", 8, min_rows=1)
    assert med.exceptAll(df.groupBy("k").agg(F.percentile("v", F.lit(0.5)).alias("m"))).isEmpty()
