"""End-to-end jobs: run (ingest + append + marts + checks), transform,
status, and the incremental streaming load."""

import os

import pytest
from helpers import SF_SMALL

from pricelens.plans import jobs, quality
from pricelens.sources import store
from pricelens.sources.driver_tables import landed_pages_from_events
from pricelens.streaming.incremental import start_incremental_load

KEYWORDS = ["click", "view", "purchase", "signup", "error"]


@pytest.fixture()
def landing(spark, tmp_path):
    """Landed page documents (JSON lines) derived from the sf0.001 events."""
    target = str(tmp_path / "landing")
    landed_pages_from_events(spark, SF_SMALL).coalesce(2).write.text(target)
    return target


def test_run_end_to_end(spark, landing, warehouse):
    result = jobs.run(spark, landing, warehouse, keywords=KEYWORDS)
    assert result["appended"] > 0 and result["total"] == result["appended"]
    assert len(result["quality"]) == 29 and all(r.failures == 0 for r in result["quality"])
    for name in jobs.MART_NAMES:
        assert store.read_mart(spark, warehouse, name).count() > 0
    assert os.path.isdir(os.path.join(warehouse, "raw", "rejects"))
    counts = spark.read.parquet(os.path.join(warehouse, "raw", "page_counts"))
    assert counts.agg({"valid_records": "sum"}).first()[0] == result["appended"]
    st = jobs.status(spark, warehouse).first()
    assert st.total_snapshots == result["total"]
    # movers read back from the table equal a fresh computation
    assert store.read_mart(spark, warehouse, "price_movers").columns[0] == "snapshot_date"


def test_run_with_nothing_valid_ends_normally(spark, landing, warehouse):
    result = jobs.run(spark, landing, warehouse, keywords=["no-such-keyword"])
    assert result["appended"] == 0 and result["total"] == 0
    assert "quality" not in result


def test_everything_that_landed_is_accounted_for(spark, landing, warehouse):
    from pricelens.plans import ingest
    from pricelens.sources import landed

    items = ingest.explode_items(landed.read_pages(spark, landing)).count()
    whole = jobs.run(spark, landing, warehouse, transforms=False)
    assert whole["appended"] + whole["rejected"] == items and whole["skipped_items"] == 0
    cut = jobs.run(spark, landing, warehouse + "-2", ["click"], transforms=False, max_pages=2)
    assert cut["skipped_items"] > 0
    assert cut["appended"] + cut["rejected"] + cut["skipped_items"] == items


def test_first_run_has_empty_marts(spark, tmp_path, warehouse):
    """New items only: no movers, no deals, no category."""
    from helpers import item, page_doc, pages_df
    from pyspark.sql import functions as F

    items = [item(itemId=f"N{i}", name="new", price="5", itemUrl="u") for i in range(2)]
    pages = pages_df(spark, [page_doc("R1", "lamp", 1, items)])
    pages.select(F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})).write.text(
        str(tmp_path / "one"))
    result = jobs.run(spark, str(tmp_path / "one"), warehouse)
    assert result["appended"] == 2 and len(result["quality"]) == 29
    sizes = {n: store.read_mart(spark, warehouse, n).count() for n in jobs.MART_NAMES}
    assert sizes == {"price_history": 2, "price_movers": 0, "category_summary": 0, "daily_deals": 0}
    assert set(jobs.MART_NAMES) <= set(jobs.register_views(spark, warehouse))
    assert jobs.report(spark, warehouse, "todays_drops").count() == 0


@pytest.mark.parametrize("field, value", [("captured_at", "not a time"), ("page", "one")])
def test_a_malformed_page_has_one_fate(spark, tmp_path, warehouse, field, value):
    import json

    page = {"run_id": "R1", "keyword": "lamp", "page": 1, "captured_at": "2024-06-01T10:00:00Z",
            "mods": {"listItems": [{"itemId": "A", "name": "n", "price": "1", "itemUrl": "u"}]}}
    os.makedirs(tmp_path / "land")
    (tmp_path / "land" / "a.json").write_text(json.dumps(page) + "\n" + json.dumps({**page, field: value}) + "\n")
    result = jobs.run(spark, str(tmp_path / "land"), warehouse, transforms=False)
    assert (result["appended"], result["malformed_pages"]) == (1, 1)
    lines = spark.read.parquet(os.path.join(warehouse, "raw", "malformed_pages")).collect()
    assert [value in r.line for r in lines] == [True]


def test_stream_needs_a_lasting_checkpoint(spark, tmp_path, warehouse):
    from pricelens import config

    spark.conf.set(config.SCRATCH_FLAG, "true")  # as where no folder was named
    try:
        with pytest.raises(ValueError):
            start_incremental_load(spark, str(tmp_path), warehouse)
    finally:
        spark.conf.unset(config.SCRATCH_FLAG)


def test_stream_keeps_pages_of_one_run_in_two_files(spark, tmp_path, warehouse):
    import json

    land = tmp_path / "land"
    os.makedirs(land)
    for p in (1, 2):
        page = {"run_id": "R1", "keyword": "lamp", "page": p, "captured_at": "2024-06-01T10:00:00Z",
                "mods": {"listItems": [{"itemId": f"A{p}", "name": "n", "price": "1", "itemUrl": "u"}]}}
        (land / f"{p}.json").write_text(json.dumps(page) + "\n")
        start_incremental_load(spark, str(land), warehouse, str(tmp_path / "ckpt")).awaitTermination(180)
    assert store.row_count(spark, warehouse) == 2


def test_reports_over_the_warehouse(spark, landing, warehouse):
    jobs.run(spark, landing, warehouse)
    drops = jobs.report(spark, warehouse, "todays_drops")
    assert 0 < drops.count() <= 10
    plan = drops._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_day" in plan.partition("PartitionFilters")[2][:200]
    assert jobs.report(spark, warehouse, "todays_deals").count() > 0
    trend = jobs.report(spark, warehouse, "category_trend").count()
    assert trend == store.read_mart(spark, warehouse, "category_summary").count()
    assert jobs.report(spark, warehouse, "fresh_drops").columns[0] == "snapshot_date"


def test_quality_failure_raises(spark):
    from helpers import snapshot, snapshots_df
    from pyspark.sql import functions as F

    bad = snapshots_df(spark, [snapshot()]).withColumn("keyword", F.lit(None).cast("string"))
    report = quality.quality_report({"price_snapshots": bad})
    with pytest.raises(quality.QualityError):
        quality.assert_quality(report)


def test_incremental_stream_is_exactly_once(spark, landing, warehouse, tmp_path):
    ckpt = str(tmp_path / "ckpt")
    q = start_incremental_load(spark, landing, warehouse, ckpt, keywords=KEYWORDS)
    q.awaitTermination(180)
    first = store.row_count(spark, warehouse)
    assert first > 0
    # a second availableNow run sees no new files and appends nothing
    q2 = start_incremental_load(spark, landing, warehouse, ckpt, keywords=KEYWORDS)
    q2.awaitTermination(180)
    assert store.row_count(spark, warehouse) == first


def test_analyst_sql_over_views(spark, landing, warehouse):
    jobs.run(spark, landing, warehouse, keywords=KEYWORDS)
    names = jobs.register_views(spark, warehouse)
    assert {"price_movers", "daily_deals", "category_summary", "stg_prices"} <= set(names)
    day = spark.sql("SELECT max(snapshot_date) AS d FROM stg_prices").first().d
    drops = spark.sql(f"""
        SELECT product_name, prev_price, current_price, price_change_pct, item_url
        FROM price_movers
        WHERE snapshot_date = TIMESTAMP '{day}' AND price_direction = 'decreased'
        ORDER BY price_change_pct ASC LIMIT 10""").collect()
    assert 0 < len(drops) <= 10
    assert all(r.price_change_pct < 0 for r in drops)
    deals = spark.sql(f"""
        SELECT deal_rank, product_name, category, current_price, discount_pct, is_fresh_drop
        FROM daily_deals WHERE snapshot_date = TIMESTAMP '{day}' ORDER BY deal_rank""").collect()
    assert deals and deals[0].deal_rank == 1
    trend = spark.sql("""
        SELECT snapshot_date, category, avg_price, median_price
        FROM category_summary ORDER BY snapshot_date DESC, category""")
    assert trend.count() == store.read_mart(spark, warehouse, "category_summary").count()


def test_malformed_lines_are_kept_and_counted(spark, landing, warehouse):
    with open(os.path.join(landing, "part-bad.txt"), "w") as fh:
        fh.write("{not json\n")
        fh.write("plain text line\n")
    result = jobs.run(spark, landing, warehouse, keywords=KEYWORDS, transforms=False)
    assert result["malformed_pages"] == 2 and result["appended"] > 0
    bad = spark.read.parquet(os.path.join(warehouse, "raw", "malformed_pages")).collect()
    assert sorted(r.line for r in bad) == ["plain text line", "{not json"]
