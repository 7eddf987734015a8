"""Landed pages -> listings -> validated records / rejects."""

import datetime as dt
from decimal import Decimal

from helpers import T0, item, page_doc, pages_df

from pricelens.plans import ingest


def sample_item(**over):
    base = dict(itemId="SKU-7", name="Desk Lamp", price="₱1,849.50", originalPrice="₱2,466",
                brandName="Lumo", categoryName="Lighting", itemUrl="//shop.example/SKU-7",
                image="//img.example/1.jpg", ratingScore="3.9", review="58", location="Quezon City")
    base.update(over)
    return item(**base)


def test_page_prefix_rules(spark):
    docs = [
        # page 2 failed: page 3 is dropped although it has items
        page_doc("R1", "laptop", 1, [sample_item()]),
        page_doc("R1", "laptop", 2, [], failed=True),
        page_doc("R1", "laptop", 3, [sample_item()]),
        # page 1 empty: nothing kept
        page_doc("R1", "phone", 1, []),
        page_doc("R1", "phone", 2, [sample_item()]),
        # cap of 3 pages
        *[page_doc("R1", "tv", p, [sample_item()]) for p in (1, 2, 3, 4)],
        # page 2 missing entirely
        page_doc("R1", "cam", 1, [sample_item()]),
        page_doc("R1", "cam", 3, [sample_item()]),
        # listItems NULL inside mods
        ("R1", "pad", 1, T0, (None,)),
    ]
    kept = ingest.page_prefix(pages_df(spark, docs), 3).select("keyword", "page").collect()
    assert sorted(map(tuple, kept)) == [("cam", 1), ("laptop", 1), ("tv", 1), ("tv", 2), ("tv", 3)]
    # the cap is a parameter
    kept2 = ingest.page_prefix(pages_df(spark, docs), max_pages=1).filter("keyword = 'tv'").count()
    assert kept2 == 1


def test_explode_positions_and_timestamps(spark):
    docs = [page_doc("R1", "laptop", 1, [sample_item(itemId=f"I{i}") for i in range(3)])]
    items = ingest.explode_items(pages_df(spark, docs))
    assert [(r.pos, r.item.itemId) for r in items.orderBy("pos").collect()] == [(0, "I0"), (1, "I1"), (2, "I2")]
    checked = ingest.check(ingest.map_listings(items)).orderBy("pos").collect()
    assert [r.scraped_at - T0.replace(tzinfo=None) for r in checked] == [
        dt.timedelta(microseconds=i) for i in range(3)]


def test_listing_map_fallbacks_and_urls(spark):
    its = [
        sample_item(itemId=None, nid="N1"),
        sample_item(name="", title="Title Only"),
        sample_item(price="", priceShow="₱99"),
        sample_item(itemUrl="https://shop.example/x"),
        sample_item(itemUrl=None, image=None),
    ]
    rows = ingest.map_listings(ingest.explode_items(pages_df(spark, [page_doc("R1", "laptop", 1, its)])))
    r = rows.orderBy("pos").collect()
    assert r[0].item_id == "N1"
    assert r[1].name == "Title Only"
    assert r[2].price == "₱99"
    assert r[0].item_url == "https://shop.example/SKU-7" and r[0].image_url == "https://img.example/1.jpg"
    assert r[3].item_url == "https://shop.example/x"
    assert r[4].item_url == "" and r[4].image_url == ""
    assert r[0].keyword == "laptop" and r[0].page == 1


def checked_rows(spark, items):
    pages = pages_df(spark, [page_doc("R1", "laptop", 1, items)])
    return ingest.check(ingest.listings(pages)).orderBy("pos").collect()


def test_from_raw_accept_and_reject(spark):
    rows = checked_rows(spark, [
        sample_item(),
        sample_item(itemId=None),
        sample_item(price=None),
        item(),
        sample_item(price="NOT_A_PRICE"),
        sample_item(originalPrice="NaN"),
        sample_item(originalPrice="abc"),
        sample_item(price="₱12,345,678,901"),
        sample_item(review="12345678901"),
        sample_item(price="Infinity"),
        sample_item(name="   "),
        sample_item(originalPrice="0"),
        sample_item(price="-5"),
    ])
    ok = rows[0]
    assert ok.reason is None
    assert ok.current_price == Decimal("1849.50") and ok.original_price == Decimal("2466.00")
    assert ok.discount_pct == 25.0 and ok.rating == 3.9 and ok.review_count == 58
    assert [r.reason for r in rows[1:]] == [
        "missing item_id", "missing price", "missing item_id", "unparseable current_price",
        "non-finite original_price", None, "current_price out of range",
        "review_count out of range", "non-finite current_price", None, None, None,
    ]
    assert rows[6].original_price is None and rows[6].discount_pct is None
    assert rows[10].name == "   "  # blanks are not missing
    assert rows[11].original_price is None  # zero original is no original
    assert rows[12].current_price == Decimal("-5.00")  # stored; staging drops it


def test_missing_capture_time_is_stamped_now(spark):
    docs = [page_doc("R1", "laptop", 1, [sample_item()], captured_at=None)]
    docs[0] = page_doc("R1", "laptop", 1, [sample_item(), sample_item(), sample_item()], captured_at=None)
    rows = ingest.check(ingest.listings(pages_df(spark, docs))).orderBy("pos").collect()
    steps = [b.scraped_at - a.scraped_at for a, b in zip(rows, rows[1:])]
    assert steps == [dt.timedelta(microseconds=1)] * 2


def test_valid_and_rejects_split(spark):
    pages = pages_df(spark, [page_doc("R1", "laptop", 1, [sample_item(), sample_item(price="N/A")])])
    checked = ingest.check(ingest.listings(pages))
    valid = ingest.valid_snapshots(checked)
    assert valid.columns[:3] == ["item_id", "name", "current_price"] and valid.count() == 1
    rej = ingest.rejects(checked).collect()
    assert [(r.pos, r.reason) for r in rej] == [(1, "unparseable current_price")]
    counts = ingest.page_counts(checked).first()
    assert (counts.valid_records, counts.rejected_records) == (1, 1)


def test_keyword_selection_and_union(spark):
    docs = [page_doc("R1", kw, 1, [sample_item()]) for kw in ("laptop", "smartphone", "toaster")]
    lst = ingest.listings(pages_df(spark, docs))
    assert ingest.keyword_filter(lst).count() == 3  # all that landed
    assert ingest.keyword_filter(lst, ["toaster"]).count() == 1
    both = ingest.union_keywords([ingest.keyword_filter(lst, ["laptop", "toaster"]),
                                  ingest.keyword_filter(lst, ["toaster"])])
    assert both.count() == 3  # duplicates kept


def test_not_null_guard_fails_on_null(spark):
    import pytest
    from helpers import snapshot, snapshots_df

    bad = snapshots_df(spark, [snapshot()]).selectExpr("item_id", "CAST(NULL AS STRING) AS name", "*").drop("name")
    good = snapshots_df(spark, [snapshot()])
    assert ingest.not_null_guard(good).count() == 1
    from pyspark.sql import functions as F
    with pytest.raises(Exception):
        ingest.not_null_guard(good.withColumn("keyword", F.lit(None).cast("string"))).collect()
    assert bad is not None


def test_long_keyword_list(spark):
    docs = [page_doc("R1", kw, 1, [sample_item()]) for kw in ("laptop", "toaster")]
    lst = ingest.listings(pages_df(spark, docs))
    many = [f"kw{i}" for i in range(200)] + ["toaster"]
    out = ingest.keyword_filter(lst, many)
    assert [r.keyword for r in out.collect()] == ["toaster"]
    assert out.columns == lst.columns


def test_page_prefix_with_null_run_and_duplicates(spark):
    docs = [
        page_doc(None, "laptop", 1, [sample_item()]),
        page_doc(None, "laptop", 2, [sample_item()]),
        page_doc("R2", "laptop", 1, [sample_item()]),
        page_doc("R2", "laptop", 1, [sample_item()]),  # landed twice: both kept
        page_doc("R2", "laptop", 3, [sample_item()]),
    ]
    kept = ingest.page_prefix(pages_df(spark, docs), 3).select("run_id", "page").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(None, 1), (None, 2), ("R2", 1), ("R2", 1)], key=str)


def test_all_pages_are_read_unless_a_cut_is_asked_for(spark):
    docs = [page_doc("R1", "tv", p, [sample_item()]) for p in (1, 3, 4)] + [page_doc("R1", "cam", 1, [sample_item()])]
    pages = pages_df(spark, docs)
    assert ingest.ingest(pages).count() == 4
    assert ingest.ingest(pages, ["tv"], max_pages=3).count() == 1
    skipped = ingest.skipped_pages(pages, ["tv"], max_pages=3).collect()
    assert sorted((r.keyword, r.page, r.n_items, r.reason) for r in skipped) == [
        ("cam", 1, 1, "keyword not chosen"), ("tv", 3, 1, "after a missing page"), ("tv", 4, 1, "beyond the page cap")]
