"""Explicit schemas: landed catalog page, raw listing, stored snapshot."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# One item object of a catalog page. Every value is read as text: a JSON
# number arrives as its literal text, so numeric and textual prices share
# one parser and a type surprise becomes a reject instead of a failed run.
ITEM_FIELDS = [
    "itemId", "nid", "name", "title", "price", "priceShow", "originalPrice",
    "brandName", "categoryName", "itemUrl", "image", "ratingScore", "review",
    "location",
]
ITEM = T.StructType([T.StructField(f, S, True) for f in ITEM_FIELDS])

# A landed page document: our envelope (run, keyword, page, capture time)
# around the catalog payload ``mods.listItems``.
PAGE = T.StructType([
    T.StructField("run_id", S, True),
    T.StructField("keyword", S, True),
    T.StructField("page", T.IntegerType(), True),
    T.StructField("captured_at", T.TimestampType(), True),
    T.StructField("mods", T.StructType([
        T.StructField("listItems", T.ArrayType(ITEM, True), True),
    ]), True),
])

# Loosely typed listing after field mapping (all text but keyword/page).
LISTING_COLUMNS = [
    "item_id", "name", "price", "original_price", "brand", "category",
    "item_url", "image_url", "rating", "review_count", "location",
    "keyword", "page",
]

# The append-only snapshot table; column order is the table order.
SNAPSHOT = T.StructType([
    T.StructField("item_id", S, False),
    T.StructField("name", S, False),
    T.StructField("current_price", T.DecimalType(12, 2), False),
    T.StructField("original_price", T.DecimalType(12, 2), True),
    T.StructField("discount_pct", T.DoubleType(), True),
    T.StructField("brand", S, True),
    T.StructField("category", S, True),
    T.StructField("item_url", S, False),
    T.StructField("rating", T.DoubleType(), True),
    T.StructField("review_count", T.IntegerType(), True),
    T.StructField("location", S, True),
    T.StructField("keyword", S, False),
    T.StructField("page", T.IntegerType(), False),
    T.StructField("scraped_at", T.TimestampType(), False),
])
SNAPSHOT_COLUMNS = SNAPSHOT.names
REQUIRED_COLUMNS = [f.name for f in SNAPSHOT.fields if not f.nullable]

# Tie-break tail appended to every order-sensitive window over snapshots,
# so equal capture times still give one deterministic order.
RAW_TIE = ["page", "keyword", "current_price", "item_url", "name"]
STG_TIE = ["page", "keyword", "current_price", "item_url", "product_name"]

STG_COLUMNS = [
    "item_id", "product_name", "current_price", "original_price",
    "discount_pct", "brand", "category", "item_url", "rating",
    "review_count", "location", "keyword", "page", "scraped_at",
    "snapshot_date", "snapshot_hour", "price_tier",
]

HISTORY_COLUMNS = [
    "item_id", "product_name", "brand", "category", "keyword",
    "current_price", "original_price", "discount_pct", "price_tier",
    "prev_price", "price_change_abs", "price_change_pct", "price_direction",
    "rating", "review_count", "location", "item_url", "snapshot_date",
    "scraped_at",
]

MOVERS_COLUMNS = [
    "snapshot_date", "item_id", "product_name", "brand", "category",
    "keyword", "prev_price", "current_price", "price_change_abs",
    "price_change_pct", "price_direction", "discount_pct", "rating",
    "review_count", "item_url", "rank_within_direction",
]

CATEGORY_COLUMNS = [
    "snapshot_date", "category", "keyword", "unique_items", "avg_price",
    "median_price", "min_price", "max_price", "avg_discount_pct",
    "deep_discount_count", "on_sale_count", "avg_rating", "total_reviews",
]

DEALS_COLUMNS = [
    "snapshot_date", "deal_rank", "item_id", "product_name", "brand",
    "category", "keyword", "current_price", "original_price",
    "discount_pct", "price_tier", "price_change_pct", "is_fresh_drop",
    "rating", "review_count", "location", "item_url", "scraped_at",
]

LATEST_COLUMNS = [
    "item_id", "name", "current_price", "original_price", "discount_pct",
    "brand", "category", "scraped_at",
]


# Declared types of every stored mart, so that an empty one reads as empty.
_D, _N, _B = T.DecimalType(12, 2), T.DoubleType(), T.LongType()
_CHANGE = T.DecimalType(13, 2)
_MART_TYPES = {
    "snapshot_date": T.TimestampType(), "scraped_at": T.TimestampType(), "current_price": _D,
    "original_price": _D, "prev_price": _D, "min_price": _D, "max_price": _D, "price_change_abs": _CHANGE,
    "price_change_pct": _N, "discount_pct": _N, "rating": _N, "avg_price": _N, "median_price": _N,
    "avg_discount_pct": _N, "avg_rating": _N, "review_count": T.IntegerType(), "rank_within_direction": _B,
    "deal_rank": _B, "unique_items": _B, "deep_discount_count": _B, "on_sale_count": _B, "total_reviews": _B,
    "is_fresh_drop": T.BooleanType(),
}


def _mart(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, _MART_TYPES.get(n, S), True) for n in columns])


# Each item's last price of a day and the one it had before that day.
CARRY_COLUMNS = ["item_id", "snapshot_date", "close", "prev_close"]
_MART_TYPES |= {"close": _D, "prev_close": _D}

# Each item's latest raw snapshot of a day, and how many it has there.
ITEM_DAY_COLUMNS = ["snapshot_date", *LATEST_COLUMNS, "n_snapshots"]
_MART_TYPES |= {"n_snapshots": _B}

MART_SCHEMAS = {
    "price_carry": _mart(CARRY_COLUMNS),
    "item_days": _mart(ITEM_DAY_COLUMNS),
    "price_history": _mart(HISTORY_COLUMNS),
    "price_movers": _mart(MOVERS_COLUMNS),
    "category_summary": _mart(CATEGORY_COLUMNS),
    "daily_deals": _mart(DEALS_COLUMNS),
}
