"""Map the driver's test tables onto price snapshots and landed pages.

The test data has no price-listing table; ``events`` carries it: ``ts`` is
unique, it spans 30 days and each ``user_id`` becomes one item, so the price
history has no ties. ``part`` and ``nation`` supply names, brands, categories
and locations. The mapping (fixed values; the oracle SQL mirrors it):

* cents  = round(value * 100)
* current cents  = 0 when event_id % 97 = 0, else cents
* original cents = NULL when event_id % 13 = 0,
                   else cents * (100 + 12 * (event_id % 11)) div 100
* item_id 'ITEM' || lpad(user_id, 5, '0'); part on p_partkey = user_id;
  nation on n_nationkey = user_id % 25
* name '  ' || p_name || ' '; brand p_brand; category ' ' when
  event_id % 17 = 0 else p_type; location n_name;
  keyword ' ' || upper(event_type); item_url 'https://shop.example/i' || user_id
* rating NULL when event_id % 23 = 0 else (event_id % 41) / 10;
  review_count NULL when event_id % 19 = 0 else event_id % 200;
  page 1 + event_id % 3; scraped_at ts
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions import columns as X
from pricelens.operators.dimension import join_dimension
from pricelens.schema import ITEM_FIELDS, SNAPSHOT_COLUMNS

NATION_COUNT = 25

# Declared schemas of the driver tables we read: no footer-inference job per
# read, and a changed file fails loudly instead of shifting types.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _price(cents_col) -> F.Column:
    return (cents_col.cast("double") / 100).cast(X.PRICE_DECIMAL)


def priced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the integer price columns of the mapping."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )
    eid, cents = F.col("event_id"), F.col("cents")
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        F.when(eid % 97 == 0, F.lit(0).cast("bigint")).otherwise(cents).alias("cur_c"),
        F.when(eid % 13 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.expr("(cents * (100 + 12 * (event_id % 11))) div 100"))
        .alias("orig_c"),
    )


def with_catalog(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    """Attach part and nation attributes to each event."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = join_dimension(events, part, events["user_id"] == part["p_partkey"])
    return join_dimension(joined, nation, (F.col("user_id") % NATION_COUNT) == F.col("n_nationkey"))


def snapshots_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``price_snapshots`` table derived from events/part/nation."""
    e = with_catalog(spark, sf_dir, priced_events(spark, sf_dir))
    eid = F.col("event_id")
    uid = F.col("user_id").cast("string")
    out = e.select(
        F.concat(F.lit("ITEM"), F.lpad(uid, 5, "0")).alias("item_id"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("name"),
        _price(F.col("cur_c")).alias("current_price"),
        _price(F.nullif(F.col("orig_c"), F.lit(0))).alias("original_price"),
        X.discount_ratio(F.col("cur_c"), F.col("orig_c")).alias("discount_ratio"),
        F.col("p_brand").alias("brand"),
        F.when(eid % 17 == 0, F.lit(" ")).otherwise(F.col("p_type")).alias("category"),
        F.concat(F.lit("https://shop.example/i"), uid).alias("item_url"),
        F.when(eid % 23 == 0, F.lit(None).cast("double"))
        .otherwise((eid % 41).cast("double") / 10).alias("rating"),
        F.when(eid % 19 == 0, F.lit(None).cast("int"))
        .otherwise((eid % 200).cast("int")).alias("review_count"),
        F.col("n_name").alias("location"),
        F.concat(F.lit(" "), F.upper(F.col("event_type"))).alias("keyword"),
        (1 + eid % 3).cast("int").alias("page"),
        F.col("ts").cast("timestamp").alias("scraped_at"),
    )
    # rounded in its own projection (see functions.columns.with_discount)
    out = out.withColumn("discount_pct", X.round2_even("discount_ratio"))
    return out.select(*SNAPSHOT_COLUMNS)


# ---------------------------------------------------------------------------
# Landed catalog pages derived from events (fixed values; the oracle mirrors)
# ---------------------------------------------------------------------------
# A run is 250 consecutive event ids; keyword = event_type; page =
# 1 + event_id % 5, so a page document holds a bounded number of items.
# Page 2 of runs with run_no % 7 = 3 failed (no payload); page 1 of runs with
# run_no % 11 = 5 came back empty. Field formats vary with event_id:
#   price by event_id % 6: 0 '₱1,234.50', 1 '1234.50', 2 '₱<NBSP>1234.50<SP>',
#     3 '' with priceShow '₱1234.50', 4 'N/A', 5 NULL with priceShow '1234.50'
#   itemId NULL with nid set when % 29 = 0; itemId '' when % 31 = 0
#   name '' with title when % 37 = 0; name NULL when % 43 = 0
#   originalPrice 'NaN' when % 47 = 0, 'abc' when % 53 = 0, else '₱1,234.50'
#   itemUrl '' when % 59 = 0, protocol-relative when even
#   ratingScore 'N/A' when % 23 = 0; review '(n)' when % 7 = 0, NULL when % 19 = 0
RUN_SIZE = 250
PAGES_PER_RUN = 5


def landed_pages_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text line per page document (column ``value``), as the
    capture would land them."""
    e = with_catalog(spark, sf_dir, priced_events(spark, sf_dir))
    eid = F.col("event_id")
    uid = F.lpad(F.col("user_id").cast("string"), 5, "0")
    cur = _price(F.col("cur_c")).cast("string")
    cur_fmt = F.format_number(_price(F.col("cur_c")), 2)
    orig_fmt = F.format_number(_price(F.col("orig_c")), 2)
    null = F.lit(None).cast("string")
    kind = eid % 6
    item = F.struct(
        F.when(eid % 29 == 0, null).when(eid % 31 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("ITEM"), uid)).alias("itemId"),
        F.when(eid % 29 == 0, F.concat(F.lit("ITEM"), uid)).alias("nid"),
        F.when(eid % 37 == 0, F.lit("")).when(eid % 43 == 0, null)
        .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("name"),
        F.when(eid % 37 == 0, F.col("p_name")).alias("title"),
        F.when(kind == 0, F.concat(F.lit("₱"), cur_fmt))
        .when(kind == 1, cur)
        .when(kind == 2, F.concat(F.lit("₱\u00a0"), cur, F.lit(" ")))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.lit("N/A"))
        .alias("price"),
        F.when(kind == 3, F.concat(F.lit("₱"), cur)).when(kind == 5, cur).alias("priceShow"),
        F.when(F.col("orig_c").isNull(), null).when(eid % 47 == 0, F.lit("NaN"))
        .when(eid % 53 == 0, F.lit("abc"))
        .otherwise(F.concat(F.lit("₱"), orig_fmt)).alias("originalPrice"),
        F.col("p_brand").alias("brandName"),
        F.when(eid % 17 == 0, F.lit(" ")).otherwise(F.col("p_type")).alias("categoryName"),
        F.when(eid % 59 == 0, F.lit(""))
        .when(eid % 2 == 0, F.concat(F.lit("//shop.example/i"), F.col("user_id").cast("string")))
        .otherwise(F.concat(F.lit("https://shop.example/i"), F.col("user_id").cast("string")))
        .alias("itemUrl"),
        F.concat(F.lit("//img.example/"), uid, F.lit(".jpg")).alias("image"),
        F.when(eid % 23 == 0, F.lit("N/A"))
        .otherwise(((eid % 41).cast("double") / 10).cast("string")).alias("ratingScore"),
        F.when(eid % 19 == 0, null)
        .when(eid % 7 == 0, F.concat(F.lit("("), (eid % 200).cast("string"), F.lit(")")))
        .otherwise((eid % 200).cast("string")).alias("review"),
        F.col("n_name").alias("location"),
    )
    run_no = F.floor(eid / RUN_SIZE)
    docs = e.select(
        run_no.alias("run_no"),
        F.col("event_type").alias("keyword"),
        (1 + eid % PAGES_PER_RUN).cast("int").alias("page"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.struct(eid.alias("event_id"), item.alias("item")).alias("entry"),
    ).groupBy("run_no", "keyword", "page").agg(
        F.min("ts").alias("captured_at"),
        F.array_sort(F.collect_list("entry")).alias("entries"),
    )
    failed = (F.col("run_no") % 7 == 3) & (F.col("page") == 2)
    empty = (F.col("run_no") % 11 == 5) & (F.col("page") == 1)
    items = F.transform("entries", lambda x: x["item"])
    item_array = "array<struct<" + ",".join(f"{f}:string" for f in ITEM_FIELDS) + ">>"
    mods = F.when(failed, F.lit(None)).otherwise(
        F.struct(F.when(empty, F.array().cast(item_array)).otherwise(items).alias("listItems"))
    )
    page_doc = F.struct(
        F.concat(F.lit("R"), F.lpad(F.col("run_no").cast("string"), 6, "0")).alias("run_id"),
        F.col("keyword"),
        F.col("page"),
        F.col("captured_at"),
        mods.alias("mods"),
    )
    return docs.select(F.to_json(page_doc, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"))


def with_bad_lines(pages: DataFrame) -> DataFrame:
    """Landed text in which some lines cannot be read (fixed rules; the oracle mirrors).

    By run_no: % 13 = 4 breaks the time of page 2, % 17 = 6 the number of
    page 3, % 19 = 8 the line of page 1 as a whole.
    """
    line = F.col("value")
    run = F.substring(F.get_json_object(line, "$.run_id"), 2, 6).cast("int")
    page = F.get_json_object(line, "$.page").cast("int")
    return pages.select(
        F.when((run % 13 == 4) & (page == 2), F.regexp_replace(line, '"captured_at":"[^"]*"', '"captured_at":"not a time"'))
        .when((run % 17 == 6) & (page == 3), F.regexp_replace(line, '"page":3', '"page":"three"'))
        .when((run % 19 == 8) & (page == 1), F.substring(line, 1, 40))
        .otherwise(line).alias("value"))
