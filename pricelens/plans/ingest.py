"""Ingest: landed page documents -> validated snapshots + rejects.

    pages -(S2 prefix)-> kept pages -(S1 explode)-> items -(P1-P5 map)->
    listings -(S3 keywords)-> -(P6-P12 parse, V1-V2 validate)-> checked
    checked -> valid snapshots (S8/S9, table schema)  |  rejects (V5)

Everything is a per-row expression except the page prefix rule, which needs
the pages of one (run, keyword): a bounded aggregate over page documents
joined back to them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions import columns as X
from pricelens.schema import ITEM_FIELDS, LISTING_COLUMNS, REQUIRED_COLUMNS, SNAPSHOT_COLUMNS

c = F.col
LINEAGE = ["run_id", "keyword", "page", "pos"]
CHECKED_COLUMNS = ["run_id", "pos", *SNAPSHOT_COLUMNS, "reason"]
# Why a page is left out.
NOT_CHOSEN, BEYOND_CAP, AFTER_GAP = "keyword not chosen", "beyond the page cap", "after a missing page"


def item_count() -> Column:
    """Items on a page document; a failed (NULL) payload counts as 0."""
    return F.coalesce(F.size(c("mods.listItems")), F.lit(0))


def page_prefix(pages: DataFrame, max_pages: int) -> DataFrame:
    """Per (run, keyword) keep pages 1..k, where k is the last page before
    the first failed, empty or missing one, and k <= ``max_pages``.

    The pages present per (run, keyword) are gathered with ``collect_set``
    over non-empty pages within the cap, so each group's buffer holds at most
    ``max_pages`` numbers and combines map-side: duplicated landings of one
    run do not pile up in a task. The prefix length is then joined back
    (null-safe on run and keyword); the joined side has one row per group.
    The pages it leaves out are listed by ``skipped_pages``.
    """
    nonempty = pages.filter(
        (c("page") >= 1) & (c("page") <= max_pages) & (item_count() > 0)
    )
    present = nonempty.groupBy("run_id", "keyword").agg(F.collect_set("page").alias("__pages"))
    prefix = F.aggregate(
        F.sequence(F.lit(1), F.lit(max_pages)), F.lit(0),
        lambda k, p: F.when((k == p - 1) & F.array_contains(c("__pages"), p), p).otherwise(k),
    )
    limits = present.select(
        c("run_id").alias("__run"), c("keyword").alias("__kw"), prefix.alias("__k")
    )
    joined = nonempty.join(
        limits,
        nonempty["run_id"].eqNullSafe(limits["__run"]) & nonempty["keyword"].eqNullSafe(limits["__kw"]),
    )
    return joined.filter(c("page") <= c("__k")).select(*pages.columns)


def explode_items(pages: DataFrame) -> DataFrame:
    """One row per item of ``mods.listItems`` with its position; NULL or
    empty payloads yield no rows."""
    return pages.select(
        "run_id", "keyword", "page", "captured_at",
        F.posexplode(c("mods.listItems")).alias("pos", "item"),
    )


def map_listings(items: DataFrame) -> DataFrame:
    """Loosely typed listing fields (all text but keyword and page).

    ``a or b`` falls through NULL and the empty string; URLs that start with
    ``//`` get ``https:``; a missing URL reads as ''.
    """
    i = lambda f: c("item")[f]
    return items.select(
        "run_id", "pos", "captured_at",
        F.coalesce(F.nullif(i("itemId"), F.lit("")), F.nullif(i("nid"), F.lit("")), F.lit("")).alias("item_id"),
        F.coalesce(F.nullif(i("name"), F.lit("")), i("title")).alias("name"),
        F.coalesce(F.nullif(i("price"), F.lit("")), i("priceShow")).alias("price"),
        i("originalPrice").alias("original_price"),
        i("brandName").alias("brand"),
        i("categoryName").alias("category"),
        X.repair_url(F.coalesce(i("itemUrl"), F.lit(""))).alias("item_url"),
        X.repair_url(F.coalesce(i("image"), F.lit(""))).alias("image_url"),
        i("ratingScore").alias("rating"),
        i("review").alias("review_count"),
        i("location").alias("location"),
        F.coalesce(c("keyword"), F.lit("")).alias("keyword"),
        F.coalesce(c("page"), F.lit(1)).alias("page"),
    ).select("run_id", "pos", "captured_at", *LISTING_COLUMNS)


def listings(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Listings of all pages, or of each run's page prefix if a cap is asked for."""
    return map_listings(explode_items(pages if max_pages is None else page_prefix(pages, max_pages)))


def keyword_filter(listing: DataFrame, keywords: Sequence[str] | None = None) -> DataFrame:
    """S3: keep the listings of the given keywords (all of them by default)."""
    return listing if keywords is None else listing.filter(c("keyword").isin(*dict.fromkeys(keywords)))


def chosen(keywords: Sequence[str] | None) -> Column:
    """Whether a page's keyword was asked for (None: all were)."""
    if keywords is None:
        return F.lit(True)
    return F.coalesce(c("keyword"), F.lit("")).isin(*dict.fromkeys(keywords))


def page_fates(full: DataFrame, keywords: Sequence[str] | None = None,
               max_pages: int | None = None) -> DataFrame:
    """Pages that carry items, with ``reason``: why what was asked for leaves them out (NULL: kept).

    A page is beyond its run's prefix if any page before it is missing, empty,
    failed or malformed: only pages in ``full`` count as present.
    """
    out, reason = full, F.lit(None).cast("string")
    if max_pages is not None:
        kept = page_prefix(full, max_pages).select(
            c("run_id").alias("__r"), c("keyword").alias("__k"), c("page").alias("__p")).distinct()
        out = out.join(kept, out["run_id"].eqNullSafe(kept["__r"]) & out["keyword"].eqNullSafe(kept["__k"])
                       & (out["page"] == kept["__p"]), "left")
        reason = F.when(c("__p").isNull(), F.when(c("page") > max_pages, F.lit(BEYOND_CAP))
                        .otherwise(F.lit(AFTER_GAP)))
    if keywords is not None:
        reason = F.when(~chosen(keywords), F.lit(NOT_CHOSEN)).otherwise(reason)
    return out.select(*full.columns, reason.alias("reason"))


def skipped_pages(pages: DataFrame, keywords: Sequence[str] | None = None,
                  max_pages: int | None = None) -> DataFrame:
    """Pages that carry items and are left out by what was asked for, with a reason."""
    fates = page_fates(pages.filter(item_count() > 0), keywords, max_pages).filter(c("reason").isNotNull())
    return fates.select("run_id", "keyword", "page", item_count().alias("n_items"), "reason")


def union_keywords(batches: Iterable[DataFrame]) -> DataFrame:
    """Concatenate per-keyword batches; duplicates are kept."""
    batches = list(batches)
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b)
    return out


def _blank(name: str) -> Column:
    return c(name).isNull() | (c(name) == "")


def check(listing: DataFrame) -> DataFrame:
    """Typed columns plus ``reason`` (NULL when valid).

    The first failing rule names the reason, in the order the record model
    checks them: required fields, then the price conversions. Values the
    table cannot hold (price >= 10^10, review count beyond INT) reject the
    row rather than the whole load.

    Written as three projections (parse, validate, round): each parsed value
    is read by several rules, so Catalyst keeps them apart, and every fused
    stage stays small enough for the JIT.
    """
    parsed = listing.select(
        *LISTING_COLUMNS, "run_id", "pos", "captured_at",
        X.parse_currency("price").alias("__cur"),
        X.parse_currency("original_price").alias("__orig"),
        X.is_non_finite("price").alias("__cur_nf"),
        X.is_non_finite("original_price").alias("__orig_nf"),
        X.review_digits("review_count").alias("__digits"),
        X.parse_rating("rating").alias("__rating"),
    )
    cur, orig, digits = c("__cur"), c("__orig"), c("__digits")
    cur_q = cur.try_cast(X.PRICE_DECIMAL)
    orig_q = orig.try_cast(X.PRICE_DECIMAL)
    reason = (
        F.when(_blank("item_id"), F.lit("missing item_id"))
        .when(_blank("name"), F.lit("missing name"))
        .when(_blank("price"), F.lit("missing price"))
        .when(_blank("item_url"), F.lit("missing item_url"))
        .when(c("__cur_nf"), F.lit("non-finite current_price"))
        .when(cur.isNull(), F.lit("unparseable current_price"))
        .when(c("__orig_nf"), F.lit("non-finite original_price"))
        .when(cur_q.isNull(), F.lit("current_price out of range"))
        .when(orig.isNotNull() & orig_q.isNull(), F.lit("original_price out of range"))
        .when(digits.isNotNull() & digits.try_cast("int").isNull(), F.lit("review_count out of range"))
    )
    stamped = F.timestamp_add("MICROSECOND", c("pos"), c("captured_at"))
    typed = parsed.select(
        "run_id", "pos", "item_id", "name",
        cur_q.alias("current_price"),
        # a zero original price is no original price (stored as NULL)
        F.when(orig != 0, orig_q).alias("original_price"),
        X.discount_ratio(cur.try_cast(X.WORK_DECIMAL), orig.try_cast(X.WORK_DECIMAL)).alias("discount_ratio"),
        "brand", "category", "item_url",
        c("__rating").alias("rating"),
        digits.try_cast("int").alias("review_count"),
        "location", "keyword", "page",
        # no capture time: now, still in item order
        F.coalesce(stamped, F.timestamp_add("MICROSECOND", c("pos"), F.current_timestamp())).alias("scraped_at"),
        reason.alias("reason"),
    )
    # rounded in its own projection (see functions.columns.with_discount)
    return typed.select(
        *[X.round2_even("discount_ratio").alias(n) if n == "discount_pct" else c(n) for n in CHECKED_COLUMNS]
    )


def _guarded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project ``columns``; the first one is routed through a NULL check of
    every required column, so the check cannot be pruned and any NULL fails
    the job with a clear error instead of writing a bad row."""
    cond = F.lit(True)
    for n in REQUIRED_COLUMNS:
        cond = cond & c(n).isNotNull()
    first, rest = columns[0], list(columns[1:])
    checked_first = F.when(cond, c(first)).otherwise(
        F.raise_error(F.lit("required snapshot column is NULL"))
    ).alias(first)
    return df.select(checked_first, *rest)


def valid_snapshots(checked: DataFrame) -> DataFrame:
    """Valid records in table column order, NOT NULL columns asserted."""
    return _guarded(checked.filter(c("reason").isNull()), SNAPSHOT_COLUMNS)


def not_null_guard(snapshots: DataFrame) -> DataFrame:
    """The required columns of a batch about to be appended, checked."""
    return _guarded(snapshots, REQUIRED_COLUMNS)


def rejects(checked: DataFrame) -> DataFrame:
    """V5: rejected records with lineage and reason."""
    return checked.filter(c("reason").isNotNull()).select(*LINEAGE, "item_id", "reason")


def page_counts(checked: DataFrame) -> DataFrame:
    """V5: valid and rejected record counts per (run, keyword, page)."""
    return checked.groupBy("run_id", "keyword", "page").agg(
        F.count_if(c("reason").isNull()).alias("valid_records"),
        F.count_if(c("reason").isNotNull()).alias("rejected_records"),
    )


def ingest(pages: DataFrame, keywords: Sequence[str] | None = None, max_pages: int | None = None) -> DataFrame:
    """Full ingest chain up to the checked records (valid + rejected).

    Everything that landed is read; ``keywords`` and ``max_pages`` are cuts
    the caller asks for, and ``skipped_pages`` tells what they leave out.
    """
    return check(keyword_filter(listings(pages, max_pages), keywords))


# fields of the raw item exposed by the explode key
RAW_ITEM_FIELDS = ["itemId", "nid", "price", "priceShow"]
assert set(RAW_ITEM_FIELDS) <= set(ITEM_FIELDS)
