"""DuckDB SQL equivalents of the registered Spark queries.

Each query is written independently of the Spark code, directly over the
driver's tables (``events``, ``part``, ``nation`` are views). The CTE chain
mirrors the dataset lineage: snap -> stg -> hist -> movers / deals, stg -> cat.
Rounding, averages and the median use the same exact forms on both sides
(see the semantics notes in README.md).
"""

from __future__ import annotations


def _round2_even(x: str) -> str:
    """Exact half-even rounding to 2 places of a DOUBLE (see round2_even)."""
    p = f"(({x}) * 200)"
    split = f"(({x}) * 134217729.0)"
    hi = f"({split} - ({split} - ({x})))"
    lo = f"(({x}) - {hi})"
    err = f"(({hi} * 200 - {p}) + {lo} * 200)"
    odd = f"({p} = floor({p}) AND abs(fmod({p}, 2)) = 1)"
    return (f"(CASE WHEN {odd} AND {err} < 0 THEN ({p} - 1) / 2 "
            f"WHEN {odd} AND {err} > 0 THEN ({p} + 1) / 2 "
            f"WHEN {odd} THEN round_even({p} / 2, 0) "
            f"ELSE round({p} / 2) END / 100)")


# --- snapshots from the driver tables (mapping in pricelens.sources.driver_tables)
SNAP = """
ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents
  FROM events
),
priced AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_id % 97 = 0 THEN 0 ELSE cents END AS cur_c,
         CASE WHEN event_id % 13 = 0 THEN NULL
              ELSE (cents * (100 + 12 * (event_id % 11))) // 100 END AS orig_c
  FROM ev
),
snap AS (
  SELECT
    'ITEM' || lpad(CAST(e.user_id AS VARCHAR), 5, '0') AS item_id,
    '  ' || p.p_name || ' ' AS name,
    CAST(CAST(e.cur_c AS DOUBLE) / 100 AS DECIMAL(12,2)) AS current_price,
    CAST(CAST(NULLIF(e.orig_c, 0) AS DOUBLE) / 100 AS DECIMAL(12,2)) AS original_price,
    CASE WHEN e.orig_c > 0 AND e.cur_c < e.orig_c
         THEN {DISC_SNAP}
    END AS discount_pct,
    p.p_brand AS brand,
    CASE WHEN e.event_id % 17 = 0 THEN ' ' ELSE p.p_type END AS category,
    'https://shop.example/i' || CAST(e.user_id AS VARCHAR) AS item_url,
    CASE WHEN e.event_id % 23 = 0 THEN NULL ELSE CAST(e.event_id % 41 AS DOUBLE) / 10 END AS rating,
    CASE WHEN e.event_id % 19 = 0 THEN NULL ELSE CAST(e.event_id % 200 AS INTEGER) END AS review_count,
    n.n_name AS location,
    ' ' || upper(e.event_type) AS keyword,
    CAST(1 + e.event_id % 3 AS INTEGER) AS page,
    e.ts AS scraped_at
  FROM priced e
  JOIN part p ON p.p_partkey = e.user_id
  JOIN nation n ON n.n_nationkey = e.user_id % 25
)""".replace("{DISC_SNAP}", _round2_even(
    "CAST((e.orig_c - e.cur_c) * 100 AS DOUBLE) / CAST(e.orig_c AS DOUBLE)"))

STG = """
stg AS (
  SELECT item_id,
         trim(name) AS product_name,
         current_price,
         original_price,
         coalesce(discount_pct, 0.0) AS discount_pct,
         nullif(trim(brand), '') AS brand,
         nullif(trim(category), '') AS category,
         item_url,
         rating,
         coalesce(review_count, 0) AS review_count,
         nullif(trim(location), '') AS location,
         lower(trim(keyword)) AS keyword,
         page,
         scraped_at,
         date_trunc('day', scraped_at) AS snapshot_date,
         CAST(extract('hour' FROM scraped_at) AS BIGINT) AS snapshot_hour,
         CASE WHEN discount_pct >= 50 THEN 'deep_discount'
              WHEN discount_pct >= 20 THEN 'on_sale'
              WHEN discount_pct > 0 THEN 'minor_discount'
              ELSE 'full_price' END AS price_tier
  FROM snap
  WHERE current_price > 0 AND item_id IS NOT NULL AND name IS NOT NULL
)"""

HIST = """
lagged AS (
  SELECT *, lag(current_price) OVER (
           PARTITION BY item_id
           ORDER BY scraped_at, page, keyword, current_price, item_url, product_name) AS prev_price
  FROM stg
),
hist AS (
  SELECT item_id, product_name, brand, category, keyword, current_price, original_price,
         discount_pct, price_tier, prev_price,
         current_price - prev_price AS price_change_abs,
         CASE WHEN prev_price > 0
              THEN round(CAST(current_price - prev_price AS DOUBLE) / CAST(prev_price AS DOUBLE) * 100 * 100) / 100
         END AS price_change_pct,
         CASE WHEN current_price - prev_price < 0 THEN 'decreased'
              WHEN current_price - prev_price > 0 THEN 'increased'
              WHEN current_price - prev_price = 0 THEN 'unchanged'
              ELSE 'first_seen' END AS price_direction,
         rating, review_count, location, item_url, snapshot_date, scraped_at
  FROM lagged
)"""

MOVERS = """
movers AS (
  SELECT snapshot_date, item_id, product_name, brand, category, keyword, prev_price,
         current_price, price_change_abs, price_change_pct, price_direction, discount_pct,
         rating, review_count, item_url, rank_within_direction
  FROM (
    SELECT *, rank() OVER (PARTITION BY snapshot_date, price_direction
                           ORDER BY abs(price_change_abs) DESC) AS rank_within_direction
    FROM hist
    WHERE price_change_abs IS NOT NULL AND price_direction IN ('decreased', 'increased')
  ) WHERE rank_within_direction <= 20
)"""


def _exact_avg(expr: str, scale: int) -> str:
    return (f"round(CAST(sum(CAST({expr} AS DECIMAL(18,{scale}))) AS DOUBLE) "
            f"/ CAST(count({expr}) AS DOUBLE) * 100) / 100")


_RATING = "CASE WHEN isnan(rating) THEN NULL ELSE rating END"

CAT = f"""
cat AS (
  SELECT snapshot_date, category, keyword,
         count(DISTINCT item_id) AS unique_items,
         {_exact_avg('current_price', 2)} AS avg_price,
         round(median(CAST(CAST(current_price * 100 AS BIGINT) AS DOUBLE))) / 100 AS median_price,
         min(current_price) AS min_price,
         max(current_price) AS max_price,
         {_exact_avg('discount_pct', 2)} AS avg_discount_pct,
         count(CASE WHEN price_tier = 'deep_discount' THEN 1 END) AS deep_discount_count,
         count(CASE WHEN price_tier = 'on_sale' THEN 1 END) AS on_sale_count,
         {_exact_avg(_RATING, 6)} AS avg_rating,
         CAST(sum(review_count) AS BIGINT) AS total_reviews
  FROM stg
  WHERE category IS NOT NULL
  GROUP BY snapshot_date, category, keyword
)"""

DEALS = """
qual AS (
  SELECT * FROM hist
  WHERE discount_pct >= 30 AND review_count >= 50 AND current_price > 0
),
dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
             PARTITION BY snapshot_date, item_id
             ORDER BY scraped_at DESC, keyword DESC, current_price DESC, item_url DESC,
                      product_name DESC, discount_pct DESC, review_count DESC, rating DESC,
                      original_price DESC, brand DESC, category DESC, location DESC) AS rn
    FROM qual
  ) WHERE rn = 1
),
deals AS (
  SELECT snapshot_date, deal_rank, item_id, product_name, brand, category, keyword,
         current_price, original_price, discount_pct, price_tier, price_change_pct,
         is_fresh_drop, rating, review_count, location, item_url, scraped_at
  FROM (
    SELECT *,
           rank() OVER (PARTITION BY snapshot_date
                        ORDER BY discount_pct DESC, review_count DESC) AS deal_rank,
           CASE WHEN price_direction = 'decreased' AND price_change_pct <= -10
                THEN true ELSE false END AS is_fresh_drop
    FROM dedup
  ) WHERE deal_rank <= 10
)"""

LATEST = """
latest AS (
  SELECT item_id, name, current_price, original_price, discount_pct, brand, category, scraped_at
  FROM (
    SELECT *, row_number() OVER (
             PARTITION BY item_id
             ORDER BY scraped_at DESC, page DESC, keyword DESC, current_price DESC,
                      item_url DESC, name DESC) AS rn
    FROM snap
  ) WHERE rn = 1
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


MART_SQL = {
    "snapshots": _with(SNAP) + "SELECT * FROM snap",
    "stg_prices": _with(SNAP, STG) + "SELECT * FROM stg",
    "price_history": _with(SNAP, STG, HIST) + "SELECT * FROM hist",
    "price_movers": _with(SNAP, STG, HIST, MOVERS) + "SELECT * FROM movers",
    "category_summary": _with(SNAP, STG, CAT) + "SELECT * FROM cat",
    "daily_deals": _with(SNAP, STG, HIST, DEALS) + "SELECT * FROM deals",
    "latest_snapshot": _with(SNAP, LATEST) + "SELECT * FROM latest",
    "status": _with(SNAP)
    + "SELECT count(*) AS total_snapshots, count(DISTINCT item_id) AS unique_items FROM snap",
    "todays_drops": _with(SNAP, STG, HIST, MOVERS) + """
SELECT product_name, prev_price, current_price, price_change_pct, item_url
FROM movers
WHERE snapshot_date = (SELECT max(snapshot_date) FROM stg) AND price_direction = 'decreased'
ORDER BY price_change_pct ASC, item_url, product_name, prev_price, current_price
LIMIT 10""",
    "todays_deals": _with(SNAP, STG, HIST, DEALS) + """
SELECT deal_rank, product_name, category, current_price, discount_pct, is_fresh_drop
FROM deals
WHERE snapshot_date = (SELECT max(snapshot_date) FROM stg)""",
    "category_trend": _with(SNAP, STG, CAT)
    + "SELECT snapshot_date, category, avg_price, median_price FROM cat",
    "fresh_drops": _with(SNAP, STG, HIST, DEALS) + "SELECT * FROM deals WHERE is_fresh_drop",
}

# --- ingest: landed pages derived from events (mapping in driver_tables) ---
ING = """
ing AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type AS keyword, e.cur_c, e.orig_c,
         e.event_id // 250 AS run_no,
         'R' || lpad(CAST(e.event_id // 250 AS VARCHAR), 6, '0') AS run_id,
         CAST(1 + e.event_id % 5 AS INTEGER) AS page,
         p.p_name, p.p_brand, p.p_type, n.n_name,
         'ITEM' || lpad(CAST(e.user_id AS VARCHAR), 5, '0') AS the_id,
         CAST(CAST(CAST(e.cur_c AS DOUBLE) / 100 AS DECIMAL(12,2)) AS VARCHAR) AS cur_s,
         format('{:,.2f}', CAST(e.cur_c AS DOUBLE) / 100) AS cur_f,
         format('{:,.2f}', CAST(e.orig_c AS DOUBLE) / 100) AS orig_f
  FROM priced e
  JOIN part p ON p.p_partkey = e.user_id
  JOIN nation n ON n.n_nationkey = e.user_id % 25
),
docs AS (
  SELECT run_id, run_no, keyword, page, min(ts) AS captured_at, count(*) AS n_items,
         (run_no % 7 = 3 AND page = 2) OR (run_no % 11 = 5 AND page = 1) AS blank
  FROM ing GROUP BY run_id, run_no, keyword, page
),
kept AS (
  SELECT run_id, keyword, page, CAST(n_items AS INTEGER) AS n_items FROM (
    SELECT *, dense_rank() OVER (PARTITION BY run_id, keyword ORDER BY page) AS r
    FROM docs WHERE NOT blank AND page <= 3
  ) WHERE r = page
),
items AS (
  SELECT i.*, d.captured_at, d.blank,
         CAST(row_number() OVER (PARTITION BY i.run_id, i.keyword, i.page ORDER BY i.event_id) - 1 AS INTEGER) AS pos
  FROM ing i JOIN docs d ON d.run_id = i.run_id AND d.keyword = i.keyword AND d.page = i.page
),
raw_items AS (
  SELECT run_id, keyword, page, pos, captured_at,
         CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN '' ELSE the_id END AS itemId,
         CASE WHEN event_id % 29 = 0 THEN the_id END AS nid,
         CASE event_id % 6 WHEN 0 THEN '₱' || cur_f WHEN 1 THEN cur_s
              WHEN 2 THEN '₱' || chr(160) || cur_s || ' ' WHEN 3 THEN '' WHEN 4 THEN 'N/A' END AS price,
         CASE event_id % 6 WHEN 3 THEN '₱' || cur_s WHEN 5 THEN cur_s END AS priceShow
  FROM items WHERE NOT blank
),
lst AS (
  SELECT it.*,
         CASE WHEN event_id % 31 = 0 AND event_id % 29 <> 0 THEN '' ELSE the_id END AS item_id,
         CASE WHEN event_id % 37 = 0 THEN p_name WHEN event_id % 43 = 0 THEN NULL
              ELSE '  ' || p_name || ' ' END AS name,
         CASE event_id % 6 WHEN 0 THEN '₱' || cur_f WHEN 1 THEN cur_s
              WHEN 2 THEN '₱' || chr(160) || cur_s || ' ' WHEN 3 THEN '₱' || cur_s
              WHEN 4 THEN 'N/A' ELSE cur_s END AS price,
         CASE WHEN orig_c IS NULL THEN NULL WHEN event_id % 47 = 0 THEN 'NaN'
              WHEN event_id % 53 = 0 THEN 'abc' ELSE '₱' || orig_f END AS original_price,
         p_brand AS brand,
         CASE WHEN event_id % 17 = 0 THEN ' ' ELSE p_type END AS category,
         CASE WHEN event_id % 59 = 0 THEN '' ELSE 'https://shop.example/i' || CAST(user_id AS VARCHAR) END AS item_url,
         'https://img.example/' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '.jpg' AS image_url,
         CASE WHEN event_id % 23 = 0 THEN 'N/A'
              ELSE CAST(CAST(event_id % 41 AS DOUBLE) / 10 AS VARCHAR) END AS rating_text,
         CASE WHEN event_id % 19 = 0 THEN NULL
              WHEN event_id % 7 = 0 THEN '(' || CAST(event_id % 200 AS VARCHAR) || ')'
              ELSE CAST(event_id % 200 AS VARCHAR) END AS review_text,
         n_name AS location,
         CASE WHEN event_id % 6 = 4 THEN NULL
              ELSE CAST(CAST(cur_c AS DOUBLE) / 100 AS DECIMAL(38,9)) END AS price_value,
         CASE WHEN orig_c IS NULL OR event_id % 47 = 0 OR event_id % 53 = 0 THEN NULL
              ELSE CAST(CAST(orig_c AS DOUBLE) / 100 AS DECIMAL(38,9)) END AS original_value,
         CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 41 AS DOUBLE) / 10 END AS rating,
         CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(event_id % 200 AS INTEGER) END AS review_count,
         CASE WHEN event_id % 6 <> 4 AND orig_c IS NOT NULL AND event_id % 47 <> 0
                   AND event_id % 53 <> 0 AND orig_c > 0 AND cur_c < orig_c
              THEN {DISC_ING}
         END AS discount_pct,
         CASE WHEN event_id % 31 = 0 AND event_id % 29 <> 0 THEN 'missing item_id'
              WHEN event_id % 43 = 0 AND event_id % 37 <> 0 THEN 'missing name'
              WHEN event_id % 59 = 0 THEN 'missing item_url'
              WHEN event_id % 6 = 4 THEN 'unparseable current_price'
              WHEN orig_c IS NOT NULL AND event_id % 47 = 0 THEN 'non-finite original_price'
         END AS reason
  FROM items it WHERE NOT blank
),
valid AS (
  SELECT run_id, pos, item_id, name,
         CAST(CAST(cur_c AS DOUBLE) / 100 AS DECIMAL(12,2)) AS current_price,
         CASE WHEN orig_c IS NULL OR event_id % 53 = 0 OR orig_c = 0 THEN NULL
              ELSE CAST(CAST(orig_c AS DOUBLE) / 100 AS DECIMAL(12,2)) END AS original_price,
         discount_pct, brand, category, item_url, rating, review_count, location, keyword, page,
         captured_at + to_microseconds(pos) AS scraped_at
  FROM lst WHERE reason IS NULL
)""".replace("{DISC_ING}", _round2_even("CAST((orig_c - cur_c) * 100 AS DOUBLE) / CAST(orig_c AS DOUBLE)"))

_SNAPSHOT_COLS = ("item_id, name, current_price, original_price, discount_pct, brand, category, "
                  "item_url, rating, review_count, location, keyword, page, scraped_at")
_LIN = "run_id, keyword, page, pos"

INGEST_SQL = {
    "explode_pages": _with(SNAP, ING) + f"SELECT {_LIN}, captured_at, itemId, nid, price, priceShow FROM raw_items",
    "page_prefix": _with(SNAP, ING) + "SELECT run_id, keyword, page, n_items FROM kept",
    "stream_prefix": _with(SNAP, ING) + "SELECT run_id, keyword, page, n_items FROM kept",
    "listing_map": _with(SNAP, ING) + """
SELECT run_id, pos, item_id, name, price, original_price, brand, category, item_url, image_url,
       rating_text AS rating, review_text AS review_count, location, keyword, page FROM lst""",
    "url_repair": _with(SNAP, ING) + f"SELECT {_LIN}, item_url, image_url FROM lst",
    "keyword_filter": _with(SNAP, ING)
    + f"SELECT {_LIN}, item_id FROM lst WHERE keyword IN ('click', 'purchase')",
    "union_keywords": _with(SNAP, ING) + f"""
SELECT {_LIN}, item_id FROM lst WHERE keyword IN ('click', 'view')
UNION ALL
SELECT {_LIN}, item_id FROM lst WHERE keyword IN ('view', 'signup')""",
    "parse_currency": _with(SNAP, ING) + f"SELECT {_LIN}, price_value, original_value FROM lst",
    "parse_rating": _with(SNAP, ING) + f"SELECT {_LIN}, rating FROM lst",
    "parse_reviews": _with(SNAP, ING) + f"SELECT {_LIN}, review_count FROM lst",
    "discount_pct": _with(SNAP, ING) + f"SELECT {_LIN}, discount_pct FROM lst",
    "validate": _with(SNAP, ING) + f"SELECT {_SNAPSHOT_COLS} FROM valid",
    "rejects": _with(SNAP, ING) + f"SELECT {_LIN}, item_id, reason FROM lst WHERE reason IS NOT NULL",
    "page_counts": _with(SNAP, ING) + """
SELECT run_id, keyword, page,
       count(*) FILTER (WHERE reason IS NULL) AS valid_records,
       count(*) FILTER (WHERE reason IS NOT NULL) AS rejected_records
FROM lst GROUP BY run_id, keyword, page""",
    "not_null_guard": _with(SNAP, ING)
    + "SELECT item_id, name, current_price, item_url, keyword, page, scraped_at FROM valid",
    "load_quantize": _with(SNAP, ING)
    + f"SELECT {_LIN}, current_price, original_price, discount_pct FROM valid",
}


# The rules and the rows that break them, written out by hand.
_MINUTE = "extract('minute' FROM scraped_at)"
_TIERS = "('full_price', 'minor_discount', 'on_sale', 'deep_discount')"
_CHECKS = {
    ("price_snapshots", "snap", _MINUTE): [
        ("item_id", None), ("name", None), ("current_price", None), ("scraped_at", None), ("keyword", None)],
    ("stg_prices", "stg", _MINUTE): [
        ("item_id", None), ("product_name", None), ("current_price", None), ("discount_pct", None),
        ("price_tier", None), ("keyword", None), ("scraped_at", None), ("price_tier", _TIERS)],
    ("price_history", "hist", _MINUTE): [
        ("item_id", None), ("current_price", None), ("snapshot_date", None),
        ("price_direction", "('decreased', 'increased', 'unchanged', 'first_seen')")],
    ("price_movers", "movers", "rank_within_direction"): [
        ("item_id", None), ("snapshot_date", None), ("price_direction", "('decreased', 'increased')")],
    ("category_summary", "cat", "extract('day' FROM snapshot_date)"): [
        ("snapshot_date", None), ("category", None), ("unique_items", None)],
    ("daily_deals", "deals", "deal_rank"): [
        ("snapshot_date", None), ("deal_rank", None), ("item_id", None), ("discount_pct", None),
        ("is_fresh_drop", None), ("price_tier", _TIERS)],
}


def _quality_sql() -> str:
    parts = []
    for (dataset, cte, mark), rules in _CHECKS.items():
        for k, (col, accepted) in enumerate(rules, 1):
            rule = "accepted_values" if accepted else "not_null"
            value = f"CASE WHEN {mark} = {k} THEN {chr(39) + 'odd' + chr(39) if accepted else 'NULL'} ELSE {col} END"
            fails = f"{value} NOT IN {accepted}" if accepted else f"{value} IS NULL"
            parts.append(f"SELECT '{dataset}' AS dataset, '{col}' AS column_name, '{rule}' AS rule, "
                         f"count(*) FILTER (WHERE {fails}) AS failures FROM {cte}")
    return _with(SNAP, STG, HIST, MOVERS, CAT, DEALS) + "\nUNION ALL\n".join(parts)


def _ordered_sql(ctes: tuple[str, ...], name: str, order: str) -> str:
    return _with(*ctes) + f"SELECT row_number() OVER (ORDER BY {order}) AS position, * FROM {name}"


MART_SQL |= {
    "quality_report": _quality_sql(),
    "price_history_hot": MART_SQL["price_history"],
    "category_summary_hot": MART_SQL["category_summary"],
    "movers_order": _ordered_sql(
        (SNAP, STG, HIST, MOVERS), "movers",
        "snapshot_date DESC, price_direction, rank_within_direction, item_id, keyword, current_price"),
    "deals_order": _ordered_sql((SNAP, STG, HIST, DEALS), "deals", "snapshot_date DESC, deal_rank, item_id"),
    "category_order": _ordered_sql(
        (SNAP, STG, CAT), "cat", "snapshot_date DESC, total_reviews DESC, category, keyword"),
    "warehouse_status": _with(SNAP) + """
SELECT count(*) + count(*) FILTER (WHERE extract('day' FROM scraped_at) >= 5) AS total_snapshots,
       count(DISTINCT item_id) AS unique_items FROM snap""",
    "warehouse_movers": MART_SQL["price_movers"],
    "warehouse_drops": MART_SQL["todays_drops"],
}

_REASON = """
CASE WHEN keyword NOT IN ('click', 'view') THEN 'keyword not chosen'
     WHEN (run_id, keyword, page) IN (SELECT (run_id, keyword, page) FROM kept) THEN NULL
     WHEN page > 3 THEN 'beyond the page cap' ELSE 'after a missing page' END"""
INGEST_SQL |= {
    "skipped_pages": _with(SNAP, ING) + f"""
SELECT run_id, keyword, page, CAST(n_items AS INTEGER) AS n_items, {_REASON} AS reason
FROM docs WHERE NOT blank AND {_REASON} IS NOT NULL""",
    "load_accounts": _with(SNAP, ING) + f"""
, flagged AS (
  SELECT *, (run_no % 13 = 4 AND page = 2) OR (run_no % 17 = 6 AND page = 3) OR (run_no % 19 = 8 AND page = 1) AS bad
  FROM docs
), prefix AS (
  SELECT run_id, keyword, page FROM (
    SELECT *, dense_rank() OVER (PARTITION BY run_id, keyword ORDER BY page) AS r
    FROM flagged WHERE NOT blank AND NOT bad AND page <= 3
  ) WHERE r = page
), landed AS (
  SELECT lst.reason, keyword NOT IN ('click', 'view') OR (run_id, keyword, page) NOT IN
         (SELECT (run_id, keyword, page) FROM prefix) AS skipped
  FROM lst JOIN flagged USING (run_id, keyword, page) WHERE NOT bad
), lines AS (SELECT count(*) AS malformed FROM flagged WHERE bad)
SELECT 'whole' AS load_id, count(*) FILTER (WHERE reason IS NULL) AS appended,
       count(*) FILTER (WHERE reason IS NOT NULL) AS rejected, 0::BIGINT AS skipped_items, any_value(malformed) AS malformed
FROM landed, lines
UNION ALL
SELECT 'cut', count(*) FILTER (WHERE NOT skipped AND reason IS NULL),
       count(*) FILTER (WHERE NOT skipped AND reason IS NOT NULL), count(*) FILTER (WHERE skipped), any_value(malformed)
FROM landed, lines""",
}

MART_SQL |= {
    "late_load_history": MART_SQL["price_history"],
    "late_load_category": MART_SQL["category_summary"],
    "empty_append": _with(SNAP) + """
SELECT count(*) AS total_snapshots, count(DISTINCT item_id) AS unique_items, 0::BIGINT AS appended FROM snap""",
    "view_sql": _with(SNAP, STG) + """
SELECT snapshot_date, price_tier, count(*) AS n, min(current_price) AS lowest, max(discount_pct) AS deepest
FROM stg GROUP BY snapshot_date, price_tier""",
    "run_movers": _with(SNAP.replace("\nsnap AS (", "\nevent_snap AS ("), ING,
                        f"snap AS (SELECT {_SNAPSHOT_COLS} FROM valid)", STG, HIST, MOVERS) + "SELECT * FROM movers",
}
