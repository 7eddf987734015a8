"""Dataset checks (K1-K6): not_null and accepted_values rules.

One aggregate per dataset counts every rule's violations in a single pass
(``count_if``), and the counts are unpivoted into
(dataset, column_name, rule, failures). ``accepted_values`` ignores NULLs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from pricelens import config

# Rule table (fixed values): dataset -> not_null columns, accepted values.
RULES: dict[str, dict] = {
    "price_snapshots": {
        "not_null": ["item_id", "name", "current_price", "scraped_at", "keyword"],
        "accepted_values": {},
    },
    "stg_prices": {
        "not_null": ["item_id", "product_name", "current_price", "discount_pct", "price_tier",
                     "keyword", "scraped_at"],
        "accepted_values": {"price_tier": config.PRICE_TIERS},
    },
    "price_history": {
        "not_null": ["item_id", "current_price", "snapshot_date"],
        "accepted_values": {"price_direction": config.PRICE_DIRECTIONS},
    },
    "price_movers": {
        "not_null": ["item_id", "snapshot_date"],
        "accepted_values": {"price_direction": config.MOVER_DIRECTIONS},
    },
    "category_summary": {
        "not_null": ["snapshot_date", "category", "unique_items"],
        "accepted_values": {},
    },
    "daily_deals": {
        "not_null": ["snapshot_date", "deal_rank", "item_id", "discount_pct", "is_fresh_drop"],
        "accepted_values": {"price_tier": config.PRICE_TIERS},
    },
}


def rule_list(dataset: str) -> list[tuple[str, str, F.Column]]:
    """(column, rule, violation predicate) for one dataset."""
    spec = RULES[dataset]
    out = [(col, "not_null", F.col(col).isNull()) for col in spec["not_null"]]
    for col, values in spec["accepted_values"].items():
        out.append((col, "accepted_values", F.col(col).isNotNull() & ~F.col(col).isin(*values)))
    return out


def observed(name: str, df: DataFrame) -> tuple[DataFrame, Callable[[], list[Row]]]:
    """``df`` with its rules counted while it is written, and what was counted (after the write)."""
    rules = rule_list(name)
    obs = Observation(f"checks_{name}_{uuid.uuid4().hex[:8]}")
    df = df.observe(obs, *[F.count_if(pred).alias(f"r{i}") for i, (_, _, pred) in enumerate(rules)])

    def counted() -> list[Row]:
        return [Row(dataset=name, column_name=col, rule=rule, failures=obs.get[f"r{i}"])
                for i, (col, rule, _) in enumerate(rules)]

    return df, counted


# A small number each row of a dataset has, by which ``broken`` picks rows.
_MARKS = {
    "price_snapshots": "minute(scraped_at)", "stg_prices": "minute(scraped_at)",
    "price_history": "minute(scraped_at)", "price_movers": "rank_within_direction",
    "category_summary": "dayofmonth(snapshot_date)", "daily_deals": "deal_rank",
}


def broken(name: str, df: DataFrame) -> DataFrame:
    """``df`` with its k-th rule broken in the rows of mark k: NULLs, then values that no rule accepts.

    Data on which the checks must fail, to check the checks.
    """
    marks = df.withColumn("__mark", F.expr(_MARKS[name]))
    out = {c: F.col(c) for c in df.columns}
    for k, (col, rule, _) in enumerate(rule_list(name)):
        bad = F.lit(None) if rule == "not_null" else F.lit("odd")
        out[col] = F.when(F.col("__mark") == k + 1, bad).otherwise(out[col])
    return marks.select(*[v.alias(c) for c, v in out.items()])


def check_dataset(name: str, df: DataFrame) -> DataFrame:
    rules = rule_list(name)
    counts = df.agg(*[F.count_if(pred).alias(f"r{i}") for i, (_, _, pred) in enumerate(rules)])
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("dataset"), F.lit(col).alias("column_name"),
            F.lit(rule).alias("rule"), F.col(f"r{i}").alias("failures"),
        )
        for i, (col, rule, _) in enumerate(rules)
    ])
    return counts.select(F.inline(rows))


def quality_report(datasets: dict[str, DataFrame]) -> DataFrame:
    """Report over every dataset given (names as in ``RULES``)."""
    parts = [check_dataset(name, df) for name, df in datasets.items() if name in RULES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityError(RuntimeError):
    pass


def assert_quality(report: DataFrame) -> None:
    """Fail when any rule has a violation (the report has ~29 rows)."""
    assert_rows(report.filter(F.col("failures") > 0).collect())


def assert_rows(rows: list[Row]) -> None:
    failed = [r for r in rows if r.failures]
    if failed:
        lines = ", ".join(f"{r.dataset}.{r.column_name} {r.rule}: {r.failures}" for r in failed)
        raise QualityError(f"data checks failed: {lines}")
