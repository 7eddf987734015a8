"""Column-expression library (built-in Spark expressions only)."""

from pricelens.functions.columns import (  # noqa: F401
    blank_to_null,
    cents,
    currency_text,
    discount_pct,
    discount_ratio,
    exact_avg,
    first_present,
    is_non_finite,
    median_price,
    nan_to_null,
    parse_currency,
    parse_rating,
    parse_reviews,
    pct_change,
    price_direction,
    price_tier,
    repair_url,
    round2,
    round2_even,
    utrim,
    with_discount,
)
