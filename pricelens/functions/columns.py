"""Column expressions shared by every plan.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python worker.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelens import config

# Parsed prices are held at this precision until the write quantises them to
# DECIMAL(12,2); discount is computed before quantising.
PARSE_DECIMAL = "decimal(38,9)"
WORK_DECIMAL = "decimal(20,9)"
PRICE_DECIMAL = "decimal(12,2)"


@lru_cache(maxsize=1)
def space_separators() -> str:
    """Category Zs: what SQL ``trim`` strips (NBSP included, tab not)."""
    return "".join(chr(i) for i in range(0x110000) if unicodedata.category(chr(i)) == "Zs")


@lru_cache(maxsize=1)
def whitespace() -> str:
    """White space as Python's ``str.isspace`` sees it (tabs, newlines, NBSP, ...)."""
    return "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


# Tokens a decimal parser accepts as non-finite numbers (with sign, payload).
_NON_FINITE = r"(?i)^[+-]?(inf|infinity|s?nan[0-9]*)$"
# Text a float parser accepts: decimal or exponent form, nan, inf, infinity.
_FLOAT_TEXT = r"(?i)^[+-]?([0-9]+\.?[0-9]*(e[+-]?[0-9]+)?|\.[0-9]+(e[+-]?[0-9]+)?|nan|inf|infinity)$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c: Column | str) -> Column:
    """Round a DOUBLE to 2 places as ``round(x*100)/100`` (half away from
    zero on the scaled binary value), so 1.005 -> 1.0 and 18.125 -> 18.13."""
    return F.round(col_(c) * 100) / 100


def round2_even(c: Column | str) -> Column:
    """Round a DOUBLE to 2 places by its *exact* binary value, ties to even.

    ``bround(x * 100)`` is not enough: the product is rounded first, so
    38.275 (stored as 38.27499999999999857...) becomes 3827.5 and then 38.28.
    Here ``t = 200 * x`` is split into its rounded value ``p`` and the exact
    rounding error ``err`` (Dekker's error-free product; 200 has few bits so
    every partial product is exact). ``p`` odd and integral marks a possible
    tie, which ``err`` resolves: below, above, or an exact tie (to even).
    """
    x = col_(c)
    p = x * 200
    split = x * 134217729.0  # 2**27 + 1
    hi = split - (split - x)
    err = (hi * 200 - p) + (x - hi) * 200
    half = F.floor(p / 2)  # p / 2 is exact
    tie_break = F.when(err > 0, 1).when(err < 0, 0).otherwise(half % 2)
    # p - 2 * half == 1 exactly when p is an odd integer
    hundredths = F.when(p - 2 * half == 1, half + tie_break).otherwise(F.floor(p / 2 + 0.5))
    return hundredths / 100


def utrim(c: Column | str) -> Column:
    """Trim Unicode space separators (NBSP included) but not tab/newline."""
    return F.trim(col_(c), F.lit(space_separators()))


def blank_to_null(c: Column | str) -> Column:
    """``nullif(trim(x), '')``."""
    return F.nullif(utrim(c), F.lit(""))


def exact_avg(c: Column | str, scale: int) -> Column:
    """Average with an exact decimal sum and one division.

    Float summation depends on row order, which would flip ties such as
    10.015 between runs; a DECIMAL(18,scale) sum does not.
    """
    d = col_(c).cast(f"decimal(18,{scale})")
    return F.try_divide(F.sum(d).cast("double"), F.count(d).cast("double"))


def cents(c: Column | str) -> Column:
    return (col_(c) * 100).cast("bigint")


def median_price(c: Column | str) -> Column:
    """Exact 0.5 continuous percentile over integer cents, back to units, as
    one aggregate expression (the marts use the distributed
    ``operators.exact_median``, which gives the same value).

    A half cent is exact in DOUBLE, so the result does not depend on how the
    engine interpolates; half cents round up.
    """
    return F.round(F.percentile(cents(c), F.lit(0.5))) / 100


def price_tier(discount: Column | str) -> Column:
    d = col_(discount)
    return (
        F.when(d >= config.TIER_DEEP_DISCOUNT, F.lit("deep_discount"))
        .when(d >= config.TIER_ON_SALE, F.lit("on_sale"))
        .when(d > 0, F.lit("minor_discount"))
        .otherwise(F.lit("full_price"))
    )


def price_direction(change: Column | str) -> Column:
    c = col_(change)
    return (
        F.when(c < 0, F.lit("decreased"))
        .when(c > 0, F.lit("increased"))
        .when(c == 0, F.lit("unchanged"))
        .otherwise(F.lit("first_seen"))
    )


def pct_change(current: Column | str, prev: Column | str) -> Column:
    """Percent change versus the previous price, 2 places; NULL unless prev > 0."""
    cur, prv = col_(current), col_(prev)
    ratio = (cur - prv).cast("double") / prv.cast("double") * 100
    return F.when(prv > 0, round2(ratio))


# ---------------------------------------------------------------------------
# Ingest parsers (text -> typed)
# ---------------------------------------------------------------------------

def first_present(*cols: Column | str) -> Column:
    """First alternative that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(col_(c), F.lit("")) for c in cols])


def repair_url(c: Column | str) -> Column:
    """Protocol-relative ``//host/x`` -> ``https://host/x``."""
    u = col_(c)
    return F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).otherwise(u)


def currency_text(c: Column | str) -> Column:
    """Price text with the currency sign, commas and whitespace removed."""
    return F.translate(col_(c), config.CURRENCY_SIGN + "," + whitespace(), "")


def parse_currency(c: Column | str) -> Column:
    """Text -> DECIMAL(38,9); unparseable (and non-finite) -> NULL."""
    return currency_text(c).try_cast(PARSE_DECIMAL)


def is_non_finite(c: Column | str) -> Column:
    """True when the price text is a NaN / Infinity token (record is rejected)."""
    return F.coalesce(currency_text(c).rlike(_NON_FINITE), F.lit(False))


def parse_rating(c: Column | str) -> Column:
    """Text -> DOUBLE when it reads as a float (nan/inf allowed), else NULL."""
    t = F.trim(col_(c), F.lit(whitespace()))
    return F.when(t.rlike(_FLOAT_TEXT), t.try_cast("double"))


def review_digits(c: Column | str) -> Column:
    """Digits of the review text ('1.2k' -> '12'); NULL when none."""
    return F.nullif(F.regexp_replace(col_(c), "[^0-9]", ""), F.lit(""))


def parse_reviews(c: Column | str) -> Column:
    return review_digits(c).try_cast("int")


def discount_ratio(current: Column | str, original: Column | str) -> Column:
    """(original - current) / original * 100 as DOUBLE when original > 0 and
    current is below it, else NULL.

    Inputs are the unquantised prices (decimals, or integer cents). The
    quotient is taken exactly (decimal division, or one DOUBLE division of
    integers) and rounded once to DOUBLE, as a decimal quotient converted to
    float would be.
    """
    cur, orig = col_(current), col_(original)
    return F.when(orig.isNotNull() & (orig > 0) & (cur < orig), ((orig - cur) * 100 / orig).cast("double"))


def discount_pct(current: Column | str, original: Column | str) -> Column:
    """Discount percent, half-even to 2 places (see ``with_discount``)."""
    return round2_even(discount_ratio(current, original))


def with_discount(df, current: Column | str, original: Column | str, out: str = "discount_pct"):
    """Add ``out`` = discount percent rounded to 2 places.

    The ratio is projected first and rounded in a second projection: the
    rounding reads its input many times, so Catalyst keeps the two projections
    apart instead of inlining the division into every use, which keeps the
    generated stage code small enough to be JIT-compiled.
    """
    tmp = f"__{out}_ratio"
    return df.withColumn(tmp, discount_ratio(current, original)).withColumn(
        out, round2_even(F.col(tmp))
    ).drop(tmp)


def nan_to_null(c: Column | str) -> Column:
    x = col_(c)
    return F.when(~F.isnan(x), x)
