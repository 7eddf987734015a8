"""Scalar parsers and helpers (record-model tests and the edge corpus)."""

from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.functions import columns as X


def one_col(spark, values, dtype=T.StringType()):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype, True)]))


def evaluate(spark, values, expr, dtype=T.StringType()):
    return [r[0] for r in one_col(spark, values, dtype).select(expr(F.col("v"))).collect()]


def test_parse_currency_reference_cases(spark):
    got = evaluate(spark, ["₱1,299.00", "4500", "1250.5", "NOT_A_PRICE"], X.parse_currency)
    assert got[0] == Decimal("1299.00")
    assert got[1] == Decimal("4500")
    assert got[2] == Decimal("1250.5")
    assert got[3] is None


def test_parse_currency_edge_corpus(spark):
    vals = [None, "", "₱\u00a01\u00a0299", "PHP 12", "-5", "0", "1e3", "12.345", " ₱ 7 "]
    got = evaluate(spark, vals, X.parse_currency)
    assert got[0] is None and got[1] is None
    assert got[2] == Decimal("1299")
    assert got[3] is None
    assert got[4] == Decimal("-5") and got[5] == Decimal("0")
    assert got[6] == Decimal("1000")
    assert got[7] == Decimal("12.345")
    assert got[8] == Decimal("7")


def test_non_finite_tokens(spark):
    vals = ["NaN", "Infinity", "-inf", "sNaN", "₱nan", "12", None, "N/A"]
    assert evaluate(spark, vals, X.is_non_finite) == [True, True, True, True, True, False, False, False]
    # the decimal parse itself gives NULL for them
    assert evaluate(spark, ["NaN", "Infinity"], X.parse_currency) == [None, None]


def test_parse_rating(spark):
    vals = ["4.5", "N/A", " 4.5 ", "4.5d", "nan", "1e1", None, "0x1p3", "-inf"]
    got = evaluate(spark, vals, X.parse_rating)
    assert got[0] == 4.5 and got[1] is None and got[2] == 4.5 and got[3] is None
    assert got[4] != got[4]  # NaN
    assert got[5] == 10.0 and got[6] is None and got[7] is None
    assert got[8] == float("-inf")


def test_parse_reviews(spark):
    vals = ["1,234", "1.2k", "-3", "none", None, "12345678901", "(120)"]
    got = evaluate(spark, vals, X.parse_reviews)
    assert got == [1234, 12, 3, None, None, None, 120]


def test_repair_url(spark):
    got = evaluate(spark, ["//x.example/a", "https://x.example/a", "", None], X.repair_url)
    assert got == ["https://x.example/a", "https://x.example/a", "", None]


def test_utrim_unicode_spaces_but_not_tabs(spark):
    got = evaluate(spark, ["  Laptop  ", "\tPhone\t", "  ", "x"], X.utrim)
    assert got == ["Laptop", "\tPhone\t", "", "x"]
    assert evaluate(spark, ["  ", " a "], X.blank_to_null) == [None, "a"]


@pytest.mark.parametrize(
    "discount,tier",
    [(None, "full_price"), (0.0, "full_price"), (0.01, "minor_discount"), (19.99, "minor_discount"),
     (20.0, "on_sale"), (49.99, "on_sale"), (50.0, "deep_discount")],
)
def test_price_tier(spark, discount, tier):
    assert evaluate(spark, [discount], X.price_tier, T.DoubleType()) == [tier]


def discount_of(spark, cur, orig):
    schema = "cur decimal(20,9), orig decimal(20,9)"
    df = spark.createDataFrame([(None if cur is None else Decimal(cur), None if orig is None else Decimal(orig))], schema)
    return df.select(X.discount_pct("cur", "orig")).first()[0]


def test_discount_reference_cases(spark):
    assert discount_of(spark, "750", "1000") == 25.0
    assert discount_of(spark, "1000", "1000") is None
    assert discount_of(spark, "1200", "1000") is None
    assert discount_of(spark, "25999", "32000") == 18.75
    assert discount_of(spark, "5", None) is None
    assert discount_of(spark, "5", "0") is None


def test_discount_is_half_even_on_the_float(spark):
    # 18.125 is exact in binary: half-even gives 18.12 (a float round would too)
    assert discount_of(spark, "6550", "8000") == 18.12
    # computed from the unquantised prices
    # 38.275 is stored just below the midpoint, so a float round gives 38.27
    assert discount_of(spark, "12.345", "20") == 38.27


def test_round2_matches_duckdb_round(spark):
    values = [1.005, 2.675, 18.125, 10.015, -2.5, 0.125, 123.455, 99.995]
    got = evaluate(spark, values, X.round2, T.DoubleType())
    con = duckdb.connect()
    want = [con.execute("SELECT round(?::DOUBLE, 2)", [v]).fetchone()[0] for v in values]
    assert got == want


def test_median_price_half_cent_rounds_up(spark):
    df = spark.createDataFrame(
        [("a", Decimal("1.00")), ("a", Decimal("1.01")), ("b", Decimal("1")), ("b", Decimal("2")),
         ("b", Decimal("3")), ("c", Decimal("9.99"))],
        "g string, p decimal(12,2)",
    )
    got = dict(df.groupBy("g").agg(X.median_price("p").alias("m")).collect())
    assert got == {"a": 1.01, "b": 2.0, "c": 9.99}


def test_exact_avg_is_order_free(spark):
    df = spark.createDataFrame([(Decimal("10.01"),), (Decimal("10.02"),)], "p decimal(12,2)")
    assert df.select(X.round2(X.exact_avg("p", 2))).first()[0] == 10.02
    empty = df.filter("p < 0")
    assert empty.select(X.exact_avg("p", 2)).first()[0] is None


def test_first_present(spark):
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), ("", "")], "x string, y string")
    got = [r[0] for r in df.select(X.first_present("x", "y")).collect()]
    assert got == ["b", "b", "a", None]
