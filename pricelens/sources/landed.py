"""Landed catalog pages: JSON documents, one per fetched page.

Each document carries our envelope (run, keyword, page, capture time) and
the catalog payload ``mods.listItems``. Reading uses an explicit schema: no
inference pass, and every item value arrives as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.schema import PAGE

CORRUPT = "_corrupt_record"
JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "columnNameOfCorruptRecord": CORRUPT,
}
PAGE_WITH_CORRUPT = T.StructType(PAGE.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page documents from a landing folder of JSON-lines files.

    A line with anything that cannot be read keeps its text in
    ``_corrupt_record``. Spark may still fill some of its other columns; see
    ``fated``.
    """
    return spark.read.schema(PAGE_WITH_CORRUPT).options(**JSON_OPTIONS).json(path)


# What becomes of a landed line (a page); items of a full page are then checked one by one.
# HELD: it waits for an earlier page of its run (see plans.open_runs).
FULL, EMPTY, MALFORMED, SKIPPED, HELD = "full", "empty", "malformed", "skipped", "held"


def fated(pages: DataFrame) -> DataFrame:
    """Pages with their one ``fate`` as read, and a malformed page's ``line``.

    A malformed page is kept as its line alone, never half ingested. All
    columns must be read in the same pass: Spark finds a line to be corrupt
    only in the columns that a scan parses.
    """
    corrupt = F.col(CORRUPT) if CORRUPT in pages.columns else F.lit(None).cast("string")
    n_items = F.coalesce(F.size("mods.listItems"), F.lit(0))
    fate = F.when(corrupt.isNotNull(), MALFORMED).when(n_items > 0, FULL).otherwise(EMPTY)
    whole = [F.when(corrupt.isNull(), F.col(f.name)).alias(f.name) for f in PAGE.fields]
    return pages.select(*whole, corrupt.alias("line"), fate.alias("fate"))


def parse_pages(text: DataFrame, column: str = "value") -> DataFrame:
    """Page documents from a column of JSON text (same parser as the reader)."""
    return text.select(F.from_json(F.col(column), PAGE, JSON_OPTIONS).alias("doc")).select("doc.*")
