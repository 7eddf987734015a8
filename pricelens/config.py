"""Fixed values and session helpers.

The values in the first block must equal the behaviour being reproduced
(tier thresholds, deal rules, top-k sizes); they are stated here once, as plain data, and used everywhere else by name.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values (must match the reference behaviour)
# ---------------------------------------------------------------------------
# price_tier thresholds on the raw discount percent: >=50, >=20, >0, else
TIER_DEEP_DISCOUNT = 50
TIER_ON_SALE = 20
PRICE_TIERS = ["full_price", "minor_discount", "on_sale", "deep_discount"]
PRICE_DIRECTIONS = ["decreased", "increased", "unchanged", "first_seen"]
MOVER_DIRECTIONS = ["decreased", "increased"]

MOVERS_TOP_K = 20
DEALS_TOP_K = 10
DEAL_MIN_DISCOUNT_PCT = 30
DEAL_MIN_REVIEWS = 50
FRESH_DROP_PCT = -10
REPORT_LIMIT = 10

# the currency sign stripped by the price parser, with commas and whitespace
CURRENCY_SIGN = "₱"  # ₱

# ---------------------------------------------------------------------------
# Engine settings
# ---------------------------------------------------------------------------
# A key is split over several tasks only when it holds more rows than an
# average shuffle partition and more than this (smaller keys fit one task).
HOT_KEY_MIN_ROWS = 1_000_000


def configure(spark: SparkSession) -> SparkSession:
    """Session settings every plan relies on.

    * UTC session zone: day truncation and hour extraction follow it.
    * AQE with skew-join splitting and partition coalescing.
    """
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


SCRATCH_FLAG = "pricelens.checkpoint.scratch"


def lasting_checkpoint_dir(spark: SparkSession) -> str:
    """``checkpoint_dir`` for what must outlive the session (a stream's progress)."""
    folder = checkpoint_dir(spark)
    if spark.conf.get(SCRATCH_FLAG, "false") == "true":
        raise ValueError("name a checkpoint folder, or set spark.checkpoint.dir")
    return folder


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset
    (local tests) a scratch folder is created and registered.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="pricelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
        spark.conf.set(SCRATCH_FLAG, "true")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def local_session(app: str = "pricelens", cores: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PRICELENS_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
