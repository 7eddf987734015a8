"""Snapshot table and mart tables as Parquet folders under a warehouse path.

Layout::

    <warehouse>/raw/<table>/load_id=<id>/attempt=<a>/[snapshot_day=<date>/]*.parquet
    <warehouse>/commits/<load id>~<n>~<attempt>.json
    <warehouse>/marts/<name>/version=<n>/snapshot_day=<date>/*.parquet
    <warehouse>/published/<n>.json

The raw tables are append-only (S5-S7). Every attempt at a load writes folders
of its own, and its commit record, written last, names them all: readers trust
nothing else, so a load is visible whole or not at all. A retried load takes
the place of its earlier attempt; distinct loads accumulate (re-running a
capture adds rows, as before). A load belongs to its writer: another one (a
stream with another checkpoint) cannot replace it.

Marts are written by day (S12): a version holds the days that were rebuilt. A
publication record, written after the checks have passed, names the version of
every day of every mart and the loads they were built from. Readers take the
newest record, so a rebuild that fails leaves them where they were.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.schema import MART_SCHEMAS, SNAPSHOT, SNAPSHOT_COLUMNS

RAW_TABLE = "raw/price_snapshots"
PAGES_TABLE = "raw/pages"
CUT_TABLE = "raw/pages_cut"
PROGRESS_TABLE = "raw/page_progress"
REJECTS_TABLE = "raw/rejects"
PAGE_COUNTS_TABLE = "raw/page_counts"
MALFORMED_TABLE = "raw/malformed_pages"
SKIPPED_TABLE = "raw/skipped_pages"
CHECKED_TABLE = "raw/checked"
DAY = "snapshot_day"
KEPT_RECORDS = 2  # the newest publication, and the one a reader may be in

STORED_SNAPSHOT = T.StructType(SNAPSHOT.fields + [
    T.StructField("load_id", T.StringType(), True), T.StructField("attempt", T.StringType(), True),
    T.StructField(DAY, T.DateType(), True)])


def path(warehouse: str, table: str) -> str:
    return f"{warehouse.rstrip('/')}/{table}"


def new_load_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


# --- small files and folders, by the file system that the path names

def _fs(spark: SparkSession, target: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def names(spark: SparkSession, folder: str) -> list[str]:
    fs, at = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _delete(spark: SparkSession, folder: str) -> None:
    fs, at = _fs(spark, folder)
    fs.delete(at, True)


def _put(spark: SparkSession, target: str, record: dict) -> None:
    """Write a record under a name that appears with its whole content."""
    fs, at = _fs(spark, target)
    draft = at.suffix(f".{uuid.uuid4().hex}.draft")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    if fs.exists(at) or not fs.rename(draft, at):
        fs.delete(draft, False)
        raise FileExistsError(f"another writer was first: {target}")


def _get(spark: SparkSession, target: str) -> dict:
    fs, at = _fs(spark, target)
    stream = fs.open(at)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


# --- loads

def commits(spark: SparkSession, warehouse: str) -> dict[str, dict]:
    """The newest commit record of every load, by load id."""
    folder, newest = path(warehouse, "commits"), {}
    for name in names(spark, folder):  # sorted: a later record of a load comes after its earlier ones
        load_id, _, rest = name.removesuffix(".json").partition("~")
        if rest and name.endswith(".json"):
            newest[load_id] = name
    return {i: _get(spark, f"{folder}/{name}") for i, name in newest.items()}


class Load:
    """One attempt at a load: tables are written to its own folders, then committed together."""

    def __init__(self, spark: SparkSession, warehouse: str, load_id: str | None = None, owner: str = ""):
        self.spark, self.warehouse, self.owner = spark, warehouse, owner
        self.load_id, self.attempt = load_id or new_load_id(), uuid.uuid4().hex[:12]
        if not re.fullmatch(r"[A-Za-z0-9._-]+", self.load_id):
            raise ValueError(f"not a load id: {self.load_id!r}")
        self.before = commits(spark, warehouse).get(self.load_id)
        if self.before and self.before["owner"] != owner:
            raise ValueError(f"load {self.load_id} was written by {self.before['owner'] or 'a batch job'}")
        self.tables: dict[str, str] = {}

    def folder(self, table: str) -> str:
        return f"{path(self.warehouse, table)}/load_id={self.load_id}/attempt={self.attempt}"

    def write(self, df: DataFrame, table: str, *partitions: str) -> DataFrame:
        """Write the load's share of a raw table; returns it as stored."""
        target = self.folder(table)
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(target)
        self.tables[table] = target
        return self.spark.read.schema(df.schema).parquet(target)

    def append(self, snapshots: DataFrame) -> int:
        """Write the snapshots; returns their number, observed while they are written."""
        obs = Observation(f"append_{uuid.uuid4().hex[:8]}")
        batch = snapshots.select(*SNAPSHOT_COLUMNS, F.to_date("scraped_at").alias(DAY))
        # rebalanced on the day: a backfill spanning many days writes a few files
        # per day instead of one per task and day, and a single large day (the
        # daily load) is split by AQE into advisory-sized tasks
        batch = batch.hint("rebalance", DAY).sortWithinPartitions(DAY, "item_id")
        self.write(batch.observe(obs, F.count(F.lit(1)).alias("rows")), RAW_TABLE, DAY)
        return int(obs.get.get("rows", 0) or 0)

    def commit(self, **counts) -> dict:
        """Make the load visible: all of its tables at once."""
        days = [n.partition("=")[2] for n in names(self.spark, self.folder(RAW_TABLE)) if n.startswith(f"{DAY}=")]
        n = self.before["n"] + 1 if self.before else 1
        record = {"load_id": self.load_id, "n": n, "owner": self.owner, "attempt": self.attempt, "days": days,
                  "tables": self.tables, "counts": counts}
        _put(self.spark, f"{path(self.warehouse, 'commits')}/{self.load_id}~{n:09d}~{self.attempt}.json", record)
        # what earlier attempts left behind goes, but for the one a reader may be in
        kept = {f"attempt={a}" for a in (self.attempt, (self.before or {}).get("attempt"))}
        for table in self.tables:
            folder = f"{path(self.warehouse, table)}/load_id={self.load_id}"
            for name in names(self.spark, folder):
                if name.startswith("attempt=") and name not in kept:
                    _delete(self.spark, f"{folder}/{name}")
        return record


def bootstrap(spark: SparkSession, warehouse: str) -> None:
    """Create the empty snapshot table if it does not exist."""
    fs, at = _fs(spark, path(warehouse, RAW_TABLE))
    fs.mkdirs(at)


def read_raw(spark: SparkSession, warehouse: str, table: str, schema: T.StructType) -> DataFrame:
    """A raw table: the committed loads' shares of it."""
    folders = [r["tables"][table] for r in commits(spark, warehouse).values() if table in r["tables"]]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path(warehouse, table)).parquet(*folders)


def read_snapshots(spark: SparkSession, warehouse: str, days: Collection[str] | None = None) -> DataFrame:
    """The snapshot table in its column order (partition columns dropped).

    With ``days`` (ISO dates) only the folders of those days are read.
    """
    raw = read_raw(spark, warehouse, RAW_TABLE, STORED_SNAPSHOT)
    if days is not None:
        raw = raw.filter(F.col(DAY).isin([dt.date.fromisoformat(d) for d in days]))
    return raw.select(*SNAPSHOT_COLUMNS)


def append_snapshots(snapshots: DataFrame, warehouse: str, load_id: str | None = None) -> int:
    """Append a batch; returns the number of rows written (0 for an empty batch)."""
    load = Load(snapshots.sparkSession, warehouse, load_id)
    rows = load.append(snapshots)
    load.commit(appended=rows)
    return rows


def row_count(spark: SparkSession, warehouse: str) -> int:
    """Total snapshots."""
    return read_snapshots(spark, warehouse).count()


# --- marts

def published(spark: SparkSession, warehouse: str) -> dict:
    """The newest publication: ``n``, ``marts`` (name -> day -> version), ``loads``, ``checks``."""
    records = [n for n in names(spark, path(warehouse, "published")) if n.endswith(".json")]
    if not records:
        return {"n": 0, "marts": {}, "loads": {}, "checks": []}
    return _get(spark, f"{path(warehouse, 'published')}/{records[-1]}")


def publish(spark: SparkSession, warehouse: str, before: dict, marts: dict[str, dict[str, int]], loads: dict,
            checks: list) -> None:
    """Make the versions of ``marts`` the ones that readers see, all at once."""
    folder = path(warehouse, "published")
    record = {"n": before["n"] + 1, "marts": marts, "loads": loads, "checks": checks}
    _put(spark, f"{folder}/{record['n']:09d}.json", record)
    used = [before["marts"], marts]
    for name in marts:
        kept = {v for m in used for v in m.get(name, {}).values()}
        target = path(warehouse, f"marts/{name}")
        for version in names(spark, target):
            number = int(version.partition("=")[2])
            if number not in kept and number < record["n"]:
                _delete(spark, f"{target}/{version}")
    for name in [n for n in names(spark, folder) if n.endswith(".json")][:-KEPT_RECORDS]:
        _delete(spark, f"{folder}/{name}")


def write_days(mart: DataFrame, warehouse: str, name: str, version: int) -> dict[str, int]:
    """Write the days of a mart that were rebuilt; returns them (day -> version).

    ``mart`` holds ``snapshot_date``. The rows are rebalanced on the day before
    the write (one shuffle, no sampling pass): AQE splits a day that is larger
    than the advisory size over several tasks and merges small days, so each
    day gets a few files of similar size whatever the skew between days. They
    are not visible before they are published.
    """
    target = f"{path(warehouse, f'marts/{name}')}/version={version:09d}"
    by_day = mart.withColumn(DAY, F.to_date("snapshot_date")).hint("rebalance", DAY)
    by_day.write.mode("overwrite").partitionBy(DAY).parquet(target)
    found = names(mart.sparkSession, target)
    return {n.partition("=")[2]: version for n in found if n.startswith(f"{DAY}=")}


def read_days(spark: SparkSession, warehouse: str, name: str, days: dict[str, int]) -> DataFrame:
    """The given days (day -> version) of a mart, with ``snapshot_day``."""
    schema = T.StructType([*MART_SCHEMAS[name].fields, T.StructField(DAY, T.DateType(), True)])
    if not days:
        return spark.createDataFrame([], schema)
    target = path(warehouse, f"marts/{name}")
    folders = [f"{target}/version={v:09d}/{DAY}={d}" for d, v in sorted(days.items())]
    stored = T.StructType([*schema.fields, T.StructField("version", T.IntegerType(), True)])
    return spark.read.schema(stored).option("basePath", target).parquet(*folders).drop("version")


def write_mart(mart: DataFrame, warehouse: str, name: str) -> None:
    """Full refresh of one mart table, published at once."""
    spark = mart.sparkSession
    before = published(spark, warehouse)
    days = write_days(mart, warehouse, name, before["n"] + 1)
    publish(spark, warehouse, before, before["marts"] | {name: days}, before["loads"], before["checks"])


def read_mart(spark: SparkSession, warehouse: str, name: str, keep_partition: bool = False) -> DataFrame:
    """A mart table as it was last published, empty if it has no rows or was never built.

    ``keep_partition`` keeps ``snapshot_day`` (DATE) so that day filters on it
    prune whole partitions.
    """
    df = read_days(spark, warehouse, name, published(spark, warehouse)["marts"].get(name, {}))
    return df if keep_partition else df.drop(DAY)
