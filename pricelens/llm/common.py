"""Helpers shared by the training-data operators.

Intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir`` (see ``config.checkpoint_dir``): every executor and
the driver see them, so a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.config import checkpoint_dir

# White space of the contracts: \x20 and \x09-\x0D. It is what bytes.split()
# and bytes.strip() use, so UTF-8 bytes are split without decoding.
SPACE_CLASS = r"[\x20\x09-\x0D]"
BATCH_ROWS = 1000
LOT_BYTES = 8 << 20


_scope: ContextVar[list[str] | None] = ContextVar("staged_tables", default=None)


@contextmanager
def scratch_tables(spark: SparkSession):
    """Deletes the tables that were staged inside, but for lasting ones, at the end.

    What was built inside must have been written by then: a frame that still
    reads one of those tables fails. Without a scope staged tables stay, since
    an operator returns a frame that its caller has yet to run.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None and not lasting:
        scope.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose rows go to Python at most ``BATCH_ROWS`` at a time from now on.

    Whole texts are long: a batch of the usual 10,000 rows would hold tens of
    megabytes several times over.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


def lots(batches: Iterator[pa.RecordBatch], size: int = LOT_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, small ones joined until they hold ``size`` bytes."""
    held, held_bytes = [], 0
    for batch in batches:
        held.append(batch)
        held_bytes += batch.nbytes
        if held_bytes >= size:
            yield pa.concat_batches(held)
            held, held_bytes = [], 0
    if held:
        yield pa.concat_batches(held)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, *columns) -> DataFrame:
    """One struct ``row`` with every input column, beside the named columns.

    Operators work on their own names; the input travels inside ``row``, so
    no column of a caller can clash with them.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    return df.select(whole, *columns)


def unpacked(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("row.*", *extra)


def text_of(column="text"):
    """The document's text, empty where it is NULL."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8 bytes (NULL becomes empty)."""
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.binary())
    return [b or b"" for b in column.to_pylist()]
