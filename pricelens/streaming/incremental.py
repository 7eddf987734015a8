"""Incremental load of the landing folder with Structured Streaming.

The file source remembers which landed files it has processed (in the
checkpoint), and each micro-batch runs the batch ingest and appends under a
load id made of the stream's name, its query id and the batch id. The query id
is fixed by the checkpoint: a batch replayed after a failure replaces its own
load whole (the append is exactly once), and a stream with another checkpoint
has loads of its own, whatever its name.

Without a page cap the stream loads every page, whichever trigger its run's
other pages come with. With one, the state of the open runs is a table of each
load and the next batch goes on from it (see ``plans.open_runs``): pages may
come in any order, and what waits is appended once the gap before it is filled.
Runs are closed while batches come in; ``close_runs`` does so at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pricelens import config
from pricelens.plans import jobs
from pricelens.sources import landed, store


def landing_stream(spark: SparkSession, landed_dir: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(landed.PAGE_WITH_CORRUPT).options(**landed.JSON_OPTIONS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.json(landed_dir)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a stream keeps over restarts; Spark writes it to the checkpoint before the first batch."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def _loads(spark: SparkSession, warehouse: str, prefix: str) -> list[str]:
    """The stream's committed loads in their order; a load that closes runs follows its batch."""
    return sorted(i for i in store.commits(spark, warehouse) if i.startswith(prefix))


def close_runs(spark: SparkSession, warehouse: str, checkpoint: str, max_pages: int,
               keywords: Sequence[str] | None = None, name: str = "snapshot_load", patience: float = 0) -> dict | None:
    """Close the runs without a page for ``patience`` seconds, once a stopped stream has no more to read.

    The pages that still wait are recorded as left out, in a load of their
    own. Returns its counts, or None if the stream has loaded nothing yet.
    """
    query = query_id(spark, checkpoint)
    loads = _loads(spark, warehouse, f"{name}-{query}-")
    if not loads:
        return None
    batch, _, closed = loads[-1].removeprefix(f"{name}-{query}-").partition("-closed")
    if str(int(batch)) not in store.names(spark, f"{checkpoint.rstrip('/')}/commits"):
        raise ValueError(f"batch {int(batch)} of the stream is not done; let the stream finish it first")
    load_id = f"{name}-{query}-{batch}-closed{int(closed or 0) + 1:06d}"
    none = spark.createDataFrame([], landed.PAGE_WITH_CORRUPT)
    return jobs.load_pages(spark, none, warehouse, keywords, max_pages, load_id, query, loads[-1], patience)


def start_incremental_load(
    spark: SparkSession,
    landed_dir: str,
    warehouse: str,
    checkpoint: str | None = None,
    keywords: Sequence[str] | None = None,
    name: str = "snapshot_load",
    available_now: bool = True,
    max_pages: int | None = None,
    patience: float = 86_400,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops once caught up.

    ``max_pages`` keeps each run's prefix of at most that many pages, as the
    batch job does; a run is closed after ``patience`` seconds without a page.

    The checkpoint defaults to ``<spark.checkpoint.dir>/<name>``, the shared
    folder the cluster names in the session; without one it must be given,
    since a scratch folder would forget what has been loaded.
    """
    config.configure(spark)
    checkpoint = checkpoint or f"{config.lasting_checkpoint_dir(spark).rstrip('/')}/{name}"
    store.bootstrap(spark, warehouse)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query = query_id(session, checkpoint)
        load_id, resume = f"{name}-{query}-{batch_id:09d}", None
        if max_pages is not None:
            earlier = [i for i in _loads(session, warehouse, f"{name}-{query}-") if i < load_id]
            resume = earlier[-1] if earlier else None
        jobs.load_pages(session, batch, warehouse, keywords, max_pages, load_id, query, resume,
                        None if max_pages is None else patience)

    writer = landing_stream(spark, landed_dir, max_files).writeStream.foreachBatch(load_batch)
    writer = writer.option("checkpointLocation", checkpoint).queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
