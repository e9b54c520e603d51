"""Streaming staging of landed files (O-09), a sink that holds every batch exactly once.

The CDC feed lands change documents as Parquet files; a Structured Streaming file source picks up
each new file exactly once (its checkpoint is the high-water mark), and every micro-batch is shredded
with the same projection as batch staging and appended as one load of a staging table. The batch id is
kept with the rows (``load_id``), and a load that is written again replaces itself: a micro-batch that
Spark repeats after a failure leaves the table as it was. ``plans.job.build_mart(streamed=True)`` starts from
these tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.staging import shred
from ..plans.tables import Tables
from ..session import configure, scratch_path
from ..sources import adapters as A
from ..sources.landing import ENVELOPE, write_landing


def staging_sink(tables: Tables, name: str, spec, run_ts: dt.datetime | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: the documents of micro-batch n become load ``stream-n`` of table ``name``.

    ``run_ts=None`` stamps each micro-batch with its own start time (the warehouse's
    ``CURRENT_TIMESTAMP()``); a fixed value makes reruns reproducible.
    """

    def write_batch(df: DataFrame, batch_id: int) -> None:
        stamp = run_ts or dt.datetime.now(dt.timezone.utc)
        tables.append(name, shred(df.select(*ENVELOPE), spec, stamp), f"stream-{batch_id:012d}")

    return write_batch


def stream_staging(
    tables: Tables,
    name: str,
    landing_path: str,
    checkpoint_path: str,
    spec,
    run_ts: dt.datetime | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start the stream into staging table ``name``; with ``available_now`` it processes everything landed so far
    and stops."""
    spark = tables.spark
    reader = spark.readStream.schema(spark.read.parquet(landing_path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    w = reader.parquet(landing_path).writeStream.foreachBatch(staging_sink(tables, name, spec, run_ts))
    w = w.option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_staging_once(spark: SparkSession, sf_dir: str, run_ts: dt.datetime | None = None) -> DataFrame:
    """Land the event stream as files, stage it with the streaming job, return the staged rows."""
    configure(spark)
    root = scratch_path(spark, "stream-staging")
    write_landing(A.events_landing(spark, sf_dir), f"{root}/landing", files=spark.sparkContext.defaultParallelism)
    tables = Tables(spark, root)
    run = run_ts or dt.datetime(2024, 1, 15, 1, 0, tzinfo=dt.timezone.utc)
    stream_staging(tables, "staging", f"{root}/landing", f"{root}/_checkpoint", A.CDC_SPEC, run).awaitTermination()
    return tables.read("staging").select(
        "id", "event_id", "event_type", "value", "k", "op", "ts_ms", "json_inserted_at", "inserted_at"
    )
