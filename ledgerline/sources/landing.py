"""Landing envelope: change documents as they arrive from the CDC feed (O-01, O-02).

Schema: ``data VARIANT, op STRING, topic STRING, database_type STRING, ts_ms TIMESTAMP,
inserted_at TIMESTAMP`` stored as Parquet partitioned by ``landing_date = to_date(inserted_at)``,
so a high-water-mark read prunes whole days before any file is opened.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = ["data", "op", "topic", "database_type", "ts_ms", "inserted_at"]
PARTITION_COL = "landing_date"


def _lit_ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.lit(v).cast("timestamp")
    return F.lit(v)


def to_landing(
    df: DataFrame,
    doc: Column,
    op: Column | str = "c",
    ts_ms=None,
    inserted_at=None,
    topic: str | None = None,
    database_type: str = "mongodb",
) -> DataFrame:
    """Turn typed rows into change documents plus envelope (O-02).

    ``doc`` is a struct column (serialised to JSON and parsed to VARIANT, as the seed script does
    with ``PARSE_JSON(FORMAT(...))``) or an existing VARIANT. NULL struct fields are left out of
    the document, which reads back as a missing path (NULL), like a JSON null.
    """
    data = doc if _is_variant(df, doc) else F.parse_json(F.to_json(doc))
    return df.select(
        data.alias("data"),
        (F.lit(op) if isinstance(op, str) else op).cast("string").alias("op"),
        F.lit(topic).cast("string").alias("topic"),
        F.lit(database_type).cast("string").alias("database_type"),
        _lit_ts(ts_ms).cast("timestamp").alias("ts_ms"),
        _lit_ts(inserted_at).cast("timestamp").alias("inserted_at"),
    )


def _is_variant(df: DataFrame, c: Column) -> bool:
    try:
        return df.select(c).schema[0].dataType.typeName() == "variant"
    except Exception:
        return False


def write_landing(df: DataFrame, path: str, mode: str = "append", files: int | None = None) -> None:
    """Append landed documents, one directory per landing day (``files``: spread the documents
    over that many write tasks, so later shredding gets one task per core)."""
    if files:
        df = df.repartition(files)
    (
        df.withColumn(PARTITION_COL, F.to_date("inserted_at"))
        .write.mode(mode)
        .partitionBy(PARTITION_COL)
        .parquet(path)
    )


def read_landing(spark: SparkSession, path: str, since: dt.datetime | None = None) -> DataFrame:
    """Scan a landing table (O-01), optionally only rows landed strictly after ``since``.

    ``since`` is a literal (collected once by the caller), so the predicate reaches the Parquet
    scan as a pushed filter and the partition filter prunes landing days. The day bound keeps one
    day of slack, so a writer whose session time zone differed from this reader's cannot make the
    pruning drop rows; the exact ``inserted_at`` predicate still decides.
    """
    df = spark.read.parquet(path)
    if since is not None:
        first_day = F.date_sub(F.to_date(F.lit(since)), 1)
        df = df.filter((F.col(PARTITION_COL) >= first_day) & (F.col("inserted_at") > F.lit(since)))
    return df.select(*ENVELOPE)


def empty_landing(spark: SparkSession) -> DataFrame:
    """No documents, with the envelope's columns: stands in where only a plan's schema is asked for."""
    schema = "data variant, op string, topic string, database_type string, ts_ms timestamp, inserted_at timestamp"
    return spark.createDataFrame([], schema)
