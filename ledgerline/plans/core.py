"""Core "latest per key" tables from staged history: full rebuild or slice-and-merge (O-06, O-10..O-13).

This is the DataFrame form of the reference's dedup materialization: on a first run (or full
refresh) the latest row per ``id`` of all staged rows; on later runs only staged rows newer than
the core's ``max(ts_ms)`` are de-duplicated and merged in on ``id``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.latest import dedup_slice, latest_per_key
from ..operators.upsert import upsert
from ..sources.specs import Field, parse_spec

KEY = "id"
TS = "ts_ms"
ORDER = ("ts_ms",)
# Equal ts_ms for one key: prefer the later landing, so re-runs pick the same row.
TIE_BREAKERS = ("json_inserted_at",)


def tie_breakers(staged: DataFrame) -> list:
    """Landing time, then a hash of the content: rows equal in both give one answer in any file layout.
    The load stamp is no part of the content."""
    cols = [
        F.col(f.name).cast("string") if f.dataType.typeName() == "variant" else F.col(f.name)
        for f in staged.schema.fields
        if f.name != "inserted_at"
    ]
    return [*TIE_BREAKERS, F.xxhash64(*cols)]


def core_projection(staged: DataFrame, spec: list[Field] | str, run_ts, keep_source_stamp: bool = False) -> DataFrame:
    """Core columns: payload + ``ts_ms`` (+ ``source_inserted_at``) + ``inserted_at = run_ts``."""
    fields = parse_spec(spec) if isinstance(spec, str) else spec
    cols = [F.col(f.name) for f in fields] + [F.col("ts_ms")]
    if keep_source_stamp:
        cols.append(F.col("inserted_at").alias("source_inserted_at"))
    cols.append(F.lit(run_ts).cast("timestamp").alias("inserted_at"))
    return staged.select(*cols)


def core_full(staged: DataFrame, spec, run_ts, keep_source_stamp: bool = False) -> DataFrame:
    latest = latest_per_key(staged, KEY, ORDER, tie_breakers(staged))
    return core_projection(latest, spec, run_ts, keep_source_stamp)


def core_increment(
    core_prev: DataFrame,
    staged: DataFrame,
    spec,
    run_ts,
    keep_source_stamp: bool = False,
    retention_days: int | None = None,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Deduplicated slice of staged rows to merge into ``core_prev``."""
    src = dedup_slice(staged, KEY, TS, ORDER, core_prev, retention_days, as_of, tie_breakers(staged))
    return core_projection(src, spec, run_ts, keep_source_stamp)


def core_merge(
    core_prev: DataFrame | None, staged: DataFrame, spec, run_ts, keep_source_stamp: bool = False,
    stored: Callable[[DataFrame], DataFrame] | None = None, **kw,
) -> DataFrame:
    """Next core snapshot: full build when there is no previous one, else slice + upsert on ``id``.

    The upsert names its source twice (the keys it replaces, the rows it adds). ``stored`` writes the increment and
    reads it back, so that its documents are shredded, sorted and shuffled once."""
    if core_prev is None:
        return core_full(staged, spec, run_ts, keep_source_stamp)
    inc = core_increment(core_prev, staged, spec, run_ts, keep_source_stamp, **kw)
    return upsert(core_prev, stored(inc) if stored else inc, KEY)
