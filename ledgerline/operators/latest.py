"""Latest row per key and the incremental slices in front of it (O-10, O-12, O-13)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import max_value

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_cols: Sequence[str | Column],
    tie_breakers: Sequence[str | Column] = (),
) -> DataFrame:
    """Keep one row per key: NULL keys dropped, then the first row by ``order_cols`` DESC (NULLs
    last), first column wins (O-10).

    Planned as ``row_number() = 1`` over a window: Catalyst inserts a *partial* WindowGroupLimit
    before the shuffle, so each map task forwards at most one row per key. A key holding a third of
    all rows therefore sends at most one row per input partition through the exchange.
    ``tie_breakers`` (DESC) make equal sort values deterministic.
    """
    keys = _keys(key)
    order = [
        (F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in list(order_cols) + list(tie_breakers)
    ]
    w = Window.partitionBy(*keys).orderBy(*order)
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    return df.filter(not_null).withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def slice_newer(df: DataFrame, ts_col: str, target: DataFrame | None) -> DataFrame:
    """Rows newer than the target's maximum (O-12).

    ``ts_ms`` (a TIMESTAMP) compares with ``COALESCE(max, 1970-01-01)``; any other column is an
    integer clock compared with ``COALESCE(max, 0)``. The maximum is collected to a literal.
    """
    default = EPOCH if ts_col == "ts_ms" else 0
    return df.filter(F.col(ts_col) > F.lit(max_value(target, ts_col, default)))


def slice_retention(df: DataFrame, ts_col: str, days: int, as_of: dt.datetime) -> DataFrame:
    """Rows inside a retention window (O-13).

    ``ts_ms``: ``ts > TIMESTAMP(as_of date - days)``; any other column holds integer nanoseconds:
    ``ts > unix_micros(as_of - days) * 1000``.
    """
    if ts_col == "ts_ms":
        start = dt.datetime.combine(as_of.date() - dt.timedelta(days=days), dt.time(), tzinfo=dt.timezone.utc)
        return df.filter(F.col(ts_col) > F.lit(start))
    start_ns = int(((as_of - dt.timedelta(days=days)) - EPOCH).total_seconds() * 1_000_000) * 1000
    return df.filter(F.col(ts_col) > F.lit(start_ns))


def dedup_slice(
    staged: DataFrame,
    key: str | Sequence[str],
    ts_col: str,
    order_cols: Sequence[str],
    target: DataFrame | None = None,
    retention_days: int | None = None,
    as_of: dt.datetime | None = None,
    tie_breakers: Sequence[str | Column] = (),
) -> DataFrame:
    """The source side of the dedup merge: slice (retention or high-water), then latest per key."""
    if retention_days is not None:
        sliced = slice_retention(staged, ts_col, retention_days, as_of)
    else:
        sliced = slice_newer(staged, ts_col, target)
    return latest_per_key(sliced, key, order_cols, tie_breakers)
