"""Keyed upsert (MERGE: update matched, insert new, never delete) as a pure DataFrame function
(O-11, O-22)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateSourceKeys(ValueError):
    """Raised when two source rows share a key: a warehouse MERGE fails in that case too."""


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def duplicate_keys(source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Non-null keys occurring more than once (partial counts are combined map-side)."""
    keys = _keys(key)
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    return source.filter(nn).groupBy(*keys).count().filter("count > 1")


def assert_unique_source(source: DataFrame, key) -> None:
    dup = duplicate_keys(source, key).limit(5).collect()
    if dup:
        raise DuplicateSourceKeys(f"source rows share a merge key, e.g. {[r.asDict() for r in dup]}")


def upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``target`` with ``source`` merged in on ``key``: target rows whose key appears in the source
    are replaced, new keys inserted, nothing deleted. The result has the target's columns.

    ``target ⟕anti source[key] ∪ source``. NULL keys never match, so NULL-key source rows are
    inserted (again) and NULL-key target rows are kept, as with SQL ``MERGE ... ON t.k = s.k``.
    The anti join reads only the source's key column; AQE broadcasts it when its measured size is
    under the threshold and otherwise shuffles both sides on the key.
    """
    keys = _keys(key)
    cols = target.columns
    src = source.select(*cols)
    kept = target.join(src.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(src)
