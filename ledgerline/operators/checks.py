"""Table-level data-quality checks (O-24..O-31).

Every check returns its violations as a DataFrame (pass = no rows), the way warehouse tests
compile to "rows that violate" queries. ``run_checks`` folds many checks into one report
DataFrame (``check, severity, violations, status``) evaluated as a single job: each check
contributes one partial-aggregated count, so no violating row ever reaches the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is NULL (O-24)."""
    return df.filter(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Non-null values of ``col`` occurring more than once, with their counts (O-25)."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Values of ``col`` outside ``values`` with their counts (O-26); NULL is not a violation."""
    return (
        df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
        .groupBy(F.col(col).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_expr(df: DataFrame, expr: str | Column) -> DataFrame:
    """Rows where ``expr`` is false (O-27); NULL passes, as ``WHERE NOT (expr)`` does."""
    e = F.expr(expr) if isinstance(expr, str) else expr
    return df.filter(~e)


def check_single_owner(
    df: DataFrame,
    id_col: str = "id",
    code_col: str = "code",
    owner_col: str = "merchant_code",
    prefix: str = "store",
    owner_name: str = "merchant",
) -> DataFrame:
    """Entities linked to more than one owner (O-28): by (id, code) and by code alone.

    Output: ``violation, {prefix}_id, {prefix}_code, {owner_name}_count``.
    """
    owned = df.filter(F.col(owner_col).isNotNull())
    n = F.countDistinct(owner_col).alias(f"{owner_name}_count")
    by_id = (
        owned.groupBy(id_col, code_col)
        .agg(n)
        .filter(F.col(f"{owner_name}_count") > 1)
        .select(
            F.lit(f"{prefix}_id_multiple_{owner_name}s").alias("violation"),
            F.col(id_col).cast("string").alias(f"{prefix}_id"),
            F.col(code_col).alias(f"{prefix}_code"),
            F.col(f"{owner_name}_count"),
        )
    )
    by_code = (
        owned.filter(F.col(code_col).isNotNull())
        .groupBy(code_col)
        .agg(n)
        .filter(F.col(f"{owner_name}_count") > 1)
        .select(
            F.lit(f"{prefix}_code_multiple_{owner_name}s").alias("violation"),
            F.lit(None).cast("string").alias(f"{prefix}_id"),
            F.col(code_col).alias(f"{prefix}_code"),
            F.col(f"{owner_name}_count"),
        )
    )
    return by_id.unionByName(by_code)


def check_matches_parent(
    child: DataFrame,
    parent: DataFrame,
    child_key: str = "store_code",
    parent_key: str = "code",
    child_attr: str = "merchant_code",
    parent_attr: str = "merchant_code",
    child_id: str = "transid",
) -> DataFrame:
    """Child rows whose attribute differs (NULL-safe) from their parent's (O-29).

    Output: ``transid, transaction_merchant_code, store_code, store_merchant_code, violation``.
    """
    c = child.filter(F.col(child_key).isNotNull()).select(
        F.col(child_id).alias("transid"), F.col(child_key).alias("__ck"), F.col(child_attr).alias("transaction_merchant_code")
    )
    p = parent.filter(F.col(parent_attr).isNotNull()).select(
        F.col(parent_key).alias("store_code"), F.col(parent_attr).alias("store_merchant_code")
    )
    return (
        c.join(p, c["__ck"] == p["store_code"], "inner")
        .filter(~F.col("transaction_merchant_code").eqNullSafe(F.col("store_merchant_code")))
        .select(
            "transid",
            "transaction_merchant_code",
            "store_code",
            "store_merchant_code",
            F.lit("transaction_merchant_mismatch_store").alias("violation"),
        )
    )


def check_freshness(
    df: DataFrame,
    col: str,
    now: dt.datetime,
    warn_after: dt.timedelta = dt.timedelta(hours=12),
    error_after: dt.timedelta = dt.timedelta(hours=24),
) -> DataFrame:
    """Source freshness (O-30): one row ``max_loaded_at, age_seconds, status`` where status is
    ``pass``, ``warn`` (age > warn_after) or ``error`` (age > error_after, or nothing loaded)."""
    age = F.lit(now).cast("timestamp").cast("long") - F.max(col).cast("long")
    return df.agg(F.max(col).alias("max_loaded_at"), age.alias("age_seconds")).select(
        "max_loaded_at",
        "age_seconds",
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > int(error_after.total_seconds())), "error")
        .when(F.col("age_seconds") > int(warn_after.total_seconds()), "warn")
        .otherwise("pass")
        .alias("status"),
    )


@dataclass
class Check:
    """A named check; ``violations`` is the DataFrame of violating rows (O-31: severity)."""

    name: str
    violations: DataFrame
    severity: str = "error"  # or "warn"


@dataclass
class RowCheck:
    """A check of single rows; ``violated`` is the condition of a violating row (NULL passes)."""

    name: str
    violated: Column
    severity: str = "error"  # or "warn"


def not_null(table: str, *cols: str) -> list[RowCheck]:
    """The ``RowCheck`` of O-24 for each of ``cols``."""
    return [RowCheck(f"{table}.{c}.not_null", F.col(c).isNull()) for c in cols]


def _row_counts(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """``check, severity, violations`` of all row checks of a table, from one scan of it."""
    rows = [
        F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), F.count_if(c.violated).alias("violations"))
        for c in checks
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


class CheckedWrite:
    """Row checks of a table counted by the very job that writes it (``DataFrame.observe``), so none scans it.

    ``Tables`` calls ``watch`` on the rows on their way to the files, above the last shuffle: a task that runs again
    there counts once. A merge writes some buckets only; it leaves the rows of the others in ``rest``, which are
    the only ones that ``counts`` reads. One object serves one write.
    """

    def __init__(self, checks: Sequence[RowCheck]):
        self.checks, self.rest, self._seen = list(checks), None, None

    def watch(self, df: DataFrame) -> DataFrame:
        if self._seen is not None:
            raise ValueError("a CheckedWrite serves one write")
        self._seen = Observation()
        counts = [F.count_if(c.violated).alias(f"c{i}") for i, c in enumerate(self.checks)]
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *counts)

    def counts(self, spark: SparkSession) -> DataFrame:
        """``check, severity, violations`` of the whole table; a merge that wrote nothing leaves all rows to ``rest``."""
        got = self._seen.get if self._seen is not None else {}
        rows = [
            F.struct(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), F.lit(got.get(f"c{i}", 0)).cast("long").alias("violations"))
            for i, c in enumerate(self.checks)
        ]
        out = spark.range(1).select(F.inline(F.array(*rows)))
        if self.rest is not None:
            both = out.unionByName(_row_counts(self.rest, self.checks))
            out = both.groupBy("check", "severity").agg(F.sum("violations").alias("violations"))
        return out


def run_checks(
    checks: Iterable[Check],
    row_checks: Iterable[tuple[DataFrame, Sequence[RowCheck]]] = (),
    written: Iterable[tuple[SparkSession, CheckedWrite]] = (),
) -> DataFrame:
    """One report row per check: ``check, severity, violations, status`` (pass / warn / fail).

    ``row_checks`` are (table, its row checks); each table is scanned once for all of them. ``written`` holds
    the checks that were counted while their tables were written."""
    parts = [
        c.violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), F.col("violations")
        )
        for c in checks
    ]
    parts += [_row_counts(df, own) for df, own in row_checks if own]
    parts += [w.counts(spark) for spark, w in written if w.checks]
    if not parts:
        raise ValueError("no checks given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn(
        "status",
        F.when(F.col("violations") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"),
    )
