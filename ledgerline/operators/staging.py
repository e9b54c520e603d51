"""Staging: shred landed documents into typed history rows (O-03..O-08).

One ``select`` per table: the document is parsed once (a VARIANT column, or ``try_parse_json`` of
text in its own projection), its top-level values are taken in one walk, scalars as text at once, and every spec column
is a built-in expression over one of them, so the plan is a single narrow stage: no shuffle, no Python. (A projection of all 131 columns is wider than the
whole-stage codegen limit and runs interpreted, which measured faster than raising that limit.)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonx import as_variant, field_cast_sql, field_type, json_query_sql, json_value, json_value_sql, nested_keys_sql, scalar_text_sql, top_values_sql
from ..sources.specs import Field, parse_spec

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def shred(
    df: DataFrame,
    spec: list[Field] | str,
    run_ts=None,
    json_col: str = "data",
    drop_columns: tuple[str, ...] = (),
    envelope: bool = True,
) -> DataFrame:
    """Document column -> typed columns per ``spec`` (O-03), plus the envelope and load stamp (O-08).

    Envelope columns are ``op, ts_ms, json_inserted_at`` (the landing time) and ``inserted_at``
    (``run_ts``, the staging run's clock). ``drop_columns`` leaves sensitive payload columns out.
    """
    fields = parse_spec(spec) if isinstance(spec, str) else spec
    is_text = dict(df.dtypes).get(json_col) == "string"
    src = df.withColumn("__doc", as_variant(json_col, is_text)) if is_text else df.withColumnRenamed(
        json_col, "__doc"
    )
    # Projections, one upon the other. The top-level values in one walk: a key that only scalar columns read as its text, any other as
    # a VARIANT, since reading a text from a VARIANT of its own costs more than the whole walk.
    paths = {f.name: f.path.partition(".") for f in fields if f.name not in drop_columns}
    fields = [f for f in fields if f.name in paths]
    keys = list(dict.fromkeys(paths[f.name][0] for f in fields))
    whole = {paths[f.name][0] for f in fields if paths[f.name][2] or field_type(f.dtype) is None}
    text = [k for k in keys if k not in whole]
    src = src.withColumn("__top", F.expr(top_values_sql("__doc", keys, text) if keys else "null")).withColumnRenamed("__doc", "__whole")
    if text:
        src = src.withColumn("__nested", F.expr(nested_keys_sql("__whole", [f"`__top`.`k{keys.index(k)}`" for k in text])))
    # Each column's text or VARIANT, once, as the casts name it several times.
    raw = []
    for i, f in enumerate(fields):
        key, _, rest = paths[f.name]
        v = f"`__top`.`k{keys.index(key)}`"
        if key not in whole:
            value = scalar_text_sql(v, "__nested", key)
        else:
            value = json_query_sql(v, rest) if field_type(f.dtype) is None else json_value_sql(v, rest)
        raw.append(f"{value} AS `__v{i}`")
    exprs = [
        f"{f'`__v{i}`' if field_type(f.dtype) is None else field_cast_sql(f'`__v{i}`', f.dtype)} AS `{f.name}`"
        for i, f in enumerate(fields)
    ]
    if envelope:
        src = src.withColumn("__run_ts", F.lit(run_ts).cast("timestamp"))
        raw += ["op", "ts_ms", "inserted_at", "__run_ts"]
        exprs += ["op", "ts_ms", "inserted_at AS json_inserted_at", "__run_ts AS inserted_at"]
    return src.selectExpr(*raw).selectExpr(*exprs)


def exact_max(df: DataFrame, col: str):
    """``MAX(col)`` as a Python value; None for no rows.

    A timestamp is collected as microseconds and returned with its zone: a naive local datetime would be an
    hour off where the clock is set back.
    """
    if isinstance(df.schema[col].dataType, T.TimestampType):
        v = df.agg(F.unix_micros(F.max(col)).alias("m")).first()["m"]
        return None if v is None else EPOCH + dt.timedelta(microseconds=v)
    return df.agg(F.max(col).alias("m")).first()["m"]


def max_value(df: DataFrame, col: str, default=EPOCH):
    """``COALESCE(MAX(col), default)`` of a (previous) table as a Python literal: one small action.

    Collecting the scalar first (instead of a scalar subquery) turns the later predicate into a
    literal that Parquet filter pushdown and partition pruning can use.
    """
    v = None if df is None else exact_max(df, col)
    return default if v is None else v


def since_watermark(df: DataFrame, col: str, target: DataFrame | None, target_col: str) -> DataFrame:
    """High-water-mark filter (O-04): rows with ``col > COALESCE(MAX(target.target_col), epoch)``.

    Strictly greater: a row landing later with a time equal to the stored maximum is skipped,
    as in the reference.
    """
    wm = max_value(target, target_col)
    return df.filter(F.col(col) > F.lit(wm))


def shred_or_quarantine(
    df: DataFrame, spec: list[Field] | str, run_ts=None, json_col: str = "data", key_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(staged rows, quarantined documents) of a landing with JSON **text**: every landed row is in one of the two.

    A document goes to quarantine if its text does not parse (which includes an object that repeats a key), if it
    is no object, or, with ``key_path``, if it holds no scalar there; a NULL document does as well. Quarantined
    rows keep the columns they landed with, and get ``reason`` and ``inserted_at_staging`` = ``run_ts``: mended
    documents can be landed again from there. Each document is parsed once per side; nothing is shuffled.
    """
    text = F.col(json_col)
    marked = df.withColumn("__doc", F.try_parse_json(text))
    is_object = F.expr("try_variant_get(__doc, '$', 'map<string,variant>') is not null")
    reason = F.when(text.isNull(), "no document").when(F.col("__doc").isNull(), "not parsable").when(~is_object, "not an object")
    if key_path:
        reason = reason.when(json_value("__doc", key_path).isNull(), "no key")
    marked = marked.withColumn("__reason", reason)
    good = marked.where("__reason is null").drop(json_col, "__reason").withColumnRenamed("__doc", json_col)
    bad = marked.where("__reason is not null").select(
        *df.columns, F.col("__reason").alias("reason"), F.lit(run_ts).cast("timestamp").alias("inserted_at_staging")
    )
    return shred(good, spec, run_ts, json_col), bad
