"""Column expressions for JSON documents held as VARIANT.

Every function returns Spark SQL built from built-in functions only, so the whole shredding
projection stays inside whole-stage codegen (no Python on the executors). Each function exists in
two forms: ``*_sql`` gives the expression text (a shred of 127 columns is then a single
``selectExpr`` call) and the plain name gives a ``Column``.

Semantics follow the reference warehouse's functions:

* ``json_value``  – scalar at a path as STRING; NULL for a missing path, a JSON null, or an
  object/array (the string ``"{x}"`` is a scalar and survives).
* ``json_query``  – the JSON value at a path (VARIANT), JSON null kept as a variant null.
* ``safe_cast``   – cast a scalar string, NULL instead of an error, with the warehouse's rules
  where Spark is more lenient (booleans only accept true/false).
* ``extract_epoch`` / ``extract_epoch_or_iso`` / ``extract_epoch_days`` – epoch numbers (ms/us/ns)
  or ISO-8601 ``...Z`` strings to TIMESTAMP / DATE.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest instants the warehouse TIMESTAMP can hold (9999-12-31 23:59:59.999999 UTC).
MAX_EPOCH_MS = 253_402_300_799_999
MAX_EPOCH_US = 253_402_300_799_999_999
# Day numbers of 0001-01-01 and 9999-12-31 relative to 1970-01-01.
MIN_EPOCH_DAY, MAX_EPOCH_DAY = -719_162, 2_932_896

# Patterns (Java regex inside Spark SQL string literals; \z because Java's $ also matches before a
# trailing newline).
_EPOCH_RE = r"^[0-9]+\\.?[0-9]*\\z"
_ISO_PREFIX_RE = r"^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}"
_ISO_FRACTION_RE = r"^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}\\.\\d{1,6}Z\\z"
_ISO_SECONDS_RE = r"^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}Z\\z"
_HAS_FRACTION_RE = r"\\.\\d"
_INT_RE = r"^[+-]?[0-9]+\\z"


def _ident(col: str) -> str:
    return col if col.startswith("`") or "(" in col else f"`{col}`"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def json_path(path: str) -> str:
    """Dot path to a bracket-quoted variant path: ``_id.$oid`` -> ``$["_id"]["$oid"]``.

    Quoting keeps keys such as ``$oid``/``$date`` literal. Like the reference, a key that itself
    contains a dot cannot be addressed. An empty path is the document itself.
    """
    return "$" + "".join(f'["{k}"]' for k in path.split(".") if path)


def spark_type(word: str) -> T.DataType | None:
    """Type word used in a column spec -> Spark type (None = keep the VARIANT).

    Checked in this order: JSON, BOOL, DOUBLE/FLOAT/REAL, NUMERIC/DECIMAL, the integer words,
    else STRING. NUMERIC(p,s) drops its precision/scale and becomes decimal(38,9).
    """
    t = word.upper()
    if "JSON" in t:
        return None
    if "BOOL" in t:
        return T.BooleanType()
    if "DOUBLE" in t or "FLOAT" in t or "REAL" in t:
        return T.DoubleType()
    if "NUMERIC" in t or "DECIMAL" in t:
        return T.DecimalType(38, 9)
    if t in ("INT", "INTEGER", "INT64", "BIGINT", "SMALLINT"):
        return T.LongType()
    return T.StringType()


def as_variant(col: Column | str, is_text: bool = False) -> Column:
    """Parse JSON text once into a VARIANT (malformed text -> NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_parse_json(c) if is_text else c


# ----------------------------------------------------------------------------- SQL text forms
def json_query_sql(v: str, path: str) -> str:
    return f"try_variant_get({_ident(v)}, {_lit(json_path(path))}, 'variant')"


def top_values_sql(v: str, keys: list[str], text: Collection[str] = ()) -> str:
    """The values of a document's top-level ``keys`` as one struct ``k0, k1, ...`` (NULL: missing), as VARIANTs, those of
    the keys in ``text`` as STRING (of an object or array its JSON text, see ``scalar_text_sql``).

    The document is walked once; a path per key walks it once for each, keys that it lacks included. The cast only
    renames, so keys that differ in case alone are told apart.
    """
    kind = ["string" if k in text else "variant" for k in keys]
    found = ", ".join(f"`{k.replace('`', '``')}`: {t}" for k, t in zip(keys, kind))
    named = ", ".join(f"k{i}: {t}" for i, t in enumerate(kind))
    return f"cast(try_variant_get({_ident(v)}, '$', {_lit(f'struct<{found}>')}) AS struct<{named}>)"


def _container_sql(v: str, p: str) -> str:
    return (
        f"(try_variant_get({v}, {p}, 'map<string,variant>') IS NOT NULL "
        f"OR try_variant_get({v}, {p}, 'array<variant>') IS NOT NULL)"
    )


def nested_keys_sql(v: str, texts: list[str]) -> str:
    """The top-level keys of ``v`` that hold objects or arrays; NULL, without a look at ``v``, if none of ``texts``
    starts like one. The tests are joined in groups of four, as one long chain is too deep to be parsed."""
    starts = [f"(startswith({s}, '{{') OR startswith({s}, '['))" for s in texts]
    while len(starts) > 1:
        starts = [f"({' OR '.join(starts[i:i + 4])})" for i in range(0, len(starts), 4)]
    nested = f"map_keys(map_filter(try_variant_get({_ident(v)}, '$', 'map<string,variant>'), (k, x) -> {_container_sql('x', _lit('$'))}))"
    return f"(CASE WHEN {starts[0]} THEN {nested} END)"


def scalar_text_sql(s: str, nested: str, key: str) -> str:
    """``s``, the text of the value at top-level ``key``, if that is a scalar; NULL if ``nested`` (``nested_keys_sql``) has the key."""
    n = _ident(nested)
    return f"(CASE WHEN {n} IS NOT NULL AND array_contains({n}, {_lit(key)}) THEN CAST(NULL AS STRING) ELSE {s} END)"


def json_value_sql(v: str, path: str) -> str:
    """Scalar at ``path`` as STRING, NULL for objects and arrays.

    The string form is taken first; only when it starts like an object/array is the (costlier)
    container test made, and the test looks at the value's type, never at its text.
    """
    v, p = _ident(v), _lit(json_path(path))
    s = f"try_variant_get({v}, {p}, 'string')"
    return f"(CASE WHEN substr({s}, 1, 1) IN ('{{', '[') AND {_container_sql(v, p)} THEN CAST(NULL AS STRING) ELSE {s} END)"


def safe_cast_sql(s: str, dtype: T.DataType) -> str:
    """SAFE_CAST of a scalar string to ``dtype`` with the warehouse's acceptance rules."""
    if isinstance(dtype, T.StringType):
        return s
    if isinstance(dtype, T.BooleanType):
        return f"(CASE WHEN lower({s}) IN ('true', 'false') THEN lower({s}) = 'true' END)"
    if isinstance(dtype, T.LongType):
        # integer text only: an optional sign and digits (Spark would also trim blanks)
        return f"(CASE WHEN {s} RLIKE '{_INT_RE}' THEN try_cast({s} AS BIGINT) END)"
    if isinstance(dtype, T.DoubleType):
        # Spark also takes a Java suffix ('5d', '5f'); only infinities may end in f
        return f"(CASE WHEN {s} RLIKE '(?i)[df] *$' AND NOT {s} RLIKE '(?i)inf *$' THEN NULL ELSE try_cast({s} AS DOUBLE) END)"
    return f"try_cast({s} AS {dtype.simpleString()})"


def extract_sql(v: str, path: str, dtype: str = "STRING") -> str:
    """``extract_json``: JSON words keep the VARIANT, others take the scalar and safe-cast it."""
    t = spark_type(dtype)
    if t is None:
        return json_query_sql(v, path)
    return safe_cast_sql(json_value_sql(v, path), t)


def _epoch_number_sql(raw: str, unit: str) -> str:
    x = f"try_cast({raw} AS DOUBLE)"
    if unit == "ms":
        n = f"try_cast(round({x}) AS BIGINT)"
        return f"(CASE WHEN {n} <= {MAX_EPOCH_MS} THEN timestamp_millis({n}) END)"
    if unit == "us":
        n = f"try_cast(round({x}) AS BIGINT)"
        return f"(CASE WHEN {n} <= {MAX_EPOCH_US} THEN timestamp_micros({n}) END)"
    if unit == "ns":
        n = f"try_cast(round({x} / 1000.0) AS BIGINT)"
        return f"(CASE WHEN {n} <= {MAX_EPOCH_US} THEN timestamp_micros({n}) END)"
    return "CAST(NULL AS TIMESTAMP)"


def epoch_text_to_ts_sql(raw: str, unit: str = "ms") -> str:
    """Epoch number held as text (ms/us/ns) -> TIMESTAMP; anything not a bare number -> NULL.

    Fractions round half away from zero (the warehouse's FLOAT64 -> INT64 rule). Negative and
    exponent forms are NULL. Out-of-range values are NULL (the warehouse would raise).
    """
    return f"(CASE WHEN {raw} IS NOT NULL AND {raw} RLIKE '{_EPOCH_RE}' THEN {_epoch_number_sql(raw, unit)} END)"


def extract_epoch_sql(v: str, path: str, unit: str = "ms") -> str:
    return epoch_text_to_ts_sql(json_value_sql(v, path), unit)


def iso_text_to_ts_sql(raw: str) -> str:
    """ISO-8601 text that must end in a literal ``Z`` -> TIMESTAMP; offsets such as ``+07:00`` are
    NULL. The fraction form is used when the text contains ``.<digit>``; quotes are removed before
    parsing (the prefix test runs on the text as it came). The ``Z`` is parsed as the zone, so the
    result does not depend on the session time zone."""
    clean = f"replace({raw}, '\"', '')"
    frac = f"try_to_timestamp({clean}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSX\")"
    sec = f"try_to_timestamp({clean}, \"yyyy-MM-dd'T'HH:mm:ssX\")"
    return (
        f"(CASE WHEN {raw} RLIKE '{_HAS_FRACTION_RE}' "
        f"THEN (CASE WHEN {clean} RLIKE '{_ISO_FRACTION_RE}' THEN {frac} END) "
        f"ELSE (CASE WHEN {clean} RLIKE '{_ISO_SECONDS_RE}' THEN {sec} END) END)"
    )


def epoch_or_iso_text_to_ts_sql(raw: str, unit: str = "ms") -> str:
    return (
        f"(CASE WHEN {raw} IS NULL THEN CAST(NULL AS TIMESTAMP) "
        f"WHEN {raw} RLIKE '{_EPOCH_RE}' THEN {_epoch_number_sql(raw, unit)} "
        f"WHEN {raw} RLIKE '{_ISO_PREFIX_RE}' THEN {iso_text_to_ts_sql(raw)} END)"
    )


def extract_epoch_or_iso_sql(v: str, path: str, unit: str = "ms") -> str:
    return epoch_or_iso_text_to_ts_sql(json_value_sql(v, path), unit)


def days_to_date_sql(n: str) -> str:
    return (
        f"(CASE WHEN {n} BETWEEN {MIN_EPOCH_DAY} AND {MAX_EPOCH_DAY} "
        f"THEN date_add(DATE'1970-01-01', CAST({n} AS INT)) END)"
    )


def extract_epoch_days_sql(v: str, path: str) -> str:
    return days_to_date_sql(extract_sql(v, path, "INT"))


def field_type(dtype: str) -> T.DataType | None:
    """Spark type of a spec's type word (``TS`` is an epoch-ms timestamp; None = keep the VARIANT)."""
    return T.TimestampType() if dtype.upper() == "TS" else spark_type(dtype.replace("_", " "))


def field_cast_sql(raw: str, dtype: str) -> str:
    """A scalar's text -> the spec's type."""
    t = field_type(dtype)
    return epoch_text_to_ts_sql(raw, "ms") if isinstance(t, T.TimestampType) else safe_cast_sql(raw, t)


# ------------------------------------------------------------------------------- Column forms
def json_query(v: str, path: str) -> Column:
    return F.expr(json_query_sql(v, path))


def json_value(v: str, path: str) -> Column:
    return F.expr(json_value_sql(v, path))


def extract(v: str, path: str, dtype: str = "STRING") -> Column:
    return F.expr(extract_sql(v, path, dtype))


def extract_epoch(v: str, path: str, unit: str = "ms") -> Column:
    return F.expr(extract_epoch_sql(v, path, unit))


def extract_epoch_or_iso(v: str, path: str, unit: str = "ms") -> Column:
    return F.expr(extract_epoch_or_iso_sql(v, path, unit))


def extract_epoch_days(v: str, path: str) -> Column:
    return F.expr(extract_epoch_days_sql(v, path))


def extract_field(v: str, path: str, dtype: str) -> Column:
    return json_query(v, path) if field_type(dtype) is None else F.expr(field_cast_sql(json_value_sql(v, path), dtype))
