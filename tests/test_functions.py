"""Edge tables for the column functions (JSON scalar rules, safe casts, epoch and ISO decoding)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import jsonx as J

UTC = dt.timezone.utc


def _doc(spark, text):
    return spark.createDataFrame([(text,)], "j string").select(F.try_parse_json("j").alias("d"))


def _one(spark, text, col):
    return _doc(spark, text).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "value, expected",
    [
        ('{"a":1}', None),  # object -> NULL
        ("[1,2]", None),  # array -> NULL
        ("{}", None),
        ("[]", None),
        ("null", None),  # JSON null -> NULL
        ('"{x}"', "{x}"),  # a string that looks like an object survives
        ('"[1]"', "[1]"),
        ("12", "12"),
        ("true", "true"),
        ('"abc"', "abc"),
    ],
)
def test_json_value_scalars_only(spark, value, expected):
    assert _one(spark, '{"k":' + value + "}", J.json_value("d", "k")) == expected


def test_json_value_missing_path_and_dollar_keys(spark):
    doc = '{"_id":{"$oid":"a1"},"created_at":{"$date":5}}'
    assert _one(spark, doc, J.json_value("d", "_id.$oid")) == "a1"
    assert _one(spark, doc, J.json_value("d", "created_at.$date")) == "5"
    assert _one(spark, doc, J.json_value("d", "nope.$oid")) is None


def test_json_path_quotes_keys():
    assert J.json_path("_id.$oid") == '$["_id"]["$oid"]'


@pytest.mark.parametrize(
    "value, dtype, expected",
    [
        ('"1.0"', "INT", None),  # no fractional text for INT64
        ("7", "INT", 7),
        ('"+7"', "INT", 7),
        ('" 7"', "INT", None),  # no blanks around integer text
        ('"yes"', "BOOL", None),  # Spark would accept yes/1/t; the warehouse only true/false
        ('"1"', "BOOL", None),
        ('"TRUE"', "BOOL", True),
        ("false", "BOOL", False),
        ('"1.1234567895"', "NUMERIC(15,2)", Decimal("1.123456790")),  # (38,9), half up
        ("3000.0", "DOUBLE PRECISION", 3000.0),
        ('"x"', "DOUBLE PRECISION", None),
        ('{"a":1}', "INT", None),
    ],
)
def test_safe_casts(spark, value, dtype, expected):
    assert _one(spark, '{"k":' + value + "}", J.extract("d", "k", dtype)) == expected


def test_spark_type_words():
    from pyspark.sql import types as T

    assert J.spark_type("JSONB") is None
    assert J.spark_type("NUMERIC(15,2)") == T.DecimalType(38, 9)
    assert J.spark_type("DOUBLE PRECISION") == T.DoubleType()
    assert J.spark_type("bigint") == T.LongType()
    assert J.spark_type("varchar") == T.StringType()


MS = 1752000000123
TS_MS = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=MS)


@pytest.mark.parametrize(
    "value, unit, expected",
    [
        (str(MS), "ms", TS_MS),
        (f'"{MS}"', "ms", TS_MS),
        (f'"{MS}."', "ms", TS_MS),
        (f"{MS}.5", "ms", TS_MS + dt.timedelta(milliseconds=1)),  # rounds half away from zero
        (f"{MS}.4", "ms", TS_MS),
        (f"-{MS}", "ms", None),  # negative -> NULL
        ("1.5e12", "ms", None),  # exponent form -> NULL
        ('"1.5e12"', "ms", None),
        (f'"{MS}\\n"', "ms", None),  # trailing newline must not pass the number test
        ("99999999999999999999", "ms", None),  # beyond the timestamp range -> NULL (no error)
        (str(MS * 1000), "us", TS_MS),
        # ns goes through FLOAT64 first (as the warehouse does): 1752000000123000499 is stored as
        # ...000576, so /1000 rounds up by one microsecond
        (str(MS * 1000000 + 499), "ns", TS_MS + dt.timedelta(microseconds=1)),
        (str(MS * 1000000), "ns", TS_MS),
        (str(MS), "s", None),  # unknown unit -> NULL
    ],
)
def test_epoch(spark, value, unit, expected):
    got = _one(spark, '{"t":' + value + "}", J.extract_epoch("d", "t", unit))
    assert got == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ('"2025-07-08T18:40:00Z"', dt.datetime(2025, 7, 8, 18, 40)),
        ('"2025-07-08T18:40:00.5Z"', dt.datetime(2025, 7, 8, 18, 40, 0, 500000)),
        ('"2025-07-08T18:40:00.123456Z"', dt.datetime(2025, 7, 8, 18, 40, 0, 123456)),
        ('"2025-07-08T18:40:00+07:00"', None),  # offsets are not accepted
        ('"2025-07-08T18:40:00"', None),  # no Z
        ('"2025-07-08 18:40:00Z"', None),
        ('"2025-13-08T18:40:00Z"', None),  # invalid month -> NULL
        (str(MS), TS_MS),  # epoch numbers still work
        ('{"$date":"2025-07-08T18:40:00Z"}', None),  # object -> NULL
    ],
)
def test_epoch_or_iso(spark, value, expected):
    assert _one(spark, '{"t":' + value + "}", J.extract_epoch_or_iso("d", "t")) == expected


def test_iso_ignores_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        got = _doc(spark, '{"t":"2025-07-08T18:40:00Z"}').select(
            F.unix_micros(J.extract_epoch_or_iso("d", "t")).alias("u")
        ).first()["u"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == int(dt.datetime(2025, 7, 8, 18, 40, tzinfo=UTC).timestamp() * 1_000_000)


@pytest.mark.parametrize(
    "value, expected",
    [("0", dt.date(1970, 1, 1)), ("20000", dt.date(2024, 10, 4)), ('"-1"', dt.date(1969, 12, 31)),
     ('"1.0"', None), ("99999999", None)],
)
def test_epoch_days(spark, value, expected):
    assert _one(spark, '{"d":' + value + "}", J.extract_epoch_days("d", "d")) == expected


def test_malformed_document_is_null(spark):
    assert _one(spark, '{"a":1,"a":2}', J.json_value("d", "a")) is None  # duplicate keys rejected
    assert _one(spark, "{not json", J.json_value("d", "a")) is None
