"""Adapters from the driver's benchmark tables to landed change documents.

The benchmark tables (``customer``, ``supplier``, ``orders``, ``lineitem``, ``events``) are mapped
onto the three document shapes the engine consumes (users, stores, payment transactions) plus a
generic CDC stream, so every query's work grows with the scale factor. Two landing batches give
the incremental scenario:

* batch 1 lands at ``T1``: all users and stores, and every order whose key is not ``≡ 9 (mod 10)``;
* batch 2 lands at ``T2``: users ``≡ 4 (mod 11)`` renamed and re-parented, stores ``≡ 3 (mod 7)``
  re-assigned to another salesman and merchant, orders ``≡ 9 (mod 10)`` arriving late and orders
  ``≡ 2 (mod 5)`` turning ``success``.

The DuckDB oracle (``ledgerline.oracle``) spells the same expressions in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .landing import to_landing

UTC = dt.timezone.utc

# Scenario clock (all UTC).
T1_TS = dt.datetime(2001, 8, 14, 2, 0, tzinfo=UTC)
T1_LANDED = dt.datetime(2001, 8, 14, 2, 5, tzinfo=UTC)
T2_TS = dt.datetime(2001, 8, 15, 2, 0, tzinfo=UTC)
T2_LANDED = dt.datetime(2001, 8, 15, 2, 5, tzinfo=UTC)
RUN1 = dt.datetime(2001, 8, 14, 6, 0, tzinfo=UTC)
RUN2 = dt.datetime(2001, 8, 15, 6, 0, tzinfo=UTC)
AS_OF = dt.date(2001, 8, 15)
STORE_EPOCH_MS = 946_684_800_000  # 2000-01-01T00:00:00Z
DAY_MS = 86_400_000

# Event type -> CDC op of the generic stream.
EVENT_OPS = {"signup": "c", "purchase": "u", "click": "u", "view": "r", "error": "d"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _oid(c: Column) -> Column:
    return F.when(c.isNotNull(), F.struct(c.alias("$oid")))


def _pad(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


# ------------------------------------------------------------------------------------- users
def user_rows(spark: SparkSession, sf_dir: str, cycle: bool = False) -> DataFrame:
    """Typed users: NULL and shared phones, inactive users, a forest of managers (``k div 3``).

    ``cycle=True`` points user 0 at user 1, whose manager is 0.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    k = F.col("c_custkey")
    phone = F.when(k % 13 == 5, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("09"), _pad(k - F.when(k % 10 == 9, 1).otherwise(0), 8))
    )
    manager = F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise((F.floor(k / 3)).cast("string"))
    if cycle:
        manager = F.when(k == 0, F.lit("1")).otherwise(manager)
    return c.select(
        k.alias("k"),
        k.cast("string").alias("id"),
        F.col("c_name").alias("name"),
        phone.alias("phone"),
        F.when(F.col("c_acctbal") < 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
        manager.alias("direct_manager"),
    )


def _user_doc(u: DataFrame) -> Column:
    return F.struct(
        _oid(F.col("id")).alias("_id"),
        F.lit(0).alias("__v"),
        F.col("name"),
        F.col("phone"),
        F.concat(F.lit("NV"), F.col("id")).alias("code"),
        F.col("status"),
        _oid(F.col("direct_manager")).alias("direct_manager"),
        F.struct((F.lit(STORE_EPOCH_MS) + F.col("k") * 1000).alias("$date")).alias("created_at"),
    )


def users_landing(spark: SparkSession, sf_dir: str, batch: int = 1, cycle: bool = False) -> DataFrame:
    u = user_rows(spark, sf_dir, cycle)
    if batch == 1:
        return to_landing(u, _user_doc(u), "c", T1_TS, T1_LANDED, "sales.users")
    k = F.col("k")
    changed = u.filter(k % 11 == 4).select(
        "k",
        "id",
        F.concat(F.col("name"), F.lit(" v2")).alias("name"),
        "phone",
        "status",
        F.when(k % 97 == 0, F.lit(None).cast("string")).otherwise(F.floor(k / 5).cast("string")).alias(
            "direct_manager"
        ),
    )
    return to_landing(changed, _user_doc(changed), "u", T2_TS, T2_LANDED, "sales.users")


# ------------------------------------------------------------------------------------ stores
def store_code(suppkey: Column) -> Column:
    return F.concat(F.lit("STORE"), _pad(suppkey, 6))


def salesman_phone(n: Column) -> Column:
    return F.concat(F.lit("09"), _pad(n, 8))


def _store_doc(s: DataFrame) -> Column:
    created = F.lit(STORE_EPOCH_MS) + F.col("s_suppkey") * DAY_MS
    return F.struct(
        _oid(F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))).alias("_id"),
        F.lit("0").alias("__v"),
        store_code(F.col("s_suppkey")).alias("code"),
        F.col("s_name").alias("name"),
        F.col("merchant_code"),
        F.lit("active").alias("status"),
        F.struct(F.col("sale_phone").alias("phone"), F.col("s_name").alias("name")).alias("sale_info"),
        created.alias("created_at"),
        (created + 7 * DAY_MS).alias("approved_at"),
        F.lit(True).alias("is_default"),
        F.lit(1).alias("index"),
    )


def stores_landing(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    if batch == 1:
        s = s.select(
            "s_suppkey",
            "s_name",
            F.concat(F.lit("MERCH"), F.col("s_nationkey").cast("string")).alias("merchant_code"),
            salesman_phone(k).alias("sale_phone"),
        )
        return to_landing(s, _store_doc(s), "c", T1_TS, T1_LANDED, "payments.stores")
    s = s.filter(k % 7 == 3).select(
        "s_suppkey",
        "s_name",
        F.concat(F.lit("MERCH"), (F.col("s_nationkey") + 100).cast("string")).alias("merchant_code"),
        salesman_phone(k + 1).alias("sale_phone"),
    )
    return to_landing(s, _store_doc(s), "u", T2_TS, T2_LANDED, "payments.stores")


# ------------------------------------------------------------------------------ transactions
def txn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payment transactions; the store is the smallest supplier among the lines."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    first_supp = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("suppkey"))
    )
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("suppkey"), "s_nationkey", "s_name")
    k = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "success")
        .when(F.col("o_orderstatus") == "O", "paid")
        .when(F.col("o_orderstatus") == "P", F.when(k % 2 == 0, "failed").otherwise("paid_processing"))
    )
    return (
        o.join(first_supp, o.o_orderkey == first_supp.l_orderkey, "left")
        .join(sup, "suppkey", "left")
        .select(
            k.alias("k"),
            F.concat(F.lit("TXN"), k.cast("string")).alias("transid"),
            F.when(F.col("suppkey").isNotNull(), store_code(F.col("suppkey"))).alias("store_code"),
            F.when(k % 101 == 0, F.lit("MERCH_X"))
            .otherwise(F.concat(F.lit("MERCH"), F.col("s_nationkey").cast("string")))
            .alias("merchant_code"),
            F.col("s_name").alias("merchant_name"),
            F.col("o_totalprice").alias("amount"),
            (F.col("o_totalprice") * F.lit(0.02)).alias("total_fee"),
            status.alias("status"),
            _epoch_ms(F.col("o_orderdate")).alias("paid_ms"),
        )
    )


def _txn_doc() -> Column:
    return F.struct(
        _oid(F.concat(F.lit("t"), F.col("k").cast("string"))).alias("_id"),
        F.lit(0).alias("__v"),
        F.col("transid"),
        F.concat(F.col("transid"), F.lit("_P")).alias("partner_transid"),
        F.col("store_code"),
        F.col("merchant_code"),
        F.col("merchant_name"),
        F.col("amount"),
        F.col("amount").alias("initial_amount"),
        F.col("total_fee"),
        F.col("status"),
        F.lit("VND").alias("currency"),
        F.col("paid_ms").alias("partner_payment_at"),
        F.col("paid_ms").alias("paid_at"),
        (F.col("paid_ms") - 300_000).alias("created_at"),
        F.col("paid_ms").alias("updated_at"),
        F.lit(False).alias("is_refund"),
        F.lit(True).alias("is_reconciled"),
        F.lit(False).alias("auto_paid"),
    )


def txns_landing(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    t = txn_rows(spark, sf_dir)
    k = F.col("k")
    if batch == 1:
        t = t.filter(k % 10 != 9)
        return to_landing(t, _txn_doc(), "c", T1_TS, T1_LANDED, "payments.transactions")
    # late or settled, never both: one pass over the lines for the two
    t2 = t.filter((k % 10 == 9) | (k % 5 == 2)).withColumn("status", F.when(k % 5 == 2, "success").otherwise(F.col("status")))
    op = F.when(k % 10 == 9, "c").otherwise("u")
    return to_landing(t2, _txn_doc(), op, T2_TS, T2_LANDED, "payments.transactions")


def late_txns_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A newer state of every 13th order that lands behind the high-water mark of batch 2."""
    t = txn_rows(spark, sf_dir).filter(F.col("k") % 13 == 6).withColumn("status", F.lit("late"))
    return to_landing(t, _txn_doc(), "u", T2_TS + dt.timedelta(hours=1), T1_LANDED, "payments.transactions")


# ------------------------------------------------------------------------------ generic CDC
CDC_SPEC = "id=_id.$oid:S event_id:INT event_type:S value:DOUBLE_PRECISION props:JSONB k=props.k:INT"
CDC_CUT = dt.datetime(2024, 1, 15, tzinfo=UTC)


def events_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change document keyed by ``user_id``; landed at its own event time."""
    e = table(spark, sf_dir, "events")
    op = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(o)) for t, o in EVENT_OPS.items()])
    doc = F.struct(
        _oid(F.col("user_id").cast("string")).alias("_id"),
        F.col("event_id"),
        F.col("event_type"),
        F.col("value"),
        F.try_parse_json(F.col("props")).alias("props"),
    )
    ts = F.col("ts").cast("timestamp")
    return to_landing(e, doc, op, ts, ts, "events")


def events_text_landing(e: DataFrame) -> DataFrame:
    """Every event as JSON text under its envelope, five of nine kinds broken: cut short, a repeated key, no document,
    no object, no key. ``topic`` holds the event's number, to find it again in quarantine."""
    n = F.col("event_id").cast("string")
    whole = F.concat(F.lit('{"_id":{"$oid":"e'), n, F.lit('"},"event_id":'), n, F.lit(',"p":'), F.col("props"), F.lit("}"))
    kind = F.col("event_id") % 9
    text = (
        F.when(kind == 1, F.expr("substring(props, 1, length(props) - 1)"))
        .when(kind == 2, F.concat(F.lit('{"a":1,"a":'), n, F.lit("}")))
        .when(kind == 3, F.lit(None).cast("string"))
        .when(kind == 4, F.concat(F.lit("["), n, F.lit("]")))
        .when(kind == 5, F.concat(F.lit('{"_id":{},"event_id":'), n, F.lit("}")))
        .otherwise(whole)
    )
    ts = F.col("ts").cast("timestamp")
    return e.select(text.alias("data"), F.lit("c").alias("op"), n.alias("topic"), F.lit("events").alias("database_type"), ts.alias("ts_ms"), ts.alias("inserted_at"))
