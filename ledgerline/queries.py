"""Registered queries: one per operator, each reading the driver tables at ``sf_dir``.

Every query runs the library's operators over whole tables (no sampling, caps or key subsets); ``shred_*``
return the columns most used of all documents, ``shred_*_whole`` every column.
``ledgerline.oracle`` holds the equivalent DuckDB SQL. Arrays are returned as comma-joined sorted
strings and VARIANTs as their JSON text, so both engines hash the same scalars.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import jsonx as J
from .operators import checks as C
from .operators.hierarchy import walk_hierarchy
from .operators.latest import latest_per_key, slice_newer, slice_retention
from .operators.mart import affected_keys, mart_watermarks
from .operators.staging import shred, shred_or_quarantine, since_watermark
from .plans.core import core_full, core_merge
from .plans.job import CORE, MART, STG, TABLES, build_mart
from .plans.scenario import Scenario
from .plans.tables import Tables, newest_partition, save_bucketed, write_clustered
from .session import configure, scratch_path
from .sources import adapters as A
from .sources.landing import PARTITION_COL, write_landing
from .streaming.stream import staging_sink, stream_staging, stream_staging_once

UTC = dt.timezone.utc
CDC_RUN1 = dt.datetime(2024, 1, 15, 1, 0, tzinfo=UTC)
CDC_RUN2 = dt.datetime(2024, 2, 1, 0, 0, tzinfo=UTC)
RETENTION_AS_OF = dt.datetime(2024, 1, 20, 12, 0, tzinfo=UTC)
FRESHNESS_NOW = dt.datetime(2001, 8, 16, 6, 0, tzinfo=UTC)


def _csv(c: str) -> Column:
    return F.array_join(F.array_sort(F.col(c)), ",").alias(c)


# ------------------------------------------------------------------------------------ shredding
def q_shred_txn(spark: SparkSession, sf: str) -> DataFrame:
    st = Scenario(spark, sf).staged_all("transactions")
    return st.select(
        "id", "__v", "transid", "partner_transid", "store_code", "merchant_code", "merchant_name", "amount",
        "initial_amount", "total_fee", "status", "currency", "partner_payment_at", "paid_at", "created_at",
        "updated_at", "settlement_at", "is_refund", "is_reconciled", "auto_paid", "op", "ts_ms",
        "json_inserted_at", "inserted_at",
    )


def q_shred_store(spark: SparkSession, sf: str) -> DataFrame:
    st = Scenario(spark, sf).staged_all("stores")
    return st.select(
        "id", "__v", "code", "name", "merchant_code", "status", J.json_value("sale_info", "phone").alias("sale_phone"),
        "created_at", "approved_at", "rejected_at", "is_default", "is_supplier", "index", "manager_phone", "op", "ts_ms",
        "json_inserted_at", "inserted_at",
    )


def q_shred_user(spark: SparkSession, sf: str) -> DataFrame:
    st = Scenario(spark, sf).staged_all("users")
    return st.select(
        "id", "__v", "name", "phone", "code", "status", "direct_manager", "created_at", "updated_at", "email",
        "op", "ts_ms", "json_inserted_at", "inserted_at",
    )


def _shred_whole(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """Every document of both batches with every column of its spec and the envelope."""

    def q(spark: SparkSession, sf: str) -> DataFrame:
        st = Scenario(spark, sf).staged_all(table)
        return st.select(*[F.to_json(c).alias(c) if kind == "variant" else F.col(c) for c, kind in st.dtypes])

    return q


# ---------------------------------------------------------------------- scalar JSON + epoch rules
def _events(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return A.table(spark, sf, "events")


def _case(key: Column, branches: list[Column]) -> Column:
    out = None
    for i, b in enumerate(branches):
        out = F.when(key == i, b) if out is None else out.when(key == i, b)
    return out


def _s(c: Column) -> Column:
    return c.cast("string")


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def q_json_scalar_rules(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf)
    u = _s(F.col("user_id"))
    x = _case(
        F.col("event_id") % 12,
        [
            F.concat(F.lit('{"a":'), u, F.lit("}")),
            F.concat(F.lit("["), u, F.lit(",2]")),
            F.lit("null"),
            F.lit('"{x}"'),
            F.lit("true"),
            F.lit('"yes"'),
            F.lit('"1.0"'),
            u,
            _q(F.concat(u, F.lit(".1234567895"))),
            F.lit('"FALSE"'),
            F.lit("{}"),
        ],
    )
    text = F.concat(
        F.lit('{"_id":{"$oid":"e'), _s(F.col("event_id")), F.lit('"},'),
        F.coalesce(F.concat(F.lit('"x":'), x, F.lit(",")), F.lit("")),
        F.lit('"p":'), F.col("props"), F.lit("}"),
    )
    d = e.select("event_id", F.try_parse_json(text).alias("doc"))
    v = "doc"
    return d.select(
        "event_id",
        J.extract(v, "_id.$oid").alias("id"),
        J.extract(v, "x").alias("x_str"),
        J.extract(v, "x", "INT").alias("x_int"),
        J.extract(v, "x", "BOOL").alias("x_bool"),
        J.extract(v, "x", "NUMERIC(15,2)").alias("x_num"),
        J.extract(v, "x", "DOUBLE PRECISION").alias("x_dbl"),
        F.to_json(J.extract(v, "x", "JSONB")).alias("x_json"),
        J.extract(v, "p.k", "INT").alias("p_k"),
    )


def _epoch_doc(e: DataFrame, n: Column, key: Column) -> DataFrame:
    ns = _s(n)
    t = _case(
        key,
        [
            ns,
            _q(ns),
            F.concat(ns, F.lit(".5")),
            _q(F.concat(ns, F.lit("."))),
            F.concat(F.lit("-"), ns),
            _q(F.concat(ns, F.lit("\\n"))),
            F.lit('"1.5e12"'),
            F.lit('"abc"'),
        ],
    )
    return e.select("event_id", F.try_parse_json(F.concat(F.lit('{"t":'), t, F.lit("}"))).alias("doc"))


def _epoch_query(unit: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        e = _events(spark, sf)
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        n = {"ms": F.floor(us / 1000), "us": us, "ns": us * 1000 + 499}[unit]
        d = _epoch_doc(e, n, F.col("event_id") % 8)
        return d.select("event_id", J.extract_epoch("doc", "t", unit).alias("t"))

    return q


def q_iso_or_epoch(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf)
    ts = F.col("ts")
    ms = _s(F.floor(F.unix_micros(ts.cast("timestamp")) / 1000))
    t = _case(
        F.col("event_id") % 8,
        [
            _q(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
            _q(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
            _q(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+07:00'")),
            ms,
            _q(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")),
            _q(F.date_format(ts, "yyyy-MM-dd HH:mm:ss'Z'")),
            _q(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
            F.lit('"garbage"'),
        ],
    )
    d = e.select("event_id", F.try_parse_json(F.concat(F.lit('{"t":'), t, F.lit("}"))).alias("doc"))
    return d.select("event_id", J.extract_epoch_or_iso("doc", "t").alias("t"))


def q_epoch_days(spark: SparkSession, sf: str) -> DataFrame:
    e = _events(spark, sf)
    days = _s(F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")))
    t = _case(
        F.col("event_id") % 5,
        [days, _q(days), F.lit('"1.0"'), F.concat(F.lit("-"), days), F.lit("99999999")],
    )
    d = e.select("event_id", F.try_parse_json(F.concat(F.lit('{"d":'), t, F.lit("}"))).alias("doc"))
    return d.select("event_id", J.extract_epoch_days("doc", "d").alias("d"))


# -------------------------------------------------------------------- CDC: staging, latest, merge
def _cdc_landing(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return A.events_landing(spark, sf)


def _cdc_runs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two staging runs over the event landing: run 1 sees what landed before the cut, run 2
    everything landed after run 1's high-water mark."""
    land = _cdc_landing(spark, sf)
    run1 = shred(land.filter(F.col("inserted_at") < F.lit(A.CDC_CUT)), A.CDC_SPEC, CDC_RUN1)
    run2 = shred(since_watermark(land, "inserted_at", run1, "json_inserted_at"), A.CDC_SPEC, CDC_RUN2)
    return run1, run2


CDC_COLS = ["id", "event_id", "event_type", "value", "k", "op", "ts_ms", "json_inserted_at", "inserted_at"]


def q_hwm_append(spark: SparkSession, sf: str) -> DataFrame:
    run1, run2 = _cdc_runs(spark, sf)
    return run1.unionByName(run2).select(*CDC_COLS)


def _staged_all(spark: SparkSession, sf: str) -> DataFrame:
    run1, run2 = _cdc_runs(spark, sf)
    return run1.unionByName(run2)


CORE_COLS = ["id", "event_id", "event_type", "value", "k", "ts_ms", "inserted_at"]


def q_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return core_full(_staged_all(spark, sf), A.CDC_SPEC, CDC_RUN2).select(
        "id", "event_id", "event_type", "value", "k", "ts_ms"
    )


def q_latest_multi_sort(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(_staged_all(spark, sf), "id", ["k", "ts_ms"], ["event_id"]).select("id", "event_id", "k", "ts_ms")


def q_slice_newer(spark: SparkSession, sf: str) -> DataFrame:
    run1, run2 = _cdc_runs(spark, sf)
    target = core_full(run1, A.CDC_SPEC, CDC_RUN1)
    return slice_newer(run1.unionByName(run2), "ts_ms", target).select("id", "event_id", "ts_ms")


def q_slice_retention(spark: SparkSession, sf: str) -> DataFrame:
    return slice_retention(_staged_all(spark, sf), "ts_ms", 7, RETENTION_AS_OF).select("id", "event_id", "ts_ms")


def q_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    run1, run2 = _cdc_runs(spark, sf)
    core1 = core_full(run1, A.CDC_SPEC, CDC_RUN1)
    core2 = core_merge(core1, run2, A.CDC_SPEC, CDC_RUN2)
    return core2.select(*CORE_COLS)


# ------------------------------------------------------------------------------- hierarchy, marts
def q_hierarchy_walk(spark: SparkSession, sf: str) -> DataFrame:
    return walk_hierarchy(Scenario(spark, sf).core1("users"))


def q_hierarchy_cycle(spark: SparkSession, sf: str) -> DataFrame:
    return walk_hierarchy(Scenario(spark, sf, cycle=True).core1("users"))


PHONE_COLS = ["user_phone", "user_name", "agent_phone", "agent_name", "source_inserted_at", "inserted_at"]


def q_user_manager_phones(spark: SparkSession, sf: str) -> DataFrame:
    return Scenario(spark, sf).phones1().select(*PHONE_COLS, _csv("hierarchy_phone"))


def _mart_out(df: DataFrame) -> DataFrame:
    return df.select(*[_csv(c) if c == "hierarchy_phone" else F.col(c) for c in df.columns])


def q_mart_full(spark: SparkSession, sf: str) -> DataFrame:
    return _mart_out(Scenario(spark, sf).mart_full())


def q_mart_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    m = Scenario(spark, sf).mart_merged()
    wm = mart_watermarks(m)
    return m.agg(F.count(F.lit(1)).alias("mart_rows")).select(*[F.lit(wm[k]).alias(f"{k}_wm") for k in wm], "mart_rows")


def q_affected_keys(spark: SparkSession, sf: str) -> DataFrame:
    sc = Scenario(spark, sf)
    m1 = sc.mart1()
    return affected_keys(m1, sc.phones2(), sc.core2("stores"), mart_watermarks(m1))


def q_mart_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _mart_out(Scenario(spark, sf).mart_increment())


def q_mart_merged(spark: SparkSession, sf: str) -> DataFrame:
    return _mart_out(Scenario(spark, sf).mart_merged())


def q_mart_job(spark: SparkSession, sf: str) -> DataFrame:
    """The end-to-end job (O-32) over stored tables: land batch 1, build; land batch 2, build
    incrementally (bucket-scoped merges of cores and mart); return the stored mart."""
    sc = Scenario(spark, sf)
    root = scratch_path(spark, "mart-job")
    paths = {t: f"{root}/landing/{t}" for t in TABLES}
    for batch, run in ((1, A.RUN1), (2, A.RUN2)):
        for t in TABLES:
            write_landing(sc.documents(t, batch), paths[t])
        build_mart(spark, paths, f"{root}/warehouse", A.AS_OF, run, buckets=16)
    return _mart_out(Tables(spark, f"{root}/warehouse").read(MART))


def q_stream_then_build(spark: SparkSession, sf: str) -> DataFrame:
    """The job fed by streams (O-09): each batch lands, three streams stage it, the job builds from their tables.
    The second transactions batch is staged once more, as Spark does after a failure, and must not count twice."""
    sc = Scenario(spark, sf)
    root = scratch_path(spark, "stream-then-build")
    paths = {t: f"{root}/landing/{t}" for t in TABLES}
    tables = Tables(spark, f"{root}/warehouse")
    for batch, run in ((1, A.RUN1), (2, A.RUN2)):
        streams = []
        for t, spec in TABLES.items():
            write_landing(sc.landing(t, batch), paths[t])
            streams.append(stream_staging(tables, STG[t], paths[t], f"{root}/checkpoints/{t}", spec, run))
        for s in streams:
            s.awaitTermination()
        if batch == 2:
            staging_sink(tables, STG["transactions"], TABLES["transactions"], run)(sc.landing("transactions", 2), 1)
        build_mart(spark, paths, tables.root, A.AS_OF, run, buckets=16, streamed=True)
    return _mart_out(tables.read(MART))


def q_merge_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The mart of batch 1 as a bucketed table, the increment of batch 2 merged into it by key (O-11, O-22)."""
    sc = Scenario(spark, sf)
    tables = Tables(spark, scratch_path(spark, "merge-buckets"))
    tables.replace("mart", sc.mart1(), "transid", buckets=16)
    tables.merge("mart", sc.mart_increment(), "transid")
    return _mart_out(tables.read("mart"))


def q_checks_on_write(spark: SparkSession, sf: str) -> DataFrame:
    """Row checks (O-24, O-27, O-31) counted while the mart is written and while the increment is merged into it."""
    sc = Scenario(spark, sf)
    tables = Tables(spark, scratch_path(spark, "checks-on-write"))

    def checks(table: str) -> C.CheckedWrite:
        return C.CheckedWrite(
            [
                *C.not_null(table, "transid", "gmv", "commission"),
                C.RowCheck(f"{table}.salesman_phone.not_null", F.col("salesman_phone").isNull(), "warn"),
                C.RowCheck(f"{table}.gmv.lt_300000", ~F.expr("gmv < 300000")),
            ]
        )

    first, then = checks("first"), checks("merged")
    tables.replace("mart", sc.mart1(), "transid", buckets=16, checks=first)
    tables.merge("mart", sc.mart_increment(), "transid", checks=then)
    return C.run_checks([], written=[(spark, first), (spark, then)])


def q_layout_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """The mart written in ranges of merchant and salesman (O-14) and read back."""
    path = scratch_path(spark, "layout-clustered")
    write_clustered(Scenario(spark, sf).mart_full(), path, ["merchant_code", "salesman_phone"], spread_by=["transid"])
    return _mart_out(spark.read.parquet(path))


def q_full_refresh_staging(spark: SparkSession, sf: str) -> DataFrame:
    """A document that lands late with old stamps is missed by the high-water marks; a full refresh of staging and
    core repairs it (O-06). Late here: a newer state of every 13th order, landed behind the mark."""
    sc = Scenario(spark, sf)
    root = scratch_path(spark, "full-refresh")
    paths = {t: f"{root}/landing/{t}" for t in TABLES}
    for batch, run in ((1, A.RUN1), (2, A.RUN2)):
        for t in TABLES:
            write_landing(sc.documents(t, batch), paths[t])
        if batch == 1:
            build_mart(spark, paths, f"{root}/warehouse", A.AS_OF, run, buckets=16)
    write_landing(A.late_txns_landing(spark, sf), paths["transactions"])
    build_mart(spark, paths, f"{root}/warehouse", A.AS_OF, A.RUN2, full_refresh=True, buckets=16)
    return Tables(spark, f"{root}/warehouse").read(CORE["transactions"]).select("id", "status")


def q_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON text, some of them broken: what is staged and what goes to quarantine (O-03), all in all."""
    landed = A.events_text_landing(_events(spark, sf))
    good, bad = shred_or_quarantine(landed, "id=_id.$oid:S event_id:INT k=p.k:INT", CDC_RUN1, key_path="_id.$oid")
    good = good.select("event_id", F.lit("staged").alias("outcome"), "k")
    return good.unionByName(bad.select(F.col("topic").cast("long").alias("event_id"), F.col("reason").alias("outcome"), F.lit(None).cast("long").alias("k")))


def q_unique_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Uniqueness (O-25) of a table bucketed by the key: the counts need no shuffle."""
    path = scratch_path(spark, "bucketed")
    table = save_bucketed(_staged_all(spark, sf).select("id", "event_id"), path, "id", buckets=16)
    return C.check_unique(table, "id")


def q_report(spark: SparkSession, sf: str) -> DataFrame:
    return _mart_out(Scenario(spark, sf).report())


# ------------------------------------------------------------------------------------- checks
def _checks(spark: SparkSession, sf: str) -> dict[str, Callable[[], C.Check]]:
    sc = Scenario(spark, sf)

    def stores_landed() -> DataFrame:
        path = scratch_path(spark, "stores-landed")
        for batch in (1, 2):
            write_landing(sc.landing("stores", batch), path)
        return newest_partition(spark.read.parquet(path), PARTITION_COL)

    return {
        "chk_not_null": lambda: C.Check("phone_mart.user_phone.not_null", C.check_not_null(sc.phones1(), "user_phone")),
        "chk_unique": lambda: C.Check("stg_events.id.unique", C.check_unique(_staged_all(spark, sf), "id"), "warn"),
        "chk_accepted": lambda: C.Check(
            "stg_transactions.status.accepted",
            C.check_accepted(sc.staged_all("transactions", ("status",)), "status", ["paid_processing", "success", "paid"]),
        ),
        "chk_expr": lambda: C.Check("mart.gmv.lt_300000", C.check_expr(sc.mart_full(), "gmv < 300000")),
        "chk_single_owner": lambda: C.Check("stg_stores.one_merchant_per_store", C.check_single_owner(sc.staged_all("stores", ("id", "code", "merchant_code")))),
        "chk_parent": lambda: C.Check(
            "dim_transactions.merchant_matches_store",
            C.check_matches_parent(sc.core_all("transactions"), sc.core_all("stores")),
        ),
        "chk_freshness": lambda: C.Check(
            "landing_stores.freshness",
            C.check_freshness(stores_landed(), "inserted_at", FRESHNESS_NOW).filter("status <> 'pass'"),
        ),
    }


def _check_query(name: str, cols: list[str] | None = None):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        df = _checks(spark, sf)[name]().violations
        return df.select(*cols) if cols else df

    return q


def q_check_report(spark: SparkSession, sf: str) -> DataFrame:
    return C.run_checks([make() for make in _checks(spark, sf).values()])


def q_stream_staging(spark: SparkSession, sf: str) -> DataFrame:
    return stream_staging_once(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "shred_txn": q_shred_txn,
    "shred_store": q_shred_store,
    "shred_user": q_shred_user,
    "shred_txn_whole": _shred_whole("transactions"),
    "shred_store_whole": _shred_whole("stores"),
    "shred_user_whole": _shred_whole("users"),
    "json_scalar_rules": q_json_scalar_rules,
    "epoch_ms": _epoch_query("ms"),
    "epoch_us": _epoch_query("us"),
    "epoch_ns": _epoch_query("ns"),
    "iso_or_epoch": q_iso_or_epoch,
    "epoch_days": q_epoch_days,
    "hwm_append": q_hwm_append,
    "latest_per_key": q_latest_per_key,
    "latest_multi_sort": q_latest_multi_sort,
    "slice_newer": q_slice_newer,
    "slice_retention": q_slice_retention,
    "upsert_latest": q_upsert_latest,
    "hierarchy_walk": q_hierarchy_walk,
    "hierarchy_cycle": q_hierarchy_cycle,
    "user_manager_phones": q_user_manager_phones,
    "mart_full": q_mart_full,
    "mart_watermarks": q_mart_watermarks,
    "affected_keys": q_affected_keys,
    "mart_incremental": q_mart_incremental,
    "mart_merged": q_mart_merged,
    "mart_job": q_mart_job,
    "stream_then_build": q_stream_then_build,
    "merge_buckets": q_merge_buckets,
    "checks_on_write": q_checks_on_write,
    "layout_clustered": q_layout_clustered,
    "full_refresh_staging": q_full_refresh_staging,
    "quarantine": q_quarantine,
    "unique_bucketed": q_unique_bucketed,
    "report": q_report,
    "chk_not_null": _check_query("chk_not_null", ["user_phone", "user_name", "agent_phone"]),
    "chk_unique": _check_query("chk_unique"),
    "chk_accepted": _check_query("chk_accepted"),
    "chk_expr": _check_query("chk_expr", ["transid", "gmv"]),
    "chk_single_owner": _check_query("chk_single_owner"),
    "chk_parent": _check_query("chk_parent"),
    "chk_freshness": _check_query("chk_freshness"),
    "check_report": q_check_report,
    "stream_staging": q_stream_staging,
}
