"""Tables as Parquet folders (loads, bucket-scoped merges, range-clustered files) and the end-to-end job."""

import datetime as dt
import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerline.operators.upsert import DuplicateSourceKeys
from ledgerline.plans.job import CORE, MART, PHONES, STG, TABLES, build_mart
from ledgerline.plans.tables import Tables, newest_partition, save_bucketed, write_clustered
from ledgerline.sources.landing import write_landing

from . import seed

UTC = dt.timezone.utc


def _files(path):
    """Every data file below ``path`` with what tells whether it was written again."""
    return {f: (os.stat(f).st_ino, os.stat(f).st_mtime_ns) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_merge_writes_only_touched_buckets(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.replace("t", spark.range(1000).select(F.col("id").alias("k"), F.lit("v1").alias("val")), "k", buckets=16)
    before = _files(f"{tmp_path}/t")
    assert len({os.path.dirname(f) for f in before}) == len(before) == 16  # one file a bucket
    src = spark.createDataFrame([(5, "v2"), (2000, "new")], "k long, val string")
    touched = tables.merge("t", src, "k")
    assert 1 <= len(touched) <= 2
    after = _files(f"{tmp_path}/t")
    kept = {f: s for f, s in before.items() if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
    assert len(kept) == 16 - len(touched) and kept.items() <= after.items()
    want = {**dict.fromkeys(range(1000), "v1"), 5: "v2", 2000: "new"}
    assert {r["k"]: r["val"] for r in tables.read("t").collect()} == want
    # a merge that is run again, say after a crash while it committed, changes nothing; the bucket count is remembered
    assert tables.merge("t", src, "k") == touched
    assert sorted(map(tuple, Tables(spark, str(tmp_path)).read("t").collect())) == sorted(want.items())
    assert tables.merge("t", src.limit(0), "k") == []


def test_merge_runs_its_source_once(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.replace("t", spark.range(100).withColumnRenamed("id", "k"), "k", buckets=8)
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    tables.merge("t", spark.range(50, 150).withColumnRenamed("id", "k").mapInArrow(count, "k long"), "k")
    assert runs.value == 100 and tables.read("t").count() == 150


def test_merge_keys(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.replace("t", spark.range(10).selectExpr("id as k", "cast(null as string) as v"), "k", buckets=4)
    with pytest.raises(DuplicateSourceKeys):
        tables.merge("t", spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string"), "k")
    with pytest.raises(ValueError):
        tables.replace("plain", spark.range(3))
        tables.merge("plain", spark.range(3), "id")
    # NULL keys match nothing: they are inserted
    tables.merge("t", spark.createDataFrame([(None, "x"), (3, "y")], "k long, v string"), "k")
    tables.merge("t", spark.createDataFrame([(None, "x")], "k long, v string"), "k")
    rows = tables.read("t").collect()
    assert len(rows) == 12 and [r.v for r in rows if r.k == 3] == ["y"] and sum(r.k is None for r in rows) == 2


def test_loads_replace_themselves(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert not tables.exists("h") and tables.max_of_newest_load("h", "id", -1) == -1
    tables.append("h", spark.range(3), "run-1")
    first = _files(f"{tmp_path}/h")
    tables.append("h", spark.range(3, 5), "run-2")
    tables.append("h", spark.range(3, 6), "run-2")  # the same load again
    tables.append("h", spark.range(0), "run-3")  # no rows, no folder
    assert sorted(r.id for r in tables.read("h").collect()) == [0, 1, 2, 3, 4, 5]
    assert first.items() <= _files(f"{tmp_path}/h").items() and len(os.listdir(f"{tmp_path}/h")) <= 4
    assert tables.max_of_newest_load("h", "id") == 5
    tables.replace("h", spark.range(2), load_id="run-4")
    assert sorted(r.id for r in tables.read("h").collect()) == [0, 1]


def test_newest_partition_reads_no_column(spark, tmp_path, capfd):
    df = spark.range(100).selectExpr("id", "pmod(id, 5) as day")
    df.write.partitionBy("day").parquet(str(tmp_path / "p"))
    table = spark.read.parquet(str(tmp_path / "p"))
    assert sorted(r.id for r in newest_partition(table, "day").collect()) == list(range(4, 100, 5))
    plan = table.agg(F.max("day"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    plan = newest_partition(table, "day").agg(F.max("id"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert newest_partition(table.where("day > 9"), "day").count() == 0


def _ranges(path, column):
    out = []
    for f in sorted(_files(path)):
        m = pq.ParquetFile(f).metadata
        i = m.schema.names.index(column)
        stats = [m.row_group(g).column(i).statistics for g in range(m.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return sorted(out)


def test_clustered_files_hold_ranges_that_hardly_overlap(spark, tmp_path):
    df = spark.range(40_000).selectExpr("id", "if(id % 3 = 0, 7, pmod(xxhash64(id), 1000)) as c").repartition(8, "id")
    write_clustered(df, str(tmp_path / "c"), ["c"], files=6, spread_by=["id"])
    back = spark.read.parquet(str(tmp_path / "c"))
    assert back.exceptAll(df).isEmpty() and back.count() == 40_000
    ranges = _ranges(str(tmp_path / "c"), "c")
    assert len(ranges) == 6 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    # the value that a third of all rows have is cut over several files by the key
    assert sum(lo <= 7 <= hi for lo, hi in ranges) >= 2
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in _files(str(tmp_path / "c"))]
    assert max(sizes) < 2 * 40_000 / 6
    for f in _files(str(tmp_path / "c")):
        c = pq.ParquetFile(f).read(columns=["c"])["c"].to_pylist()
        assert c == sorted(c)


def test_clustered_with_value_partitions(spark, tmp_path):
    df = spark.range(300).selectExpr("concat('p', id % 3) as p", "id as k")
    write_clustered(df, str(tmp_path / "c"), ["k"], partition_by=["p"], files=3)
    assert sorted(d for d in os.listdir(tmp_path / "c") if d[0] == "p") == ["p=p0", "p=p1", "p=p2"]
    assert spark.read.parquet(str(tmp_path / "c")).select("p", "k").exceptAll(df).isEmpty()


def test_clustering_survives_the_bucketed_write(spark, tmp_path):
    df = spark.range(4000).selectExpr("id", "pmod(xxhash64(id), 1000) as c")
    Tables(spark, str(tmp_path)).replace("t", df, "id", buckets=4, cluster_by=("c",))
    files = _files(f"{tmp_path}/t")
    assert len(files) == 4
    for f in files:
        c = pq.ParquetFile(f).read(columns=["c"])["c"].to_pylist()
        assert c == sorted(c)


def test_bucketed_table_is_counted_without_an_exchange(spark, tmp_path):
    from ledgerline.operators.checks import check_unique

    table = save_bucketed(spark.range(1000).selectExpr("pmod(id, 900) as k", "id"), str(tmp_path / "bucketed_unique"), "k", 8)
    check = check_unique(table, "k")
    assert sorted(map(tuple, check.collect())) == [(k, 2) for k in range(100)]
    assert "Exchange" not in check._jdf.queryExecution().executedPlan().toString()
    assert len(_files(str(tmp_path / "bucketed_unique"))) == 8


def _counts(write, spark):
    return {r["check"]: r["violations"] for r in write.counts(spark).collect()}


def test_checks_are_counted_by_the_write(spark, tmp_path):
    """Equal to a scan of the whole table after a replace, a merge of some buckets and one of none; the write's own
    job counts, so a replaced table is not read again."""
    from ledgerline.operators.checks import CheckedWrite, RowCheck, run_checks

    def checks():
        return CheckedWrite([RowCheck("v.not_null", F.col("v").isNull(), "warn"), RowCheck("v.small", ~F.expr("v < 90"))])

    tables = Tables(spark, str(tmp_path))
    rows = spark.range(100).selectExpr("id as k", "if(id % 10 = 0, null, id) as v")
    first = checks()
    tables.replace("t", rows, "k", buckets=16, checks=first)
    assert first.rest is None and "parquet" not in first.counts(spark)._jdf.queryExecution().executedPlan().toString()
    assert _counts(first, spark) == {"v.not_null": 10, "v.small": 9}
    some = checks()
    touched = tables.merge("t", spark.createDataFrame([(0, 5), (500, None), (501, 700)], "k long, v long"), "k", checks=some)
    assert 0 < len(touched) < 16 and some.rest is not None
    assert _counts(some, spark) == {"v.not_null": 10, "v.small": 10}
    none = checks()
    tables.merge("t", rows.limit(0), "k", checks=none)
    assert _counts(none, spark) == {"v.not_null": 10, "v.small": 10}
    report = run_checks([], written=[(spark, some)]).collect()
    assert {(r["check"], r["status"]) for r in report} == {("v.not_null", "warn"), ("v.small", "fail")}
    # an empty table, a clustered one, a load
    for kw in ({"key": "k", "buckets": 4}, {"cluster_by": ("k",)}, {"load_id": "run-1"}, {}):
        for df, expected in ((rows, {"v.not_null": 10, "v.small": 9}), (rows.limit(0), {"v.not_null": 0, "v.small": 0})):
            w = checks()
            tables.replace(f"u{len(kw)}{'-'.join(kw)}", df, checks=w, **kw)
            assert _counts(w, spark) == expected
    with pytest.raises(ValueError):
        w.watch(rows)


def _land(spark, root, docs_by_table, ts, landed, op="c"):
    for t, docs in docs_by_table.items():
        write_landing(seed.landing(spark, docs, ts, landed, op), f"{root}/{t}")


def test_job_incremental_run(spark, tmp_path):
    root = str(tmp_path)
    paths = {t: f"{root}/landing/{t}" for t in ("users", "stores", "transactions")}
    wh = f"{root}/wh"
    _land(spark, f"{root}/landing", {"users": seed.user_docs(), "stores": seed.store_docs(),
                                      "transactions": seed.txn_docs()}, seed.TS, seed.LANDED)
    run1 = dt.datetime(2026, 7, 16, 1, 0, tzinfo=UTC)
    res1 = build_mart(spark, paths, wh, dt.date(2026, 7, 20), run1, buckets=8)
    assert {r["transid"] for r in res1.report.collect()} == {"TXN0001", "TXN0002", "TXN0003"}
    report1 = {r["check"]: r["status"] for r in res1.checks.collect()}
    assert report1["mart.transid.unique"] == "pass"
    for table, cols in (
        ("stg_transactions", ("id", "ts_ms", "json_inserted_at", "inserted_at", "op")),
        ("mart", ("transid", "gmv", "commission", "source_inserted_at", "inserted_at")),
        ("report", ("transid", "transaction_day", "gmv")),
    ):
        assert all(f"{table}.{c}.not_null" in report1 for c in cols)
    assert report1["report.transid.unique"] == report1["mart.commission.eq_0"] == "pass"
    assert report1["landing_stores.freshness.error"] == "pass"  # landed 23 h before run 1
    assert report1["landing_stores.freshness.warn"] == "warn"

    # day 2: TXN0004 becomes paid, TXN0002 moves to STORE002 (salesman Tran Thi B)
    docs = [json.loads(d) for d in seed.txn_docs()]
    upd = []
    for d in docs:
        if d["transid"] == "TXN0004":
            d["status"] = "paid"
            upd.append(json.dumps(d))
        if d["transid"] == "TXN0002":
            d["store_code"], d["merchant_code"] = "STORE002", "MERCH002"
            upd.append(json.dumps(d))
    ts2, landed2 = dt.datetime(2026, 7, 16, 2, 0, tzinfo=UTC), dt.datetime(2026, 7, 16, 2, 5, tzinfo=UTC)
    write_landing(seed.landing(spark, upd, ts2, landed2, "u"), paths["transactions"])
    run2 = dt.datetime(2026, 7, 17, 1, 0, tzinfo=UTC)
    res2 = build_mart(spark, paths, wh, dt.date(2026, 7, 20), run2, buckets=8)
    rows = {r["transid"]: r for r in res2.report.collect()}
    assert set(rows) == {"TXN0001", "TXN0002", "TXN0003", "TXN0004"}
    assert rows["TXN0002"]["salesman_name"] == "Tran Thi B" and rows["TXN0002"]["merchant_code"] == "STORE002"

    # the incremental result equals a full refresh over the same inputs
    full = build_mart(spark, paths, f"{root}/wh_full", dt.date(2026, 7, 20), run2, full_refresh=True, buckets=8)
    cols = [c for c in full.report.columns if c != "hierarchy_phone"]
    a = sorted(tuple(r) for r in res2.report.select(*cols).collect())
    b = sorted(tuple(r) for r in full.report.select(*cols).collect())
    assert a == b

    # rerunning with no new documents changes no mart row except load stamps
    res3 = build_mart(spark, paths, wh, dt.date(2026, 7, 20), dt.datetime(2026, 7, 18, tzinfo=UTC), buckets=8)
    c = sorted(tuple(r) for r in res3.report.select(*cols).collect())
    assert c == a
    tables = Tables(spark, wh)
    assert tables.read(PHONES).count() == 3 and tables.read(MART).count() == 4

    # a run that is repeated, as after a crash half way, stages its load once
    again = build_mart(spark, paths, wh, dt.date(2026, 7, 20), run2, buckets=8)
    assert sorted(tuple(r) for r in again.report.select(*cols).collect()) == a
    assert tables.read(STG["transactions"]).count() == 7 and tables.read(CORE["transactions"]).count() == 5


def test_stable_stamps_in_the_job(spark, tmp_path):
    root = str(tmp_path)
    paths = {t: f"{root}/landing/{t}" for t in TABLES}
    docs = {"users": seed.user_docs(), "stores": seed.store_docs(), "transactions": seed.txn_docs()}
    _land(spark, f"{root}/landing", docs, seed.TS, seed.LANDED)
    runs = [dt.datetime(2026, 7, d, 1, 0, tzinfo=UTC) for d in (16, 17)]
    for run in runs:
        build_mart(spark, paths, f"{root}/wh", dt.date(2026, 7, 20), run, buckets=4, stable_stamps=True)
    stamps = {r.t for r in Tables(spark, f"{root}/wh").read(PHONES).select(F.unix_micros("inserted_at").alias("t")).collect()}
    assert stamps == {int(runs[0].timestamp()) * 1_000_000}


def test_streamed_job_counts_a_replayed_batch_once(spark, tmp_path):
    from ledgerline.streaming.stream import staging_sink, stream_staging

    root = str(tmp_path)
    paths = {t: f"{root}/landing/{t}" for t in TABLES}
    docs = {"users": seed.user_docs(), "stores": seed.store_docs(), "transactions": seed.txn_docs()}
    _land(spark, f"{root}/landing", docs, seed.TS, seed.LANDED)
    run = dt.datetime(2026, 7, 16, 1, 0, tzinfo=UTC)
    tables = Tables(spark, f"{root}/wh")
    for t, spec in TABLES.items():
        stream_staging(tables, STG[t], paths[t], f"{root}/ckpt/{t}", spec, run).awaitTermination()
        staging_sink(tables, STG[t], spec, run)(spark.read.parquet(paths[t]), 0)  # Spark repeats batch 0
        assert tables.read(STG[t]).count() == len(docs[t])
    streamed = build_mart(spark, paths, tables.root, dt.date(2026, 7, 20), run, buckets=4, streamed=True)
    batch = build_mart(spark, paths, f"{root}/wh2", dt.date(2026, 7, 20), run, buckets=4)
    assert sorted(map(str, streamed.report.collect())) == sorted(map(str, batch.report.collect()))
    assert streamed.report.count() == 3


def test_quarantine_takes_what_cannot_be_staged(spark):
    from ledgerline.operators.staging import shred_or_quarantine

    texts = ['{"_id":{"$oid":"a"},"n":1}', '{"_id":{"$oid":"b"}', '{"a":1,"a":2}', None, "[1]", "7", "null", "", '{"_id":{}}', '{"_id":{"$oid":null}}', '{"_id":{"$oid":"a"},"n":"x"}']
    rows = [(t, "c", f"{i}", "db", seed.TS, seed.LANDED) for i, t in enumerate(texts)]
    landed = spark.createDataFrame(rows, "data string, op string, topic string, database_type string, ts_ms timestamp, inserted_at timestamp")
    good, bad = shred_or_quarantine(landed, "id=_id.$oid:S n:INT", seed.LANDED, key_path="_id.$oid")
    assert sorted((r.id, r.n or 0) for r in good.collect()) == [("a", 0), ("a", 1)]
    got = {int(r.topic): (r.data, r.reason) for r in bad.collect()}
    assert got == {
        1: (texts[1], "not parsable"), 2: (texts[2], "not parsable"), 3: (None, "no document"), 4: ("[1]", "not an object"), 5: ("7", "not an object"),
        6: ("null", "not an object"), 7: ("", "not parsable"), 8: (texts[8], "no key"), 9: (texts[9], "no key"),
    }
    good, bad = shred_or_quarantine(landed, "id=_id.$oid:S n:INT", seed.LANDED)
    assert good.count() == 4 and bad.count() == 7
    none = landed.limit(0)
    assert [d.count() for d in shred_or_quarantine(none, "id=_id.$oid:S", seed.LANDED)] == [0, 0]


def test_shred_drop_columns(spark):
    from ledgerline.operators.staging import shred
    from ledgerline.sources.specs import USERS

    st = shred(seed.landing(spark, seed.user_docs()), USERS, dt.datetime(2026, 7, 20, tzinfo=UTC), drop_columns=("password",))
    assert "password" not in st.columns and len(st.columns) == 89 + 4


def test_watermark_is_exact_where_clocks_are_set_back(spark):
    import os
    import time

    from ledgerline.operators.staging import max_value, since_watermark

    df = spark.sql("select timestamp_micros(1793514600000001) as t")  # 2026-11-01T06:30:00.000001Z
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        assert int((max_value(df, "t").timestamp())) == 1793514600
        assert since_watermark(df, "t", df, "t").count() == 0
    finally:
        os.environ.pop("TZ") if old is None else os.environ.update(TZ=old)
        time.tzset()


def test_ties_give_one_answer_in_any_layout(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators.latest import latest_per_key
    from ledgerline.plans.core import KEY, ORDER, tie_breakers

    rows = spark.range(2000).selectExpr(
        "cast(pmod(id, 20) as string) as id", "id as payload", "timestamp_seconds(5) as ts_ms",
        "timestamp_seconds(9) as json_inserted_at", "current_timestamp() as inserted_at",
    )
    seen = {
        tuple(sorted((r.id, r.payload) for r in latest_per_key(d, KEY, ORDER, tie_breakers(d)).collect()))
        for d in (rows.repartition(n, F.rand(n)) for n in (1, 3, 7))
    }
    assert len(seen) == 1
