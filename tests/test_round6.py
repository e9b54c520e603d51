"""Findings on time at size: what a job writes, sorts and reads twice."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerline import queries
from ledgerline.operators.staging import shred
from ledgerline.plans.scenario import Scenario
from ledgerline.plans.tables import Tables, _dealt
from ledgerline.sources.landing import empty_landing
from ledgerline.sources.specs import TRANSACTIONS

SMOKE = "/root/testdata/sf0.001"


def test_marks_have_row_groups_to_skip(spark, tmp_path):
    """F8: INT96 stamps have no minima and maxima, so a mark read every older document and row again."""
    stamp = dt.datetime(2024, 1, 1, 1, 2, 3, 456789, tzinfo=dt.timezone.utc)
    Tables(spark, str(tmp_path)).append("t", spark.range(3).select(F.lit(stamp).alias("ts_ms")), "run-1")
    meta = pq.read_metadata(glob.glob(f"{tmp_path}/t/load_id=run-1/*.parquet")[0]).row_group(0).column(0)
    assert meta.physical_type == "INT64" and meta.statistics.has_min_max
    assert Tables(spark, str(tmp_path)).read("t").where(F.col("ts_ms") == F.lit(stamp)).count() == 3


def test_buckets_are_not_sorted_to_be_written(spark, tmp_path):
    """F8: rows of all columns were sorted by a bucket number that is the same for a whole task."""
    df = spark.range(500).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7).alias("v"))
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan(_dealt(df, ["id"], 4))
    assert "Sort" in plan(_dealt(df, ["id"], 4, ["v"]))
    tables = Tables(spark, str(tmp_path))
    tables.replace("t", df, "id", 4)
    tables.merge("t", df.where("v = 3").withColumn("v", F.lit(9).cast("long")), "id")
    want = sorted((r.id, 9 if r.v == 3 else r.v) for r in df.collect())
    assert sorted((r.id, r.v) for r in tables.read("t").collect()) == want


def test_several_partitions_in_one_task(spark, tmp_path):
    """One writer is open at a time; rows of further values are sorted and written too."""
    spark.range(100).repartition(1).select("id", (F.col("id") % 5).alias("p")).write.partitionBy("p").parquet(f"{tmp_path}/t")
    assert len(glob.glob(f"{tmp_path}/t/p=*/*.parquet")) == 5
    assert sorted((r.id, r.p) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [(i, i % 5) for i in range(100)]


def test_a_job_lands_its_documents_once(spark):
    """F7, F8: each batch was written for the scenario and copied into the job's landing."""
    Scenario.reset()
    sc = Scenario(spark, SMOKE)
    docs = sc.documents("stores", 1)
    assert ("landing", ("stores", 1)) not in sc._memo
    text = lambda d: sorted(tuple(r) for r in d.select(F.col("data").cast("string"), "op", "ts_ms", "inserted_at").collect())
    assert text(docs) == text(sc.landing("stores", 1))
    assert sc.documents("stores", 1) is sc.landing("stores", 1)


def test_containers_are_looked_for_without_arrays(spark):
    """the first letters of 103 texts were put into an array for every document."""
    plan = shred(empty_landing(spark), TRANSACTIONS)._jdf.queryExecution().analyzed().toString()
    assert "arrays_overlap" not in plan and "startswith" in plan.lower()


def test_a_merge_passes_only_the_columns_that_are_read(spark):
    """every column of the first core was joined with the increment's keys and written once more for the mart to read eight."""
    Scenario.reset()
    sc = Scenario(spark, SMOKE)
    merged = sc.core2("transactions")
    sc.core2("users")
    assert not os.path.exists(f"{sc.root}/core2_transactions") and os.path.exists(f"{sc.root}/core2_users")
    plan = merged.select("transid", "status")._jdf.queryExecution().executedPlan().toString()
    assert "partner_transid" not in plan
    stored = lambda name: {r.id: r for r in spark.read.parquet(f"{sc.root}/{name}").select("id", "status", "amount", "ts_ms", "inserted_at").collect()}
    want = {**stored("core1_transactions"), **stored("core_increment_transactions")}
    got = merged.select("id", "status", "amount", "ts_ms", "inserted_at").collect()
    assert len(got) == len(want) > 0 and {r.id: r for r in got} == want


def test_a_check_walks_documents_for_its_columns_only(spark):
    """every top-level value of every document was taken, and every text looked at, to test one status."""
    Scenario.reset()
    sc = Scenario(spark, SMOKE)
    few, whole = sc.staged_all("transactions", ("status",)), sc.staged_all("transactions")
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert "__v3" in plan(whole) and "__v3" not in plan(few)  # one a column
    assert few.columns == ["status", "op", "ts_ms", "json_inserted_at", "inserted_at"]
    text = lambda d: sorted(map(str, d.select(few.columns).collect()))
    assert text(few) == text(whole) != []
    checks = queries._checks(spark, SMOKE)
    for name in ("chk_accepted", "chk_single_owner"):
        assert "__v3" not in plan(checks[name]().violations)
