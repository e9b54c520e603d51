"""Findings of the review of round 3."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators.staging import shred
from ledgerline.plans.core import core_full, core_merge
from ledgerline.sources import adapters as A
from ledgerline.sources.landing import empty_landing
from ledgerline.sources.specs import TRANSACTIONS, parse_spec

RUN = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def test_scalars_leave_the_walk_as_text(spark):
    """a VARIANT of its own for each of 17 scalars, read twice, took most of the time of shredding."""
    plan = shred(empty_landing(spark), TRANSACTIONS, RUN)._jdf.queryExecution().analyzed().toString()
    nested = sum("." in f.path for f in TRANSACTIONS)
    json = sum(f.dtype == "JSONB" for f in TRANSACTIONS)
    assert plan.count("try_variant_get(") <= 4 * nested + json + 5


def test_scalar_columns_of_containers(spark, tmp_path):
    docs = ['{"a":{"b":1},"s":"{x}","n":[1],"m":7}', '{"a":"[1","s":[],"n":"12","m":{}}', '["a"]', "null", None, '{"s":"","n":null}']
    spec = "a:S s:S n:INT m:NUMERIC(15,2) gone:TS"
    land = spark.createDataFrame([(d,) for d in docs], "data string").select(F.try_parse_json("data").alias("data"))
    land.write.parquet(str(tmp_path / "landing"))
    none = (None,) * 5
    want = sorted([(None, "{x}", None, 7, None), ("[1", None, 12, None, None), (None, "", None, None, None), none, none, none], key=str)
    for d in (land, spark.read.parquet(str(tmp_path / "landing"))):
        got = [(r.a, r.s, r.n, None if r.m is None else int(r.m), r.gone) for r in shred(d, spec, envelope=False).collect()]
        assert sorted(got, key=str) == want


def test_core_merge_runs_its_increment_once(spark, tmp_path):
    """the upsert names its source twice, so the second batch was shredded, sorted and shuffled twice."""
    spec = parse_spec("id=_id.$oid:S v:INT")
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    def staged(ids, day):
        text = F.concat(F.lit('{"_id":{"$oid":"'), F.col("id").cast("string"), F.lit(f'"}},"v":{day}}}'))
        ts = F.lit(dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc))
        rows = ids.select(text.alias("data"), F.lit("c").alias("op"), ts.alias("ts_ms"), ts.alias("inserted_at"))
        return shred(rows.mapInArrow(count, rows.schema), spec, RUN)

    def stored(df):
        df.write.parquet(str(tmp_path / "increment"))
        return spark.read.parquet(str(tmp_path / "increment"))

    core_full(staged(spark.range(100), 1), spec, RUN).write.parquet(str(tmp_path / "core"))
    runs.value = 0
    out = core_merge(spark.read.parquet(str(tmp_path / "core")), staged(spark.range(50, 150), 2), spec, RUN, stored=stored)
    assert sorted((int(r.id), r.v) for r in out.collect()) == [(i, 1 if i < 50 else 2) for i in range(150)]
    assert runs.value == 100


def test_second_batch_reads_the_lines_once(spark):
    """late and settled orders were two passes over all lines."""
    plan = A.txns_landing(spark, "/root/testdata/sf0.001", 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1
