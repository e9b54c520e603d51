"""Findings on the driver's memory: what is sent to all tasks."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from ledgerline.operators.hierarchy import walk_hierarchy
from ledgerline.operators.upsert import upsert
from ledgerline.session import configure

STATIC, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def _ran(df):
    df.write.format("noop").mode("overwrite").save()
    n = df.count()
    return n, df._jdf.queryExecution().executedPlan().toString()


def _wide(spark, path, n):
    """A table as cores are: a few texts among many VARIANT columns, all NULL."""
    k = F.col("id")
    some = [k.cast("string").alias("id"), F.floor(k / 3).cast("string").alias("direct_manager"), F.lit("ACTIVE").alias("status"), F.concat(F.lit("09"), F.lpad(k.cast("string"), 8, "0")).alias("phone"), F.concat(F.lit("Customer#"), k.cast("string")).alias("name")]
    spark.range(n).select(*some, *[F.expr(f"cast(null as variant) as v{i}") for i in range(48)]).write.parquet(path)
    return spark.read.parquet(path)


def test_a_wide_table_is_not_broadcast_by_its_estimate(spark, tmp_path):
    """F3 to F11: each of six lookups of all users went through the driver, 1 GB for 5.4 million of them."""
    configure(spark)
    users = _wide(spark, f"{tmp_path}/users", 200_000)
    walk = walk_hierarchy(users)
    walk.write.format("noop").mode("overwrite").save()
    assert "Broadcast" not in walk._jdf.queryExecution().executedPlan().toString()
    n, plan = _ran(upsert(users, users.where("id % 10 <> 3"), "id"))
    assert n == 200_000 and "BroadcastExchange" not in plan


def test_a_small_table_is_still_broadcast(spark, tmp_path):
    configure(spark)
    users = _wide(spark, f"{tmp_path}/users", 2_000)
    walk = walk_hierarchy(users)
    got = walk.where("level = 2").collect()  # a plan of its own: the steps above are run as they are
    assert sorted((int(r.original_user_id), int(r.manager_id)) for r in got) == [(i, i // 9) for i in range(2_000)]
    joined = users.join(users.select(F.col("id").alias("other")), F.col("direct_manager") == F.col("other"))
    joined.collect()
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_the_limit_of_the_application_is_for_measured_sizes():
    def configured(**given):
        conf = {}
        stub = SimpleNamespace(conf=SimpleNamespace(set=conf.__setitem__), sparkContext=SimpleNamespace(getConf=lambda: SimpleNamespace(getAll=lambda: list(given.items()))))
        configure(stub)
        return conf

    assert configured()[STATIC] == "-1" and configured()[MEASURED] == "10MB"
    assert configured(**{STATIC: "256k"})[MEASURED] == "256k"
    own = configured(**{STATIC: "256k", MEASURED: "1m"})
    assert MEASURED not in own and own[STATIC] == "-1"
