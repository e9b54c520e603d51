"""Latest-per-key, slices, upsert, hierarchy quirks and checks on small hand-made tables."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import checks as C
from ledgerline.operators.hierarchy import user_manager_phones, walk_hierarchy
from ledgerline.operators.latest import latest_per_key, slice_newer, slice_retention
from ledgerline.operators.upsert import upsert

UTC = dt.timezone.utc
T = dt.datetime


def test_latest_per_key_drops_null_keys_and_orders_desc_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, None), ("a", None, 9), ("b", 1, 1), (None, 9, 9)], "id string, p int, q int"
    )
    out = {r["id"]: (r["p"], r["q"]) for r in latest_per_key(df, "id", ["p", "q"]).collect()}
    assert out == {"a": (2, None), "b": (1, 1)}


def test_latest_per_key_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = latest_per_key(df, "k", ["ts"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    below = "\n".join(lines[exchange:])
    # a partial top-1 per key runs map-side, under the exchange, so a hot key ships <= 1 row per task
    assert "WindowGroupLimit" in below and "Partial" in below


def test_composite_keys(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 1)], "x string, y int, ts int")
    assert latest_per_key(df, ["x", "y"], ["ts"]).count() == 2


def test_slices(spark):
    tgt = spark.createDataFrame([(T(2024, 1, 2),)], "ts_ms timestamp")
    df = spark.createDataFrame([(T(2024, 1, 1),), (T(2024, 1, 2),), (T(2024, 1, 3),)], "ts_ms timestamp")
    assert slice_newer(df, "ts_ms", tgt).count() == 1  # strictly newer
    assert slice_newer(df, "ts_ms", None).count() == 3
    ns = spark.createDataFrame([(1704067200000000000,), (1706000000000000000,)], "ts long")
    assert slice_retention(ns, "ts", 7, T(2024, 1, 25, tzinfo=UTC)).count() == 1
    assert slice_retention(df, "ts_ms", 1, T(2024, 1, 3, 12, tzinfo=UTC)).count() == 1


def test_upsert_update_insert_never_delete(spark):
    tgt = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int")
    src = spark.createDataFrame([("b", 2, "x"), ("c", 2, "y"), (None, 2, "z")], "k string, v int, extra string")
    out = sorted((r["k"] or "", r["v"]) for r in upsert(tgt, src, "k").collect())
    assert out == [("", 1), ("", 2), ("a", 1), ("b", 2), ("c", 2)]
    assert upsert(tgt, src, "k").columns == ["k", "v"]


def test_two_incremental_runs_equal_one_full_run(spark):
    from ledgerline.plans.core import core_full, core_merge

    rows = [(f"k{i % 7}", T(2024, 1, 1 + i // 7, i % 7), i) for i in range(70)]
    df = spark.createDataFrame(rows, "id string, ts_ms timestamp, v int").withColumn(
        "json_inserted_at", F.col("ts_ms")).withColumn("inserted_at", F.col("ts_ms"))
    spec = "id:S v:INT"
    run = T(2024, 2, 1, tzinfo=UTC)
    first, second = df.filter("ts_ms < '2024-01-05'"), df.filter("ts_ms >= '2024-01-05'")
    inc = core_merge(core_merge(None, first, spec, run), second, spec, run)
    full = core_full(df, spec, run)
    assert sorted(inc.collect()) == sorted(full.collect())


def _users(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, phone string, status string, direct_manager string, "
                                       "inserted_at timestamp")


def test_hierarchy_cycle_runs_to_level_six(spark):
    u = _users(spark, [("0", "n0", "p0", "ACTIVE", "1", None), ("1", "n1", "p1", "ACTIVE", "0", None)])
    levels = sorted((r["original_user_id"], r["level"], r["manager_id"]) for r in walk_hierarchy(u).collect())
    assert [x for x in levels if x[0] == "0"] == [("0", i, "1" if i % 2 else "0") for i in range(1, 7)]


def test_inactive_manager_listed_but_stops_climb_and_null_phone_row(spark):
    u = _users(spark, [
        ("a", "A", "pa", "ACTIVE", "b", None), ("b", "B", "pb", "INACTIVE", "c", None),
        ("c", "C", "pc", "ACTIVE", None, None), ("d", "D", None, "ACTIVE", "a", None),
    ])
    walk = sorted((r["original_user_id"], r["level"], r["manager_id"]) for r in walk_hierarchy(u).collect())
    assert ("a", 1, "b") in walk and not any(w[0] == "a" and w[1] == 2 for w in walk)
    rows = {r["user_phone"]: r for r in user_manager_phones(u, T(2024, 1, 1)).collect()}
    assert rows["pa"]["hierarchy_phone"] == ["pa", "pb"] and rows["pa"]["agent_name"] == "B"
    assert rows[None]["hierarchy_phone"] == ["pa", "pb"]  # NULL-phone user with managers keeps a row
    assert "pb" not in rows  # inactive users have no row


def test_checks(spark):
    df = spark.createDataFrame([("a", "c", 1), ("a", "x", 0), (None, None, 0)], "k string, op string, n int")
    assert C.check_not_null(df, "k").count() == 1
    assert C.check_unique(df, "k").first()["n_records"] == 2
    assert [r["value_field"] for r in C.check_accepted(df, "op", list("cudr")).collect()] == ["x"]
    assert C.check_expr(df, "n = 0").count() == 1
    fresh = C.check_freshness(spark.createDataFrame([(T(2024, 1, 1),)], "t timestamp"), "t", T(2024, 1, 1, 13, tzinfo=UTC))
    assert fresh.first()["status"] == "warn"
    rep = {r["check"]: r["status"] for r in C.run_checks([C.Check("a", C.check_not_null(df, "k"), "warn"),
                                                          C.Check("b", C.check_expr(df, "n >= 0"))]).collect()}
    assert rep == {"a": "warn", "b": "pass"}


def test_own_phone_first_and_stable_stamps(spark):
    u = _users(spark, [("a", "A", "p9", "ACTIVE", "b", None), ("b", "B", "p1", "ACTIVE", None, None)])
    first = {r["user_phone"]: r for r in user_manager_phones(u, T(2024, 1, 1), own_phone_first=True).collect()}
    assert first["p9"]["hierarchy_phone"] == ["p9", "p1"]
    day1 = user_manager_phones(u, T(2024, 1, 1))
    u2 = _users(spark, [("a", "A", "p9", "ACTIVE", "b", None), ("b", "B2", "p1", "ACTIVE", None, None)])
    day2 = {r["user_phone"]: r["inserted_at"] for r in user_manager_phones(u2, T(2024, 1, 2), previous=day1).collect()}
    # p1's own name changed -> new stamp; p9's agent_name changed too -> new stamp
    assert day2 == {"p9": T(2024, 1, 2), "p1": T(2024, 1, 2)}
    day3 = {r["user_phone"]: r["inserted_at"] for r in user_manager_phones(u2, T(2024, 1, 3), previous=day1).collect()}
    assert day3 == {"p9": T(2024, 1, 3), "p1": T(2024, 1, 3)}
    same = {r["user_phone"]: r["inserted_at"] for r in user_manager_phones(u, T(2024, 1, 3), previous=day1).collect()}
    assert same == {"p9": T(2024, 1, 1), "p1": T(2024, 1, 1)}  # unchanged content keeps its stamp


def test_affected_keys_fix_options(spark):
    from ledgerline.operators.mart import affected_keys

    mart = spark.createDataFrame(
        [("t1", "p1", "S1"), ("t2", "gone", "S1"), ("t3", "p1", None)], "transid string, salesman_phone string, merchant_code string"
    )
    phones = spark.createDataFrame([("p1", T(2024, 1, 1))], "user_phone string, inserted_at timestamp")
    stores = spark.createDataFrame([("S2", T(2024, 1, 5))], "code string, inserted_at timestamp")
    txn = spark.createDataFrame([("t3", "S2")], "transid string, store_code string")
    wm = {"users": T(2024, 1, 2), "stores": T(2024, 1, 2)}
    ids = lambda df: sorted(r[0] for r in df.collect())
    assert ids(affected_keys(mart, phones, stores, wm)) == []
    assert ids(affected_keys(mart, phones, stores, wm, refresh_removed_salesmen=True)) == ["t2"]
    assert ids(affected_keys(mart, phones, stores, wm, repair_late_stores=txn)) == ["t3"]


def test_read_landing_pushes_watermark_into_scan(spark, tmp_path):
    from ledgerline.sources.landing import read_landing, to_landing, write_landing

    df = spark.createDataFrame([('{"a":1}', T(2024, 1, d)) for d in (1, 2, 3)], "j string, t timestamp")
    write_landing(to_landing(df, F.parse_json("j"), "c", F.col("t"), F.col("t")), str(tmp_path / "l"))
    got = read_landing(spark, str(tmp_path / "l"), since=T(2024, 1, 2, tzinfo=UTC))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landing_date" in plan and "PushedFilters: [IsNotNull(inserted_at), GreaterThan(inserted_at" in plan
    assert got.count() == 1


def test_row_checks_of_a_table_count_each_and_keep_severity(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, None)], "a int, b string")
    rows = [*C.not_null("t", "a"), C.RowCheck("t.b.not_null", F.col("b").isNull(), "warn"), C.RowCheck("t.a.is_1", ~F.expr("a = 1"))]
    got = {r["check"]: (r.violations, r.status) for r in C.run_checks([], [(df, rows)]).collect()}
    assert got == {"t.a.not_null": (2, "fail"), "t.b.not_null": (2, "warn"), "t.a.is_1": (0, "pass")}
    empty = C.run_checks([], [(df.limit(0), rows)]).collect()
    assert [r.violations for r in empty] == [0, 0, 0]


def test_phone_mart_spreads_users_without_a_phone(spark):
    """Users without a phone form one group: its listed phones are made distinct by a shuffle on both columns
    before they are collected, and the row is kept."""
    users = spark.range(300).selectExpr(
        "cast(id as string) as id", "if(id % 3 = 1, null, concat('p', id % 40)) as phone", "concat('n', id) as name",
        "cast(id div 4 as string) as direct_manager", "'ACTIVE' as status", "timestamp_seconds(id) as inserted_at",
    )
    out = user_manager_phones(users, T(2024, 1, 1))
    plan = out._jdf.queryExecution().executedPlan().toString()
    deals = [line.split("hashpartitioning(")[1].split(", ENSURE")[0] for line in plan.split("\n") if "Exchange hashpartitioning(user_phone" in line]
    assert len(deals) == 2 and any("hp#" in d for d in deals)  # first by both, then by the phone
    (row,) = out.where("user_phone is null").collect()
    people = {r.id: r for r in users.collect()}
    listed, names = set(), []
    for p in people.values():
        if p.phone is None:
            above, boss = [], p.direct_manager
            for _ in range(6):
                above.append(people[boss].phone)
                boss = people[boss].direct_manager
            found = [x for x in above if x is not None]
            listed |= set(found)
            names += [p.name] * bool(found)
    assert row.hierarchy_phone == sorted(listed) and row.user_name == min(names)


def test_walk_equals_a_recursive_query(spark):
    """The unrolled joins against Spark's own recursion, on random managers with cycles and loops."""
    import random

    for seed in range(3):
        rng = random.Random(seed)
        n = 40
        rows = [(str(i), rng.choice([None, str(rng.randrange(n)), str(i), "gone"]), rng.choice(["ACTIVE", "ACTIVE", "OFF", None])) for i in range(n)]
        users = spark.createDataFrame(rows, "id string, direct_manager string, status string")
        users.createOrReplaceTempView("people")
        want = spark.sql("""
            WITH RECURSIVE edge AS (SELECT id AS lower, direct_manager AS upper FROM people WHERE status = 'ACTIVE' AND direct_manager IS NOT NULL),
            path (start, upper, depth) AS (
              SELECT lower, upper, 1 FROM edge
              UNION ALL SELECT p.start, e.upper, p.depth + 1 FROM path AS p JOIN edge AS e ON e.lower = p.upper WHERE p.depth < 6)
            SELECT start, upper, depth FROM path""")
        assert sorted(map(tuple, walk_hierarchy(users).collect())) == sorted(map(tuple, want.collect())), seed
