"""Property tests: JSON_VALUE / safe-cast rules against Python's JSON model on random documents; the unrolled
hierarchy walk against Spark's recursive SQL on random hierarchies."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import jsonx as J
from ledgerline.operators.hierarchy import walk_hierarchy

KEYS = [f"k{i}" for i in range(6)]
scalars = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(min_value=-(2**62), max_value=2**62),
    st.text(alphabet="abcXYZ{}[]1.0 ", max_size=6),
)
values = st.one_of(scalars, st.lists(scalars, max_size=2), st.dictionaries(st.sampled_from(["a", "b"]), scalars, max_size=2))
docs = st.dictionaries(st.sampled_from(KEYS), values, max_size=6)


def expected_value(doc: dict, key: str):
    if key not in doc:
        return None
    v = doc[key]
    if v is None or isinstance(v, (list, dict)):
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


def expected_int(s):
    if s is None:
        return None
    body = s[1:] if s[:1] in "+-" else s
    return int(s) if body.isdigit() and body.isascii() and -(2**63) <= int(s) < 2**63 else None


@settings(max_examples=30, deadline=None)
@given(st.lists(docs, min_size=1, max_size=20))
def test_json_value_matches_python_model(spark, batch):
    df = spark.createDataFrame([(json.dumps(d),) for d in batch], "j string").select(F.try_parse_json("j").alias("d"))
    cols = []
    for k in KEYS:
        cols += [J.json_value("d", k).alias(f"{k}_s"), J.extract("d", k, "INT").alias(f"{k}_i"), J.extract("d", k, "BOOL").alias(f"{k}_b")]
    rows = df.select(*cols).collect()
    for d, r in zip(batch, rows):
        for k in KEYS:
            s = expected_value(d, k)
            assert r[f"{k}_s"] == s, (d, k)
            assert r[f"{k}_i"] == expected_int(s), (d, k)
            assert r[f"{k}_b"] == ({"true": True, "false": False}.get(s.lower()) if s is not None else None), (d, k)


nodes = st.integers(min_value=0, max_value=7)
# ids are unique; a manager may be missing, inactive, the user's own self or part of a cycle
hierarchies = st.dictionaries(nodes, st.tuples(st.one_of(st.none(), nodes), st.sampled_from(["ACTIVE", "ACTIVE", "INACTIVE", None])), max_size=8)

CLIMB = """
WITH RECURSIVE walk(original_user_id, manager_id, level) AS (
  SELECT id, direct_manager, 1 FROM walk_users WHERE status = 'ACTIVE' AND direct_manager IS NOT NULL
  UNION ALL
  SELECT w.original_user_id, u.direct_manager, w.level + 1
  FROM walk w JOIN walk_users u ON u.id = w.manager_id
  WHERE w.level < 6 AND u.status = 'ACTIVE' AND u.direct_manager IS NOT NULL)
SELECT * FROM walk"""


@settings(max_examples=15, deadline=None)
@given(hierarchies)
def test_unrolled_walk_matches_recursive_sql(spark, users):
    rows = [(str(i), None if m is None else str(m), s) for i, (m, s) in users.items()]
    df = spark.createDataFrame(rows, "id string, direct_manager string, status string")
    df.createOrReplaceTempView("walk_users")
    expected = sorted(map(tuple, spark.sql(CLIMB).collect()))
    assert sorted(map(tuple, walk_hierarchy(df).select("original_user_id", "manager_id", "level").collect())) == expected
