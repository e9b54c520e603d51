"""Driver contract: the flagship entry runs and every query has a matching oracle statement."""

import pytest

import __spark_entry__ as E
from ledgerline.queries import QUERIES
from ledgerline.sources import adapters as A
from ledgerline.sources.specs import SPECS, STAGING_ENVELOPE


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "transaction_day" in df.columns


def test_every_query_has_oracle_sql():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    # trained and search operators have no SQL; every query of the library's own operators has one
    assert set(QUERIES) - set(sql) == set()


@pytest.mark.parametrize("name, table, source, key, letter", [("txn", "transactions", "orders", "o_orderkey", "t"), ("store", "stores", "supplier", "s_suppkey", "s"), ("user", "users", "customer", "c_custkey", "")])
def test_whole_shreds_hold_every_document_and_column(spark, name, table, source, key, letter):
    out = QUERIES[f"shred_{name}_whole"](spark, E.SMOKE_DIR)
    assert out.columns == [f.name for f in SPECS[table]] + STAGING_ENVELOPE
    ids = [r.id for r in out.select("id").collect()]
    keys = [r[0] for r in A.table(spark, E.SMOKE_DIR, source).select(key).collect()]
    assert set(ids) == {f"{letter}{k}" for k in keys}
    again = {"txn": lambda k: k % 5 == 2, "store": lambda k: k % 7 == 3, "user": lambda k: k % 11 == 4}[name]
    assert len(ids) == len(keys) + sum(map(again, keys))
