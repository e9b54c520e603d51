"""Streaming staging: new landed files are staged once; a rerun with the same checkpoint adds nothing."""

import datetime as dt

from ledgerline.plans.tables import LOAD, Tables
from ledgerline.sources import adapters as A
from ledgerline.sources.landing import write_landing
from ledgerline.streaming.stream import stream_staging

UTC = dt.timezone.utc
SF = "/root/testdata/sf0.001"


def test_stream_stages_each_file_once(spark, tmp_path):
    land, ckpt = str(tmp_path / "landing"), str(tmp_path / "ckpt")
    tables = Tables(spark, str(tmp_path))
    events = A.events_landing(spark, SF)
    cut = dt.datetime(2024, 1, 15, tzinfo=UTC)
    early = events.filter(events.inserted_at < cut)
    late = events.filter(events.inserted_at >= cut)
    run = dt.datetime(2024, 2, 1, tzinfo=UTC)

    write_landing(early, land)
    stream_staging(tables, "staging", land, ckpt, A.CDC_SPEC, run).awaitTermination()
    n1 = tables.read("staging").count()
    assert n1 == early.count()

    write_landing(late, land)
    stream_staging(tables, "staging", land, ckpt, A.CDC_SPEC, run).awaitTermination()
    stream_staging(tables, "staging", land, ckpt, A.CDC_SPEC, run).awaitTermination()  # nothing new
    staged = tables.read("staging")
    assert staged.count() == events.count()
    assert staged.select("event_id").distinct().count() == events.count()
    assert set(staged.columns) >= {"id", "k", "op", "ts_ms", "json_inserted_at", "inserted_at"}
    assert {r[0] for r in tables.raw("staging").select(LOAD).distinct().collect()} == {"stream-000000000000", "stream-000000000001"}
