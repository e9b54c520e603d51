"""Findings of the third review."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators.staging import shred
from ledgerline.sources.landing import empty_landing
from ledgerline.sources.specs import TRANSACTIONS


def test_shred_walks_a_document_once(spark):
    """127 paths a document, each taken several times, made staging from a stream the longest stage."""
    plan = shred(empty_landing(spark), TRANSACTIONS, dt.datetime(2024, 1, 1))._jdf.queryExecution().analyzed().toString()
    assert plan.count("try_variant_get(__doc#") == 1


def test_shred_top_level_values(spark):
    docs = ['{"a":{"b":1,"c":null},"A":"x","n":null,"o":{"k":[1]},"s":"{x}","x`y":2}', '[{"a":1}]', "null", '"a"', None, '{"a":7}']
    land = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, data string").withColumn("data", F.try_parse_json("data"))
    spec = "ab=a.b:INT ac=a.c:S upper=A:S n:S nj=n:JSONB o:S oj=o:JSONB s:S q=x`y:INT a_=a:INT gone:BOOL"
    rows = shred(land.withColumn("i", F.col("i")), spec, envelope=False)
    got = rows.select(*[F.to_json(c).alias(c) if t == "variant" else c for c, t in rows.dtypes]).collect()
    none = (None,) * 11
    assert sorted(map(tuple, got), key=str) == sorted([(1, None, "x", None, "null", None, '{"k":[1]}', "{x}", 2, None, None), none, none, none, none, (*none[:9], 7, None)], key=str)


def test_licence_model_counts_every_paragraph(spark):
    """the counts, fit and threshold took 6,000 paragraphs of 800 documents; a line that
    24,000 of 25,200 paragraphs hold must be counted in all of them, and repeated rows once."""
    from ledgerline.llm import licences

    n = 1200
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("concat(repeat('they obtain a copy of some quite ordinary prose today\\n', 20), 'line ', id)").alias("text"))
    notes = licences.evidence(docs.union(docs.limit(50)))
    assert notes.count() == 21 * n
    assert notes.where("array_contains(hits, 'obtain a')").count() == 20 * n
    weights, _, _ = licences.fit(notes)
    common = {"obtain", "copy", "a copy", "obtain a", "copy of"}
    assert not {r.f for r in weights.select("f").collect()} & common
