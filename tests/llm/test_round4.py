"""Findings on time and disk at 6 GB: pairs that nobody asks for, phrases that every shard reports."""

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import collocations, neardup


def test_pairs_across_components_only():
    """F1, op7: an entry of one large component and one member of another made all its pairs."""
    n = 3_000
    comp = np.zeros(n, np.int64)
    comp[1_234] = 7
    found = [(x, y) for x, y in neardup._pairs_across(np.array([0]), np.array([n]), comp, 1 << 19)]
    assert sum(len(x) for x, _ in found) == n - 1


def test_pairs_across_components_are_all_made_once():
    rng = np.random.default_rng(5)
    size = rng.integers(1, 30, 40)
    end = np.cumsum(size)
    start, comp = end - size, rng.integers(0, 4, end[-1])
    for most in (1, 50, 1 << 19):
        found = [tuple(sorted(p)) for x, y in neardup._pairs_across(start, end, comp, most) for p in zip(x.tolist(), y.tolist())]
        want = [(x, y) for s, e in zip(start.tolist(), end.tolist()) for x in range(s, e) for y in range(x + 1, e) if comp[x] != comp[y]]
        assert sorted(found) == want


def _words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))


def test_words_are_hashed_by_their_bytes():
    """F1, op7: equal words have equal hashes, others different ones, wherever a text is cut into batches."""
    rng = np.random.default_rng(3)
    odd = ["a", "B", "\u00c4", "\u0130", "\u2003", "\u00a0", "\x1c", "\x1f", "\x85", "\x00", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\U0001f600"]
    texts = [None, "", " ", "x", " x ", "x" * 8, "x" * 16, "x" * 17, "\x00" * 8, "\x00" * 9, "A" * 5_000, *["".join(rng.choice(odd, rng.integers(0, 40))) for _ in range(600)]]
    by_word = {}
    for size in (1, 7, 700):
        for at in range(0, len(texts), size):
            some = texts[at : at + size]
            got = neardup.word_hashes(pa.array(["before ", *some, "out"], pa.string()).slice(1, len(some)))
            assert len(got) == len(some)
            for t, h in zip(some, got):
                assert len(h) == len(_words(t))
                assert all(by_word.setdefault(w, x) == x for w, x in zip(_words(t), h.tolist()))
    assert len(set(by_word.values())) == len(by_word) > 900
    assert neardup.word_hashes(pa.array([], pa.string())) == []
    s = neardup.shingles(neardup.word_hashes(pa.array(["a b A c d a " * 3]))[0], 2)
    assert (np.diff(s) > 0).all() and len(s) == 6


def test_mining_shards_hold_one_language(spark):
    """F2, op12: each shard held some bytes of every language, so its local support was that of a small share."""
    rows = [("%05d" % i * 20, lang) for i in range(400) for lang in ("en", "de", *["l%d" % (i % 5)] * (i < 10))] + [(None, "null"), ("", "empty")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3).withColumn("n", F.coalesce(F.octet_length("text"), F.lit(0)))
    totals = docs.groupBy("lang").agg(F.sum("n").alias("total")).cache()
    dealt = collocations._dealt(docs.join(totals, "lang"), totals, 10_000)
    parts = [sorted(p) for p in dealt.rdd.map(lambda r: (r.lang, r.text)).glom().collect()]
    assert sorted(map(repr, (x for p in parts for x in p))) == sorted(repr((lang, t)) for t, lang in rows)
    of = [{lang for lang, _ in p} for p in parts]
    assert len(parts) == 4 + 4 + 1 and sum(x == {"en"} for x in of) == sum(x == {"de"} for x in of) == 4
    again = collocations._dealt(docs.join(totals, "lang"), totals, 10_000)
    assert [sorted(p) for p in again.rdd.map(lambda r: (r.lang, r.text)).glom().collect()] == parts


def test_phrases_in_parts(monkeypatch):
    rng = np.random.default_rng(1)
    ids = rng.integers(-1, 12, 4_000).astype(np.int32) ** 2 // 12
    ids[rng.random(4_000) < 0.1] = -1
    word_hash = np.array([xxhash.xxh64_intdigest(bytes([i])) for i in range(12)], np.uint64)

    def found():
        out = {}
        for j, first, n, h in collocations.phrases(ids, word_hash, lambda count, h: count >= 3):
            for f, c, x in zip(first.tolist(), n.tolist(), h.tolist()):
                assert out.setdefault(tuple(ids[f : f + j].tolist()), (f, c, x)) == (f, c, x)
        return out

    whole = found()
    assert len(whole) > 500
    for at_once in (1, 10, 333):
        monkeypatch.setattr(collocations, "_AT_ONCE", at_once)
        assert found() == whole
