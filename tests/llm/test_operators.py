"""Every operator against a brute-force version on small tables that hold the awkward cases: nulls in
any column, empty and long texts, repeated rows, shared ids, clashing column names, empty tables."""

import hashlib
import json
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import bpe, common, decontaminate, lengths, licences, multiindex, neardup, records, sharding, substrings, toxicity
from ledgerline.llm.queries import vocabulary
from ledgerline.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, score double, row string, id long"
WORDS = ["alpha", "beta", "gamma", "delta", "Straße", "naïve", "x1", "42", "don't", "...", "über", "日本語"]


def _texts():
    rng = random.Random(7)
    some = [" ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(rng.choice((3, 40, 120)))) for _ in range(24)]
    near = some[5].split(" ")
    near[11] = "other"
    return some + [some[1], some[1], " ".join(near), "intro " + some[2], "", None, "one", "a  b\n\n c\t", "é" * 300, "z" * 5000, "<|endoftext|> in it", "\x1c!"]


def _rows(texts):
    return [(i, t, None, None, "r", 1) for i, t in enumerate(texts)] + [(None, "no id here at all", "en", 1.0, None, None), (0, texts[0], None, None, "r", 1), (3, "shares its id", "en", 0.5, "r", 2)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(_texts()), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_row(rows):
    return sorted(rows, key=lambda r: json.dumps(r, default=str))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (3, 3)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}


# --- 10: encoding and decoding ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


def test_encode_decode(docs, empty, library):
    out = bpe.encode_decode(docs, vocabulary("byte_bpe_50k.json")).collect()
    want = []
    for i, t, *_ in _rows(_texts()):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert _by_row([(r.doc_id, r.ids, r.decoded) for r in out]) == _by_row(want)
    assert bpe.encode_decode(empty, vocabulary("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("step", [1, 5, 333])
def test_stream_has_constant_memory_and_equal_ids(library, step):
    merges = bpe.MergeTable(open(vocabulary("byte_bpe_50k.json"), encoding="utf-8").read())
    text = "a" * 3000 + " " * 2500 + "b don't'll  x" + "!" * 2000 + "<|endoftext|> <|endo" + "9" * 3000 + "\n" * 900 + "é" * 1500
    stream, ids, held = bpe.TextStream(merges, long=64, slack=200), [], 0
    for at in range(0, len(text), step):
        ids += stream.feed(text[at : at + step])
        held = max(held, len(stream.buf) + len(stream.bpe.held))
    ids += stream.finish()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert held < merges.lookahead + 200 + merges.longest + 3 * step + 100
    one = bpe.Decoder(merges.bytes_of)
    assert "".join(one.feed([i]) for i in ids) + one.finish() == text


def test_every_unit_goes_through_the_transducer(library):
    """What the query's encoder does: each different unit is fed once, and long ones in pieces, so that the
    transducer never holds more than its lookahead, its slack and two pieces."""
    merges = bpe.MergeTable(open(vocabulary("byte_bpe_50k.json"), encoding="utf-8").read())
    texts = ["one two  two three", "", "x" * 300_000 + " tail", "\n" * 50_000 + "é" * 30_000, "one <|endoftext|> two", "\x1c odd"]
    enc = bpe.Encoder(merges)
    ids, n = enc.encode(texts)
    assert [int(x) for x in ids] == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids] and len(n) == len(texts)
    units = {u for t in texts for u in ([t] if "\x1c" in t else bpe._UNIT.findall(t))}
    assert enc.fed == len(units)
    enc.encode(texts)
    assert enc.fed == len(units)
    assert 0 < enc.held <= merges.lookahead + 4096 + merges.longest + 2 * bpe.PIECE


def test_lookahead_is_sufficient():
    """Random merge lists: no continuation changes a token that ends before the lookahead."""
    rng = random.Random(3)
    letter = bpe.byte_letters()
    for _ in range(30):
        alphabet = [letter[ord(c)] for c in "ab"]
        vocab, merges, parts = {c: i for i, c in enumerate(letter.values())}, [], list(alphabet)
        for _ in range(rng.randrange(2, 9)):
            x, y = rng.choice(parts), rng.choice(parts)
            if x + y not in vocab:
                vocab[x + y] = len(vocab)
                merges.append([x, y])
                parts.append(x + y)
        table = bpe.MergeTable(json.dumps({"model": {"vocab": vocab, "merges": merges}, "added_tokens": []}))
        for _ in range(40):
            text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 60)))
            tokens, end, stable = table.tokenize(text), 0, []
            for t in tokens:
                end += len(table.bytes_of[t])
                if end <= len(text) - table.lookahead:
                    stable.append(t)
            for _ in range(6):
                more = text + bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 20)))
                assert table.tokenize(more)[: len(stable)] == stable
                assert table._scanned(more) == table._queued(more)


# --- 9: records -----------------------------------------------------------------------------------


def test_checksum():
    known = {b"123456789": 0xE3069283, b"a": 0xC1D04330, b"": 0, bytes(32): 0x8A9136AA}
    assert neq(records.crc32c_many(list(known)), list(known.values()))


def neq(a, b):
    return [int(x) for x in a] == b


def test_records(spark, docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    path = scratch_path(spark, "test-records")
    index = records.write_records(docs, path, vocabulary("word_bpe_49k.json"), end_id=2, file_bytes=2000)
    got = records.with_starts(records.read_records(index.orderBy(F.rand(1)), path), index).collect()
    want, start = [], 0
    for i, t, *_ in sorted(_rows(_texts()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(((r.id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == want
    data, sizes = records.frame(np.arange(5), np.array([2, 3]), 2)
    assert [x.tolist() for x in records.unframe(data, 2)] == [[0, 1], [2, 3, 4]]
    with pytest.raises(ValueError):
        records.unframe(data[:13] + b"\xff" + data[14:], 2)
    path = scratch_path(spark, "test-records")
    assert records.read_records(records.write_records(empty, path, vocabulary("word_bpe_49k.json"), end_id=2), path).count() == 0


# --- 4: lengths -----------------------------------------------------------------------------------


def test_lengths(spark, docs, empty, library):
    sizes = [len(library.encode(r[1] or "", add_special_tokens=False).ids) for r in _rows(_texts())]
    sums = lengths.suffix_sums(lengths.histogram(docs, vocabulary("byte_bpe_50k.json")))
    for r in lengths.length_table(docs, vocabulary("byte_bpe_50k.json")).collect():
        assert r.docs_at_least == sum(s >= r.n_tokens for s in sizes) and r.tokens_at_least == sum(s for s in sizes if s >= r.n_tokens)
        assert r.truncated_tokens == sum(min(s, r.n_tokens) for s in sizes) and r.total_tokens == sum(sizes)
    limits = [0, 1, 7, 100, 1023, 1024, 1500, 10**6]
    got = {r.limit: r for r in lengths.at_limits(sums, spark.createDataFrame([(x,) for x in [*limits, 7, None]], "k long")).collect()}
    assert sorted(got) == limits
    for x in limits:
        assert (got[x].docs_at_least, got[x].kept_tokens) == (sum(s >= x for s in sizes), sum(min(s, x) for s in sizes)), x
    for r in lengths.quantiles(sums, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == sorted(sizes)[int(np.ceil(r.share * len(sizes))) - 1]
    assert lengths.length_table(empty, vocabulary("byte_bpe_50k.json")).count() == 0


# --- 7: near-duplicates ---------------------------------------------------------------------------


def _brute_components(rows, k, percent):
    sets = []
    for i, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        sets.append({tuple(w)} if 0 < len(w) < k else {tuple(w[j : j + k]) for j in range(len(w) - k + 1)})
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if (sets[a] and sets[b] and 100 * same >= percent * len(sets[a] | sets[b])) or (rows[a][0] is not None and rows[a][0] == rows[b][0] and sets[a] and sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    low = {g: min((rows[j][0] for j in range(len(rows)) if group[j] == g and rows[j][0] is not None), default=None) for g in group}
    return [(rows[j][0], len(sets[j]), low[group[j]]) for j in range(len(rows))]


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs, empty, k):
    got = [(r.id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, k, 80).collect()]
    assert _by_row(got) == _by_row(_brute_components(_rows(_texts()), k, 80))
    assert neardup.near_duplicates(empty, k, 80).count() == 0


def test_near_duplicates_in_a_large_group(spark, monkeypatch):
    """Many near copies of one text, beside texts that share only a passage, with small block limits."""
    monkeypatch.setattr(neardup, "MANY", 8)
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(5)
    base = [f"w{rng.randrange(9999)}" for _ in range(150)]
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(rng.choice((0, 1, 2, 3, 4, 6, 9))):
            t[rng.randrange(150)] = f"v{rng.randrange(9999)}"
        rows.append((i, " ".join(t)))
    rows += [(100 + i, " ".join(base[:60] + [f"u{rng.randrange(9999)}" for _ in range(80)])) for i in range(20)]
    got = [(r.id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()]
    assert _by_row(got) == _by_row(_brute_components(rows, 4, 80))


def test_near_duplicates_of_classes_with_one_smallest_id(spark):
    """Every class that holds id 1 has near copies of its own; id 9 is in three classes with smaller ids."""
    rng = random.Random(6)
    texts = [[f"w{rng.randrange(9999)}" for _ in range(60)] for _ in range(8)]
    rows = [(1, " ".join(t)) for t in texts[:5]] + [(20 + i, " ".join(t + ["end"])) for i, t in enumerate(texts[:5])]
    rows += [(2 + i, " ".join(t)) for i, t in enumerate(texts[5:])] + [(9, " ".join(t)) for t in texts[5:]]
    got = [(r.id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()]
    assert _by_row(got) == _by_row(_brute_components(rows, 5, 80))


# --- 6: repeated strings --------------------------------------------------------------------------


def _brute_repeats(rows, length):
    first, out = {}, []
    order = sorted({(r[0] if r[0] is not None else common.LAST, r[1] or "") for r in rows})
    marks = {}
    by_id = {}
    for o, t in order:
        by_id.setdefault(o, []).append(t.encode())
    for o in sorted(by_id):
        fresh = set()
        for raw in by_id[o]:
            own, cut = set(), []
            for s in range(len(raw) - length + 1):
                x = raw[s : s + length]
                if x in first or x in own:
                    cut.append(s)
                own.add(x)
            fresh |= own
            gone = bytearray(len(raw))
            for s in cut:
                gone[s : s + length] = b"\x01" * length
            marks[o, raw] = bytes(gone)
        first.update(dict.fromkeys(fresh))
    for r in rows:
        raw = (r[1] or "").encode()
        gone = marks[r[0] if r[0] is not None else common.LAST, raw]
        out.append((r[0], len(raw), hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest(), len(re.findall(b"\x01+", gone))))
    return out


@pytest.mark.parametrize("length", [100, 40])
def test_repeated_strings(docs, empty, length):
    out = substrings.remove_repeats(docs, length)
    got = [(r.row.doc_id, r.n_bytes, hashlib.sha256(r.kept).hexdigest(), len(r.spans) // 2) for r in out.collect()]
    assert _by_row(got) == _by_row(_brute_repeats(_rows(_texts()), length))
    assert substrings.remove_repeats(empty, length).count() == 0


def test_repeated_strings_with_frequent_and_large_groups(spark, monkeypatch):
    monkeypatch.setattr(substrings, "FREQUENT", 6)
    monkeypatch.setattr(substrings, "GROUP", 4)
    rng = random.Random(2)
    line = "".join(rng.choice("abcdef ") for _ in range(70))
    parts = ["".join(rng.choice("ghijk") for _ in range(60)) for _ in range(4)]
    rows = [(i, rng.choice(parts) + line + rng.choice(parts) + "".join(rng.choice("xyz") for _ in range(90))) for i in range(40)]
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 100)
    got = [(r.row.doc_id, r.n_bytes, hashlib.sha256(r.kept).hexdigest(), len(r.spans) // 2) for r in out.collect()]
    assert _by_row(got) == _by_row(_brute_repeats(rows, 100))


def test_repeated_strings_of_one_window_in_large_groups(spark, monkeypatch):
    monkeypatch.setattr(substrings, "FREQUENT", 1 << 40)
    monkeypatch.setattr(substrings, "GROUP", 4)
    monkeypatch.setattr(substrings, "BLOCK", 1)  # no two groups meet in a block by chance
    rng = random.Random(5)
    line = "".join(rng.choice("abcdef ") for _ in range(90))
    texts = ["".join(rng.choice("ghijk") for _ in range(40)) + line + "".join(rng.choice("xyz") for _ in range(40)) for _ in range(30)]
    cuts = [t[at : at + 100] for t in texts for at in (33, 36)]  # texts of one window
    rows = list(enumerate(rng.sample(texts + cuts, 90)))
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 100)
    got = [(r.row.doc_id, r.n_bytes, hashlib.sha256(r.kept).hexdigest(), len(r.spans) // 2) for r in out.collect()]
    assert _by_row(got) == _by_row(_brute_repeats(rows, 100))


def test_interval_expansion():
    rng = random.Random(1)
    for _ in range(30):
        raw = bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 200))) + b"\xff"
        text = np.frombuffer(raw, dtype=np.uint8)
        for length in (1, 2, 5):
            order = substrings.bounded_suffix_array(text, len(raw))
            got = substrings.interval_expansion(text, order, length)
            want = [False] + [raw[a : a + length] == raw[b : b + length] and max(a, b) + length <= len(raw) for a, b in zip(order[:-1], order[1:])]
            assert got.tolist() == want


# --- 8: decontamination ---------------------------------------------------------------------------


def test_decontamination(spark, docs, empty):
    texts = _texts()
    items = [(1, " ".join(texts[3].split(" ")[:14])), (22, "alpha"), (3, None), (4, ""), (5, "one"), (None, "x"), (6, texts[7]), (6, texts[7])]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def words(t):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))

    windows = {}
    for i, t in items:
        w = words(t)
        for at in range(max(1, len(w) - 9) if w and i is not None else 0):
            windows.setdefault(tuple(w[at : at + 10]), set()).add(str(i))
    want = []
    for i, t, *_ in _rows(texts):
        w, hit, found = words(t), set(), set()
        for p, names in windows.items():
            for s in range(len(w) - len(p) + 1):
                if tuple(w[s : s + len(p)]) == p:
                    hit |= set(range(s, s + len(p)))
                    found |= names
        want.append((i, len(w), len(hit), sorted(found)))
    for block in (8 << 20, 200):  # in one block, and in several
        out = decontaminate.find(docs, bench, block_bytes=block, shard_bytes=3000).collect()
        got = [(r.row.doc_id, r.n_words, sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])), r["items"]) for r in out]
        assert _by_row(got) == _by_row(want)
    cleaned = decontaminate.find(docs, bench, clean=True).where("size(spans) = 1").collect()
    assert all(r.text is not None for r in cleaned)
    assert decontaminate.without("Keep this, drop that. end", [2, 4]) == "Keep this, . end"
    assert decontaminate.find(empty, bench).count() == 0 and decontaminate.find(docs, bench.where("false")).where("size(spans) > 0").count() == 0


# --- 3: shards ------------------------------------------------------------------------------------


def test_shards(spark, docs, empty):
    for limit in (200, 3000, 10**6):
        got = sharding.assign(docs, limit).collect()
        assert len(got) == len(_rows(_texts()))
        shards = {}
        for r in got:
            shards.setdefault(r.shard, []).append(r)
        for name, rows in shards.items():
            total = sum(r.n_bytes for r in rows)
            assert {r.shard_bytes for r in rows} == {total} and {r.depth for r in rows} == {len(name)}
            assert total <= limit or len(rows) == 1
            assert not any(other != name and other.startswith(name) for other in shards)
            if name:  # only what was too large was split
                assert sum(r.n_bytes for r in got if r.shard.startswith(name[:-1])) > limit
    copies = spark.createDataFrame([(1, "x" * 50)] * 30, "doc_id long, text string")
    assert max(r.shard_bytes for r in sharding.assign(copies, 100).collect()) <= 100
    assert sharding.assign(empty, 100).count() == 0


def test_written_shards(spark, docs, empty):
    """The files hold every row once, in the shards of ``assign``; repeated rows are split to keep the limit."""
    def written(table, limit):
        path = scratch_path(spark, "shards")
        sharding.write_shards(table, limit, path)
        return sharding.read_shards(table, path).collect()

    for limit in (3000, 10**6):
        key = lambda x: tuple(map(repr, x))
        want = sorted(((r.id, r.n_bytes, r.shard, r.depth, r.shard_bytes) for r in sharding.assign(docs, limit).collect()), key=key)
        assert sorted(((r.row.doc_id, r.n_bytes, r.shard, r.depth, r.shard_bytes) for r in written(docs, limit)), key=key) == want
    copies = spark.createDataFrame([(1, "x" * 50, 7, "s")] * 30, "doc_id long, text string, rid int, shard string")
    got = written(copies, 100)
    assert len(got) == 30 and {(r.row.rid, r.row.shard, r.text) for r in got} == {(7, "s", "x" * 50)}
    assert max(r.shard_bytes for r in got) <= 100
    assert written(empty, 100) == []


# --- 1: nearest neighbours ------------------------------------------------------------------------


def test_nearest(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 16))
    x[50:60] = x[40]
    rows = [(int(i), [float(z) for z in v], "x") for i, v in enumerate(x)]
    bad = [(1000, None, "x"), (1020, [0.0] * 16, "x"), (1040, [None] + [1.0] * 15, "x"), (1060, [float("nan")] * 16, "x"), (None, [1.0] * 16, "x"), (1080, [], "x"), rows[3]]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score string")
    got = {}
    for r in multiindex.nearest(table, F.col("id") % 20 == 0, k=20, target=0.99).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    assert sorted(got) == list(range(0, 600, 20))
    hits = 0
    for q, found in got.items():
        s = x @ x[q]
        best = [i for i in sorted(range(600), key=lambda i: (-round(float(s[i]), 9), i)) if i != q][:20]
        hits += len(set(best) & {i for _, i, _ in found})
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and all(abs(s[i] - z) < 1e-9 for _, i, z in found)
    assert hits >= 0.9 * 20 * len(got)
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>, score string")
    assert multiindex.nearest(few, F.col("id") == 0, k=20).count() == 2
    assert multiindex.nearest(few.where("false"), F.col("id") == 0).count() == 0


def test_centroids_grow_and_few_entries_are_visited(spark):
    """6,000 clustered vectors: recall against brute force, and how many entries a query visits."""
    assert [multiindex.centroids_for(n) for n in (0, 1000, 2000, 50_000, 10**9)] == [32, 32, 45, 224, 256]
    rng = np.random.default_rng(5)
    n = 6000
    x = rng.normal(size=(60, 24))[rng.integers(0, 60, n)] + 0.4 * rng.normal(size=(n, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    vectors = multiindex.usable(table, "vec_id", "embedding")
    centers = multiindex.fit(vectors, multiindex.centroids_for(n))
    assert centers.shape == (2, 78, 12)
    indexed = multiindex.index(vectors, centers)
    count = np.zeros((78, 78), dtype=np.int64)
    for r in indexed.groupBy("c1", "c2").count().collect():
        count[r.c1, r.c2] = r["count"]
    assert multiindex.calibrate(indexed, centers, count, 20, 0.97) < n / 4
    got = {}
    for r in multiindex.nearest(table, F.col("id") % 20 == 0, k=20).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    hits = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(found & set(np.argsort(-s)[:20].tolist()))
        assert len(found) == 20
    assert len(got) == n // 20 and hits >= 0.9 * 20 * len(got)


def test_multi_sequence_order():
    rng = np.random.default_rng(1)
    a, b, n = rng.normal(size=7), rng.normal(size=7), rng.integers(0, 3, size=(7, 7))
    got = multiindex.visit(a, b, n, 10**9)
    assert sorted(got) == sorted((i, j) for i in range(7) for j in range(7) if n[i, j])
    assert (np.diff([a[i] + b[j] for i, j in got]) >= -1e-12).all()


# --- 2: toxicity ----------------------------------------------------------------------------------


def test_toxicity(spark, empty):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        w = [rng.choice("lorem ipsum dolor sit amet elit sed eiusmod tempor".split()) for _ in range(30)]
        toxic = rng.random() < 0.15
        if toxic:
            w[rng.randrange(30)] = rng.choice(("vilefoo", "vilebar"))
        rows.append((i, " ".join(w), None, None, "r", 1))
        if rng.random() < 0.5:
            labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame([*rows, (None, "vilefoo", None, None, None, None), (9000, None, None, None, None, None), (9001, "", None, None, None, None), rows[0]], SCHEMA)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None), (77777, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train_on_labels(docs, marks)
    got = toxicity.score(docs, model).select("row.doc_id", "text", "score").collect()
    assert len(got) == len(rows) + 4
    held = [r for r in got if r.doc_id is not None and r.doc_id < 1500 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == ("vile" in r.text) for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and all(r.score < 0.5 for r in got if not r.text)
    assert toxicity.score(empty, model).count() == 0
    nothing = toxicity.train_on_labels(docs, marks.where("false"))
    assert {round(r.score, 6) for r in toxicity.score(docs, nothing).collect()} == {0.1}


# --- 5: licences ----------------------------------------------------------------------------------


def test_licences(spark):
    rng = random.Random(6)
    lines = {"Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "All rights reserved.": "all-rights-reserved", "Licensed under the Apache License, Version 2.0": "apache-2.0"}
    rows, want = [], {}
    for i in range(300):
        body = ["".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(2, 8))) for _ in range(30)]
        line = rng.choice(list(lines)) if i % 6 == 0 else None
        rows.append((i, " ".join(body[:15]) + "\n" + (line + "\n" if line else "") + " ".join(body[15:]), None, None, "r", 1))
        want[i] = [(1, lines[line])] if line else []
    docs = spark.createDataFrame([*rows, (None, None, None, None, None, None), (900, "", None, None, None, None), (901, "\n\n", None, None, None, None), rows[0]], SCHEMA)
    got = licences.scan(docs).collect()
    assert len(got) == len(rows) + 4
    for r in got:
        assert [(x.para, x.family) for x in r.licences] == want.get(r.row.doc_id, [])
    plan = licences.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_finer_entries_leave_out_their_own_chunk(spark):
    """Unrelated signatures that share one entry: no finer group holds nearly all of them, and a pair within the
    signature distance shares at least one."""
    rng = np.random.default_rng(2)
    n = 600
    sig = rng.integers(0, 1 << 16, (n, neardup.PLACES)).astype(np.uint16)
    sig[:, : neardup.WIDTH] = sig[0, : neardup.WIDTH]  # the first chunk is the same in all
    far = rng.choice(np.arange(neardup.WIDTH, neardup.PLACES), neardup.REACH, replace=False)
    sig[1] = sig[0]
    sig[1, far] += 1
    key = int(neardup.entries(sig[:1])[0, 0])
    reps = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sig)], "id long, sig binary")
    members = spark.createDataFrame([(key, 0, i, i) for i in range(n)], "key long, slot int, id long, comp long")
    fine = neardup._refined(members, reps)
    assert max(r["count"] for r in fine.groupBy("key").count().collect()) <= 3
    assert fine.where("id < 2").groupBy("key").count().where("count > 1").count() > 0
    first = [int(x) for x in neardup._first_slot(sig[:1], sig[1:2], neardup.FINE, np.zeros(1, np.int64))]
    assert {r.fine for r in fine.where("id < 2").groupBy("key", "fine").count().where("count > 1").collect()} >= set(first) and first[0] >= len(neardup._choices(neardup.WIDTH, neardup.FINE))


def test_licences_of_repeated_rows_are_those_of_one(spark):
    """Ten equal rows against one: the same lines, families and probabilities."""
    texts = ["plain words here\nthis is licensed under a version of the public software", "Released under the MIT License.", "nothing at all\nof note", "Distributed under the ISC License."]
    filler = [(100 + i, f"some ordinary line number {i}\nand another one of {i * 7} words") for i in range(60)]
    once = spark.createDataFrame(list(enumerate(texts)) + filler, "doc_id long, text string")
    many = spark.createDataFrame(list(enumerate(texts)) * 10 + filler, "doc_id long, text string").repartition(4)
    found = lambda df: {(r.row.doc_id, tuple((x.para, x.family, round(x.prob, 9)) for x in r.licences)) for r in licences.scan(df).collect() if r.row.doc_id < 100}
    assert found(once) == found(many)
