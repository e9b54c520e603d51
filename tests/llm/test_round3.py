"""Operators 11 to 13 against brute force, on tables that hold the awkward cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import collocations, languages, negatives

# --- 11: languages ------------------------------------------------------------------------------------

SOUNDS = {"aa": "lo mi ra ne tu", "bb": "kz xw zzk qv wx", "cc": "ша жо щи ря ёк"}
DOC_SCHEMA = "doc_id long, text string, lang string, score double, row string, place int"


def _made(lang, n, rng):
    return " ".join("".join(rng.choice(SOUNDS[lang].split()) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def _language_rows():
    rng = random.Random(5)
    rows = [(i, _made(lang, rng.choice((8, 60)), rng), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(1000 + i, t, lang) for i, (t, lang) in enumerate([("", "aa"), (None, "bb"), ("12 345 !?", "cc"), (_made("aa", 40, rng).upper(), "aa"), (_made("cc", 3000, rng), "cc"), ("漢字だけ", None)])]
    rows += [(None, _made("bb", 30, rng), "bb"), rows[4], rows[4], (7, "lo lo", None)]
    return [(i, t, lang, 0.5, "r", 3) for i, t, lang in rows]


def test_languages(spark, monkeypatch):
    rows = _language_rows()
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)
    model = languages.train(docs)
    assert model.languages == ["aa", "bb", "cc"]
    got = languages.predict(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.id: r for r in got}
    for i, text, lang, *_ in rows:
        if not re.search(r"[^\W\d_]", text or ""):
            assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0)
        elif lang and i != 7:
            assert by_id[i].lang_pred == lang
    # slices of a long text give what the whole gives
    whole = model.scorer()([r[1] for r in rows if r[1]])
    monkeypatch.setattr(languages, "SLICE", 50)
    assert np.allclose(model.scorer()([r[1] for r in rows if r[1]]), whole, atol=1e-5)


def test_language_kernel_is_shared_n_grams(spark):
    """Kernel values against sets of n-grams, texts beside one another and alone."""
    model = languages.train(spark.createDataFrame(_language_rows(), DOC_SCHEMA))
    p = languages.Presence(model.grams)
    texts = ["lo mi", "Ramilo, kz!", "x", "ша жо"]
    rows = languages._joined(p, texts)
    known, cls = {int(c) for c in model.grams.codes}, model.grams.classes()
    base = model.grams.base
    for t, row in zip(texts, rows):
        c = [0, 0, *(int(cls[ord(x)]) for x in t.lower()), 0, 0]
        want = set()
        for n, start in ((1, 0), (2, base), (3, base + base**2)):
            for i in range(len(c) - n + 1):
                code = 0
                for x in c[i : i + n]:
                    code = code * base + x
                if any(c[i : i + n]):
                    want.add(start + code)
        assert {int(model.grams.codes[i]) for i in np.flatnonzero(row)} == want & known


def test_languages_nothing_to_learn(spark):
    none = spark.createDataFrame([], DOC_SCHEMA)
    assert languages.train(none) is None and languages.predict(none, None).count() == 0
    docs = spark.createDataFrame([(1, "some text", None, 0.1, "r", 1), (None, "text", "aa", 0.1, "r", 1)], DOC_SCHEMA)
    assert languages.train(docs) is None
    assert [(r.lang_pred, r.score) for r in languages.predict(docs, None).collect()] == [("und", 0.0)] * 2
    alone = spark.createDataFrame([(i, "lo mi ra", "aa", 0.1, "r", 1) for i in range(8)], DOC_SCHEMA)
    assert {r.lang_pred for r in languages.predict(alone, languages.train(alone)).collect()} == {"aa"}


def test_language_fold_is_never_learned(spark):
    """A language that stands only in the held-out fold is unknown to the model."""
    ids = [r.id for r in spark.range(400).where(languages.held_out("id")).collect()]
    rows = [(i, "kz xw zzk" if i in set(ids) else "lo mi ra", "bb" if i in set(ids) else "aa", 0.1, "r", 1) for i in range(400)]
    assert len(ids) > 50 and languages.train(spark.createDataFrame(rows, DOC_SCHEMA)).languages == ["aa"]


# --- 12: collocations ------------------------------------------------------------------------------------


def _brute_collocations(rows, support, top):
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", folded):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in range(1, 6):
                for i in range(len(w) - size + 1):
                    count[lang, tuple(w[i : i + size])] += 1
    often = {k: n for k, n in count.items() if len(k[1]) > 1 and n >= support}
    out = {}
    for (lang, w), a in often.items():
        if any(x == lang and len(v) > len(w) and 100 * n >= 100 * a and any(v[i : i + len(w)] == w for i in range(len(v))) for (x, v), n in often.items()):
            continue
        n = total[lang]
        score, _, left, right = min((1000 * a * n // (count[lang, w[:k]] * count[lang, w[k:]]), k, count[lang, w[:k]], count[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right, n))
    return {(lang, i + 1, p.decode(), -a, left, right, n, -s) for lang, found in out.items() for i, (s, a, p, left, right, n) in enumerate(sorted(found)[:top])}


TEXT_SCHEMA = "text string, lang string, phrase string, n long, total long"


def _phrase_rows():
    rng = random.Random(3)
    words = ["the", "of", "New", "york", "city", "é", "über", "a-b", "x\xa0y", "z'"]
    rows = []
    for _ in range(120):
        t = "".join(rng.choice(["New York city ", "of the ", "\t", "a a a a a a ", rng.choice(words) + " ", rng.choice(words) + rng.choice([",", ".\n", "! ", " ; ", "\r\n", "\x0b", " "])]) for _ in range(rng.randrange(30)))
        rows.append((t, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [rows[0]] * 9 + [("", "en"), (None, "en"), (None, None), ("...", "xx"), ("word " * 700, "long"), ("lone", "one")]


@pytest.mark.parametrize(("shard", "bits", "parts", "top"), [(1 << 20, 27, 1, 2000), (400, 27, 5, 2000), (60, 27, 7, 6), (2000, 6, 3, 2000)])
def test_collocations(spark, monkeypatch, shard, bits, parts, top):
    """Whole in one shard, in many, in shards of a text each, and with a bitmap in which most bits are set; sums
    that are sent at once, and that are held."""
    monkeypatch.setattr(collocations, "SUMS", 1 << 20 if parts == 1 else 10)
    monkeypatch.setattr(collocations, "TASK_BYTES", 3 * shard)
    rows = _phrase_rows()
    docs = spark.createDataFrame([(t, lang, "p", 1, 2) for t, lang in rows], TEXT_SCHEMA).repartition(parts)
    got = collocations.collocations(docs, support=7, top=top, shard_bytes=shard, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = _brute_collocations(rows, 7, top)
    assert len(want) > 10 and {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize(("shard", "parts", "again"), [(1 << 20, 1, False), (400, 5, True)])
def test_collocations_known_after_mining(spark, monkeypatch, shard, parts, again):
    """Counting tasks sent every phrase once more, also those that every shard had reported with its count."""
    seen = spark.sparkContext.accumulator(0)
    flushed = collocations._flushed

    def noted(sums):
        seen.add(sum(map(len, sums.values())))
        return flushed(sums)

    monkeypatch.setattr(collocations, "_flushed", noted)
    monkeypatch.setattr(collocations, "TASK_BYTES", shard)
    rows = [("a b c d. " * 50 + "x y. " * k, "en") for k in (0, 9, 0, 9, 1)]
    docs = spark.createDataFrame([(t, lang) for t, lang in rows], "text string, lang string").repartition(parts)
    n, f = collocations.frequent_phrases(docs, 15, shard)
    assert {(r.phrase, r.f) for r in f.collect()} >= {("a b c d", 250), ("x y", 19), ("d", 250)} and n.first().n == 5 * 200 + 2 * 19
    # of 13 phrases, the 10 of a to d are known: at most x, y and "x y" are sent, by a task that holds them
    assert (0 < seen.value <= 3 * 3) if again else seen.value == 0


def test_collocations_wide_products(spark):
    """Scores of counts whose products pass 64 bits are floored exactly."""
    a, n, left, right = 3_000_000_007, 9_000_000_000_000_003, 5_000_000_029, 4_000_000_007
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert row.select(collocations.exact_score("a", "n", "l", "r", 1000)).first()[0] == 1000 * a * n // (left * right)


def test_collocations_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], TEXT_SCHEMA)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None, "p", 1, 2), ("", "en", "p", 1, 2)], TEXT_SCHEMA)).count() == 0


# --- 13: hard negatives ------------------------------------------------------------------------------------


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (17, 64, 33), (40, 31, 129), (64, 0, 20), (33, 17, 18)])
def test_strassen(shape):
    rng = np.random.default_rng(1)
    p, d, q = shape
    a, b = rng.integers(-(2**28), 2**28, (p, d)), rng.integers(-(2**28), 2**28, (d, q))
    assert np.array_equal(negatives.strassen(a, b, leaf=4), a @ b)


def _brute_negatives(rows, every=3):
    used = []
    for i, label, v, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        used.append((i, label, tuple(int(np.floor(256 * np.float64(x))) for x in v)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for i, label, v in {u for u in used if u[0] % every == 0}:
        best = sorted({(-dot(v, w), j) for j, other, w in used if other == label and j != i})[:5]
        for minus, pos in best:
            p = -minus
            fit = sorted({(-dot(v, w), j) for j, other, w in used if other != label and j != i and 30 * p <= 100 * dot(v, w) <= 90 * p})[:10]
            out |= {(i, pos, r + 1, j, p, -s) for r, (s, j) in enumerate(fit)}
    return out


VEC_SCHEMA = "vec_id long, label int, embedding array<float>, id long, v string, rank int, score double"


def _vector_rows():
    rng = np.random.default_rng(4)
    rows = [(int(i), int(rng.integers(4)), rng.normal(0, 0.3, 6).round(2 if i % 2 else 1).tolist()) for i in range(150)]
    one = [0.5, 0.25, -0.5, 0.125, 0.0, 0.75]
    rows += [(200 + i, i % 3, one) for i in range(60)]  # copies: ties everywhere
    rows += [rows[3], rows[3], (3, 1, rows[5][2]), (300, None, one), (301, 1, None), (303, 2, [0.1, None, 0.3, 0.0, 0.0, 0.0]), (306, 2, [float("nan")] * 6), (309, 1, [float("inf")] + one[1:])]
    rows += [(None, 1, one), (312, 0, [0.0] * 6), (315, 1, []), (318, 2, [0.5, 0.5]), (-3, 1, one)]
    return [(i, label, v, 9, "v", 1, 0.5) for i, label, v in rows]


@pytest.mark.parametrize(("tile", "numbers"), [(4096, 1 << 20), (7, 60)])
def test_negatives(spark, monkeypatch, tile, numbers):
    """In one round and one tile, and in many rounds of small tiles."""
    rows = _vector_rows()
    monkeypatch.setattr(negatives, "TILE", tile)
    table = spark.createDataFrame(rows, VEC_SCHEMA).repartition(4)
    got = negatives.mine(table, F.col("id") % 3 == 0, F.col("label"), anchor_numbers=numbers)
    want = _brute_negatives(rows)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == sorted(want)


def test_negatives_empty(spark):
    none = spark.createDataFrame([], VEC_SCHEMA)
    assert negatives.mine(none, F.col("id") % 3 == 0, F.col("label")).count() == 0
    lone = spark.createDataFrame([(0, 1, [1.0], 1, "v", 1, 0.1)], VEC_SCHEMA)
    assert negatives.mine(lone, F.col("id") % 3 == 0, F.col("label")).count() == 0
    vast = spark.createDataFrame([(i, i % 2, [1e30 * (i - 2), 1.0], 1, "v", 1, 0.1) for i in range(6)], VEC_SCHEMA)
    negatives.mine(vast, F.col("id") % 3 == 0, F.col("label")).collect()  # wraps, but does not crash


def test_toxic_features_are_counted_over_all_texts(spark):
    """Words rare within the fitted sample are features if the whole corpus holds them often enough."""
    import zlib

    from ledgerline.llm import toxicity

    words = [f"vile{chr(97 + k)}" for k in range(8)]
    rows = [(i, f"plain words here {words[i % 8]}" if i < 400 else f"plain words here and there {i}") for i in range(2000)]
    docs = spark.createDataFrame([*rows, (None, "vilea"), (5000, None)], "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame([(i,) for i in range(400)], "doc_id long")
    model = toxicity.train(docs, marks, 0.2, max_positive=16, max_unlabelled=60)
    assert {1 << 32 | zlib.crc32(b"=" + w.encode()) for w in words} <= set(model.index)
    assert toxicity.train(docs, marks.limit(0), 0.2).index == {}
