"""Operator 12: phrase collocations, mined by SON partitioning.

Texts are dealt by language into shards of about ``SHARD_BYTES``, so that a language has as few as can be: what a shard may leave
out grows with its share. A shard that holds the share b / B of its language's bytes is mined completely (level by level, as in Apriori) at the local support
t = ceil(``support`` * b / B). The shares add up to one, so a phrase that reaches the support in all reaches the
local one in some shard. Where it does not, it occurs t - 1 times at most: the local counts of a phrase and these bounds
for the other shards say whether it can reach the support at all. If no other shard leaves a bound, as all that may hold it
have reported it, its count is known and it is not counted again. The others that can reach the support are kept as a bitmap of fixed size;
phrases of one bit only make it a superset. A second pass counts in every shard each phrase that the bitmap
holds, and the counts are summed: they are exact.

Within a shard, words are numbers and a phrase of j words is the pair (its first j - 1 words, its last word), so equal
numbers mean equal phrases. Scores are decimals of 38 digits, divided without rounding.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

SHARD_BYTES = 64 << 20  # of mining; several smaller languages share one
COUNT_BYTES = 40 << 20  # of counting, of all languages as they come
TASK_BYTES = 256 << 20  # text that a counting task reads, shard by shard, summing before the shuffle
SUMS = 1 << 20  # distinct phrases that it holds at once
MAX_WORDS = 5
FEW = 10_000  # languages
BITS = 27  # the bitmap has 2**BITS bits: 16 MiB
_AT_ONCE = 1 << 21  # places whose phrases are sorted at once
_CHUNK = 1 << 15  # bits of one row of Spark's bitmap functions

_BREAK = b"\xff"  # no byte of UTF-8
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz " + b"\xff" * 10)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Shard:
    """The words of some texts of one language as numbers, -1 between pieces."""

    def __init__(self):
        self.number: dict[bytes, int] = {_BREAK: -1}
        self.parts: list[np.ndarray] = []
        self.n_bytes = 0

    def add(self, text: bytes) -> None:
        # words are what stands between spaces; a break stands alone
        number, words = self.number, text.translate(_FOLD).replace(_BREAK, b" \xff ").split(b" ")
        ids = np.empty(len(words) + 1, dtype=np.int32)
        n = 0
        for w in words:
            if w:
                i = number.get(w)
                if i is None:
                    i = number[w] = len(number) - 1
                ids[n] = i
                n += 1
        ids[n] = -1
        self.parts.append(ids[: n + 1].copy())
        self.n_bytes += len(text)

    def close(self) -> tuple[np.ndarray, list[bytes]]:
        """(numbers, words by number); the shard itself is emptied."""
        ids, words = np.concatenate(self.parts), list(self.number)[1:]
        self.parts, self.number = [], {}
        return ids, words


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _STEP
    return h ^ (h >> np.uint64(29))


def phrases(ids: np.ndarray, word_hash: np.ndarray, keep, max_words: int = MAX_WORDS):
    """Per length j, in parts: (first positions, counts, hashes) of the distinct phrases of j words that ``keep`` (counts,
    hashes -> mask) keeps; only phrases whose first and last j - 1 words are kept are looked at. About ``_AT_ONCE`` places are
    sorted at a time, those whose first j - 1 words are the same never apart."""
    number = np.full(int(ids.max(initial=-1)) + 2, -1, dtype=np.int32)  # of a kept word; the last is that of a break
    code = np.full(len(ids) + 1, -1, dtype=np.int32)  # of the phrase of j - 1 words that starts here
    at, n_words = np.flatnonzero(ids >= 0).astype(np.int32), 0
    for j in range(1, max_words + 1):
        if j > 1:
            at = at[at < len(ids) - j + 1]
            at = at[(code[at] >= 0) & (code[at + 1] >= 0)]
        if not len(at):
            return
        longer, n_codes = np.full(len(ids) + 1, -1, dtype=np.int32), 0
        for some in _parts(code, at) if j > 1 else [at]:
            if j == 1:
                found = ids[some]
                count = np.bincount(found)
                first = np.zeros(len(count), dtype=np.int32)
                first[found[::-1]] = some[::-1]
            else:
                key = code[some].astype(np.int64) * n_words + number[ids[some + (j - 1)]]
                order = np.argsort(key, kind="stable")
                key = key[order]
                new = np.concatenate(([True], key[1:] != key[:-1]))
                del key
                found = np.empty(len(some), dtype=np.int32)
                found[order] = np.cumsum(new, dtype=np.int32) - 1
                begin = np.flatnonzero(new)
                count, first = np.diff(np.append(begin, len(some))), some[order[begin]]
                del order, new, begin
            h = np.zeros(len(count), dtype=np.uint64)
            for i in range(j):
                h = mix(h + word_hash[ids[first + i]])
            kept = keep(count, h)
            own = np.where(kept, n_codes + np.cumsum(kept) - 1, -1).astype(np.int32)
            longer[some] = own[found]
            n_codes += int(kept.sum())
            del found
            if j == 1:
                number[: len(own)], n_words = own, n_codes
            yield j, first[kept], count[kept], h[kept]
        code = longer


def _parts(code: np.ndarray, at: np.ndarray):
    """The places ``at`` in parts of about ``_AT_ONCE``, by ranges of their codes."""
    n = -(-len(at) // _AT_ONCE)
    if n == 1:
        yield at
        return
    own = code[at]
    below = np.cumsum(np.bincount(own))
    bounds = [0, *(np.searchsorted(below, np.arange(1, n) * len(at) // n) + 1).tolist(), len(below)]
    for lo, hi in zip(bounds, bounds[1:]):
        some = at[(own >= lo) & (own < hi)]
        if len(some):
            yield some


def _shards(batches, size: int):
    """(language, its bytes in all, Shard): what a task reads, cut whenever ``size`` bytes are held."""
    held: dict[str, tuple[int, Shard]] = {}
    n = 0
    for b in batches:
        for lang, total, text in zip(b["lang"].to_pylist(), b["total"].to_pylist(), b["text"]):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            if lang not in held:
                held[lang] = (total, Shard())
            held[lang][1].add(data)
            n += len(data)
            if n >= size:
                while held:
                    lang, (total, shard) = held.popitem()
                    yield lang, total, shard
                n = 0
    while held:
        lang, (total, shard) = held.popitem()
        yield lang, total, shard


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _blocks(n: int, size: int = 1 << 16):
    return (slice(at, at + size) for at in range(0, n, size))


def _dealt(source: DataFrame, totals: DataFrame, size: int) -> DataFrame:
    """``source`` (lang, total, text) in partitions of about ``size`` bytes: a large language is dealt evenly over partitions of its
    own, the others together, each in one. By chance and not by content, so that no group of copies falls into one."""
    large = totals.where(F.col("total") > size).select("lang", "total").collect()  # of all bytes / size at most
    spans, n = [], 0
    for lang, total in large:
        spans.append((lang, n, -(-total // size)))
        n += spans[-1][2]
    rest = totals.where(F.col("total") <= size).agg(F.sum("total").alias("n")).first()["n"]
    others = 0 if rest is None else max(1, -(-rest // size))
    slot = n + F.pmod(F.xxhash64("lang"), F.lit(max(1, others)))
    if spans:
        places = source.sparkSession.createDataFrame(spans, "lang string, first long, pieces long")
        source = source.join(F.broadcast(places) if len(spans) <= FEW else places, "lang", "left")
        slot = F.coalesce(F.col("first") + F.floor(F.rand(1) * F.col("pieces")), slot)
    return source.select("lang", "total", "text", slot.cast("int").alias("slot")).repartitionById(max(1, n + others), F.col("slot")).drop("slot")


def frequent_phrases(rows: DataFrame, support: int, shard_bytes: int = SHARD_BYTES, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, n), (lang, phrase, size, f)) of ``rows`` (lang, text): words in all, and every phrase of one to five
    words that occurs ``support`` times at least."""
    spark = rows.sparkSession
    totals = stored(rows.groupBy("lang").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("total")), "totals")
    all_bytes = totals.agg(F.sum("total").alias("n")).first()["n"] or 0
    # counting needs no shuffle: a task reads several shards. Few languages are broadcast, many are not
    source = rows.join(F.broadcast(totals) if totals.count() <= FEW else totals, "lang").select("lang", "total", "text")
    cut = lambda size: source.coalesce(max(1, -(-all_bytes // size)))

    def mine(batches):
        for lang, total, shard in _shards(batches, shard_bytes + shard_bytes // 4):
            least = -(-support * shard.n_bytes // max(1, total))  # of an empty shard 0: nothing to count
            ids, words = shard.close()
            bound = least - 1 if least else 0
            yield _mined(lang, [None], 0, [0], [int((ids >= 0).sum())], bound)
            for j, first, n, h in phrases(ids, _hashes(lang, words), lambda count, h: count >= least):  # noqa: B023
                for some in _blocks(len(n)):
                    yield _mined(lang, _texts(ids, words, first[some], j), j, (h[some] >> np.uint64(64 - bits)).astype(np.int32), n[some], bound)

    # what the shards that report a phrase have counted, and what the bounds of all others leave open
    mined = _dealt(source, totals, shard_bytes).mapInArrow(mine, "lang string, phrase string, size int, bit int, n long, bound long")
    mined = stored(mined.groupBy("lang", "phrase", "size", "bit").agg(F.sum("n").alias("n"), F.sum("bound").alias("bound")), "mined")
    n_words = mined.where("phrase is null").select("lang", "n", F.col("bound").alias("all_bounds"))
    found = mined.where("phrase is not null").join(n_words.drop("n"), "lang").withColumn("open", F.expr("all_bounds - bound")).where(f"n + open >= {support}")
    exact = found.where("open = 0").select("lang", "phrase", "size", F.col("n").alias("known"), F.lit(None).cast("long").alias("f"))

    def bitmap(bit: DataFrame) -> np.ndarray:
        union = bit.groupBy(F.expr(f"bit div {_CHUNK}").alias("part")).agg(F.expr(f"bitmap_construct_agg(bit % {_CHUNK})").alias("bits"))
        out = np.zeros(1 << (bits - 3), dtype=np.uint8)
        step = min(_CHUNK, 1 << bits) >> 3
        for r in union.toLocalIterator():  # 2**bits bits in all
            out[r.part * step : (r.part + 1) * step] = np.frombuffer(r.bits, dtype=np.uint8)[:step]
        return out

    to_count = bitmap(found.where("open > 0"))
    if not to_count.any():  # every shard has reported every candidate that it holds
        return n_words.select("lang", "n"), exact.select("lang", "phrase", "size", F.col("known").alias("f"))
    # a phrase is reached by its parts, so the known ones are walked too, but not sent
    sent = spark.sparkContext.broadcast((bitmap(found), to_count))

    def count(batches):
        to_walk, to_send = sent.value

        def held(bitmap, h):
            at = (h >> np.uint64(64 - bits)).astype(np.int64)
            return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

        sums: dict[tuple, Counter] = {}
        for lang, _, shard in _shards(batches, min(shard_bytes, COUNT_BYTES)):
            ids, words = shard.close()
            for j, first, n, h in phrases(ids, _hashes(lang, words), lambda count, h: held(to_walk, h)):
                own = held(to_send, h)
                first, n = first[own], n[own]
                for some in _blocks(len(first)):
                    yield from _summed(sums, (lang, j), _texts(ids, words, first[some], j), n[some].tolist())
        yield from _flushed(sums)

    counted = cut(max(shard_bytes, TASK_BYTES)).mapInArrow(count, "lang string, phrase string, size int, f long")
    # a known phrase that shares its bit with one to count is counted too, with the same result
    both = exact.unionByName(counted.select("lang", "phrase", "size", F.lit(None).cast("long").alias("known"), "f"))
    f = both.groupBy("lang", "phrase", "size").agg(F.coalesce(F.max("known"), F.sum("f")).alias("f")).where(f"f >= {support}")
    return n_words.select("lang", "n"), stored(f, "phrases")


def _texts(ids: np.ndarray, words: list[bytes], first: np.ndarray, j: int) -> list[bytes]:
    return [b" ".join([words[i] for i in p]) for p in ids[first[:, None] + np.arange(j)].tolist()]


def _mined(lang: str, phrase: list, size: int, bit, n, bound: int) -> pa.RecordBatch:
    k = len(phrase)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * k, pa.string()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array([size] * k, pa.int32()), pa.array(bit, pa.int32()), pa.array(n, pa.int64()), pa.array([bound] * k, pa.int64())],
        names=["lang", "phrase", "size", "bit", "n", "bound"],
    )


def _summed(sums: dict[tuple, Counter], key: tuple, phrase: list, n: list[int]):
    """Add counts; all sums go out once more than ``SUMS`` phrases are held."""
    held = sums.setdefault(key, Counter())
    for p, x in zip(phrase, n):
        held[p] += x
    if sum(map(len, sums.values())) > SUMS:
        yield from _flushed(sums)


def _flushed(sums: dict[tuple, Counter]):
    while sums:
        (lang, size), held = sums.popitem()
        phrase, f = list(held), list(held.values())
        for some in _blocks(len(f)):
            n = len(f[some])
            text = pa.array(phrase[some], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), text, pa.array([size] * n, pa.int32()), pa.array(f[some], pa.int64())], names=["lang", "phrase", "size", "f"])


def exact_score(a: str, n: str, left: str, right: str, scale: int) -> Column:
    """floor(scale * a * n / (left * right)) of positive counts, in decimals: products may pass 64 bits."""
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    above = (F.lit(scale).cast("decimal(10,0)") * wide(a) * wide(n)).cast("decimal(38,0)")
    below = (wide(left) * wide(right)).cast("decimal(38,0)")
    return F.call_function("div", above, below)


def collocations(
    docs: DataFrame, support: int = 100, top: int = 2000, scale: int = 1000, text_col: str = "text", lang_col: str = "lang", shard_bytes: int = SHARD_BYTES, bits: int = BITS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to five words of each language.

    A-Z are lower-cased; a text is cut into pieces at ``.,;:!?`` and line ends (\\n, \\v, \\f, \\r), a piece into words at spaces and
    tabs; phrases lie within a piece. a = f(phrase) >= ``support``; of the cuts after the first k words the one
    of lowest floor(``scale`` * a * n / (l * r)) counts (of equal ones the smallest k), with l and r the counts of
    both parts and n all words of the language. A phrase inside a longer one of equal count is dropped. Order:
    score, then a, both descending, then the phrase in byte order.

    A null language is ``und`` (as are rows that say so); a null or empty text has no words; repeated rows all
    count. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    n, f = frequent_phrases(rows, support, shard_bytes, bits)
    words = F.split("phrase", " ")
    long = f.where("size > 1")

    # one more word can only keep or lower a count: a phrase lies in a longer one of equal count if and only
    # if it lies in one that is longer by a word
    inner = F.explode(F.array(F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " ")))
    longer = f.where("size > 2").select("lang", inner.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    own = long.join(longer, ["lang", "phrase"], "left").where("most is null or most < f").drop("most")

    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = own.select("lang", "phrase", "size", F.col("f").alias("a"), k)
    cuts = cuts.withColumn("head", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")).withColumn("tail", F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " "))
    part = lambda key, value: f.select("lang", F.col("phrase").alias(key), F.col("f").alias(value))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(n, "lang")
    cuts = cuts.withColumn("score", exact_score("a", "n", "l", "r", scale))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    out = best.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = out.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
