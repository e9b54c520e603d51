"""Operator 6: suffix-array deduplication by threshold-bounded interval expansion.

A byte goes if a string of ``length`` bytes covers it that also starts earlier (in a smaller document,
or earlier in the same one). Three steps, each a Spark shuffle of what the one before kept:

1. *Fingerprints.* Every window of ``length`` bytes is represented by the smallest hash among its
   ``GRAM``-byte strings; neighbouring windows mostly share it, so a text is cut into runs of windows
   (about one per 35 bytes). Equal windows have equal fingerprints: only runs whose fingerprint
   occurs again matter. Runs that are equal as a whole are collapsed here to the earliest one.
2. *Common prefixes.* Runs that share a fingerprint but differ are fetched as bytes and indexed block
   by block: a suffix array bounded by the threshold, its Burrows-Wheeler transform, and breadth-first
   backward extension of intervals, which sets the common prefix of neighbouring suffixes in order of
   increasing value. It stops at ``length``: boundaries then still unset separate suffixes with that
   many bytes in common, and of each such class all but the earliest window are marked.
3. *Removal.* The marks of a document are merged and cut out.

Fingerprints of very many different runs are found in a small sample and dealt window by window, large groups are dealt
by the windows' own hashes, and equal runs of a task are collapsed before the shuffle; these measures
only decide where rows go, never what is compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import LAST, packed, runs, slices, stored

GRAM = 32
SLICE = 1 << 20  # bytes of text that one vector step handles
BLOCK = 1 << 18  # bytes of one suffix array: its columns then stay in the cache
SAMPLE, FREQUENT = 4000, 12  # documents sampled, and different runs there that make a fingerprint frequent
GROUP, CELL = 4096, 256  # different runs of a group from which it is dealt by window; windows aimed at per cell
_END = 255  # never a byte of UTF-8

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the published constants of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_LETTER = _mix(np.arange(1, 257, dtype=np.uint64) * _BASE) | _U(1)


def _hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all strings of ``size`` bytes, by doubling."""
    out, have, power = _LETTER[raw], 1, np.array([_BASE])  # an array: its products wrap without a warning
    whole, covered = None, 0
    while True:
        if size & have:  # append this power of two to what is covered
            if whole is None:
                whole, covered = out, have
            else:
                n = len(raw) - covered - have + 1
                scale = _U(pow(int(_BASE), have, 1 << 64))
                whole, covered = whole[:n] * scale + out[covered : covered + n], covered + have
        if have * 2 > size:
            return _mix(whole)
        out = out[:-have] * power + out[have:]
        power = power * power
        have *= 2


def _window_minima(h: np.ndarray, size: int) -> np.ndarray:
    """Position of the smallest hash in each window of ``size`` (leftmost of equals)."""
    at = np.arange(len(h), dtype=np.uint64)
    low = (h & ~_U(0xFFFFFF)) | at  # positions take 24 bits, hashes the other 40
    have = 1
    while have * 2 <= size:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < size:
        low = np.minimum(low[: len(h) - size + 1], low[size - have :])
    return (low & _U(0xFFFFFF)).astype(np.int64)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        base = 0xD6E8FEB86659FD93
        inverse = pow(base, -1, 1 << 64)
        _POWERS[:] = [np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, b, dtype=np.uint64)))) for b in (base, inverse)]
    return _POWERS[0], _POWERS[1]


def fingerprint_runs(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int):
    """Runs of windows of some strings [begin, end) of ``raw``, none reaching across: arrays
    (string, start relative to it, windows, fingerprint, hash of the run's bytes)."""
    empty = np.empty(0, np.int64)
    span = length - GRAM + 1
    if len(raw) < length:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    h = _hashes(raw, GRAM)
    low = _window_minima(h, span)
    owner = np.repeat(np.arange(len(begin)), end - begin)[: len(low)]
    ok = np.arange(len(low)) + length <= end[owner]
    new = ok.copy()
    new[1:] &= ~((low[1:] == low[:-1]) & ok[:-1] & (owner[1:] == owner[:-1]))
    start = np.flatnonzero(new)
    stop = np.flatnonzero(ok & np.concatenate((new[1:] | ~ok[1:], [True]))) + 1
    up, down = _powers(len(raw) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LETTER[raw] * up[: len(raw)])))
    text = _mix((total[stop + length - 1] - total[start]) * down[start] + (stop - start).astype(np.uint64))
    who = owner[start]
    return who, start - begin[who], stop - start, h[low[start]], text


def _later(key, ctx, o, rid, start):
    """(order, later, first of its key and text) with rows sorted by all columns: a row is later if an
    equal run starts earlier, that is, in a smaller document or earlier in the same row."""
    order = np.lexsort((start, rid, o, ctx, key))
    if not len(order):
        return order, np.zeros(0, bool)
    k, c, o, r = key[order], ctx[order], o[order], rid[order]
    new = np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])))
    lowest = o[new][np.cumsum(new) - 1]
    again = np.concatenate(([False], (o[1:] == o[:-1]) & (r[1:] == r[:-1]))) & ~new
    return order, (o != lowest) | again


def _texts(batch, length: int):
    """Slices of texts as (row, offset, bytes): a long text in overlapping slices of ``SLICE`` windows."""
    for row, t in enumerate(batch.to_pylist()):
        raw = (t or "").encode("utf-8", "surrogatepass")
        for at in range(0, max(1, len(raw) - length + 1), SLICE):
            yield row, at, raw[at : at + SLICE + length - 1]


def _fingerprints(docs: DataFrame, length: int, frequent) -> DataFrame:
    """(key, ctx, o, rid, start, windows, single) of every run; a run that a run of the same batch makes needless
    has a negative number of windows and a key of its own. ``single`` marks a window of a frequent
    fingerprint, whose key is already its own."""

    def run(batches):
        hot = np.array(sorted(frequent.value), dtype=np.uint64) if frequent else np.empty(0, np.uint64)
        for b in batches:
            got = []
            for group in runs(_texts(b["text"], length), lambda x: len(x[2]), SLICE):
                raw = np.frombuffer(b"".join(x[2] for x in group), dtype=np.uint8)
                size = np.array([len(x[2]) for x in group], dtype=np.int64)
                end = np.cumsum(size)
                begin = end - size
                who, start, windows, key, ctx = fingerprint_runs(raw, begin, end, length)
                single = np.zeros(len(key), bool)
                if len(hot):
                    busy = np.isin(key, hot)
                    if busy.any():  # each window of such a run on its own, dealt by its own hash
                        n = windows[busy]
                        w = np.repeat(who[busy], n)
                        at = np.repeat(start[busy] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                        own = _window_hashes(raw, begin[w] + at, length)
                        key = np.concatenate([key[~busy], _mix(np.repeat(key[busy], n) * _BASE + (own >> _U(40)))])
                        who, start, ctx = (np.concatenate([x[~busy], y]) for x, y in ((who, w), (start, at), (ctx, own)))
                        windows = np.concatenate([windows[~busy], np.ones(len(w), np.int64)])
                        single = np.concatenate([single[~busy], np.ones(len(w), bool)])
                rows = np.array([x[0] for x in group], dtype=np.int64)
                offset = np.array([x[1] for x in group], dtype=np.int64)
                got.append((rows[who], start + offset[who], windows, key, ctx, single))
            if not got:
                continue
            row, start, windows, key, ctx, single = (np.concatenate(x) for x in zip(*got))
            o, rid = b["o"].to_numpy()[row], b["rid"].to_numpy()[row]
            order, later = _later(key, ctx, o, rid, start)
            o, rid, start, windows, key, ctx, single = (x[order] for x in (o, rid, start, windows, key, ctx, single))
            own = _mix(rid.view(np.uint64) * _BASE + start.astype(np.uint64))
            key, windows = np.where(later, own, key), np.where(later, -windows, windows)
            for at in range(0, len(key), 100_000):
                cut = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(x[cut]) for x in (key.view(np.int64), ctx.view(np.int64), o, rid, start, windows.astype(np.int32), single)], names=["key", "ctx", "o", "rid", "start", "windows", "single"])

    return docs.select("o", "rid", "text").mapInArrow(run, "key long, ctx long, o long, rid long, start long, windows int, single boolean")


def _window_hashes(raw: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    up, down = _powers(len(raw) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LETTER[raw] * up[: len(raw)])))
    return _mix((total[at + length] - total[at]) * down[at] + _U(1))


def _whole_groups(batches, columns: list[str], by: str = "key"):
    """Tables of whole groups from batches sorted by ``by`` (a group is held until its end is seen)."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b]).select(columns)
        t = t if held is None else pa.concat_tables([held, t])
        k = t[by].to_numpy()
        cut = np.flatnonzero(k[1:] != k[:-1])
        last = int(cut[-1]) + 1 if len(cut) else 0
        held = t.slice(last)
        if last:
            yield t.slice(0, last)
    if held is not None and held.num_rows:
        yield held


def _shared_runs(found: DataFrame) -> DataFrame:
    """What recurs: ``group`` 0 marks a run that an earlier equal one makes needless; other rows are the
    earliest of each of several different runs with one fingerprint, ``group`` being their number."""
    cols = ["key", "ctx", "o", "rid", "start", "windows", "single"]
    dealt = found.repartition("key").sortWithinPartitions("key")

    def run(batches):
        for t in _whole_groups(batches, cols):
            key, ctx, o, rid, start, windows, single = (t[c].to_numpy() for c in cols)
            again = np.concatenate(([False], key[1:] == key[:-1]))
            again[:-1] |= again[1:]
            again |= windows < 0
            key, ctx, o, rid, start, windows, single = (x[again] for x in (key, ctx, o, rid, start, windows, single))
            if not len(key):
                continue
            order, later = _later(key, ctx, o, rid, start)
            key, o, rid, start, windows, single = (x[order] for x in (key, o, rid, start, windows, single))
            later |= windows < 0
            number = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))) - 1
            n = np.bincount(number, weights=~later).astype(np.int64)[number]
            keep = later | (n > 1)
            out = (key, o, rid, start, np.abs(windows), np.where(later, 0, n), single)
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in out], names=["key", "o", "rid", "start", "windows", "group", "single"])

    return dealt.mapInArrow(run, "key long, o long, rid long, start long, windows int, group long, single boolean")


def _zipped(docs: DataFrame) -> DataFrame:
    """The texts compressed, for a shuffle."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for b in slices(batches):
            data = [pack.compress((t or "").encode("utf-8", "surrogatepass")) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary()) if f.name == "text" else b[f.name] for f in b.schema], names=b.schema.names)

    fields = [T.StructField(f.name, T.BinaryType() if f.name == "text" else f.dataType) for f in docs.schema.fields]
    return docs.mapInArrow(run, T.StructType(fields))


def _fetched(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(key, o, rid, start, bytes): the wanted runs with their bytes; members of large groups window by
    window, dealt by the window's hash, unless they are windows that their key deals already."""
    lists = wanted.groupBy("rid").agg(F.collect_list(F.struct("key", "start", "windows", "group", "single")).alias("w"))
    src = _zipped(docs.select("o", "rid", "text")).dropDuplicates(["rid"]).join(lists, "rid")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in slices(batches):
            out, held = ([], [], [], [], []), 0
            for o, rid, data, w in zip(b["o"].to_pylist(), b["rid"].to_pylist(), b["text"].to_pylist(), b["w"].to_pylist()):
                raw = unpack.decompress(data)
                for x in w:
                    s, n = x["start"], x["windows"]
                    if x["group"] <= GROUP or x["single"]:
                        parts = [(x["key"], s, raw[s : s + n + length - 1])]
                    else:
                        cells = -(-x["group"] // CELL)
                        parts = []
                        for at in range(s, s + n):
                            cell = int.from_bytes(hashlib.blake2b(raw[at : at + length], digest_size=7).digest(), "little") % cells
                            own = hashlib.blake2b(b"%d %d" % (x["key"], cell), digest_size=8).digest()
                            parts.append((int.from_bytes(own, "little", signed=True), at, raw[at : at + length]))
                    for key, at, text in parts:
                        for col, v in zip(out, (key, o, rid, at, text)):
                            col.append(v)
                    held += sum(len(text) for _, _, text in parts)
                    if len(out[0]) > 20_000 or held > 1 << 22:
                        yield batch(out)
                        out, held = ([], [], [], [], []), 0
            if out[0]:
                yield batch(out)

    def batch(out):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["key", "o", "rid", "start", "bytes"])

    return src.select("o", "rid", "text", "w").mapInArrow(run, "key long, o long, rid long, start long, bytes binary")


def bounded_suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` bytes at least (ties in any order), by doubling."""
    n = len(text)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(min(8, n)):
        key[: n - k] |= text[k:].astype(np.uint64) << _U(56 - 8 * k)
    order = np.argsort(key)
    have = 8
    while True:
        k = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate(([1], k[1:] != k[:-1])))
        if have >= depth or rank[order[-1]] == n:
            return order
        key = rank * (n + 1)
        key[:-have] += rank[have:]
        # only suffixes that are still tied move, and only within their tie
        tied = np.concatenate(([False], k[1:] == k[:-1]))
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        order[at] = order[at][np.argsort(key[order[at]])]
        have *= 2


def interval_expansion(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each suffix in ``order``, whether it has at least ``length`` bytes in common with the one
    before; by breadth-first backward extension on the Burrows-Wheeler transform.

    Level l holds intervals of suffixes that share a string of l bytes. An interval is extended to the
    left by each byte that precedes one of its suffixes: the new interval reaches from the image of that
    byte's first occurrence to the image of its last. If the boundary after the new interval is not
    yet set, its common prefix is l, and the interval goes on to the next level; else it is dropped.
    Every step sets a boundary, so all levels together take as many steps as there are suffixes.
    """
    n = len(text)
    bwt = text[order - 1]  # the text is read as a circle; its last byte is a separator
    image = np.empty(n, dtype=np.int64)
    image[np.argsort(bwt, kind="stable")] = np.arange(n)
    done = np.zeros(n + 1, dtype=bool)
    done[0] = done[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n - 1, np.int64)
    for level in range(length):
        one = low == high
        new_low, new_high = [image[low[one]]], [image[low[one]]]
        wide = np.flatnonzero(~one)
        size = high[wide] - low[wide] + 1
        ends = np.cumsum(size)
        at = 0
        while at < len(wide):  # in parts, so that memory stays bounded
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), side="right")))
            part, s = wide[at:to], size[at:to]
            row = np.repeat(low[part] - (np.cumsum(s) - s), s) + np.arange(int(s.sum()))
            tag = np.repeat(np.arange(len(part)), s) * 256 + bwt[row]
            if len(part) * 256 < 4 * len(row):  # few wide intervals: first and last place of each byte
                first = np.full(len(part) * 256, n, dtype=np.int64)
                last = np.full(len(part) * 256, -1, dtype=np.int64)
                last[tag] = row
                first[tag[::-1]] = row[::-1]
                found = np.flatnonzero(last >= 0)
                new_low.append(image[first[found]])
                new_high.append(image[last[found]])
            else:
                by = np.argsort(tag, kind="stable")
                t = tag[by]
                cut = np.concatenate(([True], t[1:] != t[:-1]))
                new_low.append(image[row[by[cut]]])
                new_high.append(image[row[by[np.concatenate((cut[1:], [True]))]]])
            at = to
        low, high = np.concatenate(new_low), np.concatenate(new_high)
        fresh = ~done[high + 1]
        low, high = low[fresh], high[fresh]
        done[high + 1] = True
        if not len(low):
            break
    return ~done[:n]


def repeated_windows(parts: list[bytes], o: np.ndarray, rid: np.ndarray, start: np.ndarray, length: int):
    """(part, offset) of the windows of some runs to which an equal window stands earlier."""
    text = np.frombuffer(b"".join(p + bytes([_END]) for p in parts), dtype=np.uint8)
    size = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    begin = np.cumsum(size) - size
    order = bounded_suffix_array(text, length)
    same = interval_expansion(text, order, length)
    pair = same.copy()
    pair[:-1] |= same[1:]
    row = np.flatnonzero(pair)
    part = np.searchsorted(begin, order[row], side="right") - 1
    offset = order[row] - begin[part]
    whole = offset + length < size[part]  # a window that ends before the separator
    number = np.cumsum(~same)[row][whole]
    part, offset = part[whole], offset[whole]
    zero = np.zeros(len(part), np.int64)
    by, later = _later(number, zero, o[part], rid[part], start[part] + offset)
    return part[by[later]], offset[by[later]]


def _compared(fetched: DataFrame, length: int) -> DataFrame:
    """(rid, start, windows) of the windows that an earlier window of another run equals."""
    cols = ["key", "o", "rid", "start", "bytes"]
    dealt = fetched.repartition("key").sortWithinPartitions("key", "bytes", "o", "rid", "start")

    def run(batches):
        block, total = [], 0
        for t in _whole_groups(batches, cols):
            key = t["key"].to_numpy()
            edge = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                part = t.slice(a, b - a)
                n = part["bytes"].combine_chunks().nbytes
                if block and total + n > BLOCK:
                    yield done(block)
                    block, total = [], 0
                block.append(part)
                total += n
        if block:
            yield done(block)

    def done(block):
        t = pa.concat_tables(block)
        o, rid, start = (t[c].to_numpy() for c in ("o", "rid", "start"))
        # windows of different groups in a block may be equal too; that they are marked is right as well
        part, offset = repeated_windows(t["bytes"].to_pylist(), o, rid, start, length)
        r, s = rid[part], start[part] + offset
        by = np.lexsort((s, r))
        r, s = r[by], s[by]
        new = np.concatenate(([True], (r[1:] != r[:-1]) | (s[1:] > s[:-1] + 1))) if len(r) else np.empty(0, bool)
        first = np.flatnonzero(new)
        last = (np.append(first[1:], len(r)) - 1)[: len(first)]
        return pa.RecordBatch.from_arrays([pa.array(r[first]), pa.array(s[first]), pa.array((s[last] - s[first] + 1).astype(np.int32))], names=["rid", "start", "windows"])

    return dealt.mapInArrow(run, "rid long, start long, windows int")


def _frequent(docs: DataFrame, length: int, n_docs: int) -> set[int]:
    """Fingerprints that many different runs of a small sample have (bounded by the sample); equal runs need
    no such care, they collapse where they are read."""
    m = max(1, n_docs // SAMPLE)
    sample = docs.where(F.pmod(F.xxhash64("rid"), F.lit(m)) == 0)
    seen = _fingerprints(sample, length, None).where("windows > 0").groupBy("key").agg(F.countDistinct("ctx").alias("n"))
    return {r.key % (1 << 64) for r in seen.where(F.col("n") >= FREQUENT).orderBy(F.desc("n")).limit(SAMPLE).select("key").collect()}


def spans_to_remove(docs: DataFrame, length: int) -> DataFrame:
    """(rid, spans): per row of (o, rid, text) that loses bytes, its marked ranges (begin, end), unmerged."""
    frequent = _frequent(docs, length, docs.count())
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most ``SAMPLE`` numbers
    recur = stored(_shared_runs(_fingerprints(docs, length, shared)), "recurring")
    fetched = _fetched(docs, recur.where("group > 0").select("key", "rid", "start", "windows", "group", "single"), length)
    more = stored(_compared(fetched, length), "repeated")
    marks = recur.where("group = 0").select("rid", "start", "windows").unionByName(more)
    return marks.groupBy("rid").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """(row, kept, n_bytes, spans): see ``packed`` for ``row``; ``kept`` is the text's UTF-8 bytes without
    every byte that a string of ``length`` bytes covers which also starts earlier; ``spans`` are the
    maximal removed ranges (begin, end, begin, ...). With ``as_text``, ``kept`` is a string: a character
    that loses a byte goes whole.

    Strings are judged on the input, not on what is left, and never reach across documents. A null
    text is empty. Order is by id, null ids last; rows that share an id are not earlier than each
    other, so a row repeated as a whole is kept or cut like its twin. Texts shorter than ``length`` are
    kept whole. An empty table gives an empty result.
    """
    src = packed(docs, text_col)
    with_id = src.withColumn("o", F.coalesce(F.col(f"row.`{id_col}`").cast("long"), F.lit(LAST)))
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("o"))
    repeated = not ids.groupBy("o").count().where("count > 1").isEmpty()
    rid = F.xxhash64("o", "text") if repeated else F.col("o")  # a row's name: its id, where ids are unique
    with_id = with_id.withColumn("rid", rid)
    once = with_id.select("o", "rid", "text")
    spans = spans_to_remove(once.dropDuplicates(["rid"]) if repeated else once, length)
    both = _zipped(with_id.select("row", "rid", "text")).join(spans, "rid", "left").select("row", "text", "spans")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in slices(batches):
            kept, size, cut = [], [], []
            for data, spans in zip(b["text"].to_pylist(), b["spans"].to_pylist()):
                raw = unpack.decompress(data)
                merged: list[int] = []
                for s, e in sorted((x["start"], x["start"] + x["windows"] + length - 1) for x in spans or []):
                    if merged and s <= merged[-1]:
                        merged[-1] = max(merged[-1], e)
                    else:
                        merged += [s, e]
                edges = [0, *merged, len(raw)]
                kept.append(b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2])))
                size.append(len(raw))
                cut.append(merged)
            out = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays([b["row"], out, pa.array(size, pa.int64()), pa.array(cut, pa.list_(pa.int64()))], names=["row", "kept", "n_bytes", "spans"])

    kinds = [T.StructField("row", src.schema["row"].dataType), T.StructField("kept", T.StringType() if as_text else T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType()))]
    return both.mapInArrow(run, T.StructType(kinds))
