"""Operator 8: benchmark decontamination with an FM-index per shard of training texts.

A task indexes its texts shard by shard (a bounded number of bytes each): words become numbers, a
suffix array of the number sequence gives the Burrows-Wheeler transform, a wavelet matrix answers
rank queries on it. All test phrases are then searched backwards together, one word per step;
matching rows are walked to the next sampled suffix position, which gives the place of each
occurrence; the words inside any occurrence are merged into removal spans.

Words that no benchmark item has cannot be part of an occurrence: they all become the separator, and
stretches between separators that are shorter than the shortest phrase are left out of the index.

The benchmark is a stated set of phrases. It is sent to the tasks in blocks of ``block_bytes``, each
searched in a further narrow pass, so no broadcast grows with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import packed, runs, slices

# Words: runs of 0-9, a-z and everything beyond ASCII, after lower-casing A-Z.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Phrases:
    """The distinct windows of some benchmark items and which items have each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], dict[str, None]] = {}
        for name, text in items:
            w = [self.number.setdefault(x, len(self.number) + 1) for x in words(text)]
            for at in range(max(1, len(w) - window + 1) if w else 0):
                seen.setdefault(tuple(w[at : at + window]), {})[name] = None
        self.items = [list(v) for v in seen.values()]
        size = np.array([len(k) for k in seen], dtype=np.int64)
        self.by_size = {int(n): (np.flatnonzero(size == n), np.array([k for k in seen if len(k) == n], dtype=np.int64)) for n in np.unique(size)}
        self.size = size
        self.shortest = int(size.min()) if len(size) else 0


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; ``ranks`` are non-negative numbers, a suffix that ends sorts first."""
    n = len(ranks)
    _, rank = np.unique(ranks, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    step = 1
    order = np.argsort(rank, kind="stable")
    while n and rank[order[-1]] < n:
        key = rank * (n + 2)
        key[:-step] += rank[step:]
        order = np.argsort(key, kind="stable")
        k = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([1], k[1:] != k[:-1])))
        step *= 2
        if step >= n:
            break
    return order


class WaveletMatrix:
    """rank(symbol, i): how often ``symbol`` stands before position i, for arrays of both."""

    def __init__(self, data: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (data >> level & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(len(data) - int(self.ones[-1][-1]))
            data = np.concatenate([data[~bit], data[bit]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(i), i
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one = (symbol >> level & 1).astype(bool)
            a, b = self.ones[k][low], self.ones[k][high]
            low = np.where(one, self.zeros[k] + a, low - a)
            high = np.where(one, self.zeros[k] + b, high - b)
        return high - low


class FmIndex:
    """Backward search over a sequence of numbers, 0 being a separator that no phrase has."""

    def __init__(self, seq: np.ndarray, symbols: int, sample: int = 8):
        n = len(seq)
        cuts = np.cumsum(seq == 0)
        # each separator is a symbol of its own when suffixes are ordered, so every order is decided
        # by the end of a stretch
        order = suffix_array(np.where(seq == 0, cuts, int(cuts[-1]) + 1 + seq if n else seq))
        before = np.where(order > 0, seq[order - 1], 0)
        self.last, self.n = before, n
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=symbols))))
        self.tree = WaveletMatrix(before, symbols)
        # positions are kept at every ``sample``-th place and at the start of each stretch
        self.known = np.where((order % sample == 0) | (before == 0), order, -1)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row numbers of ``phrases`` that occur, first matching suffix, one past the last)."""
        alive = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[alive, k]
            low, high = (self.first[c] + self.tree.rank(c, x) for x in (low, high))
            keep = high > low
            alive, low, high = alive[keep], low[keep], high[keep]
            if not len(alive):
                break
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes at these rows begin: walk back to a sampled one and add the steps."""
        out, steps, at = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64), rows.copy()
        todo = np.arange(len(rows))
        while len(todo):
            known = self.known[at[todo]]
            done = known >= 0
            out[todo[done]] = known[done] + steps[todo[done]]
            todo = todo[~done]
            c = self.last[at[todo]]
            at[todo] = self.first[c] + self.tree.rank(c, at[todo])
            steps[todo] += 1
        return out


def scan_shard(texts: list[str | None], phrases: Phrases) -> tuple[list[int], list[list[int]], list[list[str]]]:
    """Per text: its number of words, merged hit spans as flat word positions (begin, end, begin, ...),
    the items that occur."""
    split = [words(t) for t in texts]
    n_words = [len(w) for w in split]
    spans: list[list[int]] = [[] for _ in texts]
    items: list[list[str]] = [[] for _ in texts]
    total = sum(n_words)
    if not phrases.shortest or not total:
        return n_words, spans, items
    get = phrases.number.get
    seq = np.fromiter((get(x, 0) for w in split for x in (*w, b"")), np.int64, total + len(texts))
    ends = np.cumsum(np.array(n_words) + 1)
    # stretches of benchmark words, and those long enough to hold a phrase
    on = np.concatenate(([0], (seq != 0).astype(np.int8), [0]))
    edge = np.diff(on)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    fit = end - begin >= phrases.shortest
    begin, end = begin[fit], end[fit]
    if not len(begin):
        return n_words, spans, items
    size = end - begin + 1  # with the separator after it
    place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    index = FmIndex(seq[place], len(phrases.number) + 1)
    cover = np.zeros(len(place) + 1, np.int64)
    for n, (which, table) in phrases.by_size.items():
        alive, low, high = index.search(table)
        count = high - low
        if not len(alive):
            continue
        rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        at = index.locate(rows)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + n, -1)
        doc = np.searchsorted(ends, place[at], side="right")
        pair = np.unique(np.stack([doc, np.repeat(which[alive], count)]), axis=1)
        for d, p in pair.T.tolist():
            items[d].extend(phrases.items[p])
    hit = np.zeros(len(seq), bool)
    hit[place] = np.cumsum(cover)[:-1] > 0
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        d = int(np.searchsorted(ends, a, side="right"))
        base = int(ends[d]) - n_words[d] - 1
        spans[d] += [a - base, b - base]
    return n_words, spans, [sorted(set(x)) for x in items]


def _merged(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return a or b
    out: list[int] = []
    for x, y in sorted(list(zip(a[::2], a[1::2])) + list(zip(b[::2], b[1::2]))):
        if out and x <= out[-1]:
            out[-1] = max(out[-1], y)
        else:
            out += [x, y]
    return out


def without(text: str, spans: list[int]) -> str:
    """The text without the given words and what stands between words of one span."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [(m.start(), m.end()) for m in _WORD.finditer(raw.translate(_TABLE))]
    out, last = [], 0
    for b, e in zip(spans[::2], spans[1::2]):
        out.append(raw[last : at[b][0]])
        last = at[e - 1][1]
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    return runs(((r.i, r.t) for r in rows.toLocalIterator()), lambda r: len(r[1]), block_bytes)


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, shard_bytes: int = 8 << 20, block_bytes: int = 8 << 20, clean: bool = False) -> DataFrame:
    """(row, text, n_words, spans, items): see ``packed`` for ``row``; ``spans`` are flat word positions
    (begin, end, ...) of the merged hits, ``items`` the ids, as strings in string order, of the items
    with an occurring window. With ``clean``, ``text`` is the text without the spans.

    A window is ``window`` consecutive words of an item, or all words of a shorter one; items without
    words or id have none. A null text has no words and stays null. Repeated rows and repeated items
    are scanned as they are; empty tables give empty results or no hits. No shuffle.
    """
    out = packed(docs, text_col).selectExpr("row", "text", "0L as n_words", "array() :: array<int> as spans", "array() :: array<string> as items")
    sc = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    block, following = next(blocks, []), True
    while following:
        following = next(blocks, None)
        out = out.mapInArrow(_pass(sc.broadcast(block), window, shard_bytes, clean and following is None), out.schema)
        block = following
    return out


def _pass(shared, window: int, shard_bytes: int, clean: bool):
    def run(batches):
        phrases = Phrases(shared.value, window)
        for b in slices(batches, 4096):
            texts, at = b["text"].to_pylist(), 0
            for group in runs(texts, lambda t: len(t or ""), shard_bytes):
                n_words, spans, items = scan_shard(group, phrases)
                part = b.slice(at, len(group))
                at += len(group)
                spans = [_merged(x, y) for x, y in zip(part["spans"].to_pylist(), spans)]
                items = [sorted({*x, *y}) for x, y in zip(part["items"].to_pylist(), items)]
                text = pa.array([without(t, s) if s else t for t, s in zip(group, spans)], pa.string()) if clean else part["text"]
                yield pa.RecordBatch.from_arrays([part["row"], text, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))], names=["row", "text", "n_words", "spans", "items"])

    return run
