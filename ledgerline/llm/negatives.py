"""Operator 13: hard-negative mining with Strassen multiplication on integer tiles.

Each component x of a vector becomes floor(256 x), and the score of two rows is the inner product of
these integers. Anchors go out in rounds of bounded size (``ANCHOR_NUMBERS`` integers a broadcast); a
round passes over all rows twice. Every task cuts its rows into tiles, multiplies the anchors with each
tile by Strassen's recursion (seven products of half-sized blocks, odd sides padded with zeros; additions
and products of 64-bit integers, hence exact), and keeps heaps of bounded size: in the first pass the
best rows of the anchor's label, in the second, for each positive, the best rows of other labels whose score
lies in the positive's window. Heaps are merged by taking the best of both, within a task as over tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.session import scratch_path

ANCHOR_NUMBERS = 1 << 20  # integers of the anchors in one broadcast
TILE = 4096  # rows of one candidate tile
LEAF = 16  # the recursion stops at blocks with a side of at most this
_LEAST = np.iinfo(np.int64).min
SCALE = 256


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices of any shape; exact wherever the result fits 64 bits (additions wrap)."""
    (p, d), q = a.shape, b.shape[1]
    if min(p, d, q) <= leaf:
        return np.matmul(a, b)
    if p % 2 or d % 2:
        a = np.pad(a, ((0, p % 2), (0, d % 2)))
    if d % 2 or q % 2:
        b = np.pad(b, ((0, d % 2), (0, q % 2)))
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    out = np.empty((2 * i, 2 * k), dtype=np.int64)
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out[:i, :k] = m1 + m4 - m5 + m7
    m3 = strassen(a11, b12 - b22, leaf)
    out[:i, k:] = m3 + m5
    m2 = strassen(a21 + a22, b11, leaf)
    out[i:, :k] = m2 + m4
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    out[i:, k:] = m1 - m2 + m3 + m6
    return out[:p, :q]


class Heaps:
    """For each key the ``k`` best (score, id), higher scores first, ties by the smaller id; an entry counts
    once. ``push`` of another heap's entries merges the two."""

    def __init__(self, k: int):
        self.k, self.of = k, {}

    def push(self, key: int, score: int, ident: int) -> None:
        heap, entry = self.of.setdefault(key, []), (score, -ident)
        if entry in heap:
            return
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        else:
            heapq.heappushpop(heap, entry)

    def push_tile(self, keys: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """The best entries of a tile: ``scores`` (keys x ids) where ``allowed``."""
        s = np.where(allowed, scores, _LEAST)
        least = np.partition(s, -self.k, axis=1)[:, -self.k] if s.shape[1] > self.k else np.full(len(s), _LEAST)
        row, col = np.nonzero(allowed & (s >= least[:, None]))
        by = np.lexsort((ids[col], -s[row, col], row))
        row, col = row[by], col[by]
        if not len(row):
            return
        # rows that repeat an id with one score stand together and count once
        best, who = s[row, col], ids[col]
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (best[1:] != best[:-1]) | (who[1:] != who[:-1])))
        row, best, who = row[new], best[new], who[new]
        begin = np.searchsorted(row, row)
        keep = np.arange(len(row)) - begin < self.k
        for r, v, i in zip(row[keep].tolist(), best[keep].tolist(), who[keep].tolist()):
            self.push(int(keys[r]), v, i)

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for key, heap in self.of.items():
            for score, ident in heap:
                yield key, -ident, score


def integer_rows(table: DataFrame, label: Column, id_col: str, vec_col: str) -> DataFrame:
    """(id, label, v array<long>) of the rows that take part."""
    x = table.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = x.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    edge = float(2**62)  # components further out are held there: 256 times them is no long any more
    whole = F.transform("x", lambda c: F.when(F.abs(c) < edge / SCALE, F.floor(c * F.lit(float(SCALE)))).otherwise((F.signum(c) * edge).cast("long")))
    return x.select("id", "label", whole.alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a batch as rows; shorter ones are padded with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    size = np.diff(column.offsets.to_numpy())
    if (size == dim).all():
        return flat.reshape(len(size), dim)
    out = np.zeros((len(size), dim), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _tiles(batches, dim: int):
    """(ids, labels, matrix) of at most ``TILE`` rows, filled over the batches of a task."""
    held, n = [], 0
    for b in batches:
        for at in range(0, b.num_rows, TILE):
            part = b.slice(at, TILE)
            if n and n + part.num_rows > TILE:
                yield _tile(held, dim)
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if held:
        yield _tile(held, dim)


def _tile(parts: list[pa.RecordBatch], dim: int):
    t = pa.Table.from_batches(parts).combine_chunks()
    v = t["v"].combine_chunks()
    v = pa.concat_arrays(v.chunks) if isinstance(v, pa.ChunkedArray) else v
    return t["id"].to_numpy(), t["label"].to_numpy(), _matrix(v, dim)


def _round(rows: DataFrame, anchors: pa.Table, dim: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Both passes for the anchors of one round: (anchor_id, positive_id, rank, negative_id, ..)."""
    sc = rows.sparkSession.sparkContext
    v = anchors["v"].combine_chunks()
    v = pa.concat_arrays(v.chunks) if isinstance(v, pa.ChunkedArray) else v
    a_ids, a_labels, a = anchors["id"].to_numpy(), anchors["label"].to_numpy(), _matrix(v, dim)
    sent = sc.broadcast((a_ids, a_labels, a))

    def same(batches):
        ids_a, labels_a, a = sent.value
        heaps = Heaps(positives)
        for ids, labels, x in _tiles(batches, dim):
            s = strassen(a, np.ascontiguousarray(x.T))
            heaps.push_tile(np.arange(len(a)), s, (labels_a[:, None] == labels) & (ids_a[:, None] != ids), ids)
        yield _batch(heaps, ["anchor", "id", "score"])

    def merged(df: DataFrame, keys: list[str], k: int) -> DataFrame:
        best = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
        return df.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    found = merged(rows.mapInArrow(same, "anchor long, id long, score long"), ["anchor"], positives)
    found = found.orderBy("anchor", "rank").toArrow()  # at most ``positives`` rows an anchor
    anchor, pos_id, pos = (found[c].to_numpy() for c in ("anchor", "id", "score"))
    # low * score <= 100 * negative <= high * score, as bounds of the negative's score
    least = [-((-low * s) // 100) for s in pos.tolist()]
    most = [high * s // 100 for s in pos.tolist()]
    asked = sc.broadcast((anchor, np.array(least, dtype=np.int64), np.array(most, dtype=np.int64)))

    def other(batches):
        ids_a, labels_a, a = sent.value
        of, least, most = asked.value
        heaps, key = Heaps(negatives), np.arange(len(of))
        rank = key - np.searchsorted(of, of)  # a positive's place among those of its anchor
        for ids, labels, x in _tiles(batches, dim):
            s = strassen(a, np.ascontiguousarray(x.T))
            differ = (labels_a[:, None] != labels) & (ids_a[:, None] != ids)
            for r in range(int(rank.max(initial=-1)) + 1):
                at = key[rank == r]
                mine = s[of[at]]
                heaps.push_tile(at, mine, differ[of[at]] & (mine >= least[at, None]) & (mine <= most[at, None]), ids)
        yield _batch(heaps, ["pair", "id", "score"])

    got = merged(rows.mapInArrow(other, "pair long, id long, score long"), ["pair"], negatives)
    pairs = {"pair": np.arange(len(anchor)), "anchor_id": a_ids[anchor], "positive_id": pos_id, "positive_score": pos}
    named = rows.sparkSession.createDataFrame(pa.table(pairs).cast(pa.schema([(c, pa.int64()) for c in pairs])))
    return got.join(F.broadcast(named), "pair").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _batch(heaps: Heaps, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*heaps.rows())) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def mine(
    table: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    anchor_numbers: int = ANCHOR_NUMBERS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), scores as 64-bit integers.

    Anchors are the rows that ``is_anchor`` (a condition on ``id``) picks; ``label`` is an expression over
    ``table``. An anchor's positives are its ``positives`` best other rows of its label. For each, the
    ``negatives`` best rows of another label come back whose score s fulfils low * p <= 100 * s <= high * p, p being
    the positive's score; a positive without any gives no row, and neither does one of negative score.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Vectors shorter
    than the longest count as padded with zeros (an empty one scores 0). Rows that repeat an id count once
    for each score they reach; no row is a partner of its own id, and an anchor that stands twice, with
    equal label and vector, is one. Components beyond 2**62 / 256 are held there, and scores beyond 64 bits
    wrap. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark = table.sparkSession
    rows = stored(integer_rows(table, label, id_col, vec_col), "integer_rows")
    anchors = rows.where(is_anchor).dropDuplicates(["id", "label", "v"])
    size = rows.agg(F.max(F.size("v")).alias("dim")).first()
    dim, n = size.dim or 0, anchors.count()
    out = f"{scratch_path(spark, 'negatives')}"
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], schema)
    rounds = -(-n * max(1, dim) // anchor_numbers)
    dealt = stored(anchors.withColumn("round", F.pmod(F.xxhash64("id", "label", "v"), F.lit(rounds))), "anchors") if rounds > 1 else anchors
    for r in range(rounds):
        block = (dealt.where(F.col("round") == r) if rounds > 1 else dealt).select("id", "label", "v").orderBy("id", "label").toArrow()
        if block.num_rows:
            _round(rows, block, dim, positives, negatives, low, high).write.parquet(f"{out}/round={r}")
    return spark.read.schema(schema).parquet(out).select(*[c.split(" ")[0] for c in schema.split(", ")])
