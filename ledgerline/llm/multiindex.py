"""Operator 1: approximate nearest neighbours with an inverted multi-index.

Both halves of the vectors are quantised by their own centroids; a vector lies in the cell of its pair.
For a query, the pairs are visited in order of summed distance (the negative inner product of
the query's halves and the pair's centroids) with a heap, until their cells hold enough entries; those
are reranked by the exact inner product.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors); every vector is indexed. Their number grows with
the square root of the table (``centroids_for``), so that cells stay small; at ``CENTROIDS[1]`` of a half it stays,
which bounds the heap's steps and the table of cell sizes. How many entries a query must visit is calibrated:
a bounded sample of queries is searched exhaustively in one pass over the index, and the number is the
smallest with which the cells visited would have held ``target`` of their true neighbours.

Rerank blocks are sections (neighbouring first-half centroids), split into parts of bounded size. Cells are visited in
order of their sum, so the last sum tells which cells they were: a query goes to each part of the sections that
it visits once, with that one number.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

SAMPLE, CENTROIDS, PROBES = 20_000, (32, 256), 200
SECTIONS = 32  # most sections a query is sent to
PART, QUERY_PART = 8192, 2048  # entries and queries of one rerank block


def usable(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the vectors that take part: not null, without null or non-finite components, not zero, and
    of the most frequent dimension (of the smallest, if several are)."""
    v = F.col("vec")
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where("id is not null and vec is not null and size(vec) > 0")
    rows = rows.where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    dim = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (dim.n if dim else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows of the sample (deterministic)."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def centroids_for(n: int) -> int:
    """Centroids of each half for ``n`` vectors: about as many cells as vectors, within ``CENTROIDS``."""
    return min(CENTROIDS[1], max(CENTROIDS[0], math.ceil(math.sqrt(n))))


def fit(vectors: DataFrame, centroids: int, sample: int = SAMPLE) -> np.ndarray | None:
    """Centroids (2, k, ceil(d / 2)) of the halves, from ``sample`` vectors in order of a hash of the id. Those of the
    first half stand in order along the direction of their widest spread, so that a section is one region."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").toArrow()["vec"].combine_chunks()
    x = _matrix(pa.concat_arrays(rows.chunks) if isinstance(rows, pa.ChunkedArray) else rows)
    if not len(x):
        return None
    half = -(-x.shape[1] // 2)
    x = np.pad(x, ((0, 0), (0, 2 * half - x.shape[1])))
    first, second = (_kmeans(x[:, h * half : (h + 1) * half], min(centroids, len(x))) for h in range(2))
    along = np.linalg.svd(first - first.mean(axis=0), full_matrices=False)[2][0]
    return np.stack([first[np.argsort(first @ along, kind="stable")], second])


def _halves(x: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.pad(x, ((0, 0), (0, 2 * half - x.shape[1])))
    return x[:, :half], x[:, half:]


def index(vectors: DataFrame, centers: np.ndarray) -> DataFrame:
    """(id, vec, c1, c2): every vector with the nearest centroid of each half."""
    sent = vectors.sparkSession.sparkContext.broadcast(centers)

    def run(batches):
        c = sent.value
        for b in batches:
            if b.num_rows:
                near = [(x @ c[h].T - 0.5 * (c[h] ** 2).sum(axis=1)).argmax(axis=1).astype(np.int32) for h, x in enumerate(_halves(_matrix(b["vec"]), c.shape[2]))]
                yield pa.RecordBatch.from_arrays([b["id"], b["vec"], *map(pa.array, near)], names=["id", "vec", "c1", "c2"])

    return vectors.mapInArrow(run, "id long, vec array<double>, c1 int, c2 int")


def visit(d1: np.ndarray, d2: np.ndarray, count: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Centroid pairs in order of ``d1[i] + d2[j]`` until their cells hold ``enough`` entries.

    Multi-sequence search: the halves are sorted, and the heap holds the next pair of each sorted row whose cell has
    entries; empty cells are stepped over.
    """
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2, n2 = d1[o1].tolist(), d2[o2].tolist(), len(d2)
    size = count[np.ix_(o1, o2)]
    at = (size > 0).argmax(axis=1).tolist()  # per row, the pair that the heap holds
    heap = [(s1[i] + s2[at[i]], i) for i in np.flatnonzero(size.any(axis=1)).tolist()]
    heapq.heapify(heap)
    size, o1, o2 = size.tolist(), o1.tolist(), o2.tolist()
    out, held = [], 0
    while heap and held < enough:
        i = heap[0][1]
        row, j = size[i], at[i]
        held += row[j]
        out.append((o1[i], o2[j]))
        j += 1
        while j < n2 and not row[j]:
            j += 1
        if j < n2:
            at[i] = j
            heapq.heapreplace(heap, (s1[i] + s2[j], i))
        else:
            heapq.heappop(heap)
    return out


def _top(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, allowed=None):
    """(query, id, score) of the ``k`` best per query, ties to smaller ids; scores are summed the same way
    wherever a vector stands, so equal vectors have equal scores. ``allowed`` tells, for a range of the queries, which
    entries each may have."""
    out = []
    for at in range(0, len(q), 256):
        s = q[at : at + 256] @ x.T
        s[q_ids[at : at + 256, None] == ids] = -np.inf
        if allowed is not None:
            s[~allowed(at, at + 256)] = -np.inf
        least = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
        row, col = np.nonzero((s >= (least - 1e-9 * np.maximum(1, np.abs(least)))[:, None]) & (s > -np.inf))
        exact = np.einsum("ij,ij->i", q[at + row], x[col])
        by = np.lexsort((ids[col], -exact, row))
        row, col, exact = row[by], col[by], exact[by]
        begin = np.searchsorted(row, np.arange(len(s)))
        keep = np.arange(len(row)) - begin[row] < k
        out.append((q_ids[at + row[keep]], ids[col[keep]], exact[keep]))
    return [np.concatenate(z) for z in zip(*out)]


def exhaustive(queries: pa.Table, indexed: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, c1, c2): the true neighbours of a bounded set of queries."""
    sent = indexed.sparkSession.sparkContext.broadcast((queries["id"].to_numpy(), _matrix(queries["vec"].combine_chunks())))

    def run(batches):
        q_ids, q = sent.value
        for b in batches:
            if b.num_rows:
                ids = b["id"].to_numpy()
                a, i, s = _top(q, q_ids, _matrix(b["vec"]), ids, k)
                at = np.argsort(ids, kind="stable")
                cell = at[np.searchsorted(ids, i, sorter=at)]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(i), pa.array(s), b["c1"].take(pa.array(cell)), b["c2"].take(pa.array(cell))], names=["query_id", "id", "score", "c1", "c2"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    got = indexed.mapInArrow(run, "query_id long, id long, score double, c1 int, c2 int")
    return got.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)


def calibrate(indexed: DataFrame, centers: np.ndarray, count: np.ndarray, k: int, target: float, probes: int = PROBES) -> int:
    """The smallest number of entries with which the visited cells hold ``target`` of the true neighbours of
    ``probes`` vectors (in order of a hash of the id), on average."""
    sample = indexed.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(probes).select("id", "vec").toArrow().combine_chunks()
    true = exhaustive(sample, indexed, k).select("query_id", "c1", "c2").toPandas()
    total = int(count.sum())
    vec = dict(zip(sample["id"].to_pylist(), _matrix(sample["vec"].combine_chunks())))
    needed = []
    for query_id, rows in true.groupby("query_id"):
        a, b = _halves(vec[query_id][None], centers.shape[2])
        order = np.argsort(-((centers[0] @ a[0])[:, None] + centers[1] @ b[0]), axis=None, kind="stable")
        before = np.empty(count.size, np.int64)  # entries in the cells that the heap would give earlier
        before[order] = np.cumsum(count.ravel()[order]) - count.ravel()[order]
        needed += (before[rows["c1"] * count.shape[1] + rows["c2"]] + 1).tolist()
    return int(np.quantile(needed, target, method="higher")) if needed else total


def search(indexed: DataFrame, queries: DataFrame, centers: np.ndarray, count: np.ndarray, k: int, enough: int) -> DataFrame:
    """(query_id, rank, id, score): for each of ``queries`` (id, vec), the ``k`` best of the entries visited."""
    sent = indexed.sparkSession.sparkContext.broadcast((centers, count))  # bounded: 2 k d/2 and k * k numbers

    k1 = count.shape[0]

    def route(batches):
        centers, count = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            row, section, last = [], [], []
            for i, (x, y) in enumerate(zip(*_halves(_matrix(b["vec"]), centers.shape[2]))):
                d1, d2 = -(centers[0] @ x), -(centers[1] @ y)
                cells = visit(d1, d2, count, enough)
                here = sorted({c1 * SECTIONS // k1 for c1, _ in cells})
                row += [i] * len(here)
                section += here
                last += [float(d1[cells[-1][0]] + d2[cells[-1][1]])] * len(here)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b["id"].take(take), b["vec"].take(take), pa.array(section, pa.int32()), pa.array(last, pa.float64())], names=["query_id", "q", "section", "last"])

    # written, so that the heap is run once for each query
    asked = stored(queries.mapInArrow(route, "query_id long, q array<double>, section int, last double"), "asked")
    indexed = indexed.withColumn("section", F.expr(f"cast((c1 * {SECTIONS}) div {k1} as int)"))
    parts = lambda df, key, size: df.groupBy("section").agg(F.ceil(F.count("*") / size).cast("int").alias(key))
    n_parts, q_parts = parts(indexed, "parts", PART), parts(asked, "q_parts", QUERY_PART)
    both = n_parts.join(q_parts, "section")
    left = asked.join(both, "section").withColumn("qp", F.pmod(F.xxhash64("query_id"), F.col("q_parts")).cast("int"))
    left = left.select("query_id", "q", "last", "section", "qp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    right = indexed.join(both, "section").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    right = right.select("id", "vec", "c1", "c2", "section", "part", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("qp"))

    def rerank(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}).astype({"query_id": "int64", "id": "int64"})
        centers, _ = sent.value
        q, c1, c2 = np.stack(a["q"].to_numpy()), b["c1"].to_numpy(), b["c2"].to_numpy()
        d1, d2 = (-(x @ c.T) for x, c in zip(_halves(q, centers.shape[2]), centers))
        last = a["last"].to_numpy()
        last = (last + 1e-9 * np.maximum(1, np.abs(last)))[:, None]  # sums may be rounded otherwise than by the heap

        def allowed(begin, end):
            return d1[begin:end, c1] + d2[begin:end, c2] <= last[begin:end]

        q, i, s = _top(q, a["query_id"].to_numpy(), np.stack(b["vec"].to_numpy()), b["id"].to_numpy(), k, allowed)
        return pd.DataFrame({"query_id": q, "id": i, "score": s})

    keys = ("section", "part", "qp")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(rerank, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def nearest(table: DataFrame, is_query, k: int = 20, target: float = 0.97, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found for the rows that ``is_query`` (a condition on ``id``)
    picks, against all rows but the query's own, by largest inner product; ties to the smaller id.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
    without an id. Rows that repeat an id are told apart by nothing: the first of equal (id, vector) counts,
    and no row is a neighbour of its own id. Fewer candidates than ``k`` give fewer rows.
    """
    vectors = usable(table, id_col, vec_col).dropDuplicates(["id", "vec"])
    centers = fit(vectors, centroids_for(vectors.count()))
    if centers is None:
        return vectors.selectExpr("id as query_id", "cast(null as int) as rank", "id", "cast(null as double) as score").where("false")
    indexed = stored(index(vectors, centers), "multi_index")
    count = np.zeros((centers.shape[1], centers.shape[1]), dtype=np.int64)
    for r in indexed.groupBy("c1", "c2").count().collect():  # at most one row per cell
        count[r.c1, r.c2] = r["count"]
    enough = max(calibrate(indexed, centers, count, k, target), k + 1)
    return search(indexed, indexed.where(is_query).select("id", "vec"), centers, count, k, enough)
