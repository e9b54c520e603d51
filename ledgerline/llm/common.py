"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

LAST = 2**63 - 1  # stands for a null id wherever ids are ordered: such rows come last


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(id_col: str, text_col: str) -> Column:
    """A key of (id, text): repeated rows share it, rows that only share the id do not."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def runs(batches: Iterable, size, limit: int) -> Iterator[list]:
    """Group items into lists of about ``limit`` in total ``size`` (an item larger than that is alone)."""
    group, total = [], 0
    for x in batches:
        n = size(x)
        if group and total + n > limit:
            yield group
            group, total = [], 0
        group.append(x)
        total += n
    if group:
        yield group


def slices(batches: Iterable, rows: int = 256) -> Iterator:
    """The record batches in slices of ``rows`` rows, so that few texts are Python objects at a time. At the end of
    a task its worker, which serves later ones too, gives free memory back to the system."""
    try:
        for b in batches:
            for at in range(0, b.num_rows, rows):
                yield b.slice(at, rows)
    finally:
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges`` (a, b).

    Alternating large-star / small-star rounds: each rewires the edges of a node towards the smallest
    node it knows, so the number of rounds grows with the logarithm of a component's size. Every
    round is a grouped minimum (combined on the map side) and an equi-join, and is written to the
    shared folder. Nodes without an edge are not in the result.
    """
    e = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), name)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(low.select("a", F.col("m").alias("b")))
        e = stored(small.distinct(), name)
        # settled when no node both has a smaller neighbour and is one, or has two
        roles = e.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        roles = roles.union(e.select("b", F.lit(0), F.lit(1))).groupBy("n").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        if roles.where("up > 1 or (up > 0 and down > 0)").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select("b").distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("b", "b"))


def packed(docs: DataFrame, text_col: str) -> DataFrame:
    """(row, text): every column but the text in one struct, so that no name can clash with those of
    an operator. ``unpacked`` undoes it."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return docs.select((F.struct(*others) if others else F.lit(0)).alias("row"), F.col(f"`{text_col}`").alias("text"))


def unpacked(df: DataFrame, columns: list[str], text_col: str, text: Column | str = "text") -> DataFrame:
    """The columns of the table that ``packed`` took, with ``text`` as its text."""
    text = F.col(text) if isinstance(text, str) else text
    return df.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in columns])
