"""Operator 4: exact length histogram of encoded documents and the answers that follow from it.

``histogram`` counts documents by encoded length (counts are summed per batch, then per map task,
before the shuffle). ``suffix_sums`` adds, for every length, how many documents and tokens lie at or
above it; with these two sums any context limit's totals are exact arithmetic (``at_limits``), and a
quantile is the first length whose share is reached (``quantiles``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import runs, stored
from ledgerline.llm.tokens import unit_encoder

BLOCK = 1024  # lengths per block of the two-level suffix sum


def histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """(n_tokens, n_docs): documents by encoded length.

    A null text counts as empty, that is, length 0; repeated rows count each; other columns are
    ignored; an empty table gives no rows. ``tokenizer``: path of a tokenizer JSON file.
    """
    spec = docs.sparkSession.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())

    def run(batches):
        enc = unit_encoder(spec.value)
        for b in batches:
            sizes = [enc.lengths(g) for g in runs((t or "" for t in b[0].to_pylist()), len, 1 << 20)]
            if sizes:
                n, c = np.unique(np.concatenate(sizes), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(c.astype(np.int64))], names=["n_tokens", "n"])

    counts = docs.select(docs[text_col]).mapInArrow(run, "n_tokens long, n long")
    return counts.groupBy("n_tokens").agg(F.sum("n").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per length of ``hist``: documents and tokens at or above it, and over the whole table.

    Two levels: a window inside each block of ``BLOCK`` lengths, and one over the blocks' totals.
    Only the latter is one task; it holds (longest length / ``BLOCK``) rows, whatever the corpus.
    Repeated lengths are added up; null lengths are dropped. The histogram is written once, as it is read twice.
    """
    h = stored(hist.where("n_tokens is not null").groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")), "lengths")
    h = h.withColumn("block", F.expr(f"n_tokens div {BLOCK}"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.expr("n_docs * n_tokens")).alias("t"))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(every).alias("total_docs"),
        F.sum("t").over(every).alias("total_tokens"),
    )
    return h.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(inside) + F.col("d_above")).alias("docs_at_least"),
        (F.sum(F.expr("n_docs * n_tokens")).over(inside) + F.col("t_above")).alias("tokens_at_least"),
        "total_docs",
        "total_tokens",
    )


def truncated(limit: Column) -> Column:
    """Tokens kept when every document is cut at ``limit``, where ``limit`` is at most the row's
    length and above the next smaller one."""
    return F.col("total_tokens") - F.col("tokens_at_least") + limit * F.col("docs_at_least")


def at_limits(sums: DataFrame, limits: DataFrame) -> DataFrame:
    """Per ``limit`` of ``limits`` (one integer column): documents cut or exactly full, tokens kept.

    ``limits`` is a stated list (one row per context size), joined in blocks of lengths; a limit
    above every length keeps all tokens. Null limits are dropped; repeated limits appear once.
    """
    want = limits.select(F.col(limits.columns[0]).cast("long").alias("limit")).where("limit is not null").distinct()
    marks = want.select(F.col("limit").alias("n_tokens"), F.lit(True).alias("asked"))
    rows = sums.select("n_tokens", "docs_at_least", "tokens_at_least", "total_docs", "total_tokens").withColumn("asked", F.lit(False))
    blank = [F.lit(None).cast("long").alias(c) for c in ("docs_at_least", "tokens_at_least", "total_docs", "total_tokens")]
    both = rows.unionByName(marks.select("n_tokens", *blank, "asked")).withColumn("block", F.expr(f"n_tokens div {BLOCK}"))
    cols = ("docs_at_least", "tokens_at_least", "total_docs", "total_tokens")
    up = Window.partitionBy("block").orderBy(F.desc("n_tokens"), "asked").rowsBetween(Window.unboundedPreceding, 0)
    # nearest measured length at or above the limit: in the limit's block, else the first of a later block
    firsts = rows.withColumn("block", F.expr(f"n_tokens div {BLOCK}")).groupBy("block").agg(F.min_by(F.struct(*cols), "n_tokens").alias("first"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    spread = both.select("block").distinct().join(firsts, "block", "left").select("block", F.last("first", True).over(later).alias("later"))
    got = both.select("block", "n_tokens", "asked", F.last(F.when(~F.col("asked"), F.struct(*cols)), True).over(up).alias("here"))
    got = got.where("asked").join(spread, "block").withColumn("s", F.coalesce("here", "later"))
    total = sums.agg(F.max("total_docs").alias("all_docs"), F.max("total_tokens").alias("all_tokens"))
    one = got.select(F.col("n_tokens").alias("limit"), "s.*", F.lit(1).alias("k")).join(total.withColumn("k", F.lit(1)), "k")
    return one.select(
        "limit",
        F.coalesce("all_docs", F.lit(0)).alias("n_docs"),
        F.coalesce("docs_at_least", F.lit(0)).alias("docs_at_least"),
        F.coalesce(F.coalesce(truncated(F.col("limit")), F.col("all_tokens")), F.lit(0)).alias("kept_tokens"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that at least ``share`` of the documents do not exceed."""
    below = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    cols = [F.min(F.when(below >= F.ceil(F.lit(s) * F.col("total_docs")), F.col("n_tokens"))).alias(f"q{i}") for i, s in enumerate(shares)]
    pairs = ", ".join(f"cast({s} as double), q{i}" for i, s in enumerate(shares))
    return sums.agg(*cols).selectExpr(f"stack({len(shares)}, {pairs}) as (share, n_tokens)")


def length_table(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """One row per encoded length, read as a context limit: totals, rank and truncated total."""
    s = suffix_sums(histogram(docs, tokenizer, text_col))
    return s.select("*", truncated(F.col("n_tokens")).alias("truncated_tokens"), ((F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")).alias("share_not_longer"))
