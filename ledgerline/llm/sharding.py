"""Operator 3: sharding by extendible hashing.

A document's place is a string of bits: 60 bits of the MD5 of its id, then 60 bits of a hash of its
row (which only rows with one id ever reach). A shard is a prefix of such strings. The directory
starts with the empty prefix and splits only the shards whose bytes are above the limit, each on its
next bit, until every shard fits; what fits keeps its short prefix.

Splits need no passes over the texts: one aggregate gives the bytes of all prefixes of a depth that
the total suggests, the levels above are sums of it, and only prefixes that are still too large are
looked at deeper, round by round. Rows move by (id, bytes, hash) alone; ``write_shards`` then moves the texts once.
"""

from __future__ import annotations

import math

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import packed, row_key, slices, stored

BITS = 60


def place_bits(id_col: str = "doc_id"):
    """The first 60 bits of the MD5 of the id's text, as a string of 0 and 1 (a null id: empty text)."""
    text = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return F.lpad(F.bin(F.conv(F.substring(text, 1, BITS // 4), 16, 10).cast("long")), BITS, "0")


def _levels(hist: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """(cell, depth, shard_bytes) per cell of ``hist`` (cell, bytes, n): the first depth from ``low`` at which
    its prefix fits; null where it does not fit at ``high``."""
    each = hist.select("cell", "bytes", "n", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    each = each.withColumn("prefix", F.expr("substring(cell, 1, depth)"))
    sums = each.groupBy("depth", "prefix").agg(F.sum("bytes").alias("total"), F.sum("n").alias("rows"))
    fits = sums.where((F.col("total") <= limit) | (F.col("rows") <= 1))
    first = each.join(fits, ["depth", "prefix"]).groupBy("cell").agg(F.min(F.struct("depth", "total")).alias("first"))
    return hist.select("cell").join(first, "cell", "left").select("cell", "first.depth", F.col("first.total").alias("shard_bytes"))


def assign(docs: DataFrame, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, id, n_bytes, shard, depth, shard_bytes) per row: ``shard`` is its prefix, ``shard_bytes`` what the
    shard holds; ``rid`` is ``row_key`` of the row.

    Every shard holds at most ``limit_bytes`` of text, but for a single text that is larger by itself and has
    a shard of its own. A null text has no bytes; a null id is placed like the empty one; repeated rows
    and rows that share an id are placed alike as long as they fit and are split by row beyond.
    A table that fits is one shard with the empty prefix; an empty table gives an empty result.
    """
    n = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    base = docs.select(row_key(id_col, text_col).alias("rid"), F.col(id_col).alias("id"), n.alias("n_bytes"), place_bits(id_col).alias("h"))
    # numbered rows are written, so that a recomputed task cannot number them anew
    return _assigned(stored(base.withColumn("u", F.monotonically_increasing_id()), "places"), limit_bytes).drop("u")


def _assigned(base: DataFrame, limit_bytes: int) -> DataFrame:
    """``assign`` of numbered rows (rid, id, n_bytes, h, u), with their number ``u``."""
    more = F.lpad(F.bin(F.shiftrightunsigned(F.xxhash64("u"), 64 - BITS)), BITS, "0")
    left = base.withColumn("bits", F.concat("h", more)).drop("h")
    total = base.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(2 * BITS, math.ceil(math.log2(max(1, total / limit_bytes))) + 4)
    placed = []
    while True:
        cells = left.withColumn("cell", F.expr(f"substring(bits, 1, {high})"))
        hist = cells.groupBy("cell").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
        found = stored(_levels(hist, low, high, limit_bytes), "directory")
        placed.append(cells.join(found.where("depth is not null"), "cell"))
        if high == 2 * BITS or found.where("depth is null").isEmpty():
            break
        left = cells.join(found.where("depth is null").select("cell"), "cell").drop("cell")
        low, high = high + 1, min(2 * BITS, high + 8)
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out.select("u", "rid", "id", "n_bytes", F.expr("substring(bits, 1, depth)").alias("shard"), F.col("depth").cast("int").alias("depth"), "shard_bytes")


def _zstd(rows: DataFrame, back: bool = False) -> DataFrame:
    """``rows`` with their column ``text`` compressed row by row, or ``back`` as text; nulls stay null."""

    def run(batches):
        pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        one = (lambda t: unpack.decompress(t).decode("utf-8", "surrogatepass")) if back else (lambda t: pack.compress(t.encode("utf-8", "surrogatepass")))
        for b in slices(batches):
            text = pa.array([None if t is None else one(t) for t in b["text"].to_pylist()], pa.string() if back else pa.binary())
            yield pa.RecordBatch.from_arrays([text if f.name == "text" else b[f.name] for f in b.schema], names=b.schema.names)

    kind = T.StringType() if back else T.BinaryType()
    return rows.mapInArrow(run, T.StructType([T.StructField(f.name, kind if f.name == "text" else f.dataType) for f in rows.schema.fields]))


def write_shards(docs: DataFrame, limit_bytes: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the texts as Parquet, one folder per shard (``shard=``; the empty prefix is ``root``), as (row, text): see
    ``packed`` for ``row``, so no input column can clash. Shards are those of ``assign``; a row goes to its own
    one by its number, so rows that are repeated are split like others. A shard is written by one task. Texts are
    compressed while they are stored and moved, and in the files. An empty table gives no folder, and none is read back.
    """
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = packed(docs, text_col).withColumn("rid", row_key(f"row.`{id_col}`", "text")).withColumn("n_bytes", n)
    rows = stored(_zstd(rows.withColumn("u", F.monotonically_increasing_id())), "numbered")
    base = rows.select("rid", F.col(f"row.`{id_col}`").alias("id"), "n_bytes", place_bits(f"row.`{id_col}`").alias("h"), "u")
    where = _assigned(stored(base, "places"), limit_bytes).select("u", F.when(F.col("shard") == "", "root").otherwise(F.col("shard")).alias("shard"))
    out = _zstd(rows.select("row", "text", "u").join(where, "u").drop("u").repartition("shard"), back=True)
    out.write.option("compression", "zstd").partitionBy("shard").parquet(path)


def read_shards(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(row, text, n_bytes, shard, depth, shard_bytes): the rows that ``write_shards`` wrote of a table like ``docs``, with
    the bytes of each shard as read back."""
    kind = packed(docs, text_col).withColumn("shard", F.lit("")).schema
    rows = docs.sparkSession.read.schema(kind).parquet(path).withColumn("shard", F.when(F.col("shard") == "root", "").otherwise(F.col("shard")))
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    sizes = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return rows.join(sizes, "shard").select("row", "text", "n_bytes", "shard", F.length("shard").alias("depth"), "shard_bytes")
