"""Operator 9: length-delimited binary records of token ids, with a separate offset index.

File format, one file per partition, documents in ascending id order over all files: each record is
the payload's length (8 bytes, little-endian), a masked checksum of these 8 bytes (4), the payload,
and a masked checksum of the payload (4). The payload is the document's ids as little-endian unsigned
integers of 2 bytes (4 where an id needs it). The checksum is CRC-32C, masked by a rotation of 15
bits and a constant, so that any reader of this widely used framing can read the files.

The index is a Parquet table (file, ordinal, id, offset, size, n_tokens, local_start): readers that
shuffle take any subset of it in any order. A file's name carries an attempt id and only the index
of the attempt that Spark committed names it; what a lost executor or a second attempt wrote is
never read.
"""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import LAST, runs
from ledgerline.llm.tokens import unit_encoder

# The Castagnoli polynomial (reflected) and the mask's constant.
POLY, MASK = 0x82F63B78, 0xA282EAD8
_LANE = 256  # bytes of a payload that one vector step covers


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(POLY), t >> np.uint32(1))
    return t


_BYTE = _byte_table()


def _advance(n: int) -> np.ndarray:
    """2 x 65536 tables that advance a checksum register over ``n`` zero bytes, by its halves."""
    reg = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(n):
        reg = _BYTE[reg & np.uint32(255)] ^ (reg >> np.uint32(8))
    out = np.zeros((2, 1 << 16), dtype=np.uint32)
    for k in range(2):
        for bit in range(16):
            out[k] ^= np.where(np.arange(1 << 16) >> bit & 1, reg[16 * k + bit], np.uint32(0)).astype(np.uint32)
    return out


_WORD, _SKIP = _advance(4), _advance(_LANE)


def _step(tables: np.ndarray, reg: np.ndarray) -> np.ndarray:
    return tables[0][reg & np.uint32(0xFFFF)] ^ tables[1][reg >> np.uint32(16)]


def crc32c_many(parts: list) -> np.ndarray:
    """CRC-32C of many byte strings.

    Each is cut into lanes of ``_LANE`` bytes; all lanes of all strings advance together, four bytes
    per step, from a zero register, and the lanes of a string are then joined from the left by
    advancing the register over a lane of zeros. Strings are padded at their left, where zero bytes
    leave a zero register alone; the standard start value goes into the first four real bytes.
    """
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    lanes = np.maximum(1, -(-size // _LANE))
    last = np.cumsum(lanes)
    first = last - lanes
    buf = np.zeros(int(last[-1]) * _LANE if len(last) else 0, dtype=np.uint8)
    view = memoryview(buf)
    for end, p in zip((last * _LANE).tolist(), parts):
        view[end - len(p) : end] = p
    put = last * _LANE - size
    for k in range(4):
        buf[put[size > k] + k] ^= np.uint8(255)
    grid = np.ascontiguousarray(buf.view("<u4").reshape(-1, _LANE // 4).T)
    reg = np.zeros(grid.shape[1], dtype=np.uint32)
    for row in grid:
        reg = _step(_WORD, reg ^ row)
    out = reg[first]
    for step in range(1, int(lanes.max()) if len(lanes) else 0):
        more = np.flatnonzero(lanes > step)
        out[more] = _step(_SKIP, out[more]) ^ reg[first[more] + step]
    out = out ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size < 4).tolist():  # too short to hold the start value
        r = 0xFFFFFFFF
        for x in bytes(parts[i]):
            r = int(_BYTE[(r ^ x) & 255]) ^ (r >> 8)
        out[i] = r ^ 0xFFFFFFFF
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK)


def frame(ids: np.ndarray, counts: np.ndarray, width: int) -> tuple[bytes, np.ndarray]:
    """(records as one byte string, size of each) of documents given by their concatenated ids."""
    body = memoryview(ids.astype("<u2" if width == 2 else "<u4").tobytes())
    size = counts.astype(np.int64) * width
    ends = np.cumsum(size).tolist()
    bodies = [body[e - n : e] for e, n in zip(ends, size.tolist())]
    head = memoryview(size.astype("<u8").tobytes())
    heads = [head[i : i + 8] for i in range(0, len(head), 8)]
    check = [memoryview(masked(crc32c_many(x)).astype("<u4").tobytes()) for x in (heads, bodies)]
    out = [x for i, (h, b) in enumerate(zip(heads, bodies)) for x in (h, check[0][4 * i : 4 * i + 4], b, check[1][4 * i : 4 * i + 4])]
    return b"".join(out), size + 16


def unframe(data: bytes, width: int) -> list[np.ndarray]:
    """The ids of each of some adjoining records; raises on a bad length or checksum."""
    view, at, heads, bodies, checks = memoryview(data), 0, [], [], []
    while at < len(view):
        n = int.from_bytes(view[at : at + 8], "little")
        if at + n + 16 > len(view):
            raise ValueError("a record's length is damaged")
        heads.append(view[at : at + 8])
        bodies.append(view[at + 12 : at + 12 + n])
        checks.append((view[at + 8 : at + 12], view[at + 12 + n : at + 16 + n]))
        at += n + 16
    for k, parts in enumerate((heads, bodies)):
        if masked(crc32c_many(parts)).astype("<u4").tobytes() != b"".join(c[k] for c in checks):
            raise ValueError("a record's checksum does not match")
    return [np.frombuffer(b, dtype="<u2" if width == 2 else "<u4") for b in bodies]


def _open(path: str):
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = 32 << 20) -> DataFrame:
    """Encode every document, append ``end_id``, write the record files and the index under ``path``
    (a folder all executors share); returns the index.

    Files are ranges of ids of about ``file_bytes`` of text, so a reader can stream them in order.
    A null text is empty (its record is the end id alone). Rows with a null id come last; rows that
    share an id stay next to each other, ordered by text, and repeated rows each get a record. Extra
    columns are ignored. An empty table writes an empty index.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    src = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / file_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")) if total > file_bytes else 1)
    src = src.withColumn("o", F.coalesce("id", F.lit(LAST)))
    src = src.repartitionByRange(n, "o").sortWithinPartitions("o", "text").select("id", "text")

    def run(batches):
        enc = unit_encoder(spec.value)
        width = 2 if max(end_id, enc.tok.get_vocab_size(with_added_tokens=True)) < 1 << 16 else 4
        ordinal = TaskContext.get().partitionId()
        name = f"part-{ordinal:06d}-{uuid.uuid4().hex}.rec"
        fs, base = _open(path)
        out, offset, start = None, 0, 0
        for b in batches:
            for rows in runs(zip(b["id"].to_pylist(), b["text"].to_pylist()), lambda r: len(r[1]), 1 << 20):
                ids, counts = enc.encode([t for _, t in rows])
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
                data, sizes = frame(ids, counts, width)
                if out is None:
                    fs.create_dir(f"{base}/data", recursive=True)
                    out = fs.open_output_stream(f"{base}/data/{name}")
                out.write(data)
                k = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * k),
                        pa.array(np.full(k, ordinal, np.int32)),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array(offset + np.cumsum(sizes) - sizes),
                        pa.array(sizes),
                        pa.array(counts.astype(np.int64)),
                        pa.array(start + np.cumsum(counts) - counts),
                        pa.array(np.full(k, width, np.int32)),
                    ],
                    names=["file", "ordinal", "id", "offset", "size", "n_tokens", "local_start", "width"],
                )
                offset += len(data)
                start += int(counts.sum())
        if out is not None:
            out.close()

    kind = "file string, ordinal int, id long, offset long, size long, n_tokens long, local_start long, width int"
    src.mapInArrow(run, kind).write.parquet(f"{path}/index")
    return spark.read.schema(kind).parquet(f"{path}/index")


def read_records(index: DataFrame, path: str, read_bytes: int = 16 << 20) -> DataFrame:
    """(file, offset, id, n_tokens, ids_crc32, local_start) of the records that ``index`` names.

    Any subset of the index, in any order, will do; neighbouring records are read together, at most
    about ``read_bytes`` at a time. Both checksums are checked. ``ids_crc32``: CRC-32 of the ids as
    little-endian unsigned 32-bit integers. Raises where a record is damaged.
    """

    def run(batches):
        for b in batches:
            col = {c: b[c].to_numpy(zero_copy_only=False) for c in ("file", "offset", "size", "local_start", "width")}
            order = np.lexsort((col["offset"], col["file"]))
            for near in runs(order.tolist(), lambda i: int(col["size"][i]), read_bytes):
                for name in dict.fromkeys(col["file"][near].tolist()):
                    at = np.array([i for i in near if col["file"][i] == name])
                    fs, base = _open(path)
                    with fs.open_input_file(f"{base}/data/{name}") as f:
                        off, size = col["offset"][at], col["size"][at]
                        cut = np.flatnonzero(np.concatenate(([True], off[1:] != off[:-1] + size[:-1])))
                        ends = np.append(cut[1:], len(at)) - 1
                        spans = [f.read_at(int(off[e] + size[e] - off[s]), int(off[s])) for s, e in zip(cut, ends)]
                    ids = [x for part in spans for x in unframe(part, int(col["width"][at[0]]))]
                    counts = [len(x) for x in ids]
                    crc = [zlib.crc32(x.astype("<u4").data) for x in ids]
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [b["file"].take(take), b["offset"].take(take), b["id"].take(take), pa.array(counts, pa.int64()), pa.array(crc, pa.int64()), b["local_start"].take(take)],
                        names=["file", "offset", "id", "n_tokens", "ids_crc32", "local_start"],
                    )

    cols = index.select("file", "offset", "size", "id", "local_start", "width")
    return cols.mapInArrow(run, "file string, offset long, id long, n_tokens long, ids_crc32 long, local_start long")


def with_starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """``records`` with ``start``: the ids of all documents before. The files' totals (one row per
    file) are summed in file order; a record adds its place inside its file."""
    files = index.groupBy("file", "ordinal").agg(F.sum("n_tokens").alias("t"))
    before = Window.orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    return records.join(files, "file").withColumn("start", F.col("base") + F.col("local_start"))
