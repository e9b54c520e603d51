"""Tables as plain Parquet folders, kept by Spark's own writers (O-05, O-06, O-11, O-14, O-22 on files).

Three ways to write, all of them ``DataFrameWriter`` calls:

* ``append``: rows of one load go to the partition ``load_id=<id>`` with dynamic partition overwrite, so a load
  that is run again replaces itself and no other; a load without rows writes no folder.
* ``replace``: the whole table anew (full refresh).
* ``merge``: an upsert on a key into a table partitioned by ``_bucket = pmod(xxhash64(key), n)``. The source is
  written once; the buckets it touches are read by partition pruning, merged, and put back with
  ``partitionOverwriteMode=dynamic``. Files of other buckets are neither read nor written.

Spark moves the new files of a partition in when the write commits, so a job that fails before leaves the
table as it was. A merge stopped while it commits is mended by running it again: merging a source twice
gives what merging it once gives. Readers that need one state for long should read between builds.

How many buckets a table has stands in the Parquet schema, as metadata of its bucket key column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..operators.checks import CheckedWrite
from ..operators.staging import max_value
from ..operators.upsert import assert_unique_source, upsert
from ..session import scratch_path

BUCKET, LOAD = "_bucket", "load_id"
_BUCKETS = "ledgerline.buckets"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def bucket_of(key: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(n)).cast("int")


def newest_partition(df: DataFrame, partition_col: str) -> DataFrame:
    """The rows of the highest value of a partition column.

    The maximum is taken over file listings: the scan reads no column (``ReadSchema`` is empty), and the value is a
    literal afterwards, so the second scan opens the files of one partition.
    """
    newest = df.agg(F.max(partition_col).alias("m")).first()["m"]
    return df.where(F.lit(False)) if newest is None else df.where(F.col(partition_col) == F.lit(newest))


def write_clustered(
    df: DataFrame, path: str, cluster_by: Sequence[str], partition_by: Sequence[str] = (), files: int | None = None, spread_by: Sequence[str] = (),
    checks: CheckedWrite | None = None,
) -> None:
    """Write ``df`` so that each file holds a narrow range of ``cluster_by`` (O-14).

    Rows are dealt by ranges (bounds sampled by Spark) and sorted within a file, so the Parquet minima and maxima
    of files and row groups hardly overlap and a filter on ``cluster_by`` skips most of them. Without ``files``
    their number follows the data, as AQE joins small ranges. ``spread_by`` (a key, say) goes on
    ordering rows equal in ``cluster_by``, so that one value with a third of all rows is cut over files too.
    """
    order = [*partition_by, *cluster_by, *spread_by]
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    rows = ranged.sortWithinPartitions(*order)
    w = (checks.watch(rows) if checks else rows).write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def save_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` with Spark's own bucketing and return the table: aggregates and joins on ``key`` then read it
    without an exchange. The table is registered in the session's catalog under a name of its own, its files
    in ``path``."""
    spark = df.sparkSession
    name = "bucketed_" + path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    # rows are dealt by the bucket first, so that each bucket has one file and not one a task
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


def _dealt(df: DataFrame, keys: Sequence[str], n: int, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Bucket i goes to task i: no two buckets share one, and each has one run of files, sorted if ``cluster_by`` asks for it.

    Otherwise no row is sorted: the writer takes a task's one bucket as it comes (``maxConcurrentOutputFileWriters``)."""
    out = df.withColumn(BUCKET, bucket_of(keys, n)).repartitionById(n, F.col(BUCKET))
    return out.sortWithinPartitions(BUCKET, *cluster_by) if cluster_by else out


class Tables:
    """The tables under one folder, by name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def raw(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table with its ``_bucket`` or ``load_id``; ``schema``, its columns, spares the look into a file."""
        if schema is None:
            return self.spark.read.parquet(self.path(name))
        return self.spark.read.schema(T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])).parquet(self.path(name))

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        return self.raw(name, schema).drop(BUCKET, LOAD)

    def exists(self, name: str) -> bool:
        try:
            return bool(self.raw(name).columns)
        except AnalysisException:  # no folder, or none with a file
            return False

    def max_of_newest_load(self, name: str, col: str, default=None):
        """``max(col)`` of the newest load: of all, where each load holds only rows beyond the earlier ones."""
        return max_value(newest_partition(self.raw(name), LOAD), col, default) if self.exists(name) else default

    def append(self, name: str, df: DataFrame, load_id: str) -> None:
        """Add the rows of load ``load_id``, or replace them if it was added before. Load ids sort in order of time."""
        w = df.withColumn(LOAD, F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        w.partitionBy(LOAD).parquet(self.path(name))

    def replace(
        self, name: str, df: DataFrame, key=None, buckets: int = 0, cluster_by: Sequence[str] = (), load_id: str = "",
        checks: CheckedWrite | None = None,
    ) -> None:
        """The table holds exactly ``df`` from now on. ``df`` may not read the table itself.

        With ``key`` the table is bucketed for ``merge``; else ``cluster_by`` deals its rows by ranges, or ``load_id``
        makes it one load. ``checks`` are counted as the rows are written."""
        if key:
            self._write_buckets(df, name, _keys(key), buckets, cluster_by, "static", checks)
            return
        if cluster_by:
            write_clustered(df, self.path(name), cluster_by, checks=checks)
            return
        df = checks.watch(df) if checks else df
        if load_id:
            w = df.withColumn(LOAD, F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "static")
            w.partitionBy(LOAD).parquet(self.path(name))
        else:
            df.write.mode("overwrite").parquet(self.path(name))

    def merge(
        self, name: str, source: DataFrame, key, cluster_by: Sequence[str] = (), checks: CheckedWrite | None = None
    ) -> list[int]:
        """Upsert ``source`` on ``key`` (update matched, insert new, delete nothing); the buckets written.

        Rows of one key in the source raise, as in a warehouse MERGE. NULL keys match nothing and are
        inserted. The list of touched buckets is bounded by their number. ``checks`` are counted over the rows
        written; the rows of the other buckets are left to them as ``rest``.
        """
        keys = _keys(key)
        target = self.raw(name)
        n = target.schema[keys[0]].metadata.get(_BUCKETS)
        if not n:
            raise ValueError(f"{name} is not bucketed on {keys}; use replace")
        columns = [c for c in target.columns if c != BUCKET]
        path = scratch_path(self.spark, "merge_source")
        source.select(*columns, bucket_of(keys, n).alias(BUCKET)).write.parquet(path)
        src = self.spark.read.parquet(path)
        keyed = F.count_if(F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
        stats = src.groupBy(BUCKET).agg(keyed.alias("keyed"), F.countDistinct(*keys).alias("distinct")).collect()
        if any(r["keyed"] != r["distinct"] for r in stats):
            assert_unique_source(src, keys)
        touched = sorted(r[BUCKET] for r in stats)
        if touched:
            old = target.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
            self._write_buckets(upsert(old, src.drop(BUCKET), keys), name, keys, n, cluster_by, "dynamic", checks)
        if checks and len(touched) < n:
            checks.rest = self.raw(name).where(~F.col(BUCKET).isin(touched)).drop(BUCKET)
        return touched

    def _write_buckets(self, df: DataFrame, name: str, keys: list[str], n: int, cluster_by: Sequence[str], mode: str, checks: CheckedWrite | None = None) -> None:
        marked = [F.col(f"`{c}`").alias(c, metadata={_BUCKETS: n}) if c == keys[0] else F.col(f"`{c}`") for c in df.columns]
        out = _dealt(df, keys, n, cluster_by).select(*marked, BUCKET)
        w = (checks.watch(out) if checks else out).write.mode("overwrite").option("partitionOverwriteMode", mode)
        w.partitionBy(BUCKET).parquet(self.path(name))
