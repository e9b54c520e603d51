"""The benchmark scenario built in memory from the driver tables: landing batches -> staging ->
core -> phone mart -> transaction mart -> report. Used by the registered queries, the bench and
the flagship entry point; ``ledgerline.plans.job`` runs the same steps against stored tables."""

from __future__ import annotations

import functools
import threading

from pyspark.sql import DataFrame, SparkSession

from ..operators.hierarchy import user_manager_phones
from ..operators.mart import incremental_detail, report, transaction_detail
from ..operators.staging import shred
from ..operators.upsert import upsert
from ..session import configure, scratch_path
from ..sources import adapters as A
from ..sources.specs import STORES, TRANSACTIONS, USERS
from .core import core_full, core_merge


def _memo(fn):
    """Build each DataFrame of a scenario once: later calls reuse the same plan object, so Spark
    sees one subtree (and can reuse its exchanges) instead of re-analysed copies."""

    @functools.wraps(fn)
    def wrapper(self, *args):
        key = (fn.__name__, args)
        with self._lock:
            if key not in self._memo:
                self._memo[key] = fn(self, *args)
            return self._memo[key]

    return wrapper


def _stored(fn):
    """Like ``_memo``, but the model is written once as a Parquet table in the shared checkpoint
    folder and read back, as a scheduled run stores each model. Downstream plans then start from a
    scan (bounded lineage, column pruning and filter pushdown, no recomputation after an executor
    loss) instead of re-deriving the whole chain from the landing documents."""

    @functools.wraps(fn)
    def wrapper(self, *args):
        key = (fn.__name__, args)
        with self._lock:
            if key in self._memo:
                return self._memo[key]
            df = fn(self, *args)
            if self.materialize:
                df = self._store(df, fn.__name__ + "".join(f"_{a}" for a in args))
            self._memo[key] = df
            return df

    return wrapper


class Scenario:
    """Lazily built DataFrames of the two-batch scenario (nothing is executed until an action)."""

    _instances: dict = {}
    _class_lock = threading.Lock()

    def __new__(cls, spark: SparkSession, sf_dir: str, cycle: bool = False, materialize: bool = True):
        key = (id(spark), sf_dir, cycle, materialize)
        with cls._class_lock:
            inst = cls._instances.get(key)
            if inst is not None:
                return inst
            inst = super().__new__(cls)
            inst._memo = {}
            inst._lock = threading.RLock()
            inst.root = None
            cls._instances[key] = inst
            return inst

    def __init__(self, spark: SparkSession, sf_dir: str, cycle: bool = False, materialize: bool = True):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.cycle = cycle
        self.materialize = materialize
        with self._lock:
            if materialize and self.root is None:
                self.root = scratch_path(self.spark, "scenario")

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    @classmethod
    def reset(cls) -> None:
        """Forget all built scenarios (the bench times every query from the landing documents)."""
        cls._instances.clear()

    # -- staging (run 1 stages batch 1, run 2 stages batch 2)
    # -- landing (the CDC feed's stored documents)
    @_stored
    def landing(self, table: str, batch: int) -> DataFrame:
        return self._documents(table, batch)

    def documents(self, table: str, batch: int) -> DataFrame:
        """The documents of a batch for a job that lands them itself, once: not written here on the way."""
        with self._lock:
            return self._memo.get(("landing", (table, batch))) or self._documents(table, batch)

    def _documents(self, table: str, batch: int) -> DataFrame:
        docs = {
            "users": lambda b: A.users_landing(self.spark, self.sf_dir, b, self.cycle),
            "stores": lambda b: A.stores_landing(self.spark, self.sf_dir, b),
            "transactions": lambda b: A.txns_landing(self.spark, self.sf_dir, b),
        }[table](batch)
        # Shredding costs CPU per document, not per byte: land the documents in enough files for
        # every core to take a share (a CDC sink writes many files; AQE would coalesce a small
        # join output into one or two).
        return docs.repartition(2 * self.spark.sparkContext.defaultParallelism)

    # -- staging (run 1 stages batch 1, run 2 stages batch 2). Each staged batch feeds exactly one
    # core build here, so it is kept as a plan over the stored landing (the shred runs inside the
    # core's first stage, with VARIANT paths pushed into the landing scan) instead of being written.
    @_memo
    def staged(self, table: str, batch: int, columns: tuple[str, ...] = ()) -> DataFrame:
        """``columns``: only these payload columns, in all rows. Spark prunes columns but not the values that a document's one
        walk takes, so who reads a few says which."""
        spec = {"users": USERS, "stores": STORES, "transactions": TRANSACTIONS}[table]
        others = tuple(f.name for f in spec if columns and f.name not in columns)
        return shred(self.landing(table, batch), spec, A.RUN1 if batch == 1 else A.RUN2, drop_columns=others)

    @_memo
    def staged_all(self, table: str, columns: tuple[str, ...] = ()) -> DataFrame:
        return self.staged(table, 1, columns).unionByName(self.staged(table, 2, columns))

    # -- core
    @_stored
    def core1(self, table: str) -> DataFrame:
        spec = {"users": USERS, "stores": STORES, "transactions": TRANSACTIONS}[table]
        return core_full(self.staged(table, 1), spec, A.RUN1, keep_source_stamp=(table == "stores"))

    @_memo
    def core2(self, table: str) -> DataFrame:
        """Transactions are merged when they are read: core 1 and increment are both stored whole, and the marts read a few
        of the 131 columns, which alone pass the merge. Users and stores are small, read many times, and written."""
        spec = {"users": USERS, "stores": STORES, "transactions": TRANSACTIONS}[table]
        stored = (lambda inc: self._store(inc, f"core_increment_{table}")) if self.materialize else None
        merged = core_merge(self.core1(table), self.staged(table, 2), spec, A.RUN2, keep_source_stamp=(table == "stores"), stored=stored)
        return self._store(merged, f"core2_{table}") if self.materialize and table != "transactions" else merged

    @_stored
    def core_all(self, table: str) -> DataFrame:
        """One full refresh over both batches, stamped at run 2."""
        spec = {"users": USERS, "stores": STORES, "transactions": TRANSACTIONS}[table]
        return core_full(self.staged_all(table), spec, A.RUN2, keep_source_stamp=(table == "stores"))

    # -- marts
    @_stored
    def phones1(self) -> DataFrame:
        return user_manager_phones(self.core1("users"), A.RUN1)

    @_stored
    def phones2(self) -> DataFrame:
        return user_manager_phones(self.core2("users"), A.RUN2)

    @_stored
    def phones_all(self) -> DataFrame:
        return user_manager_phones(self.core_all("users"), A.RUN2)

    @_stored
    def mart_full(self) -> DataFrame:
        """Full refresh of the mart after both batches (run 2)."""
        return transaction_detail(
            self.core_all("transactions"), self.core_all("stores"), self.phones_all(), A.AS_OF, A.RUN2
        )

    @_stored
    def mart1(self) -> DataFrame:
        return transaction_detail(self.core1("transactions"), self.core1("stores"), self.phones1(), A.AS_OF, A.RUN1)

    @_memo
    def mart_increment(self) -> DataFrame:
        return self._mart_increment()

    @_memo
    def mart_merged(self) -> DataFrame:
        return upsert(self.mart1(), self.mart_increment(), "transid")

    def _mart_increment(self, mart1: DataFrame | None = None) -> DataFrame:
        m1 = mart1 if mart1 is not None else self.mart1()
        return incremental_detail(self.core2("transactions"), self.core2("stores"), self.phones2(), m1, A.AS_OF, A.RUN2)


    @_memo
    def report(self) -> DataFrame:
        return report(self.mart_full())
