"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import math
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import delete, shared_folder
from ..sources.shipping import ship


#: Bytes and rows that go to a Python worker at a time while a table is written: workers hold a few copies of a batch.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2_000
_BYTES, _ROWS = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bounds the batches of Python workers by bytes; the session's own settings come back afterwards."""
    held = {k: spark.conf.get(k) for k in (_BYTES, _ROWS)}
    try:
        spark.conf.set(_BYTES, str(BATCH_BYTES))
        if not 0 < int(held[_ROWS]) <= BATCH_ROWS:
            spark.conf.set(_ROWS, str(BATCH_ROWS))
        yield
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def release() -> None:
    """Gives memory that this process no longer needs back to the system."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps what it likes
        pass


def tidy(run: Callable) -> Callable:
    """``run``, a function of an iterator of batches, that releases memory when its task ends."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


#: Share of the driver's heap that may be committed before it is cleaned, and seconds between two cleanings.
HEAP_SHARE, REST_S = 0.45, 3
_rested = [0.0]


def rest(spark: SparkSession) -> None:
    """Gives memory of the driver back to the system if its heap has grown.

    Plans that are done hold broadcast relations and metrics until they are collected, and the heap
    grows to its bound before that: a plan of many small jobs would fill it beside all that a driver
    holds outside its heap. A full collection lets the heap shrink again.
    """
    jvm = spark.sparkContext._jvm
    runtime = jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() <= HEAP_SHARE * runtime.maxMemory() or time.monotonic() < _rested[0] + REST_S:
        return
    gc.collect()  # frames of Python hold plans of the driver
    jvm.java.lang.System.gc()
    _rested[0] = time.monotonic()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; only Spark opens it, so any store Spark can read will do."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the shared folder, which cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark = spark
        self.base = f"{shared_folder(spark)}/weftlink-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        atexit.register(self.clear)

    def path(self, name: str) -> str:
        """A folder for ``name``, dropped with the tables."""
        self.names.add(name)
        return f"{self.base}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a reader of the written table."""
        path = self.path(name)
        with small_batches(self.spark):
            df.write.parquet(path)
        rest(self.spark)
        return self.spark.read.schema(_nullable(df.schema)).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            delete(self.spark, f"{self.base}/{name}")
            self.names.discard(name)

    def only(self, *names: str) -> None:
        """Delete all tables but these, which a result still reads; they go when the process ends."""
        self.drop(*(self.names - {*names}))

    def clear(self) -> None:
        try:
            delete(self.spark, self.base)
        except Exception:  # the session has ended; the store's own expiry takes over
            pass


def running_total(rows: DataFrame, order: list[str], value: str, out: str, scratch: Scratch, name: str) -> DataFrame:
    """``rows``, one for each ``order``, with ``out``: the sum of ``value`` over all rows before.

    Ranges of the order are summed apart; one sum a range, at most one for each shuffle partition,
    meets in one task.
    """
    ranged = scratch.keep(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), name)
    sums = ranged.groupBy("__part").agg(F.sum(value).alias("__sum"))
    before = lambda over: over.rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("__part", F.coalesce(F.sum("__sum").over(before(Window.orderBy("__part"))), F.lit(0)).alias("__start"))
    within = F.coalesce(F.sum(value).over(before(Window.partitionBy("__part").orderBy(*order))), F.lit(0))
    return ranged.withColumn("__within", within).join(F.broadcast(starts), "__part").withColumn(out, F.col("__start") + F.col("__within")).drop("__part", "__start", "__within")


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


#: A key is hot if it holds more than this share of the rows; so at most 1/HOT_SHARE keys are hot.
HOT_SHARE = 1 / 2000
HOT_LEAST = 1000


def hot_bound(n_rows: int) -> int:
    """Rows beyond which a key counts as hot."""
    return max(HOT_LEAST, math.ceil(n_rows * HOT_SHARE))


def attach(rows: DataFrame, facts: DataFrame, key: str, weight: str, n_rows: int, spread: str) -> DataFrame:
    """``rows`` left-joined to ``facts``, which has one row per ``key``, without a hot task.

    ``weight`` in ``facts`` is the number of rows of its key. Keys above ``hot_bound`` are at
    most ``1 / HOT_SHARE`` many, a proven size, and are broadcast; the others are shuffled and
    no task gets more than the bound of any one of them. Rows that already found a hot key are
    dealt out by ``spread`` in the second join, where they match nothing.
    """
    bound = hot_bound(n_rows)
    names = [c for c in facts.columns if c != key]
    hot = facts.where(F.col(weight) > bound).select(key, *[F.col(c).alias(f"__h_{c}") for c in names])
    cold = facts.where(F.col(weight) <= bound).select(F.col(key).alias("__key"), *[F.col(c).alias(f"__c_{c}") for c in names])
    found = F.col(f"__h_{weight}").isNotNull()
    kind = dict(facts.dtypes)[key]
    salted = F.xxhash64(F.col(spread))
    salted = F.unhex(F.hex(salted)) if kind == "binary" else F.concat(F.lit("~"), salted.cast("string")) if kind == "string" else salted.cast(kind)
    probe = F.when(found, salted).otherwise(F.col(key))
    both = rows.join(F.broadcast(hot), key, "left").withColumn("__probe", probe).withColumn("__hot", found)
    both = both.join(cold, (F.col("__probe") == F.col("__key")) & ~F.col("__hot"), "left")
    return both.select(*rows.columns, *[F.when(F.col("__hot"), F.col(f"__h_{c}")).otherwise(F.col(f"__c_{c}")).alias(c) for c in names])


#: Rows of a narrow table (about 100 bytes each) up to which it is broadcast.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def keep_rows(docs: DataFrame, judged: DataFrame, text: str, id: str) -> DataFrame:
    """``docs`` without the rows that ``judged`` (__id, __sha, kept) drops; rows it lacks stay.

    Rows that repeat both id and text are told apart by nothing: if one of them is to stay, one does.
    """
    gone = judged.where("not kept").select("__id", "__sha").distinct()
    marked = docs.withColumn("__text_sha", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    same = lambda keys: marked[id].eqNullSafe(keys["__id"]) & (marked["__text_sha"] == keys["__sha"])
    listed = small(gone)
    left = marked.join(listed, same(listed), "left_anti")
    back = judged.where("kept").select("__id", "__sha").intersect(gone)
    if back.take(1):
        back = small(back)
        left = left.unionByName(marked.join(back, same(back), "left_semi").dropDuplicates([id, "__text_sha"]))
    return left.select(*docs.columns)


def drop_texts(docs: DataFrame, judged: DataFrame, text: str, scratch: Scratch) -> DataFrame:
    """``docs`` without the rows whose text is one of ``judged`` (__sha, a SHA-256); a null text counts as empty."""
    gone = scratch.keep(judged.select("__sha").distinct(), "gone")
    scratch.only("gone")
    marked = docs.withColumn("__sha", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return marked.join(small(gone), "__sha", "left_anti").select(*docs.columns)
