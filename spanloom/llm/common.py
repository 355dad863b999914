"""What the operators share: tables in the cluster's shared folder, connected components, workers' memory, table reading."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import threading
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_made: list[tuple[SparkSession, str]] = []
_local: dict[str, str] = {}
_scope = threading.local()

#: Caches that operators keep in Python workers: owner -> what empties them; and the owner whose cache is in use.
_caches: dict = {}
_using: list[str] = []

#: While a table is written, rows and bytes of an Arrow batch at most: texts are long, and a batch is held by the JVM as
#: well as by the worker.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def _libc():
    with contextlib.suppress(OSError):
        return ctypes.CDLL("libc.so.6")
    return None


def release_memory() -> None:
    """Give what is free back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if (libc := _libc()) is not None and hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def _lean() -> None:
    """Large arrays get pages of their own, which go back to the system once they are free."""
    if (libc := _libc()) is not None and hasattr(libc, "mallopt"):
        for option, value in ((-3, 1 << 18), (-1, 1 << 18), (-8, 2)):  # mmap threshold, trim threshold, arenas
            libc.mallopt(option, value)
    pa.set_memory_pool(pa.system_memory_pool())


def holding(owner: str, clear=lambda: None) -> None:
    """Called on a worker by an operator before its work: the caches of all others are emptied, their memory freed.

    Workers are reused by later stages, so several operators' caches would add up.
    """
    if not _using:
        _lean()
    _caches[owner] = clear
    if _using == [owner]:
        return
    _using[:] = [owner]
    for other, empty in _caches.items():
        if other != owner:
            empty()
    release_memory()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def local_table(spark: SparkSession, columns: dict, schema: str) -> DataFrame:
    """A small table of the driver's as a DataFrame; it travels as Arrow, so no Python worker starts for it."""
    kinds = T.StructType.fromDDL(schema)
    if not len(next(iter(columns.values()))):
        return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in kinds))
    return spark.createDataFrame(pa.table({f.name: pa.array(columns[f.name]) for f in kinds}), kinds)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder; any other master is refused, as executors could not
    see a folder of the driver's machine.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local:
        _local[sc.applicationId] = tempfile.mkdtemp(prefix="spanloom-")
    return "file://" + _local[sc.applicationId]


class Scratch:
    """Tables and broadcasts of one run of an operator; see `scratch`."""

    def __init__(self):
        self.tables: list[tuple[SparkSession, str]] = []
        self.broadcasts: list = []

    def share(self, spark: SparkSession, value):
        """A broadcast that is destroyed at the end."""
        self.broadcasts.append(spark.sparkContext.broadcast(value))
        return self.broadcasts[-1]

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write df as a table that outlives this scratch: the operator's result."""
        made = materialize(df, label)
        self.leave(1)
        return made

    def leave(self, n: int) -> None:
        """The last ``n`` tables outlive this scratch."""
        _outer(self).extend(self.tables[-n:])
        del self.tables[-n:]


def _outer(scratch: Scratch) -> list:
    at = _scope.stack.index(scratch)
    if at:
        return _scope.stack[at - 1].tables
    if not _made:
        atexit.register(_sweep)
    return _made


@contextlib.contextmanager
def scratch():
    """Tables that are written inside are deleted at the end, but for those that keep() wrote, and broadcasts destroyed.

    Nothing that is read later may depend on them, so an operator returns what keep() gives, or collected values.
    """
    if not hasattr(_scope, "stack"):
        _scope.stack = []
    here = Scratch()
    _scope.stack.append(here)
    try:
        yield here
    finally:
        _scope.stack.pop()
        for b in here.broadcasts:
            with contextlib.suppress(Exception):
                b.destroy()
        for spark, path in here.tables:
            delete(spark, path)


@contextlib.contextmanager
def _small_batches(spark: SparkSession):
    """BATCHES hold for the plans that start inside; a session that asks for less keeps its own."""
    before = {}
    for name, value in BATCHES.items():
        before[name] = spark.conf.get(name, None)
        spark.conf.set(name, value)
    rows = before["spark.sql.execution.arrow.maxRecordsPerBatch"]
    if rows and 0 < int(rows) < int(BATCHES["spark.sql.execution.arrow.maxRecordsPerBatch"]):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write df as Parquet and read it back. zstd keeps the tables small, and small row groups the writers' buffers."""
    spark = df.sparkSession
    with _small_batches(spark):
        df.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df in the shared folder and read it back: lineage ends there and survives lost executors.

    The table goes at the end of the `scratch` it is written in, or else when the Python process ends.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    made = write_table(df, path)
    if stack := getattr(_scope, "stack", None):
        stack[-1].tables.append((df.sparkSession, path))
    else:
        if not _made:
            atexit.register(_sweep)
        _made.append((df.sparkSession, path))
    return made


def delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        if spark.sparkContext._jsc is None:
            raise RuntimeError("the session has ended")
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        return
    if path.startswith("file://"):
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def _sweep() -> None:
    for spark, path in _made:
        delete(spark, path)
    for path in _local.values():
        shutil.rmtree(path, ignore_errors=True)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

    edges: columns a, b (long); loops and nulls are ignored, either order and repeats are fine. Returns (node, root)
    for every node that has an edge to another one; root is the smallest node of the component.

    All steps are joins and partial aggregates on DataFrames. The minimum of each node is a table of its own, so both
    sides of a join are plain shuffles and Spark can split the rows of a hub. Nothing is gathered per node.
    """
    now = (
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )
    now = materialize(now, "edges")
    seen = _print_of(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "least")
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
            .distinct()
        )
        large = materialize(large, "large-stars")
        lower = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")), "lower")
        small = (
            large.join(lower, "hi")
            .where("lo > m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(lower)
            .distinct()
        )
        now = materialize(small, "stars")
        before, seen = seen, _print_of(now)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        now.select("lo", "lo").distinct()
    )


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return row["n"], row["x"]
