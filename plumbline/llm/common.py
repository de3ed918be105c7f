"""Session, storage and hashing helpers that the text operators share."""

from __future__ import annotations

import ctypes
import time
import uuid
from functools import cache

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark so that any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: An Arrow batch has at most so many rows and about so many bytes; a longer text is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20


def tune(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session, so that a batch of long texts fits a Python worker; limits only fall.

    Spark takes the limits when a result is run, after its operator has returned it, so they stay with the session.
    """
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        if not 0 < int(spark.conf.get(key).rstrip("bB")) <= most:
            spark.conf.set(key, str(most))


#: glibc's names for the size of free memory at the top that goes back, and of a block that is mapped by itself.
_TRIM, _MAP = -1, -3


@cache
def keep_freed(top: int = 64 << 20, block: int = 32 << 20) -> None:
    """Let this worker use freed memory again, up to some bytes, instead of giving it back after every array.

    Loops over many arrays of a megabyte spend a fifth of their time on new pages otherwise. Other C libraries than
    glibc keep their ways.
    """
    try:
        mallopt = ctypes.CDLL(None).mallopt
    except (OSError, AttributeError, TypeError):
        return
    mallopt(_TRIM, top)
    mallopt(_MAP, block)


@cache
def _trimmer():
    """glibc's malloc_trim, or something that does nothing."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError, TypeError):
        return lambda _: 0


def give_back() -> None:
    """Return memory that this worker has freed to the machine; workers stay alive between tasks with what they hold."""
    pa.default_memory_pool().release_unused()
    _trimmer()(0)


#: The driver's JVM is asked to return memory no more often than every so many seconds; when it last was.
EVERY, _last = 5.0, [-1e9]


def settle(spark: SparkSession) -> bool:
    """Return memory that the driver's Python and JVM have freed to the machine; whether the JVM did now.

    The hundreds of threads that a driver runs jobs with leave freed blocks in as many as eight pools a core of the C
    library, which keeps them. HotSpot has a command against that since 17.0.9; other JVMs keep their ways.
    """
    give_back()
    if time.monotonic() - _last[0] < EVERY:
        return False
    _last[0] = time.monotonic()
    context = spark.sparkContext
    jvm = context._jvm
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        given = context._gateway.new_array(jvm.java.lang.Object, 4)  # the command takes nothing: no values, no types
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        call.invoke(server, given)
    except Py4JError:
        return False
    return True


def unused(name: str, columns: list[str]) -> str:
    """The name, with as many underscores behind it as it takes to be none of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The URI of the folder that the driver and all executors share: the one the cluster names in spark.checkpoint.dir.

    Only where that is unset and all runs on one machine, as in tests, a folder below the warehouse is taken.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    path = context._jvm.org.apache.hadoop.fs.Path(named.rstrip("/"))
    return str(path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path))


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing is created."""
    return f"{shared_dir(spark)}/plumbline/{name}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, whatever store it is in."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear(spark: SparkSession) -> None:
    """Delete all that the text operators have left in the shared folder. Results not yet written are lost with it."""
    drop_dir(spark, f"{shared_dir(spark)}/plumbline")


class Scratch:
    """Tables written to the shared folder to cut lineage. A lost executor costs a re-read, never a recomputation.

    drop() deletes a table that nothing still to run reads.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, fresh_dir(spark, name)
        self.paths: dict[int, str] = {}
        self.n = 0

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/t{self.n}"
        self.n += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.__dict__.setdefault("_keep", []).append(out)
        settle(self.spark)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if path := self.paths.pop(id(t), None):
                drop_dir(self.spark, path)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on uint64 values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX_A
        x = (x ^ (x >> np.uint64(27))) * MIX_B
        return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as doubles in [0, 1)."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53
