"""Session settings and the two ways in which lineage is cut."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "millrace") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: what the cluster names in spark.checkpoint.dir.

    Where that is unset a local session, as in tests, gets a temporary folder; on a cluster it is an error, as
    executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            path = tempfile.mkdtemp(prefix="millrace-")
            atexit.register(shutil.rmtree, path, ignore_errors=True)
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def give_back(spark: SparkSession) -> None:
    """Return to the system what the driver's JVM has freed outside its heap.

    Each plan leaves such memory behind: of compilers, and of the threads that fill broadcasts and shuffles. The C
    library keeps it, so without this a driver grows with the number of plans that a session has run.
    """
    jvm = spark._jvm
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        # its class is not open to Py4J, the interface is
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        args = jvm.java.util.ArrayList()
        for x in (jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap", None, None):
            args.append(x)
        invoke.invoke(server, args.toArray())
    except Py4JError:  # another JVM; it frees as it likes
        pass


def collect_garbage(spark: SparkSession) -> None:
    """Have the executors collect their garbage and give back the heap that they then don't need.

    A heap grows while tasks hold the pages of their sorts and aggregates, and keeps that size when they are gone.
    After many plans each executor's heap is as large as it may be, with the Python workers beside it. Each core
    gets a task; an executor whose cores are all busy may get none.
    """
    n = spark.sparkContext.defaultParallelism
    each = spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc")).alias("done"))
    each.write.format("noop").mode("overwrite").save()


_written: list[str] = []  # the paths of cut(), in order


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df once as Parquet into the shared folder and return a reader of it.

    Unlike ``DataFrame.checkpoint`` the plan runs once, the files are columnar and compressed, and a lost
    executor costs nothing: the table is in the shared store, not in block managers. The driver gives back what
    the plan has left.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    give_back(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if path in _written:
        _written.remove(path)


def drop(*tables: DataFrame | None) -> None:
    """Delete tables made by cut() that no later plan reads."""
    for t in tables:
        if (path := getattr(t, "_millrace_path", None)) is not None:
            _delete(t.sparkSession, path)


def written() -> set[str]:
    """The tables of cut() that exist now, for sweep()."""
    return set(_written)


def sweep(spark: SparkSession, before: set[str], *keep: DataFrame) -> None:
    """Delete the tables that cut() has made since before = written(), but for those of keep."""
    kept = before | {getattr(t, "_millrace_path", None) for t in keep}
    for path in [p for p in _written if p not in kept]:
        _delete(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes of an Arrow batch, alike for every operator: the option acts when a plan runs, so the last one set decides.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Few rows and bytes to an Arrow batch, because texts can be very long; a row longer than that goes alone."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release() -> None:
    """Give memory that a task has freed back to the system: workers are kept for later tasks, of other stages too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library; it frees as it likes
        pass
