"""Session settings and the shared work folder.

Everything that must outlive one task (written stages, token files, manifests)
goes below the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Settings the engine's own sessions use; a session handed in keeps its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "loomsift", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, or on a local master a
    temporary one, which is then set so that ``checkpoint()`` works as well.

    On a cluster without that setting this raises: a machine-local folder would
    be invisible to other executors.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="loomsift-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, grouped by application."""
    return f"{shared_root(spark)}/loomsift-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it; with ``by``, in a
    folder for each of that column's values, so that a filter on it reads its own.

    Cuts lineage: a lost executor costs re-reading files, never recomputation.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    writer = df.write.options(**options)
    (writer.partitionBy(by) if by else writer).parquet(path)
    reclaim(spark)
    return spark.read.schema(df.schema).parquet(path)


#: Least seconds between collections of garbage; short stages leave little behind.
RECLAIM_EVERY = 2.0
_reclaimed = 0.0


def reclaim(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more: it does
    so when the driver collects garbage, which may be long after a stage was written.
    Then the driver's free memory goes back to the system."""
    global _reclaimed
    if time.monotonic() - _reclaimed < RECLAIM_EVERY:
        return
    _reclaimed = time.monotonic()
    gc.collect()
    spark._jvm.System.gc()
    trim(spark)


def trim(spark: SparkSession) -> None:
    """Give back what the C allocators of the driver's Python and JVM hold of freed
    memory, which collections of garbage leave with the processes (193 MB of the JVM's
    after two runs of the pipeline). The JVM's own command does it (HotSpot on Linux,
    17.0.9 or later); elsewhere its memory stays."""
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)
    jvm = spark._jvm
    with contextlib.suppress(Py4JError):  # another JVM
        # Through the interface, as the server's class isn't open to callers.
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        call = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        call[0], call[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), call)


def release(spark: SparkSession) -> None:
    """Delete all this application's written tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_root(spark)}/loomsift-{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
