"""Session defaults and the shared storage location used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


TRIM = "systemTrimNativeHeap"  # a diagnostic command of the JVM


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` as the cluster sets it.

    Only on a local master with nothing configured (unit tests) is a temporary folder chosen; a
    cluster's executors would each write to a disk of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        current = spark.sparkContext.getCheckpointDir()
        if current is None:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            current = tempfile.mkdtemp(prefix="tidemark-")
            spark.sparkContext.setCheckpointDir(current)
        return current.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def drop_unused(context: SparkContext) -> None:
    """Collect the driver's garbage: only then does Spark drop broadcasts and shuffle files of finished jobs.

    For loops of hundreds of short jobs, before whose end the driver's heap would otherwise grow to its limit. What
    lies free outside the heap is handed back as well: compiling plans, collecting garbage and short-lived threads
    leave far more there than is in use.
    """
    context._jvm.System.gc()
    hand_back(context)


def hand_back(context: SparkContext) -> bool:
    """Return the driver JVM's freed native memory to the system; False where its JVM has no such command."""
    jvm, array, named = context._jvm, context._gateway.new_array, context._jvm.java.lang.Class.forName
    kinds, given = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
    for k, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[k] = named(kind)
    given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), TRIM
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    try:
        named("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, given)
    except Py4JJavaError:
        return False
    return True


def heap_used(context: SparkContext) -> tuple[int, int]:
    """Bytes of the driver's heap in use, garbage included, and the most it may hold."""
    runtime = context._jvm.java.lang.Runtime.getRuntime()
    return runtime.totalMemory() - runtime.freeMemory(), runtime.maxMemory()


def settle(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Used where several later passes read the same derived rows. The stored copy is columnar (so
    each pass reads only its columns), has a known size for join planning, and survives the loss
    of executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
