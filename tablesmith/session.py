"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces small shuffle outputs at
# runtime; skew-join splitting protects the few joins against a hot key.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # no Python call site with every expression: it takes several calls to the JVM each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # reliable checkpoints of intermediate tables are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tablesmith", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above.

    On a cluster the master and memory come from spark-submit; ``master`` is only
    for local runs and tests.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The session's setting always wins. Only when it is unset on a single-process master
    (``local``, ``local[n]``: tests and small runs) a fresh scratch folder is created; on a
    cluster, ``local-cluster`` included, an unset setting is an error, since executors would
    not share a machine-local folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master or ""
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/DBFS...) for cluster runs")
        configured = tempfile.mkdtemp(prefix="tablesmith-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


_REMOVING: dict[SparkSession, list] = {}      # by session: threads inside, and the setting before
_REMOVING_LOCK = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files as soon as they end (Spark 4.1; earlier
    versions ignore the setting). Otherwise these lie on the executors' disks until the driver
    happens to collect its garbage. Only for frames that are run once, such as those written.
    The setting is the session's: the first of several threads sets it, the last one takes it back."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with _REMOVING_LOCK:
        inside = _REMOVING.setdefault(spark, [0, spark.conf.get(key, None)])
        inside[0] += 1
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        with _REMOVING_LOCK:
            inside[0] -= 1
            if not inside[0]:
                before = _REMOVING.pop(spark)[1]
                spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def garbage_collected(spark: SparkSession) -> None:
    """Have the driver collect what earlier steps left: plans, statistics, broadcasts. Its heap
    otherwise grows to its limit first, and Spark removes broadcasts and shuffle files only after
    the driver's JVM found nothing that refers to them. Py4J passes on what Python has let go
    of a little later, so proxies in cycles count for the next collection."""
    gc.collect()
    spark._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Like a checkpoint this cuts the lineage, so a lost executor costs the tasks it was running;
    unlike a checkpoint the planner sees the table's real size, and so whether to broadcast it."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discarded(*tables: DataFrame) -> None:
    """Delete tables made by :func:`stored` that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.stored_path)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
