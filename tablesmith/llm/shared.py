"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.session import checkpoint_dir, shuffles_removed

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


# Parameter: rows that go to a Python worker at a time; a batch of long texts stays small.
BATCH_ROWS = 1000


def importable(spark: SparkSession) -> None:
    """Let Python workers on the driver's machine import this package wherever it was loaded
    from (clusters get it by ``--py-files`` or their image), and bound their batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks it was running, and later
    jobs read columns of the table instead of repeating the work above it. ``by`` names a column
    of few values, each of which gets a folder of its own."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def part_of_saved(table: DataFrame, folder: str) -> DataFrame:
    """One folder of a table made by :func:`saved` with ``by``, for :func:`dropped`."""
    part = table.limit(0)
    part.saved_path = f"{table.saved_path}/{folder}"
    return part


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by :func:`saved` that no later step reads."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.saved_path)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def id_text(c: Column) -> Column:
    """An id as text; null counts as the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32(doc_id as text) mod 4 is 2."""
    return F.crc32(id_text(doc_id)) % 4 == 2


CHUNK = 256


def chunked(arr: Column, size: int = CHUNK) -> Column:
    """An array cut into arrays of ``size`` elements (none for an empty array)."""
    n = F.size(arr)
    parts = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")),
                        lambda b: F.slice(arr, b * size + 1, F.lit(size)))
    return F.when(n > 0, parts).otherwise(F.slice(F.array(arr), 1, 0))


def running_total(lengths: Column) -> Column:
    """For each element of an array of ints, the sum of the elements before it (bigint).

    Two levels, so that a very long array costs about n * CHUNK copies and not n * n."""
    zero = F.lit(0).cast("bigint")
    none = F.expr("cast(array() as array<bigint>)")

    def scan(arr, start):
        grown = F.aggregate(arr, F.struct(start.alias("at"), none.alias("out")),
                            lambda s, x: F.struct((s["at"] + x).alias("at"),
                                                  F.concat(s["out"], F.array(s["at"])).alias("out")))
        return grown["out"]

    chunks = chunked(lengths)
    sums = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda s, x: s + x))
    starts = scan(sums, zero)
    return F.flatten(F.transform(F.arrays_zip(chunks.alias("c"), starts.alias("s")),
                                 lambda z: scan(z["c"], z["s"])))
