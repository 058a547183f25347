"""Document fingerprints: a digest of bucket quartiles.

Every byte triplet of a text is hashed to one of 128 buckets; the digest holds, for each
bucket, the quartile of its count among all buckets (two bits), the length on a logarithmic
scale, and the ratios of the quartiles. Two digests are compared by a difference score that
adds the quartile steps (a step over the whole range counts double), length and ratio
differences, and is bounded, which gives a likeness from 0 to 1.

``neighbours`` pairs each document with the next one in descending id without sorting the
table in one task: ids are cut into ranges by approximate quantiles, texts are shuffled once
to their range, and only the first document of each range also goes to the range before it.

Defined results: a null text is the empty text; a text of under three bytes has empty
buckets, equal texts have equal digests; null ids come last, equal ids by text, repeated
rows follow each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.shared import importable

# Parameters of the digest.
BUCKETS = 128
LENGTH_BASE = 1.25
WORST = 400.0            # differences from here on are a likeness of 0


class Digest:
    __slots__ = ("length", "ratios", "codes")

    def __init__(self, data: bytes):
        n = len(data)
        counts = np.zeros(BUCKETS, dtype=np.int64)
        # blocks keep the working arrays small for very long texts
        raw = np.frombuffer(data, dtype=np.uint8)
        for at in range(0, max(n - 2, 0), 1 << 20):
            b = raw[at:at + (1 << 20) + 2].astype(np.uint32)
            h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            counts += np.bincount(h >> np.uint32(25), minlength=BUCKETS)
        q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
        self.codes = ((counts > q1).astype(np.int8) + (counts > q2) + (counts > q3)).astype(np.int8)
        self.length = min(255, int(np.log(n + 1.0) / np.log(LENGTH_BASE)))
        self.ratios = (int(q1 * 15 // q3), int(q2 * 15 // q3)) if q3 else (0, 0)

    def __str__(self) -> str:
        quads = self.codes.reshape(-1, 4)
        packed = (quads[:, 0] << 6 | quads[:, 1] << 4 | quads[:, 2] << 2 | quads[:, 3]).astype(np.uint8)
        return f"{self.length:02x}{self.ratios[0]:x}{self.ratios[1]:x}{packed.tobytes().hex()}"


def difference(a: Digest, b: Digest) -> float:
    steps = np.abs(a.codes - b.codes)
    total = int(steps.sum()) + 3 * int((steps == 3).sum())
    total += 4 * abs(a.length - b.length)
    return min(total + 2 * sum(abs(x - y) for x, y in zip(a.ratios, b.ratios, strict=True)), WORST)


def likeness(a: Digest, b: Digest) -> float:
    return 1.0 - difference(a, b) / WORST


def _ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, text, part, borrowed): rows by descending id in numbered parts; the first row of
    each part also stands, borrowed, at the end of the part before it (cyclically)."""
    from pyspark.ml.feature import Bucketizer

    ids = docs.select(F.col("doc_id").cast("double").alias("x")).where("x is not null")
    cuts = ids.approxQuantile("x", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))).alias("x"))
    if len(splits) > 2:
        rows = Bucketizer(splits=splits, inputCol="x", outputCol="b").transform(rows)
    else:
        rows = rows.withColumn("b", F.lit(0.0))
    rows = rows.select("doc_id", "text", (F.lit(len(splits) - 2) - F.col("b")).cast("int").alias("part"))
    # one row per part comes to the driver: at most ``ranges`` of them
    heads = sorted((r[0], r[1]) for r in rows.groupBy("part").agg(F.max("doc_id")).collect())
    lend = [(p, head, heads[i - 1][0]) for i, (p, head) in enumerate(heads)]
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lend = F.broadcast(spark.createDataFrame(lend, f"part int, head {id_type}, lender int"))
    own = F.struct("part", F.lit(0).alias("borrowed"))
    rows = rows.join(lend, "part").withColumn("place", F.explode(
        F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(own, F.struct(F.col("lender").alias("part"), F.lit(1).alias("borrowed"))))
        .otherwise(F.array(own))))
    return rows.select("doc_id", "text", "place.part", "place.borrowed")


def neighbours(docs: DataFrame, visit: Callable, schema: str, ranges: int | None = None) -> DataFrame:
    """Rows ``visit(doc_id, (text, made), (next text, next made), make)`` for each document and the
    next in descending id (after the last the first), where ``make`` is run once per text."""
    importable(docs.sparkSession)
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by range of the part's number: hashing the numbers would leave tasks empty and give others several
    placed = (_ranges(docs, ranges).repartitionByRange(ranges, "part")
              .sortWithinPartitions("part", "borrowed", F.desc_nulls_last("doc_id"), "text"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, out, make = None, [], visit.make
        for batch in batches:
            for doc_id, text, borrowed in zip(batch["doc_id"], batch["text"], batch["borrowed"], strict=True):
                if borrowed and held is None:
                    continue                     # ties of a borrowed row: the first one served
                now = (text, make(text))
                if held is not None:
                    out.append((held[0], *visit.pair(held[1], now)))
                held = None if borrowed else (doc_id, now)
            if out:
                yield pd.DataFrame(out, columns=visit.columns).astype({"doc_id": "object"})
                out = []

    # ids as text on the Python side keep nulls and any width exact
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texted = placed.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "borrowed")
    made = texted.mapInPandas(walk, f"doc_id string, {schema}")
    return made.withColumn("doc_id", F.col("doc_id").cast(id_type))


class _Edited:
    """The digest of a text and of its edited form, against the next document."""

    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    @staticmethod
    def make(text: str) -> Digest:
        return Digest(text.encode("utf-8", "surrogatepass"))

    @staticmethod
    def pair(now: tuple[str, Digest], after: tuple[str, Digest]) -> tuple:
        text, own = now
        half = len(text) // 2
        data = (text[:len(text) - half] + after[0][:half]).encode("utf-8", "surrogatepass")
        edited = Digest(data)
        return (len(text), hashlib.sha256(data).hexdigest(), str(own), str(edited), likeness(own, edited), likeness(own, after[1]))


def op5_fingerprint(docs: DataFrame) -> DataFrame:
    schema = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return neighbours(docs, _Edited, schema)
