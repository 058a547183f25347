"""Incremental line dedup: sharded cuckoo filters over exact reference-count tables.

A line's key is the line, stripped and with A-Z lower-cased. Keys long enough that stand in at
least ``threshold`` documents are *common*; a common key loses its lines in every document but the
one of the largest id. A ledger below one folder holds

* ``references``, a log: (key digest, doc_id, part, n), the lines of each document by part (a
  digest of the row's text), negative n for documents taken out again; the sum over a document and
  key is exact;
* ``common``: (key digest, documents, largest doc_id) of the common keys, exact;
* ``filters``: one cuckoo filter a shard, of the digests that are common. Buckets of four 16-bit
  fingerprints take insertions and deletions, and a filter that overflows is made anew with twice
  the buckets from the exact table. The number of shards follows the number of references, so a
  filter's size is bounded by SHARD_REFERENCES.

``insert`` and ``delete`` append to the log, recount the keys they touch, and change the filters
only by keys that crossed the threshold, so taking a document out restores every line that it had
made common. ``deduped`` tests references in the filters, one group of shards of FILTER_BYTES at a
time (broadcast: that is its bound), and looks up what passes, and so may be common, in the exact
table; lines are never dropped by a filter alone. Only digests travel but for one join that brings
each text its dropped keys.

New versions of ``common`` and ``filters`` are written as new folders and the ones before are
deleted, so a lost executor costs its tasks.

Defined results: a null or empty text is one empty line; rows of one doc_id are one document, and
rows of the null id are one that counts as the smallest; repeated rows repeat; ids are compared
as whatever type they have; a document whose lines are all dropped has an empty text; an empty
table gives no rows; other columns stay, in a struct ``row``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm.shared import dropped, importable, saved

# Parameters of the query.
LEAST_POINTS = 20
THRESHOLD = 3

SPACE = " \t\n\x0b\x0c\r"
SLOTS = 4                        # fingerprints of a bucket
KICKS = 500
LOAD = 0.85
SHARD_REFERENCES = 1 << 19       # references of a shard, on average
FILTER_BYTES = 32 << 20          # filters that are broadcast at once


def digest_of(line: str, least: int) -> bytes | None:
    """16 bytes that stand for a line's key, or none for short keys."""
    key = line.strip(SPACE)
    if len(key) < least:
        return None
    # lower() of bytes changes A-Z only
    return hashlib.blake2b(key.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


class CuckooFilter:
    """A set of digests with deletions: each has a 16-bit fingerprint in one of two buckets."""

    def __init__(self, buckets: int, data: bytes | None = None):
        self.buckets = buckets           # a power of two
        self.table = (np.zeros((buckets, SLOTS), np.uint16) if data is None
                      else np.frombuffer(data, np.uint16).reshape(buckets, SLOTS).copy())

    @classmethod
    def holding(cls, digests: list[bytes]) -> CuckooFilter:
        """A filter of the digests, with as many buckets as it takes."""
        buckets = 1 << max(0, math.ceil(math.log2(max(1, len(digests) / (SLOTS * LOAD)))))
        while True:
            made = cls(buckets)
            if all(made.insert(d) for d in digests):
                return made
            buckets *= 2

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        one = int.from_bytes(digest[10:16], "little") & (self.buckets - 1)
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 >> 3 & (self.buckets - 1))

    def _put(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = mark
        return bool(len(free))

    def insert(self, digest: bytes) -> bool:
        """False if it overflows; the filter must then be made anew."""
        mark, one, two = self._places(digest)
        if self._put(one, mark) or self._put(two, mark):
            return True
        at = two
        for kick in range(KICKS):
            slot = kick % SLOTS
            mark, self.table[at, slot] = int(self.table[at, slot]), mark
            at = self._other(at, mark)
            if self._put(at, mark):
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        """Take out a digest that was inserted."""
        mark, one, two = self._places(digest)
        for bucket in (one, two):
            found = np.flatnonzero(self.table[bucket] == mark)
            if len(found):
                self.table[bucket, found[0]] = 0
                return True
        return False

    def may_hold(self, marks: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """For digests given by their fingerprints and bucket hashes: whether they may be held."""
        one = (firsts & np.uint64(self.buckets - 1)).astype(np.int64)
        two = one ^ ((marks.astype(np.int64) * 0x5BD1E995 >> 3) & (self.buckets - 1))
        mark = marks[:, None]
        return (self.table[one] == mark).any(axis=1) | (self.table[two] == mark).any(axis=1)


def shards_of(raw: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each digest, from its first eight bytes."""
    return (raw[:, :8].copy().view("<u8")[:, 0] % np.uint64(shards)).astype(np.int64)


def _raw(digests: pa.Array) -> np.ndarray:
    """Digests of 16 bytes as an n x 16 array."""
    return np.frombuffer(b"".join(digests.to_pylist()), np.uint8).reshape(len(digests), 16)


def _references(least: int):
    """A batch function: (digest, doc_id, part, n) of the lines of each text, counted by text."""
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, digests, counts = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = {}
                for line in (text or "").split("\n"):
                    d = digest_of(line, least)
                    if d is not None:
                        found[d] = found.get(d, 0) + 1
                at += [i] * len(found)
                digests += found
                counts += found.values()
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column("doc_id").take(at), batch.column("part").take(at),
                                              pa.array(counts, pa.int64())], names=["digest", "doc_id", "part", "n"])
    return visit


def _kept(least: int):
    """A batch function: each text without the lines whose digest is dropped."""
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                lines = (text or "").split("\n")
                gone = set(gone or ())
                left = [x for x in lines if digest_of(x, least) not in gone] if gone else lines
                texts.append("\n".join(left))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(texts, pa.string())],
                names=["row", "n_lines", "n_dropped", "kept"])
    return visit


def part_of(text: Column) -> Column:
    """Tells rows of one doc_id apart by their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


class LineLedger:
    """References, common keys and filters of a growing and shrinking set of documents."""

    def __init__(self, spark: SparkSession, threshold: int = THRESHOLD, least: int = LEAST_POINTS, shard_references: int = SHARD_REFERENCES):
        importable(spark)
        self.spark, self.threshold, self.least, self.shard_references = spark, threshold, least, shard_references
        self.references = self.common = self.filters = None
        self.shards = 1

    # --- references and counts

    def _lines(self, docs: DataFrame) -> DataFrame:
        id_type = docs.schema["doc_id"].dataType.simpleString()
        return docs.select("doc_id", part_of(F.col("text")).alias("part"), "text").mapInArrow(
            _references(self.least), f"digest binary, doc_id {id_type}, part bigint, n bigint")

    def _counted(self, references: DataFrame) -> DataFrame:
        """(digest, documents, top) of the digests whose lines stand in ``threshold`` documents."""
        held = references.groupBy("digest", "doc_id").agg(F.sum("n").alias("n")).where("n > 0")
        return (held.groupBy("digest").agg(F.count("*").alias("documents"), F.max(F.struct("doc_id")).alias("top"))
                .where(F.col("documents") >= self.threshold))

    def _apply(self, delta: DataFrame) -> None:
        """Append to the log, recount the digests it touches, and follow with the filters."""
        delta = saved(delta, "line-references")
        if self.references is None:
            self.references, self.common = delta, saved(self._counted(delta), "line-common")
            self._build()
            return
        touched = delta.select("digest").distinct()
        self.references = self.references.unionByName(delta)
        fresh = saved(self._counted(self.references.join(touched, "digest", "left_semi")), "line-common")
        was = self.common.join(touched, "digest", "left_semi").select("digest")
        now = fresh.select("digest")
        crossed = saved(now.join(was, "digest", "left_anti").withColumn("now", F.lit(True)).unionByName(
            was.join(now, "digest", "left_anti").withColumn("now", F.lit(False))), "line-crossed")
        before = self.common
        self.common = saved(before.join(touched, "digest", "left_anti").unionByName(fresh), "line-common")
        dropped(before, fresh)
        if self.references.count() > 2 * self.shards * self.shard_references:
            self._build()                # more shards, so that each filter stays small
        else:
            self._change(crossed)
        dropped(crossed)

    # --- filters

    def _sharded(self, digests: DataFrame) -> DataFrame:
        shards = self.shards

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards_of(_raw(batch.column("digest")), shards))],
                                                 names=[*batch.schema.names, "shard"])
        return digests.mapInArrow(visit, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in digests.schema.fields)}, shard bigint")

    def _build(self) -> None:
        """The filters from the exact table, in as many shards as the references ask for."""
        self.shards = max(1, math.ceil(self.references.count() / self.shard_references))

        def make(shard: pd.DataFrame) -> pd.DataFrame:
            f = CuckooFilter.holding(shard["digest"].tolist())
            return pd.DataFrame({"shard": shard["shard"].iloc[:1], "buckets": [f.buckets], "data": [f.table.tobytes()]})

        made = self._sharded(self.common.select("digest")).groupBy("shard").applyInPandas(make, "shard bigint, buckets bigint, data binary")
        self._replace(made)

    def _change(self, crossed: DataFrame) -> None:
        """Insert digests that became common and delete those that are no longer; a filter that
        overflows is made anew from the exact table."""
        def change(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            shard = int((filters if len(filters) else keys)["shard"].iloc[0])
            f = CuckooFilter(int(filters["buckets"].iloc[0]), filters["data"].iloc[0]) if len(filters) else CuckooFilter.holding([])
            whole = all(f.delete(d) for d in keys.loc[~keys["now"].astype(bool), "digest"])
            whole = whole and all(f.insert(d) for d in keys.loc[keys["now"].astype(bool), "digest"])
            # no buckets: overflowed
            return pd.DataFrame({"shard": [shard], "buckets": [f.buckets if whole else 0], "data": [f.table.tobytes() if whole else b""]})

        schema = "shard bigint, buckets bigint, data binary"
        made = saved(self._sharded(crossed).groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(change, schema), "line-filters")
        full = made.where("buckets = 0").select("shard")

        def make(shard: pd.DataFrame) -> pd.DataFrame:
            f = CuckooFilter.holding(shard["digest"].tolist())
            return pd.DataFrame({"shard": shard["shard"].iloc[:1], "buckets": [f.buckets], "data": [f.table.tobytes()]})

        again = (self._sharded(self.common.select("digest")).join(full, "shard", "left_semi")
                 .groupBy("shard").applyInPandas(make, schema))
        self._replace(made.where("buckets > 0").unionByName(again))
        dropped(made)

    def _replace(self, filters: DataFrame) -> None:
        before, self.filters = self.filters, saved(filters, "line-filters")
        if before is not None:
            dropped(before)

    # --- the ledger's calls

    def insert(self, docs: DataFrame) -> None:
        """Take in documents (doc_id, text)."""
        self._apply(self._lines(docs))

    def delete(self, ids: DataFrame) -> None:
        """Take out all documents whose doc_id stands in ``ids``."""
        same = F.col("r.doc_id").eqNullSafe(F.col("i.doc_id"))
        gone = self.references.alias("r").join(ids.select("doc_id").distinct().alias("i"), same, "left_semi")
        self._apply(gone.groupBy("digest", "doc_id", "part").agg((-F.sum("n")).alias("n")).where("n <> 0"))

    def _groups(self) -> Iterator[dict[int, tuple[int, bytes]]]:
        """Filters by shard, FILTER_BYTES of them (or one) at a time."""
        sizes = self.filters.select("shard", F.length("data").alias("bytes")).orderBy("shard").toLocalIterator()
        group, total = [], 0
        groups = []
        for r in sizes:
            if group and total + r.bytes > FILTER_BYTES:
                groups.append((group[0], group[-1]))
                group, total = [], 0
            group.append(r.shard)
            total += r.bytes
        if group:
            groups.append((group[0], group[-1]))
        for low, high in groups:
            yield {r.shard: (r.buckets, r.data) for r in self.filters.where(F.col("shard").between(low, high)).collect()}

    def _maybe_common(self, lines: DataFrame) -> DataFrame:
        """The references that pass their shard's filter."""
        lines = lines.select("digest", "doc_id", "part")
        schema = f"digest binary, doc_id {lines.schema['doc_id'].dataType.simpleString()}, part bigint"
        shards, out = self.shards, None
        for group in self._groups():
            sent = self.spark.sparkContext.broadcast(group)

            def visit(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                filters = {k: CuckooFilter(*v) for k, v in sent.value.items()}
                for batch in batches:
                    raw = _raw(batch.column("digest"))
                    marks = raw[:, 8:10].copy().view("<u2")[:, 0]
                    marks = np.where(marks == 0, 1, marks).astype(np.uint16)
                    firsts = raw[:, 10:16].astype(np.uint64) @ (np.uint64(1) << np.arange(0, 48, 8, dtype=np.uint64))
                    at = shards_of(raw, shards)
                    passed = np.zeros(len(raw), bool)
                    for shard in np.unique(at):
                        if int(shard) in filters:
                            here = np.flatnonzero(at == shard)
                            passed[here] = filters[int(shard)].may_hold(marks[here], firsts[here])
                    yield batch.filter(pa.array(passed))

            hits = saved(lines.mapInArrow(visit, schema), "line-hits")
            sent.unpersist()
            out = hits if out is None else out.unionByName(hits)
        return out if out is not None else lines.limit(0)

    def deduped(self, docs: DataFrame) -> DataFrame:
        """``docs``, which the ledger holds, without the lines of common keys that a larger id holds:
        row, n_lines, n_dropped, kept."""
        hits = self._maybe_common(self.references)
        gone = (hits.join(self.common.select("digest", "top"), "digest").where(~F.col("doc_id").eqNullSafe(F.col("top.doc_id")))
                .groupBy(F.col("doc_id").alias("gone_id"), F.col("part").alias("gone_part")).agg(F.collect_set("digest").alias("gone")))
        rows = docs.select(F.struct("*").alias("row"))
        same = F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (part_of(F.col("row.text")) == F.col("gone_part"))
        with_gone = rows.join(gone, same, "left")
        schema = f"row {rows.schema['row'].dataType.simpleString()}, n_lines bigint, n_dropped bigint, kept string"
        return with_gone.select("row", F.col("row.text").alias("text"), "gone").mapInArrow(_kept(self.least), schema)


def op13_linededup(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    ledger = LineLedger(docs.sparkSession)
    ledger.insert(docs)
    return ledger.deduped(docs).select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = f"""
WITH l AS (SELECT doc_id, i, lines[i] AS line FROM (
  SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
k AS (SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= {LEAST_POINTS} GROUP BY key HAVING count(DISTINCT doc_id) >= {THRESHOLD}),
d AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.top AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id"""
