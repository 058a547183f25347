"""Centroid clustering with an incremental distance matrix.

Vectors become integers, so every number here is exact. A table keeps, for each vector, its
components, its squared length and its dot product with every centroid. A round

1. sums the components of each cluster, within batches first, and moves every non-empty centroid
   to the componentwise floor of its mean;
2. changes the dot products by the nonzero component changes of the centroids only:
   ``v.c' = v.c + sum of v[j] * (c'[j] - c[j])`` over the components j that moved;
3. takes the smallest of ``|v|^2 - 2 v.c + |c|^2`` over the centroids again, where ties go to the
   smaller number.

The table is written to the shared folder once a round and the one before is deleted, so a lost
executor costs its tasks of the round. What goes to the driver and back are the centroids and
their sums: ``k`` times the components, whatever the number of vectors. No vector is shuffled.

``clustered(vectors, ...)`` returns columns of its input (all, or those of ``carry``) in a struct
``row``, so that no name clashes, with ``cluster`` and ``distance`` beside it, and the centroids.

Defined results: a vector that is null, of another length, or holds a null, NaN or infinite
component is left out; equal vectors are clustered alike, repeated rows are vectors of their own;
of vectors with equal ids (null ids too, whose text is empty) the one with smaller components
starts first; fewer vectors than centroids start fewer centroids; an empty table gives no rows;
other columns are ignored by the distance. Components beyond +-LIMIT count as LIMIT, since
squared distances would not fit a bigint; sums of distances that don't fit stay at the largest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.shared import dropped, id_text, importable, saved

# Parameters of the query.
CENTROIDS = 16
ROUNDS = 3
COMPONENTS = 64
SCALE = 64
SEED = "1:"

LIMIT = 1 << 27
LARGEST = (1 << 63) - 1


def whole(vector: Column, components: int) -> Column:
    """Whether a vector has this many components, none null or non-finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce((F.size(vector) == components) & F.forall(vector, finite), F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x, as double, kept within LIMIT."""
    def one(x):
        value = F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT))))
        return value.cast("bigint")
    return F.transform(vector, one)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * width, width, dtype=np.int32), matrix.reshape(-1))


def nearest(length: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, distance) from squared lengths and dot products; the first of equal distances."""
    distances = length[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)
    cluster = distances.argmin(axis=1)
    return cluster.astype(np.int32), distances[np.arange(len(cluster)), cluster]


def changed(q: np.ndarray, dots: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The dot products after the centroids moved, by their nonzero component changes only."""
    dots = dots.copy()
    step = new - old
    for k in np.flatnonzero(step.any(axis=1)):
        moved = np.flatnonzero(step[k])
        dots[:, k] += q[:, moved] @ step[k, moved]
    return dots


def _update(old: np.ndarray, new: np.ndarray, components: int):
    """A batch function: dot products moved from centroids ``old`` to ``new``, clusters anew."""
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("q"), components)
            length = batch.column("length").to_numpy()
            dots = changed(q, _matrix(batch.column("dots"), len(old)), old, new)
            cluster, distance = nearest(length, dots, new)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("q"), batch.column("length"), _lists(dots), pa.array(cluster), pa.array(distance)],
                names=["row", "q", "length", "dots", "cluster", "distance"])
    return visit


def _sums(k: int, components: int):
    """A batch function: (cluster, n, component, total) of a batch, exactly."""
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            q = _matrix(batch.column("q"), components)
            present = np.unique(cluster)
            totals = np.stack([q[cluster == c].sum(axis=0) for c in present]) if len(present) else np.zeros((0, components), np.int64)
            counts = np.bincount(cluster, minlength=k)[present]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(present, components).astype(np.int32)), pa.array(np.repeat(counts, components).astype(np.int64)),
                 pa.array(np.tile(np.arange(components, dtype=np.int32), len(present))), pa.array(totals.reshape(-1).astype(np.int64))],
                names=["cluster", "n", "component", "total"])
    return visit


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of each cluster's mean; empty clusters keep their centroid."""
    k, components = centroids.shape
    parts = state.select("cluster", "q").mapInArrow(_sums(k, components), "cluster int, n bigint, component int, total bigint")
    # one row per centroid and component reaches the driver
    rows = parts.groupBy("cluster", "component").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    out = centroids.copy()
    for r in rows:
        out[r.cluster, r.component] = int(r.total) // r.n
    return out


@dataclass
class Clustering:
    rows: DataFrame              # row (a struct of the input's columns), cluster, distance
    centroids: list[list[int]]   # the final ones, by number


def clustered(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", k: int = CENTROIDS, rounds: int = ROUNDS,
              components: int = COMPONENTS, scale: int = SCALE, seed: str = SEED, carry: list[str] | None = None) -> Clustering:
    """Cluster ``vectors`` by ``rounds`` rounds from ``k`` vectors chosen by a hash of their key."""
    spark = vectors.sparkSession
    importable(spark)
    kept = vectors.where(whole(F.col(vector), components)).select(
        F.struct(*(carry or ["*"])).alias("row"), integers(F.col(vector), scale).alias("q"),
        F.sha2(F.concat(F.lit(seed), id_text(F.col(key))), 256).alias("h"))
    starts = kept.select("h", "q").orderBy("h", "q").limit(k).collect()             # k vectors
    centroids = np.array([r.q for r in starts], dtype=np.int64).reshape(len(starts), components)

    # the dot products with zero centroids are zero: the first round is an update as every other
    start = kept.select("row", "q", F.aggregate("q", F.lit(0).cast("bigint"), lambda s, x: s + x * x).alias("length"),
                        F.array_repeat(F.lit(0).cast("bigint"), len(starts)).alias("dots"))
    schema = f"row {kept.schema['row'].dataType.simpleString()}, q array<bigint>, length bigint, dots array<bigint>, cluster int, distance bigint"
    if not starts:
        return Clustering(start.select("row", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), [])
    old, state = np.zeros_like(centroids), start
    for turn in range(rounds + 1):
        before = state
        state = saved(before.select("row", "q", "length", "dots").mapInArrow(_update(old, centroids, components), schema), "centroids")
        if before is not start:
            dropped(before)
        if turn < rounds:
            old, centroids = centroids, moved(state, centroids)
    result = saved(state.select("row", "cluster", "distance"), "clusters")
    dropped(state)
    return Clustering(result, [[int(x) for x in c] for c in centroids])


def op11_centroids(embeddings: DataFrame) -> DataFrame:
    found = clustered(embeddings, carry=["vec_id"])
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    as_long = lambda c: F.least(c, F.lit(LARGEST).cast("decimal(38,0)")).cast("bigint")
    by_cluster = found.rows.groupBy("cluster").agg(total.alias("s"))
    # at most one row per centroid
    every = by_cluster.agg(F.sum("s").alias("t"))
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(found.centroids)]
    digests = embeddings.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    report = (by_cluster.join(F.broadcast(digests), "cluster").join(F.broadcast(every))
              .select("cluster", as_long(F.col("s")).alias("cluster_inertia"), as_long(F.col("t")).alias("inertia"), "centroid_sha256"))
    return (found.rows.select("row.vec_id", "cluster", "distance").join(F.broadcast(report), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def oracle() -> str:
    """DuckDB SQL of the query: the same rounds, with every distance computed anew."""
    dist = ("list_sum(list_transform(range(1, {d} + 1), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))").format(d=COMPONENTS)
    parts = [f"""v AS (SELECT row_number() OVER () AS rid, vec_id, q FROM (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = {COMPONENTS})),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{SEED}' || coalesce(vec_id::VARCHAR, '')), q) - 1 AS k, q FROM v
  QUALIFY k < {CENTROIDS})"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS (SELECT rid, vec_id, q, b[1] AS d, b[2] AS k FROM (
  SELECT v.rid, any_value(v.vec_id) AS vec_id, any_value(v.q) AS q, min([{dist}::BIGINT, c.k]) AS b FROM v CROSS JOIN c{r} c GROUP BY v.rid))""")
        if r < ROUNDS:
            parts.append(f"""s{r} AS (SELECT k, j, sum(x) AS s, count(*) AS n FROM (
  SELECT k, unnest(q) AS x, unnest(range(1, {COMPONENTS} + 1)) AS j FROM a{r}) GROUP BY k, j),
m{r} AS (SELECT k, list((s - ((s % n + n) % n)) // n ORDER BY j)::BIGINT[] AS q FROM s{r} GROUP BY k),
c{r + 1} AS (SELECT c.k, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m{r} m ON c.k = m.k)""")
    return f"""WITH {', '.join(parts)}
SELECT a.vec_id, a.k::INTEGER AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia,
  sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON a.k = c.k"""
