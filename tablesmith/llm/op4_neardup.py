"""MinHash near-duplicates with tensored banding.

Each document is the set of its distinct five-word shingles (64-bit hashes). Two small
collections of HALVES half keys, each made of ROWS minhashes, are paired into HALVES^2 table
keys, so that 144 tables of six minhashes cost 72 minhashes. Two documents meet if they share
a half key of each collection: a pair at a similarity of 0.85 does so but for a chance of
2e-5, and every link is confirmed on the full sets. The least similarity is a parameter (85 or
80 hundredths; 85 is described here): at 0.80, 256 tables of 96 minhashes miss as few.

1. Documents with equal sets are one class; only classes go on.
2. A class whose half keys nobody shares has no partner; the others are the survivors.
3. A survivor of whose shingles less than 85% occur in another survivor can't be linked and
   goes (an exact test).
4. Star: in every table bucket each member is paired with one pivot, the member that shares
   the most half keys, and the pair is compared. That is one row per member, however large
   the bucket.
5. Rest: members that were not linked to their pivot may still be linked to each other. Per
   candidate cluster (the connected components of the star pairs) every class outside the
   cluster's largest linked component is compared with the cluster's other classes, block
   against block, blocks having a set size; a block pair gives at most as many links as
   change the components. Nothing is skipped, and no pair is written that isn't a link.
6. Components of the links, and of the classes, give each document the smallest id it reaches.

Defined results: null, empty or blank texts have no shingles and are linked with nothing
(their own component); a text of fewer than five words is one shingle; repeated rows and
equal texts are one class; null ids never name a component unless all ids of it are null
(then it is null); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tablesmith.llm.components import components
from tablesmith.llm.shared import dropped, importable, saved

# Fixed values.
SHINGLE = 5               # words
LEAST, OF = 85, 100       # linked: OF * intersection >= LEAST * union
# Parameters of the banding.
HALVES = {85: 12, 80: 16}   # half keys in each of the two collections, by the least similarity
ROWS = 3                  # minhashes of a half key
SHARED = 5                # half keys (of both collections) that a partner shares at least
# Parameters of the rest: classes, and bytes of text, of a block.
BLOCK_CLASSES, BLOCK_BYTES = 256, 4 << 20
REMEMBERED = 1 << 16      # words whose hash a worker keeps

_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Words()


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    n = len(h) - width + 1
    acc = h[:n].copy()
    for k in range(1, width):
        acc = _mix(acc) + h[k:k + n]
    return np.unique(_mix(acc + np.uint64(width)))


@cache
def _factors(halves: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(4))
    a = rng.integers(0, 1 << 63, 2 * halves * ROWS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    return a, rng.integers(0, 1 << 63, 2 * halves * ROWS, dtype=np.uint64)


def minhashes(s: np.ndarray, halves: int) -> np.ndarray:
    a, b = _factors(halves)
    best = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 2048):
        best = np.minimum(best, (s[at:at + 2048] * a[:, None] + b[:, None]).min(axis=1))
    return best


def half_keys(s: np.ndarray, halves: int) -> np.ndarray:
    """The half keys of both collections: hashes of ROWS minhashes each."""
    m = minhashes(s, halves).reshape(2 * halves, ROWS)
    acc = np.arange(2 * halves, dtype=np.uint64)
    for k in range(ROWS):
        acc = _mix(acc) + m[:, k]
    return _mix(acc).view(np.int64)


def _signature(halves: int):
    def signed(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            s = shingles(t or "")
            if len(s):
                out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), half_keys(s, halves).tolist()))
            else:
                out.append((0, None, None))
        return pd.DataFrame(out, columns=["n", "content", "half"])

    return signed


def _linked(least: int):
    def compared(a: pd.Series, b: pd.Series) -> pd.Series:
        out, last, sa = [], None, None
        for x, y in zip(a, b, strict=True):
            if x is not last:
                last, sa = x, shingles(x)
            sb = shingles(y)
            both = len(np.intersect1d(sa, sb, assume_unique=True))
            out.append(OF * both >= least * (len(sa) + len(sb) - both))
        return pd.Series(out, dtype=bool)

    return compared


def _shingle_lists(texts: pd.Series) -> pd.Series:
    return pd.Series([shingles(t).view(np.int64).tolist() for t in texts])


def _block_links(group: pd.DataFrame, least: int) -> pd.DataFrame:
    """Links between the left and the right classes of a block pair that join components."""
    left, right = group[group["side"] == 0], group[group["side"] == 1]
    sets = [shingles(t) for t in left["text"]]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    if sets and len(right):
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        sizes = np.array([len(x) for x in sets])
        nodes, roots = left["node"].to_numpy(), left["root"].to_numpy()
        for node, own, text in zip(right["node"], right["root"], right["text"], strict=True):
            s = shingles(text)
            lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
            n = hi - lo
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            for i in np.flatnonzero(OF * both >= least * (sizes + len(s) - both)):
                a, b = root(int(roots[i])), root(int(own))
                if a != b:
                    parent[a] = b
                    out.append((int(nodes[i]), int(node)))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def signature(text: Column, halves: int) -> Column:
    """n (shingles), content (a digest of the set; null without shingles) and half keys."""
    return pandas_udf(_signature(halves), "struct<n:bigint,content:binary,half:array<bigint>>")(text)


def linked(a: Column, b: Column, least: int) -> Column:
    """Whether two texts' full shingle sets are similar enough."""
    return pandas_udf(_linked(least), "boolean")(a, b)


def survivors(classes: DataFrame, halves: int) -> DataFrame:
    """(node, doc_id, a, b, popularity): classes that share SHARED half keys, some of each
    collection, with others; a and b are the shared ones."""
    keys = classes.select("node", F.posexplode("half").alias("pos", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    mine = lambda which: F.collect_list(F.when(which, F.col("key")))  # noqa: E731  (2 * halves at most)
    hits = keys.join(shared, "key").groupBy("node").agg(
        mine(F.col("pos") < halves).alias("a"), mine(F.col("pos") >= halves).alias("b"), F.sum("n").alias("popularity"))
    return hits.where((F.size("a") > 0) & (F.size("b") > 0) & (F.size("a") + F.size("b") >= SHARED))


def with_shared_shingles(texts: DataFrame, least: int) -> DataFrame:
    """Nodes of ``texts`` of whose shingles ``least`` in OF or more occur in another of them."""
    each = texts.select("node", F.explode(pandas_udf(_shingle_lists, "array<bigint>")("text")).alias("shingle"))
    common = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    shared = each.join(common, "shingle").groupBy("node").agg(F.count("*").alias("shared"))
    total = each.groupBy("node").agg(F.count("*").alias("total"))
    return shared.join(total, "node").where(OF * F.col("shared") >= least * F.col("total")).select("node")


def star_pairs(nodes: DataFrame) -> DataFrame:
    """(node, pivot): every member of a table bucket with the bucket's most popular member."""
    rows = (nodes.select("node", "popularity", F.explode("a").alias("x"), "b")
            .select("node", "popularity", "x", F.explode("b").alias("y"))
            .select("node", "popularity", F.xxhash64("x", "y").alias("key")))
    pivots = (rows.groupBy("key").agg(F.max(F.struct("popularity", "node")).alias("top"), F.count("*").alias("n"))
              .where("n > 1").select("key", F.col("top.node").alias("pivot")))
    return rows.join(pivots, "key").where("node <> pivot").select("node", "pivot").distinct()


def rest_links(texts: DataFrame, clusters: DataFrame, linked_roots: DataFrame, least: int) -> DataFrame:
    """Links that the stars missed: in clusters of several components, every class outside the
    largest component against the cluster's classes, in blocks."""
    place = (clusters.select("node", F.col("root").alias("cluster")).join(linked_roots, "node", "left")
             .select("node", "cluster", F.coalesce("root", "node").alias("root")))
    place = saved(texts.join(place, "node").select("node", "text", "cluster", "root"), "neardup-rest")
    size = F.octet_length("text")
    parts = place.groupBy("cluster", "root").agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))
    blocks = lambda n, x: F.ceil(F.greatest(n / BLOCK_CLASSES, x / BLOCK_BYTES)).cast("int")
    shape = parts.groupBy("cluster").agg(
        F.count("*").alias("parts"), F.max(F.struct("n", "root", "bytes")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    shape = shape.where("parts > 1").select(
        "cluster", F.col("top.root").alias("top"), blocks(F.col("n"), F.col("bytes")).alias("right_blocks"),
        blocks(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("left_blocks"))
    rows = place.join(shape, "cluster")
    block = lambda count, seed: F.pmod(F.xxhash64("node", F.lit(seed)), count).cast("int")
    upto = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    left = (rows.where("root <> top").select("cluster", "node", "root", "text", F.lit(0).alias("side"),
                                             block(F.col("left_blocks"), 1).alias("lb"), upto(F.col("right_blocks")).alias("rb")))
    right = rows.select("cluster", "node", "root", "text", F.lit(1).alias("side"), upto(F.col("left_blocks")).alias("lb"),
                        block(F.col("right_blocks"), 2).alias("rb"))
    # one key for a block pair: the rows of a cluster would otherwise stay together in one task
    pair = F.concat_ws(":", "cluster", "lb", "rb")
    return left.unionByName(right).withColumn("pair", pair).groupBy("pair").applyInPandas(lambda group: _block_links(group, least), "a bigint, b bigint")


def row_key(doc_id: Column, text: Column) -> Column:
    """A digest of a row's id and text."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    return F.md5(F.concat(part(doc_id), F.lit(":"), part(text)))


def near_duplicates(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id and row_key of every row of ``docs`` (doc_id, text), linked
    at a similarity of ``least`` in OF."""
    halves = HALVES[least]
    importable(docs.sparkSession)
    signed = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), signature(F.col("text"), halves).alias("s"))
    signed = saved(signed.select("doc_id", "row_key", "s.*"), "neardup-signatures")
    classes = saved(signed.where("content is not null").groupBy("content").agg(
        F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"), F.count("*").alias("copies"), F.first("half").alias("half"))
        .select("content", F.xxhash64("content").alias("node"), "doc_id", "row_key", "copies", "half"), "neardup-classes")
    found = saved(survivors(classes, halves), "neardup-survivors")
    # one text of each survivor, found again by its row's key
    ids = found.select("node").join(classes.select("node", "row_key"), "node")
    texts = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "text").join(ids, "row_key").select("node", "text")
    texts = saved(texts.dropDuplicates(["node"]), "neardup-texts")
    alive = saved(found.join(with_shared_shingles(texts, least), "node"), "neardup-alive")
    live_texts = saved(texts.join(alive.select("node"), "node"), "neardup-live-texts")
    pairs = saved(star_pairs(alive), "neardup-pairs")
    compared = (pairs.join(live_texts, "node").select("pivot", F.col("node").alias("a"), F.col("text").alias("a_text"))
                .join(live_texts.select(F.col("node").alias("pivot"), F.col("text").alias("pivot_text")), "pivot"))
    links = saved(compared.where(linked(F.col("pivot_text"), F.col("a_text"), least)).select("a", F.col("pivot").alias("b")), "neardup-links")
    stars = saved(components(links), "neardup-stars")
    clusters = components(pairs.select(F.col("node").alias("a"), F.col("pivot").alias("b")))
    more = saved(rest_links(live_texts, clusters, stars, least), "neardup-more")
    roots = saved(components(links.unionByName(more)), "neardup-roots")
    # classes of several rows or in a component; every other row is its own component
    named = classes.join(roots, "node", "left").select("content", "copies", "doc_id", "root")
    names = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    named = named.where("copies > 1 or root is not null").join(names, "root", "left")
    named = named.select("content", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component"),
                         F.lit(True).alias("shared"))
    dropped(found, texts, alive, live_texts, pairs, links, stars, more)
    out = signed.select("doc_id", "row_key", "n", "content").join(named, "content", "left")
    return out.select("doc_id", "row_key", F.col("n").alias("n_shingles"),
                      F.when(F.col("shared"), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def op4_neardup(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows of ``docs`` that name their component, repeated rows once, with all their columns.
    Documents without an id can't be named by one: a group of such documents alone stays, each
    text once."""
    found = near_duplicates(docs.select("doc_id", "text"), least)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("row_key").alias("key")).distinct()
    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), F.struct("*").alias("row"))
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


# Exact in SQL for small tables: shared shingles counted per pair, then everything reachable.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT k, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
p AS (SELECT x.k AS a, y.k AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.k < y.k GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.k = a JOIN n y ON y.k = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(k, m) AS (SELECT k, k FROM d UNION SELECT e.b, r.m FROM r JOIN e ON r.k = e.a),
c AS (SELECT r.k, min(o.doc_id) AS component_id FROM r JOIN d o ON o.k = r.m GROUP BY r.k)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN c USING (k) LEFT JOIN n USING (k)"""
