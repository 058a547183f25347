"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put in a shuffled order (by a digest of the id) and laid end to
end; the stream is cut into blocks of equal numbers of words. A source gets as many slots of
the schedule as its target asks for. Slot t lies at the point t * g modulo N of the N slots,
with g next to N divided by the golden ratio and without a common divisor with N, so the
points are a golden-ratio sequence that meets every place once; cumulative slot counts of the
sources map a point to its source. The slots of a source are ranked, and rank r takes block r
modulo the number of blocks, so repeats are passes over the whole source.

Nothing depends on one task per source: points are joined to sources by chunks of the point
range, ranks and offsets are made of totals of chunks (or of digest prefixes) and running
sums inside them, and targets of running totals over ranges of the table of sources, which may
be long. ``scheduled_mix`` is the mix itself: which document's words stand at which slot.

Defined results: a null text has size 0; documents of size 0 are taken 0 times; a null source
is one source, last in order; equal digests (repeated ids) are ordered by size; an empty
table, or one without words, takes nothing (no first slot); other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.ranking import running_totals
from tablesmith.llm.shared import id_text, saved

# Weights by rank of the source, share of all words, and the most repeats.
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 128             # parameter: words of a block
CHUNK = 1 << 14         # slots or points that are ranked together
PREFIX = 3              # hexadecimal digits of the digest whose totals are added up first
SEED = "mix-1"          # parameter: another seed shuffles anew


def document_sizes(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select("doc_id", "source", size.alias("size"))


def source_targets(sized: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per source: its size, weight, target, blocks, slots and the range of points
    [low, high) that is its own. Targets share the total by weight; what exceeds a source's
    limit is shared again until none does: target = min(limit, level * weight), the level found
    over the sources in order of limit / weight."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # running totals over ranges of the source table: it may be as long as a list of hosts
    per = per.select("source", "source_size", F.struct(F.col("source").isNull().alias("none"), "source").alias("place"), F.lit(1).cast("bigint").alias("one"))
    per = running_totals(per, [], "place", ["one", "source_size"]).select(
        "source", "source_size", (F.col("cum_one") - 1).alias("rank"), F.col("tot_source_size").alias("every"),
        (F.lit(float(REPEATS)) * F.col("source_size")).alias("limit"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
    per = running_totals(per.withColumn("place", F.struct((F.col("limit") / F.col("weight")).alias("ratio"), "rank")), [], "place", ["limit", "weight"])
    left = F.col("tot_weight") - F.col("cum_weight") + F.col("weight")
    per = saved(per.withColumn("level", (SHARE * F.col("every") - (F.col("cum_limit") - F.col("limit"))) / left), "mix-levels")
    first = per.where("level <= place.ratio").agg(F.min_by("level", "place").alias("level")).first()["level"]
    size, level = F.col("source_size"), F.lit(0.0 if first is None else first)
    per = per.withColumn("target", F.least(F.col("limit"), level * F.col("weight")))
    blocks = F.ceil(size / block)
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    slots = passes * blocks + F.when(size > 0, F.round((F.col("target") - passes * size) / block)).otherwise(0).cast("bigint")
    per = per.select("source", "rank", "source_size", "target", blocks.cast("bigint").alias("blocks"), slots.cast("bigint").alias("slots"))
    return running_totals(per, [], "rank", ["slots"]).select(
        "source", "rank", "source_size", "target", "blocks", "slots", (F.col("cum_slots") - F.col("slots")).alias("low"), F.col("cum_slots").alias("high"))


def golden_step(n: int) -> int:
    """The step next to n / golden ratio that has no common divisor with n."""
    g = max(1, round(n * (math.sqrt(5) - 1) / 2))
    while math.gcd(g, n) != 1:
        g += 1
    return g % n if n > 1 else 1


def schedule(targets: DataFrame) -> DataFrame:
    """(slot, rank, pass, block): which block of which source each slot of the mix takes."""
    spark = targets.sparkSession
    n = targets.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0]
    g = golden_step(n) if n else 1
    wide = lambda c: c.cast("decimal(19,0)")
    point = (wide(F.col("id")) * F.lit(g).cast("decimal(19,0)") % F.lit(max(n, 1)).cast("decimal(19,0)")).cast("bigint")
    slots = spark.range(n).select(F.col("id").alias("slot"), point.alias("point"))
    slots = slots.withColumn("chunk", F.floor(F.col("point") / CHUNK))
    ranges = targets.where("slots > 0").select("rank", "blocks", "low", "high", F.explode(
        F.sequence(F.floor(F.col("low") / CHUNK), F.floor((F.col("high") - 1) / CHUNK))).alias("chunk"))
    placed = slots.join(ranges, "chunk").where("point >= low and point < high").select("slot", "rank", "blocks")
    placed = placed.withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    totals = placed.groupBy("rank", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("rank", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("rank", "chunk").orderBy("slot")) - 1
    ranked = placed.withColumn("inside", inside).join(starts, ["rank", "chunk"])
    r = F.col("start") + F.col("inside")
    return ranked.select("slot", "rank", F.floor(r / F.col("blocks")).alias("pass"), (r % F.col("blocks")).alias("block"))


def offsets(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with words: (rank, doc_id, size, at), ``at`` being the words of the source's
    shuffled stream before it."""
    ranks = targets.select(F.col("source").alias("_source"), "rank")
    rows = sized.where("size > 0").join(ranks, F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.select("rank", "doc_id", "size", F.md5(F.concat(id_text(F.col("doc_id")), F.lit(f":{SEED}"))).alias("key"))
    rows = rows.withColumn("prefix", F.substring("key", 1, PREFIX))
    totals = rows.groupBy("rank", "prefix").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("rank").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("rank", "prefix", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = F.coalesce(F.sum("size").over(Window.partitionBy("rank", "prefix").orderBy("key", "size")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (rows.withColumn("inside", inside).join(starts, ["rank", "prefix"])
            .select("rank", "doc_id", "size", (F.col("start") + F.col("inside")).alias("at")))


def block_pieces(placed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(rank, block, doc_id, at, size, words): the words that each document has in each block."""
    first, last = F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)
    pieces = placed.withColumn("block", F.explode(F.sequence(first, last)))
    words = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block) - F.greatest("at", F.col("block") * block)
    return pieces.withColumn("words", words)


def scheduled_mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as a reader takes it: (slot, source, pass, block, at, doc_id, first_word, words), a
    row for each document with words in the block that a slot takes, in order of slot and ``at``
    (the words of the block before it); ``first_word`` counts the document's own words."""
    sized = saved(document_sizes(docs), "mix-sizes")
    targets = saved(source_targets(sized, block), "mix-targets")
    pieces = block_pieces(offsets(sized, targets), block)
    start = F.greatest("at", F.col("block") * block)
    pieces = pieces.select("rank", "block", "doc_id", (start - F.col("block") * block).alias("in_block"), (start - F.col("at")).alias("first_word"), "words")
    return (schedule(targets).join(pieces, ["rank", "block"]).join(targets.select("rank", "source"), "rank")
            .select("slot", "source", "pass", "block", F.col("in_block").alias("at"), "doc_id", "first_word", "words"))


def mixture(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and first_slot (the first slot of the mix
    that takes words of it; null if none does) of every row of ``docs``."""
    sized = saved(document_sizes(docs), "mix-sizes")
    targets = saved(source_targets(sized, block), "mix-targets")
    uses = schedule(targets).groupBy("rank", "block").agg(F.count("*").alias("uses"), F.min("slot").alias("slot"))
    pieces = block_pieces(offsets(sized, targets), block)
    taken = (pieces.join(uses, ["rank", "block"], "left").groupBy("rank", "at", "size", "doc_id")
             .agg(F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken"), F.min("slot").alias("first_slot"))
             .select("rank", "doc_id", "size", "taken", "first_slot"))
    none = (sized.where("size = 0").join(targets.select(F.col("source").alias("_source"), "rank"), F.col("source").eqNullSafe(F.col("_source")))
            .select("rank", "doc_id", "size", F.lit(0).cast("bigint").alias("taken"), F.lit(None).cast("bigint").alias("first_slot")))
    return (taken.unionByName(none).join(targets.select("rank", "source", "source_size", "target"), "rank")
            .select("doc_id", "source", "size", "source_size", "target", "taken", "first_slot"))


def op9_mixture(docs: DataFrame) -> DataFrame:
    return mixture(docs).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


ORACLE = rf"""
WITH s AS (SELECT row_number() OVER () AS k, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s GROUP BY source),
w AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, {REPEATS}.0::DOUBLE * source_size AS lim FROM per),
l AS (SELECT *, ({SHARE}::DOUBLE * sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT *, least(lim, weight * (SELECT arg_min(level, lim / weight) FROM l WHERE level <= lim / weight)) AS target FROM l),
b AS (SELECT *, ceil(source_size / {BLOCK}.0)::BIGINT AS blocks, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM t),
c AS (SELECT *, CASE WHEN source_size > 0 THEN round((target - passes * source_size) / {BLOCK}.0) ELSE 0 END::BIGINT AS more FROM b),
o AS (SELECT k, s.doc_id, s.size, c.*, coalesce(sum(s.size) OVER (PARTITION BY rank ORDER BY md5(coalesce(s.doc_id::VARCHAR, '') || ':{SEED}'), s.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM s JOIN c ON s.source IS NOT DISTINCT FROM c.source),
n AS (SELECT sum(passes * blocks + more)::BIGINT AS n, greatest(1, round(sum(passes * blocks + more) * (sqrt(5) - 1) / 2))::BIGINT AS g FROM c),
g AS (SELECT n, CASE WHEN n > 1 THEN (SELECT min(g + i) FROM range(1000) t(i) WHERE gcd(g + i, n) = 1) % n ELSE 1 END AS g FROM n),
r AS (SELECT rank, blocks, sum(passes * blocks + more) OVER (ORDER BY rank) - (passes * blocks + more) AS low, sum(passes * blocks + more) OVER (ORDER BY rank) AS high FROM c),
p AS (SELECT slot, (slot::HUGEINT * g % n)::BIGINT AS point FROM g, range((SELECT n FROM g)) q(slot)),
u AS (SELECT rank, slot, (row_number() OVER (PARTITION BY rank ORDER BY slot) - 1) % blocks AS block FROM p JOIN r ON point >= low AND point < high),
f AS (SELECT rank, block, min(slot) AS slot FROM u GROUP BY rank, block),
e AS (SELECT k, rank, unnest(range((place // {BLOCK})::BIGINT, ((place + size - 1) // {BLOCK})::BIGINT + 1)) AS block FROM o WHERE size > 0),
h AS (SELECT k, min(slot) AS first_slot FROM e JOIN f ON e.rank = f.rank AND e.block = f.block GROUP BY k)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (CASE WHEN size = 0 THEN 0 ELSE passes * size + greatest(0, least(place + size, more * {BLOCK}) - place) END)::BIGINT AS taken, first_slot
FROM o LEFT JOIN h ON o.k = h.k"""
