"""Toxicity by class-conditional Kneser-Ney models.

One model of the letters of words for toxic and one for ordinary texts, each with absolute
discounting and interpolation: the class's eight-grams (up to seven letters of the same word
before a letter; a word's end is a letter too) over backoff counts shared by both classes
(in how many of their longer events a two-gram stands). Where either class has not seen the
letters before, both back off to the shared counts, so that an expression that is rare in
both classes costs both the same. Letters rather than whole words let the forms of an
expression share their counts.

The score of an expression (a word) is the difference of its toxic and ordinary
log-likelihoods. A text is as toxic as the mean of its three worst expressions, which keeps
scores of short and long texts comparable. A logistic curve, fitted on labelled texts that
its models have not seen, turns that into a probability. Beside it stands the comparison of the
classes' length-normalised log-likelihoods over the whole text: the sum of the scores of all its words, each
as often as it occurs, by the number of its letters (``likelihood``; above 0: toxic likelier).

Counts are exact and are tables: every event of every labelled text outside the held-out
rows has its row, so the model grows with the corpus. The score of a word depends on the word
only, so each distinct word of the corpus is scored once, by joining its events to the counts;
then each text joins its words' scores. The most frequent events and words (a set size, which
holds every hot key) go to the tasks as small broadcasts with their exact values, and only the
others are shuffled; none of those is frequent. Rows whose crc32 remainder is 0 or 1 train the
models under the curve, those with 3 the curve; then all three train the models that score.
Rows with 2 are held out from all.

Defined results: a null text is the empty text, and a text without words scores the share of
toxic labels; a document with several labels counts as toxic if any is; labels without a
document and null labels are ignored; without labels of both classes every score is the
share of toxic labels (0 without any); without words or without labels of both classes the
likelihood is null; repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.op3_decontaminate import words_of
from tablesmith.llm.shared import dropped, held_out, id_text, importable, part_of_saved, saved

ORDER = 8                            # parameter: letters of an event, the last one predicted
WORST = 3                            # parameter: expressions that make a text's score
THRESHOLD = 0.3                      # fixed value
CALIBRATION_BINS = 4096              # parameter: resolution of the fitted curve's input
SPAN = 32.0                          # parameter: the curve is fitted for scores in [-SPAN, SPAN]
HOT = 1 << 17                        # parameter: events, and words, whose values are broadcast
FLUSH = 1 << 20                      # events that a task holds before it adds them up
HELD_WORDS, HELD_BYTES = 1 << 17, 1 << 26    # distinct words, and bytes of text, likewise
KEY_BYTES = 16                       # longer words go by a digest of this size
END = 32
USES = ("fit", "every")              # the models under the curve, and those that score
FILTER_BUCKETS = 256                 # parameter: of 32768 bits each (1 MB) in the filter of labelled ids
EVENT_FILTER_BITS = 25               # parameter: 4 MB, the filter of events that have a ratio


def events(words: list[bytes]) -> np.ndarray:
    """For each byte of the words, and each word's end, the byte below up to seven bytes before
    it in the same word (eight bytes in one number); what precedes a word counts as one end."""
    line = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint64)
    n = len(line) - 1
    keys = line[1:].copy()
    inside = np.ones(n, dtype=bool)
    for k in range(1, ORDER):
        before = np.zeros(n, dtype=np.uint64)
        before[k - 1:] = line[:max(n - k + 1, 0)]
        before[~inside] = 0
        keys |= before << np.uint64(8 * k)
        inside &= (before != END) & (before != 0)
    return keys


def slot(keys: np.ndarray, bits: int) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits)).astype(np.int64)


def word_key(word: bytes) -> bytes:
    """The word, or a digest (after a space, which no word holds) of a long one."""
    return word if len(word) <= KEY_BYTES else b" " + hashlib.blake2b(word, digest_size=KEY_BYTES).digest()


def text_key(text: Column) -> Column:
    """A digest of a text; equal texts have equal scores."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words of each kind of text, added up in the task."""
    held: dict[int, Counter] = defaultdict(Counter)
    size = 0

    def flush():
        while held:
            kind, words = held.popitem()
            yield pd.DataFrame({"kind": np.int32(kind), "word": list(words), "n": np.fromiter(words.values(), np.int64, len(words))})

    for batch in batches:
        for kind, text in zip(batch["kind"], batch["text"], strict=True):
            words = words_of(text)
            if words:
                held[kind].update(words)
                size += len(text)
            if size > HELD_BYTES or sum(map(len, held.values())) > HELD_WORDS:
                yield from flush()
                size = 0
    yield from flush()


def _count_events(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Events of (kind, word, n), added up in the task."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
    size = 0

    def flush():
        while held:
            kind, parts = held.popitem()
            keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            keys, n = keys[first], np.add.reduceat(n, first)
            for at in range(0, len(keys), 100_000):
                yield pd.DataFrame({"kind": np.int32(kind), "event": keys[at:at + 100_000].view(np.int64), "n": n[at:at + 100_000]})

    for batch in batches:
        for kind, own in batch.groupby("kind"):
            words = own["word"].tolist()
            keys = events(words)
            held[kind].append((keys, np.repeat(own["n"].to_numpy(), [len(w) + 1 for w in words])))
            size += len(keys)
        if size > FLUSH:
            yield from flush()
            size = 0
    yield from flush()


def _event_places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"place": slot(b["event"].to_numpy().view(np.uint64), EVENT_FILTER_BITS)})


def frequent(table: DataFrame, n: str) -> DataFrame:
    """The rows of the highest ``n``, HOT of them at most: those left out are not frequent."""
    level = F.floor(F.log2(F.col(n)) * 8)
    least, rows = 1 << 30, 0
    for at, size in sorted(table.groupBy(level.alias("level")).count().collect(), reverse=True):
        rows += size
        if rows > HOT:
            break
        least = at
    return table.where(level >= least)


def _columns(df: DataFrame) -> list[np.ndarray]:
    """A bounded table as arrays."""
    return [c.to_numpy(zero_copy_only=False) for c in df.toArrow().combine_chunks().columns]


def event_counts(train: DataFrame) -> DataFrame:
    """(event, n00, n01, n10, n11): the counts of ``train`` (text, toxic, curve) by class and use."""
    kind = F.col("toxic") * 2 + F.col("curve").cast("int")
    words = (train.select(kind.alias("kind"), "text").mapInPandas(_count_words, "kind int, word binary, n bigint")
             .groupBy("kind", "word").agg(F.sum("n").alias("n")))
    summed = lambda *kinds: F.sum(F.when(F.col("kind").isin(*kinds), F.col("n")).otherwise(0))
    return words.mapInPandas(_count_events, "kind int, event bigint, n bigint").groupBy("event").agg(
        summed(0).alias("n00"), summed(0, 1).alias("n01"), summed(2).alias("n10"), summed(2, 3).alias("n11"))


def event_ratios(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(event, n, fit, every): toxic less ordinary log-likelihood of the ``wanted`` events (event, n)
    whose context both classes have seen; the others' is 0."""
    spark = counts.sparkSession
    names = [f"n{c}{u}" for c in (0, 1) for u in (0, 1)]
    rare = counts.agg(*[F.count_if(F.col(k) == n).alias(f"{k}_{n}") for k in names for n in (1, 2)]).first()
    two = F.col("event").bitwiseAND(0xFFFF).cast("int")
    at, *kinds = _columns(counts.groupBy(two.alias("two")).agg(
        *[F.count_if(F.greatest(f"n0{u}", f"n1{u}") > 0).cast("double") for u in (0, 1)]))
    shared = {"two": np.arange(1 << 16, dtype=np.int32)}
    for use, k in zip(USES, kinds, strict=True):
        p = np.full(1 << 16, 0.01)
        p[at] += k
        p = p.reshape(256, 256)               # row: the letter before
        shared[f"p_{use}"] = (p / p.sum(axis=1, keepdims=True)).reshape(-1)
    shared = F.broadcast(spark.createDataFrame(pd.DataFrame(shared)))
    context = F.shiftrightunsigned("event", 8)
    contexts = counts.groupBy(context.alias("context")).agg(
        *[F.sum(k).alias(f"total_{k}") for k in names], *[F.count_if(F.col(k) > 0).alias(f"kinds_{k}") for k in names])
    contexts = contexts.where("total_n01 > 0 AND total_n11 > 0")
    ratios = []
    for u, use in enumerate(USES):
        p = []
        for c in (0, 1):
            k = f"n{c}{u}"
            once, twice = rare[f"{k}_1"], rare[f"{k}_2"]
            cut, total = once / (once + 2 * twice) if once else 0.5, F.greatest(F.col(f"total_{k}"), F.lit(1))
            mass = F.greatest(F.coalesce(k, F.lit(0)) - F.lit(cut), F.lit(0.0))
            p.append(mass / total + F.lit(cut) * F.col(f"kinds_{k}") / total * F.col(f"p_{use}") + F.lit(1e-12))
        known = (F.col(f"total_n0{u}") > 0) & (F.col(f"total_n1{u}") > 0)
        ratios.append(F.when(known, F.log(p[1] / p[0])).otherwise(0.0).alias(use))
    return (wanted.withColumn("context", context).join(contexts, "context").join(counts, "event", "left")
            .withColumn("two", two).join(shared, "two").select("event", "n", *ratios))


def bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``places`` (place)."""
    bucket, bit = F.floor(F.col("place") / 32768).cast("int"), F.col("place") % 32768
    out = np.zeros(1 << (bits - 3), np.uint8)
    for at, own in places.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit)).collect():
        out[at * 4096:(at + 1) * 4096] = np.frombuffer(own, np.uint8)
    return out


def word_scores(words: DataFrame, ratios: DataFrame) -> DataFrame:
    """(key, n, fit, every) of ``words`` (word, n): the sums over each word's events. The tables
    ``words`` and ``ratios`` are deleted when they have been read."""
    spark = words.sparkSession
    hot = frequent(ratios, "n").select("event", *USES)
    event, *values = _columns(hot)
    event = event.view(np.uint64)
    order = np.argsort(event)
    others = ratios.join(F.broadcast(hot.select("event")), "event", "left_anti").select("event")
    bits = bitmap(others.mapInPandas(_event_places, "place bigint"), EVENT_FILTER_BITS)
    sent = spark.sparkContext.broadcast((event[order], np.array(values)[:, order], bits))

    def sums(batches):
        event, values, bits = sent.value
        for b in batches:
            words = b["word"].tolist()
            keys = events(words)
            lengths = np.array([len(w) + 1 for w in words])
            ends = np.cumsum(lengths)
            at = np.searchsorted(event, keys)
            at[at == len(event)] = 0
            found = event[at] == keys if len(event) else np.zeros(len(keys), bool)
            out = [np.add.reduceat(np.where(found, v[at], 0.0) if len(event) else np.zeros(len(keys)), ends - lengths) for v in values]
            place = slot(keys, EVENT_FILTER_BITS)
            more = np.flatnonzero(~found & (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1))
            cuts = np.searchsorted(more, np.concatenate(([0], ends)))
            keys = keys.view(np.int64)
            names = [word_key(w) for w in words]
            yield pd.DataFrame({"kind": 0, "key": names, "n": b["n"], "fit": out[0], "every": out[1], "event": None})
            own = np.repeat(np.arange(len(words)), np.diff(cuts))
            yield pd.DataFrame({"kind": 1, "key": [names[i] for i in own], "n": None, "fit": None, "every": None, "event": keys[more]})

    # two tables of one pass: the sums, and the events that still have to be looked up
    schema = "key binary, n bigint, fit double, every double, event bigint"
    first = saved(words.select("word", "n").mapInPandas(sums, f"kind int, {schema}"), "toxicity-sums", by="kind")
    dropped(words)
    rest = saved(first.where("kind = 1").select("key", "event").join(ratios.select("event", *USES), "event")
                 .groupBy("key").agg(*[F.sum(u).alias(f"more_{u}") for u in USES]), "toxicity-rest")
    dropped(ratios, part_of_saved(first, "kind=1"))
    out = saved(first.where("kind = 0").join(rest, "key", "left").select(
        "key", "n", *[(F.col(u) + F.coalesce(f"more_{u}", F.lit(0.0))).alias(u) for u in USES]), "toxicity-scores")
    sent.destroy()
    dropped(first, rest)
    return out


def text_scores(texts: DataFrame, scores: DataFrame, use: str) -> DataFrame:
    """(text_key, x, likelihood) of the distinct texts of ``texts`` (text_key, text): the mean of the
    worst words' scores, and the sum of every word's score by the text's letters; null without words.
    Every word of a text is looked up."""
    keys, values = _columns(frequent(scores, "n").select("key", use))
    sent = texts.sparkSession.sparkContext.broadcast(dict(zip(keys, values.tolist(), strict=True)))

    def parts(batches):
        hot = sent.value
        for b in batches:
            top, total, letters, more, times = [], [], [], [], []
            for text in b["text"]:
                words = words_of(text)
                x = np.array([hot.get(w, np.nan) for w in words])
                other = Counter(words[i] for i in np.flatnonzero(np.isnan(x)))
                x = x[~np.isnan(x)]
                sum_x = x.sum()
                if len(x) > WORST:
                    x = np.partition(x, len(x) - WORST)[-WORST:]
                rare = {}
                for w, n in other.items():
                    key = word_key(w)
                    if key in hot:           # a long word
                        x = np.append(x, [hot[key]] * min(n, WORST))
                        sum_x += hot[key] * n
                    else:
                        rare[key] = n
                top.append(np.sort(x)[-WORST:])
                total.append(sum_x)
                letters.append(sum(map(len, words)) + len(words))        # a word's end is a letter too
                more.append(list(rare))
                times.append(list(rare.values()))
            yield pd.DataFrame({"text_key": b["text_key"], "top": top, "total": total, "letters": letters, "more": more, "times": times})

    out = texts.mapInPandas(parts, "text_key binary, top array<double>, total double, letters bigint, more array<binary>, times array<int>")
    out = saved(out.dropDuplicates(["text_key"]), "toxicity-parts")
    each = out.select("text_key", F.explode(F.arrays_zip("more", "times")).alias("w")).select("text_key", F.col("w.more").alias("key"), F.col("w.times").alias("times"))
    worst = lambda a: F.slice(F.sort_array(a, False), 1, WORST)
    rest = (each.join(scores.select("key", F.col(use).alias("x")), "key").groupBy("text_key")
            .agg(worst(F.flatten(F.collect_list(F.expr(f"array_repeat(x, least(times, {WORST}))")))).alias("rest"),
                 F.sum(F.col("x") * F.col("times")).alias("more_total")))
    both = worst(F.concat("top", F.coalesce("rest", F.expr("cast(array() as array<double>)"))))
    mean = F.when(F.size("both") > 0, F.aggregate("both", F.lit(0.0), lambda a, x: a + x) / F.size("both"))
    whole = F.try_divide(F.col("total") + F.coalesce("more_total", F.lit(0.0)), F.col("letters"))
    found = saved(out.join(rest, "text_key", "left").select("text_key", both.alias("both"), whole.alias("likelihood"))
                  .select("text_key", mean.alias("x"), "likelihood"), "toxicity-texts")
    sent.destroy()
    dropped(out)
    return found


def _curve(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and intercept of a logistic curve by Newton's method; bins of (score, label, count)."""
    x, y, n = (np.array(v, dtype=np.float64) for v in zip(*bins, strict=True))
    a, b = 0.0, float(np.log((n[y == 1].sum() + 0.5) / (n[y == 0].sum() + 0.5)))
    scale = np.sqrt((n * x * x).sum() / n.sum()) or 1.0
    x = x / scale
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = n * p * (1 - p)
        ga, gb = (n * (y - p) * x).sum() - 0.01 * a, (n * (y - p)).sum()
        haa, hab, hbb = (w * x * x).sum() + 0.01, (w * x).sum(), w.sum() + 1e-9
        det = haa * hbb - hab * hab
        da, db = (ga * hbb - gb * hab) / det, (gb * haa - ga * hab) / det
        step = min(1.0, 4.0 / max(abs(da), abs(db), 1e-9))
        a, b = a + step * da, b + step * db
        if max(abs(da), abs(db)) < 1e-9:
            break
    return a / scale, b


def _maybe_labelled(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose id may have a label, by a bitmap of hashed ids of a fixed size, so
    that texts without a label stay out of the shuffle of the join that follows. Ids beyond the
    bitmap's resolution only let more rows through."""
    spark = texts.sparkSession
    place = F.pmod(F.xxhash64("_id"), F.lit(FILTER_BUCKETS * 32768))
    bitmaps = (marks.select(F.floor(place / 32768).cast("int").alias("_bucket"), (place % 32768).alias("_bit"))
               .groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")).collect())
    bitmaps = F.broadcast(spark.createDataFrame(bitmaps, "_bucket int, _bits binary"))
    rows = texts.withColumn("_bucket", F.floor(place / 32768).cast("int")).withColumn("_bit", (place % 32768).cast("int")).join(bitmaps, "_bucket")
    byte = F.conv(F.hex(F.expr("substring(_bits, _bit div 8 + 1, 1)")), 16, 10).cast("int")
    return rows.where(F.getbit(byte, F.col("_bit") % 8) == 1).select("_id", "text")


class ToxicityScorer:
    """Fitted on the labelled ones of ``docs``; ``scored`` gives their texts' probability of label 1."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        importable(docs.sparkSession)
        text = F.coalesce(F.col(text_col), F.lit(""))
        marks = (labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("_id"))
                 .agg(F.max("toxic").cast("int").alias("toxic")))
        texts = docs.select(F.col(id_col).alias("_id"), text.alias("text")).where(~held_out(F.col("_id")))
        train = saved(_maybe_labelled(texts, marks).join(marks, "_id").select(
            "text", "toxic", (F.crc32(id_text(F.col("_id"))) % 4 == 3).alias("curve")), "toxicity-train")
        n = {r[0]: r[1] for r in train.groupBy("toxic").count().collect()}
        self.prior = n.get(1, 0) / max(1, sum(n.values()))
        self.raw, self.a, self.b = None, 1.0, float(np.log((self.prior + 1e-6) / (1 - self.prior + 1e-6)))
        if n.get(0) and n.get(1):
            words = saved(docs.select(F.lit(0).alias("kind"), text.alias("text")).mapInPandas(_count_words, "kind int, word binary, n bigint")
                          .groupBy("word").agg(F.sum("n").alias("n")), "toxicity-words")
            counts = saved(event_counts(train), "toxicity-counts")
            wanted = words.select(F.lit(0).alias("kind"), "word", F.lit(1).cast("bigint").alias("n"))
            wanted = wanted.mapInPandas(_count_events, "kind int, event bigint, n bigint").groupBy("event").agg(F.sum("n").alias("n"))
            # what is written is deleted as soon as the next table stands, to keep the peak of the disk low
            curve = saved(train.where("curve").select(text_key(F.col("text")).alias("text_key"), "text", "toxic"), "toxicity-curve")
            dropped(train)
            train = None
            ratios = saved(event_ratios(counts, wanted), "toxicity-ratios")
            dropped(counts)
            scores = word_scores(words, ratios)
            known = text_scores(curve.select("text_key", "text"), scores, "fit")
            place = F.floor((F.col("x") + SPAN) * (CALIBRATION_BINS / (2 * SPAN)))
            bins = (curve.select("text_key", "toxic").join(known, "text_key").where("x is not null")
                    .groupBy(F.least(F.greatest(place, F.lit(0)), F.lit(CALIBRATION_BINS - 1)).alias("bin"), "toxic").count().collect())
            dropped(curve, known)
            points = [((r[0] + 0.5) * 2 * SPAN / CALIBRATION_BINS - SPAN, r[1], r[2]) for r in bins]
            if {p[1] for p in points} == {0, 1}:
                self.a, self.b = _curve(points)
            self.raw = text_scores(docs.select(text_key(F.col(text_col)).alias("text_key"), text.alias("text")), scores, "every")
            dropped(scores)
        if train is not None:
            dropped(train)

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with the ``text_key`` of a text of the documents), their ``score`` and ``likelihood``."""
        if self.raw is None:
            return rows.withColumns({"score": F.lit(self.prior), "likelihood": F.lit(None).cast("double")})
        score = F.coalesce(1 / (1 + F.exp(-(F.lit(self.a) * F.col("x") + F.lit(self.b)))), F.lit(self.prior))
        return rows.join(self.raw, "text_key").withColumn("score", score).drop("x")


def op6_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scorer = ToxicityScorer(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_key(F.col("text")).alias("text_key"))
    return scorer.scored(rows).select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "likelihood")
