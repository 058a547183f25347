"""Secret scans over versioned texts, with an incremental blob ledger.

Every version of a text is addressed by its content (SHA-256). The ledger is a Parquet
table of (blob, pack, spans): one row for each blob and rule-pack version that has been
scanned. A scan addresses the given versions, takes the blobs of which some (blob, pack
version) pair is missing, scans each such pair once however many paths share the blob, and
appends the findings; joining the ledger back by blob gives the findings of every path.

Only texts that hold a pack's keyword are carried to the scan (others are entered as clean),
and everything is made of DataFrame functions.

Defined results: a null text is the empty text; repeated rows and null ids each keep their
row and get the findings of their blob; an empty table gives no rows; other columns are
ignored. Spans are code points, end exclusive, of the whole match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm.shared import running_total, scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0        # the group whose length counts
    least: int = 1        # shorter matches are dropped after matching


@dataclass(frozen=True)
class Pack:
    """Rules with one version; a changed rule needs a new version, and is then scanned anew."""
    version: str
    gate: str             # a text without a match of this can't hold a match of any rule
    rules: tuple[Rule, ...]


# The base rules and their order.
BASE = Pack("base-1", "(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}", (
    Rule("assign", """(?i:password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
))
# The published token formats of widely used services.
VENDOR = Pack("vendor-1", "gh[pousr]_|xox[abprs]-|AIza|eyJ|-----BEGIN|sk_live_|glpat-", (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("stripe", "sk_live_[A-Za-z0-9]{16,}"),
    Rule("gitlab", "glpat-[A-Za-z0-9_-]{20,}"),
))
PACKS = (BASE, VENDOR)
SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's leftmost non-overlapping matches: the text split by the pattern gives what
    lies between them, and running totals of the lengths give their places."""
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    n = F.size(found)
    steps = F.zip_with(F.slice(between, 1, n), found, lambda gap, m: gap + F.length(m))
    whole = F.zip_with(
        F.arrays_zip(running_total(steps).alias("at"), F.slice(between, 1, n).alias("gap")),
        F.arrays_zip(found.alias("m"), counted.alias("g")),
        lambda a, b: F.struct((a["at"] + a["gap"]).alias("start"), F.lit(rank).alias("rank"),
                              F.lit(rule.kind).alias("kind"),
                              (a["at"] + a["gap"] + F.length(b["m"])).alias("end"),
                              F.length(b["g"]).alias("size")))
    kept = F.filter(whole, lambda s: s["size"] >= rule.least)
    out = F.transform(kept, lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"]))
    return F.when(text.rlike(rule.pattern), out).otherwise(F.expr("array()")).cast(SPANS)


def pack_spans(text: Column, pack: Pack, first_rank: int = 0) -> Column:
    """All spans of a pack in a text, by start and then in the order of the rules."""
    return F.array_sort(F.flatten(F.array(*[_spans(text, r, first_rank + i) for i, r in enumerate(pack.rules)])))


class BlobLedger:
    """The scanned (blob, pack version) pairs and their findings, in a shared folder."""

    def __init__(self, spark: SparkSession, path: str, packs: tuple[Pack, ...] = PACKS):
        self.spark, self.path, self.packs = spark, path, packs

    def read(self) -> DataFrame:
        schema = f"blob string, pack string, spans {SPANS}"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def address(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(path, text, blob) of every version."""
        text = F.coalesce(F.col(text_col), F.lit(""))
        return docs.select(F.col(id_col).alias("path"), text.alias("text"), F.sha2(text, 256).alias("blob"))

    def scan(self, versions: DataFrame) -> None:
        """Scan the unseen pairs among ``versions`` (of :meth:`address`) and enter them."""
        gated = F.lit(False)
        for p in self.packs:
            gated = gated | F.col("text").rlike(p.gate)
        # one row for each blob; the text travels only where some pack's keyword occurs
        blobs = (versions.select("blob", F.when(gated, F.col("text")).alias("text"))
                 .groupBy("blob").agg(F.max("text").alias("text")))
        wanted = blobs.select("blob", "text", F.explode(F.array(*[F.lit(p.version) for p in self.packs])).alias("pack"))
        unseen = wanted.join(self.read().select("blob", "pack"), ["blob", "pack"], "left_anti")
        # the patterns' work is many times that of reading the texts: as many tasks as the session
        # has partitions, where adaptive execution would fold the rows into a few by their bytes
        unseen = unseen.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        spans, rank = F.lit(None).cast(SPANS), 0
        for p in self.packs:
            spans = F.when((F.col("pack") == p.version) & F.col("text").rlike(p.gate),
                           pack_spans(F.col("text"), p, rank)).otherwise(spans)
            rank += len(p.rules)
        clean = F.expr("array()").cast(SPANS)
        unseen.select("blob", "pack", F.coalesce(spans, clean).alias("spans")).write.mode("append").parquet(self.path)

    def findings(self, versions: DataFrame) -> DataFrame:
        """(path, spans) of every version: the ledger joined back to all paths."""
        packs = [p.version for p in self.packs]
        # a pair that two scans entered at the same time counts once
        hits = (self.read().where((F.size("spans") > 0) & F.col("pack").isin(packs)).dropDuplicates(["blob", "pack"])
                .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")))
        out = versions.select("path", "blob").join(hits, "blob", "left")
        return out.select("path", F.coalesce("spans", F.expr("array()").cast(SPANS)).alias("spans"))


def secret_findings(docs: DataFrame, packs: tuple[Pack, ...] = PACKS) -> DataFrame:
    """Findings (path, spans) of ``docs``, scanned through a new ledger."""
    spark = docs.sparkSession
    ledger = BlobLedger(spark, scratch_path(spark, "ledger"), packs)
    versions = ledger.address(docs)
    ledger.scan(versions)
    return ledger.findings(versions)


def without_secrets(docs: DataFrame, packs: tuple[Pack, ...] = PACKS) -> DataFrame:
    """Rows of ``docs`` in whose text nothing is found, with all their columns."""
    spark = docs.sparkSession
    ledger = BlobLedger(spark, scratch_path(spark, "ledger"), packs)
    ledger.scan(ledger.address(docs))
    hits = ledger.read().where(F.size("spans") > 0).select("blob").distinct()
    rows = docs.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"), F.struct("*").alias("row"))
    return rows.join(hits, "blob", "left_anti").select("row.*")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(
        s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def op8_secrets(docs: DataFrame) -> DataFrame:
    found = secret_findings(docs)
    base = F.filter("spans", lambda s: s["rank"] < len(BASE.rules))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("path").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def oracle() -> str:
    """The same rows in DuckDB SQL: matches and the gaps between them, placed by prefix sums."""
    parts = []
    rank = 0
    for pack in PACKS:
        for r in pack.rules:
            pattern = r.pattern.replace("\\x20", " ").replace("'", "''")
            parts.append(f"""
  SELECT doc_key, {rank} AS rank, '{r.kind}' AS kind, regexp_extract_all(t, '{pattern}') AS m,
         regexp_extract_all(t, '{pattern}', {r.group}) AS g, regexp_split_to_array(t, '{pattern}') AS gaps, {r.least} AS least
  FROM d WHERE regexp_matches(t, '{pattern}')""")
            rank += 1
    return f"""
WITH d AS (SELECT row_number() OVER () AS doc_key, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(parts)}),
each AS (SELECT doc_key, rank, kind, least, unnest(range(1, len(m) + 1)) AS i, m, g, gaps FROM found),
placed AS (SELECT doc_key, rank, kind, i,
    coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s, length(m[i]) AS n
  FROM each WHERE length(g[i]) >= least),
per AS (SELECT doc_key, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, rank) FILTER (rank < {len(BASE.rules)}) AS base,
    string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, rank) AS spans
  FROM placed GROUP BY doc_key)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_key)"""
