"""Benchmark decontamination with one Aho-Corasick automaton.

Windows of ten consecutive words of the benchmark items (an item of fewer words is one
window) become patterns of an automaton over words: each word of the benchmark is one
symbol, every other word is one symbol that no pattern holds, so a text is scanned once,
whatever the number of items. Hits are intervals of words, mapped back to code points of
the original text.

The benchmark is the query set and the corpus is the other side. Items go to the executors
in blocks of at most about ``block_bytes`` of text, each block as one broadcast automaton
and GROUP blocks in one scan, so what is collected, broadcast and held by a worker at once has
a set bound whatever the size of the benchmark.

Defined results: a null or empty text has no words and no hits; an item without words has
no windows; a null item id hits but is not listed; repeated items count once, repeated rows
of the corpus each keep their row; an empty benchmark hits nothing; other columns stay as
they are (the operator works on one column and returns one).
"""

from __future__ import annotations

import functools
import re
import uuid
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tablesmith.llm.shared import dropped, importable, saved

# Ten words a window; what separates words.
WINDOW = 10
SEPARATOR = [c for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122)]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BLOCK_BYTES = 1 << 20     # parameter: benchmark text in one automaton
GROUP = 4                 # parameter: automata that a scan broadcasts and a worker holds at once
HITS = "struct<n_words:bigint,hits:array<struct<first:int,last:int,start:int,end:int>>,items:array<string>>"

_FOLD = bytearray(range(256))
_FOLD[65:91] = bytes(range(97, 123))
for _c in SEPARATOR:
    if not 65 <= _c <= 90:
        _FOLD[_c] = 32
_FOLD = bytes(_FOLD)


def words_of(text: str) -> list[bytes]:
    """The words of a text as UTF-8: one pass folds ASCII letters and separators."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Matcher:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[str | None, str]]):
        import ahocorasick

        self.symbol: dict[bytes, str] = {}
        windows: dict[str, set[str]] = defaultdict(set)
        for item_id, text in items:
            line = "".join([self._code(w) for w in words_of(text)])
            for i in range(max(len(line) - WINDOW, 0) + 1 if line else 0):
                windows[line[i:i + WINDOW]].update([] if item_id is None else [item_id])
        self.automaton = ahocorasick.Automaton()
        for w, ids in windows.items():
            self.automaton.add_word(w, (len(w), tuple(ids)))
        if windows:
            self.automaton.make_automaton()
        self.any = bool(windows)

    def _code(self, word: bytes) -> str:
        if word not in self.symbol:
            n = len(self.symbol) + 2                       # 1 is any word of no item
            self.symbol[word] = chr(n if n < 0xD800 else n + 0x800)
        return self.symbol[word]

    def scan(self, text: str) -> tuple[int, list, list]:
        words = words_of(text)
        if not self.any or not words:
            return len(words), [], []
        get = self.symbol.get
        line = "".join([get(w, "\x01") for w in words])
        found, items = [], set()
        for end, (n, ids) in self.automaton.iter(line):
            found.append((end - n + 1, end + 1))
            items.update(ids)
        if not found:
            return len(words), [], []
        found.sort()
        merged = [list(found[0])]
        for first, last in found[1:]:
            if first <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], last)
            else:
                merged.append([first, last])
        places = [m.span() for m in WORD.finditer(text)]
        hits = [{"first": a, "last": b, "start": places[a][0], "end": places[b - 1][1]} for a, b in merged]
        return len(words), hits, sorted(items)


_BUILT: dict[str, Matcher] = {}       # the automata of this worker's scan


def _matcher(key: str, items) -> Matcher:
    if key not in _BUILT:
        if len(_BUILT) >= GROUP:
            _BUILT.clear()
        _BUILT[key] = Matcher(items.value)
    return _BUILT[key]


def _scanner(spark, items: list) -> tuple:
    importable(spark)
    key, sent = uuid.uuid4().hex, spark.sparkContext.broadcast(items)

    @pandas_udf(HITS)
    def scan(texts: pd.Series) -> pd.DataFrame:
        matcher = _matcher(key, sent)
        rows = [matcher.scan(t or "") for t in texts]
        return pd.DataFrame({"n_words": [r[0] for r in rows], "hits": [r[1] for r in rows], "items": [r[2] for r in rows]})

    return scan, sent


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """Groups of GROUP blocks, each a list of (id, text) items of about ``block_bytes`` of text;
    a group is collected when it is asked for."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull()).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    if n > GROUP:
        items = saved(items, "benchmark-items")
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for first in range(0, n, GROUP):
        own = [[] for _ in range(min(GROUP, n - first))]
        for at, item_id, text in items.select(block.alias("b"), "item_id", "text").where(block.between(first, first + len(own) - 1)).toLocalIterator():
            own[at - first].append((item_id, text))
        yield own
    if n > GROUP:
        dropped(items)


def _found(texts: DataFrame, blocks: list[list], text_col: Column, *others: str) -> tuple[DataFrame, list]:
    """``others`` of ``texts`` with n_words, hits and items by the blocks, and what was broadcast."""
    scanners = [_scanner(texts.sparkSession, b) for b in blocks]
    step = texts.select(*others, F.array(*[scan(text_col) for scan, _ in scanners]).alias("found"))
    return step.select(*others, F.get("found", F.lit(0))["n_words"].alias("n_words"), F.flatten(F.transform("found", lambda b: b["hits"])).alias("hits"),
                       F.flatten(F.transform("found", lambda b: b["items"])).alias("items")), [sent for _, sent in scanners]


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` as (row, n_words, n_hit, hits, items): the whole row in a struct, so that no
    column of it can clash.

    The corpus is scanned once per group of blocks. All groups but the last leave a table of the
    texts that they hit, which the last scan joins by the text's digest."""
    rows = docs.select(F.struct("*").alias("row"))
    text = F.col(f"row.{text_col}")
    key = F.md5(F.coalesce(text, F.lit("")))
    groups = benchmark_blocks(benchmark, block_bytes)
    now, tables = next(groups), []
    for after in groups:
        found, sent = _found(rows.select(key.alias("key"), text.alias("text")), now, F.col("text"), "key")
        tables.append(saved(found.where(F.size("hits") > 0).select("key", "hits", "items").dropDuplicates(["key"]), "benchmark-hits"))
        for s in sent:
            s.destroy()
        now = after
    step, _ = _found(rows, now, text, "row")
    if tables:
        earlier = functools.reduce(DataFrame.unionByName, tables).groupBy("key").agg(
            F.flatten(F.collect_list("hits")).alias("h"), F.flatten(F.collect_list("items")).alias("i"))
        none = lambda c, like: F.concat(like, F.coalesce(c, F.slice(like, 1, 0)))
        step = step.join(earlier, key == F.col("key"), "left").select(
            "row", "n_words", none(F.col("h"), F.col("hits")).alias("hits"), none(F.col("i"), F.col("items")).alias("items"))
    step = step.select("row", "n_words", F.array_sort("hits").alias("hits"), F.array_sort(F.array_distinct("items")).alias("items"))
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).alias("to"), F.lit(0).cast("bigint").alias("n")),
        lambda s, h: F.struct(F.greatest(s["to"], h["last"]).alias("to"),
                              (s["n"] + F.greatest(h["last"] - F.greatest(s["to"], h["first"]), F.lit(0))).alias("n")))["n"]
    return step.select("row", "n_words", covered.alias("n_hit"), "hits", "items")


def op3_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = with_hits(docs.select("doc_id", "text"), benchmark)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


# Words by the regular expression, windows and documents' word runs as joined strings, met by an equality join.
ORACLE = r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT row_number() OVER () AS k, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, fold),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, fold),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
run AS (SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
  SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
met AS (SELECT k, i, run.n AS n, item_id FROM run JOIN win ON run.n = win.n AND run.g = win.g),
hit AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM met) GROUP BY k),
its AS (SELECT k, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (
  SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS s FROM met WHERE item_id IS NOT NULL) GROUP BY k)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (k) LEFT JOIN its USING (k)"""
