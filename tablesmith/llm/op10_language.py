"""Language identification with hyperdimensional profiles.

Every letter has a random vector of plus and minus ones (from a generator seeded by the
letter). Three letters in a row are bound into one vector: the first permuted twice, the
second once, the third as it is, multiplied place by place. A text is the sum (bundle) of
its trigram vectors, words bounded by a space letter; a language is the sum over its
training texts. The prediction is the language whose prototype has the largest cosine with
the text's vector, which is also the score (0 at least; of equal cosines the first language
by code point).

Training reads all texts with a language outside the held-out rows; bundling is a sum, so a
task adds up trigram counts of its partition and sends one vector per language, and the
prototypes (one vector for each language) are what is broadcast.

Defined results: a null text and a text without letters are ``und`` with score 0; null
languages are not learned; without any learned language all is ``und``; repeated rows are
predicted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tablesmith.llm.shared import held_out, importable

DIMENSION = 1024          # parameter
REMEMBERED = 12_000       # trigram vectors that a worker keeps (48 MB)
UNKNOWN = "und"

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams (three code points in one number, 0 for the space letter) and counts."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    codes[~_letters()[codes]] = 0
    codes = np.concatenate(([0], codes, [0]))
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)      # one space for any run
    codes = codes[keep]
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)


class Vectors:
    """Trigram vectors as rows of one matrix, made when first met."""

    def __init__(self):
        self.letter: dict[int, np.ndarray] = {}
        self.row: dict[int, int] = {}
        self.matrix = np.empty((REMEMBERED, DIMENSION), np.float32)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letter:
            if len(self.letter) >= 20_000:
                self.letter.clear()
            bits = np.random.Generator(np.random.PCG64(code)).integers(0, 2, DIMENSION, dtype=np.int8)
            self.letter[code] = bits * np.int8(2) - np.int8(1)
        return self.letter[code]

    def _rows(self, keys: list[int]) -> list[int]:
        row = self.row
        new = [k for k in keys if k not in row]
        if len(row) + len(new) > REMEMBERED:
            row.clear()
            new = keys
        for k in new:
            a, b, c = k >> 42, k >> 21 & 0x1FFFFF, k & 0x1FFFFF
            row[k] = len(row)
            self.matrix[row[k]] = np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)
        return [row[k] for k in keys]

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(DIMENSION, np.float64)
        for at in range(0, len(keys), REMEMBERED):
            rows = self._rows(keys[at:at + REMEMBERED].tolist())
            total += counts[at:at + REMEMBERED].astype(np.float32) @ self.matrix[rows]
        return total


_VECTORS: list[Vectors] = []


def _vectors() -> Vectors:
    if not _VECTORS:
        _VECTORS.append(Vectors())
    return _VECTORS[0]


def _learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One vector for each language of the partition."""
    vectors = _vectors()
    total: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(DIMENSION, np.float64))
    counts: dict[str, dict[int, int]] = defaultdict(lambda: defaultdict(int))

    def settle(lang: str) -> None:
        c = counts.pop(lang)
        if c:
            keys = np.fromiter(c.keys(), np.int64, len(c))
            total[lang] += vectors.bundle(keys, np.fromiter(c.values(), np.int64, len(c)))

    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"], strict=True):
            own = counts[lang]
            keys, n = trigrams(text)
            for k, m in zip(keys.tolist(), n.tolist(), strict=True):
                own[k] += m
            if len(own) > 200_000:
                settle(lang)
    for lang in list(counts):
        settle(lang)
    if total:
        yield pd.DataFrame({"lang": list(total), "vector": [v.tolist() for v in total.values()]})


def prototypes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """A unit vector for each language of the training rows."""
    importable(docs.sparkSession)
    rows = docs.where(~held_out(F.col(id_col))).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    parts = rows.where("text is not null and lang is not null").mapInPandas(_learn, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(DIMENSION))
    for lang, at, x in sums.collect():      # languages x DIMENSION numbers
        out[lang][at] = x
    return {k: v / (np.linalg.norm(v) or 1.0) for k, v in sorted(out.items())}


def language(spark, known: dict[str, np.ndarray]):
    """A function of a text column: struct of lang_pred and score."""
    langs = list(known)
    sent = spark.sparkContext.broadcast(np.array([known[k] for k in langs], dtype=np.float64).reshape(len(langs), DIMENSION))

    @pandas_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        profiles, vectors, out = sent.value, _vectors(), []
        for t in texts:
            keys, counts = trigrams(t or "")
            if not len(keys) or not langs:
                out.append((UNKNOWN, 0.0))
                continue
            v = vectors.bundle(keys, counts)
            cosines = profiles @ v / (np.linalg.norm(v) or 1.0)
            best = int(np.argmax(cosines))
            out.append((langs[best], float(min(1.0, max(0.0, cosines[best])))))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return predict


def op10_language(docs: DataFrame) -> DataFrame:
    predict = language(docs.sparkSession, prototypes(docs))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")
