"""Token counts by a count-only Viterbi search.

A unigram vocabulary gives each piece a score; the tokens of a text are the segmentation of
the highest total score. Only its number of pieces is wanted: an Aho-Corasick automaton
enumerates the vocabulary matches that end at each place, and dynamic programming carries
the best score and its piece count, so no segmentation is kept.

Rules of the tokenizers that use such vocabularies: spaces become U+2581, a text starts with
one. Pieces may hold runs of it, so a word is searched with all the spaces before it; where
some piece spans the end of a word, the whole text is searched at once. A character that no piece matches costs the lowest score less 10 and becomes one token per UTF-8 byte
(byte fallback). Of equal scores the candidate of the earliest start (the longest last
piece) stands.

Defined results: a null or empty text has no tokens; repeated rows are counted each; an
empty table gives no rows; other columns are ignored. Texts of any length are searched
whole; a worker keeps counts of words it has met in a table of bounded size.
"""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tablesmith.llm.shared import importable

# Parameters: the vocabulary's file (read by the driver); words that a worker remembers.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
REMEMBERED = 400_000
SPACE = "▁"
UNKNOWN_PENALTY = 10.0      # fixed value


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the ordinary pieces of a vocabulary file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


RUNS = re.compile(f"{SPACE}+[^{SPACE}]*")


class Counter(dict):
    """Tokens of a word (its inner spaces, if any, stand before it), remembered. With ``split``
    each space starts a new search, as in tokenizers that split there first."""

    def __init__(self, pieces: list[tuple[str, float]], split: bool = True):
        import ahocorasick

        super().__init__()
        self.split = split
        # a piece that spans the end of a word
        self.whole = not split and any(SPACE in piece.lstrip(SPACE) for piece, _ in pieces)
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece and not (split and SPACE in piece[1:]):
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        n = self[word] = self.search(SPACE + word)
        return n

    def search(self, chunk: str) -> int:
        n = len(chunk)
        ends: list[list | None] = [None] * n
        for end, match in self.automaton.iter(chunk):
            if ends[end] is None:
                ends[end] = [match]
            else:
                ends[end].append(match)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(n):
            top, of, longest, single = None, 0, 0, False
            for length, score in ends[end] or ():
                total = best[end + 1 - length] + score
                single = single or length == 1
                if top is None or total > top or (total == top and length > longest):
                    top, of, longest = total, count[end + 1 - length] + 1, length
            if not single:
                total = best[end] + self.unknown
                if top is None or total > top:
                    top, of = total, count[end] + len(chunk[end].encode("utf-8", "surrogatepass"))
            best[end + 1], count[end + 1] = top, of
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        if text[0] == " ":               # the text brings its own first space
            text = text[1:]
        if self.whole:
            return self.search(SPACE + text.replace(" ", SPACE))
        if self.split or "  " not in text and text[:1] != " ":
            words = text.split(" ")
        else:
            words = [run[1:] for run in RUNS.findall(SPACE + text.replace(" ", SPACE))]
        return sum(map(self.__getitem__, words))


_BUILT: dict[str, Counter] = {}


def token_counter(spark, pieces: list[tuple[str, float]]):
    """A function of a text column that gives its number of tokens. The vocabulary (a fixed
    file) is broadcast once; each worker builds one automaton."""
    importable(spark)
    key, sent = uuid.uuid4().hex, spark.sparkContext.broadcast(pieces)

    @pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Counter(sent.value, split=False)
        counter = _BUILT[key]
        return pd.Series([counter.count(t or "") for t in texts], dtype="int64")

    return count


def op7_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    count = token_counter(docs.sparkSession, load_vocabulary(vocabulary))
    out = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars"), count("text").alias("n_tokens"))
    return out.select("doc_id", "n_chars", "n_tokens")
