"""Toxicity reads whole texts: every word, as often as it occurs, counts in the likelihood."""

from __future__ import annotations

import math
import random

import pytest

from tablesmith.llm import op6_toxicity as tox
from tablesmith.llm.op3_decontaminate import words_of

from test_models import toxic_corpus


@pytest.mark.parametrize("hot", [1 << 17, 60])
def test_likelihood_adds_up_every_word_of_a_text(spark, hot, monkeypatch):
    monkeypatch.setattr(tox, "HOT", hot)
    rows, marks = toxic_corpus(240)
    rng = random.Random(8)
    # mild, rare and long words, some repeated, beside words that alone decide the score
    odd = ["".join(rng.choices("abcdefghijklm", k=k)) for k in (3, 5, 9, 16, 17, 30) for _ in range(8)]
    rows = [(i, t + " " + " ".join(w for w in rng.sample(odd, 9) for _ in range(rng.choice([1, 1, 4])))) for i, t in rows]
    words = sorted({w.decode() for _, t in rows for w in words_of(t)})
    alone = {10_000 + k: w for k, w in enumerate(words)}
    docs = spark.createDataFrame([*rows, *alone.items(), (9000, None), (9001, " ")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in tox.op6_toxicity(docs, spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")).collect()}
    assert got[9000].likelihood is None and got[9001].likelihood is None
    # a word alone: its score, of which the text's is the curve
    x = {w: got[i].likelihood * (len(w) + 1) for i, w in alone.items()}
    logit = {w: math.log(got[i].score / (1 - got[i].score)) for i, w in alone.items()}
    low, high = min(x, key=x.get), max(x, key=x.get)
    a = (logit[high] - logit[low]) / (x[high] - x[low])
    assert x[high] > 0 > x[low] and all(logit[w] == pytest.approx(logit[low] + a * (x[w] - x[low]), abs=1e-6) for w in words)
    for i, t in rows:
        own = [w.decode() for w in words_of(t)]
        assert got[i].likelihood == pytest.approx(sum(x[w] for w in own) / sum(len(w) + 1 for w in own), abs=1e-9)


def test_texts_of_equal_worst_words_differ_by_the_others(spark):
    rows, marks = toxic_corpus(240)
    rows += [(9000, "quagk quagkly vrrump lobaan mian"), (9001, "quagk quagkly vrrump " + "lobaan mian terlo " * 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in tox.op6_toxicity(docs, spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")).collect()}
    assert got[9000].score == got[9001].score and got[9000].likelihood > got[9001].likelihood
    none = tox.op6_toxicity(docs, spark.createDataFrame(marks[:0], "doc_id bigint, quality int, toxic int")).collect()
    assert all(r.score == 0 and r.likelihood is None for r in none)
