"""The queries of the numbered operators over the given tables, and their oracle SQL."""

from __future__ import annotations

import corpus_pipeline
from tablesmith.llm import (op1_license, op2_chat, op3_decontaminate, op4_neardup, op5_fingerprint, op6_toxicity, op7_tokens, op8_secrets,
                            op9_mixture, op10_language, op11_centroids, op12_repair, op13_linededup)
from tablesmith.llm.shared import table


def _over(fn, *names):
    return lambda spark, sf_dir: fn(*[table(spark, sf_dir, n) for n in names])


QUERIES = {
    "op1_license": _over(op1_license.op1_license, "documents"),
    "op2_chat": _over(op2_chat.op2_chat, "conversations"),
    "op3_decontaminate": _over(op3_decontaminate.op3_decontaminate, "documents", "benchmark"),
    "op4_neardup": _over(op4_neardup.op4_neardup, "documents"),
    "op5_fingerprint": _over(op5_fingerprint.op5_fingerprint, "documents"),
    "op6_toxicity": _over(op6_toxicity.op6_toxicity, "documents", "labels"),
    "op7_tokens": _over(op7_tokens.op7_tokens, "documents"),
    "op8_secrets": _over(op8_secrets.op8_secrets, "documents"),
    "op9_mixture": _over(op9_mixture.op9_mixture, "documents"),
    "op10_language": _over(op10_language.op10_language, "documents"),
    "op11_centroids": _over(op11_centroids.op11_centroids, "embeddings"),
    "op12_repair": _over(op12_repair.op12_repair, "conversations"),
    "op13_linededup": _over(op13_linededup.op13_linededup, "documents"),
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op1_license": op1_license.oracle(),
    "op4_neardup": op4_neardup.ORACLE,
    "op2_chat": op2_chat.ORACLE,
    "op3_decontaminate": op3_decontaminate.ORACLE,
    "op8_secrets": op8_secrets.oracle(),
    "op9_mixture": op9_mixture.ORACLE,
    "op11_centroids": op11_centroids.oracle(),
    "op12_repair": op12_repair.oracle(),
    "op13_linededup": op13_linededup.ORACLE,
}
