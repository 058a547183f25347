"""A stage of the pipeline begins with the driver's garbage collected."""

from __future__ import annotations

import gc
import time

import corpus_pipeline


class _Cycle:
    def __init__(self):
        self.me = self


def test_stage_collects_what_earlier_ones_left(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    made = []
    left = spark._jvm.java.lang.ref.WeakReference(spark._jvm.java.lang.Object())
    time.sleep(3)       # Py4J passes on released objects once a second or so
    gc.disable()
    try:
        cycle = _Cycle()
        cycle.watch = type("Watch", (), {"__del__": lambda self: made.append(1)})()
        del cycle
        dict(corpus_pipeline.STAGES)["secrets"](spark, docs, "/nowhere")
        assert made == [1]              # Python's
        assert left.get() is None       # the JVM's
    finally:
        gc.enable()
