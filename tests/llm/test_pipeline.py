"""The corpus pipeline: stage by stage against brute force, odd tables, registration."""

import os

import corpus_pipeline as cp
import __spark_entry__ as E
from tablesmith.llm import op6_toxicity as tox
from tablesmith.plans import oracle_check as OC

from test_models import brute_components, brute_hits, toxic_corpus
from test_native import brute_secrets

import pytest

SMALL = "/root/testdata/sf0.001"
KEYS = sorted(k for k in E.queries() if k.startswith("op") and k[2].isdigit()) + ["pipeline"]


def test_every_operator_is_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in KEYS if k != "pipeline")
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(set(KEYS) & set(E.oracle_sql())))
def test_oracle(spark, key):
    problems, *_ = OC.compare(spark, OC.duck(SMALL), key, E.queries()[key], E.oracle_sql()[key], SMALL)
    assert not problems, problems


def write(spark, folder, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_stages_match_brute_force(spark, tmpdir_path):
    rows, marks = toxic_corpus(300)
    rows += [(1000 + i, rows[4 * i + 1][1] + (" tail" if i % 2 else "")) for i in range(20)]                 # copies and near copies
    rows += [(2000, "clean start " + "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 end"), (2001, "my password=hunter2000 here"), (2002, None), (2003, ""), (2003, "")]
    docs = spark.createDataFrame([(i, t, f"s{(i or 0) % 3}", "extra", 1) for i, t in rows], "doc_id bigint, text string, source string, row string, n_hit int")
    items = [(1, "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10")]
    folder = write(spark, tmpdir_path, documents=docs, labels=spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int"),
                   benchmark=spark.createDataFrame(items, "item_id bigint, text string"))
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in now.collect()]
        out = stage(spark, now, folder)
        assert out.columns == docs.columns
        path = f"{folder}/{name}"
        out.write.parquet(path)
        now = spark.read.parquet(path)
        after = sorted(((r.doc_id, r.text) for r in now.collect()), key=str)
        if name == "toxicity":
            scores = {r.doc_id: r.score for r in tox.op6_toxicity(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")).collect()}
            want = [r for r in before if scores[r[0]] < tox.THRESHOLD]
            assert len(want) < len(before) - 40
        elif name == "near_duplicates":
            keep = {c[0] for c in brute_components(before) if c[3]}
            want = list(dict.fromkeys(r for r in before if r[0] in keep))
            assert len(want) < len(before)
        elif name == "decontamination":
            want = [r for r in before if not brute_hits(r[1], items)[4]]
            assert 2000 not in {r[0] for r in want}
        else:
            want = [r for r in before if not brute_secrets(r[1])[4]]
            assert 2001 not in {r[0] for r in want}
        assert after == sorted(want, key=str), name
    last = cp.run(spark, folder).collect()
    assert {r.doc_id for r in last} == {r[0] for r in after}
    assert all(r["size"] == len((dict(rows)[r.doc_id] or "").split()) for r in last)


def test_near_duplicates_stage_links_from_80_hundredths(spark):
    """A changed word of n + 4 leaves n - 5 of n + 5 shingles."""
    rows = []
    for group, n in enumerate([56, 45, 44]):                 # 0.836, 0.80 and 0.796
        words = [f"w{group}x{i}" for i in range(n + 4)]
        rows += [(2 * group, " ".join(words)), (2 * group + 1, " ".join([*words[:20], "other", *words[21:]]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in cp.near_duplicates(spark, docs, "").collect()) == [0, 2, 4, 5]


def test_odd_and_empty_tables(spark, odd, labels, benchmark, tmpdir_path):
    folder = write(spark, tmpdir_path + "/a", documents=odd, labels=labels, benchmark=benchmark)
    assert len(cp.run(spark, folder).collect()) > 0
    folder = write(spark, tmpdir_path + "/b", documents=odd.limit(0), labels=labels.limit(0), benchmark=benchmark.limit(0))
    assert cp.run(spark, folder).collect() == []


def test_entry_stands_without_this_subpackage(tmpdir_path):
    """The rest imports and lists its queries when the folders are gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copytree(root, tmpdir_path + "/repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".tmp"))
    code = "import __spark_entry__ as E; q = E.queries(); assert 'pipeline' not in q and 'op1_license' not in q and len(q) > 50; E.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmpdir_path + "/repo", check=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(E.__file__))
    for folder, _, names in os.walk(os.path.join(root, "tablesmith")):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in names:
            if name.endswith(".py"):
                assert "tablesmith.llm" not in open(os.path.join(folder, name)).read(), name
