"""Centroids, conversation repair and line dedup against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablesmith.llm import op11_centroids as cen
from tablesmith.llm import op12_repair as rep
from tablesmith.llm import op13_linededup as line

CALM = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# --- centroids

def brute_clusters(rows, k=cen.CENTROIDS, rounds=cen.ROUNDS, d=cen.COMPONENTS, scale=cen.SCALE):
    limit = cen.LIMIT
    kept = [(i, [max(-limit, min(limit, int(np.floor(np.clip(scale * float(x), -1e300, 1e300))))) for x in v]) for i, v in rows
            if v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(q) for _, q in order[:k]]
    distance = lambda q, c: sum((x - y) ** 2 for x, y in zip(q, c))
    assign = lambda q: min((distance(q, c), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(assign(q)[1], []).append(q)
        for i, g in groups.items():
            centroids[i] = [sum(x) // len(g) for x in zip(*g)]
    out = [(i, *assign(q)[::-1]) for i, q in kept]
    total = sum(d for _, _, d in out)
    sums = {c: sum(d for _, e, d in out if e == c) for _, c, _ in out}
    most = cen.LARGEST
    return sorted(((i, c, d, min(sums[c], most), min(total, most), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in out), key=repr)


def vectors(n, seed=0):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(i % 5 - 2, 0.4) for _ in range(64)]) for i in range(n)]
    return rows


VECTORS = "vec_id bigint, embedding array<float>, label int, q string, row int, cluster int"


def centroid_rows(spark, rows):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], 1, "x", 2, 3) for i, v in rows], VECTORS)
    return sorted((tuple(r) for r in cen.op11_centroids(df).collect()), key=repr)


def as_floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_centroids_match_brute_force_with_odd_rows(spark):
    rows = vectors(60)
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (None, rows[4][1])]                        # repeated rows and null ids
    rows += [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [1.0] * 63), (105, [float("nan")] + [1.0] * 63),
             (106, [float("-inf")] + [1.0] * 63), (107, [0.0] * 64), (108, [-0.0] * 64), (109, [1e30] * 64), (110, [-1e30] * 64)]
    assert centroid_rows(spark, rows) == brute_clusters(as_floats(rows))


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = vectors(3) + [(9, vectors(3)[0][1])]
    assert centroid_rows(spark, rows) == brute_clusters(as_floats(rows))
    assert centroid_rows(spark, []) == []


def test_equal_vectors_take_the_smaller_centroid(spark):
    rows = [(i, [1.0] * 64) for i in range(40)] + [(50, [0.5] * 64)]
    got = centroid_rows(spark, rows)
    assert got == brute_clusters(as_floats(rows)) and len({r[1] for r in got}) == 2


def test_dot_products_follow_changed_components_only():
    rnd = np.random.default_rng(3)
    q, old = rnd.integers(-60, 60, (200, 64)), rnd.integers(-60, 60, (16, 64))
    new = old.copy()
    new[2, 5] += 3
    new[7, ::9] -= 1
    seen = np.zeros_like(q)
    assert (cen.changed(q, q @ old.T, old, new) == q @ new.T).all()
    seen[:, np.flatnonzero((new != old).any(axis=0))] = q[:, np.flatnonzero((new != old).any(axis=0))]
    assert (cen.changed(seen, q @ old.T, old, new) == q @ new.T).all()         # the others are not read


def test_clustered_keeps_the_columns(spark):
    df = spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in vectors(30)], VECTORS)
    found = cen.clustered(df, k=4, rounds=2, seed="other:")
    assert len(found.centroids) == 4 and found.rows.select("row.*").schema.names == df.schema.names
    assert found.rows.count() == 30


# --- conversation repair

SPACES = " \t\n\x0b\x0c\r"


def brute_audit(conversations):
    """The contract, row by row; cheapest edits by comparing whole (cost, edits, repaired) triples."""
    groups = {}
    for conv, turn, role, text in conversations:
        rows = groups.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if fault == 4 else role
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            end = text.rstrip(SPACES)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[0] for r in rows if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        best = {"": (0, "", ())}
        insert = lambda b: {**b}
        names = {"u": "user", "a": "assistant"}

        def grown(b):
            """Insert one or two rows; more are never cheaper."""
            b = insert(b)
            for _ in range(3):
                for state, (cost, edits, made) in list(b.items()):
                    for letter in "ua":
                        to = written(state, letter)
                        new = (cost + 5, edits + "I", (*made, f"{names[letter]}:"))
                        if to is not None and (to not in b or new < b[to]):
                            b[to] = new
            return b

        def written(state, letter):
            whole = state + letter                 # states: "", "s", "su", "sua": what matters of the initials
            return whole if re.fullmatch("s?u?|s?ua", whole) else {"ua" + "u": "u", "sua" + "u": "su"}.get(whole)

        best = grown(best)
        for (_, role, text), fault in zip(rows, faults):
            after = {}
            for state, (cost, edits, made) in best.items():
                options = [(state, cost + 2, "D", made)]
                if fault not in ("blank", "duplicate"):
                    more = 5 * (fault == "truncated")
                    options.append((written(state, role[:1]) if role[:1] in ("s", "u", "a") else None, cost + more, "K", (*made, f"{role}:{text}")))
                    options += [(written(state, x), cost + more + 1, "R", (*made, f"{names[x]}:{text}")) for x in "ua"]
                for to, c, letter, m in options:
                    if to is not None and (to not in after or (c, edits + letter, m) < after[to]):
                        after[to] = (c, edits + letter, m)
            best = grown(after)
        cost, edits, made = min(v for state, v in best.items() if state in ("", "ua", "sua"))
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, edits,
                    hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=repr)


CHATS = "conv_id bigint, turn bigint, role string, text string, n int, kind string, symbol string, copies int"


def audited(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", "y", 5) for r in rows], CHATS)
    return sorted((tuple(r) for r in rep.op12_repair(df).collect()), key=repr)


ODD_CHATS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (1, 5, "user", "Bye"),
    (2, None, None, None), (2, None, "user", "a."), (2, 3, "", "b."), (2, 4, "tool", "c!"),
    (None, 0, "user", "x."), (None, None, "assistant", "y."), (None, 1, "user", "x."),
    (4, 0, "user", ""), (5, 0, "assistant", " \t\n"), (6, 0, "user", "Long. " * 20000), (6, 1, "assistant", "Long. " * 20000),
    (7, 0, "assistant", "only."), (8, 0, "user", "no end"), (8, 1, "assistant", "no end"), (9, 9, "USER", "é。"), (9, 9, "user", "\U0001F600!"),
]


def test_repair_matches_brute_force_on_odd_rows(spark):
    assert audited(spark, ODD_CHATS) == brute_audit(ODD_CHATS)
    gone = [(c, t, "user", "x.") for c in range(40) for t in range(2) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone and audited(spark, gone) == brute_audit(gone)                   # no rows are left
    assert audited(spark, []) == []


@CALM
@given(st.lists(st.tuples(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 25)), st.sampled_from(["user", "assistant", "system", "user", "assistant", None, "tool"]),
                          st.sampled_from(["a.", "b!", "c", "d?", "", " ", "e.", "f. "])), max_size=150))
def test_repair_property(spark, rows):
    assert audited(spark, rows) == brute_audit(rows)


def test_block_tables_match_a_search_over_whole_edit_strings():
    def search(symbols):
        best = {0: (0, "")}

        def grown(b):
            for _ in range(3):
                for q, (cost, edits) in list(b.items()):
                    to, new = rep.WRITE[q, rep.WANTED[q]], (cost + 5, edits + "I")
                    if to not in b or new < b[to]:
                        b[to] = new
            return b

        best = grown(best)
        for s in symbols:
            after = {}
            for q, (cost, edits) in best.items():
                for letter, c, to in rep._edits(q, s):
                    new = (cost + c, edits + letter)
                    if to not in after or new < after[to]:
                        after[to] = new
            best = grown(after)
        return min(best[q] for q in rep.ACCEPTED if q in best)

    rnd = random.Random(5)
    for _ in range(4000):
        weights = [rnd.random() ** 3 for _ in range(rep.SYMBOLS)]
        symbols = bytes(rnd.choices(range(rep.SYMBOLS), weights, k=rnd.randrange(40)))
        assert rep.cheapest(symbols) == search(symbols)
    assert len(rep.tables().vectors) < 400


def test_repaired_rows_alternate(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "assistant", "b."), (2, 0, "user", "q?"), (2, 1, "assistant", "r.")]
    got = rep.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).orderBy("conv_id", "place").collect()
    for conv in (1, 2):
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in got if r.conv_id == conv))
    assert [(r.edit, r.role, r.text) for r in got if r.conv_id == 2] == [("K", "user", "q?"), ("K", "assistant", "r.")]


# --- line dedup

def brute_lines(rows, threshold=3, least=20):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(SPACES))
    holders = {}
    for doc, text in rows:
        for x in (text or "").split("\n"):
            holders.setdefault(key(x), set()).add(doc)
    top = {k: max(v, key=lambda d: (d is not None, d or 0)) for k, v in holders.items() if len(k) >= least and len(v) >= threshold}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in top or top[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def line_rows(spark, rows):
    df = spark.createDataFrame([(i, t, "en", 1, "d", 2) for i, t in rows], "doc_id bigint, text string, lang string, row int, digest string, n int")
    return sorted((tuple(r) for r in line.op13_linededup(df).collect()), key=repr)


COMMON = "This line is the same in many documents"
ODD_LINES = [
    (1, COMMON + "\nown line of the first document here\n" + COMMON.upper()), (2, "\t" + COMMON + " \r\nshort\nshort"), (3, COMMON + "\n\n"),
    (3, COMMON + "\n\n"), (4, None), (5, ""), (6, "\n\n"), (None, COMMON), (None, "a null id's own long line, twice\na null id's own long line, twice"),
    (8, "Ünï line of over twenty code points"), (9, "ünï line of over twenty code points"), (10, "Ünï line of over twenty code points "),
    (11, "Ünï LINE of over twenty code points\nx"), (12, "Ünï line of over twenty code points"), (13, ("many of this line in one document\n") * 3000),
    (14, "nineteen characters"), (15, "nineteen characters"), (16, "nineteen characters"),
]


def test_lines_match_brute_force_with_odd_rows(spark):
    assert line_rows(spark, ODD_LINES) == brute_lines(ODD_LINES)
    assert line_rows(spark, []) == []


LINES = [COMMON, COMMON.lower() + " ", "another line that may be common", "short", "", "a third line that may be common", "A Third Line That May Be Common"]


@CALM
@given(st.lists(st.tuples(st.integers(0, 9), st.lists(st.sampled_from(LINES), max_size=6).map("\n".join)), max_size=14, unique_by=lambda r: r[0]),
       st.sets(st.integers(0, 9)), st.integers(0, 14))
def test_insertions_and_deletions_are_reversible(spark, rows, taken, cut):
    """After any insertions and deletions the ledger says what a new one over what is left says."""
    schema = "doc_id bigint, text string"
    ledger = line.LineLedger(spark, shard_references=8)
    for part in (rows[:cut], rows[cut:]):
        ledger.insert(spark.createDataFrame(part, schema))
    ledger.delete(spark.createDataFrame([(i,) for i in taken], "doc_id bigint"))
    left = [r for r in rows if r[0] not in taken]
    docs = spark.createDataFrame(left, schema)
    read = lambda x: sorted((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept.encode()).hexdigest())
                            for r in x.deduped(docs).select("row.doc_id", "n_lines", "n_dropped", "kept").collect())
    assert read(ledger) == brute_lines(left)
    again = [r for r in rows if r[0] in taken]
    ledger.insert(spark.createDataFrame(again, schema))
    docs = spark.createDataFrame(rows, schema)
    assert read(ledger) == brute_lines(rows)
    # the filters hold the common digests and no others
    held = {bytes(r.digest) for r in ledger.common.collect()}
    marks = sum(int((np.frombuffer(r.data, np.uint16) != 0).sum()) for r in ledger.filters.collect())
    assert marks == len(held)


@pytest.mark.parametrize("n", [0, 1, 50, 5000])
def test_cuckoo_filter(n):
    digests = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(2 * n)]
    held = line.CuckooFilter.holding(digests[:n])

    def asked(d):
        raw = np.frombuffer(b"".join(d), np.uint8).reshape(len(d), 16)
        marks = raw[:, 8:10].copy().view("<u2")[:, 0]
        firsts = raw[:, 10:16].astype(np.uint64) @ (np.uint64(1) << np.arange(0, 48, 8, dtype=np.uint64))
        return held.may_hold(np.where(marks == 0, 1, marks).astype(np.uint16), firsts)

    assert asked(digests[:n]).all() and asked(digests[n:]).sum() <= 0.01 * n + 1
    for d in digests[:n]:
        assert held.delete(d)
    assert not held.table.any()


def test_a_filter_that_overflows_is_made_anew(spark):
    """Many keys become common after the first insertion, in one shard with room for none."""
    ledger = line.LineLedger(spark, shard_references=1 << 20)
    schema = "doc_id bigint, text string"
    rows = [(i, "\n".join(f"line number {j} of some length" for j in range(400))) for i in range(3)]
    ledger.insert(spark.createDataFrame(rows[:2], schema))
    assert ledger.filters.count() == 0
    ledger.insert(spark.createDataFrame(rows[2:], schema))
    docs = spark.createDataFrame(rows, schema)
    assert {r["row"].doc_id: r.n_dropped for r in ledger.deduped(docs).collect()} == {0: 400, 1: 400, 2: 0}
