"""Decontamination, near-duplicates, fingerprints, toxicity, tokens, language and mixing."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tablesmith.llm import op3_decontaminate as dec
from tablesmith.llm import op4_neardup as near
from tablesmith.llm import op5_fingerprint as fp
from tablesmith.llm import op6_toxicity as tox
from tablesmith.llm import op7_tokens as tok
from tablesmith.llm import op9_mixture as mix
from tablesmith.llm import op10_language as lang
from tablesmith.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def folded(text):
    return WORD.findall((text or "").translate(LOWER))


# --- decontamination

def brute_hits(text, items):
    words, hit, ids = folded(text), set(), set()
    for item_id, item in items:
        w = folded(item)
        for i in range(max(len(w) - 10, 0) + 1 if w else 0):
            window = w[i:i + 10]
            for k in range(len(words) - len(window) + 1):
                if words[k:k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    ids |= set() if item_id is None else {str(item_id)}
    return (len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))


@pytest.mark.parametrize("block_bytes", [dec.BLOCK_BYTES, 40])
def test_decontamination_matches_brute_force(spark, odd, benchmark, block_bytes, monkeypatch):
    monkeypatch.setattr(dec.with_hits, "__defaults__", ("text", block_bytes))
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in dec.op3_decontaminate(odd, benchmark).collect())
    assert got == sorted((str(r.doc_id), *brute_hits(r.text, items)) for r in odd.select("doc_id", "text").collect())
    assert dec.op3_decontaminate(odd.limit(0), benchmark).collect() == []
    assert not any(r.contaminated for r in dec.op3_decontaminate(odd, benchmark.limit(0)).collect())


def test_ten_blocks_are_built_once_each(spark, tmpdir_path):
    """Groups of blocks are scanned in turn: no automaton is built once more for every batch."""
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(60)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(i, "lead " + items[i % 60][1] + " tail " + items[(i * 7 + 1) % 60][1] if i % 3 else "plain text") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    size = sum(len(t) for _, t in items) // 10
    assert sum(len(g) for g in dec.benchmark_blocks(bench, size)) >= 10
    got = sorted((r.row.doc_id, r.n_words, r.n_hit, tuple(r.items)) for r in dec.with_hits(docs, bench, block_bytes=size).collect())
    few = sorted((r.row.doc_id, r.n_words, r.n_hit, tuple(r.items)) for r in dec.with_hits(docs, bench).collect())
    assert got == few and sum(g[2] > 0 for g in got) > 2000


def test_a_worker_builds_a_block_once(monkeypatch):
    built = []
    monkeypatch.setattr(dec, "Matcher", lambda items: built.append(1) or items)
    dec._BUILT.clear()
    for _ in range(10):
        for key in range(dec.GROUP):
            dec._matcher(str(key), type("B", (), {"value": key}))
    assert len(built) == dec.GROUP
    dec._BUILT.clear()


def test_hits_map_to_the_original_text(spark, benchmark):
    text = "É first — ONE two,\nthree four; five six (seven) eight nine TEN and mixed."
    row = dec.with_hits(spark.createDataFrame([(1, text)], "doc_id int, text string"), benchmark).first()
    assert [text[h.start:h.end] for h in row.hits] == ["ONE two,\nthree four; five six (seven) eight nine TEN", "mixed"]


# --- fingerprints in plain Python

def plain_digest(data):
    """The digest from triplet counts, without the operator's code."""
    counts = [0] * 128
    for a, b, c in zip(data, data[1:], data[2:]):
        h = (a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) & 0xFFFFFFFF
        h ^= h >> 15
        counts[(h * 0x2C1B3C6D & 0xFFFFFFFF) >> 25] += 1
    q1, q2, q3 = (sorted(counts)[i] for i in (31, 63, 95))
    codes = [(c > q1) + (c > q2) + (c > q3) for c in counts]
    length = min(255, int(np.log(len(data) + 1.0) / np.log(1.25)))
    return codes, length, (q1 * 15 // q3, q2 * 15 // q3) if q3 else (0, 0)


def plain_text(d):
    codes, length, ratios = d
    packed = bytes(codes[i] << 6 | codes[i + 1] << 4 | codes[i + 2] << 2 | codes[i + 3] for i in range(0, 128, 4))
    return f"{length:02x}{ratios[0]:x}{ratios[1]:x}{packed.hex()}"


def plain_likeness(x, y):
    steps = [abs(a - b) for a, b in zip(x[0], y[0])]
    total = sum(steps) + 3 * steps.count(3) + 4 * abs(x[1] - y[1]) + 2 * sum(abs(a - b) for a, b in zip(x[2], y[2]))
    return 1 - min(total, 400) / 400


@pytest.mark.parametrize("pair", [("", "ab"), ("some plain words here", "some plain words there"), ("Äpfel " * 300, "Apfel " * 280), ("x" * 5000, "xy" * 2500)])
def test_digest_in_plain_python(pair):
    (a, b), (x, y) = [fp.Digest(t.encode()) for t in pair], [plain_digest(t.encode()) for t in pair]
    assert [str(a), str(b)] == [plain_text(x), plain_text(y)]
    assert abs(fp.likeness(a, b) - plain_likeness(x, y)) < 1e-12


# --- near-duplicates

def brute_components(rows):
    def sets(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    docs = [(i, sets(t)) for i, t in rows]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            x, y = docs[a][1], docs[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                parent[find(a)] = find(b)
    out = []
    for k, (i, s) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(k) and docs[j][0] is not None]
        least = min(ids, default=None)
        out.append((i, len(s), least, i == least))
    return sorted(out, key=str)


def corpus(seed, n, group):
    """Random texts; ``group`` of them are edits of one text, by few or many words."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    base = rng.choices(words, k=80)
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(1, 90))
        if i < group:
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_match_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_CLASSES", 16)       # several blocks on a small group
    rows = [*corpus(seed, 260, 90), (1000, None), (1001, ""), (1002, " \n"), (1003, "A b"), (1004, "a B"), (None, "a b"), (None, "lonely one")]
    got = near.op4_neardup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)


def test_near_duplicates_of_odd_tables(spark, odd):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near.op4_neardup(odd).collect()), key=str)
    want = brute_components([(r.doc_id, r.text) for r in odd.collect()])
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert near.op4_neardup(odd.limit(0)).collect() == []
    kept = near.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "None", "7", "8", "9"])


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(10, 60)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in (7, *range(10, 60))}}


# --- fingerprints

def brute_fingerprints(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        a, e, b = (fp.Digest(x.encode()) for x in (t, edited, after))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), str(a), str(e), fp.likeness(a, e), fp.likeness(a, b)))
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges", [1, 2, 5])
def test_fingerprints_match_brute_force(spark, odd, ranges, monkeypatch):
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        rows = [(r.doc_id, r.text or "") for r in odd.collect()]
        got = sorted((tuple(r) for r in fp.op5_fingerprint(odd).collect()), key=str)
        assert got == brute_fingerprints(rows)
        assert fp.op5_fingerprint(odd.limit(0)).collect() == []
        assert [tuple(r) for r in fp.op5_fingerprint(odd.where("doc_id = 9")).collect()] == brute_fingerprints([(9, "two words")])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_likeness_follows_the_share_of_common_text():
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n))
    near_by = far = 0.0
    for _ in range(20):
        a, b = text(400), text(400)
        near_by += fp.likeness(fp.Digest(a.encode()), fp.Digest((a[:2500] + b[2500:]).encode()))
        far += fp.likeness(fp.Digest(a.encode()), fp.Digest(b.encode()))
    assert near_by > far + 2
    assert fp.likeness(fp.Digest(b""), fp.Digest(b"")) == 1.0 and str(fp.Digest(b"ab")) == str(fp.Digest(b"xy"))


# --- toxicity

def toxic_corpus(n):
    rng = random.Random(6)
    words = ["".join(rng.choices(["ba", "lo", "mi", "ter", "an", "os"], k=rng.randint(2, 4))) for _ in range(300)]
    rows, marks = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 120))
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            text[rng.randrange(len(text))] = rng.choice(["quagk", "quagkly", "vrrump"])
        rows.append((i, " ".join(text)))
        marks.append((i, 1, int(bad)))
    return rows, marks


def test_toxicity_ranks_held_out_texts(spark):
    rows, marks = toxic_corpus(900)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    got = tox.op6_toxicity(docs, table).collect()
    assert {r.doc_id: r.held_out for r in got} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in rows}
    held = [(r.score, r.doc_id % 4 == 0, r.predicted) for r in got if r.held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, x, _ in held for b, y, _ in held if x and not y]
    assert sum(pairs) / len(pairs) > 0.97
    assert sum(p == y for _, y, p in held) / len(held) > 0.93 and all(r.predicted == (r.score >= 0.3) for r in got)
    # held-out labels are not learned from
    flipped = table.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    assert {r.doc_id: r.score for r in tox.op6_toxicity(docs, flipped).collect()} == {r.doc_id: r.score for r in got}


def brute_toxicity(rows, marks):
    """Scores by dictionaries of letters, none sharing a place."""
    import math
    from collections import Counter, defaultdict

    def grams(word):
        line = b" " + word + b" "
        return [line[max(0, i - 7):i + 1] for i in range(1, len(line))]

    toxic, part = {i: t for i, _, t in marks}, {i: zlib.crc32(str(i).encode()) % 4 for i, _ in rows}
    texts = {i: [w.encode() for w in folded(t)] for i, t in rows}

    def model(parts):
        n = [Counter(), Counter()]
        for i, words in texts.items():
            if part[i] in parts:
                n[toxic[i]].update(g for w in words for g in grams(w))
        two, before = Counter(), Counter()
        for g in set(n[0]) | set(n[1]):
            two[g[-2:]] += 1
            before[g[-2]] += 1
        total, kinds, cut = [Counter(), Counter()], [Counter(), Counter()], []
        for c in (0, 1):
            for g, k in n[c].items():
                total[c][ctx(g)] += k
                kinds[c][ctx(g)] += 1
            once, twice = (sum(k == x for k in n[c].values()) for x in (1, 2))
            cut.append(once / (once + 2 * twice))

        def ratio(g):
            h = ctx(g)
            if not (total[0][h] and total[1][h]):
                return 0.0
            shared = (two[g[-2:]] + 0.01) / (before[g[-2]] + 2.56)
            p = [max(n[c][g] - cut[c], 0) / total[c][h] + cut[c] * kinds[c][h] / total[c][h] * shared + 1e-12 for c in (0, 1)]
            return math.log(p[1] / p[0])

        memo = defaultdict(float)
        for words in texts.values():
            for w in words:
                if w not in memo:
                    memo[w] = sum(map(ratio, grams(w)))
        return lambda words: sum(sorted((memo[w] for w in words), reverse=True)[:3]) / min(3, len(words))

    def ctx(g):                              # an eight-gram's first letter is part of its context
        return g[:-1] if len(g) == 8 else b"^" + g[:-1]

    fit, every = model((0, 1)), model((0, 1, 3))
    bins = Counter((min(max(math.floor((fit(texts[i]) + 32) * 64), 0), 4095), toxic[i]) for i in texts if part[i] == 3)
    a, b = tox._curve([((k + 0.5) / 64 - 32, y, m) for (k, y), m in bins.items()])
    return {i: 1 / (1 + math.exp(-(a * every(w) + b))) for i, w in texts.items()}


@pytest.mark.parametrize("hot", [tox.HOT if hasattr(tox, "HOT") else 0, 60])
def test_toxicity_counts_are_exact_however_many(spark, hot, monkeypatch):
    """Hundreds of thousands of distinct events, each with its own counts."""
    monkeypatch.setattr(tox, "HOT", hot, raising=False)
    rows, marks = toxic_corpus(400)
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, t + " " + " ".join("".join(rng.choices(letters, k=rng.choice([4, 7, 9, 30]))) for _ in range(60))) for i, t in rows]
    got = {r.doc_id: r.score for r in tox.op6_toxicity(
        spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")).collect()}
    assert got == pytest.approx(brute_toxicity(rows, marks), abs=1e-9)


def test_toxicity_of_odd_tables(spark, odd, labels):
    rows = tox.op6_toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 for r in tox.op6_toxicity(odd, labels.limit(0)).collect())
    assert tox.op6_toxicity(odd.limit(0), labels).collect() == []


def test_events_are_word_prefixes():
    keys = [int(k) for k in tox.events([b"ab", b"c"])]
    pack = lambda s: int.from_bytes(s, "big")
    assert keys == [pack(b" a"), pack(b" ab"), pack(b" ab "), pack(b" c"), pack(b" c ")]


# --- tokens

def test_tokens_match_a_public_implementation(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = tok.load_vocabulary(tok.VOCABULARY)
    vocab = [("<unk>", 0.0)] + [(f"<0x{b:02X}>", -1e9) for b in range(256)] + pieces
    # the byte pieces' scores must not set the unknown score: give the lowest ordinary score
    low = min(s for _, s in pieces)
    vocab = [(p, low if p.startswith("<0x") else s) for p, s in vocab]
    reference = Tokenizer(models.Unigram(vocab, 0, True))
    reference.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tok.SPACE, prepend_scheme="always", split=True)
    counter = tok.Counter(pieces)
    texts = ["Hello world", "a  b   c", " leading", "trailing ", "line\nbreak\ttab", "漢字かな \U0001F600 é", "x" * 300, "the aaaaabbbb" * 50,
             "internationalisation of the under-standing", "1234567890 !!! ???", "été ñandú straße"]
    rng = random.Random(7)
    texts += ["".join(rng.choices("abcdehilnorst  éä漢!", k=60)) for _ in range(200)]
    texts = [t for t in texts if not t.startswith(tok.SPACE)]
    assert [counter.count(t) for t in texts] == [len(reference.encode(t, add_special_tokens=False).ids) for t in texts]


def test_tokens_of_runs_of_spaces(spark):
    """Against a Unigram model that searches the whole text."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = tok.load_vocabulary(tok.VOCABULARY)
    low = min(s for _, s in pieces)
    reference = Tokenizer(models.Unigram([("<unk>", 0.0)] + [(f"<0x{b:02X}>", low) for b in range(256)] + pieces, 0, True))
    reference.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tok.SPACE, prepend_scheme="always", split=False)
    texts = ["a  b   c", "def f():\n" + " " * 16 + "return 1", "x" + " " * 40, " " * 7 + "x", " ", "  ", "one two", "a" + " " * 15 + "b  "]
    rng = random.Random(8)
    texts += ["".join(rng.choices(["the", "x", "1", "é", " ", "  ", " " * 16, "\n"], k=30)) for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.n_tokens for r in tok.op7_tokens(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [len(reference.encode(t, add_special_tokens=False).ids) for t in texts]
    spanning = tok.Counter([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("a▁b", -1.0)], split=False)
    assert spanning.count("a b") == 2 and spanning.count("a  b") == 5


def test_tokens_ties_take_the_earliest_start():
    counter = tok.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", 0.0), ("c", -1.0), ("bc", -2.0), ("abc", -3.0)])
    assert counter.search("▁ab") == 2 and counter.search("▁abc") == 2     # one piece, though a+b scores the same
    assert counter.search("▁é") == 3 and counter.count("") == 0            # two bytes


def test_tokens_of_odd_tables(spark, odd):
    got = {(r.doc_id, r.n_chars): r.n_tokens for r in tok.op7_tokens(odd).collect()}
    assert got[(2, 0)] == 0 and got[(3, 0)] == 0 and len(got) == 9
    assert tok.op7_tokens(odd.limit(0)).collect() == []


# --- language

def test_language_of_held_out_texts(spark):
    rng = random.Random(10)
    parts = {"aa": ["the", "ing", "wh", "er"], "bb": ["sch", "ung", "ä", "ei"], "cc": ["ção", "lh", "os", "de"]}
    rows = [(i, " ".join("".join(rng.choices(parts[k], k=3)) for _ in range(40)), k) for i in range(240) for k in [list(parts)[i % 3]]]
    rows += [(500, None, "aa"), (501, "123 ...", "aa"), (502, "漢字", None), (503, "", "bb")]
    got = {r.doc_id: r for r in lang.op10_language(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows[:240] if got[i].held_out)
    assert {got[i].lang_pred for i in (500, 501, 503)} == {"und"} and got[502].lang_pred in parts
    assert all(0 <= r.score <= 1 for r in got.values())


def plain_vector(text):
    """A text's profile: each trigram's letter vectors, rolled by their place and multiplied, added
    by how often the trigram stands there."""
    letter = lambda code: np.random.Generator(np.random.PCG64(code)).integers(0, 2, lang.DIMENSION, dtype=np.int8) * 2.0 - 1
    keys, counts = lang.trigrams(text)
    out = [n * np.roll(letter(k >> 42), 2) * np.roll(letter(k >> 21 & 0x1FFFFF), 1) * letter(k & 0x1FFFFF) for k, n in zip(keys.tolist(), counts.tolist())]
    return np.sum(out, axis=0) if out else None


def test_language_matches_cosines_in_plain_python(spark):
    """Prototypes as sums over texts, and predictions as the first of the largest cosines."""
    rng = random.Random(4)
    words = {"en": "the and of to in that with was for".split(), "de": "der und die das nicht ein ist auf mit".split(), "xx": "der the und and".split()}
    rows = [(i, " ".join(rng.choices(words[k], k=rng.randrange(0, 12))), k) for i in range(60) for k in [rng.choice(list(words))]]
    rows += [(100, "der und", "en"), (101, None, "en"), (102, "12 34", "de"), (103, "the the the", None)]
    sums = {}
    for i, text, k in rows:
        v = None if text is None or k is None or zlib.crc32(str(i).encode()) % 4 == 2 else plain_vector(text)
        if v is not None:
            sums[k] = sums.get(k, 0) + v
    names = sorted(sums)
    unit = [sums[k] / np.linalg.norm(sums[k]) for k in names]
    got = {r.doc_id: (r.lang_pred, r.score) for r in lang.op10_language(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    for i, text, _ in rows:
        v = plain_vector(text or "")
        if v is None:
            assert got[i] == ("und", 0.0)
            continue
        cosines = [float(u @ v / np.linalg.norm(v)) for u in unit]
        best = max(range(len(names)), key=lambda j: (round(cosines[j], 12), -j))
        assert got[i][0] == names[best] and abs(got[i][1] - min(1.0, max(0.0, cosines[best]))) < 1e-9


def test_language_of_odd_tables(spark, odd):
    rows = lang.op10_language(odd).collect()
    assert len(rows) == odd.count() and {r.lang_pred for r in rows if r.doc_id in (2, 3, 7)} == {"und"}
    assert lang.op10_language(odd.limit(0)).collect() == []
    assert {r.lang_pred for r in lang.op10_language(odd.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()} == {"und"}


# --- mixing

def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mix.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2 * sizes[s] for s in above)
        open_ -= above
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixture_meets_its_targets(spark, seed):
    rng = random.Random(seed)
    sources = ["a", "B", "é", "zz", None, "hot"]
    rows = [(i, "w " * rng.choice([0, 1, 5, 50, 700]), rng.choices(sources, [1, 2, 1, 3, 1, 12])[0]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mix.mixture(docs, 16).collect()
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 16 for s in sizes)
    assert sorted(map(tuple, mix.mixture(docs, 16).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_schedule_is_a_low_discrepancy_order(spark):
    rows = [(i, "w " * 64, "abc"[i % 3]) for i in range(300)]
    sized = mix.document_sizes(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    targets = mix.source_targets(sized, 16)
    slots = sorted(mix.schedule(targets).collect())
    share = {r["rank"]: r.slots for r in targets.collect()}
    n = len(slots)
    assert [r.slot for r in slots] == list(range(n)) and n == sum(share.values())
    seen = dict.fromkeys(share, 0)
    for i, r in enumerate(slots, 1):
        seen[r["rank"]] += 1
        assert all(abs(seen[k] - i * share[k] / n) < 6 for k in share)      # every prefix is near the weights
    blocks = {r["rank"]: r.blocks for r in targets.collect()}
    for k in share:
        mine = [(r["pass"], r.block) for r in slots if r["rank"] == k]
        assert mine == [(j // blocks[k], j % blocks[k]) for j in range(share[k])]


def test_scheduled_mix_is_what_the_mixture_counts(spark, monkeypatch):
    """Words and first slots of the mixture come from the schedule joined to blocks; another
    order of the slots gives other first slots."""
    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([0, 1, 5, 50, 300]), rng.choice("abc")) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    slots = mix.scheduled_mix(docs, 16).collect()
    words, first, block = {}, {}, {}
    for r in slots:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.words
        first[r.doc_id] = min(first.get(r.doc_id, r.slot), r.slot)
        block.setdefault(r.slot, []).append((r["at"], r.words))
    got = {r.doc_id: (r.taken, r.first_slot) for r in mix.mixture(docs, 16).collect()}
    assert got == {i: (words.get(i, 0), first.get(i)) for i, _, _ in rows}
    for pieces in block.values():                                        # each slot's words stand end to end
        pieces.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:])) and sum(n for _, n in pieces) <= 16
    monkeypatch.setattr(mix, "golden_step", lambda n: 1)
    assert {r.doc_id: r.first_slot for r in mix.mixture(docs, 16).collect()} != {i: f for i, (_, f) in got.items()}


def test_mixture_of_odd_tables(spark, odd):
    rows = mix.op9_mixture(odd).collect()
    assert len(rows) == odd.count() and all(r.taken == 0 for r in rows if r.size == 0)
    assert mix.op9_mixture(odd.limit(0)).collect() == []
    assert all(r.taken == 0 and r.target == 0 for r in mix.op9_mixture(odd.where("doc_id in (2, 3, 7)")).collect())
