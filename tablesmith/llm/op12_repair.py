"""Conversation structure repair by Four-Russians block tables.

A conversation is a sequence of symbols, one a row: forced deletion (blank or repeated rows), or
the role's initial with a mark for truncated texts. The cheapest edits that give role initials
``(s?(ua)+)?`` are a shortest path through four states (nothing yet, after s, after u, after a).
The costs of the four states, less their minimum, take few values: states that lie DEAD or more
above the minimum can't come back (see below), so there are some dozens of normalised vectors.
``tables()`` lists them and precomputes, for each vector and each block of BLOCK symbols, the
vector after the block and the cost it adds. A conversation is then

1. read block by block, by lookup, keeping the vector at each block's start;
2. walked backward, each block expanded to mark the states that lie on a cheapest path;
3. traced forward, taking at each state the ASCII-least edit (D, I, K, R) that stays on marked
   states. Edits are deterministic, so this gives the least of all cheapest edit strings; blocks
   seen before with the same vector, marks and state are looked up.

DEAD is exact: what state "nothing yet" does, any other state can do with at most 12 more (insert
to where the path stands, delete instead of keeping an s), and the others are apart by less.

Repeated rows of a turn are counted before anything is shuffled by conversation, and repeated
texts of a conversation are found by grouping on (conversation, role, digest), so neither is one
task's work. Then each conversation's symbols stream to one task ahead of its texts: the task
holds a few bytes a row and one batch of texts, since a digest of the whole conversation has to
see its rows in order.

``repair(messages)`` returns the repaired rows (conv_id, place, edit, role, text), and
``audit(messages)`` one row per conversation with its counts, cost and edits.

Defined results: null role, text, conversation id (in the damage's key) and turn (there too) are
one space; a null conversation id is a conversation of its own; rows of equal turn are ordered by
role and then by the SHA-256 of the text; repeated rows are rows; a conversation without rows has
zeros, an empty audit and the digest of the empty text; an empty table gives no rows; other
columns are ignored. A role's initial is its first character, an empty role has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.shared import importable

BLANK = " \t\n\x0b\x0c\r"
# Costs of the edits and of keeping a truncated row.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
# The states' next state by the letter written; inserts and new roles by state.
STATES = 4
WRITE = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}
ACCEPTED = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

INITIALS = "sua"
GONE = 0                        # the symbol of rows that must be deleted
SYMBOLS = 1 + 2 * (len(INITIALS) + 1)
BLOCK = 4                       # parameter: symbols of a block
DEAD = 13
INF = 1 << 20


def symbol_of(initial: Column, truncated: Column) -> Column:
    """1, 3, 5 for s, u, a and 7 for others; one more for truncated texts."""
    place = F.lit(2 * len(INITIALS))
    for i, letter in enumerate(INITIALS):
        place = F.when(initial == letter, 2 * i).otherwise(place)
    return (1 + place + truncated.cast("int")).cast("int")


def _edits(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, by letter."""
    out = [("D", DELETE, state)]
    if symbol == GONE:
        return out
    initial = (INITIALS + "?")[(symbol - 1) // 2]
    extra = TRUNCATED * ((symbol - 1) % 2)
    if (state, initial) in WRITE:
        out.append(("K", extra, WRITE[state, initial]))
    if initial != WANTED[state]:
        out.append(("R", extra + REROLE, WRITE[state, WANTED[state]]))
    return out


def _settled(costs: list[int]) -> tuple[tuple[int, ...], int]:
    """Costs closed under inserts and normalised, and the minimum taken off."""
    costs = list(costs)
    for _ in range(2):
        for q in range(STATES):
            to = WRITE[q, WANTED[q]]
            costs[to] = min(costs[to], costs[q] + INSERT)
    low = min(costs)
    return tuple(c - low if c - low < DEAD else INF for c in costs), low


class Tables(NamedTuple):
    vectors: list[tuple[int, ...]]
    step: np.ndarray            # vector, symbol -> vector
    added: np.ndarray           # vector, symbol -> cost
    block_step: np.ndarray      # vector, block -> vector
    block_added: np.ndarray     # vector, block -> cost


@lru_cache(maxsize=1)
def tables() -> Tables:
    vectors, index, step, added = [], {}, [], []

    def number(v):
        if v not in index:
            index[v] = len(vectors)
            vectors.append(v)
        return index[v]

    number(_settled([0, INF, INF, INF])[0])
    at = 0
    while at < len(vectors):
        now, row, costs = vectors[at], [], []
        for symbol in range(SYMBOLS):
            after = [INF] * STATES
            for q in range(STATES):
                for _, cost, to in _edits(q, symbol) if now[q] < INF else ():
                    after[to] = min(after[to], now[q] + cost)
            vector, low = _settled(after)
            row.append(number(vector))
            costs.append(low)
        step.append(row)
        added.append(costs)
        at += 1
    step, added = np.array(step, dtype=np.int32), np.array(added, dtype=np.int32)
    block_step, block_added = step, added
    for _ in range(BLOCK - 1):
        # one symbol more behind every block so far
        block_added = (block_added[:, :, None] + added[block_step]).reshape(len(vectors), -1)
        block_step = step[block_step].reshape(len(vectors), -1)
    return Tables(vectors, step, added, block_step, block_added)


def _closed(vector: tuple[int, ...], marks: int) -> int:
    """Marks of states and of those from which inserts lead to them at no loss."""
    for _ in range(2):
        for q in range(STATES):
            to = WRITE[q, WANTED[q]]
            if marks >> to & 1 and vector[q] < INF and vector[q] + INSERT == vector[to]:
                marks |= 1 << q
    return marks


@lru_cache(maxsize=1 << 16)
def _expanded(vector: int, symbols: bytes, marks: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(vectors, marks) before each symbol of a block and after the last."""
    t = tables()
    inside = [vector]
    for s in symbols:
        inside.append(int(t.step[inside[-1], s]))
    all_marks = [marks]
    for i in range(len(symbols) - 1, -1, -1):
        now, after, low = t.vectors[inside[i]], t.vectors[inside[i + 1]], t.added[inside[i], symbols[i]]
        before = 0
        for q in range(STATES):
            if now[q] < INF and any(now[q] + cost == after[to] + low and all_marks[-1] >> to & 1 for _, cost, to in _edits(q, symbols[i])):
                before |= 1 << q
        all_marks.append(_closed(now, before))
    return tuple(inside), tuple(reversed(all_marks))


@lru_cache(maxsize=1 << 16)
def _traced(vector: int, symbols: bytes, marks: int, state: int) -> tuple[str, int]:
    """The least edits of a block from a state on marked states, and the state after it."""
    t = tables()
    inside, all_marks = _expanded(vector, symbols, marks)
    out, i = [], 0
    while i < len(symbols):
        now, after, low = t.vectors[inside[i]], t.vectors[inside[i + 1]], t.added[inside[i], symbols[i]]
        best = [(letter, to, i + 1) for letter, cost, to in _edits(state, symbols[i])
                if now[state] + cost == after[to] + low and all_marks[i + 1] >> to & 1]
        to = WRITE[state, WANTED[state]]
        if now[state] + INSERT == now[to] and all_marks[i] >> to & 1:
            best.append(("I", to, i))
        letter, state, i = min(best)
        out.append(letter)
    return "".join(out), state


def cheapest(symbols: bytes) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair; the ASCII-least edits of equal cost."""
    t = tables()
    whole = len(symbols) - len(symbols) % BLOCK
    blocks = [symbols[i:i + BLOCK] for i in range(0, whole, BLOCK)] + [symbols[i:i + 1] for i in range(whole, len(symbols))]
    starts, vector, cost = [], 0, 0
    for b in blocks:
        starts.append(vector)
        if len(b) == BLOCK:
            code = 0
            for s in b:
                code = code * SYMBOLS + s
            cost += int(t.block_added[vector, code])
            vector = int(t.block_step[vector, code])
        else:
            cost += int(t.added[vector, b[0]])
            vector = int(t.step[vector, b[0]])
    last = t.vectors[vector]
    least = min(last[q] for q in ACCEPTED)
    marks = _closed(last, sum(1 << q for q in ACCEPTED if last[q] == least))
    ends = []
    for at, b in zip(reversed(starts), reversed(blocks), strict=True):
        ends.append(marks)
        marks = _expanded(at, b, marks)[1][0]
    state, out = 0, []
    for at, b, marks in zip(starts, blocks, reversed(ends), strict=True):
        letters, state = _traced(at, b, marks, state)
        out.append(letters)
    while not (state in ACCEPTED and last[state] == least):
        out.append("I")
        state = WRITE[state, WANTED[state]]
    return cost + least, "".join(out)


class Conversation:
    """One conversation in a stream: its symbols first, then its texts in the same order."""

    def __init__(self, conv_id: str | None):
        self.conv_id = conv_id
        self.symbols = bytearray()
        self.text_at: list[int] = []           # places of the rows whose texts follow
        self.initials = []                     # initials of kept places, by text
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.turns = 0
        self.before = None
        self.edits = None
        self.at = self.place = self.state = 0
        self.text, self.key = -1, None

    def add(self, turn: int | None, role: str, symbol: int, later: bool, n: int) -> None:
        """``n`` equal rows; ``later``: their role and text stand in an earlier turn."""
        if not n:
            return
        initial = role[:1]
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        self.illegal += n - 1 + (self.before is not None and self.before + initial not in LEGAL)
        self.before = initial
        if symbol == GONE:
            self.blank += n
        elif later:
            self.duplicate += n
        else:
            self.duplicate += n - 1
            self.truncated += (symbol - 1) % 2
        if symbol != GONE:
            self.text_at.append(len(self.symbols))
            self.initials.append(initial)
        self.symbols += bytes([GONE if later else symbol]) + bytes([GONE]) * (n - 1)

    def solve(self) -> None:
        if self.edits is None:
            self.cost, self.edits = cheapest(bytes(self.symbols))

    def _written(self, row: int) -> Iterator[tuple[str, str, str]]:
        """Inserted rows and deletions before the row at a place."""
        while self.at < len(self.edits) and (self.place < row or self.edits[self.at] == "I"):
            letter = self.edits[self.at]
            self.at += 1
            if letter == "I":
                wanted = WANTED[self.state]
                self.state = WRITE[self.state, wanted]
                yield "I", ROLE[wanted], ""
            else:
                self.place += 1
                yield "D", None, None

    def read(self, key: tuple, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The next text of the stream; repeated rows bring it again."""
        if key == self.key:
            return
        self.solve()
        self.key = key
        self.text += 1
        yield from self._written(self.text_at[self.text])
        letter = self.edits[self.at]
        self.at += 1
        self.place += 1
        if letter == "D":
            yield "D", None, None
        else:
            wanted = WANTED[self.state] if letter == "R" else self.initials[self.text]
            self.state = WRITE[self.state, wanted]
            yield letter, role if letter == "K" else ROLE[wanted], text

    def close(self) -> Iterator[tuple[str, str, str]]:
        self.solve()
        yield from self._written(len(self.symbols))

    def counts(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.edits


def _streamed(messages: DataFrame, copies: str | None) -> DataFrame:
    """Each conversation's rows in one task: its counted symbols (kind 0), then its texts (kind 1)."""
    rows = messages.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), (F.col(copies) if copies else F.lit(1)).cast("bigint").alias("n"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    ending = F.rtrim(F.col("text"), F.lit(BLANK))
    truncated = ~F.substring(ending, -1, 1).isin(".", "!", "?")
    symbol = F.when(ending == "", GONE).otherwise(symbol_of(F.substring("role", 1, 1), truncated))
    runs = rows.withColumn("symbol", symbol).groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("n").alias("n"), F.max("symbol").alias("symbol"))
    # texts that stand in several turns of a conversation, with the first of these
    repeated = (runs.where((F.col("n") > 0) & (F.col("symbol") != GONE)).groupBy("conv_id", "role", "digest")
                .agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("c")).where("c > 1").alias("f"))
    same = F.expr("r.conv_id <=> f.conv_id and r.role = f.role and r.digest = f.digest")
    light = runs.alias("r").join(repeated, same, "left").select(
        "r.conv_id", F.lit(0).alias("kind"), "r.turn", "r.role", "r.digest", "r.symbol", "r.n",
        (F.col("first").isNotNull() & ~F.col("r.turn").eqNullSafe(F.col("first.turn"))).alias("later"), F.lit(None).cast("string").alias("text"))
    texts = rows.where((F.col("n") > 0) & (ending != "")).select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", F.lit(0).alias("symbol"), F.col("n"), F.lit(False).alias("later"), "text")
    return (light.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
            .select(F.col("conv_id").cast("string").alias("conv_id"), "kind", "turn", "role", "digest", "symbol", "n", "later", "text"))


def _walk(batches: Iterator[pa.RecordBatch], begin, write, end) -> Iterator[tuple]:
    """Rows made of a stream: ``begin`` gives each conversation what ``write`` and ``end`` fill."""
    now = held = None
    for batch in batches:
        for conv_id, kind, turn, role, digest, symbol, n, later, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    for e in now.close():
                        yield from write(now, held, e)
                    yield from end(now, held)
                now, held = Conversation(conv_id), begin()
            if kind == 0:
                now.add(turn, role, symbol, later, n)
            else:
                for e in now.read((turn, role, digest), role, text):
                    yield from write(now, held, e)
    if now is not None:
        for e in now.close():
            yield from write(now, held, e)
        yield from end(now, held)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    out = []
    for r in rows:
        out.append(r)
        if len(out) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)


_REPAIRED = pa.schema([("conv_id", pa.string()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_AUDIT = pa.schema([("conv_id", pa.string()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                    ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def write(now, held, edit):
        if edit[0] != "D":
            held[0] += 1
            yield (now.conv_id, held[0], *edit)

    return _batches(_walk(batches, lambda: [0], write, lambda now, held: ()), _REPAIRED)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def write(now, held, edit):
        if edit[0] != "D":
            held[0].update((("\n" if held[1] else "") + f"{edit[1]}:{edit[2]}").encode("utf-8", "surrogatepass"))
            held[1] += 1
        return ()

    return _batches(_walk(batches, lambda: [hashlib.sha256(), 0], write, lambda now, held: [(now.conv_id, *now.counts(), held[0].hexdigest())]), _AUDIT)


def repair(messages: DataFrame, copies: str | None = None) -> DataFrame:
    """The repaired rows: conv_id, place (from 1), edit (K, R or I), role and text. ``copies`` names
    a column that says how often a row stands (0: only its conversation does)."""
    importable(messages.sparkSession)
    made = _streamed(messages, copies).mapInArrow(_repaired, "conv_id string, place bigint, edit string, role string, text string")
    return made.withColumn("conv_id", F.col("conv_id").cast(messages.schema["conv_id"].dataType))


def audit(messages: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per conversation: gaps, faults, cost, edits and the digest of the repaired rows."""
    importable(messages.sparkSession)
    schema = ("conv_id string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
              "audit string, repaired_sha256 string")
    made = _streamed(messages, copies).mapInArrow(_audited, schema)
    return made.withColumn("conv_id", F.col("conv_id").cast(messages.schema["conv_id"].dataType))


def damaged(conversations: DataFrame) -> DataFrame:
    """The query's damage by a hash of conversation and turn; ``copies`` says how often a row stands."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                                (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("fault"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


def op12_repair(conversations: DataFrame) -> DataFrame:
    return audit(damaged(conversations), "copies")


def oracle() -> str:
    """DuckDB SQL of the query: CRC-32 from its polynomial, and the states' cheapest edits row by row."""
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    far = "{'c': 1000000, 'a': '', 'r': ''}"

    def move(state, letter, cost, role=None, text="''"):
        """The state after an edit; ``role`` is the SQL of the role it writes."""
        line = f"{state}.r || chr(10) || {role} || ':' || {text}" if role else f"{state}.r"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {line}}}"

    def kept(state, initial, role):
        """Keep a row of this initial, else give it the role."""
        keep, rerole = move(state, "K", "5 * w.trunc", "w.role", "w.text"), move(state, "R", "5 * w.trunc + 1", f"'{role}'", "w.text")
        return f"CASE WHEN w.gone THEN {far} WHEN w.i = '{initial}' THEN {keep} ELSE {rerole} END"

    def least(*states):
        return f"list_min([{', '.join(states)}])"

    insert_user = [move(f"n{q}", "I", 5, "'user'") for q in (0, 1, 3)]
    return f"""WITH RECURSIVE tab(i, c, b) AS (SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b + 1 FROM tab WHERE b < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM tab WHERE b = 8),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
    lambda a, x: xor(a >> 8, crc.t[(xor(a, x) & 255) + 1])), 4294967295) % 20 AS fault FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN fault = 0 THEN 0 WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS p, left(role, 1) AS i, rtrim(text, {blank}) AS e FROM d),
f AS (SELECT *, e = '' AS blank, e <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS dup FROM o),
w AS (SELECT *, blank OR dup AS gone, (NOT blank AND NOT dup AND right(e, 1) NOT IN ('.', '!', '?'))::INTEGER AS trunc,
  lag(i) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM f),
s(conv_id, p, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0, 'a': '', 'r': ''}}, {far}, {{'c': 5, 'a': 'I', 'r': chr(10) || 'user:'}},
    {{'c': 10, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} FROM conversations
  UNION ALL SELECT conv_id, p, n0, n1, m2, {least('n3', move('m2', 'I', 5, "'assistant'"))} FROM (
    SELECT *, {least('n2', *insert_user)} AS m2 FROM (
      SELECT s.conv_id, w.p, {move('s0', 'D', 2)} AS n0,
        {least(move('s1', 'D', 2), f"CASE WHEN w.gone OR w.i <> 's' THEN {far} ELSE " + move('s0', 'K', '5 * w.trunc', 'w.role', 'w.text') + " END")} AS n1,
        {least(move('s2', 'D', 2), kept('s0', 'u', 'user'), kept('s1', 'u', 'user'), kept('s3', 'u', 'user'))} AS n2,
        {least(move('s3', 'D', 2), kept('s2', 'a', 'assistant'))} AS n3
      FROM s JOIN w ON s.conv_id = w.conv_id AND w.p = s.p + 1))),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
  sum(trunc) AS truncated, count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM w GROUP BY conv_id),
z AS (SELECT s.conv_id, gaps, blank, duplicate, truncated, illegal, {least('s0', 's3')} AS b FROM s LEFT JOIN g ON s.conv_id = g.conv_id WHERE s.p = coalesce(g.n, 0))
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, b.c::BIGINT AS cost, b.a AS audit, sha256(substr(b.r, 2)) AS repaired_sha256 FROM z"""
