"""License scans with ordered signature rules.

A text is cut into words (ASCII letters in lower case). A rule is a sequence of words
(``a|b`` is either, ``a?`` may be missing, but not at the ends), a keyword that every match contains, a priority (0 is the
strongest evidence) and a label. A rule is tried only on texts that hold its keyword, and
texts that hold no keyword at all are not numbered or searched. Detections are intervals of
words; one is suppressed when another that is at least as strong contains it (of equal
intervals and priorities the first rule stays).

The words are numbered in the searched text ("17:mit 18:license"), so that a regex match
gives its interval by the numbers of its first and last word, at any count of matches in one
pass. Only words as near to a keyword as the longest rule is long are searched, since every
match holds its keyword; a mark stands where words between are left out. All of it is one projection of DataFrame functions: no shuffle, no Python.

Defined results: a null text has no words; empty texts get zero counts, null positions and
empty labels; ties and repeated rows are scored row by row; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.shared import ascii_lower, chunked

# What separates words, and the base phrases.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# License families as (label, keyword, name).
FAMILIES = (
    ("0bsd", "0bsd", "0bsd"),
    ("academic-free", "academic", "academic free"),
    ("agpl", "affero", "affero general public"),
    ("apache-1.1", "apache", "apache software? version|v? 1 1"),
    ("apache-2.0", "apache", "apache software? version|v? 2"),
    ("artistic", "artistic", "artistic"),
    ("beerware", "beerware", "beerware"),
    ("boost", "boost", "boost software"),
    ("bsd-2-clause", "bsd", "2|two|simplified clause? bsd"),
    ("bsd-3-clause", "bsd", "3|three|new|modified|revised clause? bsd"),
    ("bsd-4-clause", "bsd", "4|four|original clause? bsd"),
    ("cc-by", "creative", "creative commons attribution"),
    ("cc-by-sa", "creative", "creative commons attribution share|sharealike"),
    ("cc-by-nc", "creative", "creative commons attribution non|noncommercial"),
    ("cc-by-nd", "creative", "creative commons attribution no|noderivatives|noderivs"),
    ("cc0", "cc0", "cc0"),
    ("cddl", "cddl", "cddl"),
    ("cecill", "cecill", "cecill"),
    ("cpl", "common", "common public"),
    ("ecl", "educational", "educational community"),
    ("eiffel", "eiffel", "eiffel forum"),
    ("epl", "eclipse", "eclipse public"),
    ("eupl", "eupl", "eupl"),
    ("gfdl", "documentation", "free documentation"),
    ("gpl-2.0", "gpl", "gpl version|v? 2"),
    ("gpl-3.0", "gpl", "gpl version|v? 3"),
    ("ijg", "jpeg", "independent jpeg group"),
    ("intel", "intel", "intel open source"),
    ("isc", "isc", "isc"),
    ("lgpl", "general", "lesser|library general public"),
    ("lgpl", "lgpl", "lgpl"),
    ("libpng", "libpng", "libpng"),
    ("lppl", "latex", "latex project public"),
    ("mit", "expat", "expat"),
    ("mit", "mit", "mit"),
    ("mpl-1.1", "mozilla", "mozilla public version|v? 1 1"),
    ("mpl-2.0", "mozilla", "mozilla public version|v? 2"),
    ("ms-pl", "microsoft", "microsoft public"),
    ("ms-rl", "microsoft", "microsoft reciprocal"),
    ("ncsa", "illinois", "university of illinois"),
    ("ofl", "sil", "sil open font"),
    ("odbl", "odbl", "odbl"),
    ("openssl", "openssl", "openssl"),
    ("osl", "osl", "osl"),
    ("php", "php", "php"),
    ("postgresql", "postgresql", "postgresql"),
    ("psf", "python", "python software foundation"),
    ("qpl", "qpl", "qpl"),
    ("ruby", "ruby", "ruby"),
    ("sleepycat", "sleepycat", "sleepycat"),
    ("unicode", "unicode", "unicode"),
    ("unlicense", "unlicense", "unlicense"),
    ("vim", "vim", "vim"),
    ("w3c", "w3c", "w3c software"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("x11", "x11", "x11"),
    ("zlib", "zlib", "zlib"),
    ("zope", "zope", "zope public"),
)
# How texts speak of a license, as (priority, words before the name, after it).
FORMS = (
    (0, "spdx license identifier", ""),
    (1, "licensed|licenced under the|an|a?", ""),
    (1, "licensed|licenced under the|an|a?", "license|licence"),
    (1, "released|distributed|available|published|provided under the|an|a? terms? of? the?", "license|licence"),
    (1, "subject to the? terms of the?", "license|licence"),
    (2, "", "license|licence"),
    (3, "", "licensed"),
)
# Licenses with a version as (label, keyword, name, version). "license" may stand
# before the version or after it ("Apache License, Version 2.0", "Apache 2.0 License").
VERSIONED = (
    ("agpl-3.0", "affero", "affero general public", "3"),
    ("agpl-3.0", "agpl", "agpl", "3"),
    ("apache-1.1", "apache", "apache software?", "1 1"),
    ("apache-2.0", "apache", "apache software?", "2"),
    ("artistic-2.0", "artistic", "artistic", "2"),
    ("boost", "boost", "boost software", "1"),
    ("cddl-1.0", "cddl", "cddl", "1"),
    ("cddl-1.0", "distribution", "common development and distribution", "1"),
    ("epl-1.0", "eclipse", "eclipse public", "1"),
    ("epl-1.0", "epl", "epl", "1"),
    ("epl-2.0", "eclipse", "eclipse public", "2"),
    ("epl-2.0", "epl", "epl", "2"),
    ("eupl-1.2", "eupl", "eupl", "1 2"),
    ("gpl-2.0", "general", "general public", "2"),
    ("gpl-2.0", "gpl", "gpl", "2"),
    ("gpl-3.0", "general", "general public", "3"),
    ("gpl-3.0", "gpl", "gpl", "3"),
    ("lgpl-2.1", "general", "lesser|library general public", "2 1"),
    ("lgpl-2.1", "lgpl", "lgpl", "2 1"),
    ("lgpl-2.0", "general", "lesser|library general public", "2"),
    ("lgpl-2.0", "lgpl", "lgpl", "2"),
    ("lgpl-3.0", "general", "lesser|library general public", "3"),
    ("lgpl-3.0", "lgpl", "lgpl", "3"),
    ("mpl-1.1", "mozilla", "mozilla public", "1 1"),
    ("mpl-1.1", "mpl", "mpl", "1 1"),
    ("mpl-2.0", "mozilla", "mozilla public", "2"),
    ("mpl-2.0", "mpl", "mpl", "2"),
)
# How texts speak of a version, as (priority, words before the name, after the version).
VERSION_FORMS = (
    (0, "spdx license identifier", ""),
    (1, "licensed|licenced under the|an|a? gnu?", ""),
    (1, "released|distributed|available|published|provided under the|an|a? terms? of? the? gnu?", ""),
    (1, "subject to the? terms of the? gnu?", ""),
    (2, "", "0? or? later? license|licence"),
)
# SPDX identifiers and short names as words.
IDS = (
    ("agpl-3.0", "agpl", "agpl 3 0"), ("agpl-3.0", "agplv3", "agplv3"),
    ("apache-2.0", "apache", "apache 2 0"), ("artistic-2.0", "artistic", "artistic 2 0"),
    ("boost", "bsl", "bsl 1 0"),
    ("bsd-2-clause", "bsd", "bsd 2 clause"), ("bsd-3-clause", "bsd", "bsd 3 clause"), ("bsd-4-clause", "bsd", "bsd 4 clause"),
    ("cc-by", "cc", "cc by 1|2|3|4"), ("cc-by-sa", "cc", "cc by sa"), ("cc-by-nc", "cc", "cc by nc"), ("cc-by-nd", "cc", "cc by nd"),
    ("cc0", "cc0", "cc0 1 0"), ("cddl-1.0", "cddl", "cddl 1 0"), ("epl-1.0", "epl", "epl 1 0"), ("epl-2.0", "epl", "epl 2 0"),
    ("eupl-1.2", "eupl", "eupl 1 2"),
    ("gpl-2.0", "gpl", "gpl 2 0"), ("gpl-2.0", "gplv2", "gplv2"), ("gpl-3.0", "gpl", "gpl 3 0"), ("gpl-3.0", "gplv3", "gplv3"),
    ("lgpl-2.0", "lgpl", "lgpl 2 0"), ("lgpl-2.1", "lgpl", "lgpl 2 1"), ("lgpl-3.0", "lgpl", "lgpl 3 0"), ("lgpl-3.0", "lgplv3", "lgplv3"),
    ("mpl-1.1", "mpl", "mpl 1 1"), ("mpl-2.0", "mpl", "mpl 2 0"), ("ms-pl", "ms", "ms pl"), ("ms-rl", "ms", "ms rl"),
    ("ofl", "ofl", "ofl 1 1"), ("psf", "psf", "psf 2 0"), ("unlicense", "unlicense", "unlicense"),
)
ID_FORMS = ((0, "spdx license identifier"), (1, "licensed|licenced under the|an|a?"), (2, "license|licence"), (3, ""))
# Phrases of the license texts themselves, as (label, keyword, words).
PHRASES = (
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("gpl", "gnu", "gnu general public license"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "domain", "dedicated|released to|into the public domain"),
    ("cc0", "waived", "waived all copyright and related or neighboring rights"),
    ("proprietary", "reserved", "all rights reserved"),
    ("proprietary", "confidential", "proprietary and confidential"),
    ("warranty-disclaimer", "warranty", "without warranty of any kind"),
)
PHRASES += tuple((f"cc-by{end}", "creative", f"creative commons attribution{words} 1|2|3|4 0|5? international|unported|generic? public? license|licence")
                 for end, words in (("", ""), ("-sa", " share|sharealike alike?"), ("-nc", " non|noncommercial commercial?"),
                                    ("-nd", " no|noderivatives|noderivs derivatives|derivs?"),
                                    ("-nc-sa", " non|noncommercial commercial? share|sharealike alike?"),
                                    ("-nc-nd", " non|noncommercial commercial? no|noderivatives|noderivs derivatives|derivs?")))
PRIORITIES = 4
CONFIDENCE = (1.0, 0.9, 0.8, 0.5)      # parameter: by priority
DETECTIONS = "array<struct<start:int,neg_end:int,priority:int,rule:int,label:string>>"


def _after_number(words: str) -> str:
    """Words as a regex over numbered words, from after the first word's number."""
    first, *rest = words.split()
    return f"(?:{first})" + "".join(rf"(?: \d+:(?:{w[:-1]}))?" if w.endswith("?") else rf" \d+:(?:{w})" for w in rest)


def numbered(words: str) -> str:
    """Words as a regex over numbered words; group 1 is the first word's number, group 2 the last's."""
    parts = words.split()
    if len(parts) == 1:
        return rf"(?<![^ ])((\d+)):(?:{parts[0]})(?![^ ])"
    return rf"(?<![^ ])(\d+):{_after_number(' '.join(parts[:-1]))} (\d+):(?:{parts[-1]})(?![^ ])"


def _versioned(name: str, version: str) -> str:
    first, *rest = version.split()
    return " ".join([name, "license|licence?", "version|v?", f"{first}|v{first}", *rest])


def signatures() -> list[tuple[int, str, str, str]]:
    """(priority, keyword, words, label) of every rule, in order."""
    joined = lambda *parts: " ".join(x for x in parts if x)
    out = [(priority, keyword, joined(before, name, after), label)
           for label, keyword, name in FAMILIES for priority, before, after in FORMS]
    out += [(priority, keyword, joined(before, _versioned(name, version), after), label)
            for label, keyword, name, version in VERSIONED for priority, before, after in VERSION_FORMS]
    # the license named before its version, without any other word around
    out += [(2, keyword, _versioned(name, version).replace("license|licence?", "license|licence"), label)
            for label, keyword, name, version in VERSIONED]
    out += [(priority, keyword, joined(before, words), label) for label, keyword, words in IDS for priority, before in ID_FORMS]
    return out + [(1, keyword, words, label) for label, keyword, words in PHRASES]


def rules() -> list[tuple[int, str, str, str]]:
    """(priority, keyword, regex, label) of every rule, in order."""
    return [(priority, keyword, numbered(words), label) for priority, keyword, words, label in signatures()]


def _near(places: str, n_words: Column) -> Column:
    """The numbers, ascending, of all words that a match can hold: those at most as far from a
    keyword as the longest rule reaches. Windows begin where the one before ends, so the array is
    never longer than the text."""
    reach = max(len(words.split()) for _, _, words, _ in signatures()) - 1

    def window(i, j):
        before = F.when(j > 0, F.get(places, j - 1) + reach + 1)
        first, last = F.greatest(i - reach, F.lit(0), before), F.least(i + reach, n_words - 1)
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.expr("cast(array() as array<int>)"))

    return F.flatten(F.transform(places, window))


def _any_of(words: list[str]) -> str:
    """A regex for any of the words, by first letters: an alternation tries its branches one by one
    at every word of every text."""
    return "|".join(f"{first}(?:{'|'.join(w[1:] for w in words if w[0] == first)})" for first in sorted({w[0] for w in words}))


def words_of(text: Column) -> Column:
    """The text's words with single spaces between (letters as they were)."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATORS, " "))


def _rule_table() -> Column:
    """The rules as one constant array of structs, parsed from one text (a literal a field would
    take some thousand calls to the JVM and as many nodes of the plan)."""
    rows = [{"priority": p, "keyword": k, "regex": r, "label": label, "rule": i} for i, (p, k, r, label) in enumerate(rules())]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<priority:int,keyword:string,regex:string,label:string,rule:int>>")


def _intervals(numbered_text: Column, regex: Column) -> Column:
    """Whole matches, whose first and last word carry their numbers: a pattern that comes from an
    array is compiled anew for every text, so each is asked once."""
    return F.transform(F.regexp_extract_all(numbered_text, regex, F.lit(0)), lambda m: F.struct(
        F.substring_index(m, ":", 1).cast("int").alias("first"),
        F.substring_index(F.substring_index(m, " ", -1), ":", 1).cast("int").alias("last")))


def _unsuppressed(found: Column) -> Column:
    """Detections that no earlier one contains; ``found`` is sorted by (start, -end, priority,
    rule), so whatever contains a detection stands before it, and it is enough to carry the
    largest end seen at each priority or a stronger one."""
    carry = F.array(*[F.lit(0)] * PRIORITIES)

    def grown(best, priority, end):
        return F.transform(best, lambda v, p: F.when(p >= priority, F.greatest(v, end)).otherwise(v))

    def fold(best, d):
        return grown(best, d["priority"], -d["neg_end"])

    none = F.expr(f"cast(array() as {DETECTIONS})")
    chunks = chunked(found)
    # the carry at the start of each chunk, then the chunks one by one
    starts = F.aggregate(
        F.transform(chunks, lambda c: F.aggregate(c, carry, fold)),
        F.struct(carry.alias("best"), F.expr("cast(array() as array<array<int>>)").alias("out")),
        lambda s, c: F.struct(F.zip_with(s["best"], c, lambda a, b: F.greatest(a, b)).alias("best"),
                              F.concat(s["out"], F.array(s["best"])).alias("out")))["out"]

    def keep(s, d):
        contained = F.element_at(s["best"], d["priority"] + 1) >= -d["neg_end"]
        return F.struct(fold(s["best"], d).alias("best"),
                        F.when(contained, s["out"]).otherwise(F.concat(s["out"], F.array(d))).alias("out"))

    return F.flatten(F.transform(
        F.arrays_zip(chunks.alias("c"), starts.alias("s")),
        lambda z: F.aggregate(z["c"], F.struct(z["s"].alias("best"), none.alias("out")), keep)["out"]))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``base`` (array of the base phrases'
    places: start and label) and ``detections`` (what the rules found and nothing suppressed:
    start and end in words, end exclusive, priority, rule, label)."""
    table = rules()
    keywords = sorted({k for _, k, _, _ in table} | {"license"})
    words = F.col("_words")
    step = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("_words"))
    # the prefilter: some keyword as a whole word, in any case
    gate = words.rlike(f"(?i)(?<![^ ])(?:{_any_of(keywords)})(?![^ ])")
    # functions of the marked texts only: their words in lower case, then numbered
    step = step.select(
        "doc_id",
        F.when(words == "", 0).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1)
        .cast("bigint").alias("n_words"),
        F.when(gate, F.split(ascii_lower(words), " ", -1)).alias("_list"))
    places_of_keys = F.filter(F.transform("_list", lambda w, i: F.when(w.isin(keywords), i)), lambda i: i.isNotNull())
    step = step.select("doc_id", "n_words", "_list", places_of_keys.alias("_places"))
    step = step.select("doc_id", "n_words", "_list", _near("_places", F.size("_list")).alias("_near"),
                       F.array_distinct(F.transform("_places", lambda i: F.get("_list", i))).alias("_keys"))
    step = step.select("doc_id", "n_words", "_keys", F.array_join(F.transform("_near", lambda i, j: F.concat(
        F.when(F.get("_near", j - 1) < i - 1, F.lit("| ")).otherwise(F.lit("")), i.cast("string"), F.lit(":"), F.get("_list", i))), " ")
        .alias("_numbered"))
    text = F.col("_numbered")

    def places(phrase, label):
        starts = F.regexp_extract_all(text, F.lit(numbered(phrase)), F.lit(1))
        return F.transform(starts, lambda s: F.struct(s.cast("bigint").alias("start"), F.lit(label).alias("label")))

    base = F.flatten(F.array(*[places(phrase, label) for phrase, label in BASE]))
    # patterns that stand in the plan are compiled once a task, those of the rules anew for every
    # text: so first ask each keyword of the text whether any of its rules matches
    tails = {}
    for _, keyword, signature, _ in signatures():
        tails.setdefault(keyword, []).append(_after_number(signature))
    some = [F.when(F.array_contains("_keys", k) & text.rlike(rf"(?<![^ ])\d+:(?:{'|'.join(t)})(?![^ ])"), F.lit(k)) for k, t in tails.items()]
    step = step.select("doc_id", "n_words", "_numbered", F.array(*some).alias("_matching"))
    # bound by a lambda: a column named inside the filter would be computed anew for every rule
    active = F.get(F.transform(F.array("_matching"), lambda keys: F.filter(_rule_table(), lambda r: F.array_contains(keys, r["keyword"]))), F.lit(0))
    found = F.flatten(F.transform(active, lambda r: F.transform(
        _intervals(text, r["regex"]),
        lambda m: F.struct(m["first"].alias("start"), (-m["last"] - 1).alias("neg_end"),
                           r["priority"].alias("priority"), r["rule"].alias("rule"), r["label"].alias("label")))))
    step = step.select("doc_id", "n_words", F.when(text.isNotNull(), base).alias("base"),
                       F.when(text.isNotNull(), F.array_sort(found)).cast(DETECTIONS).alias("found"))
    return step.select(
        "doc_id", "n_words", F.coalesce("base", F.expr("cast(array() as array<struct<start:bigint,label:string>>)")).alias("base"),
        F.coalesce(F.when(F.size("found") > 0, _unsuppressed(F.col("found"))),
                   F.expr(f"cast(array() as {DETECTIONS})")).alias("detections"))


def op1_license(docs: DataFrame) -> DataFrame:
    scan = license_scan(docs)
    labels = lambda *a: F.array_join(F.array_sort(F.array_distinct(F.concat(*a))), ",")
    base, own = F.transform("base", lambda b: b["label"]), F.transform("detections", lambda d: d["label"])
    strength = F.transform("detections", lambda d: F.element_at(F.array(*[F.lit(c) for c in CONFIDENCE]), d["priority"] + 1))
    best = F.coalesce(F.array_max(strength), F.lit(0.0))
    return scan.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["start"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["start"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(base, own).alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, CONFIDENCE[2]).otherwise(0.0)).alias("score"))


def _spaced(words: str) -> str:
    """The rule for a text whose words stand as " 17:mit ", each with spaces of its own (the
    oracle's regular expressions can't look around)."""
    parts = words.split()
    if len(parts) == 1:
        return rf" ((\d+)):(?:{parts[0]}) "
    out = rf" (\d+):(?:{parts[0]}) "
    for w in parts[1:-1]:
        out += rf"(?: \d+:(?:{w[:-1]}) )?" if w.endswith("?") else rf" \d+:(?:{w}) "
    return out + rf" (\d+):(?:{parts[-1]}) "


def oracle() -> str:
    """The same rows in DuckDB SQL: rules as a table, met by keyword, suppressed by NOT EXISTS."""
    rows = [(p, k, _spaced(words), label) for p, k, words, label in signatures()]
    rule_rows = ", ".join(f"({i}, {p}, '{k}', '{r}', '{label}')" for i, (p, k, r, label) in enumerate(rows))
    base_rows = ", ".join(f"('{_spaced(phrase)}', '{label}')" for phrase, label in BASE)
    score = " ".join(f"WHEN {p} THEN {c}" for p, c in enumerate(CONFIDENCE))
    return rf"""
WITH rules AS (SELECT * FROM (VALUES {rule_rows}) t(rule, priority, keyword, regex, label)),
bases AS (SELECT * FROM (VALUES {base_rows}) t(regex, label)),
d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT k, w, array_to_string(list_transform(w, lambda x, i: ' ' || (i - 1) || ':' || x || ' '), '') AS t
  FROM d WHERE list_has_any(w, [{', '.join(f"'{k}'" for k in sorted({r[1] for r in rows} | {'license'}))}])),
b AS (SELECT k, label, unnest(regexp_extract_all(t, regex, 1))::BIGINT AS place FROM t, bases),
f AS (SELECT k, rule, priority, label, unnest(regexp_extract_all(t, regex, 1))::BIGINT AS s, unnest(regexp_extract_all(t, regex, 2))::BIGINT AS e
  FROM t JOIN rules ON list_contains(w, keyword)),
kept AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.k = f.k AND g.s <= f.s AND g.e >= f.e AND g.priority <= f.priority
    AND (g.s < f.s OR g.e > f.e OR g.priority < f.priority OR g.rule < f.rule))),
pb AS (SELECT k, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM b GROUP BY k),
pl AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT k, label FROM b UNION ALL SELECT k, label FROM kept) GROUP BY k),
ps AS (SELECT k, max(CASE priority {score} END) AS score FROM (SELECT k, priority FROM kept UNION ALL SELECT k, 2 FROM b) GROUP BY k)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN pb USING (k) LEFT JOIN pl USING (k) LEFT JOIN ps USING (k)"""
