r"""License notices by exact set-similarity join.

Each template is a set of words, and each run of as many words of a text as
the template's wording has is a block, whatever the line breaks (a shorter
text is one block). A block holds a template if it has at least ``THRESHOLD``
of the template's distinct words, among them those that name the license, and
none that names another of its family.

Words are ordered by how often they stand in all texts, rarest first. A block
that meets the threshold has one of the first |T| - need + 1 words of the
template (prefix), has ``need`` words of some template (length), and after
the first shared word both sides still have enough left (position). The
surroundings of prefix words are tried by the three filters first; the blocks
in those that pass are counted out by a sliding window.

The templates are a fixed, short list; blocks stay where they are, and what
moves between tasks is one count for each template word and task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.text import UPPER, LOWER

# Label and wording of common notices, words that must be there, words that must not.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache 2", ""),
    ("mit", "Released under the MIT License", "mit license", ""),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "", ""),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "fee", ""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "gnu general public license", "lesser library affero"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
     "gnu general public license", "lesser library affero"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
     "gnu lesser general public license", "affero"),
    ("lgpl", "This work is licensed under the GNU Lesser General Public License, version 3", "gnu lesser general public license", "affero"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
     "gnu affero general public license", "lesser library"),
    ("cc-by", "Licensed under CC BY 4.0", "cc by 0", "nc nd sa"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa 0", "nc nd"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0", "cc by nd 0", "nc sa"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc 0", "nd sa"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0", "cc by nc sa 0", "nd"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0", "cc by nc nd 0", "sa"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
     "creative commons attribution license", "noncommercial noderivatives sharealike"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
     "creative commons attribution sharealike license", "noncommercial noderivatives"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
     "creative commons attribution noderivatives license", "noncommercial sharealike"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
     "creative commons attribution noncommercial license", "noderivatives sharealike"),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
     "creative commons attribution noncommercial sharealike license", "noderivatives"),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
     "creative commons attribution noncommercial noderivatives license", "sharealike"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights", "waived", ""),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution", ""),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla 2", ""),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License", "eclipse", ""),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0", "boost 1", ""),
    ("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered", ""),
    ("zlib", "In no event will the authors be held liable for any damages arising from the use of this software", "authors", ""),
)
# Phrases and their labels.
PHRASES = (
    (("cc", "by"), "cc-by"),
    (("general", "public", "license"), "gpl"),
    (("all", "rights", "reserved"), "reserved"),
)
# Containment as a fraction of whole numbers.
THRESHOLD = (4, 5)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


class Index:
    """Templates as word lists in the global order, and the prefix words that lead to them."""

    def __init__(self, templates, counts: dict[bytes, int], threshold: tuple[int, int]):
        part, whole = threshold
        self.sets = [(label, frozenset(_words(text.encode()))) for label, text, _, _ in templates]
        self.lengths = [len(_words(text.encode())) for _, text, _, _ in templates]
        self.naming = [frozenset(_words(words.encode())) for _, _, words, _ in templates]
        self.others = [frozenset(_words(words.encode())) for _, _, _, words in templates]
        vocabulary = set().union(*(words for _, words in self.sets))
        self.rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
        self.templates = []
        self.prefixes: dict[bytes, list[tuple[int, int]]] = {}
        for t, (label, words) in enumerate(self.sets):
            ordered = sorted(words, key=self.rank.__getitem__)
            need = -(-part * len(ordered) // whole)
            self.templates.append((label, words, len(ordered), need))
            for i, word in enumerate(ordered[:len(ordered) - need + 1]):
                self.prefixes.setdefault(word, []).append((t, i))
        self.leads = frozenset(self.prefixes)
        self.reach = max(self.lengths, default=0)

    def search(self, block: list[bytes]) -> Iterator[tuple[int, int]]:
        """(template, shared words) of every template of whose words the block holds enough."""
        if self.leads.isdisjoint(block):
            return
        # Words of no template cannot be shared.
        ordered = sorted({w for w in block if w in self.rank}, key=self.rank.__getitem__)
        seen = set()
        for j, word in enumerate(ordered):
            for t, i in self.prefixes.get(word, ()):
                if t in seen:
                    continue
                seen.add(t)
                _, words, size, need = self.templates[t]
                if len(ordered) < need or 1 + min(size - i - 1, len(ordered) - j - 1) < need:
                    continue
                shared = len(words.intersection(ordered))
                if shared >= need:
                    yield t, shared

    def _regions(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(start, end) of what lies within the longest block of a prefix word; regions that touch are one."""
        begin = end = None
        for p, word in enumerate(words):
            if word in self.leads:
                if end is not None and p - self.reach + 1 <= end:
                    end = min(len(words), p + self.reach)
                    continue
                if end is not None:
                    yield begin, end
                begin, end = max(0, p - self.reach + 1), min(len(words), p + self.reach)
        if end is not None:
            yield begin, end

    def _runs(self, words: list[bytes], t: int) -> Iterator[tuple[int, int]]:
        """(start, shared words) of the best block, the first of equals, of every run of blocks that hold the template."""
        _, own, _, need = self.templates[t]
        length, naming, others = min(self.lengths[t], len(words)), self.naming[t], self.others[t]
        held: Counter = Counter()
        shared = named = barred = 0
        best = None
        for p, word in enumerate(words):
            if word in own:
                held[word] += 1
                if held[word] == 1:
                    shared += 1
                    named += word in naming
            barred += word in others
            start = p - length + 1
            if start > 0:
                gone = words[start - 1]
                if gone in own:
                    held[gone] -= 1
                    if not held[gone]:
                        shared -= 1
                        named -= gone in naming
                barred -= gone in others
            if start < 0:
                continue
            if shared >= need and named == len(naming) and not barred:
                if best is None or shared > best[1]:
                    best = (start, shared)
            elif best is not None:
                yield best
                best = None
        if best is not None:
            yield best

    def blocks(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(template, start, shared words) of the best block of every run of blocks of a text that hold a template."""
        for begin, end in self._regions(words):
            region = words[begin:end]
            present = set(region)
            for t, _ in self.search(region):
                if self.naming[t] <= present:
                    for start, shared in self._runs(region, t):
                        yield t, begin + start, shared


def _phrases(words: list[bytes], present: set[bytes], phrases) -> dict[str, list[int]]:
    found: dict[str, list[int]] = {}
    for phrase, label in phrases:
        if not present.issuperset(phrase):
            continue
        at, first = -1, phrase[0]
        while True:
            try:
                at = words.index(first, at + 1)
            except ValueError:
                break
            if tuple(words[at:at + len(phrase)]) == phrase:
                found.setdefault(label, []).append(at)
    return found


def word_counts(df: DataFrame, vocabulary: frozenset[bytes], text: str) -> dict[bytes, int]:
    """How often each word of the fixed vocabulary stands in all texts."""
    def run(batches):
        for batch in batches:
            counts: Counter = Counter()
            for value in batch.column(0).to_pylist():
                counts.update(w for w in _words(value or b"") if w in vocabulary)
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())})

    found = df.select(F.col(text).cast("binary")).mapInArrow(run, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES,
    threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, matches) for every row.

    ``templates`` are (label, wording, naming words, words that must not be
    there). ``matches`` has (word, label, template, containment) of every run
    of blocks that hold a template: where its best block starts, the first of
    equals, words and templates counted from 0. ``n_base`` counts the places
    of the phrases, ``first_word`` and ``last_word`` are the least and largest
    start, null without one. A null text is empty. Texts may have any length.
    Repeated rows get equal results; an empty table gives an empty result;
    other columns are not touched.
    """
    kind = df.schema[key].dataType.simpleString()
    vocabulary = frozenset(w for _, t, _, _ in templates for w in _words(t.encode()))
    index = Index(templates, word_counts(df, vocabulary, text), threshold)
    phrases = [(tuple(w.encode() for w in phrase), label) for phrase, label in phrases]
    asked = frozenset(w for phrase, _ in phrases for w in phrase)
    matches = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string()), ("template", pa.int32()), ("containment", pa.float64())]))

    def one(value: bytes | None) -> tuple:
        lowered = (value or b"").lower()
        words = _WORD.findall(lowered)
        places = _phrases(words, asked.intersection(words), phrases)
        starts = [p for found in places.values() for p in found]
        held = []
        if not index.leads.isdisjoint(words):
            for t, start, shared in index.blocks(words):
                label, _, size, _ = index.templates[t]
                held.append({"word": start, "label": label, "template": t, "containment": shared / size})
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(places), held)

    def run(batches):
        for batch in batches:
            found = list(zip(*(one(v) for v in batch.column(1).to_pylist()))) or [[]] * 6
            columns = [pa.array(c, t) for c, t in zip(
                found, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), matches))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[
                "key", "n_words", "n_base", "first_word", "last_word", "base_labels", "matches"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(
        run, f"key {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "matches array<struct<word:bigint,label:string,template:int,containment:double>>").withColumnRenamed("key", key)


def _list(words) -> str:
    return "CAST([" + ", ".join(f"'{w.decode()}'" for w in sorted(set(words))) + "] AS VARCHAR[])"


def _values() -> str:
    return ", ".join("({}, '{}', {}, {}, {}, {})".format(
        i, label, len(_words(t.encode())), *(_list(_words(x.encode())) for x in (t, naming, others)))
        for i, (label, t, naming, others) in enumerate(TEMPLATES))


_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _tokens(column: str) -> str:
    return f"list_filter(regexp_split_to_array(translate({column}, '{UPPER}', '{LOWER}'), '{_SPLIT}'), lambda x: x <> '')"


def _starts() -> str:
    parts = []
    for phrase, label in PHRASES:
        same = " AND ".join(f"w[p + {i + 1}] = '{word}'" for i, word in enumerate(phrase))
        parts.append(f"SELECT r, p, '{label}' AS label FROM places WHERE {same}")
    return " UNION ALL ".join(parts)


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, {_tokens('t')} AS w FROM d),
places AS (SELECT r, w, unnest(range(len(w))) AS p FROM w),
starts AS ({_starts()}),
base AS (SELECT r, count(*) AS n, min(p) AS a, max(p) AS z FROM starts GROUP BY r),
templates(t, label, n, words, naming, others) AS (VALUES {_values()}),
texts AS (SELECT r, list_distinct(w) AS present FROM w),
possible AS (
  SELECT r, t FROM texts, templates
  WHERE list_has_all(present, naming) AND {THRESHOLD[1]} * len(list_intersect(present, words)) >= {THRESHOLD[0]} * len(words)),
blocks AS (
  SELECT r, t, w[p + 1 : p + n] AS b
  FROM (SELECT r, t, n, w, unnest(range(greatest(len(w) - n + 1, 1))) AS p FROM possible JOIN w USING (r) JOIN templates USING (t))),
held AS (
  SELECT r, label, CAST(len(list_intersect(b, words)) AS DOUBLE) / len(words) AS c FROM blocks JOIN templates USING (t)
  WHERE list_has_all(b, naming) AND NOT list_has_any(b, others)
    AND {THRESHOLD[1]} * len(list_intersect(b, words)) >= {THRESHOLD[0]} * len(words)),
best AS (SELECT r, max(c) AS c FROM held GROUP BY r),
base_names AS (SELECT r, string_agg(label, ',' ORDER BY label) AS names FROM (SELECT DISTINCT r, label FROM starts) GROUP BY r),
all_names AS (
  SELECT r, string_agg(label, ',' ORDER BY label) AS names
  FROM (SELECT r, label FROM starts UNION SELECT r, label FROM held) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base,
       CAST(a AS BIGINT) AS first_word, CAST(z AS BIGINT) AS last_word,
       coalesce(base_names.names, '') AS base_labels, coalesce(all_names.names, '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(best.c, 0.0::DOUBLE) END AS score
FROM w LEFT JOIN base ON w.r = base.r LEFT JOIN best ON w.r = best.r
LEFT JOIN base_names ON w.r = base_names.r LEFT JOIN all_names ON w.r = all_names.r
"""
