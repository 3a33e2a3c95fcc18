import random
import re

import pytest

from medloom.llm import licenses


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates=licenses.TEMPLATES):
    w = words(text)
    starts = [(p, label) for phrase, label in licenses.PHRASES for p in range(len(w)) if tuple(w[p:p + len(phrase)]) == phrase]
    held = []
    for t, (label, wording, naming, others) in enumerate(templates):
        size, need = len(words(wording)), set(words(wording))
        run = []
        for s in range(max(1, len(w) - size + 1) + 1):
            b = set(w[s:s + size]) if s < max(1, len(w) - size + 1) else set()
            if 5 * len(b & need) >= 4 * len(need) and b >= set(words(naming)) and not b & set(words(others)):
                run.append((-len(b & need), s))
            elif run:
                shared, at = min(run)
                held.append((at, label, t, -shared / len(need)))
                run = []
    at = [p for p, _ in starts]
    return len(w), len(at), min(at, default=None), max(at, default=None), sorted({x for _, x in starts}), sorted(held)


def rows():
    rng = random.Random(3)
    out = []
    for i in range(150):
        _, wording, _, _ = rng.choice(licenses.TEMPLATES)
        w = wording.split()
        if i % 2:
            rng.shuffle(w)
            w = w[:rng.randrange(len(w) // 2, len(w) + 1)]
        else:
            at = rng.randrange(len(w))
            w[at:at] = rng.choice([[], ["\n"], ["//", "\n//"], ["other"], ["NonCommercial"]])
        lines = [" ".join(rng.choice(["the", "of", "license", "free", "version"]) for _ in range(8)), " ".join(w), "plain words"]
        rng.shuffle(lines)
        out.append((i, "\n".join(lines)))
    out += [(500, None), (501, ""), (502, "CC BY cc-by CC\nBY"), (503, "All Rights Reserved. all rights"), (504, "GNU General Public License general public license"),
            (505, "x " * 2_000 + "Released under the MIT License"), (None, "Licensed under CC BY-NC 4.0."), (0, out[0][1]), (0, out[0][1]), (506, "ccby cc. by"), (507, "\n\n\n")]
    return out


def test_against_brute_force(docs):
    data = rows()
    found = licenses.scan(docs(data, clash=True)).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, sorted((m.word, m.label, m.template, m.containment) for m in r.matches)) for r in found), key=str)
    assert got == sorted(((k, *brute(t)) for k, t in data), key=str)
    assert any(r.matches for r in found)


@pytest.mark.parametrize("seed", range(5))
def test_filters_lose_nothing_whatever_the_order(seed):
    """Any order of the words, small vocabularies, many shared words."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(14)]
    templates = [(f"l{i}", " ".join(rng.sample(vocabulary, rng.randrange(1, 12))), "", "") for i in range(12)]
    index = licenses.Index(templates, {v.encode(): rng.randrange(3) for v in vocabulary}, (4, 5))
    for _ in range(300):
        block = [rng.choice(vocabulary + ["other"]) for _ in range(rng.randrange(16))]
        got = sorted(index.search([b.encode() for b in block]))
        assert got == [(t, len(set(w.split()) & set(block))) for t, (_, w, _, _) in enumerate(templates)
                       if 5 * len(set(w.split()) & set(block)) >= 4 * len(set(w.split()))]


@pytest.mark.parametrize("seed", range(5))
def test_blocks_of_any_words(seed):
    """Overlapping runs, words twice, templates longer than the text, naming and barring words."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(9)]
    templates = []
    for i in range(10):
        wording = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 9))]
        naming = rng.sample(sorted(set(wording)), rng.randrange(0, min(3, len(set(wording)) + 1)))
        templates.append((f"l{i}", " ".join(wording), " ".join(naming), " ".join(rng.sample(sorted({*vocabulary, "w"} - set(wording)), rng.randrange(2)))))
    index = licenses.Index(templates, {v.encode(): rng.randrange(3) for v in vocabulary}, (4, 5))
    for _ in range(200):
        text = [rng.choice(vocabulary + ["other", "w"] * rng.randrange(6)) for _ in range(rng.randrange(50))]
        got = sorted((s, templates[t][0], t, n / index.templates[t][2]) for t, s, n in index.blocks([w.encode() for w in text]))
        assert got == brute(" ".join(text), templates)[-1]


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY 4.0", ["cc-by"]), ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]), ("licensed under cc by-sa 3.0", ["cc-by-sa"]),
    ("Released under the Apache License", []), ("Licensed under the Apache License, Version 1.0", []),
    ("# Licensed under the Apache License,\n# Version 2.0 (the License)", ["apache-2.0"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ["cc-by-nc"]),
    ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 3.0 Unported License.", ["cc-by-sa"]),
    ("This work is licensed under the GNU Lesser General Public License, version 3", ["lgpl"]),
    ("This work is licensed under the GNU General Public License, version 3", ["gpl"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy", ["mpl-2.0"]),
    ("Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided", ["bsd"]),
    ("To the extent possible under law, the author has waived all copyright\nand related or neighboring rights to this", ["cc0"]),
    ("Released under the MIT\nLicense", ["mit"]), ("the students of MIT were released under the license", []), ("the software under the license", []),
])
def test_notices(text, labels):
    found = licenses.Index(licenses.TEMPLATES, {}, licenses.THRESHOLD)
    assert sorted({found.templates[t][0] for t, _, _ in found.blocks([w.encode() for w in words("Some words before. " + text + " and more after")])}) == labels


def test_long_text(docs):
    """Half a million words of a prefix word alone take linear time."""
    (row,) = licenses.scan(docs([(1, "apache " * 500_000 + "Released under the MIT License")])).collect()
    assert row.n_words == 500_005 and [(m.word, m.label) for m in row.matches] == [(500_000, "mit")]


def test_empty_table(docs):
    assert licenses.scan(docs([])).collect() == []
