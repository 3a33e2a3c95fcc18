import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medloom.llm import repeats
from medloom.llm.shared import stage


def brute(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    starts = {}
    for d, w in enumerate(words):
        for p in range(len(w) - window + 1):
            starts.setdefault(tuple(w[p:p + window]), []).append((d, p))
    gone = [set() for _ in words]
    for places in starts.values():
        if len(places) > 1:
            for d, p in places:
                gone[d].update(range(p, p + window))
    return [(len(w), len(g), " ".join(x for i, x in enumerate(w) if i not in g)) for w, g in zip(words, gone)]


def check(df, rows, window):
    found = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in repeats.remove_repeats(df, window=window).collect()), key=str)
    expected = sorted(((k, *b) for (k, _), b in zip(rows, brute([t for _, t in rows], window))), key=str)
    assert found == expected


def test_planted_passages(docs):
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([0, 10, 34, 35, 36, 300]))]
        if i % 4 == 0:
            length = rng.choice([34, 35, 36, 50, 60])
            begin = rng.randrange(61 - length)
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[begin:begin + length]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(100, None), (101, ""), (None, rows[4][1]), rows[8], rows[8], (102, "la " * 80), (103, "a b " * 40), (104, "é x\u0085y " * 40)]
    check(docs(rows, clash=True), rows, 35)


@pytest.mark.parametrize("window", [1, 2, 5])
def test_short_windows_over_few_words(docs, window):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(12)))) for i in range(30)]
    check(docs(rows), rows, window)


def test_spans_are_maximal(docs):
    text = " ".join(f"w{i}" for i in range(50))
    found = repeats.remove_repeats(docs([(1, "x " + text + " y"), (2, text)])).collect()
    assert {r.doc_id: r.repeats for r in found} == {1: [[1, 51]], 2: [[0, 50]]}


def test_empty_table(docs):
    assert repeats.remove_repeats(docs([])).collect() == []


def test_many_row_groups(docs, monkeypatch):
    monkeypatch.setattr(repeats, "stage", lambda df, name, size: stage(df, name, 1 << 10, 7))
    rng = random.Random(2)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(i, " ".join(f"w{rng.randrange(9000)}" for _ in range(60)) + (" " + shared if i % 5 == 0 else "")) for i in range(80)]
    check(docs(rows), rows, 35)


@given(st.lists(st.text(alphabet="ab ", max_size=30), min_size=1, max_size=6))
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_texts(docs, texts):
    rows = list(enumerate(texts))
    check(docs(rows), rows, 3)
