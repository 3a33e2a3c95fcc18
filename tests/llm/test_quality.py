import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from medloom.llm import quality


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars = len(w), sum(map(len, w))
    symbols = sum(c in "#*$%&|<>" for c in t)
    dup = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(covered) > 50 * n
    every = t.split("\n")
    kept = not failed and all([
        10 * symbols <= n, 2 * n <= chars <= 15 * n, 10 * dup <= 3 * len(lines), 5 * t.count("!") <= n,
        2 * sum("A" <= c <= "Z" for c in t) <= chars, 10 * sum(any(c.isalpha() for c in x) for x in w) >= 8 * n,
        10 * sum(x.endswith(("...", "…")) for x in every) <= 3 * len(lines),
        10 * sum(x.startswith(("•", "- ", "* ")) for x in every) <= 9 * len(lines)])
    return n, chars, symbols, dup, len(covered), failed, kept


def good(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


ROWS = [
    (1, None), (2, ""), (3, " \n\t"), (4, good(60)), (5, good(49)), (6, good(50)), (7, "la " * 100), (8, good(60) + " ***" * 9),
    (9, good(80).replace(" ", " | ")), (10, (good(10) + "\n") * 8), (11, "\n".join(good(5, i) for i in range(20)) + "\n" + good(5, 1) + "\n" + good(5, 2)),
    (12, good(70).upper()), (13, good(60) + " 12" * 30), (14, good(60, 1) + " " + good(20, 2) + " " + good(20, 2)),
    (15, "\n".join(good(6, i) + "..." for i in range(12))), (16, "\n".join("- " + good(6, i) for i in range(12))),
    (17, good(60) + " !!" * 20), (18, "a b c " * 30 + good(100)), (19, " ".join("x" * 30 + str(i) for i in range(60))),
    (None, good(60)), (4, good(60)), (4, good(60)), (20, good(30_000)), (21, "ünï " * 2 + " " + good(60, 9).replace("a", "ß")),
    (22, "tick\x0btock\x0c" + good(55)), (23, good(60) + "\n\n" + good(3) + "\n" + good(3)),
]


def test_against_brute_force(docs):
    found = quality.judge(docs(ROWS, clash=True))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = sorted(((r.doc_id, *(r[n] for n in names)) for r in found.select("doc_id", *names).collect()), key=str)
    assert got == sorted(((k, *brute(t)) for k, t in ROWS), key=str)
    assert {r.kept for r in found.collect()} == {True, False}


def test_order_does_not_change_the_verdict(docs):
    df = quality.measured(docs(ROWS))
    names = list(quality.RULES)
    one = df.withColumn("v", quality.cascade(names)).select("doc_id", "v").collect()
    two = df.withColumn("v", quality.cascade(names[::-1])).select("doc_id", "v").collect()
    assert sorted(one, key=str) == sorted(two, key=str)


def test_best_rule_first(docs, monkeypatch):
    """Rejections per second decide, each on what the rules before it leave."""
    seconds = iter([0.1, 0.1, 0.2, 1.1, 0.2])
    monkeypatch.setattr(quality, "_seconds", lambda sample, rule: next(seconds))
    monkeypatch.setattr(quality, "RULES", {
        "cheap": lambda: F.col("doc_id") > 3, "dear": lambda: F.col("doc_id") > 9, "same_as_cheap": lambda: F.col("doc_id") > 2})
    order = quality.estimate(docs([(i, "") for i in range(12)]))
    assert [n for n, _, _ in order] == ["cheap", "dear", "same_as_cheap"]
    assert [round(s, 3) for _, _, s in order] == [round(4 / 12, 3), round(6 / 8, 3), 0.0]


def test_empty_table(docs):
    assert quality.judge(docs([])).collect() == []


def test_plan_stays_native(docs):
    plan = quality.judge(docs(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_passing_is_what_judge_keeps(docs):
    df = docs(ROWS, clash=True)
    from tests.llm.conftest import CLASHES

    names = ["c", "t", "n_lines", "_text", "lines"]
    df = df.withColumns({c: F.lit("mine") for c in names})
    got = quality.passing(df)
    assert got.columns == df.columns
    rows = got.collect()
    expected = sorted((str(k), t) for k, t in ROWS if brute(t)[-1])
    assert sorted((str(r.doc_id), r.text) for r in rows) == expected
    assert all(r[c] == "mine" for r in rows for c in names) and all(r[c] == "other" for r in rows for c in CLASHES if c not in names)
    assert quality.passing(docs([])).collect() == []


def test_dear_expressions_stand_once(docs):
    plan = quality.passing(docs(ROWS))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(") == 1 and "Python" not in plan


def test_rules_that_reject_nothing_go_by_cost(docs, monkeypatch):
    seconds = iter([0.0, 0.0, 0.9, 0.1, 0.5])
    monkeypatch.setattr(quality, "_seconds", lambda sample, rule: next(seconds))
    rules = {n: lambda: F.col("doc_id") >= 0 for n in ("dear", "cheap", "fair")}
    assert [n for n, _, _ in quality.estimate(docs([(1, ""), (2, "")]), rules)] == ["cheap", "fair", "dear"]
