import random
import re
from collections import Counter

import pytest

from medloom.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    w, hit, held = words(text), set(), set()
    for key, other in items:
        o = words(other)
        n = min(len(o), window)
        grams = {tuple(o[i:i + n]) for i in range(len(o) - n + 1)} if o else set()
        for p in range(len(w) - n + 1 if grams else 0):
            if tuple(w[p:p + n]) in grams:
                hit.update(range(p, p + n))
                held.add(key)
    return len(w), len(hit), sorted(str(k) for k in held if k is not None), bool(hit)


def brute_near(texts, items, slop, window=10):
    """(start, window) of every proximity match of every text."""
    split = [words(t) for t in texts]
    counts = Counter(x for w in split for x in w)
    grams = {tuple(o[i:i + window]) for o in (words(t) for _, t in items) if o for i in range(max(1, len(o) - window + 1))}
    out = [set() for _ in texts]
    for g in grams:
        missing = len(g) // 5
        leads = [(x, o) for n, x, o in sorted((counts[x], x.encode(), o) for o, x in enumerate(g))[:missing + 1] if n]
        for k, w in enumerate(split):
            for start in {p - o for x, o in leads for p, y in enumerate(w) if y.encode() == x}:
                if sum(g[i] in w[max(start + i - slop, 0):max(start + i + slop + 1, 0)] for i in range(len(g))) >= len(g) - missing:
                    out[k].add((start, g))
    return out


@pytest.fixture
def corpus(docs, spark):
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(30)] + ["the", "of", "Ünd"]
    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([3, 9, 10, 11, 25]))) for i in range(12)]
    items += [(90, None), (91, ""), (92, "?!"), (None, "null key words stand here"), (93, items[0][1]), (94, items[1][1].upper()), (1, "second text of one"), (95, "the the the the the the the the the the the the")]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            source = words(rng.choice(items)[1])
            at = rng.randrange(max(1, len(source)))
            parts += [", ".join(source[at:at + rng.choice([5, 10, 25])]).title(), text(rng.randrange(5))]
        rows.append((i, " ".join(parts)))
    rows += [(200, None), (201, ""), (202, "The " * 40), (203, text(3) + "\n" + items[4][1].replace(" ", "-\n")), rows[7], rows[7], (None, rows[9][1]),
             (204, "Null KEY words, stand here."), (205, text(20_000))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    return rows, items, docs(rows, clash=True).drop("items", "n_words"), bench


def check(rows, items, found):
    got = sorted(((r.doc_id, r.n_words, r.n_hit, sorted(str(i) for i in r["items"] if i is not None), r.contaminated) for r in found.collect()), key=str)
    assert got == sorted(((k, *brute(t, items)) for k, t in rows), key=str)


def test_against_brute_force(corpus):
    rows, items, df, bench = corpus
    check(rows, items, decontaminate.decontaminate(df, bench))


@pytest.mark.parametrize("keys", [-1, 1000])
def test_shuffled_joins(corpus, monkeypatch, spark, keys):
    rows, items, df, bench = corpus
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(decontaminate, "BROADCAST_CANDIDATES", -1)
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", keys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    check(rows, items, decontaminate.decontaminate(df, bench))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("lists", [1, 10])
def test_number_of_lists_does_not_matter(corpus, lists):
    rows, items, df, bench = corpus
    check(rows, items, decontaminate.decontaminate(df, bench, lists=lists))


def test_proximity(docs, spark):
    item = " ".join(f"k{i}" for i in range(10))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    # Rarest by text: all terms stand equally often, so the first three in order of term are looked up: k0 k1 k2.
    rows = [(1, item), (2, "k0 x k1 k2 k3 k4 k5 k6 k7 k8 k9"), (3, "k0 x x x x x x k1 k2"), (4, "k2 k1"), (5, None)]
    found = decontaminate.decontaminate(docs(rows), bench, slop=2)
    assert {r.doc_id: (r.n_near, r.contaminated) for r in found.collect()} == {
        1: (1, True), 2: (1, False), 3: (0, False), 4: (0, False), 5: (0, False)}


def test_proximity_looks_at_all_terms_and_every_place(docs, spark):
    item = " ".join(f"k{i}" for i in range(10))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    # The text begins within the passage; a word is changed, k4 stands nowhere; seven and three terms are missing; a word is put in.
    rows = [(1, "k1 k2 k3 k5 k5 k6 k7 k8 k9"), (2, "x x k0 k1 k2 k3 other k5 k6 k7 k8 k9"), (3, "k0 k1 k2 x x x x x x x"),
            (4, "k0 k1 k2 k3 y k5 k6 y y y"), (5, "k0 k1 k2 k3 x y k5 k6 k7 k8 k9"), (6, ""), (7, None)]
    found = {r.doc_id: r for r in decontaminate.decontaminate(docs(rows), bench, slop=1).collect()}
    assert {k: r.n_near for k, r in found.items()} == {1: 1, 2: 1, 3: 0, 4: 0, 5: 1, 6: 0, 7: 0}
    assert [(p.start, p["items"]) for p in found[1].near] == [(-1, [1])]
    assert [(p.start, p["items"]) for p in found[2].near] == [(2, [1])]
    assert not any(r.contaminated for r in found.values())


@pytest.mark.parametrize("slop, rows_limit", [(0, None), (1, None), (2, -1)])
def test_proximity_against_brute_force(corpus, monkeypatch, slop, rows_limit):
    rows, items, df, bench = corpus
    if rows_limit is not None:
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows_limit)
        monkeypatch.setattr(decontaminate, "BROADCAST_CANDIDATES", rows_limit)
    found = decontaminate.decontaminate(df, bench, slop=slop).collect()
    got = sorted(((r.doc_id, r.n_near, sorted(p.start for p in r.near)) for r in found), key=str)
    want = brute_near([t for _, t in rows], items, slop)
    assert got == sorted(((k, len({g for _, g in m}), sorted(s for s, _ in m)) for (k, _), m in zip(rows, want)), key=str)
    check(rows, items, decontaminate.decontaminate(df, bench, slop=slop))
    if slop:
        assert any(r.n_near and not r.contaminated for r in found)


def test_long_text_of_one_window(docs, spark):
    """One window 40,000 times in a text: lists are met as a whole, not place by place."""
    item = " ".join(f"k{i}" for i in range(10))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    (row,) = decontaminate.decontaminate(docs([(1, f"{item} " * 40_000)]), bench).collect()
    assert row.n_words == row.n_hit == 400_000 and row["items"] == [1]


def test_empty_tables(docs, spark, corpus):
    rows, items, df, bench = corpus
    assert decontaminate.decontaminate(docs([]), bench).collect() == []
    none = decontaminate.decontaminate(df, bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated or r["items"] for r in none)


def test_plan_stays_native(corpus):
    _, _, df, bench = corpus
    plan = decontaminate.decontaminate(df, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_words_are_lowered_one_by_one(docs, spark):
    """A-Z alone, beside letters whose lower case is ASCII, longer or another letter."""
    from pyspark.sql import functions as F
    from medloom.llm import text

    rows = ["".join(map(chr, range(128))) + " ABC", "\u212aELVIN Kelvin \u0130stanbul \u00c4PFEL \u00e4PFEL \u03a3\u0391\u03a3 x\u0301Y \U0001F600Z", "  A--b  C ", "", "?!"]
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    cased = F.transform(text.cased_words(F.col("text")), text.lowered_word)
    for r, t in zip(df.select(cased.alias("w"), text.alnum_words(F.col("text")).alias("a")).collect(), rows):
        assert r.w == r.a == words(t)
    # The index lowers words, not texts.
    plan = decontaminate.term_counts(df, spark.createDataFrame([("abc",)], "term string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "split(translate(" not in plan and "split(coalesce(text" in plan
