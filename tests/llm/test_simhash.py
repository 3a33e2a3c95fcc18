import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medloom.llm import simhash
from medloom.llm.components import connected


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """Least key of each component of (key, fingerprint)."""
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(pairs):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(pairs))]


@given(st.text(alphabet="abcXYZé \n\t", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_long_text_is_counted_whole():
    words = [f"w{random.Random(i).randrange(10**6)}" for i in range(80_000)]
    assert simhash.fingerprint(" ".join(words).encode()) == brute_fingerprint(" ".join(words))


def test_spark_hash_agrees(spark):
    assert spark.sql("SELECT xxhash64('a b c')").first()[0] % (1 << 64) == xxhash.xxh64("a b c", seed=42).intdigest()


def planted(seed, n):
    """Fingerprints in chains of few differing bits, and others."""
    rng, out = random.Random(seed), []
    while len(out) < n:
        value = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 5, 30])):
            out.append(value)
            for bit in rng.sample(range(64), rng.choice([0, 1, 2, 3, 3, 4])):
                value ^= 1 << bit
    return out[:n]


@pytest.mark.parametrize("limit", [simhash.LIST_LIMIT, 2])
def test_links_lose_nothing(spark, limit):
    values = planted(3, 400)
    distinct = sorted(set(values))
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in distinct]
    found = simhash.links(spark.createDataFrame(rows, "simhash long"), limit)
    roots = {r.node % (1 << 64): r.root for r in connected(found).collect()}
    expected = brute_components(list(zip(range(len(distinct)), distinct)))
    for i, a in enumerate(distinct):
        for j in range(i):
            same = roots.get(a, a) == roots.get(distinct[j], distinct[j])
            assert same == (expected[i] == expected[j])


def test_verification_needs_shared_bytes():
    one = np.array([0], dtype=np.int64)
    assert simhash._linked(one[0], np.array([0b111, 0b1111, 0x010101, 0x01010101], dtype=np.int64)).tolist() == [True, False, True, False]


def test_components_of_a_chain_and_a_hot_node(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)] + [(7, 7), (100, 101)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 400)}}


def test_near_duplicates_against_brute_force(docs):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(50)) for _ in range(rng.choice([2, 30, 200]))]
        rows.append((i, " ".join(words)))
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "changed"
            rows.append((1000 + i, " ".join(words)))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (None, rows[0][1]), (None, "alone here now"), rows[1], rows[1]]
    found = simhash.near_duplicates(docs(rows, clash=True)).collect()
    pairs = [(k, brute_fingerprint(t)) for k, t in rows]
    expected = sorted(((k, f, c) for (k, f), c in zip(pairs, brute_components(pairs))), key=str)
    assert sorted(((r.doc_id, r.simhash % (1 << 64), r.component) for r in found), key=str) == expected


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).collect() == []
    assert simhash.deduplicate(docs([])).collect() == []


@pytest.mark.parametrize("limit", [simhash.BROADCAST_KEYS, -1])
def test_deduplicate_keeps_one_of_each(docs, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BROADCAST_KEYS", limit)
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(3, text), (1, text), (1, text), (None, "other words stand here"), (5, "something else again it is"), (5, "and a different text under one id"),
            (7, None), (8, ""), (9, "gone with a null one"), (None, "gone with a null one"), (None, "gone with a null one")]
    df = docs(rows, clash=True)
    kept = simhash.deduplicate(df)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, text), rows[3], rows[4], rows[5], (7, None), rows[9]], key=str)
    assert kept.columns == df.columns and all(r["_key"] == "other" for r in kept.collect())
