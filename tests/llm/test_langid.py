import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from medloom.llm import langid
from tests.conftest import SMALL

TEXTS = ["", " ", "a", "Hello, World 12 x2y", "ÜNÏ straße İx", "12 ² ½ _ --", "東京 に 行く", "a\x00b퟿c 😀 z", "don't", "x" * 50]


def bucket(gram):
    h = 2166136261
    for c in gram:
        h = ((h ^ ord(c)) * 16777619) % 2**32
    return (h * 2654435769 % 2**32) >> 16


def brute(text):
    """Subwords of each word, an end of which is marked by a space."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    found = Counter()
    for w in words:
        marked = f" {w} "
        for n in range(1, 5):
            found.update(bucket(marked[i:i + n]) for i in range(len(marked) - n + 1) if marked[i:i + n].strip())
    # The mark between two words belongs to both, but stands once; single marks are no subwords.
    return found


@pytest.mark.parametrize("block", [1, 2, 5, 1 << 18])
def test_subwords(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    rng = random.Random(3)
    for text in TEXTS + ["".join(rng.choice("abé1 .東Z") for _ in range(rng.randrange(30))) for _ in range(60)]:
        used, counts = langid.subwords(text)
        assert dict(zip(used.tolist(), counts.tolist())) == brute(text), repr(text)


def predicted(model, text):
    """The prediction in plain arithmetic."""
    found = brute(text or "")
    if not found or not model.labels:
        return "und", 0.0
    total = sum(found.values())
    hidden = [sum(n * model.embeddings[b][d] for b, n in found.items()) / total for d in range(langid.WIDTH)]
    logits = [sum(h * model.weights[d][k] for d, h in enumerate(hidden)) + model.bias[k] for k in range(len(model.labels))]
    powers = [math.exp((x - max(logits)) / model.temperature) for x in logits]
    best = max(range(len(powers)), key=lambda k: powers[k])
    return model.labels[best], powers[best] / sum(powers)


def made(n, seed=1):
    rng = random.Random(seed)
    parts = {"xx": ["ka", "ro", "mi"], "yy": ["ze", "lu", "th"], "zz": ["ßa", "öd", "éx"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(12)), lang))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit("other") for c in ("key", "order", "label", "rank", "count", "held_out", "score", "used")})


def test_table(spark):
    rows = made(120) + [(None, "karo", "xx"), (200, None, "xx"), (201, "12 - ²", "yy"), (202, "", None), (203, "zelu", None),
                        (204, "roka " * 60_000, "xx"), (300, "zelu", "yy"), (300, "zelu", "yy"), (205, "karo ze", "only held out")]
    rows = [r for r in rows if r[2] != "only held out" or zlib.crc32(b"205") % 3 == 1]
    df = frame(spark, rows)
    model = langid.fit(df)
    assert model.labels == ["xx", "yy", "zz"]
    found = langid.identify(df, model).collect()
    assert len(found) == len(rows)
    assert Counter((r.doc_id, r.held_out) for r in found) == Counter(
        (k, k is not None and zlib.crc32(str(k).encode()) % 3 == 1) for k, _, _ in rows)
    texts = {k: t for k, t, _ in rows}
    for r in found:
        name, score = predicted(model, texts[r.doc_id])
        assert r.lang_pred == name and abs(r.score - score) < 1e-6 and 0 <= r.score <= 1
        assert r.rejected == (name == "und" or r.score < model.threshold)
    truth = {k: lang for k, t, lang in rows if t and lang}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 20 and all(r.lang_pred == truth[r.doc_id] for r in held)


def test_learns_from_nothing_held_out(spark):
    """Held-out rows, their languages and texts, do not change the model."""
    rows = made(90)
    other = [r if zlib.crc32(str(r[0]).encode()) % 3 != 1 else (r[0], "otherwise", "qq") for r in rows]
    one, two = langid.fit(frame(spark, rows)), langid.fit(frame(spark, other).repartition(5))
    assert one.labels == two.labels and np.array_equal(one.embeddings, two.embeddings)
    assert (one.temperature, one.threshold) == (two.temperature, two.threshold)


def test_sample_is_bounded(spark):
    rows = [(i, f"t{i}", "aa" if i % 10 else "bb") for i in range(3_000)]
    sizes = Counter(r.label for r in langid.sample(frame(spark, rows), "doc_id", "text", "lang", rows=60).collect())
    assert sizes == {"aa": 30, "bb": 30}


def test_empty_tables(spark):
    empty = langid.fit(frame(spark, []))
    assert empty.labels == [] and langid.identify(frame(spark, []), empty).collect() == []
    assert [(r.lang_pred, r.score, r.rejected) for r in langid.identify(frame(spark, made(1)), empty).collect()] == [("und", 0.0, True)]
    alone = langid.fit(frame(spark, [(0, "karo", "xx"), (4, "miro", "xx")]))
    assert alone.predict("anything")[0] == "xx"


def test_rejection_keeps_errors_few():
    rng = np.random.default_rng(2)
    model = langid.Model(["a", "b"], np.array([[4.0] + [0] * 15, [-4.0] + [0] * 15]), np.array([[1.0, -1]] + [[0, 0]] * 15), np.zeros(2))
    rows = []
    for _ in range(400):
        n = int(rng.integers(0, 101))
        # Mixed rows are of either label by chance.
        rows.append((np.array([0, 1]), np.array([n + 1e-9, 100 - n + 1e-9]), int(rng.random() > 0.5 if 30 < n < 70 else n <= 30)))
    langid.calibrate(model, rows)
    got = [(model.logits(u, c), label) for u, c, label in rows]
    scores = [(langid._softmax(x / model.temperature).max(), int(np.argmax(x)) != label) for x, label in got]
    kept = [wrong for score, wrong in scores if score >= model.threshold]
    assert 20 < len(kept) < 300 and np.mean(kept) <= langid.ACCEPTED_ERRORS
    assert abs(np.mean([s for s, _ in scores]) - (1 - np.mean([w for _, w in scores]))) < 0.1


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = langid.identify(docs, langid.fit(docs)).filter("held_out").join(docs, "doc_id").filter("lang IS NOT NULL")
    right, n, kept, kept_right = found.selectExpr(
        "avg(CAST(lang = lang_pred AS INT))", "count(*)", "sum(CAST(NOT rejected AS INT))",
        "avg(CASE WHEN NOT rejected THEN CAST(lang = lang_pred AS INT) END)").first()
    assert n > 30 and right >= 0.95 and kept > 0.6 * n and kept_right >= right
