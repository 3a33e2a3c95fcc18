import pytest
from pyspark.sql import functions as F

from medloom.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), epochs=3):
    """Clamp, deal the excess by weight, repeat."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 1000}, {"a": 1, "b": 2, "c": 5000, "d": 1, "e": 3},
    {"a": 0, "b": 10}, {None: 500, "z": 20, "b": 1}, {"a": 7},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(rows).collect()}
    expected = brute_targets(sizes)
    assert found.keys() == expected.keys()
    for source, target in expected.items():
        assert found[source] == pytest.approx(target)


def test_mix_comes_near_its_targets(docs):
    rows = [(i, "w " * (5 + i % 40), ["a", "b", "c", None][i % 4]) for i in range(2000)]
    rows += [(9000, None, "a"), (9001, "", "c"), (None, "x y", "b"), (5, "w w", "a"), (5, "w w", "a")]
    df = docs(rows, clash=True)
    found = mixing.mix(df)
    assert found.count() == len(rows)
    for r in found.groupBy("source", "source_size", "target").agg(F.sum("taken").alias("taken"), F.max("copies").alias("most")).collect():
        assert abs(r.taken - r.target) <= 20 and r.most <= 3
    again = sorted(found.collect(), key=str)
    assert again == sorted(mixing.mix(df.repartition(7)).collect(), key=str)


def test_repeat_gives_the_copies(docs):
    rows = [(i, "w " * (i % 9), ["a", "b"][i % 10 == 0]) for i in range(300)]
    df = docs(rows, clash=True)
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect() if r.copies}
    out = mixing.repeat(df)
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == copies
    assert out.columns == [*df.columns, "epoch"]


def test_empty_table_and_no_words(docs):
    assert mixing.mix(docs([])).collect() == [] and mixing.repeat(docs([])).collect() == []
    assert [(r.target, r.taken) for r in mixing.mix(docs([(1, None), (2, "")])).collect()] == [(0.0, 0), (0.0, 0)]
