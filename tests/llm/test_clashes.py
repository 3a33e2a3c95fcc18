"""Columns of a caller whose names operators use for themselves come through with their values."""

import pytest
from pyspark.sql import functions as F

from medloom.llm import decontaminate, quality, sanitise, simhash

NAMES = ["_key", "_k1", "_k2", "_r1", "_r2", "_general", "_removed", "_salt", "_part", "_judged", "_close", "_found_k1", "_found_candidates",
         "_base", "_lines", "_text", "_words", "row", "c", "t", "entity", "term", "k1", "w", "component", "simhash"]


@pytest.fixture
def clashing(docs):
    rows = [(i, f"some words of text {i} mail u{i}@example.org and a passage of ten common words that stand here again") for i in range(6)]
    return docs(rows + [(6, None), (7, "")]).withColumns({n: F.concat(F.lit(f"{n} of "), F.coalesce("doc_id", F.lit(-1)).cast("string")) for n in NAMES})


def bench(spark):
    return spark.createDataFrame([(1, "a passage of ten common words that stand here again")], "item_id long, text string")


@pytest.mark.parametrize("limit", [None, -1])
@pytest.mark.parametrize("name", ["decontaminate", "sanitise", "judge", "passing", "deduplicate"])
def test_all_come_through(spark, clashing, monkeypatch, name, limit):
    if limit is not None:
        for module, knobs in ((decontaminate, ("BROADCAST_CANDIDATES", "BROADCAST_KEYS")), (sanitise, ("BROADCAST_TERMS", "BROADCAST_KEYS"))):
            for knob in knobs:
                monkeypatch.setattr(module, knob, limit)
    run = {
        "decontaminate": lambda df: decontaminate.decontaminate(df, bench(spark), slop=1), "sanitise": sanitise.sanitise,
        "judge": quality.judge, "passing": quality.passing, "deduplicate": simhash.deduplicate,
    }[name]
    found = run(clashing)
    rows = found.collect()
    assert set(clashing.columns) <= set(found.columns)
    for r in rows:
        assert all(r[n] == f"{n} of {r.doc_id}" for n in NAMES)
    if name in ("decontaminate", "sanitise", "judge"):
        assert len(rows) == 8
    if name == "decontaminate":
        assert {r.doc_id for r in rows if r.contaminated} == set(range(6))
