import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from medloom.llm import infill


def brute(key, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    a, b, _, kind = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    low, high = sorted((a % (n + 1), b % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if kind % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(5)
    made = ["", "\n", "a", "a\n", "\n\n\n", "a\nb", "x<S\n>y", "<\n<P\n<S", "has <M> in it\nb", "é\n東京\n😀", "\r\n\v\f \n", "<P>",
            "line\n" * 60_000, "one line " * 90_000, "a\nb\x00\nc"]
    return made + ["".join(rng.choice("ab\n<>PSMé😀") for _ in range(rng.randrange(40))) for _ in range(300)]


def test_table_and_way_back(docs):
    rows = list(enumerate(texts())) + [(None, "a\nb\nc\nd"), (None, None), (1, "z"), (1, "z")]
    found = infill.transform(docs(rows, clash=True)).withColumn("back", infill.restored())
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in found.collect()), key=repr)
    assert got == sorted(((k, *brute(k, t), t or "") for k, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_rate_and_seed(docs):
    rows = [(i, "a\nb\nc\n") for i in range(400)]
    forms = [r.form for r in infill.transform(docs(rows), rate=50, spm_rate=0, seed=9).collect()]
    assert 120 < forms.count("plain") < 280 and forms.count("psm") == 400 - forms.count("plain")


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 8, 9, 10, 25])
def test_rotation_in_small_blocks(monkeypatch, size):
    monkeypatch.setattr(infill, "BLOCK", 4)
    for cut in range(size + 1):
        given = bytes(range(size + 2))
        buffer = bytearray(given)
        infill.rotate(buffer, 1, 1 + cut, 1 + size)
        assert buffer == given[:1] + given[1 + cut:1 + size] + given[1:1 + cut] + given[1 + size:]
        infill.rotate(buffer, 1, 1 + size - cut, 1 + size)
        assert buffer == given


def test_nothing(docs, spark):
    assert infill.transform(docs([])).collect() == []
    df = spark.range(1).select(F.lit(None).cast("string").alias("output"), F.lit("psm").alias("form"))
    assert df.select(infill.restored()).collect()[0][0] is None
