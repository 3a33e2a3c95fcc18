import gzip
import hashlib
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from medloom.llm import warc
from medloom.sources.storage import scratch_path


@pytest.fixture
def pages(spark):
    def make(rows):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        return df.withColumns({c: F.lit("other") for c in ("record", "digest", "run", "keeper", "n", "entries")})
    return make


BIG, OTHER = "x" * 1200, "é" * 500
ROWS = [
    (1, "http://www.a.com/x?b=2&a=1", BIG), (5, "https://A.com/x?a=1&b=2", BIG), (3, None, BIG), (4, "http://b.org/", None), (6, "http://b.org", ""),
    (7, "not a url", "short"), (8, "http://c.net:8080/p/#f", "short"), (9, "http://c.net/p", OTHER), (0, "http://c.net/p", OTHER), (None, "http://d.de", BIG),
    (10, "http://e.fr/", "body\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "y" * 1000), (11, "http://e.fr/", "\x00 😀" * 400),
    (12, "http://[bad", "z" * 999), (13, "http://f.io/", "z" * 999), (14, "http://g.io/", "long " * 300_000), (15, "http://h\r\nInjected: 1", "q"),
]


def brute(rows):
    groups = {}
    for key, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000:
            groups.setdefault(body, []).append(key)
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        group = groups.get(body, [key])
        keeper = max((k for k in group if k is not None), default=None)
        revisit = len(group) > 1 and key != keeper
        out.append((key, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


def read(found):
    return sorted(((r.page_id, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in found.collect()), key=str)


def test_round_trip(pages):
    found = warc.archive_and_index(pages(ROWS))
    assert read(found) == brute(ROWS)
    assert {r.page_id: r.url_key for r in found.collect()}[1] == {r.page_id: r.url_key for r in found.collect()}[5] == "com,a)/x?a=1&b=2"


def test_histories_are_in_global_order(pages, monkeypatch, spark):
    rng = random.Random(2)
    rows = [(i, f"http://{rng.choice('abc')}.com/{rng.randrange(4)}", f"body {i}") for i in range(600)]
    folder = scratch_path(spark, "warc")
    archives = warc.write_archives(pages(rows).repartition(5), folder, archive_bytes=4000)
    assert archives.count() > 20
    runs = warc.index_runs(archives, run_entries=40, block_entries=7)
    found = warc.merge_runs(runs, range_entries=50).orderBy("range", "place").collect()
    keys = [(r.url_key, r.captured, r.record) for r in found]
    assert keys == sorted(keys) and len(keys) == 600 and {int(k[2]) for k in keys} == set(range(600))
    assert len({r.range for r in found}) > 5


def test_archives_are_plain_warc(pages, spark):
    """Every archive is a row of gzip members, read here without the operator."""
    folder = scratch_path(spark, "warc")
    total = 0
    for row in warc.write_archives(pages(ROWS), folder).collect():
        store, path = warc.open_store(row.archive)
        with store.open_input_stream(path, compression=None) as stream:
            data = stream.read()
        assert len(data) == row.bytes
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")
        records = list(warc.read_records(io.BytesIO(data)))
        assert len(records) == row.records
        for offset, headers, block in records:
            assert data[offset:offset + 2] == b"\x1f\x8b" and len(block) == int(headers["content-length"]) and "injected" not in headers
        total += row.records
    assert total == len(ROWS)


def test_damaged_payload_is_seen():
    row = {"html": "abc", "refers_to": None, "payload_bytes": 3, "record": 1, "captured": "x", "url": "u", "digest": "0" * 40}
    (_, headers, block), = warc.read_records(io.BytesIO(gzip.compress(warc._record(row))))
    with pytest.raises(ValueError):
        warc._entry("r", "a", 0, headers, block)


@given(st.lists(st.lists(st.integers(0, 50)), max_size=20))
@settings(max_examples=300, deadline=None)
def test_loser_tree(lists):
    tree, out = warc.LoserTree(), []
    for values in lists:
        tree.add(iter([(v,) for v in sorted(values)]))
    while tree.peek() is not None:
        out.append(tree.pop()[0])
    assert out == sorted(v for values in lists for v in values)


def test_empty_table_and_repeated_rows(pages):
    assert warc.archive_and_index(pages([])).collect() == []
    rows = [(1, "http://a.com", BIG), (1, "http://a.com", BIG), (0, "http://a.com", BIG)]
    assert read(warc.archive_and_index(pages(rows))) == brute(rows)
