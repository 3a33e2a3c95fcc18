"""Every query against its SQL, and the pipeline against a brute-force version on a small fixture."""

import os
import random

import pytest

import corpus_pipeline
from casebook.compare import compare, oracle
from medloom.llm import catalog
from tests.conftest import SMALL
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_mixing import brute_targets
from tests.llm.test_quality import brute as brute_quality, good
from tests.llm.test_sanitise import brute_all as brute_spans
from tests.llm.test_simhash import brute_components, brute_fingerprint

given_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")


@given_tables
@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_query(spark, name):
    assert compare(spark, oracle(SMALL), name, SMALL) is None


@given_tables
def test_every_operator_has_a_query():
    names = list(catalog.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]


@given_tables
def test_queries_without_sql_cover_all_rows(spark):
    for name, table in (("op5_html_extraction", "pages"), ("op7_token_counts", "documents"), ("op9_simhash", "documents"), ("op10_pii", "documents")):
        assert catalog.queries()[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_pipeline(spark, tmp_path):
    rng = random.Random(12)
    items = [(1, good(12, 500)), (2, good(4, 501))]
    rows = []
    for i in range(60):
        text = good(80, i)
        if i % 7 == 0:
            text += " " + items[i % 2][1]
        if i % 5 == 0:
            text += f" mail user{i}@example.org now"
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
    for i in range(60, 90):
        words = rows[i % 9][1].split()
        if i % 2:
            words[3] = "other"
        rows.append((i, " ".join(words), "en", "s1", 7))
    rows += [(200, None, None, None, None), (201, "", "en", "s1", 0), (202, "la " * 90, "de", None, 3), (203, good(70, 900), None, None, None)]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = [r for r in sorted(rows) if brute_quality(r[1])[-1]]
    component = brute_components([(r[0], brute_fingerprint(r[1])) for r in kept])
    kept = [r for r, c in zip(kept, component) if r[0] == c]
    kept = [r for r in kept if not brute_hits(r[1], items)[-1]]
    clean = {}
    all_spans, masked_terms = brute_spans([r[1] for r in kept]), 0
    for (key, text, lang, source, n), spans in zip(kept, all_spans):
        for kind, a, b in reversed(spans):
            word = text[a:b]
            general = "[NUMBER]" if word[0].isdigit() else "[NAME]" if word[0].isupper() else "[TERM]"
            text = text[:a] + {"general": general, "removed": ""}.get(kind, f"[{kind.upper()}]") + text[b:]
            n, masked_terms = len(text), masked_terms + (kind in ("general", "removed"))
        clean[key] = (text, lang, source, n)
    assert masked_terms
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    copies = {}
    for r in found:
        assert (r.text, r.lang, r.source, r.n_chars) == clean[r.doc_id]
        copies.setdefault(r.doc_id, []).append(r.epoch)
    assert all(sorted(e) == list(range(1, len(e) + 1)) for e in copies.values())
    sizes = {}
    for text, _, source, _ in clean.values():
        sizes[source] = sizes.get(source, 0) + len(text.split())
    for source, target in brute_targets(sizes).items():
        taken = sum(len(e) * len(clean[k][0].split()) for k, e in copies.items() if clean[k][2] == source)
        assert abs(taken - target) <= max(len(v[0].split()) for v in clean.values())


def test_stages_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
