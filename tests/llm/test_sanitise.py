import math
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from medloom.llm import sanitise

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], sanitise.KINDS.index(s[0])))


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_disclosures(texts):
    """{(entity, term): share} of all pairs, over the distinct texts."""
    distinct, c_t, c_e, c_te = {t or "" for t in texts}, Counter(), Counter(), Counter()
    for t in distinct:
        c_t.update(set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))))
        entities, terms = entities_of(t), {term for term, _, _ in terms_of(t)}
        c_e.update(entities)
        c_te.update((e, x) for e in entities for x in terms)
    out = {}
    for (e, x), n in c_te.items():
        known = math.log(len(distinct) / c_e[e])
        pmi = math.log(len(distinct) * n / (max(c_t[x], n) * c_e[e]))
        out[e, x] = pmi / known * n / (n + 0.25) if known else 0.0
    return out


def entities_of(text):
    return {f"{k}:" + (lower(text[a:b]) if k in ("email", "ip") else re.sub("[^0-9]", "", text[a:b])) for k, a, b in brute(text)}


def terms_of(text):
    """(term, start, end) of what stands outside of all spans; a span cuts a word."""
    covered = {i for _, a, b in brute(text) for i in range(a, b)}
    open_text = "".join("\0" if i in covered else c for i, c in enumerate(lower(text)))
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", open_text)]


def brute_all(texts):
    """All spans of each text, those of disclosing terms included."""
    shares, out = brute_disclosures(texts), []
    for t in texts:
        t = t or ""
        found, entities = brute(t), entities_of(t)
        for term, a, b in terms_of(t) if entities else []:
            share = max(shares[e, term] for e in entities)
            if share >= 0.8 - 1e-9:
                found.append(("removed" if share >= 0.95 - 1e-9 else "general", a, b))
        out.append(sorted(found, key=lambda s: (s[1], (*sanitise.KINDS, "general", "removed").index(s[0]))))
    return out


@pytest.mark.parametrize("text", [
    None, "", "a@b.c", "a@b", "x a.b%c@d-e.f.g. y", "a@b.c_d@e.f", "a@b@c.d", "@a.b", "a@b.c@d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.3.0255",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "+1 (555) 123-4567", "+1 22", "+12345678901234567 1", "++1 234 567 890", "é😀 a@b.co 1.1.1.1",
    "0000000000000000", "a@b.c 1.2.3.4 4111111111111111 +12345678901", "x" * 5000 + "@", "1" * 5000, "+1" + "(" * 5000, "a." * 3000 + "@x", "a@" * 2000 + "b.c",
])
def test_base_spans(text):
    assert sanitise.base_spans(text) == brute(text)


@given(st.text(alphabet="a1.@+-( 24", max_size=40))
@settings(max_examples=1500, deadline=None)
def test_base_spans_on_any_text(text):
    assert sanitise.base_spans(text) == brute(text)


def test_very_long_texts_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "a@" * 500_000, "+1 " * 500_000, "1." * 500_000):
        sanitise.base_spans(text)


def corpus():
    """zorvian stands near one address alone, and common everywhere; some terms stand in one text only."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["common", "word", "stands", f"v{rng.randrange(40)}"]) for _ in range(40))) for i in range(300)]
    for i in range(6):
        rows.append((1000 + i, f"{rows[i][1]} common zorvian writes from ann@example.org word {i} stands Zorvian. {rows[i][1]}"))
    rows.append((2000, "only once quixote bob@example.org here"))
    rows += [(3000 + i, "copies bear vexing carl@example.org evidence") for i in range(50)]
    return rows + [(4000, None), (4001, ""), (None, rows[301][1]), (1001, rows[301][1])]


def test_terms_that_disclose(docs):
    rows = corpus()
    found = {r.doc_id: r for r in sanitise.sanitise(docs(rows, clash=True)).collect()}
    assert len(sanitise.sanitise(docs(rows)).collect()) == len(rows)
    text = dict(rows)
    for i in range(6):
        spans = found[1000 + i].spans
        terms = {text[1000 + i][s.start:s.end].lower() for s in spans if s.kind not in sanitise.KINDS}
        assert "zorvian" in terms and not terms & {"common", "word", "stands"}
        assert [tuple(s) for s in spans if s.kind in sanitise.KINDS] == brute(text[1000 + i])
    # Copies of a text count once; a term that no other text has gives the address away, and is not removed.
    for key, terms in ((2000, {"only", "once", "quixote", "here"}), (3000, {"copies", "bear", "vexing", "evidence"}), (3049, {"copies", "bear", "vexing", "evidence"})):
        assert {text[key][s.start:s.end] for s in found[key].spans if s.kind == "general"} == terms
    assert [[tuple(s) for s in found[k].spans] for k, _ in rows] == brute_all([t for _, t in rows])
    assert all(not found[k].spans for k, t in rows if k is not None and not brute(t))
    assert [tuple(s) for s in found[None].spans] == [tuple(s) for s in found[1001].spans]


def test_disclosure_is_pmi_by_information(docs):
    texts = [t for _, t in corpus()]
    df = docs(corpus())
    found = {(r.entity, r.term): r.share for r in sanitise.disclosures(df, sanitise.co_occurrences(df)).collect()}
    want = {k: v for k, v in brute_disclosures(texts).items() if v >= sanitise.DISCLOSURE - 1e-9}
    assert found.keys() == want.keys() and found == pytest.approx(want)


@pytest.mark.parametrize("n", [12, 150, 1500])
def test_the_size_of_the_corpus_does_not_decide(docs, n):
    rows = [(i, f"common words stand v{i % 5} here") for i in range(n)]
    rows += [(9000, "common words quixote bob@example.org here"), (9001, "common ann@example.org seldom"), (9002, "ann@example.org seldom words")]
    found = {r.doc_id: r for r in sanitise.sanitise(docs(rows)).collect()}
    assert [[tuple(s) for s in found[k].spans] for k, _ in rows] == brute_all([t for _, t in rows])
    for key, term in ((9000, "quixote"), (9001, "seldom"), (9002, "seldom")):
        r = found[key]
        assert [(s.kind, r.text[s.start:s.end]) for s in r.spans if s.kind != "email"] == [("general", term)]


@pytest.mark.parametrize("limit", [200_000, -1])
def test_all_spans_against_brute_force(docs, monkeypatch, limit):
    monkeypatch.setattr(sanitise, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(sanitise, "BROADCAST_KEYS", limit)
    monkeypatch.setattr(sanitise, "BROADCAST_TERMS", limit)
    rng = random.Random(9)
    parts = [f"w{i}" for i in range(60)] + ["ann@example.org", "Bob@Example.org", "10.0.0.1", "(4111 1111 1111 1111)", "+1 (555) 123-4567", "xann@example.org9", "Ünd"]
    rows = [(i, " ".join(rng.choice(parts[:20] if i % 2 else parts) for _ in range(rng.randrange(12)))) for i in range(120)]
    rows += [(i, rows[i % 120][1]) for i in range(120, 150)] + [(None, rows[3][1]), (500, None), (501, "")]
    found = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in sanitise.sanitise(docs(rows)).collect()), key=str)
    assert found == sorted(((k, s) for (k, _), s in zip(rows, brute_all([t for _, t in rows]))), key=str)
    assert {k for _, spans in found for k, _, _ in spans} >= {"general", "email", "ip", "card", "phone"}


def test_one_text_among_many_discloses(docs):
    # Among 1,500 texts a term that only one text has gives its address away, copies or not; common words do not.
    rows = [(i, f"common words stand v{i % 50} here") for i in range(50)] + [(i, f"common words stand {i} here") for i in range(50, 1500)]
    rows += [(2000, "common words quixote bob@example.org here"), *[(3000 + i, "common vexing carl@example.org words") for i in range(20)]]
    for key, term in ((2000, "quixote"), (3000, "vexing"), (3019, "vexing")):
        text = dict(rows)[key]
        found = {r.doc_id: r.spans for r in sanitise.sanitise(docs(rows)).collect()}[key]
        assert [(s.kind, text[s.start:s.end]) for s in found if s.kind != "email"] == [("general", term)]


@pytest.mark.parametrize("limit", [1_000_000, -1])
def test_terms_far_from_the_entity(docs, monkeypatch, limit):
    # The name stands far more than eight words before the address, and again after it.
    monkeypatch.setattr(sanitise, "BROADCAST_TERMS", limit)
    rng = random.Random(2)
    def filler():
        return " ".join(f"v{rng.randrange(30)}" for _ in range(30))
    rows = [(i, filler()) for i in range(200)] + [(1000 + i, f"Zorvian {filler()} ann@example.org {filler()} zorvian") for i in range(6)]
    rows += [(2000, None), rows[201]]
    found = sanitise.sanitise(docs(rows)).collect()
    assert sorted(r.doc_id for r in found) == sorted([k for k, _ in rows[:-2]] + [2000, rows[-1][0]], key=lambda k: k)
    for r in found:
        names = [r.text[s.start:s.end] for s in r.spans if s.kind == "removed"]
        assert names == (["Zorvian", "zorvian"] if 1000 <= r.doc_id < 2000 else [])


def test_masked_text(docs):
    out = sanitise.sanitise(docs(corpus()))
    rows = {r.doc_id: r.clean for r in out.select("doc_id", sanitise.masked("text", "spans").alias("clean")).collect()}
    assert "ann@example.org" not in rows[1002] and "[EMAIL]" in rows[1002] and "zorvian" not in rows[1002].lower()
    assert rows[2000] == "[TERM] [TERM] [TERM] [EMAIL] [TERM]" and rows[5] == dict(corpus())[5] and rows[4001] == ""


def test_empty_table(docs):
    assert sanitise.sanitise(docs([])).collect() == []
