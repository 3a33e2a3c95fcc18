import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from medloom.llm import turns


def cheapest(rows):
    """Cost, audit and lines of the cheapest edits of (role, text, fault), by a search over all edits."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        state = (i, roles[-1:] if roles else "")
        if state in done:
            continue
        done.add(state)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, lines
        ways = [("I", r, f"{r}:", 5, 0) for r in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            ways.append(("D", None, None, 2, 1))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                ways += [("K", role, f"{role}:{text}", more, 1)]
                ways += [("R", r, f"{r}:{text}", 1 + more, 1) for r in ("user", "assistant")]
        for edit, role, line, price, step in ways:
            after = roles if role is None else roles + (role[:1] or "?")
            # Some way to go on must be left.
            if not re.fullmatch("s?(ua)*u?", after):
                continue
            heapq.heappush(heap, (cost + price, audit + edit, i + step, after, lines if line is None else (*lines, line)))
    raise AssertionError


def brute(table, damage=True):
    """What each conversation comes to, from (conv, turn, role, text)."""
    convs = {r[0]: [] for r in table}
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, marked, count = set(), [], Counter()
        for _, role, text in rows:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            count[fault] += 1
            marked.append((role, text, fault))
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, lines = cheapest(marked)
        found[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest(), list(lines))
    return found


ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "sys", "User"]
TEXTS = ["Hello.", "Hello", "", " \t\n", None, "So?", "wait! \r\n", "a.b", "é…", "\x0b.", "long " * 40_000 + "."]


def table(n=260, seed=4):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        regular = rng.random() < 0.5
        for i in range(rng.randrange(1, 9)):
            turn = None if rng.random() < 0.06 else i + rng.choice([0, 0, 0, 1, 5])
            role = ("user", "assistant")[i % 2] if regular else rng.choice(ROLES)
            rows.append((conv, turn, role, f"Turn {i}." if regular else rng.choice(TEXTS)))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit("other") for c in ("conv", "copies", "digest", "kind", "first", "others", "part", "audit", "cost")})


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(found):
    rows = found.collect()
    result = {r.conv: tuple(r[n] for n in NAMES) for r in rows}
    assert len(result) == len(rows)
    return result


def test_against_search(spark):
    rows = table()
    expected = {k: v[:-1] for k, v in brute(rows).items()}
    assert got(turns.repair(turns.damage(frame(spark, rows)))) == expected
    # At these costs no insertion is among the cheapest edits.
    assert {e for v in expected.values() for e in v[6]} == set("KRD")
    # Conversations without a row left.
    assert any(v[6] == "" and v[5] == 0 for v in expected.values())


def test_undamaged_and_rows(spark):
    rows = table(60, seed=8)
    given = turns.rows_of(frame(spark, rows))
    expected = brute(rows, damage=False)
    assert got(turns.repair(given)) == {k: v[:-1] for k, v in expected.items()}
    lines = {}
    for r in sorted(turns.repaired_rows(given).collect(), key=lambda r: r.position):
        lines.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
        assert r.edit in "KRI" and (r.turn is None or r.edit != "I")
    assert lines == {k: v[-1] for k, v in expected.items() if v[-1]}


def test_long_conversation_over_many_tasks(spark):
    """One conversation holds most rows; its pieces come from several tasks."""
    rng = random.Random(6)
    rows = [(7, i // 3 * 2, rng.choice(["user", "assistant", "tool"]), rng.choice(["a.", "b", "", f"c{i}."])) for i in range(1_500)]
    rows += [(8, 1, "user", "same.")] * 400 + [(i, 0, "user", "x.") for i in range(9, 60)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        given = turns.damage(frame(spark, rows))
        assert turns.signatures(given).filter("conv = 7 AND length(signature) > 1000").count() == 1
        assert got(turns.repair(given)) == {k: v[:-1] for k, v in brute(rows).items()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_every_short_signature():
    """The automaton against the search, whatever it read before."""
    kinds = [(r, f) for r in ("system", "user", "assistant", "tool") for f in ("", "truncated")] + [("user", "blank")]
    signs = dict(zip(kinds, "sSuUaAxXD"))
    one = turns.Automaton()
    every = [c for n in range(4) for c in itertools.product(kinds, repeat=n)]
    for rows in sorted(every, key=lambda c: [signs[k] for k in c[::-1]]):
        expected = cheapest([(r, "t", f) for r, f in rows])[:2]
        assert one.read("".join(signs[k] for k in rows[::-1])) == expected
    rng = random.Random(1)
    for _ in range(60):
        rows = [rng.choice(kinds) for _ in range(rng.randrange(30))]
        assert one.read("".join(signs[k] for k in rows[::-1])) == cheapest([(r, "t", f) for r, f in rows])[:2]
    # Few classes of nodes, however many suffixes.
    assert len(one.classes) < 100


def test_insertions(monkeypatch):
    """Where deleting costs more, rows are inserted, and written out."""
    monkeypatch.setattr(turns, "DELETE", 20)
    one = turns.Automaton()
    assert [one.read(k) for k in ("u", "x", "aas")] == [(5, "KI"), (6, "IR"), (1, "KRK")]
    lines = []
    repair = turns.Repair("KIKIK")
    for role in ("system", "assistant", "assistant"):
        lines += [r for r, _ in repair.inserts()] + [repair.row(role)[0]]
    assert lines == ["system", "user", "assistant", "user", "assistant"]


def test_shared_suffixes_are_solved_once(monkeypatch):
    one, pushed = turns.Automaton(), []
    step = turns.Automaton.step
    monkeypatch.setattr(turns.Automaton, "step", lambda self, node, symbol: pushed.append(symbol) or step(self, node, symbol))
    for backwards in ["au", "aua", "auas", "auau", "x"]:
        one.read(backwards)
    assert "".join(pushed) == "auasux"


def test_nothing(spark):
    assert turns.repair(turns.damage(frame(spark, []))).collect() == []
    assert turns.repaired_rows(turns.damage(frame(spark, []))).collect() == []


@pytest.mark.parametrize("kind", ["string", "int"])
def test_other_ids(spark, kind):
    rows = table(20, seed=3)
    df = frame(spark, rows).withColumn("conv_id", F.col("conv_id").cast(kind))
    cast = {k if k is None or kind == "int" else str(k): v[:-1] for k, v in brute(rows).items()}
    assert got(turns.repair(turns.damage(df))) == cast
