"""Repair of the structure of conversations at least cost.

Each row of a conversation becomes one symbol of its signature: the class of
its role (system, user, assistant, other) and its first fault (blank,
duplicate, truncated). What follows a row decides what its edit will cost, so
signatures are read from the end: those that end alike share a suffix, a node
of the automaton, and are brought together by sorting them reversed. A task
keeps the nodes of the signature at hand on a stack and gives up only what the
next one does not share, so each node gets its cost-to-go and best edit for
the four states of the grammar once for all conversations. Nodes that agree in
both up to a constant are one class, of which there are few, whatever the
conversations hold.

Edits: keep a row (0), give it the role user or assistant (1), delete it (2,
required where it is blank or a duplicate), insert an empty row of the user or
the assistant (5); a truncated row that stays costs 5 more. The roles left must
read ``(s?(ua)+)?``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.sources.storage import materialize

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5
WORDS = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
# Symbols of a signature by fault, each for the roles system, user, assistant, other; D must go.
PLAIN, CUT, BLANK, DOUBLE = "suax", "SUAX", "1234", "5678"
# States of the grammar: nothing yet, after the system's row, after a user's, after an assistant's.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
MOVES = {
    START: {"s": AFTER_SYSTEM, "u": AFTER_USER}, AFTER_SYSTEM: {"u": AFTER_USER},
    AFTER_USER: {"a": AFTER_ASSISTANT}, AFTER_ASSISTANT: {"u": AFTER_USER},
}
# Where an inserted or re-roled row leads, and its role.
NEXT = [AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER]
ROLE = ["user", "user", "assistant", "user"]


class Automaton:
    """Costs-to-go and best edits of the suffixes of signatures, the last one's on a stack."""

    def __init__(self):
        # A class of nodes: costs of the four states above the least of them, and the best edit of each.
        self.classes: list[tuple[tuple[int, ...], tuple[str, ...]]] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[tuple[int, str], tuple[int, int]] = {}
        end, offset = self._number(self._inserted([(0, ""), (None, ""), (None, ""), (0, "")]))
        self.reversed, self.nodes, self.costs = "", [end], [offset]

    def _number(self, found: list[tuple[int, str]]) -> tuple[int, int]:
        """Number of the class of a node, and its least cost."""
        least = min(cost for cost, _ in found)
        key = (tuple(cost - least for cost, _ in found), tuple(edit for _, edit in found))
        if key not in self.numbers:
            self.numbers[key] = len(self.classes)
            self.classes.append(key)
        return self.numbers[key], least

    @staticmethod
    def _inserted(found: list[tuple[int | None, str]]) -> list[tuple[int, str]]:
        """Costs and edits where rows may be inserted first; two rows lead to every state."""
        for _ in range(2):
            after = [found[NEXT[state]][0] for state in range(4)]
            found = [
                min([x for x in (found[q], (None if after[q] is None else after[q] + INSERT, "I")) if x[0] is not None], default=(None, ""))
                for q in range(4)]
        return found

    def step(self, node: int, symbol: str) -> tuple[int, int]:
        """Class of the node before ``node`` by a symbol, and what its least cost adds."""
        known = self.steps.get((node, symbol))
        if known is None:
            costs = self.classes[node][0]
            role, stays = symbol.lower(), TRUNCATED if symbol in CUT else 0
            found = []
            for state in range(4):
                ways = [(costs[state] + DELETE, "D")]
                if symbol != "D":
                    ways.append((costs[NEXT[state]] + REROLE + stays, "R"))
                    if role in MOVES[state]:
                        ways.append((costs[MOVES[state][role]] + KEEP + stays, "K"))
                # Of equal costs, the edit whose letter comes first gives the least audit.
                found.append(min(ways))
            known = self.steps[node, symbol] = self._number(self._inserted(found))
        return known

    def read(self, backwards: str) -> tuple[int, str]:
        """Least cost and audit of a signature, given from its end."""
        shared, most = 0, min(len(backwards), len(self.reversed))
        while shared < most and backwards[shared] == self.reversed[shared]:
            shared += 1
        del self.nodes[shared + 1:], self.costs[shared + 1:]
        for symbol in backwards[shared:]:
            node, added = self.step(self.nodes[-1], symbol)
            self.nodes.append(node)
            self.costs.append(self.costs[-1] + added)
        self.reversed = backwards
        depth, state, audit = len(backwards), START, []
        cost = self.costs[depth] + self.classes[self.nodes[depth]][0][state]
        while edit := self.classes[self.nodes[depth]][1][state]:
            audit.append(edit)
            if edit == "K":
                state = MOVES[state][backwards[depth - 1].lower()]
            elif edit != "D":
                state = NEXT[state]
            depth -= edit != "I"
        return cost, "".join(audit)


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies): every row, damaged or not by a checksum of conversation and turn.

    Of twenty, one is dropped (no copies), one loses its text, one its final
    marks, one stands twice, one becomes the user's. Nulls count as a space;
    the turn stays null.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    kind = F.crc32(name) % 20
    said = F.coalesce(F.col(text), space)
    return df.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def rows_of(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The same columns for rows as they are."""
    space = F.lit(" ")
    return df.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"), F.lit(1).cast("long").alias("copies"))


ORDER = ["conv", "turn", "role", "digest"]


def _faults(rows: DataFrame) -> DataFrame:
    """One row for equal rows of a conversation: order, symbol of the first, symbol of its copies, how many."""
    kind = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x")
    short = rows.select(
        "conv", "turn", "role", F.unhex(F.md5("text")).alias("digest"), "copies", kind.alias("kind"),
        (~F.col("text").rlike(WORDS)).alias("blank"), (~F.col("text").rlike(ENDED)).alias("cut"))
    once = short.groupBy(*ORDER).agg(
        F.sum("copies").alias("copies"), *[F.first(c).alias(c) for c in ("kind", "blank", "cut")])
    once = materialize(once, "turn-faults")
    same = ["conv", "role", "digest"]
    # Texts of more than one turn are few; their first turn is found with partial sums and meets the rows once.
    again = once.filter("copies > 0").groupBy(*same).agg(F.min(F.struct("turn")).alias("least"), F.count(F.lit(1)).alias("n"))
    again = again.filter("n > 1").select(
        *[F.col(c).alias(f"{c}_") for c in same], F.col("least.turn").alias("turn_"), F.lit(True).alias("known"))
    met = once.join(again, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in same][0]
                    & (F.col("role") == F.col("role_")) & (F.col("digest") == F.col("digest_")), "left")
    later = F.col("known").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_"))

    def of(fault: str) -> Column:
        return F.translate("kind", PLAIN, fault)

    first = F.when(F.col("blank"), of(BLANK)).when(later, of(DOUBLE)).when(F.col("cut"), of(CUT)).otherwise(F.col("kind"))
    others = F.when(F.col("blank"), of(BLANK)).otherwise(of(DOUBLE))
    return met.select(*ORDER, "copies", first.alias("first"), others.alias("others"))


def signatures(rows: DataFrame) -> DataFrame:
    """(conv, gaps, signature) of every conversation.

    Rows are sorted over ranges of conversation and turn, so a long
    conversation goes over many tasks; each gives the piece it has seen.
    """
    faults = _faults(rows)
    kind = faults.schema["conv"].dataType.simpleString()
    names = ["conv", "turn", "role", "digest", "piece", "low", "high", "turns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each conversation of a task: its first key, symbols, and turns."""
        def flush() -> pa.RecordBatch:
            columns = list(zip(*[[*f[:4], "".join(f[4]), f[5], f[6], f[7]] for f in found]))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        found, types = [], None
        for batch in batches:
            types = [batch.column(i).type for i in range(4)] + [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            for conv, turn, role, digest, copies, first, others in zip(*[c.to_pylist() for c in batch.columns]):
                if not found or found[-1][0] != conv:
                    if len(found) >= 10_000:
                        yield flush()
                        found = []
                    found.append([conv, turn, role, digest, [], None, None, 0])
                last = found[-1]
                if copies:
                    last[4].append(first + others * (copies - 1))
                    if turn is not None and turn != last[6]:
                        last[5] = turn if last[5] is None else last[5]
                        last[6], last[7] = turn, last[7] + 1
        if found:
            yield flush()

    sorted_ = faults.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    pieces = sorted_.mapInArrow(
        run, f"conv {kind}, turn long, role string, digest binary, piece string, low long, high long, turns long")
    whole = pieces.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct(*names[1:]))).alias("pieces"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.sum("turns").alias("turns"))
    # A turn whose rows went to two tasks was counted by both.
    shared = F.size(F.filter(F.col("pieces"), lambda p, i: (i > 0) & (
        F.col("pieces")[F.greatest(i - 1, F.lit(0))]["high"] == p["low"])))
    return whole.select(
        "conv", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns") + shared, F.lit(0)).cast("long").alias("gaps"),
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("signature"))


def audits(found: DataFrame) -> DataFrame:
    """Add (cost, audit) to signatures.

    Sorted by the reversed signature over ranges, so that what ends alike
    meets in a task; a signature that very many conversations have goes over
    several tasks, which find its nodes once each.
    """
    kind = found.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton()
        last, known = None, None
        for batch in batches:
            costs, edits = [], []
            for backwards in batch.column(3).to_pylist():
                if backwards != last:
                    last, known = backwards, automaton.read(backwards)
                costs.append(known[0])
                edits.append(known[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(costs, pa.int64()), pa.array(edits, pa.string())],
                names=["conv", "gaps", "signature", "cost", "audit"])

    ends = found.withColumn("backwards", F.reverse(F.translate("signature", BLANK + DOUBLE, "D" * 8)))
    sorted_ = ends.repartitionByRange("backwards", "conv").sortWithinPartitions("backwards")
    return sorted_.mapInArrow(run, f"conv {kind}, gaps long, signature string, cost long, audit string")


def _edited(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of each conversation in order behind its audit; only texts of rows that exist travel."""
    texts = rows.filter("copies > 0").select(
        "conv", F.lit(1).alias("part"), "turn", "role", "text", "copies", *[
            F.lit(None).cast(t).alias(c) for c, t in (("gaps", "long"), ("signature", "string"), ("cost", "long"), ("audit", "string"))])
    heads = found.select(
        "conv", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"), F.lit(None).cast("long").alias("copies"), "gaps", "signature", "cost", "audit")
    return heads.unionByName(texts).repartition("conv").sortWithinPartitions(
        "conv", "part", "turn", "role", F.unhex(F.md5("text")))


class Repair:
    """Applies one conversation's audit to its rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield ROLE[self.state], "I"
            self.state, self.at = NEXT[self.state], self.at + 1

    def row(self, role: str) -> tuple[str | None, str]:
        """New role of the next row, or None if it goes, and its edit."""
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = MOVES[self.state][role[0]]
        elif edit == "R":
            role, self.state = ROLE[self.state], NEXT[self.state]
        return (None if edit == "D" else role), edit


def _repaired(batches: Iterator[pa.RecordBatch], begin: Callable, line: Callable) -> Iterator[pa.RecordBatch | None]:
    """Call ``begin`` with each head and ``line`` with each repaired row (turn, role, text, edit), in order."""
    repair = None
    for batch in batches:
        for i in range(batch.num_rows):
            if not batch.column(1)[i].as_py():
                if repair:
                    for role, edit in repair.inserts():
                        line(None, role, "", edit)
                begin(*[batch.column(c)[i].as_py() for c in (0, 6, 7, 8, 9)])
                repair = Repair(batch.column(9)[i].as_py())
                continue
            turn, role, text, copies = (batch.column(c)[i].as_py() for c in (2, 3, 4, 5))
            for _ in range(copies):
                for given, edit in repair.inserts():
                    line(None, given, "", edit)
                given, edit = repair.row(role)
                if given is not None:
                    line(turn, given, text, edit)
        yield None
    if repair:
        for role, edit in repair.inserts():
            line(None, role, "", edit)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """(conv, position, turn, role, text, edit): the rows of the repaired conversations.

    ``rows`` are those of ``rows_of`` or ``damage``. Positions count from 0;
    an inserted row has no turn.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    names = ["conv", "position", "turn", "role", "text", "edit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, types = [], [None, 0], []

        def begin(conv, *_):
            at[:] = [conv, 0]

        def line(turn, role, text, edit):
            out.append((at[0], at[1], turn, role, text, edit))
            at[1] += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def seen():
            for batch in batches:
                types[:] = [batch.column(0).type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield batch

        for _ in _repaired(seen(), begin, line):
            if out:
                yield flush()
        if out:
            yield flush()

    edited = _edited(rows, audits(signatures(rows)))
    return edited.mapInArrow(run, f"conv {kind}, position long, turn long, role string, text string, edit string")


def repair(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    ``rows`` are those of ``rows_of`` or ``damage``: rows by turn, nulls
    first, then role, then the text's MD5, so that equal rows stand together
    and the order is the same in every run. A conversation without an id is
    one of its own; one whose rows have no copies, and thus no row left, has
    zeros, an empty audit and the hash of nothing. A null role or text is a
    space. An empty table gives an empty result. A conversation's texts meet
    in one task, as the hash over them runs in order; they pass through it one
    by one and are never held together.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    names = ["conv", "gaps", "signature", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, types = [], [], []

        def close():
            if at:
                out.append((*at[0], at[1].hexdigest()))
                at.clear()

        def begin(*head):
            close()
            at[:] = [head, hashlib.sha256(), False]

        def line(turn, role, text, edit):
            at[1].update(f"\n{role}:{text}".encode() if at[2] else f"{role}:{text}".encode())
            at[2] = True

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def seen():
            for batch in batches:
                types[:] = [batch.column(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
                yield batch

        for _ in _repaired(seen(), begin, line):
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    done = _edited(rows, audits(signatures(rows))).mapInArrow(
        run, f"conv {kind}, gaps long, signature string, cost long, audit string, repaired_sha256 string")
    length = F.length("signature")
    roles = F.translate("signature", PLAIN + CUT + BLANK + DOUBLE, PLAIN * 4)

    def of(symbols: str) -> Column:
        return (length - F.length(F.translate("signature", symbols, ""))).cast("long")

    legal = sum(((length - F.length(F.replace(roles, F.lit(pair), F.lit("")))) / 2 for pair in ("su", "ua", "au")), F.lit(0))
    return done.select(
        "conv", "gaps", of(BLANK).alias("blank"), of(DOUBLE).alias("duplicate"), of(CUT).alias("truncated"),
        (F.greatest(length - 1, F.lit(0)) - legal).cast("long").alias("illegal"), "cost", "audit", "repaired_sha256")


SQL = """
WITH RECURSIVE
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                        lambda x: CAST(ascii(x) AS BIGINT)) AS codes
  FROM conversations),
summed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(codes, lambda c, b:
    xor(c >> 8, t[CAST(xor(c, b) & 255 AS INT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS k
  FROM named, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM summed, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) WHERE k <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
placed AS (
  SELECT conv_id, role, text, turn, i, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
              WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault
  FROM ordered),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM placed GROUP BY conv_id),
-- The best (cost, audit, lines) from a row on, for the four states of the grammar, from the last row to the first.
solved AS (
  SELECT conv_id, n AS i, [{'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}, {'c': 10, 'a': 'II', 'o': ['user:', 'assistant:']},
         {'c': 5, 'a': 'I', 'o': ['assistant:']}, {'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}] AS v
  FROM counted
  UNION ALL
  SELECT conv_id, i, list_transform([1, 2, 3, 4], lambda q: list_sort([once[q],
    {'c': once[[3, 3, 4, 3][q]].c + 5, 'a': 'I' || once[[3, 3, 4, 3][q]].a,
     'o': list_prepend(CASE q WHEN 3 THEN 'assistant:' ELSE 'user:' END, once[[3, 3, 4, 3][q]].o)}])[1]) AS v
  FROM (
    SELECT conv_id, i, list_transform([1, 2, 3, 4], lambda q: list_sort([base[q],
      {'c': base[[3, 3, 4, 3][q]].c + 5, 'a': 'I' || base[[3, 3, 4, 3][q]].a,
       'o': list_prepend(CASE q WHEN 3 THEN 'assistant:' ELSE 'user:' END, base[[3, 3, 4, 3][q]].o)}])[1]) AS once
    FROM (
      SELECT s.conv_id, s.i - 1 AS i, list_transform([1, 2, 3, 4], lambda q: list_sort(list_filter([
        {'c': s.v[q].c + 2, 'a': 'D' || s.v[q].a, 'o': s.v[q].o},
        CASE WHEN p.fault NOT IN ('blank', 'duplicate') THEN
          {'c': s.v[[3, 3, 4, 3][q]].c + 1 + CASE p.fault WHEN 'truncated' THEN 5 ELSE 0 END, 'a': 'R' || s.v[[3, 3, 4, 3][q]].a,
           'o': list_prepend(CASE q WHEN 3 THEN 'assistant:' ELSE 'user:' END || p.text, s.v[[3, 3, 4, 3][q]].o)} END,
        CASE WHEN p.fault NOT IN ('blank', 'duplicate') AND
               (p.role[1] = 's' AND q = 1 OR p.role[1] = 'u' AND q <> 3 OR p.role[1] = 'a' AND q = 3) THEN
          {'c': s.v[CASE p.role[1] WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].c + CASE p.fault WHEN 'truncated' THEN 5 ELSE 0 END,
           'a': 'K' || s.v[CASE p.role[1] WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].a,
           'o': list_prepend(p.role || ':' || p.text, s.v[CASE p.role[1] WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].o)} END
        ], lambda x: x IS NOT NULL))[1]) AS base
      FROM solved s JOIN placed p ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.i = p.i)))
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(v[1].c, 0) AS BIGINT) AS cost, coalesce(v[1].a, '') AS audit,
       sha256(coalesce(array_to_string(v[1].o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted ON c.conv_id IS NOT DISTINCT FROM counted.conv_id
LEFT JOIN (SELECT * FROM solved WHERE i = 0) f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
"""
