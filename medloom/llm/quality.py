r"""Quality rules as a short-circuit cascade.

Each rule looks at a document alone. On a bounded sample every rule is timed,
and one pass counts which rules reject which rows. The rule that rejects most
of what is still there for its time goes first, then the best of the others
on what that one leaves, and so on. The cascade is one CASE expression in
that order, so that later rules are not evaluated for rows an earlier one
rejected. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm.shared import carried, given_back, within
from medloom.llm.text import SPACE, UPPER, let, text_of, words
from medloom.sources.storage import materialize

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
REPEATED_PERCENT = 50
# Rows on which cost and selectivity are estimated.
SAMPLE_ROWS = 2000
SAMPLE_SEED = 11
_SPACES = " \t\n\x0b\x0c\r"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(_without(text, characters))).cast("long")


def _repeat_words(w: Column) -> Column:
    """Words in three-word windows that the text has twice or more.

    Windows are sorted as text with their place behind a line feed, which no
    word contains, so that equal windows are neighbours.
    """
    def places(ordered: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            return F.substring_index(F.get(ordered, i), "\n", 1) == F.substring_index(F.get(ordered, j), "\n", 1)

        at = F.sequence(F.lit(0), F.size(ordered) - 1)
        twice = F.filter(at, lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
        return F.array_sort(F.transform(twice, lambda i: F.substring_index(F.get(ordered, i), "\n", -1).cast("int")))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.concat(
        F.get(w, i), F.lit(" "), F.get(w, i + 1), F.lit(" "), F.get(w, i + 2), F.lit("\n"), i.cast("string")))
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    # Windows whose hashes all differ do not repeat.
    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    heavy = let(F.sort_array(windows), lambda s: let(places(s), covered))
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).when(repeats, heavy).otherwise(F.lit(0).cast("long"))


def _worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.length(_without(line, _SPACES)) > 0)


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """The frame with _text, _words and the base counts of every whole text."""
    rows = df.withColumn("_text", text_of(text))
    base = let(words(F.col("_text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    lines = let(_worded_lines(F.col("_text")), lambda found: F.struct(
        F.size(found).cast("long").alias("n_lines"),
        (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines")))
    rows = rows.withColumns({
        "_base": base, "_lines": lines,
        "word_chars": F.length(_without(F.col("_text"), _SPACES)).cast("long"),
        "n_symbols": _count_of(F.col("_text"), SYMBOLS),
    })
    return rows.withColumns({
        "n_words": F.col("_base.n_words"), "n_repeat_words": F.col("_base.n_repeat_words"),
        "n_lines": F.col("_lines.n_lines"), "n_dup_lines": F.col("_lines.n_dup_lines"),
    }).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))).drop("_base", "_lines")


def _letters() -> Column:
    """Eight of ten words hold a letter."""
    lettered = F.size(F.filter(words(F.col("_text")), lambda w: F.regexp_like(w, F.lit(r"\p{L}"))))
    return 10 * lettered >= 8 * F.col("n_words")


def _ellipses() -> Column:
    open_ended = F.size(F.filter(F.split(F.col("_text"), "\n"), lambda x: x.endswith("...") | x.endswith("…")))
    return 10 * open_ended <= 3 * F.col("n_lines")


def _bullets() -> Column:
    marked = F.size(F.filter(F.split(F.col("_text"), "\n"), lambda x: x.startswith("•") | x.startswith("- ") | x.startswith("* ")))
    return 10 * marked <= 9 * F.col("n_lines")


# What a document must satisfy, over the columns of ``measured``.
RULES: dict[str, Callable[[], Column]] = {
    "few_symbols": lambda: 10 * F.col("n_symbols") <= F.col("n_words"),
    "word_length": lambda: F.col("word_chars").between(2 * F.col("n_words"), 15 * F.col("n_words")),
    "distinct_lines": lambda: 10 * F.col("n_dup_lines") <= 3 * F.col("n_lines"),
    "calm": lambda: 5 * _count_of(F.col("_text"), "!") <= F.col("n_words"),
    "lower_case": lambda: 2 * _count_of(F.col("_text"), UPPER) <= F.col("word_chars"),
    "lettered_words": _letters,
    "closed_lines": _ellipses,
    "no_list": _bullets,
}


def _seconds(sample: DataFrame, rule: Column) -> float:
    """Time of a pass that evaluates a rule on every row of the sample, the better of two."""
    found = []
    for _ in range(2):
        started = time.perf_counter()
        sample.agg(F.count(F.when(rule, 1))).collect()
        found.append(time.perf_counter() - started)
    return min(found)


def estimate(sample: DataFrame, rules: dict[str, Callable[[], Column]] | None = None) -> list[tuple[str, float, float]]:
    """(rule, seconds, rejected share of what reaches it), best first, from a measured sample.

    Half a row more than was seen counts as rejected, so that rules that
    reject nothing on the sample go by their cost, the cheap ones first.
    """
    rules = RULES if rules is None else rules
    names = list(rules)
    idle = min(_seconds(sample, F.lit(True)) for _ in range(2))
    cost = {n: max(_seconds(sample, rules[n]()) - idle, 1e-3) for n in names}
    # At most one row for each combination of verdicts.
    passed = sample.groupBy(*[rules[n]().alias(n) for n in names]).count().collect()
    order, left = [], passed
    while names:
        total = sum(r["count"] for r in left)
        rejected = {n: sum(r["count"] for r in left if not r[n]) for n in names}
        best = max(names, key=lambda n: (rejected[n] + 0.5) / (total + 1) / cost[n])
        order.append((best, cost[best], rejected[best] / (total or 1)))
        left = [r for r in left if r[best]]
        names.remove(best)
    return order


def cascade(order: list[str]) -> Column:
    """False at the first rule that fails; rules behind it are not evaluated."""
    verdict = F.when(F.col("base_failed"), False)
    for name in order:
        verdict = verdict.when(~RULES[name](), False)
    return verdict.otherwise(True)


def _sampled(df: DataFrame, text: str, sample_rows: int) -> DataFrame:
    spare = df.select(F.col(text).alias("text"))
    rows = spare.count()
    return spare.sample(min(1.0, 2 * sample_rows / max(rows, 1)), SAMPLE_SEED).limit(sample_rows)


def judge(df: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The frame with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed and kept.

    Words stand between ASCII white space. A null or empty text has no words
    and fails. Very long texts are measured whole. Rows with equal texts get
    equal verdicts; an empty table gives an empty result. Columns of these
    names and of the names _text, _words in the frame are replaced.
    """
    sample = materialize(measured(_sampled(df, text, sample_rows)).filter("NOT base_failed"), "quality-sample")
    order = [name for name, _, _ in estimate(sample)]
    found = measured(carried(df), within(text)).withColumn("kept", cascade(order)).drop("_text")
    return given_back(found, df.columns)


def _counted(df: DataFrame, text: str) -> DataFrame:
    """(row, t, and the counts that cost little): the whole row of the caller in one column.

    The counts come out of an explode of one element: Spark does not copy
    their expressions into a filter behind it, so each is evaluated once.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), text_of(F.col(f"`{text}`")).alias("_text"))
    lines = let(_worded_lines(F.col("_text")), lambda found: F.struct(
        F.size(found).cast("long").alias("n_lines"),
        (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines")))
    counts = F.struct(
        F.size(words(F.col("_text"))).cast("long").alias("n_words"), F.length(_without(F.col("_text"), _SPACES)).cast("long").alias("word_chars"),
        _count_of(F.col("_text"), SYMBOLS).alias("n_symbols"), lines.alias("lines"))
    found = rows.select("row", "_text", F.explode(F.array(counts)).alias("c"))
    return found.select("row", "_text", "c.n_words", "c.word_chars", "c.n_symbols", "c.lines.n_lines", "c.lines.n_dup_lines")


# The base tests as rules like all others, where only the verdict is asked for.
EVERY_RULE: dict[str, Callable[[], Column]] = {
    "enough_words": lambda: F.col("n_words") >= LEAST_WORDS, **RULES,
    "little_repeated": lambda: 100 * let(words(F.col("_text")), _repeat_words) <= REPEATED_PERCENT * F.col("n_words"),
}


def passing(df: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows whose text passes every rule: those that ``judge`` keeps, with their columns and no others.

    Here the base tests are part of the cascade, so that the dear one, which
    counts repeated windows, runs only for what the cheap rules leave. Nulls,
    long texts, repeated rows and empty tables as in ``judge``; columns of any
    name pass through.
    """
    sample = materialize(_counted(_sampled(df, text, sample_rows), "text").drop("row"), "quality-sample")
    order = [name for name, _, _ in estimate(sample, EVERY_RULE)]
    verdict = F.when(~EVERY_RULE[order[0]](), False)
    for name in order[1:]:
        verdict = verdict.when(~EVERY_RULE[name](), False)
    return _counted(df, text).filter(verdict.otherwise(True)).select("row.*")


_LIST = f"list_filter(regexp_split_to_array(t, '{SPACE}'), lambda x: x <> '')"
_LINES = "list_filter(string_split(t, chr(10)), lambda x: length(translate(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) > 0)"
SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, doc_id, t, {_LIST} AS w, {_LINES} AS lines FROM texts),
windows AS (SELECT r, unnest(range(len(w) - 2)) AS p, w FROM words WHERE len(w) >= 3),
keyed AS (SELECT r, p, w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] AS k FROM windows),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, k) AS c FROM keyed) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT p + i) AS n FROM twice, range(3) x(i) GROUP BY r),
base AS (
  SELECT words.r, doc_id, t, w, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines, string_split(t, chr(10)) AS all_lines
  FROM words LEFT JOIN covered ON words.r = covered.r),
failed AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND 10 * n_symbols <= n_words
       AND word_chars BETWEEN 2 * n_words AND 15 * n_words
       AND 10 * n_dup_lines <= 3 * n_lines
       AND 5 * length(regexp_replace(t, '[^!]', '', 'g')) <= n_words
       AND 2 * length(regexp_replace(t, '[^A-Z]', '', 'g')) <= word_chars
       AND 10 * len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) >= 8 * n_words
       AND 10 * len(list_filter(all_lines, lambda x: suffix(x, '...') OR suffix(x, '…'))) <= 3 * n_lines
       AND 10 * len(list_filter(all_lines, lambda x: starts_with(x, '•') OR starts_with(x, '- ') OR starts_with(x, '* '))) <= 9 * n_lines
       AS kept
FROM failed
"""
