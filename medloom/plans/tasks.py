"""Clean-up tasks written as SQL over the tables of a delivery."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom import schema
from medloom.operators.dedupe import repair_keys
from medloom.operators.diff import diff_by_content, diff_by_key
from medloom.operators.metrics import as_metrics

# Reviewed concepts that stay although they were mapped from text: fixed values.
TEXT_MAPPED_ALLOWED = [
    4020553, 44816618, 21490847, 36674488, 3020891, 4140731, 4137519, 4134573, 4139702, 4141359, 1988764, 4177340,
]
_LOOKUP = "optimized_vocab_file"


def drop_text_mapped(measurement: DataFrame) -> DataFrame:
    """Without measurements whose concept was guessed from text.

    A row for which the rule cannot be decided goes as well.
    """
    guessed = (
        (F.col("measurement_concept_id") != 0)
        & (F.col("measurement_source_concept_id") == 0)
        & (F.length(F.coalesce(F.col("measurement_source_value"), F.lit(""))) > 5)
        & ~F.col("measurement_concept_id").isin(TEXT_MAPPED_ALLOWED)
    )
    return measurement.filter(~guessed)


@dataclass(frozen=True)
class TaskResult:
    """Tables after a task, and rows added and removed per written table."""

    name: str
    tables: dict[str, DataFrame]
    changes: DataFrame

    def metrics(self) -> DataFrame:
        """Three metrics per changed table; two zeros if nothing changed."""
        changed = self.changes.filter("added > 0 OR removed > 0")
        entry = "label string, n double"

        def rows(*pairs: tuple[str, object]) -> F.Column:
            return F.explode(F.array(*[
                F.struct(F.lit(label).alias("label"), (n if n is not None else F.lit(None)).cast("double").alias("n"))
                for label, n in pairs
            ])).alias("entry")

        per_table = changed.select("table_name", rows(
            ("rows added", F.col("added")), ("rows removed", F.col("removed")), ("table affected", None)))
        none = changed.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
            F.lit(None).cast("string").alias("table_name"), rows(("rows added", F.lit(0)), ("rows removed", F.lit(0))))
        name = F.concat(F.lit(f"Post-processing task {self.name}: "), F.col("entry.label"))
        return as_metrics(
            per_table.unionByName(none), name, F.col("table_name"), F.col("entry.n"), about=F.lit(None)
        )


def _diff(table: str, before: DataFrame, after: DataFrame) -> DataFrame:
    known = table in schema.tables()
    key = schema.primary_key(table) if known else None
    counts = diff_by_key(before, after, key) if key else diff_by_content(before, after)
    return counts.select(F.lit(table).alias("table_name"), "added", "removed")


def run_task(name: str, tables: dict[str, DataFrame], statements: dict[str, str | None]) -> TaskResult:
    """Run ``{table: SELECT ...}`` over the tables, which SQL names as ``{table}``.

    None as a statement drops the table. Vocabulary tables may be read, not
    written. Keys that a statement made repeat are repaired.
    """
    if not statements:
        raise ValueError(f"task {name} writes no table")
    protected = [t for t in statements if t in (*schema.VOCABULARY_TABLES, _LOOKUP)]
    if protected:
        raise ValueError(f"task {name} must not write vocabulary table {', '.join(protected)}")
    unknown = [t for t in statements if t not in tables]
    if unknown:
        raise ValueError(f"task {name} writes unknown table {', '.join(unknown)}")

    after, changes = dict(tables), []
    for table, statement in statements.items():
        before = tables[table]
        if statement is None:
            changes.append(_diff(table, before, before.limit(0)))
            del after[table]
            continue
        named = {t: df for t, df in tables.items() if "{" + t + "}" in statement}
        written = before.sparkSession.sql(statement, **named)
        changes.append(_diff(table, before, written))
        after[table] = repair_keys(written, schema.primary_key(table)) if table in schema.SURROGATE_KEY_TABLES else written
    return TaskResult(name, after, reduce(DataFrame.unionByName, changes))
