"""Mixing sources to target weights by capped water-filling.

Every source gets its weight's share of all words, but no more than
``epochs`` times its own. What a capped source leaves is dealt to the others
by weight, again and again until none is above its cap. Clamping in the order
of cap by weight gives the same fixed point as repeated rounds, so that it is
one running sum over the sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from medloom.llm.text import SPACE, text_of, words
from medloom.sources.storage import materialize

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = 17
# Steps of the seeded draw; a step, or a document if that is more, is the least that can be added to a source's words.
STEPS = 1 << 12
UNITS = 1 << 32
# Sources up to which their plan, one short row each, is broadcast; beyond it the join shuffles.
BROADCAST_SOURCES = 10_000


def draw(seed: int, key: Column) -> Column:
    """A number from 0 to 2^32 - 1 that depends on the seed and the key alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) for each source.

    Sources take the weights in turn by code point, null last. The frame has a
    row for each source, and the running sums see these rows only.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = sizes.withColumn("weight", F.array(*[F.lit(w) for w in weights])[(turn % len(weights)).cast("int")])
    ranked = ranked.withColumn("cap", epochs * F.col("source_size"))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    level = ranked.select(
        "*", F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("held"),
        F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)).alias("open"),
    ).withColumn("level", (F.col("total") - F.col("held")) / F.col("open"))
    free = level.withColumn("free", F.when(F.col("weight") * F.col("level") < F.col("cap"), F.col("level")))
    # The level of the first source that is not clamped holds for all after it.
    held = free.withColumn("water", F.first("free", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)))
    return held.select(
        "source", "source_size",
        F.coalesce(F.col("weight") * F.col("water"), F.col("cap").cast("double")).alias("target"))


def _sized(df: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    return materialize(df.select(
        F.col(key).alias("key"), F.col(source).alias("source"), F.size(words(text_of(text))).cast("long").alias("size"),
        _step(seed, key).alias("step")), "mix-sizes")


def _step(seed: int, key: str) -> Column:
    return F.floor(draw(seed, F.col(key)) / (UNITS // STEPS))


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target, whole, below, extra): how often a source's documents are taken.

    All are taken ``whole`` times. What whole repetitions leave of the target
    is filled by steps of the draw, as long as their running sum stays within
    it, so those below ``below`` are taken once more; then by the one step
    behind them that brings the sum nearest, if any brings it nearer.
    """
    # One row for each source and step: a hot source is summed before it meets.
    steps = materialize(sized.groupBy("source", "step").agg(F.sum("size").alias("words")), "mix-steps")
    goal = targets(steps.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole)
    goal = materialize(goal.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    running = W.partitionBy("source").orderBy("step")
    parts = goal.select(F.col("source").alias("s"), "part")
    drawn = steps.join(parts, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "step", "part", F.sum("words").over(running).alias("upto"), "words")
    inside = F.col("upto") <= F.col("part")
    filled = F.coalesce(F.max(F.when(inside, F.col("upto"))).over(W.partitionBy("source")), F.lit(0))
    drawn = drawn.withColumns({"gap": F.col("part") - filled, "inside": inside})
    miss = F.abs(F.col("gap") - F.col("words"))
    nearer = F.when(~F.col("inside") & (miss < F.col("gap")), F.struct(miss.alias("miss"), "step"))
    cut = drawn.groupBy(F.col("source").alias("s")).agg(
        F.max(F.when(F.col("inside"), F.col("step") + 1)).alias("below"), F.min(nearer).alias("nearest"))
    return materialize(goal.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("below", F.lit(0)).alias("below"),
        F.coalesce("nearest.step", F.lit(-1)).alias("extra")), "mix-plan")


def _with_copies(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (source, step, ...) with source_size, target and copies."""
    found = found.withColumnRenamed("source", "_s")
    if found.count() <= BROADCAST_SOURCES:
        found = F.broadcast(found)
    rows = rows.join(found, F.col("source").eqNullSafe(F.col("_s")), "left")
    return rows.withColumn("copies", F.col("whole") + ((F.col("step") < F.col("below")) | (F.col("step") == F.col("extra"))).cast("long"))


def mix(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED,
) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken) for every row.

    ``size`` counts the words between white space, zero for a null text. All
    documents of a source are taken whole as often as the target holds the
    source, and a seeded part once more. The null source is a source of its
    own. Repeated rows draw alike, and so do rows without a key. Sources
    without words have the target zero. An empty table gives an empty result;
    other columns are not touched.
    """
    sized = _sized(df, key, text, source, seed)
    rows = _with_copies(sized, plan(sized, weights, epochs))
    return rows.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def repeat(
    df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED,
) -> DataFrame:
    """The mixture itself: every row as often as ``mix`` takes it, numbered by ``epoch`` from 1. Texts do not shuffle.

    A column named epoch is replaced.
    """
    found = plan(_sized(df, key, text, source, seed), weights, epochs)
    columns = [c for c in df.columns if c != "epoch"]
    rows = df.select(F.struct(*columns).alias("row"), F.col(source).alias("source"), _step(seed, key).alias("step"))
    rows = _with_copies(rows, found).filter("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("epoch")).select("row.*", "epoch")


_COUNT = f"len(list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> ''))"
SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST({_COUNT} AS BIGINT) AS size,
         CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) // {UNITS // STEPS} AS step
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, {EPOCHS} * CAST(sum(size) AS BIGINT) AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM sources),
water AS (SELECT level FROM levels WHERE weight * level < cap ORDER BY cap / weight, source NULLS LAST LIMIT 1),
goal AS (
  SELECT source, source_size, CASE WHEN weight * water.level < cap THEN weight * water.level ELSE CAST(cap AS DOUBLE) END AS target
  FROM levels LEFT JOIN water ON true),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM goal),
steps AS (SELECT source, step, sum(size) AS words FROM sized GROUP BY source, step),
upto AS (SELECT source, step, words, sum(words) OVER (PARTITION BY source ORDER BY step) AS upto FROM steps),
placed AS (
  SELECT u.source, step, words, upto, target - whole * source_size AS part, upto <= target - whole * source_size AS inside
  FROM upto u JOIN parts p ON u.source IS NOT DISTINCT FROM p.source),
gaps AS (SELECT *, part - coalesce(max(CASE WHEN inside THEN upto END) OVER (PARTITION BY source), 0) AS gap FROM placed),
cuts AS (SELECT source, max(CASE WHEN inside THEN step + 1 END) AS below FROM gaps GROUP BY source),
extras AS (
  SELECT source, step AS extra FROM gaps WHERE NOT inside AND abs(gap - words) < gap
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(gap - words), step) = 1)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN step < coalesce(below, 0) OR step = extra THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
LEFT JOIN extras e ON s.source IS NOT DISTINCT FROM e.source
"""
