"""Joins that hold when one key carries a large share of the rows.

A lookup is broadcast only after its rows were counted. Past the limit the
lookup is narrowed to the keys in use, and past it again both sides shuffle.
A sketch of the keys then tells the heavy ones; these alone get a salt, so
that many tasks serve them.

Rows that an inner join would drop may be sieved out before: a bit for each
hash of a key costs two bytes a key, however wide the lookup is, and a filter by
these bits goes below the joins that made the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.sources.storage import materialize

# Lookups are narrow: a few ids, flags and short codes, about 100 bytes a row.
BROADCAST_ROWS = 1_000_000
SALTS = 32
# Share of the rows from which a key is heavy; what lies below is left to adaptive skew handling.
HEAVY_SHARE = 0.01
# Bits of a sieve for each key, in pieces of 512 words of 64 bits, of which there are at most so many (16 MB).
SIEVE_BITS = 16
SIEVE_WORDS = 512
SIEVE_PIECES = 4096


def setting(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(f"spark.medloom.{name}", str(default)))


def fits(df: DataFrame, bound: DataFrame | None = None) -> bool:
    """True when a counted bound on the frame's rows allows a broadcast.

    ``bound`` is a frame with at least as many rows that is cheaper to count.
    """
    return row_count(df if bound is None else bound) <= setting(df.sparkSession, "broadcastRows", BROADCAST_ROWS)


def row_count(df: DataFrame) -> int:
    """Rows of a frame, counted once per frame."""
    if not hasattr(df, "_medloom_rows"):
        df._medloom_rows = df.count()
    return df._medloom_rows


def heavy_keys(df: DataFrame, on: list[str]) -> dict[int, float]:
    """Hash and share of the keys that hold more than ``HEAVY_SHARE`` of the rows.

    A frequent-items sketch of bounded size, merged over the tasks without a
    shuffle: no key above the share is missed, and there are at most
    ``1 / HEAVY_SHARE`` of them.
    """
    most = round(1 / HEAVY_SHARE)
    found = df.select(F.xxhash64(*on).alias("key")).agg(
        F.expr(f"approx_top_k(key, {most}, {16 * most})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {r["item"]: r["count"] / found.n for r in found.top or [] if r["count"] > HEAVY_SHARE * found.n}


def counted_keys(counts: DataFrame, on: list[str], number: str) -> dict[int, float]:
    """The same from rows that were already counted by key, without a look at the rows themselves."""
    total = counts.agg(F.sum(number).alias("n")).first().n or 0
    heavy = counts.filter(F.col(number) > HEAVY_SHARE * total).select(F.xxhash64(*on).alias("key"), F.col(number).alias("n"))
    # At most 1 / HEAVY_SHARE keys reach the driver.
    return {r.key: r.n / total for r in heavy.collect()}


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, heavy: dict[int, float] | None = None
) -> DataFrame:
    """Shuffle join whose left rows of a heavy key spread over many tasks.

    Only heavy keys are salted, each in proportion to its share, and only
    their right rows are repeated, once per salt; all other rows join as they
    are. The salt is the partition a left row comes from: rows of one key,
    copies of one row included, arrive from many partitions, and a repeated
    task assigns the same salt again. Left, inner, semi and anti joins stay
    exact. ``heavy`` names the heavy keys where they are known.
    """
    if heavy is None:
        heavy = heavy_keys(left, on)
    if not heavy:
        return left.join(right, on, how)
    spark = left.sparkSession
    most, tasks = setting(spark, "salts", SALTS), int(spark.conf.get("spark.sql.shuffle.partitions"))
    # As many salts as tasks of average size that the key's rows would fill, two at least.
    salts = {key: min(most, max(2, round(2 * share * tasks))) for key, share in heavy.items()}
    table = F.create_map(*[F.lit(x) for pair in salts.items() for x in pair])
    salted = left.withColumn("_salts", table[F.xxhash64(*on)])
    spread = salted.withColumn("_salt", F.when(
        F.col("_salts").isNotNull(), F.pmod(F.spark_partition_id(), F.col("_salts"))).otherwise(0)).drop("_salts")
    count = F.coalesce(table[F.xxhash64(*on)], F.lit(1))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), count - 1)))
    return spread.join(repeated, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    left: DataFrame, lookup: DataFrame, on: list[str] | str, how: str = "left", bound: DataFrame | None = None,
    narrow: bool = True, number: str | None = None,
) -> DataFrame:
    """Join rows with a lookup on equally named columns.

    ``narrow=False`` skips the look at the keys in use, for lookups that were
    made from these very rows. Such a lookup may tell by its column ``number``,
    which stays behind, how many of the rows hold a key; heavy keys are then
    found there, and the rows are not read for them.
    """
    keys = [on] if isinstance(on, str) else on
    if number:
        counts, lookup = lookup, lookup.drop(number)
        if fits(counts, bound):
            return left.join(F.broadcast(lookup), keys, how)
        return salted_join(left, lookup, keys, how, counted_keys(counts, keys, number))
    if fits(lookup, bound):
        return left.join(F.broadcast(lookup), keys, how)
    if narrow:
        # Written, as it is counted first and joined after.
        lookup = materialize(lookup.join(left.select(*keys).distinct(), keys, "left_semi"), "used-keys")
        if fits(lookup):
            return left.join(F.broadcast(lookup), keys, how)
    return salted_join(left, lookup, keys, how)


def sieve(keys: DataFrame) -> DataFrame:
    """One written row (_sieve) of bits, set for every hash in the only column of the written frame ``keys``.

    About one in sixteen other hashes passes as well, and more where the keys
    are so many that the sieve is at its limit.
    """
    pieces = max(1, min(SIEVE_PIECES, -(-row_count(keys) * SIEVE_BITS // (64 * SIEVE_WORDS))))
    place = F.pmod(F.col(keys.columns[0]), F.lit(pieces * SIEVE_WORDS * 64))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    words = keys.groupBy(F.floor(place / 64).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    # Words without a key stand in their places too.
    words = keys.sparkSession.range(pieces * SIEVE_WORDS).withColumnRenamed("id", "_word").join(words, "_word", "left")

    def in_order(number: str, value: Column) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct(F.col(number), value.alias("value")))), lambda x: x["value"])
    by_piece = words.groupBy(F.floor(F.col("_word") / SIEVE_WORDS).alias("_piece")).agg(
        in_order("_word", F.coalesce("_bits", F.lit(0).cast("bigint"))).alias("_words"))
    return materialize(by_piece.agg(in_order("_piece", F.col("_words")).alias("_sieve")), "sieve")


def passes(sieve: DataFrame, key: Column) -> Column:
    """Whether a hash may be among the keys of a sieve; always true of those that are.

    The sieve is a subquery of one value, so that a filter by it goes below
    the joins that made the rows, which a join would not.
    """
    held = sieve.scalar()
    place = F.pmod(key, F.size(held) * F.lit(SIEVE_WORDS * 64).cast("bigint"))
    words = F.get(held, F.floor(place / (64 * SIEVE_WORDS)).cast("int"))
    return F.getbit(F.get(words, (F.floor(place / 64) % SIEVE_WORDS).cast("int")), (place % 64).cast("int")) == 1
