"""SimHash near-duplicates through an inverted index of bytes by position.

Two 64-bit fingerprints that differ in three bits or fewer share at least
five of their eight bytes at the same positions. The index lists fingerprints
by (positions, bytes): every five of eight positions hold one of eight
triples, so a pair that can be linked meets in one list at least. In a list
the shared bytes of each pair are tallied, pairs below five are dropped and
the rest verified bit by bit. A list of more than ``LIST_LIMIT`` fingerprints
is dealt anew by one more position, twice if need be, which loses no pair.

Texts are reduced to distinct fingerprints first, and a list gives a spanning
forest of its links instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.components import connected
from medloom.llm.shared import carried, within
from medloom.sources.storage import materialize

BITS = 3
SHARED_BYTES = 8 - BITS
# Triples within either half of the eight positions: any five positions hold three of one half.
TRIPLES = [sum(1 << p for p in t) for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3)]
# Lists up to this size are compared in one task, 8 bytes a fingerprint.
LIST_LIMIT = 4096
# Keys of rows, two longs each, up to which they are broadcast, after they were counted; beyond it the join shuffles.
BROADCAST_KEYS = 1_000_000
SEED = 42
WORDS = 3
_STEP = 1 << 16


def fingerprint(text: bytes | None) -> int:
    """The 64-bit SimHash of a text in UTF-8; zero without words."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(WORDS)))] or [b" ".join(words)]
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, len(grams), _STEP):
        hashes = np.array([xxh64_intdigest(g, SEED) for g in grams[start:start + _STEP]], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(grams), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, simhash) of every row; simhash is the fingerprint as a signed long. A null text has no words."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["key", "simhash"])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, simhash long").withColumnRenamed("key", key)


def _bytes_mask(mask: int) -> int:
    value = sum(0xFF << (8 * p) for p in range(8) if mask >> p & 1)
    return value - (1 << 64) if value >= 1 << 63 else value


def _listed(rows: DataFrame, masks: list[int]) -> DataFrame:
    entries = [F.struct(F.lit(m).alias("mask"), F.col("simhash").bitwiseAND(F.lit(_bytes_mask(m))).alias("bytes"))
               for m in masks]
    return rows.select("simhash", F.explode(F.array(*entries)).alias("e")).select("e.mask", "e.bytes", "simhash")


def _deeper(hot: DataFrame, size: int) -> DataFrame:
    """Entries of hot lists under one more position; of those left, so many that a linked pair shares one of them."""
    pieces = []
    masks = sorted({m for t in TRIPLES for m in _grown(t, size)})
    for mask in masks:
        more = [mask | 1 << p for p in _next_positions(mask)]
        pieces.append((mask, more))
    choice = F.create_map(*[x for m, more in pieces for x in (F.lit(m), F.array(*[F.lit(v) for v in more]))])
    full = F.create_map(*[x for m in sorted({v for _, more in pieces for v in more}) for x in (F.lit(m), F.lit(_bytes_mask(m)))])
    return (hot.select("simhash", F.explode(choice[F.col("mask")]).alias("mask"))
            .select("mask", F.col("simhash").bitwiseAND(full[F.col("mask")]).alias("bytes"), "simhash").distinct())


def _next_positions(mask: int) -> list[int]:
    """A pair shares ``SHARED_BYTES - size`` of the other positions at least: it misses at most three of them."""
    return [p for p in range(8) if not mask >> p & 1][:BITS + 1]


def _grown(mask: int, size: int) -> set[int]:
    """The masks of so many positions that grow out of a triple."""
    if mask.bit_count() == size:
        return {mask}
    return {m for p in _next_positions(mask) for m in _grown(mask | 1 << p, size)}


def _linked(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Which of the fingerprints pass the count of shared bytes and the verification."""
    differing = np.bitwise_xor(one, many).view(np.uint64)  # of signed numbers, bits are counted without the sign
    shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    return (shared >= SHARED_BYTES) & (np.bitwise_count(differing) <= BITS)


def _forest(members: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join each linked set of a list: every member is reached once."""
    left = members
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            hit = _linked(node, left)
            if hit.any():
                found, left = left[hit], left[~hit]
                yield np.full(len(found), node), found
                queue.extend(found)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of lists; rows come sorted by (mask, bytes, simhash)."""
    rest = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        rest = columns if rest is None else [np.concatenate(x) for x in zip(rest, columns)]
        mask, value, member = rest
        starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
        last = starts[-1]
        yield from _solved(member[:last].astype(np.int64), starts[:-1])
        rest = [x[last:] for x in rest]
    if rest is not None and len(rest[0]):
        yield from _solved(rest[2].astype(np.int64), np.array([0]))


def _solved(members: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(starts):
        return
    sizes = np.diff(np.r_[starts, len(members)])
    pairs = starts[sizes == 2]
    one, two = members[pairs], members[pairs + 1]
    hit = _linked(one, two) if len(one) else np.zeros(0, dtype=bool)
    us, vs = [one[hit]], [two[hit]]
    for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
        for u, v in _forest(members[start:start + size]):
            us.append(u)
            vs.append(v)
    u, v = np.concatenate(us), np.concatenate(vs)
    if len(u):
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def links(distinct: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints (column simhash) differing in three bits or fewer.

    A spanning forest for each list of the index: nothing that is linked is
    left apart, without one row for each pair.
    """
    lists, size, parts = _listed(distinct, TRIPLES), TRIPLES[0].bit_count(), []
    while True:
        hot = None
        if size < SHARED_BYTES:
            counts = lists.groupBy("mask", "bytes").count().filter(F.col("count") > list_limit)
            hot = materialize(counts.select("mask", "bytes"), "hot-lists")
            hot = hot if hot.take(1) else None
        cool = lists.join(hot, ["mask", "bytes"], "left_anti") if hot is not None else lists
        ordered = cool.repartition("mask", "bytes").sortWithinPartitions("mask", "bytes", "simhash")
        parts.append(ordered.mapInArrow(_solve, "u long, v long"))
        if hot is None:
            break
        lists = materialize(_deeper(lists.join(hot, ["mask", "bytes"], "left_semi"), size), "deeper-lists")
        size += 1
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", list_limit: int = LIST_LIMIT) -> DataFrame:
    """(key, simhash, component) for every row of a frame.

    ``component`` is the least key reachable over links of three or fewer
    differing bits, the own included. Equal and empty texts are linked like
    any other (their fingerprints are equal); a null text counts as empty.
    Repeated rows stay repeated. A null key never becomes a component while
    a linked row has a key. An empty table gives an empty result; other
    columns are not touched.
    """
    rows = materialize(fingerprints(df, key, text), "simhash")
    nodes = materialize(rows.groupBy("simhash").agg(F.min(key).alias("least")), "simhash-nodes")
    roots = connected(links(nodes.select("simhash"), list_limit))
    placed = nodes.join(roots, nodes["simhash"] == roots["node"], "left").select(
        "simhash", "least", F.coalesce("root", "simhash").alias("root"))
    placed = materialize(placed, "simhash-roots")
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = materialize(placed.join(materialize(least, "simhash-least"), "root").select("simhash", "component"), "simhash-named")
    return rows.join(named, "simhash", "left").select(key, "simhash", "component")


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", list_limit: int = LIST_LIMIT) -> DataFrame:
    """One row of each component, that with the least key; nulls come first.

    Rows are told apart by key and text, so that neither a key that stands
    twice nor a null one loses a different text. Rows equal in both are one.
    """
    key, text = within(key), within(text)
    rows = carried(df).withColumn("_key", F.struct(F.col(key).alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit("")))))
    found = materialize(near_duplicates(rows, "_key", text, list_limit), "simhash-components")
    first = F.col("_key") == F.col("component")
    dropped = found.filter(~first).select("_key")
    repeated = materialize(found.filter(first).groupBy("_key").count().filter("count > 1").select("_key"), "simhash-repeated")
    gone = materialize(dropped.union(repeated).distinct(), "simhash-gone")
    kept = rows.join(_small(gone), "_key", "left_anti")
    if repeated.take(1):
        kept = kept.unionByName(rows.join(_small(repeated), "_key", "left_semi").dropDuplicates(["_key"]))
    return kept.select("row.*")


def _small(keys: DataFrame) -> DataFrame:
    """The (written) keys, marked for a broadcast when their count allows it; then the texts need not shuffle."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
