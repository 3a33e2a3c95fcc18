r"""Exact repeats of word sequences, found over fixed-block anchors.

A repeat of ``window`` words holds a whole reference block wherever it
starts, if blocks of ``(window + 1) // 2`` words begin at every multiple of
that length. So the blocks are indexed, every rolling window of the block's
length probes them, and only what lies around a hit is looked at further: a
hit grows word by word as long as the ``window`` words around it also start
elsewhere, and runs of such windows merge into maximal repeats.

The index holds no pairs. It is dealt by hash; each task sends a hash once,
however often it has it, with two marks: a reference block begins with it,
and it was seen more than once. A passage that every document shares is
therefore one entry for each task, and no group of copies is ever expanded.
Anchors are compared by 32 bits within a bucket, which may only give hits too
many; the windows that decide are compared by 128 bits.

The texts do not shuffle. They are written once to the shared folder, and
each pass reads its files there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.shared import open_store, stage, staged_files
from medloom.sources.storage import materialize

WINDOW = 35
# Text that one bucket of the index serves; a bucket is one group in one task.
BUCKET_BYTES = 32 << 20
LEAST_BUCKETS = 64
# Partitions for each staged file.
SPREAD = 8
# Odd multipliers of the rolling sums, their inverses modulo 2^64, and seeds of the word hashes.
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_INVERSES = tuple(pow(m, -1, 1 << 64) for m in _MULTIPLIERS)
_SEEDS = (1, 2)
# Text of one row group of the staged files, which a task holds as arrays of about twenty times its bytes.
GROUP_BYTES = 4 << 20
_ENTRY = "file string, part int, bucket long, one binary, two binary, marks binary"


class Words:
    """Words of one row group, end to end, with what rolling windows need."""

    def __init__(self, texts: pa.ChunkedArray):
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").combine_chunks())
        flat, owner = lists.flatten(), pc.list_parent_indices(lists)
        kept = pc.not_equal(flat, "")
        self.flat, owner = flat.filter(kept), owner.filter(kept).to_numpy()
        self.ends = np.searchsorted(owner, np.arange(len(lists)), side="right").astype(np.int32)
        self.starts = np.r_[np.int32(0), self.ends[:-1]] if len(lists) else self.ends
        self.coded = self.flat.dictionary_encode()
        lengths = self.ends - self.starts
        self.start_of = np.repeat(self.starts, lengths)
        self.end_of = np.repeat(self.ends, lengths)

    def rolling(self, length: int, which: int) -> np.ndarray:
        """Hash of the ``length`` words from each position on; only meaningful where they fit the document."""
        from xxhash import xxh64_intdigest

        n = len(self.flat)
        if n < length:
            return np.zeros(0, dtype=np.uint64)
        distinct = [xxh64_intdigest(w, _SEEDS[which]) for w in self.coded.dictionary.cast(pa.binary()).to_pylist()]
        values = np.array(distinct, dtype=np.uint64)[self.coded.indices.to_numpy()]
        powers = np.full(n, _MULTIPLIERS[which], dtype=np.uint64)
        powers[0] = 1
        inverses = np.full(n, _INVERSES[which], dtype=np.uint64)
        inverses[0] = 1
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(np.multiply(values, np.cumprod(powers, out=powers), out=values), out=sums[1:])
        mixed = sums[length:] - sums[:-length]
        mixed *= np.cumprod(inverses, out=inverses)[:n - length + 1]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ (mixed >> np.uint64(29))

    def fitting(self, length: int, least: int) -> np.ndarray:
        """Positions from which ``length`` words fit, in documents of ``least`` words or more."""
        at = np.arange(len(self.start_of), dtype=np.int32)
        return at[(at + length <= self.end_of) & (self.end_of - self.start_of >= least)]


def _parts(file: str) -> Iterator[tuple[int, pa.Table]]:
    """Row groups of a staged file."""
    store, path = open_store(file)
    with store.open_input_file(path) as source:
        parquet = pq.ParquetFile(source)
        for part in range(parquet.num_row_groups):
            yield part, parquet.read_row_group(part)


def _anchor_keys(words: Words, block: int, window: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rolling windows, and their bucket and 32 bits as one number."""
    at = words.fitting(block, window)
    hashes = words.rolling(block, 0)[at] if len(at) else np.zeros(0, dtype=np.uint64)
    return at, (hashes >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)


def _batches(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)


_ENTRIES = pa.schema([("file", pa.string()), ("part", pa.int32()), ("bucket", pa.int64()), ("one", pa.binary()),
                      ("two", pa.binary()), ("marks", pa.binary())])


def _dealt(file: str, part: int, bucket: np.ndarray, one: np.ndarray, two: np.ndarray | None, marks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries of one row group, one row for each bucket; sorted by bucket."""
    if not len(bucket):
        return
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    rows = [
        (file, part, int(bucket[a]), one[a:b].tobytes(), None if two is None else two[a:b].tobytes(), marks[a:b].tobytes())
        for a, b in zip(cuts, np.r_[cuts[1:], len(bucket)])
    ]
    yield from _batches(rows, _ENTRIES).to_batches(max_chunksize=1024)


def _anchors(files: DataFrame, block: int, window: int, buckets: int) -> DataFrame:
    """Hashes of rolling windows of each row group; mark 1: a reference block, mark 2: more than once."""
    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                for part, table in _parts(file):
                    words = Words(table.column("text"))
                    at, keys = _anchor_keys(words, block, window, buckets)
                    found, counts = np.unique(keys, return_counts=True)
                    aligned = keys[(at - words.start_of[at]) % block == 0]
                    marks = (counts > 1).astype(np.uint8) * 2
                    marks[np.searchsorted(found, np.unique(aligned))] |= 1
                    yield from _dealt(file, part, found >> np.uint64(32), found.astype(np.uint32), None, marks)
    return files.mapInArrow(run, _ENTRY)


def _array(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Values of all rows of a binary column end to end, and how many each row has."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=dtype), np.array([len(v) // np.dtype(dtype).itemsize for v in values])


def _answer(table: pa.Table, good: np.ndarray, sizes: np.ndarray, one: np.ndarray, two: np.ndarray | None) -> pa.Table:
    """What of each row's entries is good, sent back to its row group."""
    file, part, bucket = (table.column(c).to_pylist() for c in ("file", "part", "bucket"))
    rows, start = [], 0
    for i, size in enumerate(sizes):
        hit = good[start:start + size]
        if hit.any():
            rows.append((file[i], part[i], bucket[i], one[start:start + size][hit].tobytes(),
                         None if two is None else two[start:start + size][hit].tobytes(), None))
        start += size
    return _batches(rows, _ENTRIES)


def _met_anchors(table: pa.Table) -> pa.Table:
    """Anchors that a reference block and another place share."""
    one, sizes = _array(table.column("one"), np.uint32)
    marks, _ = _array(table.column("marks"), np.uint8)
    found, where = np.unique(one, return_inverse=True)
    places = np.bincount(where, 1 + (marks >> 1), len(found))
    blocks = np.bincount(where, marks & 1, len(found))
    return _answer(table, ((places > 1) & (blocks > 0))[where], sizes, one, None)


def _same_runs(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of 128-bit hashes, and the number of the run of equal ones that each place of that order is in."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    fresh = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(order)]
    return order, np.cumsum(fresh) - 1


def _met_windows(table: pa.Table) -> pa.Table:
    """Windows that start at two places or more."""
    one, sizes = _array(table.column("one"), np.uint64)
    two, _ = _array(table.column("two"), np.uint64)
    marks, _ = _array(table.column("marks"), np.uint8)
    order, run = _same_runs(one, two)
    places = np.bincount(run, 1 + (marks[order] >> 1))
    good = np.zeros(len(one), dtype=bool)
    good[order] = places[run] > 1
    return _answer(table, good, sizes, one, two)


def _by_part(answers: pa.Table, dtype) -> dict[int, list[bytes]]:
    found: dict[int, list] = {}
    for row in answers.select(["part", "bucket", "one", "two"]).to_pylist():
        found.setdefault(row["part"], []).append(row)
    return found


def _windows(block: int, window: int, buckets: int):
    """Windows around the anchors that were met, as entries of 128 bits."""
    def run(files: pa.Table, answers: pa.Table) -> pa.Table:
        met = _by_part(answers, np.uint32)
        out = []
        for file in files.column(0).to_pylist():
            for part, table in _parts(file):
                if part not in met:
                    continue
                words = Words(table.column("text"))
                at, keys = _anchor_keys(words, block, window, buckets)
                good = np.concatenate([
                    np.frombuffer(r["one"], dtype=np.uint32).astype(np.uint64) | np.uint64(r["bucket"]) << np.uint64(32)
                    for r in met[part]])
                hit = np.zeros(len(words.flat) + 1, dtype=np.int64)
                hit[at[np.isin(keys, good)] + 1] = 1
                upto = np.cumsum(hit)
                begin = words.fitting(window, window)
                begin = begin[upto[begin + window - block + 1] > upto[begin]]
                if not len(begin):
                    continue
                one, two = words.rolling(window, 0)[begin], words.rolling(window, 1)[begin]
                order, same = _same_runs(one, two)
                first = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
                one, two = one[order][first], two[order][first]
                marks = (np.bincount(same) > 1).astype(np.uint8) * 2
                bucket = (one >> np.uint64(20)) % np.uint64(buckets)
                deal = np.argsort(bucket, kind="stable")
                out.extend(_dealt(file, part, bucket[deal], one[deal], two[deal], marks[deal]))
        return pa.Table.from_batches(out, schema=_ENTRIES)
    return run


def _cut(window: int, key: str, key_type: pa.DataType):
    """Every document without the words of its repeated windows."""
    schema = pa.schema([("key", key_type), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_text", pa.string()), ("repeats", pa.list_(pa.list_(pa.int64())))])

    def run(files: pa.Table, answers: pa.Table) -> pa.Table:
        met = _by_part(answers, np.uint64)
        out = []
        for file in files.column(0).to_pylist():
            for part, table in _parts(file):
                words = Words(table.column("text"))
                n = len(words.flat)
                covered = np.zeros(n, dtype=bool)
                if part in met:
                    good = np.frombuffer(b"".join(r["one"] for r in met[part]), dtype=np.uint64)
                    other = np.frombuffer(b"".join(r["two"] for r in met[part]), dtype=np.uint64)
                    begin = words.fitting(window, window)
                    one, two = words.rolling(window, 0)[begin], words.rolling(window, 1)[begin]
                    near = np.isin(one, good)
                    begin, one, two = begin[near], one[near], two[near]
                    wanted = set(zip(good.tolist(), other.tolist()))
                    begin = begin[np.fromiter(((a, b) in wanted for a, b in zip(one.tolist(), two.tolist())), dtype=bool, count=len(begin))]
                    edge = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, begin + window, -1)
                    covered = np.cumsum(edge)[:n] > 0
                upto = np.r_[0, np.cumsum(covered)]
                removed = upto[words.ends] - upto[words.starts]
                kept = pa.array(~covered)
                lengths = words.ends - words.starts - removed
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), words.flat.filter(kept))
                spans = []
                for start, end, gone in zip(words.starts, words.ends, removed):
                    if not gone:
                        spans.append([])
                        continue
                    turns = np.flatnonzero(np.diff(np.r_[False, covered[start:end], False].astype(np.int8)))
                    spans.append(turns.reshape(-1, 2).tolist())
                out.append(pa.Table.from_arrays([
                    table.column("key").combine_chunks(), pa.array((words.ends - words.starts).astype(np.int64)), pa.array(removed),
                    pc.binary_join(lists, " "), pa.array(spans, type=schema.field("repeats").type)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, n_words, n_removed, kept_text, repeats) for every row of a frame.

    A window is ``window`` consecutive words of one document, as they stand
    between ASCII white space; each word covered by a window that also starts
    anywhere else, in the same document included, is removed. ``repeats`` are
    the maximal removed spans as [start, end) in words, and ``kept_text`` the
    other words joined by one space. A null text has no words. Repeated rows
    are repeats of each other. Rows without a key are handled like any other,
    an empty table gives an empty result; other columns are not touched.
    """
    spark, block = df.sparkSession, (window + 1) // 2
    kind = df.schema[key].dataType
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).alias("n_bytes"))
    folder = stage(rows, "repeats-texts", GROUP_BYTES)
    files = staged_files(spark, folder)
    if not files.take(1):
        return spark.createDataFrame([], f"{key} {kind.simpleString()}, n_words long, n_removed long, kept_text string, repeats array<array<bigint>>")
    total = spark.read.schema("n_bytes int").parquet(folder).agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    # A file is the unit of work; with more partitions than files few files share one.
    parts = SPREAD * files.count()
    files = files.repartition(parts, "file")

    def met(entries: DataFrame, check) -> DataFrame:
        found = entries.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(check, _ENTRY)
        return materialize(found, "repeats-met").repartition(parts, "file").groupBy("file")

    anchors = met(_anchors(staged_files(spark, folder), block, window, buckets), _met_anchors)
    around = files.groupBy("file").cogroup(anchors).applyInArrow(_windows(block, window, buckets), _ENTRY)
    repeated = met(around, _met_windows)
    from pyspark.sql.pandas.types import to_arrow_type

    cut = _cut(window, key, to_arrow_type(kind))
    found = files.groupBy("file").cogroup(repeated).applyInArrow(
        cut, f"key {kind.simpleString()}, n_words long, n_removed long, kept_text string, repeats array<array<bigint>>")
    return found.withColumnRenamed("key", key)
