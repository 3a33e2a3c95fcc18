"""Web archives, and the merge of their indexes to capture histories.

Pages are written as WARC records, one gzip member each, in archives of
bounded size. Of pages with equal payloads one is a response, the others
revisit it. Every archive that is read back gives a run of index entries,
sorted by URL key, time and record; runs are cut into blocks and stored.

The runs merge by ranges of keys. A range gets its part of every block,
ordered by the block's first entry, and merges the runs in a loser tree: a
block is taken up when the merge comes to its first entry, so that a task
holds one block of each run at a time and not the range.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm.shared import open_store
from medloom.llm.text import text_of
from medloom.sources.storage import materialize, scratch_path

# Payloads below it are never revisits.
LEAST_REVISIT = 1000
ARCHIVE_BYTES = 64 << 20
# Entries of one run, of one block of a run, and of one range of the merge.
RUN_ENTRIES = 200_000
BLOCK_ENTRIES = 2000
RANGE_ENTRIES = 1_000_000
LEAST_RANGES = 16
# Sampled keys for each range; they place the ranges' borders and nothing else.
SAMPLED = 50
# Captures have no time of their own in the table; they follow each other by the second from here.
FIRST_CAPTURE = datetime(2020, 1, 1, tzinfo=timezone.utc)
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY = ("url_key string, captured string, record string, run string, url string, record_type string, digest string, "
          "payload_bytes long, refers_to string, archive string, offset long")
_FIELDS = [f.split()[0] for f in _ENTRY.split(", ")]
_BLOCK = ("range int, first_url_key string, first_captured string, first_record string, run string, "
          f"entries array<struct<{', '.join(f.replace(' ', ':') for f in _ENTRY.split(', '))}>>")


def url_key(url: str | None) -> str:
    """Host from its end, then path and query, without scheme, user, www, default port and fragment, in lower case."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").lower()
        port = parts.port
    except ValueError:
        return (url or "").strip().lower()
    host = re.sub(r"^www\d*\.", "", host)
    if not host:
        return (url or "").strip().lower()
    shown = f":{port}" if port and port not in (80, 443) else ""
    query = "&".join(sorted(parts.query.lower().split("&"))) if parts.query else ""
    path = parts.path.lower().rstrip("/") or "/"
    return ",".join(reversed(host.split("."))) + shown + ")" + path + (f"?{query}" if query else "")


def _record(row: dict) -> bytes:
    """One record; a revisit holds the HTTP head without the payload."""
    payload = row["html"].encode() if row["refers_to"] is None else b""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if row['refers_to'] is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{row['record']}>", f"WARC-Date: {row['captured']}",
        "WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", row["url"] or ""), f"WARC-Payload-Digest: sha1:{row['digest']}",
    ]
    if row["refers_to"] is not None:
        lines += [f"WARC-Refers-To: <urn:page:{row['refers_to']}>", f"WARC-Profile: {_REVISIT}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(head) + len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + head + payload + b"\r\n\r\n"


def _captured(record: int | None) -> str:
    return (FIRST_CAPTURE + timedelta(seconds=(record or 0) % 3_000_000_000)).strftime("%Y-%m-%dT%H:%M:%SZ")


def roles(pages: DataFrame, key: str, html: str, least: int = LEAST_REVISIT) -> DataFrame:
    """(digest, payload_bytes, keeper) of payloads that repeat; the keeper is the page with the largest key."""
    body = text_of(html)
    short = pages.select(F.col(key).alias("key"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("payload_bytes"))
    many = short.filter(F.col("payload_bytes") >= least).groupBy("digest", "payload_bytes").agg(
        F.max("key").alias("keeper"), F.count("*").alias("n"))
    return many.filter("n > 1 AND keeper IS NOT NULL").drop("n")


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every page; (archive, records, bytes) of what was written.

    A task writes archives of its own under names no other attempt uses; only
    those in the returned frame count, so that a lost or repeated task leaves
    at most files that nothing refers to.
    """
    body = text_of(html)
    rows = pages.select(F.col(key).cast("long").alias("record"), F.col(url).alias("url"), body.alias("html"),
                        F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("payload_bytes"))
    repeated = materialize(roles(pages, key, html), "repeated-payloads")
    if repeated.take(1):
        rows = rows.join(repeated, ["digest", "payload_bytes"], "left")
    else:
        rows = rows.withColumn("keeper", F.lit(None).cast("long"))
    # A page without a key cannot be the one others revisit, but it can revisit.
    refers = F.when(~F.col("keeper").eqNullSafe(F.col("record")), F.col("keeper"))
    rows = rows.select("record", "url", "html", "digest", "payload_bytes", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        store.create_dir(root)
        out, written = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    written.append([f"{folder}/{name}", 0, 0])
                row["captured"] = _captured(row["record"])
                row["record"] = "none" if row["record"] is None else row["record"]
                member = gzip.compress(_record(row), 4, mtime=0)
                out.write(member)
                written[-1][1] += 1
                written[-1][2] += len(member)
                if written[-1][2] >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        columns = list(zip(*written)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))],
                                         names=["archive", "records", "bytes"])

    return materialize(rows.mapInArrow(run, "archive string, records long, bytes long"), "archives")


def read_records(data) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of every record of an archive of gzip members."""
    import zlib

    buffer, offset = b"", 0
    while True:
        inflate, parts, used = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not buffer:
                buffer = data.read(1 << 20)
                if not buffer:
                    break
            parts.append(inflate.decompress(buffer))
            used += len(buffer) - len(inflate.unused_data)
            buffer = inflate.unused_data if inflate.eof else b""
        if not used:
            return
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        yield offset, headers, rest[:int(headers["content-length"])]
        offset += used


def _entry(run: str, archive: str, offset: int, headers: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"(?im)^content-length: (\d+)", head).group(1))
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response":
        if len(payload) != stated or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"record at {offset} of {archive} does not match its digest")
    page = re.compile(r"<urn:page:(.*)>")
    refers = page.match(headers["warc-refers-to"]).group(1) if "warc-refers-to" in headers else None
    url = headers["warc-target-uri"]
    return (url_key(url), headers["warc-date"], page.match(headers["warc-record-id"]).group(1).zfill(20), run, url, kind,
            digest, stated, refers, archive, offset)


def index_runs(archives: DataFrame, run_entries: int = RUN_ENTRIES, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Sorted runs of index entries, a row for each block of a run."""
    schema = _arrow_blocks()

    def run(batches):
        number, held = 0, []
        task = TaskContext.get().partitionId()

        def blocks():
            name = f"{task:06d}-{number:04d}"
            ordered = sorted((*e[:3], name, *e[4:]) for e in held)
            for start in range(0, len(ordered), block_entries):
                part = ordered[start:start + block_entries]
                yield pa.RecordBatch.from_pylist([{
                    "range": 0, "first_url_key": part[0][0], "first_captured": part[0][1], "first_record": part[0][2],
                    "run": name, "entries": [dict(zip(_FIELDS, e)) for e in part]}], schema=schema)

        for batch in batches:
            for archive in batch.column(0).to_pylist():
                store, path = open_store(archive)
                with store.open_input_stream(path, compression=None) as data:
                    for offset, headers, block in read_records(data):
                        held.append(_entry("", archive, offset, headers, block))
                        if len(held) >= run_entries:
                            yield from blocks()
                            number, held = number + 1, []
        if held:
            yield from blocks()

    n = max(1, archives.count())
    return materialize(archives.select("archive").repartition(n, "archive").mapInArrow(run, _BLOCK), "runs")


def _arrow_blocks() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    entry = pa.struct([(f.split()[0], kinds[f.split()[1]]) for f in _ENTRY.split(", ")])
    return pa.schema([("range", pa.int32()), ("first_url_key", pa.string()), ("first_captured", pa.string()),
                      ("first_record", pa.string()), ("run", pa.string()), ("entries", pa.list_(entry))])


class LoserTree:
    """Merges sorted runs; each inner node holds the loser of its match, so that a step replays one path."""

    def __init__(self):
        self.size, self.runs, self.heads, self.losers, self.winner = 1, [None], [None], [0, 0], 0

    def add(self, run: Iterator[tuple]) -> None:
        """Take up one more run; free leaves are used first."""
        head = next(run, None)
        if head is None:
            return
        try:
            leaf = self.heads.index(None)
        except ValueError:
            leaf = self.size
            self.heads += [None] * self.size
            self.runs += [None] * self.size
            self.size *= 2
        self.heads[leaf], self.runs[leaf] = head, run
        self._build()

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def _build(self) -> None:
        winners = [0] * self.size + list(range(self.size))
        self.losers = [0] * max(2, self.size)
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._less(a, b) else (b, a)
        self.winner = winners[1]

    def peek(self) -> tuple | None:
        return self.heads[self.winner]

    def pop(self) -> tuple:
        champion = self.winner
        out = self.heads[champion]
        self.heads[champion] = next(self.runs[champion], None)
        node = (champion + self.size) // 2
        while node >= 1:
            if not self._less(champion, self.losers[node]):
                champion, self.losers[node] = self.losers[node], champion
            node //= 2
        self.winner = champion
        return out


def _cut_blocks(borders: list[tuple]):
    """Blocks cut at the borders of the ranges."""
    schema = _arrow_blocks()

    def run(batches):
        for batch in batches:
            out = []
            for block in batch.to_pylist():
                entries = block["entries"]
                keys = [(e["url_key"], e["captured"], e["record"]) for e in entries]
                cuts = [0, *(bisect_left(keys, b) for b in borders), len(keys)]
                for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if a < b:
                        out.append({"range": number, "first_url_key": keys[a][0], "first_captured": keys[a][1],
                                    "first_record": keys[a][2], "run": block["run"], "entries": entries[a:b]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def _merged(batches):
    """Entries of each range in order; blocks come by range and first entry."""
    schema = pa.schema([("range", pa.int32()), ("place", pa.int64()), *_arrow_blocks().field("entries").type.value_type])
    tree, current, place, out = LoserTree(), None, 0, []

    def until(border: tuple | None):
        nonlocal place
        while (head := tree.peek()) is not None and (border is None or head[:4] < border):
            entry = tree.pop()
            out.append({"range": current, "place": place, **dict(zip(_FIELDS, entry))})
            place += 1
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()

    for batch in batches:
        for block in batch.to_pylist():
            if block["range"] != current:
                yield from until(None)
                tree, current, place = LoserTree(), block["range"], 0
            yield from until((block["first_url_key"], block["first_captured"], block["first_record"], block["run"]))
            tree.add(iter([tuple(e[f] for f in _FIELDS) for e in block["entries"]]))
    yield from until(None)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def merge_runs(runs: DataFrame, range_entries: int = RANGE_ENTRIES, least_ranges: int = LEAST_RANGES) -> DataFrame:
    """All entries with (range, place): by these two, captures stand in the order of URL key, time and record.

    Entries of one URL may go on in the next range, so a hot URL is no hot task.
    """
    total = runs.agg(F.sum(F.size("entries"))).first()[0] or 0
    ranges = max(least_ranges, -(-total // range_entries))
    keys = runs.select(F.explode("entries").alias("e")).select("e.url_key", "e.captured", "e.record")
    sampled = keys.sample(min(1.0, SAMPLED * ranges / max(total, 1)), 5).limit(2 * SAMPLED * ranges)
    ordered = sorted(tuple(r) for r in sampled.collect())
    borders = sorted({ordered[i * len(ordered) // ranges] for i in range(1, ranges)}) if ordered else []
    cut = runs.mapInArrow(_cut_blocks(borders), _BLOCK)
    dealt = cut.repartition(ranges, "range").sortWithinPartitions("range", "first_url_key", "first_captured", "first_record", "run")
    return dealt.mapInArrow(_merged, f"range int, place long, {_ENTRY}")


def archive_and_index(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write pages as archives, read them back and merge their indexes.

    One row for each page: range, place, url_key, captured, key, record_type,
    digest, payload_bytes, refers_to (a key, null for a response), archive and
    offset. A null html is an empty payload; a null URL gives the empty URL
    key; a null key is never the response of others. Equal payloads below
    1000 bytes, empty ones included, are all responses. Repeated rows with
    one key: the copies of the kept page are responses too. An empty table
    gives an empty result; other columns are not touched.
    """
    spark: SparkSession = pages.sparkSession
    folder = scratch_path(spark, "warc")
    archives = write_archives(pages, folder, key, url, html)
    found = merge_runs(index_runs(archives))
    return found.select(
        "range", "place", "url_key", "captured", F.when(~F.endswith("record", F.lit("none")), F.col("record").cast("long")).alias(key),
        "record_type", "digest", "payload_bytes", F.col("refers_to").cast("long").alias("refers_to"), "archive", "offset")


SQL = f"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_REVISIT} AND page_id <> keeper THEN keeper END AS refers_to
FROM k
"""
