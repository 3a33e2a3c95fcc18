"""Fill-in-the-middle by rotating segments of a text in place.

A text of n lines is cut after two of its line ends into prefix, middle and
suffix. The sentinels go into a byte array in the order of the segments, and
the segments change places by rotation: a rotation reverses both of its parts
and then the whole, which needs no second copy of the text. The same rotation
with the parts exchanged restores the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE, SPM_RATE, SEED = 100, 50, 7
# Bytes exchanged at once by a reversal.
BLOCK = 1 << 16


def reverse(buffer: bytearray, start: int, end: int) -> None:
    """Reverse ``buffer[start:end]`` in place, a block from either end at a time."""
    while end - start > 1:
        size = min(BLOCK, (end - start) // 2)
        left, right = buffer[start:start + size], buffer[end - size:end]
        left.reverse()
        right.reverse()
        buffer[start:start + size], buffer[end - size:end] = right, left
        start, end = start + size, end - size


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange ``buffer[start:cut]`` and ``buffer[cut:end]``."""
    reverse(buffer, start, cut)
    reverse(buffer, cut, end)
    reverse(buffer, start, end)


def line_ends(data: bytes | bytearray) -> np.ndarray:
    """Where each line ends; a last line may stand without its line feed."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    if len(data) and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    return ends


def draws(key: str, seed: int = SEED) -> list[int]:
    """Four numbers below 2**32 that depend on the key alone."""
    found = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(found[8 * i:8 * i + 8], 16) for i in range(4)]


def _holds_sentinel(text: str) -> bool:
    return PREFIX in text or SUFFIX in text or MIDDLE in text


class Cut:
    """How one text is transformed: its form and where its segments end, in bytes."""

    def __init__(self, key: str, text: str, rate: int, spm_rate: int, seed: int):
        self.data = bytearray(text, "utf-8")
        ends = line_ends(self.data)
        self.n = len(ends)
        one, two, chance, kind = draws(key, seed)
        if not text or _holds_sentinel(text) or chance % 100 >= rate:
            self.form, self.first, self.second = "plain", 0, 0
            return
        self.form = "spm" if kind % 100 < spm_rate else "psm"
        low, high = sorted((one % (self.n + 1), two % (self.n + 1)))
        self.first, self.second = (int(ends[i - 1]) if i else 0 for i in (low, high))

    def segment_chars(self) -> tuple[int, int]:
        first = len(self.data[:self.first].decode())
        return first, len(self.data[self.first:self.second].decode())

    def arrange(self) -> bytearray:
        """The transformed text; takes the byte array over."""
        buffer = self.data
        if self.form != "plain":
            # Prefix, middle, suffix, each behind its sentinel; the later ones go in first.
            buffer[self.second:self.second] = SUFFIX.encode()
            buffer[self.first:self.first] = MIDDLE.encode()
            buffer[0:0] = PREFIX.encode()
            middle, suffix = self.first + 3, self.second + 6
            rotate(buffer, middle if self.form == "psm" else 0, suffix, len(buffer))
        return buffer


def restore_text(output: str, form: str) -> str:
    """The text that a transformed one was made from."""
    if form == "plain":
        return output
    buffer = bytearray(output, "utf-8")
    middle = buffer.index(MIDDLE.encode())
    if form == "psm":
        # <P>prefix <S>suffix <M>middle: suffix and middle go back.
        start, cut = buffer.index(SUFFIX.encode()), middle
    else:
        # <S>suffix <P>prefix <M>middle: the suffix goes back behind both.
        start, cut = 0, buffer.index(PREFIX.encode())
    rotate(buffer, start, cut, len(buffer))
    for sentinel in (PREFIX, MIDDLE, SUFFIX):
        at = buffer.index(sentinel.encode())
        del buffer[at:at + 3]
    return buffer.decode()


def transform(
    df: DataFrame, key: str = "doc_id", text: str = "text", rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED,
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) for every row.

    ``rate`` per cent of the texts are transformed, ``spm_rate`` per cent of
    these with the suffix first; both follow from the key and ``seed``. A text
    that is empty or holds a sentinel stays plain, with null lengths. A null
    text is empty; a null key draws as an empty one. Equal rows get equal
    results, an empty table gives an empty result, and further columns are not
    carried. One text at a time is taken apart, whatever its length.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name, given in zip(batch.column(1), batch.column(2)):
                cut = Cut(name.as_py(), given.as_py(), rate, spm_rate, seed)
                sizes = (None, None) if cut.form == "plain" else cut.segment_chars()
                found.append((cut.n, cut.form, *sizes, cut.arrange().decode()))
            n, form, first, second, output = zip(*found) if found else [()] * 5
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(first, pa.int64()),
                pa.array(second, pa.int64()), pa.array(output, pa.string()),
            ], names=["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = df.select(
        F.col(key).alias("key"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    layout = f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, layout).withColumnRenamed("key", key)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text before its transformation, as a column; null where either is null."""
    @F.arrow_udf("string")
    def back(output: pa.Array, form: pa.Array) -> pa.Array:
        found = []
        for text, kind in zip(output, form):
            whole = text.is_valid and kind.is_valid
            found.append(restore_text(text.as_py(), kind.as_py()) if whole else None)
        return pa.array(found, pa.string())

    return back(output, form)


SQL = """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS s FROM documents),
l AS (
  SELECT *, regexp_extract_all(s, '[^\\n]*\\n|[^\\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM t),
d AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN s = '' OR contains(s, '<P>') OR contains(s, '<S>') OR contains(s, '<M>') THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM l),
c AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(u[greatest(a, b) + 1:], '') AS x FROM d)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN s WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
              ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(s) AS restored_sha256
FROM c
"""
