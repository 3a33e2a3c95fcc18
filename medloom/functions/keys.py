"""Content-derived keys.

A key is the first 60 bits of an md5 over the unit-separated text of its
parts: deterministic, non-negative and the same in any engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "\u001f"


def _text(part: Column | str) -> Column:
    column = F.col(f"`{part}`") if isinstance(part, str) else part
    return F.coalesce(column.cast("string"), F.lit(""))


def digest(parts: list[Column | str]) -> Column:
    """md5 of the parts; NULL counts as the empty string."""
    return F.md5(F.concat_ws(SEPARATOR, *[_text(part) for part in parts]))


def content_key(parts: list[Column | str], salt: str | None = None) -> Column:
    """60-bit key of the parts, made site-specific by ``salt``."""
    salted = [*parts, F.lit(salt)] if salt is not None else list(parts)
    return F.conv(F.substring(digest(salted), 1, 15), 16, 10).cast("bigint")


def site_key(column: str, site: str) -> Column:
    """Globally unique form of a site-local key; NULL stays NULL."""
    return F.when(F.col(column).isNotNull(), content_key([column], site))


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """md5 of a whole row."""
    return digest(list(columns or df.columns))


def name_key(name: Column) -> Column:
    """Positive 63-bit id of a name: the leading 8 bytes of its sha-256."""
    hexed = F.sha2(name, 256)
    # Clearing the sign bit is a lookup on the first hex digit.
    lead = F.translate(F.substring(hexed, 1, 1), "89abcdef", "01234567")
    value = F.conv(F.concat(lead, F.substring(hexed, 2, 15)), 16, 10).cast("bigint")
    return F.when(value == 0, F.lit(1).cast("bigint")).otherwise(value)


def mark_unique(df: DataFrame, key: str) -> DataFrame:
    """State that no two rows share the key. The fact is kept with the column, also in a written table.

    It holds for this very frame; a step that repeats or unites rows has to
    drop it (``unmarked``).
    """
    return _marked(df, key, True)


def unmarked(df: DataFrame, key: str) -> DataFrame:
    return _marked(df, key, False)


def known_unique(df: DataFrame, key: str) -> bool:
    return bool(df.schema[key].metadata.get("unique", False))


def _marked(df: DataFrame, key: str, unique: bool) -> DataFrame:
    return df.withMetadata(key, {**df.schema[key].metadata, "unique": unique})
