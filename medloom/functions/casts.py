"""Lenient text casts.

Deliveries arrive as text. A value that cannot be read becomes NULL and never
fails the job. Numbers follow round-half-up reading of decimals ('12.7' is 13
as a whole number); dates accept y-m-d and y/m/d, timestamps also a time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Java reads '5d' as a number; '1e3' and 'inf' must pass.
_TYPE_SUFFIX = r"[0-9.][dDfF]\s*$"
_SLASH_DATE = r"^(\s*\d{4})/(\d{1,2})/(\d{1,2})"
_DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}.*)?$"
_LONG_LIMIT = 9223372036854774784.0  # largest double below 2^63

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

# strptime directive -> (padded, free-width) pattern letters.
_DIRECTIVES = {
    "Y": ("yyyy", "yyyy"), "y": ("yy", "yy"), "m": ("MM", "M"), "d": ("dd", "d"),
    "H": ("HH", "H"), "I": ("hh", "h"), "M": ("mm", "m"), "S": ("ss", "s"),
    "f": ("SSSSSS", "SSSSSS"), "j": ("DDD", "D"), "p": ("a", "a"), "b": ("MMM", "MMM"),
    "B": ("MMMM", "MMMM"), "a": ("E", "E"), "A": ("EEEE", "EEEE"),
}


def as_double(text: Column) -> Column:
    return F.when(~text.rlike(_TYPE_SUFFIX), text.try_cast("double"))


def as_long(text: Column) -> Column:
    rounded = F.round(as_double(text))
    in_range = F.abs(rounded) <= F.lit(_LONG_LIMIT)
    # Plain whole numbers, nearly all values, never reach the second reading.
    return F.coalesce(text.try_cast("bigint"), F.when(in_range, rounded.try_cast("bigint")))


def double_to_long(value: Column) -> Column:
    """Whole number nearest to a double, ties to even."""
    nearest = F.rint(value)
    return F.when(F.abs(nearest) <= F.lit(_LONG_LIMIT), nearest.try_cast("bigint"))


def _iso(text: Column) -> Column:
    return F.regexp_replace(text, _SLASH_DATE, "$1-$2-$3")


def as_timestamp(text: Column) -> Column:
    iso = _iso(text)
    return F.when(iso.rlike(_DATE_SHAPE), iso.try_cast("timestamp_ntz"))


def as_date(text: Column) -> Column:
    return as_timestamp(F.trim(text)).cast("date")


def spark_pattern(strptime: str) -> str:
    """Datetime pattern for a strptime format.

    A field takes any width unless it touches the next one, as in ``%Y%m%d``.
    """
    tokens = re.findall(r"%(.)|([^%]+)", strptime)
    out = []
    for index, (directive, literal) in enumerate(tokens):
        if literal:
            out.append("".join(f"'{c}'" if c.isalpha() else ("''" if c == "'" else c) for c in literal))
            continue
        if directive not in _DIRECTIVES:
            raise ValueError(f"unsupported date directive %{directive}")
        neighbours = tokens[max(index - 1, 0):index] + tokens[index + 1:index + 2]
        touching = any(not text for _, text in neighbours)
        padded, free = _DIRECTIVES[directive]
        out.append(padded if touching else free)
    return "".join(out)


def _shape(strptime: str) -> str:
    """Regular expression for text that may be in a strptime format."""
    widths = {"Y": r"\d+", "f": r"\d+", "p": r"\D+", "b": r"\D+", "B": r"\D+", "a": r"\D+", "A": r"\D+", "j": r"\d{1,3}"}
    tokens = re.findall(r"%(.)|([^%]+)", strptime)
    body = "".join(re.escape(literal) if literal else widths.get(directive, r"\d{1,2}") for directive, literal in tokens)
    return f"^{body}$"


def parse_timestamp(text: Column, strptime: str) -> Column:
    """Parse by a site's format, without regard to the session time zone.

    The text is read as UTC and counted from the epoch, so local clock changes
    neither shift nor lose a value. Text of another shape is not tried: a
    failed parse costs far more than a look at the shape.
    """
    pattern = spark_pattern(strptime)
    instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{pattern} Z"))
    moment = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))
    return F.when(text.rlike(_shape(strptime)), moment)


def cast_text(text: Column, kind: str) -> Column:
    """Lenient cast of text to one of the model's types."""
    if kind == "string":
        return text
    return {"bigint": as_long, "double": as_double, "date": as_date, "timestamp_ntz": as_timestamp}[kind](text)


def cast_temporal(text: Column, kind: str, strptime: str, default: Column) -> Column:
    """The site's format first, then the plain forms, then the default."""
    readers = [as_date(text) if kind == "date" else as_timestamp(text), default]
    if strptime:
        readers.insert(0, parse_timestamp(text, strptime).cast(kind))
    return F.coalesce(*readers)


def whole_number(df: DataFrame, column: str) -> Column:
    """A column as a whole number; text is read leniently, numbers are taken as they are."""
    if df.schema[column].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        return F.col(column).cast("bigint")
    return as_long(F.col(column).cast("string"))
