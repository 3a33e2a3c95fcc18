"""Reading delivered and vocabulary files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom import schema
from medloom.sources.encoding import Encoding, encoding_of
from medloom.sources.records import has_open_quotes, split_records, values_of
from medloom.sources.storage import materialize

NULL_WORDS = ["NULL", "null"]
_CORRUPT = "_corrupt_record"
BLOCK_BITS = 15
# Code points that no text holds.
_NO_SEPARATOR = "\uffff\ufffe\uffff"


def clean_name(name: str) -> str:
    """Lower-case column name of letters, digits and underscores."""
    return re.sub(r"\W", "", name).lower()


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def null_words(df: DataFrame) -> DataFrame:
    """The words NULL and null become missing values; other spellings stay."""
    return df.select(*[
        F.when(~F.col(f"`{c}`").isin(NULL_WORDS), F.col(f"`{c}`")).alias(c) for c in df.columns
    ])


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A delivered Parquet table as text with clean names."""
    return null_words(clean_names(as_text(spark.read.parquet(path))))


def csv_header(spark: SparkSession, path: str, separator: str = ",", encoding: str | None = None) -> list[str]:
    """Column names as delivered; a name in quotes may hold line breaks."""
    found = encoding_of(spark, path, encoding)
    western = found.name == "windows-1252"
    options = {"header": True, "sep": separator, "encoding": "ISO-8859-1" if western else found.name, "escape": '"',
               "inferSchema": False, "multiLine": True}
    return [c.removeprefix("\ufeff") for c in spark.read.options(**options).csv(path).columns]


def read_csv(
    spark: SparkSession, path: str, separator: str = ",", encoding: str | None = None, strict: bool = False,
    names: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A delivered CSV table as text, and the lines that are not records.

    Plain and gzip files, or folders of them, with a header unless ``names``
    are given. The encoding is found from a sample unless it is named. Files
    are read by line and stay split over tasks. Records may go over lines and
    blocks and have any length (``records.split_records``); a quote that opens
    a value and never soundly closes it costs its own line only. Short records
    are filled with NULL. A line with too many values or a quote left open is
    rejected, and it alone; with ``strict`` it fails the job instead.

    Where no line leaves a quote open, which one look at the lines tells, every
    line is a record. Otherwise the lines are written once, so that all passes
    see the same ones.
    """
    found = encoding_of(spark, path, encoding)
    header = names or csv_header(spark, path, separator, encoding)
    lines = _lines(spark, path, found)
    if found.name == "UTF-8" and not has_open_quotes(lines, separator):
        records = _parsed(_single_lines(spark, path, names is None, found), header, separator)
    else:
        lines = materialize(lines, "csv-lines")
        whole = split_records(lines, len(header), separator, names is None, found.line_end)
        records = _parsed(whole, header, separator)
    reason = rejection(F.col("line"), F.col("values")[_CORRUPT].isNotNull(), len(header), separator)
    values = [F.col("values")[_value(i)].alias(c) for i, c in enumerate(header)]
    rejects = records.filter(reason.isNotNull()).select("line", reason.alias("reason"))
    if strict:
        checked = F.when(reason.isNotNull(), F.raise_error(reason)).otherwise(F.col("values")[_value(0)])
        good = records.select(checked.alias(header[0]), *values[1:])
    else:
        good = records.filter(reason.isNull()).select(*values)
    return null_words(clean_names(good)), rejects


def _lines(spark: SparkSession, path: str, encoding: Encoding) -> DataFrame:
    """(file, block, at, line): ``at`` grows by one from line to line of a block of a file.

    A block is a run of at most ``1 << BLOCK_BITS`` lines of what one task reads
    of a file, so what sorts a block's lines stays small; blocks are numbered in
    the file's order.
    """
    lines = spark.read.option("lineSep", encoding.separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), encoding.text("value").alias("line"))
    # The low 33 bits of the id count the lines of a task.
    run = F.shiftright(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)), BLOCK_BITS)
    return lines.select("file", (F.shiftleft("start", 33 - BLOCK_BITS) + run).alias("block"), "at", "line")


def _single_lines(spark: SparkSession, path: str, has_header: bool, encoding: Encoding) -> DataFrame:
    """(line) of files whose lines are records: read as one column, so that the reader takes each file's header away."""
    options = {"sep": _NO_SEPARATOR, "quote": "", "escape": "", "header": has_header, "lineSep": encoding.line_end}
    lines = spark.read.schema("line STRING").options(**options).csv(path)
    return lines.select(F.regexp_replace(encoding.text("line"), "\r\\z", "").alias("line")).filter(F.trim("line") != "")


def _value(place: int) -> str:
    """Column names may be anything, so parsed values go by their place."""
    return f"_{place}"


def _parsed(rows: DataFrame, header: list[str], separator: str) -> DataFrame:
    layout = ", ".join(f"{_value(i)} STRING" for i in range(len(header))) + f", {_CORRUPT} STRING"
    # With multiLine, line breaks within values stay as they are.
    options = {"sep": separator, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "multiLine": "true"}
    return rows.withColumn("values", F.from_csv(F.col("line"), layout, options))


def rejection(line: Column, incomplete: Column, width: int, separator: str = ",") -> Column:
    """Why a record is none; NULL if it is one or is only short.

    A quote within a value is text, as in 5" tall; one that opens a value and
    does not close is not. A value that goes on behind its closing quote is
    read as well as may be, if the record then has the header's width.
    """
    # The struct is worked out once; Spark tries the branches in order.
    return F.transform(F.array(values_of(line, separator)), lambda v: (
        F.when(v["opens"], F.lit("open quote")).when(v["sound"] & (v["separators"] >= width), F.lit("too many values"))
        .when(~v["sound"] & incomplete, F.lit("open quote"))
    ))[0]


def read_delivery_file(spark: SparkSession, path: str, **options) -> DataFrame:
    """Text table from a file or folder named by its format."""
    name = path.rstrip("/").lower()
    if name.endswith((".csv", ".csv.gz")):
        return read_csv(spark, path, **options)[0]
    if name.endswith(".parquet"):
        return read_parquet(spark, path)
    raise ValueError(f"unsupported delivery file {path}")


def read_vocabulary(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A tab-separated vocabulary file in the model's types; quotes are text."""
    options = {"sep": "\t", "header": True, "quote": "", "escape": "", "inferSchema": False}
    text = clean_names(spark.read.options(**options).csv(path))

    def column(field: T.StructField) -> Column:
        value = F.col(field.name) if field.name in text.columns else F.lit(None).cast("string")
        if isinstance(field.dataType, T.DateType):
            return F.to_date(value, "yyyyMMdd").alias(field.name)
        return value.try_cast(field.dataType).alias(field.name)

    return text.select(*[column(f) for f in schema.layout(table)])
