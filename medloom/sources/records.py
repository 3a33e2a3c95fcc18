"""Records of delimited files whose quoted values hold line breaks.

A file is read by line and stays split. What a line does to the state of a
parser, outside or inside a quoted value, follows from the line alone, so the
states combine over the lines of a block, then over the blocks of a file, and
every block finds its records by itself.

A line that leaves a quoted value open begins a record if the next line that
ends a quoted value does so soundly (the quote stands before a separator or at
the end) and the record then has no more values than the header. Otherwise its
quote is a stray one: the line stands alone, and the next one is outside.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom.operators.joins import lookup_join
from medloom.sources.storage import materialize

QUOTE = '"'
# Lines with quotes that a task sorts; a block has fewer lines (``ingest``).
EVENTS_PER_TASK = 250_000


# Noncharacters: two quotes that follow each other, and a value with the separator behind it.
_PAIR, _VALUE = "\ufffe", "\uffff"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used or the optimizer moves filters."""
    return F.transform(F.array(value), use)[0]


def _outside(text: Column, separator: str) -> Column:
    """Struct (opens, sound, separators) of a line that begins outside; pairs of quotes are marked in it.

    Sound values are taken off from the left. ``opens`` if what is left is a
    quoted value without its end, ``sound`` if it is a whole value;
    ``separators`` are those taken off.
    """
    sep = re.escape(separator)
    quoted, plain = f'{_PAIR}*"[^"]*"|{_PAIR}+', f'(?!["{_PAIR}])(?:(?!{sep}).)*+' if len(separator) > 1 else f'(?!["{_PAIR}])[^{sep}]*'

    def judged(cut: Column) -> Column:
        return _once(F.replace(cut, F.lit(_VALUE), F.lit("")), lambda left: F.struct(
            F.regexp_like(left, F.lit(f'^{_PAIR}*"[^"]*\\z')).alias("opens"),
            F.regexp_like(left, F.lit(f"(?s)^(?:{quoted}|{plain})\\z")).alias("sound"),
            (F.length(cut) - F.length(left)).cast("long").alias("separators")))

    return _once(F.regexp_replace(text, f"\\G(?:{quoted}|{plain}){sep}", _VALUE), judged)


def _marked(line: Column) -> Column:
    return F.replace(F.regexp_replace(line, "\r\\z", ""), F.lit('""'), F.lit(_PAIR))


def values_of(record: Column, separator: str) -> Column:
    """Struct (opens, sound, separators) of a whole record."""
    return _outside(_marked(record), separator)


def effects(line: Column, separator: str) -> Column:
    """Struct of what a line does to a parser.

    ``opens``: from outside, it leaves a quoted value open, ``before``
    separators in front of it. ``stops``: from inside, it ends the value and
    leaves none open, ``sound`` if well-formed. ``within``: separators between
    values from inside.
    """
    def told(text: Column) -> Column:
        inside = F.concat(F.lit(QUOTE), text)
        return _once(F.struct(_outside(text, separator).alias("o"), _outside(inside, separator).alias("i")), lambda x: F.struct(
            x["o"]["opens"].alias("opens"), x["o"]["separators"].alias("before"), (~x["i"]["opens"]).alias("stops"),
            x["i"]["sound"].alias("sound"), x["i"]["separators"].alias("within")))

    return _once(_marked(line), told)


def has_open_quotes(lines: DataFrame, separator: str) -> bool:
    """Whether any line leaves a quoted value open, as a record over several lines does."""
    quoted = lines.filter(F.contains("line", F.lit(QUOTE)))
    return not quoted.filter(values_of(F.col("line"), separator)["opens"]).isEmpty()


def split_records(lines: DataFrame, width: int, separator: str, header: bool, line_end: str = "\n") -> DataFrame:
    """(line) of each record of (file, block, at, line), without the header of each file.

    ``at`` grows from line to line of a block and is unique over all files;
    ``lines`` is a written table, so it does not change between the passes.
    Records may have any length. Blank lines are no records.
    """
    quoted = lines.filter(F.contains("line", F.lit(QUOTE)))
    # Generated, as a filter would be moved below and work out the regular expressions again.
    found = quoted.select("file", "block", "at", F.inline(F.filter(
        F.array(effects(F.col("line"), separator)), lambda e: e["opens"] | e["stops"] | (e["within"] > 0))))
    events = materialize(_states(found, width), "csv-events")
    blank = F.trim(F.regexp_replace("line", "\r\\z", "")) == ""
    blocks = lines.groupBy("file", "block").agg(
        F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.min(F.when(~blank, F.col("at"))).alias("text_at"))
    # Only the records and a few numbers for each block and file go on; no text.
    places = _places(events, blocks, header)
    inside = lookup_join(lines.drop("file"), places.select("at", "record"), "at", "inner", narrow=False)
    whole = inside.filter("record IS NOT NULL").groupBy("record").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "at", "line"))), lambda p: p["line"]), line_end).alias("line"))
    alone = lookup_join(lines.filter(~blank), places.select("at"), "at", "left_anti", narrow=False).select("line")
    return alone.unionByName(whole.select("line")).select(F.regexp_replace("line", "\r\\z", "").alias("line"))


def _states(events: DataFrame, width: int) -> DataFrame:
    """Where records begin and where they end; one row for each, and what a block does to the state.

    Windows run over the lines with quotes of one block, or over the blocks of
    one file.
    """
    events = materialize(events, "csv-quotes")
    # Dealt by their number: by their bytes, which are few, one task would sort many millions.
    events = events.repartition(events.count() // EVENTS_PER_TASK + 1, "file", "block")
    block = Window.partitionBy("file", "block").orderBy("at")
    upto, later = block.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("file", "block").orderBy(F.desc("at"))
    stop = F.when(F.col("stops"), F.struct(F.col("seen").alias("seen"), "sound", "block", "at"))
    placed = events.withColumn("seen", F.sum("within").over(upto)).withColumn(
        "next", F.last(stop, ignorenulls=True).over(later.rowsBetween(Window.unboundedPreceding, -1)))
    sums = events.groupBy("file", "block").agg(F.sum("within").alias("total")).withColumnsRenamed({"block": "b"})
    firsts = placed.filter("stops").groupBy("file", "block").agg(
        F.min(F.struct("at", "seen", "sound")).alias("stop")).withColumnsRenamed({"block": "b", "file": "f"})
    order = Window.partitionBy("file").orderBy("b")
    table = sums.join(firsts, (sums["file"] == firsts["f"]) & (sums["b"] == firsts["b"]), "left").select(
        "file", sums["b"], "total", "stop")
    table = table.withColumn("base", F.sum("total").over(order) - F.col("total"))
    ahead = F.when(F.col("stop").isNotNull(), F.struct(
        (F.col("base") + F.col("stop.seen")).alias("seen"), F.col("stop.sound").alias("sound"),
        F.col("b").alias("block"), F.col("stop.at").alias("at")))
    back = Window.partitionBy("file").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    table = table.withColumn("ahead", F.last(ahead, ignorenulls=True).over(back)).select("file", F.col("b").alias("block"), "base", "ahead")
    # A row for each block, so that the lines join it where they lie.
    table = materialize(table, "csv-ends")
    known = lookup_join(placed, table, ["file", "block"], "inner", narrow=False).withColumn("end", F.coalesce(
        F.when(F.col("next").isNotNull(), F.struct(
            (F.col("base") + F.col("next.seen")).alias("seen"), F.col("next.sound").alias("sound"),
            F.col("next.block").alias("block"), F.col("next.at").alias("at"))), F.col("ahead")))
    values = F.col("before") + 1 + F.col("end.seen") - F.col("base") - F.col("seen")
    fits = F.coalesce(F.col("opens") & F.col("end.sound") & (values <= width), F.lit(False))
    known = known.withColumn("fits", fits).filter("fits OR stops").select(
        "file", "block", "at", "stops", "fits", F.col("end.block").alias("end_block"), F.col("end.at").alias("end_at"))
    # From outside a line leads to `fits`, from inside to `not stops`: always the same, or the other one.
    known = known.withColumn("turns", (F.col("fits") & F.col("stops")).cast("int"))
    fixed = F.when(F.col("fits") != F.col("stops"), F.col("fits").cast("int"))
    known = known.withColumn("turned", F.sum("turns").over(upto)).withColumn("fixed", fixed)
    last = F.last(F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turned")), ignorenulls=True)
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("since", last.over(before))
    known = materialize(known, "csv-turns")
    # Numbers only, as a struct would be combined by a sort. `turned` never falls, so its greatest is the last one's.
    is_fixed = F.col("fixed").isNotNull()
    whole = known.groupBy("file", "block").agg(
        F.sum("turns").alias("turns"), F.max(F.when(is_fixed, 2 * F.col("at") + F.col("fixed"))).alias("last"),
        F.max(F.when(is_fixed, F.col("turned"))).alias("last_turned"))
    whole = whole.withColumn("out", (F.col("last") % 2 + F.col("turns") - F.col("last_turned")) % 2).withColumn(
        "flips", F.when(F.col("out").isNull(), F.col("turns")).otherwise(0))
    blocks = Window.partitionBy("file").orderBy("block")
    whole = whole.withColumn("flipped", F.sum("flips").over(blocks))
    set_ = F.last(F.when(F.col("out").isNotNull(), F.struct("out", "flipped")), ignorenulls=True).over(
        blocks.rowsBetween(Window.unboundedPreceding, -1))
    whole = whole.withColumn("set", set_)
    starts = whole.select("file", "block", ((
        F.coalesce(F.col("set.out"), F.lit(0)) + F.col("flipped") - F.col("flips")
        - F.coalesce(F.col("set.flipped"), F.lit(0))) % 2).alias("start"))
    state = F.when(F.col("since").isNotNull(), F.col("since.fixed") + F.col("turned") - F.col("turns") - F.col("since.turned")).otherwise(
        F.col("start") + F.col("turned") - F.col("turns")) % 2
    return known.join(starts, ["file", "block"]).filter(F.col("fits") & (state == 0)).select(
        "file", "block", "at", "end_block", "end_at")


def _places(records: DataFrame, blocks: DataFrame, header: bool) -> DataFrame:
    """(at, record) of all lines of records over several lines, and of headers, whose record is null."""
    blocks = materialize(blocks, "csv-blocks")
    spans = records.withColumnRenamed("at", "record").join(
        blocks.select("file", F.col("block"), "last_at"), ["file", "block"])
    here = spans.select("record", F.explode(F.sequence(
        "record", F.when(F.col("end_block") == F.col("block"), F.col("end_at")).otherwise(F.col("last_at")))).alias("at"))
    # A record that goes on over further blocks: at most one for each border of two blocks.
    over = spans.filter("end_block <> block").select("file", F.col("block").alias("from"), "record", "end_block", "end_at")
    tagged = blocks.join(over.withColumn("block", F.col("from")), ["file", "block"], "left")
    carried = tagged.withColumn("open", F.last(
        F.when(F.col("record").isNotNull(), F.struct("record", "end_block", "end_at")), ignorenulls=True).over(
            Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    there = carried.filter(F.col("open.end_block") >= F.col("block")).select(
        F.col("open.record").alias("record"), F.explode(F.sequence("first_at", F.when(
            F.col("open.end_block") == F.col("block"), F.col("open.end_at")).otherwise(F.col("last_at")))).alias("at"))
    places = here.unionByName(there)
    if header:
        first = Window.partitionBy("file").orderBy("block")
        heads = blocks.filter("text_at IS NOT NULL").withColumn("n", F.row_number().over(first)).filter("n = 1").select(
            F.col("text_at").alias("head"))
        # The header's record goes, with all its lines; a header of one line is no record over several.
        named = places.join(heads, places["record"] == heads["head"], "left").select(
            "at", F.when(F.col("head").isNull(), F.col("record")).alias("record"))
        lone = heads.select(F.col("head").alias("at"), F.lit(None).cast("long").alias("record")).join(
            places.select("at"), "at", "left_anti")
        places = named.unionByName(lone)
    return materialize(places, "csv-places")
