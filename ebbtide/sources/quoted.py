"""Records with line breaks within quotes, put together from lines that were read in splits.

A line either leaves the state of the quotes as it is, turns it over, or ends inside or
outside of quotes whatever it began in. Such a map of two states is a constant or a
parity, so the state ahead of every line is the last constant before it and the number
of turns since. That is scanned within each split, then over one row per split, and
no task reads a whole file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.text import (
    computed_once,
    split_fields,
    without_nul,
    without_return,
)
from ebbtide.session import materialise

# A record of more bytes is taken for quotes that went astray.
MOST_RECORD_BYTES = 16 << 20
_QUOTE = '"'
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'


def plain_lines(lines: DataFrame) -> DataFrame:
    """Lines without NUL bytes and without the carriage return at their end."""
    others = [name for name in lines.columns if name != "line"]
    plain = computed_once(lines, others, without_nul(F.col("line")).alias("line"))
    return computed_once(plain, others, without_return(F.col("line")).alias("line"))


def _fields(separator: str) -> str:
    """Any fields, closed and followed by a separator. A quote within an unquoted field
    opens nothing."""
    sep = re.escape(separator)
    return rf'(?:(?:"{_QUOTED}"|[^"{sep}][^{sep}]*+)?+{sep})*+'


def ends_inside(line: Column, separator: str, inside: bool) -> Column:
    """Whether a line that begins inside quotes, or outside, ends inside."""
    opened = rf'{_fields(separator)}"{_QUOTED}\z'
    if not inside:
        return F.contains(line, F.lit(_QUOTE)) & line.rlike(rf"^{opened}")
    closed_before = rf'{_QUOTED}"{re.escape(separator)}{opened}'
    return ~F.contains(line, F.lit(_QUOTE)) | line.rlike(rf"^(?:{_QUOTED}\z|{closed_before})")


def _parity(count: Column) -> Column:
    return (count % 2) == 1


def _other(state: Column, turned: Column) -> Column:
    return state != turned


def _entry_states(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``rows`` with the state ahead of each as ``fixed`` (null if no constant came before)
    and ``turned``, an odd number of turns since. A row's own map is ``constant`` and
    ``turns``."""
    ordered = Window.partitionBy(*keys).orderBy(order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.coalesce(F.sum(F.col("turns").cast("int")).over(before), F.lit(0))
    counted = rows.withColumn("so_far", turns)
    constant = F.when(F.col("constant").isNotNull(), F.struct("constant", "so_far"))
    counted = counted.withColumn("last", F.last(constant, ignorenulls=True).over(before))
    since = F.col("so_far") - F.coalesce("last.so_far", F.lit(0))
    return counted.withColumn("turned", _parity(since)).withColumn("fixed", F.col("last.constant"))


def _with_states(lines: DataFrame, separator: str) -> DataFrame:
    """Lines with ``inside`` (ahead of the line), ``open`` (after it) and ``start``, the
    place of the first line of their record."""
    others = lines.columns
    mapped = computed_once(
        lines,
        others,
        ends_inside(F.col("line"), separator, False).alias("opens"),
        ends_inside(F.col("line"), separator, True).alias("stays"),
    )
    mapped = mapped.withColumn(
        "constant", F.when(F.col("opens") == F.col("stays"), F.col("opens"))
    ).withColumn("turns", F.col("opens") & ~F.col("stays"))
    scanned = _entry_states(mapped, ["file", "block"], "seq")
    scanned = materialise(
        scanned.select(*others, "opens", "stays", "constant", "turns", "so_far", "fixed", "turned")
    )

    # A split as a map: its last constant and the turns after it, or all its turns.
    last = F.max_by(F.struct("constant", "so_far"), F.when(F.col("constant").isNotNull(), F.col("seq")))
    splits = scanned.groupBy("file", "block").agg(
        last.alias("end"), F.sum(F.col("turns").cast("int")).alias("all_turns")
    )
    rest = _parity(F.col("all_turns") - F.coalesce("end.so_far", F.lit(0)))
    splits = splits.select(
        "file",
        "block",
        _other(F.col("end.constant"), rest).alias("constant"),
        (F.col("end.constant").isNull() & rest).alias("turns"),
    )
    splits = _entry_states(splits, ["file"], "block").select(
        "file",
        "block",
        _other(F.coalesce("fixed", F.lit(False)), F.col("turned")).alias("split_inside"),
    )
    # One row per split.
    stated = scanned.join(F.broadcast(splits), ["file", "block"])
    inside = _other(F.coalesce("fixed", "split_inside"), F.col("turned"))
    stated = stated.withColumn("inside", inside).withColumn(
        "open", F.when(F.col("inside"), F.col("stays")).otherwise(F.col("opens"))
    )

    starts = stated.groupBy("file", "block").agg(
        F.max(F.when(~F.col("inside"), F.col("seq"))).alias("last_start")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    place = F.when(F.col("last_start").isNotNull(), F.struct("block", F.col("last_start").alias("seq")))
    starts = starts.select(
        "file", "block", F.last(place, ignorenulls=True).over(earlier).alias("carried")
    )
    so_far = Window.partitionBy("file", "block").orderBy("seq")
    own = F.last(F.when(~F.col("inside"), F.struct("block", "seq")), ignorenulls=True).over(so_far)
    return (
        stated.withColumn("own", own)
        .join(F.broadcast(starts), ["file", "block"])
        .select(*others, "inside", "open", F.coalesce("own", "carried").alias("start"))
    )


def whole_records(lines: DataFrame, separator: str) -> DataFrame:
    """Plain ``lines`` with the lines of a record in one, joined by line feeds, at the
    place of its first line; and ``stray``, which tells lines that could not be joined.

    A record that quoting breaks, that no quote closes before the file ends, or that is
    longer than ``MOST_RECORD_BYTES`` stays in its single lines. Carriage returns ahead
    of a line feed are dropped, within quotes as well. Empty lines between records are
    left out.

    Files in which no line opens a quote for the next are found first and go through as
    they are; the other files' lines are stored once.
    """
    lines = plain_lines(lines)
    columns = lines.columns
    opening = lines.where(ends_inside(F.col("line"), separator, False))
    # One row per file at most.
    files = materialise(opening.select("file").distinct())
    if files.isEmpty():
        return lines.where("line <> ''").withColumn("stray", F.lit(False))
    files = F.broadcast(files)
    untouched = lines.join(files, "file", "left_anti").where("line <> ''")
    held = materialise(lines.join(files, "file", "left_semi"))
    stated = materialise(_with_states(held, separator))

    single = stated.where("NOT inside AND NOT open AND line <> ''").select(*columns)
    several = stated.where("inside OR open")
    record = ["file", "start"]
    sizes = several.groupBy(*record).agg(
        F.sum(F.octet_length("line") + 1).alias("bytes"), F.min("open").alias("unclosed")
    )
    # At most one unclosed record per file, and few that are so long.
    astray = F.broadcast(
        sizes.where(F.col("unclosed") | (F.col("bytes") > MOST_RECORD_BYTES)).select(*record)
    )
    lost = several.join(astray, record, "left_semi").select(*columns)
    one = F.struct("block", "seq", *[c for c in columns if c not in ("block", "seq")])
    joined = (
        several.join(astray, record, "left_anti")
        .groupBy(*record)
        .agg(F.sort_array(F.collect_list(one)).alias("lines"))
        .withColumn("whole", F.array_join(F.transform("lines", lambda x: x["line"]), "\n"))
        .withColumn("sound", split_fields(F.col("whole"), separator).isNotNull())
    )
    first = F.get("lines", F.lit(0)).withField("line", F.col("whole"))
    joined = joined.select(
        "sound", F.explode(F.when(F.col("sound"), F.array(first)).otherwise(F.col("lines")))
    ).select(*[f"col.{c}" for c in columns], (~F.col("sound")).alias("stray"))
    return (
        untouched.unionByName(single)
        .withColumn("stray", F.lit(False))
        .unionByName(lost.withColumn("stray", F.lit(True)))
        .unionByName(joined)
        .where("line <> ''")
    )
