"""Multi-line CSV of which many tasks read one file.

A quoted field may hold line breaks, so whether a line begins a record hangs on all
quotes before it, and Spark's own multi-line reader gives each file to one task.
Here files are read as lines, which Spark splits into blocks, and a line is a
function from the state before it (outside or inside a quoted field) to the state
after it:

1. One pass finds, per block, whether every line that begins outside also ends
   outside, and then where the block ends when it begins inside.  Blocks with other
   lines (the ones that hold line breaks in fields) get both ends from the running
   composition of their lines' functions.
2. The small table of blocks is put in order per file: the state at the begin of
   each block follows from those before it.
3. A second pass parses.  Where a block begins outside and its lines end outside,
   each line is a record.  In the others the lines of a record are put together; a
   record that began in an earlier block carries that block's name.

Records are parsed by ``from_csv``, so the values are those of Spark's reader.  The
lines of a file end with LF or CR LF, as its first one does; the header takes one line, and fields are separated by commas.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterline.session import written_once

#: Name of the column with the text of a record whose number of fields is not the header's.
MALFORMED = "malformed_record"

_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|)'
_COMPLETE = rf"\A{_FIELD}(?:,{_FIELD})*+\z"
_CLOSED = rf'\A{_INSIDE}"[^,]*+(?:,{_FIELD})*+\z'
_FILE, _START, _POS, _LINE = "_file", "_start", "_pos", "_line"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line with its file, its block's begin and its place in the order of the block's lines."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("_path"), F.xxhash64("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_START), F.monotonically_increasing_id().alias(_POS), F.col("value").alias(_LINE),
    )


def _after_outside(line: Column) -> Column:
    """State (0 outside, 1 inside) after a line that begins outside."""
    return F.when(~line.contains('"'), 0).otherwise(F.when(line.rlike(_COMPLETE), 0).otherwise(1))


def _after_inside(line: Column) -> Column:
    return F.when(~line.contains('"'), 1).otherwise(F.when(line.rlike(_CLOSED), 0).otherwise(1))


def _running(lines: DataFrame) -> DataFrame:
    """Adds the states after each line for a block that begins outside (``_s0``) or inside (``_s1``).

    A line either sets the state or flips it or leaves it; the state is the last one
    set, or that at the begin, flipped as often as lines since then flip.
    """
    order = Window.partitionBy(_FILE, _START).orderBy(_POS)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_f0", _after_outside(F.col(_LINE))).withColumn("_f1", _after_inside(F.col(_LINE)))
    flips = F.sum(((F.col("_f0") == 1) & (F.col("_f1") == 0)).cast("int")).over(upto)
    lines = lines.withColumn("_flips", flips)
    fixed = F.when(F.col("_f0") == F.col("_f1"), F.struct(F.col("_f0").alias("to"), F.col("_flips").alias("flips")))
    lines = lines.withColumn("_set", F.last(fixed, ignorenulls=True).over(upto))

    def state(begin: int) -> Column:
        return (F.coalesce(F.col("_set.to"), F.lit(begin)) + F.col("_flips") - F.coalesce(F.col("_set.flips"), F.lit(0))) % 2

    return lines.withColumn("_s0", state(0)).withColumn("_s1", state(1)).drop("_f0", "_f1", "_flips", "_set")


def _blocks(lines: DataFrame, head: str) -> DataFrame:
    """A row per block: state at its begin, whether its lines are its records, the file's header,
    and the block that holds the begin of a record open at its begin."""
    line = F.col(_LINE)
    some = F.when(_text(line) != "", F.struct(_POS, _LINE))
    closing = F.when(_after_inside(line) == 0, F.col(_POS))
    first = written_once(
        lines.groupBy(_FILE, _START).agg(
            F.max(_after_outside(line)).alias("_dirty"), F.min(some).alias("_first"), F.max(_POS).alias("_last"),
            F.min(closing).alias("_closing"), F.count_if(_text(line) == head).alias("_heads"),
            # A block's only path, as a set: the aggregate then keeps its few blocks in
            # memory as objects, where one of plain strings would sort all lines.
            F.get(F.collect_set("_path"), F.lit(0)).alias("_path"),
        ),
        "csv-blocks",
    )
    clean = first.where("_dirty = 0").select(
        _FILE, _START, F.lit(0).alias("_end0"), F.when(F.col("_closing").isNull(), 1).otherwise(0).alias("_end1"),
        F.lit(True).alias("_has0"), F.coalesce(F.col("_closing") < F.col("_last"), F.lit(False)).alias("_has1"),
    )
    dirty = first.where("_dirty = 1").select(_FILE, _START)
    if not dirty.isEmpty():
        run = _running(lines.join(dirty, [_FILE, _START], "left_semi"))
        ends = run.groupBy(_FILE, _START).agg(
            F.max_by("_s0", _POS).alias("_end0"), F.max_by("_s1", _POS).alias("_end1"), F.max(_POS).alias("_last"),
            F.min(F.when(F.col("_s0") == 0, F.col(_POS))).alias("_out0"), F.min(F.when(F.col("_s1") == 0, F.col(_POS))).alias("_out1"),
        )
        clean = clean.unionByName(ends.select(
            _FILE, _START, F.col("_end0").cast("int").alias("_end0"), F.col("_end1").cast("int").alias("_end1"), F.lit(True).alias("_has0"),
            F.coalesce(F.col("_out1") < F.col("_last"), F.lit(False)).alias("_has1"),
        ))
    # A block is 0 or 1 at its begin: again the last state that is set whatever came
    # before, flipped by the blocks since.  One row a block: small beside the lines.
    order = Window.partitionBy(_FILE).orderBy(_START)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    flips = F.sum(((F.col("_end0") == 1) & (F.col("_end1") == 0)).cast("int")).over(upto)
    table = clean.withColumn("_flips", flips)
    fixed = F.when(F.col("_end0") == F.col("_end1"), F.struct(F.col("_end0").alias("to"), F.col("_flips").alias("flips")))
    table = table.withColumn("_set", F.last(fixed, ignorenulls=True).over(upto))
    after = (F.coalesce(F.col("_set.to"), F.lit(0)) + F.col("_flips") - F.coalesce(F.col("_set.flips"), F.lit(0))) % 2
    table = table.withColumn("_begin", F.coalesce(F.lag(after).over(order), F.lit(0)).cast("int"))
    has = F.when(F.col("_begin") == 0, F.col("_has0")).otherwise(F.col("_has1"))
    table = table.withColumn("_owner", F.last(F.when(has, F.col(_START)), ignorenulls=True).over(before))
    earlier = F.max(F.col("_first").isNotNull()).over(before)
    told = first.select(
        _FILE, _START, "_dirty", "_path", "_heads",
        F.when(~F.coalesce(earlier, F.lit(False)), F.col(f"_first.{_LINE}")).alias("_header"),
    ).withColumn("_crlf", F.coalesce(F.max(F.col("_header").endswith("\r")).over(Window.partitionBy(_FILE)), F.lit(False)))
    has_header = F.col("_header").isNotNull()
    # In a block that repeats the header's text, order tells which line is the header.
    plain = (F.col("_begin") == 0) & (F.col("_dirty") == 0) & ~(has_header & (F.col("_heads") > 1))
    return written_once(
        table.join(told, [_FILE, _START]).select(
            _FILE, _START, "_begin", "_owner", "_path", "_header", _text(F.col("_header")).alias("_title"), "_crlf", plain.alias("_plain")
        ),
        "csv-table",
    )


def _text(line: Column) -> Column:
    """A line as headers are compared: without mark of byte order and line end, in lower case."""
    return F.lower(F.rtrim(F.ltrim(line, F.lit("\ufeff")), F.lit("\r")))


def _ended(line: Column) -> Column:
    """The line without the CR of its end, in files whose lines end with CR LF."""
    return F.when(F.col("_crlf") & line.endswith("\r"), F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def _check_headers(blocks: DataFrame, head: str) -> None:
    """All files name the same columns in the same order, whatever the case."""
    if head.count('"') % 2:
        raise ValueError("the header takes more than one line")
    names = next(csv.reader([head]))
    lines = blocks.where("_header IS NOT NULL").groupBy(_text(F.col("_header")).alias("line")).agg(F.min("_path").alias("path"))
    for r in lines.where(F.col("line") != head).limit(1000).collect():  # header lines in another form: none as a rule
        if next(csv.reader([r["line"]])) != names:
            raise ValueError(f"the header of {r['path']} differs from the first file's")


def _whole_records(lines: DataFrame) -> DataFrame:
    """Records of blocks that begin inside a field or hold line breaks in fields."""
    order = Window.partitionBy(_FILE, _START).orderBy(_POS)
    first = F.min(F.when(_text(F.col(_LINE)) != "", F.col(_POS))).over(Window.partitionBy(_FILE, _START))
    lines = lines.withColumn("_head", F.col("_header").isNotNull() & (F.col(_POS) == first))
    run = _running(lines).withColumn("_s", F.when(F.col("_begin") == 0, F.col("_s0")).otherwise(F.col("_s1")))
    run = run.withColumn("_new", (F.coalesce(F.lag("_s").over(order), F.col("_begin")) == 0).cast("int"))
    upto, later = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(1, Window.unboundedFollowing)
    run = run.withColumn("_nth", F.sum("_new").over(upto)).withColumn("_left", F.coalesce(F.sum("_new").over(later), F.lit(0)))
    # A record is named by the block it begins in and the records that begin after it there.
    block = F.when(F.col("_nth") > 0, F.col(_START)).otherwise(F.col("_owner"))
    place = F.when(F.col("_nth") > 0, F.col("_left")).otherwise(F.lit(0))
    parts = run.groupBy("_path", block.alias("_block"), place.alias("_place")).agg(
        F.array_sort(F.collect_list(F.struct(_START, _POS, _ended(F.col(_LINE)).alias(_LINE)))).alias("_parts"), F.max("_head").alias("_head")
    )
    whole = F.array_join(F.transform("_parts", lambda p: p[_LINE]), "\n")
    return parts.where("NOT _head").select("_path", whole.alias("_record"))


def read_records(spark: SparkSession, path: str | list[str], columns: list[str], malformed: bool = False) -> DataFrame:
    """All records of the files as strings under ``columns`` (their header), with ``source_file``.

    With ``malformed`` the column MALFORMED holds the text of records with another
    number of fields; as in Spark's reader their first fields are kept.  The passes
    over the blocks run when this is called; only the parsing is left to the plan.
    """
    lines = _lines(spark, path)
    found = lines.where(_text(F.col(_LINE)) != "").select(_text(F.col(_LINE))).first()
    head = found[0] if found else ""
    blocks = _blocks(lines, head)
    _check_headers(blocks, head)
    # The second pass must see the blocks of the first one.
    changed = F.raise_error(F.lit("the files or their splits changed while they were read")).cast("boolean")
    placed = lines.drop("_path").join(blocks, [_FILE, _START], "left")
    plain = placed.where(F.when(F.col("_path").isNull(), changed).otherwise(F.col("_plain")))
    header = F.col("_title").isNotNull() & (_text(F.col(_LINE)) == F.col("_title"))
    records = plain.where(~header).select("_path", _ended(F.col(_LINE)).alias("_record"))
    if not blocks.where("NOT _plain").isEmpty():
        records = records.unionByName(_whole_records(lines.drop("_path").join(blocks.where("NOT _plain"), [_FILE, _START])))
    schema = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in [*columns, MALFORMED])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": MALFORMED}
    # The ids are never negative, but an expression with them is evaluated once a record:
    # a filter on its fields, moved below it, would parse the record for every field.
    once = F.when(F.monotonically_increasing_id() >= 0, F.col("_record"))
    parsed = records.where(F.length("_record") > 0).select(F.from_csv(once, schema, options).alias("_row"), F.col("_path").alias("source_file"))
    out = [F.col("_row").getField(c).alias(c) for c in columns]
    return parsed.select(*out, *([F.col("_row").getField(MALFORMED).alias(MALFORMED)] if malformed else []), "source_file")
