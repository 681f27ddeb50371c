"""Records of large CSV files, quoted line breaks included, read by many tasks.

A reader that allows line breaks inside quotes can't begin in the middle of a
file, so Spark gives it one task a file.  Here the file is read as lines, which
split into byte ranges, and what a range needs to know of the ranges before it
is one bit: whether its first line continues a quoted field.

1. Each range is read once as a function of that bit: where it leaves the bit
   if it begins in a record and if it begins in quotes.  Only lines with a
   quote count.  The functions compose, so a window over the ranges of each file
   (one row a range) gives every range its bit.
2. If no line has a quote, or none of any range ends inside quotes, every line is a record, and
   the ordinary line reader does the rest.
3. Otherwise each range joins its lines to records.  A record that crosses a
   range's end comes out in pieces, at most two a range, which are put together
   by file and order; all others never leave their task.

The rules of quoting are those of Spark's reader: a quote opens a field only at
its beginning, a doubled quote is one, and a closing quote that something other
than the delimiter follows makes the rest of the field plain.  A record ends
with a line feed or a carriage return and a line feed; where it does the latter, line
breaks inside its quotes are read as line feeds, else they are kept as they are.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.session import scratch_path, ship_package

#: A record (as text) beyond this is taken for a quote that was never closed.
MAX_RECORD = 64 << 20

_PLAIN = r'(?!")[^,]*+'
_QUOTED = r'(?:[^"]++|"")*+'
_FIELDS = rf'(?:(?:{_PLAIN}|"{_QUOTED}"(?!"){_PLAIN}),)*+'
_OPEN = rf'{_FIELDS}"{_QUOTED}\Z'
#: Lines that end inside quotes, if they begin in a record or in quotes.
FROM_RECORD = re.compile(_OPEN)
FROM_QUOTE = re.compile(rf'{_QUOTED}(?:\Z|"(?!"){_PLAIN},{_OPEN})')


def ends_quoted(line: str, quoted: bool) -> bool:
    """Whether a line that begins in quotes (or doesn't) ends in quotes."""
    if '"' not in line:
        return quoted
    return bool((FROM_QUOTE if quoted else FROM_RECORD).match(line))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, begin): the lines in order within each byte range."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"))


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """(file, path) of the files that ``_lines`` numbers."""
    name = F.col("_metadata.file_path")
    return spark.read.option("lineSep", "\n").text(path).select(F.xxhash64(name).alias("file"), name.alias("path")).distinct()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(file, begin, rows) of the stretches of one range in each batch."""
    for batch in batches:
        if batch.num_rows:
            file, begin = batch.column("file").to_numpy(), batch.column("begin").to_numpy()
            cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(begin) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                yield int(file[a]), int(begin[a]), batch.slice(a, b - a)


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: its end's bit by its beginning's, and whether any line
    ends in quotes or holds a carriage return of its own."""
    names = ["file", "begin", "after_record", "after_quote", "opens"]

    def row(at, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, (*at, *state)))],
                                          pa.schema(list(zip(names, [pa.int64()] * 2 + [pa.bool_()] * 3))))

    held, state = None, None
    for file, begin, part in _parts(batches):
        if held != (file, begin):
            if held:
                yield row(held, state)
            held, state = (file, begin), (False, True, False)
        for line in part.column("value").drop_null().to_pylist():
            a, b = ends_quoted(line, state[0]), ends_quoted(line, state[1])
            state = a, b, state[2] or a or "\r" in line[:-1]
    if held:
        yield row(held, state)


def _may_break() -> Column:
    """Whether a line has a quote or, before its end, a carriage return."""
    return F.contains("value", F.lit('"')) | F.contains(F.expr("left(value, length(value) - 1)"), F.lit("\r"))


def has_line_breaks(spark: SparkSession, path: str) -> DataFrame | None:
    """``range_states``, if a record has a line break (or a line a carriage
    return of its own).  Files without a quote are only looked through."""
    if spark.read.option("lineSep", "\n").text(path).where(_may_break()).isEmpty():
        return None
    states = range_states(spark, path)
    return None if states.where("opens").isEmpty() else states


def range_states(spark: SparkSession, path: str) -> DataFrame:
    """(file, begin, quoted, opens) of every range, written to the shared folder."""
    ship_package(spark)
    told = F.when(_may_break(), F.col("value"))
    ranges = _lines(spark, path).select("file", "begin", told.alias("value")).mapInArrow(
        _functions, "file long, begin long, after_record boolean, after_quote boolean, opens boolean")
    order = Window.partitionBy("file").orderBy("begin")
    resets = F.col("after_record") == F.col("after_quote")
    swaps = F.sum((F.col("after_record") & ~F.col("after_quote")).cast("int")).over(order)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    counted = ranges.withColumn("swaps", swaps)
    last = F.last(F.when(resets, F.struct("after_record", "swaps")), ignorenulls=True).over(before)
    swapped = F.coalesce(F.lag("swaps").over(order), F.lit(0)) - F.coalesce(last["swaps"], F.lit(0))
    states = counted.select(
        "file", "begin", (F.coalesce(last["after_record"], F.lit(False)).cast("int") != swapped % 2).alias("quoted"), "opens")
    where = scratch_path(spark, "csv-ranges")
    states.write.parquet(where)
    return spark.read.schema(states.schema).parquet(where)


def _joined(pieces: bool, header: list[str]):
    """Lines of ranges -> whole records (file, record), or with ``pieces``
    the parts of records that cross a range's end (file, begin, part, piece):
    part 0 continues an earlier range's record, part 1 begins one."""
    names = ["file", "begin", "part", "piece"] if pieces else ["file", "record"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string()] if pieces else [pa.int64(), pa.string()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, quoted, size, returns = None, False, 0, False
        part, lines, first = 1, [], False  # the record that is open
        out: list[tuple] = []
        for file, begin, rows in _parts(batches):
            if held != (file, begin):
                if pieces and lines:
                    out.append((*held, part, "\n".join(lines)))
                state = rows.column("quoted")[0].as_py()
                if state is None:
                    raise RuntimeError("the byte ranges of a file changed while it was read")
                held, quoted, size = (file, begin), state, 0
                part, lines, first, returns = 0 if quoted else 1, [], begin == 0, False
            for line in rows.column("value").to_pylist():
                quoted = ends_quoted(line, quoted)
                if quoted or lines or part == 0:
                    lines.append(line)
                    size += len(line) + 1
                    if size > MAX_RECORD:
                        raise ValueError(f"a record of more than {MAX_RECORD} characters: is a quote not closed?")
                    if quoted:
                        continue
                    if part == 0:  # the end of another range's record
                        if pieces:
                            out.append((*held, 0, "\n".join(lines)))
                        part, lines, size = 1, [], 0
                        continue
                    line, lines, size = "\n".join(lines), [], 0
                record = line
                if record[-1:] == "\r":
                    record, returns = record[:-1], True
                if not record:
                    continue
                if returns and "\r" in record:
                    record = record.replace("\r\n", "\n")
                if first:
                    first = False
                    if next(csv.reader([record.lstrip("\ufeff")])) != header:
                        raise ValueError(f"another header than {header}: {record}")
                    continue
                if not pieces:
                    out.append((file, record))
            if out:
                yield batch(out)
                out = []
        if pieces and lines:
            out.append((*held, part, "\n".join(lines)))
        if out:
            yield batch(out)

    return run


def read_records(spark: SparkSession, path: str, states: DataFrame, header: list[str]) -> DataFrame:
    """(file, record) of every record but the files' headers; blank lines are
    left out.  ``states``: ``range_states`` of the same path.  Finds and puts
    together the records that cross ranges when called."""
    # one row a byte range, which bounds the broadcast; it keeps the lines' order
    rows = _lines(spark, path).join(
        F.broadcast(states.select("file", "begin", "quoted")), ["file", "begin"], "left")
    whole = rows.mapInArrow(_joined(False, header), "file long, record string")
    where = scratch_path(spark, "csv-pieces")
    rows.mapInArrow(_joined(True, header), "file long, begin long, part int, piece string").write.parquet(where)
    parts = spark.read.schema("file long, begin long, part int, piece string").parquet(where)
    order = Window.partitionBy("file").orderBy("begin", "part")
    crossing = parts.withColumn("number", F.sum("part").over(order)).groupBy("file", "number").agg(
        F.sum(F.char_length("piece")).alias("size"), F.sort_array(F.collect_list(F.struct("begin", "part", "piece"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["piece"]), "\n")
    text = F.when(F.col("size") > MAX_RECORD, F.raise_error(F.lit("a record too long: is a quote not closed?")).cast("string")
                  ).otherwise(F.when(F.endswith(text, F.lit("\r")), F.rtrim(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r")))
                              .otherwise(text))
    return whole.unionByName(crossing.select("file", text.alias("record")))
