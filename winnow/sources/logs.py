"""Log files as rows: a file per row, or, for files of any size, a line per row."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnow.sources.tables import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TASK_BYTES = 8_000_000  # of ranges that one task reads, at least, where there are many for each core


def read_logs(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """``(file, value)``; bytes that are not UTF-8 are replaced."""
    return (
        spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
        .select(
            F.col("_metadata.file_path").alias("file"), F.make_valid_utf8("value").alias("value")
        )
    )


def lines_of(value: Column) -> Column:
    """Array of lines; a final line break does not begin another line."""
    lines = F.split(value, r"\r\n|\r|\n")
    return F.when(
        F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)
    ).otherwise(lines)


def log_lines(files: DataFrame) -> DataFrame:
    """``(file, line_no, line)``, numbered from 0."""
    return files.select("file", F.posexplode_outer(lines_of(F.col("value"))).alias("line_no", "line")).where(
        F.col("line_no").isNotNull()
    )


def read_log_lines(spark: SparkSession, path: str, glob: str = "*.log", parts: bool = False) -> DataFrame:
    """``(file, line_no, line)`` of log files of any size, numbered from 0; each is read in byte ranges.

    With ``parts`` the files of a folder are one log, in the order of their names, and ``file`` is the folder.

    Lines end in a line feed, a carriage return or both; one that crosses the end of a range belongs to the
    range it starts in. Bytes that are not UTF-8 are replaced, a byte order mark is dropped. A file without
    any line has no row.

    Ranges are counted first: a row for each, whose running sum over its file tells the number of a range's
    first line. That table is stored, so its size is known: joined to the lines it is broadcast,
    unless there are so many ranges that Spark shuffles instead. No text is counted twice or kept.
    """
    lines = _placed_lines(spark, path, glob)
    ranges = lines.groupBy("file", "range").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    log = _log(parts)
    shift = F.coalesce(F.sum("n").over(_earlier(log)), F.lit(0)) - F.col("first")
    shifts = stored(ranges.select("file", "range", log.alias("log"), shift.alias("shift")))
    return lines.join(shifts, ["file", "range"]).select(F.col("log").alias("file"), (F.col("place") + F.col("shift")).alias("line_no"), "line")


def _placed_lines(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """``(file, range, line, place)``: the lines of a range have consecutive places, as one task reads it in order."""
    lines = (
        spark.read.text(path, pathGlobFilter=glob, recursiveFileLookup=True)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("range"),
            F.make_valid_utf8("value").alias("line"),
        )
        .withColumn("place", F.monotonically_increasing_id())
    )
    return _in_few_tasks(lines)


def _in_few_tasks(files: DataFrame) -> DataFrame:
    """Small ranges are read several to a task, one after another: tasks would take longer than what they read."""
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return files.coalesce(max(-(-size // _TASK_BYTES), 8 * files.sparkSession.sparkContext.defaultParallelism))


def _log(parts: bool) -> Column:
    return F.regexp_extract("file", r"^(.*)/[^/]*$", 1) if parts else F.col("file")


def _earlier(log: Column) -> Window:
    """The ranges of a log before each one."""
    return Window.partitionBy(log).orderBy("file", "range").rowsBetween(Window.unboundedPreceding, -1)


_OUTLINE = "file string, range bigint, place bigint, kind string, line string, next string"


def _outlines(batches: Iterator[pa.RecordBatch], mark: str, tail: int) -> Iterator[pa.RecordBatch]:
    """Of each range: ``first`` and last line, every ``error`` with the ``next`` line, without errors the ``tail``.

    The last lines of a range are carried over to the next batch, the very last one to be looked at with it.
    """
    carried, failed = None, False  # the range that is being read: its last lines, had it errors

    def outline(rows: pa.RecordBatch, old: int, ended: bool) -> pa.RecordBatch:
        nonlocal failed
        file, span, line = (rows.column(rows.schema.get_field_index(c)) for c in ("file", "range", "line"))
        n, starts = rows.num_rows, span.to_numpy()
        other = (starts[1:] != starts[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
        begins = np.flatnonzero(other) + 1
        hit = pc.starts_with(line, mark).to_numpy(zero_copy_only=False)
        errors = np.flatnonzero(hit[: n if ended else n - 1])
        errors = errors[errors >= old - 1]
        firsts = begins if old else np.append(0, begins)
        lasts = np.append(begins - 1, n - 1) if ended else begins - 1
        tails = [np.empty(0, dtype=np.int64)]
        for begin, end in zip(np.append(0, begins).tolist(), (lasts + 1).tolist(), strict=False):
            if not (hit[begin:end].any() or (begin == 0 and failed)):
                tails.append(np.arange(max(begin, end - tail), end))
        begin = int(begins[-1]) if len(begins) else 0
        failed = bool(hit[begin:].any()) or (begin == 0 and failed)
        kinds = {"error": errors, "first": firsts, "last": lasts, "tail": np.concatenate(tails)}
        at = np.concatenate(list(kinds.values()))
        kind = np.repeat(list(kinds), [len(x) for x in kinds.values()])
        is_error = np.arange(len(at)) < len(errors)
        no_next = ~is_error | np.isin(at + 1, np.append(begins, n))
        shown = rows.take(pa.array(at))
        return pa.RecordBatch.from_arrays(
            [
                shown.column("file"), shown.column("range"), shown.column("place"), pa.array(kind, pa.string()),
                pc.if_else(pa.array(kind != "last"), shown.column("line"), None), line.take(pa.array(at + 1, mask=no_next)),
            ],
            names=["file", "range", "place", "kind", "line", "next"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        old = carried.num_rows if carried else 0
        rows = pa.concat_batches([carried, batch]) if old else batch
        yield outline(rows, old, False)
        starts, files = rows.column("range"), rows.column("file")
        keep = rows.slice(max(0, rows.num_rows - max(tail, 1)))
        same = pc.and_(pc.equal(keep.column("range"), starts[-1]), pc.equal(keep.column("file"), files[-1]))
        carried = keep.filter(same)
    if carried:
        yield outline(carried, carried.num_rows, True)


def read_outline(spark: SparkSession, path: str, glob: str = "*.log", parts: bool = False, mark: str = "!", tail: int = 10) -> DataFrame:
    """``(file, line_no, kind, line, next)`` of log files of any size, read once, as ``read_log_lines`` reads them.

    Of kind ``error`` are the lines that begin with ``mark``, each with the line after it, of kind ``tail`` the last ones
    of a log without any. Only they leave the tasks that read, with a row or two for each range, from which the numbers
    follow. What a range cannot tell of its last line, the one after it, is the first line of the next range.
    """
    found = stored(_placed_lines(spark, path, glob).mapInArrow(lambda batches: _outlines(batches, mark, tail), _OUTLINE))
    kind, log = F.col("kind"), _log(parts)
    ranges = _in_few_tasks(found).groupBy("file", "range").agg(
        F.min("place").alias("first"),
        F.max("place").alias("last"),
        F.max(F.when(kind == "first", F.col("line"))).alias("head"),
        F.bool_or(kind == "error").alias("failed"),
    )
    whole, n = Window.partitionBy(log), F.col("last") - F.col("first") + 1
    shifts = stored(
        ranges.select(
            "file", "range", log.alias("log"), "last",
            (F.coalesce(F.sum(n).over(_earlier(log)), F.lit(0)) - F.col("first")).alias("shift"),
            F.lead("head").over(whole.orderBy("file", "range")).alias("head"),
            F.sum(n).over(whole).alias("size"),
            F.bool_or("failed").over(whole).alias("failed"),
        )
    )
    line_no = F.col("place") + F.col("shift")
    is_tail = (kind == "tail") & ~F.col("failed") & (line_no >= F.col("size") - tail)
    return (
        found.join(shifts, ["file", "range"])
        .where((kind == "error") | is_tail)
        .select(
            F.col("log").alias("file"), line_no.alias("line_no"), "kind", "line",
            F.when(kind == "error", F.when(F.col("place") == F.col("last"), F.col("head")).otherwise(F.col("next"))).alias("next"),
        )
    )
