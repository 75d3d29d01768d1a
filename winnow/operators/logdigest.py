"""Errors of log files: each error line with the line after it, else the last lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions.text import let, strip
from winnow.sources.logs import lines_of
from winnow.sources.tables import stored

TAIL = 10
_ROW = "array<struct<line_no:bigint,kind:string,line:string,context:string>>"


def digest_files(files: DataFrame, tail: int = TAIL) -> DataFrame:
    """Digest of ``(file, value)`` rows. A file is one row already, so nothing is shuffled."""

    def rows_of(lines):
        n = F.size(lines)
        numbered = F.transform(
            lines,
            lambda line, i: F.struct(
                i.cast("bigint").alias("line_no"),
                F.when(F.startswith(line, F.lit("!")), "error").otherwise("tail").alias("kind"),
                strip(line).alias("line"),
                F.when(F.startswith(line, F.lit("!")), strip(F.get(lines, i + 1))).alias("context"),
            ),
        )
        return let(
            numbered,
            lambda all_: F.when(
                F.exists(all_, lambda r: r["kind"] == "error"),
                F.filter(all_, lambda r: r["kind"] == "error"),
            ).otherwise(F.filter(all_, lambda r: r["line_no"] >= n - tail)),
        )

    return (
        files.select("file", let(lines_of(F.col("value")), rows_of).cast(_ROW).alias("rows"))
        .select("file", F.explode_outer("rows").alias("r"))
        .where(F.col("r").isNotNull())
        .select("file", "r.*")
    )


def digest_lines(lines: DataFrame, tail: int = TAIL) -> DataFrame:
    """Digest of ``(file, line_no, line)`` rows, numbered from 0 without gaps.

    Made for files of any length: as lines are numbered, the places of what is wanted beside the errors,
    the lines after them and the last lines of files without any, follow from the errors and from the
    length of each file. They are stored, so that their size is known, and looked up in one reading:
    few of them are broadcast, and no text is shuffled; more are matched in one shuffle.

    What ``read_outline`` has found, a ``kind`` and the ``next`` line beside a line, need not be looked up.
    """
    if "next" in lines.columns:
        return lines.select("file", "line_no", "kind", strip(F.col("line")).alias("line"), strip(F.col("next")).alias("context"))
    at = ["file", "line_no"]
    errors = stored(lines.where(F.startswith(F.col("line"), F.lit("!"))).select(*at, "line"))
    ends = lines.groupBy("file").agg(F.max("line_no").alias("end"))
    clean = ends.join(errors.select("file").distinct(), "file", "left_anti")
    last = F.sequence(F.greatest(F.col("end") - (tail - 1), F.lit(0)), F.col("end"))
    after = errors.select("file", (F.col("line_no") + 1).alias("line_no"), F.lit("after").alias("as"))
    wanted = after.unionByName(
        clean.select("file", F.explode(last).alias("line_no"), F.lit("tail").alias("as"))
    )
    found = stored(lines.select(*at, "line").join(stored(wanted), at))
    following = found.where(F.col("as") == "after").select(
        "file", (F.col("line_no") - 1).alias("line_no"), F.col("line").alias("next")
    )
    hits = errors.join(following, at, "left").select(
        *at, F.lit("error").alias("kind"), strip(F.col("line")).alias("line"), strip(F.col("next")).alias("context")
    )
    tails = found.where(F.col("as") == "tail").select(
        *at, F.lit("tail").alias("kind"), strip(F.col("line")).alias("line"), F.lit(None).cast("string").alias("context")
    )
    return hits.unionByName(tails)
