"""Error digests of log lines and of whole log files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query, scratch, table
from winnow.operators.logdigest import digest_files, digest_lines
from winnow.plans import stages
from winnow.sources.logs import read_log_lines
from winnow.sources.tables import stored


def turn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as log files, turns as lines; what a system says is an error."""
    line = F.regexp_replace("text", r"[\r\n]+", " ")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("file"),
        F.col("turn").alias("line_no"),
        F.when(F.col("role") == "system", F.concat(F.lit("! "), line)).otherwise(line).alias("line"),
    )


def digest_sql(lines: str) -> str:
    t = "trim({}, ' ' || chr(9) || chr(10) || chr(13))"
    return f"""{lines}, w AS (SELECT *, starts_with(line, '!') AS err, lead(line) OVER (PARTITION BY file ORDER BY line_no) AS next,
  max(CAST(starts_with(line, '!') AS INTEGER)) OVER (PARTITION BY file) AS any_err,
  row_number() OVER (PARTITION BY file ORDER BY line_no DESC) AS back FROM line)
SELECT file, line_no, CASE WHEN err THEN 'error' ELSE 'tail' END AS kind, {t.format("line")} AS line,
  CASE WHEN err THEN {t.format("next")} END AS context FROM w WHERE err OR (any_err = 0 AND back <= 10)"""


@query(
    "log_errors",
    digest_sql(r"""WITH line AS (SELECT conv_id AS file, turn AS line_no,
  CASE WHEN role = 'system' THEN '! ' ELSE '' END || regexp_replace(text, '[\r\n]+', ' ', 'g') AS line FROM conversations)"""),
)
def lines_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_lines(turn_lines(spark, sf_dir))


@query(
    "log_errors_files",
    digest_sql(r"""WITH v AS (SELECT doc_id AS file, string_split(regexp_replace(text, '(^|\n)(Th|E)', '\1! \2', 'g'), chr(10)) AS ls FROM documents),
u AS (SELECT file, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS line_no, len(ls) AS n FROM v),
line AS (SELECT file, line, line_no FROM u WHERE NOT (line_no = n - 1 AND line = ''))"""),
)
def files_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as log files; lines that begin in one of two ways are errors."""
    files = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file"),
        F.regexp_replace("text", r"(^|\n)(Th|E)", "$1! $2").alias("value"),
    )
    return digest_files(files)


_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
_RANGE_BYTES = 64_000  # so that logs of any scale are read in many ranges
_PART_LINES = 200_000  # of a part of a log, about: one task sorts them


def written_logs(spark: SparkSession, sf_dir: str) -> str:
    """Order lines as three logs, each in the order of its lines; large ones of two are errors.

    A log is a folder of parts, ranges of its lines, so that no task sorts more than one of them.
    """
    is_error = (F.col("l_quantity") >= 49) & (F.col("l_suppkey") % 3 != 2)
    line = F.concat_ws(" ", *[F.col(c).cast("bigint").cast("string") for c in _ORDER])
    path = f"{scratch(spark)}/logs"
    lines = table(spark, sf_dir, "lineitem")
    (
        lines.withColumn("file", F.col("l_suppkey") % 3)
        .repartitionByRange(-(-lines.count() // _PART_LINES) or 1, "file", *_ORDER)
        .sortWithinPartitions("file", *_ORDER)
        .select("file", F.when(is_error, F.concat(F.lit("! "), line)).otherwise(line).alias("value"))
        .write.partitionBy("file")
        .text(path)
    )
    return path


_WRITTEN_SQL = f"""l AS (SELECT l_suppkey % 3 AS file, row_number() OVER (PARTITION BY l_suppkey % 3 ORDER BY {", ".join(_ORDER)}) - 1 AS line_no,
  CASE WHEN l_quantity >= 49 AND l_suppkey % 3 <> 2 THEN '! ' ELSE '' END
    || concat_ws(' ', {", ".join(f"CAST(trunc({c}) AS BIGINT)" for c in _ORDER)}) AS line FROM lineitem),
line AS (SELECT CAST(file AS BIGINT) AS file, line_no, line FROM l)"""


def _in_ranges(spark: SparkSession, make):
    """What ``make`` reads is read in small ranges; it must not leave the reading for later."""
    conf = {"spark.sql.files.maxPartitionBytes": str(_RANGE_BYTES), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return make()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _file() -> Column:
    return F.regexp_extract("file", r"/file=(\d+)$", 1).cast("bigint").alias("file")


@query("log_errors_ranges", digest_sql(f"WITH {_WRITTEN_SQL}"))
def ranges_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of log files that are read in byte ranges, by many tasks each."""
    path = written_logs(spark, sf_dir)
    found = _in_ranges(spark, lambda: stages.run_log_digest(spark, path, glob="*.txt", parts=True))
    return found.select(_file(), "line_no", "kind", "line", "context")


@query(
    "log_lines_ranges",
    f"WITH {_WRITTEN_SQL} SELECT file, count(*) AS n, max(line_no) AS last, CAST(sum(line_no * length(line)) AS BIGINT) AS digest FROM line GROUP BY file",
)
def ranges_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line's number, summed up by file."""
    path = written_logs(spark, sf_dir)

    def make() -> DataFrame:
        lines = read_log_lines(spark, path, glob="*.txt", parts=True)
        summed = lines.groupBy(_file()).agg(
            F.count("*").alias("n"), F.max("line_no").alias("last"), F.sum(F.col("line_no") * F.length("line")).alias("digest")
        )
        return stored(summed)

    return _in_ranges(spark, make)
