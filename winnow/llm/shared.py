"""Small helpers of the operators: intermediate tables, names that clash with none, sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.sources.tables import shared_dir


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives executors."""
    path = path or shared_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: Rows and bytes of one batch that Spark hands to Python, at most: texts can be long.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20


def texts_of(df: DataFrame) -> DataFrame:
    """``df``, to be read by Python in batches that stay small whatever the length of its texts.

    Lowers the session's limits of Arrow batches where they are higher, as they are by default.
    """
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        found = conf.get(name).lower().removesuffix("b")
        if not found.isdigit() or not 0 < int(found) <= most:
            conf.set(name, str(most))
    return df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
