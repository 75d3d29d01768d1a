"""Discovery as pages land: the batch functions under Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from winnow.functions.urls import job_id
from winnow.operators.state import insert_new
from winnow.plans.discovery import discover
from winnow.plans.stages import known_ids
from winnow.schemas import PAGES
from winnow.sources.tables import land


def read_pages(spark: SparkSession, path: str, *, glob: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Stream of the page files in a folder."""
    reader = spark.readStream.schema(PAGES).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start_discovery(
    pages: DataFrame, table: str, checkpoint: str, *, every: str | None = None, as_of=None, **options
) -> StreamingQuery:
    """Add the new rows of every micro-batch to ``table``.

    Stops when all input is read, or looks for more ``every`` so often (``"1 minute"``).

    ``table`` is the one the stages read. Rows land beside its newest version, so a stage that writes
    the next one may run meanwhile; batch discovery may not, as it lands rows too. What a run committed
    is known to the next, so a batch that is run again after a failure never inserts twice.
    """

    def insert(batch: DataFrame, _: int) -> None:
        found = discover(batch, **options).persist()
        # The table outgrows every batch. Of the buckets that the batch's ids fall into it is cut to
        # those ids first, where it lies as long as they are few enough to be broadcast.
        ids = found.select(job_id(F.col("url")).alias("id")).distinct()
        known, n = known_ids(batch.sparkSession, table, found)
        known = known.join(ids, "id", "left_semi")
        land(insert_new(known, found, as_of=as_of), table, "id", n)
        found.unpersist()

    when = {"processingTime": every} if every else {"availableNow": True}
    return (
        pages.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(**when)
        .start()
    )


def unique_listings(
    listings: DataFrame, within: str | None = None, event_time: str | None = None, known: DataFrame | None = None
) -> DataFrame:
    """First arrival of each listing of a stream, kept by state instead of by the table.

    Ids that ``known`` has, the jobs table as it is when the query starts, or starts again, are never passed on.
    Beside them the state holds the ids that have arrived; with ``event_time`` and ``within`` they
    are forgotten after that delay, so that the state stays as small as what arrives in it, and a listing seen
    again later is passed on again, unless a restart has found it in the table. The known ids
    are joined, not held: a stream that is to look into the table with every batch is ``start_discovery``.
    """
    keyed = listings.withColumn("id", job_id(F.col("url")))
    if known is not None:
        keyed = keyed.join(known.select("id"), "id", "left_anti")
    if event_time and within:
        return keyed.withWatermark(event_time, within).dropDuplicatesWithinWatermark(["id"])
    return keyed.dropDuplicates(["id"])
