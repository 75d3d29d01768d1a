"""An index of landed pages by address: the page that holds the first copy of each.

The index is a Parquet table of url and page_id, bucketed by url, without any markup. A landed batch adds
one row an address, so an address that a third of its pages share is a single row. The first copies of
some addresses are then found bucket by bucket: of the pages nothing is shuffled, however many have landed.

Rows may be added twice, as the least page_id of an address stays the same: a batch that was cut off
while it was added is added again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.sources.tables import children

#: Buckets of a new index: choose them so that one holds some hundred MB of addresses.
BUCKETS = 64


@dataclass(frozen=True)
class PageIndex:
    """An index under the ``name`` that this session's catalog has for it."""

    spark: SparkSession
    name: str
    buckets: int

    def add(self, pages: DataFrame) -> None:
        """Take in a batch of pages (page_id, url), with or without markup. One writer at a time.

        Pages without an address or a number are left out: none can be wanted. Each bucket gets one file.
        """
        rows = pages.where(F.col("url").isNotNull() & F.col("page_id").isNotNull())
        firsts = rows.groupBy("url").agg(F.min("page_id").cast("long").alias("page_id"))
        firsts.repartition(self.buckets, "url").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def rows(self) -> DataFrame:
        """url and page_id, several rows for an address that came in several batches."""
        return self.spark.table(self.name)

    def firsts(self) -> DataFrame:
        """url and page_id of the first copy of every address; not shuffled."""
        return self.rows().groupBy("url").agg(F.min("page_id").alias("page_id"))

    def first_copies(self, urls: DataFrame) -> DataFrame:
        """url and page_id of the first copies of ``urls``, a table with such a column.

        The addresses are folded and dealt into the index's buckets, whatever the number of shuffle
        partitions, so the index stays where it lies.
        """
        wanted = urls.select("url").distinct().repartition(self.buckets, "url")
        return self.firsts().join(wanted, "url", "left_semi")


def open_index(spark: SparkSession, path: str, name: str, buckets: int = BUCKETS) -> PageIndex:
    """The index below ``path``, a new one with so many ``buckets`` if there is none.

    ``name`` is a table's name that the session has not given to anything else. An index keeps the number of
    buckets that it was made with: its folder tells it.
    """
    found = [m[1] for child, _ in children(spark, path) if (m := re.fullmatch(r"buckets=(\d+)", child))]
    n = int(found[0]) if found else buckets
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (url STRING, page_id BIGINT) USING parquet "
        f"CLUSTERED BY (url) INTO {n} BUCKETS LOCATION '{path}/buckets={n}'"
    )
    spark.catalog.refreshTable(name)
    return PageIndex(spark, name, n)
