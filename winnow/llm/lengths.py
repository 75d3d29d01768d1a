"""Token counts for every context limit from one exact histogram of encoded lengths.

Documents are counted by encoded length; the histogram has a row per length that occurs. Prefix and
suffix sums over it answer, for every limit L: how many documents fit, how many ids there are in all,
and how many are left if longer documents are cut at L.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from winnow.llm.shared import stored, texts_of
from winnow.llm.tokens import encoder

#: Lengths per group of the two-level sums, so that no task holds the whole histogram.
GROUP = 1024


def encoded_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and n_tokens of every row. A null text counts as empty, with no ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for row, counts, _ in encode(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(counts)), pa.array(counts, pa.int64())],
                    names=["doc_id", "n_tokens"],
                )

    return texts_of(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        count, "doc_id long, n_tokens long"
    )


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """length, n_docs: the number of rows of each length; rows without a length do not count."""
    found = lengths.select(F.col(column).cast("long").alias("length")).where("length is not null")
    return found.groupBy("length").agg(F.count("*").alias("n_docs"))


def by_limit(counts: DataFrame) -> DataFrame:
    """One row for each length that occurs, taken as a context limit.

    n_docs, n_ids: documents of just that length and their ids. docs_within, ids_within: of that
    length or shorter. docs_over, ids_over: longer. ids_truncated: ids left if longer documents are
    cut at the limit. total_docs, total_ids. share_within: the part of the documents that fit, so a
    quantile q is the least limit whose share reaches q. Limits between two lengths lose docs_over of
    the lower one for each id less. An empty table gives no rows.
    """
    rows = stored(counts.withColumn("part", F.expr(f"length div {GROUP}")))
    sums = [F.sum("n_docs").alias("docs"), F.sum(F.col("length") * F.col("n_docs")).alias("ids")]
    parts = rows.groupBy("part").agg(*sums)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.select(
        "part",
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("ids_before"),
        F.sum("docs").over(whole).alias("total_docs"),
        F.sum("ids").over(whole).alias("total_ids"),
    )
    here = Window.partitionBy("part").orderBy("length")
    n_ids = F.col("length") * F.col("n_docs")
    out = rows.join(parts, "part").select(
        "length", "n_docs", n_ids.alias("n_ids"), "total_docs", "total_ids",
        (F.col("docs_before") + F.sum("n_docs").over(here)).alias("docs_within"),
        (F.col("ids_before") + F.sum(n_ids).over(here)).alias("ids_within"),
    )
    over = F.col("total_docs") - F.col("docs_within")
    return out.select(
        F.col("length").alias("context_limit"), "n_docs", "n_ids", "docs_within", "ids_within",
        over.alias("docs_over"), (F.col("total_ids") - F.col("ids_within")).alias("ids_over"),
        (F.col("ids_within") + F.col("length") * over).alias("ids_truncated"),
        "total_docs", "total_ids", (F.col("docs_within") / F.col("total_docs")).alias("share_within"),
    )


def quantile(limits: DataFrame, share: float) -> DataFrame:
    """The least limit that at least ``share`` of the documents fit: a nearest-rank quantile."""
    fits = limits.where(F.col("docs_within") >= F.ceil(F.col("total_docs") * F.lit(share)))
    return fits.agg(F.min("context_limit").alias("context_limit"))


def at_limit(limits: DataFrame, limit: int) -> DataFrame:
    """What any limit, of a length that occurs or not, fits and leaves."""
    ids = F.least(F.col("context_limit"), F.lit(limit)) * F.col("n_docs")
    fits = F.col("context_limit") <= limit
    return limits.agg(
        F.coalesce(F.sum(F.when(fits, F.col("n_docs"))), F.lit(0)).alias("docs_within"),
        F.coalesce(F.sum(ids), F.lit(0)).alias("ids_truncated"),
    )
