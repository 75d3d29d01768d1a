"""The jobs table as a status machine: insert, update, evolve, reset."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.functions.nodes import page_text
from winnow.functions.text import raw_filename
from winnow.functions.urls import job_id
from winnow.schemas import JOBS
from winnow.sources.html import html_nodes
from winnow.sources.page_index import PageIndex
from winnow.sources.tables import stored


def empty_jobs(spark: SparkSession) -> DataFrame:
    """A fresh, or reset, jobs table."""
    return spark.createDataFrame([], JOBS)


def insert_new(
    jobs: DataFrame,
    listings: DataFrame,
    *,
    order: Iterable[str] = ("page_id", "pos"),
    as_of: Column | None = None,
    extra: Iterable[str] = (),
) -> DataFrame:
    """The rows the listings add to ``jobs``: those whose id no row of any status has.

    The first listing of an id in ``order`` wins. It is picked by an aggregate, which keeps
    one candidate per id and task before anything is shuffled, so an address that fills a
    third of the input costs no more than any other. The anti join then works on the same
    partitioning by id. ``extra`` listing columns are kept beside the jobs columns.
    """
    order, extra = list(order), list(extra)
    if as_of is None:
        as_of = F.date_trunc("second", F.current_timestamp())
    carried = ["company", "ats_provider", "title", "location", "url", *extra]
    first = listings.groupBy(job_id(F.col("url")).alias("id")).agg(
        F.min_by(F.struct(*carried), F.struct(*order)).alias("row")
    )
    made = {
        "company": F.col("row.company"),
        "ats_provider": F.col("row.ats_provider"),
        "title": F.col("row.title"),
        "location": F.col("row.location"),
        "apply_url": F.col("row.url"),
        "status": F.lit("new"),
        "created_at": as_of,
        "relevance_score": F.lit(0),
    }
    return first.join(jobs.select("id"), "id", "left_anti").select(
        "id",
        *[
            made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in JOBS.fields
            if f.name != "id"
        ],
        *[F.col(f"row.{c}").alias(c) for c in extra],
    )


def first_of_key(rows: DataFrame, key: Iterable[str], order: Iterable[str]) -> DataFrame:
    """The first row of each key; like ``insert_new`` it combines before it shuffles."""
    key = list(key)
    rest = [c for c in rows.columns if c not in key]
    return (
        rows.groupBy(*key)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
        .select(*key, *[F.col(f"row.{c}").alias(c) for c in rest])
    )


def update_by_key(
    jobs: DataFrame,
    updates: DataFrame,
    columns: Iterable[str],
    *,
    key: str = "id",
    where: Column | None = None,
    order: Iterable[str] = (),
) -> DataFrame:
    """``jobs`` with ``columns`` replaced, nulls included, where ``updates`` has the key.

    Of several updates for a key the last in ``order`` counts. That grouping and the join
    use the same partitioning, so keeping the result one row per job is no extra shuffle.
    """
    columns, order = list(columns), list(order)
    fields = F.struct(*columns)
    latest = F.max_by(fields, F.struct(*order)) if order else F.max(fields)
    new = updates.groupBy(key).agg(latest.alias("new"))
    hit = F.col("new").isNotNull()
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    return jobs.join(new, key, "left").select(
        *[
            F.when(hit, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in jobs.columns
        ]
    )


def is_pending() -> Column:
    """Not yet described and not ignored; a null status is neither."""
    return F.col("description").isNull() & (F.col("status") != "ignored")


def pending_details(jobs: DataFrame) -> DataFrame:
    return jobs.where(is_pending())


def _firsts(pages: DataFrame, index: PageIndex | None, urls: DataFrame | None = None) -> DataFrame:
    """url and page_id of the first copy of each address, or of those of ``urls``."""
    if index is not None:
        return index.firsts() if urls is None else index.first_copies(urls)
    firsts = pages.groupBy("url").agg(F.min("page_id").alias("page_id"))
    return firsts if urls is None else firsts.join(urls.distinct(), "url", "left_semi")


def fetched_pages(jobs: DataFrame, pages: DataFrame, index: PageIndex | None = None) -> DataFrame:
    """The page of each pending address: its first copy, by ``page_id``.

    Copies are settled on two narrow columns, and many rows that point at one page are
    folded first; the markup is read once, for pages in use. Their numbers are stored, so that
    Spark knows their size before it reads any markup: few enough are broadcast, and the markup
    is scanned where it lies; more are matched in one shuffle. With an ``index`` of the pages
    their addresses are not grouped anew: only the wanted ones are shuffled.
    """
    wanted = pending_details(jobs).select(F.col("apply_url").alias("url"))
    firsts = stored(_firsts(pages, index, wanted).select("page_id"))
    return pages.join(firsts, "page_id", "left_semi").where(F.col("html").isNotNull())


def pending_with_page(jobs: DataFrame, pages: DataFrame, index: PageIndex | None = None) -> DataFrame:
    """Ids of the pending rows whose page may have arrived; no markup is read but for its presence.

    With an ``index`` none is read at all, so rows whose page has no markup count as well.
    """
    arrived = pages.where(F.col("html").isNotNull()) if index is None else index.firsts()
    arrived = arrived.select(F.col("url").alias("apply_url"))
    return pending_details(jobs).select("id", "apply_url").join(arrived, "apply_url", "left_semi").select("id")


def apply_details(
    jobs: DataFrame, pages: DataFrame, raw_dir: str = "data/raw_jobs", index: PageIndex | None = None
) -> DataFrame:
    """Pending rows whose page has arrived get its text and become ``scraped``.

    Rows without a page, or with one that cannot be scanned, stay as they are. Each page is
    scanned once, before the join, however many rows point at it. Pages that an ``index`` does not have
    yet have not arrived.
    """
    texts = (
        html_nodes(fetched_pages(jobs, pages, index), "url", attributes=())
        .where(F.col("error").isNull())
        .select("url", page_text(F.col("nodes")).alias("text"))
    )
    waiting = pending_details(jobs)
    rest = jobs.where(~F.coalesce(is_pending(), F.lit(False)))
    hit = F.col("text").isNotNull()
    path = F.concat(
        F.lit(raw_dir.rstrip("/") + "/"),
        raw_filename(F.col("company"), F.col("title"), F.col("location"), F.col("id")),
    )
    new = {
        "description": F.col("text"),
        "status": F.when(hit, F.lit("scraped")).otherwise(F.col("status")),
        "raw_path": F.when(hit, path).otherwise(F.col("raw_path")),
    }
    done = waiting.join(texts, waiting["apply_url"] == texts["url"], "left").select(
        *[new[c].alias(c) if c in new else F.col(c) for c in jobs.columns]
    )
    return done.unionByName(rest)


def raw_pages(jobs: DataFrame, pages: DataFrame, index: PageIndex | None = None) -> DataFrame:
    """``(company, raw_path, html)`` of the rows whose page is kept under ``raw_path``."""
    firsts = _firsts(pages, index)
    used = jobs.where(F.col("raw_path").isNotNull()).join(
        firsts, F.col("apply_url") == firsts["url"]
    )
    return used.select("company", "raw_path", "page_id").join(
        pages.select("page_id", "html"), "page_id"
    ).select("company", "raw_path", "html")


def write_raw_pages(rows: DataFrame, path: str) -> None:
    """Raw markup as one Parquet table, named by its ``raw_path`` column. Replaces what a run left."""
    rows.write.mode("overwrite").parquet(path)


def mark_generated(jobs: DataFrame, done: DataFrame) -> DataFrame:
    """Approved rows with an id in ``done`` become ``generated``. No others are joined."""
    approved = F.col("status") == "approved"
    marks = done.select("id", F.lit("generated").alias("mark")).distinct()
    marked = jobs.where(approved).join(marks, "id", "left").withColumn("status", F.coalesce("mark", "status"))
    rest = jobs.where(~F.coalesce(approved, F.lit(False)))
    return marked.select(*jobs.columns).unionByName(rest)


# Defaults of columns that older tables lack.
LATE_COLUMNS = {"relevance_score": 0}


def evolve(jobs: DataFrame, schema: T.StructType = JOBS, defaults=LATE_COLUMNS) -> DataFrame:
    """Add each missing column on its own, with its default; others stay as they are."""
    missing = [f for f in schema.fields if f.name not in jobs.columns]
    return reduce(
        lambda df, f: df.withColumn(f.name, F.lit(defaults.get(f.name)).cast(f.dataType)),
        missing,
        jobs,
    )


def status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
