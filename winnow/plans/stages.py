"""The stages run against a stored jobs table: read the newest version, write the next.

The table lies in buckets of the id. A stage finds the ids whose rows change, reads and writes
their buckets alone, and an insert looks its ids up in theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.functions.urls import job_id
from winnow.operators.documents import build_prompts, write_documents
from winnow.operators.extract import extract, scan_errors
from winnow.operators.logdigest import TAIL, digest_lines
from winnow.operators.profiles import LIVE_PROFILES
from winnow.operators.state import (
    LATE_COLUMNS,
    apply_details,
    empty_jobs,
    insert_new,
    mark_generated,
    pending_details,
    pending_with_page,
    raw_pages,
    update_by_key,
    write_raw_pages,
)
from winnow.operators.triage import apply_triage, triage, triage_summary
from winnow.plans.application import ingest_responses
from winnow.plans.discovery import discovery_metrics, dispatch, in_target_order
from winnow.schemas import JOBS
from winnow.sources.logs import read_outline
from winnow.sources.page_index import PageIndex
from winnow.sources.tables import Version, buckets_of, land, newest, read_latest, read_version, stored, write_next

# Stages look at few statuses; as partitions the others are not read.
LAYOUT = ("status",)


def jobs_table(spark: SparkSession, root: str) -> DataFrame:
    return read_latest(spark, root, JOBS, LATE_COLUMNS)


def known_ids(spark: SparkSession, root: str, listings: DataFrame) -> tuple[DataFrame, int]:
    """Ids of the jobs table in the buckets of the listings' ids, and its number of buckets."""
    seen = newest(spark, root)
    ids = listings.select(job_id(F.col("url")).alias("id"))
    only = buckets_of(ids, "id", seen.n_buckets) if seen.buckets else None
    return read_version(spark, seen, JOBS, buckets=only).select("id"), seen.n_buckets


def _seen(spark: SparkSession, root: str) -> tuple[Version, DataFrame]:
    seen = newest(spark, root)
    return seen, read_version(spark, seen, JOBS, LATE_COLUMNS)


def _write(
    spark: SparkSession, root: str, seen: Version, touched: DataFrame, make: Callable[[DataFrame], DataFrame]
) -> int:
    """The next version: the buckets that hold the ``touched`` ids, made anew. None is written if there are none.

    A table that has no buckets yet is written whole, into some.
    """
    if not seen.buckets:
        return write_next(make(read_version(spark, seen, JOBS, LATE_COLUMNS)), root, LAYOUT, seen, "id")[0]
    only = buckets_of(touched, "id", seen.n_buckets)
    if not only:
        return seen.number
    return write_next(make(read_version(spark, seen, JOBS, LATE_COLUMNS, only)), root, LAYOUT, seen, "id", only)[0]


@dataclass(frozen=True)
class Discovered:
    counts: DataFrame  # found and new per company and parser
    errors: DataFrame  # id, stage, message of the pages that could not be scanned


def run_discovery(
    pages: DataFrame,
    root: str,
    *,
    targets: DataFrame | None = None,
    profiles=LIVE_PROFILES,
    as_of=None,
    **options,
) -> Discovered:
    """Add the pages' new listings, which land beside the newest version.

    With ``targets`` (``distinct_targets``) only their pages are visited, and the first listing of an
    id is that of the first target; else that of the first page. The listings are written first:
    they are needed four times, and reading them back is cheaper, and safer when executors are lost,
    than scanning the pages again. Of the jobs only the ids are read, in the buckets the listings fall into.
    """
    spark = pages.sparkSession
    visited = dispatch(pages if targets is None else in_target_order(pages, targets), **options)
    first = () if targets is None else ("ord",)
    keep = (*first, "page_id", "url", "company", "parser")
    scanned = stored(extract(visited, profiles, keep=keep, errors=True))
    listings = scanned.where(F.col("url").isNotNull())
    known, n = known_ids(spark, root, listings)
    new = insert_new(known, listings, order=(*first, "page_id", "pos"), as_of=as_of, extra=["parser"])
    added = stored(new)
    land(added.drop("parser"), root, "id", n)
    return Discovered(discovery_metrics(listings, added, visited=visited), scan_errors(scanned))


def run_details(pages: DataFrame, root: str, raw: str | None = None, index: PageIndex | None = None) -> int:
    """Give pending rows their page's text; with ``raw``, keep the markup there as well.

    The markup is written first: a run that is cut off leaves its rows pending, and the next one
    writes the markup of the same version anew. Rows are stored before that, so pages are scanned once.
    With an ``index`` that has taken in the pages, their addresses are not shuffled in every run.
    """
    spark = pages.sparkSession
    seen, jobs = _seen(spark, root)
    touched = pending_with_page(jobs, pages, index)
    if raw is None:
        return _write(spark, root, seen, touched, lambda rows: apply_details(rows, pages, index=index))

    def make(rows: DataFrame) -> DataFrame:
        done = stored(apply_details(rows, pages, index=index))
        now = done.join(pending_details(rows).select("id"), "id", "left_semi")
        write_raw_pages(raw_pages(now, pages, index), f"{raw}/version={seen.number + 1}")
        return done

    return _write(spark, root, seen, touched, make)


def run_triage(spark: SparkSession, root: str, **keywords) -> DataFrame:
    """Judge the scraped rows; returns how many were approved and ignored."""
    seen, jobs = _seen(spark, root)
    scraped = jobs.where(F.col("status") == "scraped")
    _write(spark, root, seen, scraped, lambda rows: apply_triage(rows, **keywords))
    return triage_summary(triage(jobs, **keywords))


def run_prompts(spark: SparkSession, root: str, candidate: str, path: str) -> None:
    build_prompts(jobs_table(spark, root), candidate).write.mode("overwrite").parquet(path)


def run_generation(
    responses: DataFrame, root: str, identity: Mapping[str, str], templates: Mapping[str, str], path: str, **options
) -> DataFrame:
    """Write the documents, then the new state; returns the rows that could not be used.

    Rows are marked from the documents as written: replies are parsed once, and no row is
    ``generated`` without its documents.
    """
    spark = responses.sparkSession
    seen, jobs = _seen(spark, root)
    done = ingest_responses(jobs, responses, identity, templates, **options)
    written = spark.read.schema(done.documents.schema).parquet(write_documents(done.documents, path))
    _write(spark, root, seen, written, lambda rows: mark_generated(rows, written))
    return done.errors


def run_update(updates: DataFrame, root: str, columns: Iterable[str], *, where: Column | None = None, order: Iterable[str] = ()) -> int:
    """Set ``columns`` of the rows whose id ``updates`` has, nulls included, as ``update_by_key`` does.

    The updates are read twice: store them first if they are dear to make.
    """
    spark, columns, order = updates.sparkSession, list(columns), list(order)
    seen, _ = _seen(spark, root)
    return _write(spark, root, seen, updates, lambda rows: update_by_key(rows, updates, columns, where=where, order=order))


def run_log_digest(spark: SparkSession, path: str, glob: str = "*.log", parts: bool = False) -> DataFrame:
    """Errors, or else the last lines, of the log files below ``path``, however large.

    With ``parts`` the files of a folder are one log, in the order of their names.
    """
    return digest_lines(read_outline(spark, path, glob, parts, tail=TAIL))


def run_reset(spark: SparkSession, root: str) -> int:
    """An empty version; what has landed so far goes as well. On no table yet it makes one."""
    return write_next(empty_jobs(spark), root, LAYOUT, newest(spark, root), "id")[0]


def run_compaction(spark: SparkSession, root: str, buckets: int | None = None) -> int:
    """A whole version of the rows as they are: takes in what has landed and what updates wrote.

    Run it now and then, as each update since the last whole version is one more folder to look into; with
    ``buckets`` the table is dealt into so many.
    """
    seen, jobs = _seen(spark, root)
    return write_next(jobs, root, LAYOUT, seen, "id", buckets=buckets)[0]
