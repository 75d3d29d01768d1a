"""From pages to new rows of the jobs table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow import defaults
from winnow.functions import urls
from winnow.operators.extract import extract
from winnow.operators.profiles import LIVE_PROFILES, Profile
from winnow.operators.state import insert_new
from winnow.sources.tables import stored


def detect_ats_join(pages: DataFrame, rules: DataFrame, fallback=defaults.FALLBACK_RULE) -> DataFrame:
    """Layout by a rule table ``(priority, domain, profile, label)`` of any size.

    "Occurs in the host" is made an equi-join: each distinct host is cut into its pieces that are as
    long as some rule's text, of which only the distinct lengths come to the driver. There are far
    fewer hosts than pages, and one that holds a third of the pages is cut up once. The hosts that
    a rule names are stored, so that their size is known when they are matched with the pages.
    """
    lengths = rules.select(F.length("domain")).where(F.col("domain").isNotNull()).distinct()
    sizes = [r[0] for r in lengths.collect()]
    hosts = pages.select(urls.host(F.col("url")).alias("host")).distinct()
    host = F.col("host")
    cut = F.flatten(
        F.transform(
            F.array(*[F.lit(n) for n in sizes]).cast("array<int>"),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(host) - n + 1, F.lit(1))),
                lambda at: F.substring(host, at, n),
            ),
        )
    )
    first = (
        hosts.select("host", F.explode_outer(F.array_distinct(cut)).alias("domain"))
        .join(rules, "domain")
        .groupBy("host")
        .agg(F.min_by(F.struct("profile", "label"), "priority").alias("rule"))
    )
    first = stored(first)
    return (
        pages.withColumn("host", urls.host(F.col("url")))
        .join(first, "host", "left")
        .select(
            *pages.columns,
            F.coalesce("rule.profile", F.lit(fallback[0])).alias("profile"),
            F.coalesce("rule.label", F.lit(fallback[1])).alias("label"),
        )
    )


def in_target_order(pages: DataFrame, targets: DataFrame) -> DataFrame:
    """Pages of the targets, with the target's ``ord``."""
    return pages.join(targets.select("url", "ord"), "url")


def dispatch(
    pages: DataFrame,
    *,
    rules: Iterable[tuple[str, str, str]] = defaults.ATS_RULES,
    fallback: tuple[str, str] = defaults.FALLBACK_RULE,
    overrides: Iterable[tuple[str, str]] = defaults.COMPANY_OVERRIDES,
) -> DataFrame:
    """``pages`` with the ``company``, the ``profile`` to read them by, and its label, ``parser``."""
    url = F.col("url")
    return pages.withColumns(
        {"company": urls.company_name(url, overrides), "ats": urls.detect_ats(url, rules, fallback)}
    ).select(*pages.columns, "company", F.col("ats.profile").alias("profile"), F.col("ats.label").alias("parser"))


def discover(
    pages: DataFrame,
    *,
    profiles: Mapping[str, Profile] = LIVE_PROFILES,
    keep: tuple[str, ...] = ("page_id",),
    **options,
) -> DataFrame:
    """Listings of all pages, each read by the layout its host calls for, in one scan.

    ``options`` are those of ``dispatch``.
    """
    return extract(dispatch(pages, **options), profiles, keep=(*keep, "url", "company", "parser"))


def discover_new(jobs: DataFrame, pages: DataFrame, *, as_of=None, **options) -> DataFrame:
    """The rows that the pages add to ``jobs``."""
    return insert_new(jobs, discover(pages, **options), as_of=as_of)


def discovery_metrics(
    listings: DataFrame,
    inserted: DataFrame,
    *,
    keys: Iterable[str] = ("company", "parser"),
    visited: DataFrame | None = None,
) -> DataFrame:
    """Listings found and rows added per company and parser, with subtotals and the total.

    ``inserted`` is ``insert_new(…, extra=("parser",))``, or more for other ``keys``. With
    ``visited``, the dispatched pages, those without listings count as well, with zeros.

    Found and added rows are counted in one grouping, so the listings need not be matched
    against the added rows, and subtotals are made from the counts, as a rollup first
    copies each of its rows.
    """
    keys = list(keys)

    def ones(rows: DataFrame, found: int, new: int) -> DataFrame:
        return rows.select(*keys, F.lit(found).alias("found"), F.lit(new).alias("new"))

    counted = ones(listings, 1, 0).unionByName(ones(inserted, 0, 1))
    if visited is not None:
        counted = counted.unionByName(ones(visited, 0, 0))
    sums = [F.sum(c).alias(c) for c in ("found", "new")]
    return counted.groupBy(*keys).agg(*sums).rollup(*keys).agg(*sums)
