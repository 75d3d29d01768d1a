"""Address functions: Column in, Column out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from winnow import defaults


def company_name(
    url: Column,
    overrides: Iterable[tuple[str, str]] = defaults.COMPANY_OVERRIDES,
    generic: Iterable[str] = defaults.GENERIC_SUBDOMAINS,
) -> Column:
    """Company from the host labels; ``unknown`` when the address has none."""
    labels = F.split(F.get(F.split(url, "//"), F.lit(1)), r"\.")
    first = F.get(labels, F.lit(0))
    name = F.when(first.isin(*generic), F.get(labels, F.lit(1))).otherwise(first)
    for part, company in reversed(list(overrides)):
        name = F.when(F.contains(url, F.lit(part)), F.lit(company)).otherwise(name)
    return F.coalesce(name, F.lit("unknown"))


def host(url: Column) -> Column:
    """Lower-case authority part (user and port included), empty if there is none."""
    return F.lower(
        F.coalesce(
            F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1), F.lit("")
        )
    )


def absolute(href: Column) -> Column:
    return F.startswith(href, F.lit("http"))


def normalize_url(href: Column, base: Column) -> Column:
    return (
        F.when(absolute(href), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href))
        .otherwise(
            F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.ltrim(href, F.lit("/")))
        )
    )


def prefixed_url(href: Column, prefix: str) -> Column:
    return F.when(absolute(href), href).otherwise(F.concat(F.lit(prefix), href))


def scheme_fixed_url(href: Column) -> Column:
    return F.replace(prefixed_url(href, "https:"), F.lit("https:https:"), F.lit("https:"))


def site_url(href: Column, page_url: Column) -> Column:
    """``/x`` goes to the site root, anything else below the page."""
    parts = F.split(page_url, "/")
    site = F.concat(F.get(parts, F.lit(0)), F.lit("//"), F.get(parts, F.lit(2)))
    return (
        F.when(absolute(href), href)
        .when(F.startswith(href, F.lit("/")), F.concat(site, href))
        .otherwise(F.concat(F.rtrim(page_url, F.lit("/")), F.lit("/"), href))
    )


def job_id(url: Column) -> Column:
    return F.md5(url)


def detect_ats(
    url: Column,
    rules: Iterable[tuple[str, str, str]] = defaults.ATS_RULES,
    fallback: tuple[str, str] = defaults.FALLBACK_RULE,
) -> Column:
    """``struct(profile, label)`` of the first rule whose text occurs in the host."""
    where = host(url)
    chosen = F.struct(F.lit(fallback[0]).alias("profile"), F.lit(fallback[1]).alias("label"))
    for domain, profile, label in reversed(list(rules)):
        chosen = F.when(
            F.contains(where, F.lit(domain)),
            F.struct(F.lit(profile).alias("profile"), F.lit(label).alias("label")),
        ).otherwise(chosen)
    return chosen
