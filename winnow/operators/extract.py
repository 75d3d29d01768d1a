"""Listings of a page: profiles compiled to native expressions over the node array.

A page's listings are one array expression, so extraction of all layouts is a single
projection after the HTML scan, with no shuffle; which layout applies is a ``CASE``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions import nodes as N
from winnow.functions import urls
from winnow.functions.text import WHITESPACE, contains_any, let, matches_role
from winnow.operators.profiles import LIVE_PROFILES, REFERENCE, Profile
from winnow.sources.html import html_nodes

_LISTING_FIELDS = "array<struct<pos:bigint,title:string,location:string,url:string,ats_provider:string>>"


def _href(profile: Profile, link: Column) -> Column:
    href = link["attrs"]["href"]
    if profile.href_rule == "any":
        href = F.coalesce(href, F.lit(""))
    return F.btrim(href, F.lit(WHITESPACE)) if profile.href_strip else href


def _items(profile: Profile, nodes: Column) -> Column:
    primary = F.filter(nodes, profile.items.test)
    if profile.items_fallback is None:
        return primary
    return let(
        primary,
        lambda found: F.when(F.size(found) > 0, found).otherwise(
            F.filter(nodes, profile.items_fallback.test)
        ),
    )


def _link(profile: Profile, nodes: Column, item: Column) -> Column:
    if profile.link_is_item is None:
        return N.find(nodes, item, profile.link)
    if profile.items.tags == profile.link_is_item.tags:
        return item
    return F.when(profile.link_is_item.test(item), item).otherwise(
        N.find(nodes, item, profile.link)
    )


def _title(profile: Profile, nodes: Column, row: Column) -> Column:
    link = row["link"]
    if profile.title_first_piece:
        plain = F.coalesce(
            F.get(N.pieces(N.subtree(nodes, link)), F.lit(0)), F.lit(profile.title_default)
        )
    elif profile.title_default is not None:
        plain = F.lit(profile.title_default)
    else:
        plain = N.text(nodes, link, profile.title_sep)
    if not profile.title:
        return plain
    within = link if profile.title_in == "link" else row["item"]
    return let(
        N.find_any(nodes, within, profile.title),
        lambda tag: F.when(tag.isNotNull(), N.text(nodes, tag, profile.title_sep)).otherwise(plain),
    )


def _marks(profile: Profile, nodes: Column) -> Column:
    """What the places of all links of a page are looked up in: worked out once a page."""
    return F.struct(
        N.enclosing(nodes, profile.row_tag).alias("row"),
        *[N.next_match(nodes, s).alias(f"match{i}") for i, s in enumerate(profile.place)],
    )


def _place(profile: Profile, nodes: Column, row: Column, marks: Column | None) -> Column:
    default = F.lit(profile.place_default)
    if not profile.place:
        return default

    def text_of(tag: Column) -> Column:
        return F.when(tag.isNotNull(), N.text(nodes, tag)).otherwise(default)

    if profile.place_in == "row":
        matches = [marks[f"match{i}"] for i in range(len(profile.place))]
        at = F.get(marks["row"], row["link"]["pre"])
        return let(
            F.when(at >= 0, F.get(nodes, at)),
            lambda near: let(N.first_below(nodes, near, matches), text_of),
        )
    within = row["link"] if profile.place_in == "link" else row["item"]
    found = N.find_any(nodes, within, profile.place)
    if profile.place_for_link_items:
        also = F.when(
            row["item"]["tag"] == "a", N.find_any(nodes, within, profile.place_for_link_items)
        )
        found = F.coalesce(found, also)
    return let(found, text_of)


def _url(profile: Profile, href: Column, page_url: Column) -> Column:
    if profile.address == "normalize":
        return urls.normalize_url(href, page_url if profile.base is None else F.lit(profile.base))
    if profile.address == "prefix":
        return urls.prefixed_url(href, profile.base)
    if profile.address == "scheme":
        return urls.scheme_fixed_url(href)
    if profile.address == "site":
        return urls.site_url(href, page_url)
    return href


def _title_ok(profile: Profile, row: Column) -> Column:
    title, href = row["title"], row["href"]
    checks = []
    if profile.title_min:
        checks.append(F.length(title) >= profile.title_min)
    if profile.title_skip:
        checks.append(~contains_any(F.lower(title), profile.title_skip))
    if profile.roles is not None:
        role = matches_role(title, profile.roles)
        if profile.role_hrefs:
            role = role | contains_any(F.lower(href), profile.role_hrefs)
        checks.append(role)
    return reduce(lambda a, b: a & b, checks)


@lru_cache(maxsize=64)  # an expression takes longer to put together than a small table to read
def listings_of(profile: Profile) -> Column:
    """Array of ``struct(pos, title, location, url, ats_provider)`` in page order.

    Reads the columns ``nodes`` and ``url`` of ``html_nodes``.
    """
    nodes, page_url = F.col("nodes"), F.col("url")

    def link_row(item: Column) -> Column:
        return F.struct(item.alias("item"), _link(profile, nodes, item).alias("link"))

    def href_row(row: Column) -> Column:
        return F.struct(
            row["item"].alias("item"), row["link"].alias("link"), _href(profile, row["link"]).alias("href")
        )

    def href_ok(row: Column) -> Column:
        ok = row["link"].isNotNull() & row["href"].isNotNull()
        if profile.href_rule == "nonempty":
            ok = ok & (row["href"] != "")
        if profile.href_pattern is not None:
            ok = ok & row["href"].rlike(profile.href_pattern)
        return ok

    def titled(row: Column) -> Column:
        return F.struct(
            row["item"].alias("item"),
            row["link"].alias("link"),
            row["href"].alias("href"),
            _title(profile, nodes, row).alias("title"),
        )

    def listing(row: Column, marks: Column | None = None) -> Column:
        return F.struct(
            row["item"]["pre"].cast("bigint").alias("pos"),
            row["title"].alias("title"),
            _place(profile, nodes, row, marks).alias("location"),
            _url(profile, row["href"], page_url).alias("url"),
            F.lit(profile.provider).alias("ats_provider"),
        )

    rows = F.transform(F.transform(_items(profile, nodes), link_row), href_row)
    rows = F.filter(rows, href_ok)
    if profile.dedupe == "before":
        rows = N.keep_first(rows, lambda r: r["href"])
    rows = F.transform(rows, titled)
    if profile.title_min or profile.title_skip or profile.roles is not None:
        rows = F.filter(rows, lambda r: _title_ok(profile, r))
    if profile.dedupe == "after":
        rows = N.keep_first(rows, lambda r: r["href"])
    elif profile.dedupe == "url":
        rows = N.keep_first(rows, lambda r: _url(profile, r["href"], page_url))
    if profile.place and profile.place_in == "row":
        return let(_marks(profile, nodes), lambda m: F.transform(rows, lambda r: listing(r, m))).cast(_LISTING_FIELDS)
    return F.transform(rows, lambda r: listing(r)).cast(_LISTING_FIELDS)


def may_list(profile: Profile) -> Column:
    """Whether a page's markup may hold a listing: quick to test, and never wrong on a no."""
    html, hints = F.col("html"), profile.hints()
    every = reduce(lambda a, b: a & b, (html.rlike(h) for h in hints), html.isNotNull())
    return every | html.rlike(REFERENCE) if hints else every


def extract(
    pages: DataFrame,
    profiles: Mapping[str, Profile] | Profile = LIVE_PROFILES,
    *,
    profile: Column | None = None,
    keep: tuple[str, ...] = ("page_id", "url", "company"),
    errors: bool = False,
    every: bool = False,
) -> DataFrame:
    """Listings of all pages in one pass: ``keep`` columns (``url`` as ``page_url``) + listing.

    ``pages`` needs ``url`` and ``html``, and with several profiles the ``profile`` column
    or expression naming the one to use. A page that cannot be scanned yields no rows
    (``page_errors`` lists them); with ``errors`` it is one row with its message in ``error``,
    and without a ``url`` (``scan_errors``). Pages whose markup lacks what every listing of their
    profile holds are left out before the scan.

    ``pages`` that ``html_nodes`` has scanned, with the attributes that the profiles name, are not scanned
    again. With ``every`` each page that reaches the extraction has a row, without a ``url`` if it lists nothing.
    """
    single = isinstance(profiles, Profile)
    kept = list(keep)
    if not single:
        pages = pages.withColumn("profile", F.col("profile") if profile is None else profile)
        if "profile" not in kept:
            kept.append("profile")
    used = [profiles] if single else profiles.values()
    has_markup = "html" in pages.columns  # else they have been scanned
    if has_markup and single:
        pages = pages.where(may_list(profiles))
    elif has_markup:
        tests = [F.when(F.col("profile") == name, may_list(p)) for name, p in profiles.items()]
        pages = pages.where(F.coalesce(*tests))
    scanned = html_nodes(pages, *kept, attributes=set().union(*(p.attributes() for p in used)))
    if single:
        found = listings_of(profiles)
    else:
        found = None
        for name, p in profiles.items():
            rows, hit = listings_of(p), F.col("profile") == name
            found = F.when(hit, rows) if found is None else found.when(hit, rows)
    shown = [F.col(c).alias("page_url") if c == "url" else F.col(c) for c in keep]
    # Outer, as the plain form makes the optimizer test the array's size first and
    # so evaluate the whole extraction twice.
    listed = F.col("url").isNotNull() | F.lit(every)
    if not errors:
        return scanned.select(*shown, F.inline_outer(found)).where(listed)
    return scanned.select(*shown, "error", F.inline_outer(found)).where(listed | F.col("error").isNotNull())


def page_errors(pages: DataFrame) -> DataFrame:
    """``(id, stage, message)`` of the pages that could not be scanned."""
    return scan_errors(html_nodes(pages, "page_id", attributes=()))


def scan_errors(scanned: DataFrame) -> DataFrame:
    """The same of rows with ``page_id`` and ``error``, as ``html_nodes`` and ``extract`` give them."""
    return scanned.where(F.col("error").isNotNull()).select(
        F.col("page_id").cast("string").alias("id"),
        F.lit("scan").alias("stage"),
        F.col("error").alias("message"),
    )
