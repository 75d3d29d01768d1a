"""One query per page layout, over pages that Spark builds from ``part``.

A page holds eight parts, two of which share a link. The SQL works out the listings from
``part`` itself, without any markup.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query, table
from winnow.operators import profiles as P
from winnow.operators.extract import extract
from winnow.plans.discovery import discover
from winnow.sources.html import html_nodes
from winnow.sources.tables import stored

ROLES = ("widget", "gear", "rod", "red")
ROLE_SQL = "regexp_matches(lower(title), 'widget|gear|rod|red')"

_HEAD = """<!DOCTYPE html><html><head><title>Open roles</title><style>a{}</style>
<script>var t="<a href='/posting/0'>hot rod</a>";</script></head><body><nav><ul>
<li><a href="/about">About</a><li><a href="/team">Team</a></ul></nav>
<!-- <a href="/jobs/1">hot rod</a> --><p>We are hiring<p>Join us<ul>"""
_FOOT = "</ul><footer>&copy; us &amp; them</footer>"


def _place(markup: str) -> Column:
    """Markup around the place, empty for the parts without one."""
    before, after = markup.split("@")
    return F.when(F.col("p_type") == "ECONOMY", "").otherwise(
        F.concat(F.lit(before), F.lit("City "), F.col("p_size").cast("string"), F.lit(after))
    )


def _item(layout: str) -> Column:
    other = F.col("p_size") > 40
    h = F.expr("p_partkey div 2").cast("string")
    title = F.concat("p_name", F.lit(" &amp; "), "p_brand")
    words = F.split("p_name", " ")
    w1, w2 = F.get(words, F.lit(0)), F.get(words, F.lit(1))
    pick = lambda a, b: F.when(other, a).otherwise(b)
    L = F.lit
    if layout == "ashby":
        return F.concat(
            L('<a href="/'), pick("other", "posting"), L("/"), h, L('"><b>'), w1, L("</b>\n<i> "),
            w2, L(" &amp; "), F.col("p_brand"), L("</i></a>"),
        )
    if layout == "greenhouse":
        return F.concat(
            L('<div class="'), pick("openings", "opening"), L(' x"><a href="/a/jobs/'), h, L('">'),
            title, L("</a>"), _place('<span class="location">@</span>'), L("</div>"),
        )
    if layout == "lever":
        place = F.when(
            F.col("p_size") % 2 == 0,
            F.concat(L('<span class="location">Else</span>'), _place('<span class="sort-by-location">@</span>')),
        ).otherwise(_place('<span class="location">@</span>'))
        return F.concat(
            L('<a class="big '), pick("posting", "posting-title"), L('" href="https://jobs.lever.co/a/'), h,
            L('"><h5 data-qa="posting-name">'), title, L("</h5>"), place, L("</a>"),
        )
    if layout == "teamtailor":
        block = F.concat(
            L('<li class="w '), pick("grid", "block-grid-item"), L('"><a href="'),
            pick("/about/", "//h/jobs/"), h, L('"><span title="x">'), title, L("</span></a>"),
            _place('<div class="text-md">@</div>'), L("</li>"),
        )
        plain = F.concat(
            L('<a href="https://h/jobs/'), F.when(other, F.concat(L("x"), h)).otherwise(h), L('">'),
            title, L("<br>more</a>"),
        )
        return F.when(F.expr("(p_partkey div 64) % 2 = 0"), block).otherwise(plain)
    if layout == "workday":
        return F.concat(
            L('<li><div><a data-automation-id="'), pick("other", "jobTitle"), L('" href="/j/'), h, L('">'),
            title, L("</a></div><dl><dt>where"), _place('<dd data-automation-id="locations">@'), L("</dl></li>"),
        )
    if layout == "smartrecruiters":
        head = F.when(F.col("p_size") < 5, F.concat(L("<b>"), title, L("</b>"))).otherwise(
            F.concat(L("<h4>"), title, L("</h4>"))
        )
        return F.concat(
            L('<li class="x '), pick("opening", "opening-job"), L('"><a href="/R/'), h, L('">'), head,
            L("<i>note</i></a>"), _place('<span class="job-location">@</span>'), L("</li>"),
        )
    if layout == "workable":
        return F.concat(
            L('<li data-ui="'), pick("other", "job-opening"), L('"><a href="/j/'), h, L('"><h3>'), title,
            L("</h3></a>"), _place('<span class="x location-y">@</span>'), L("</li>"),
        )
    text = F.when(F.col("p_size") < 10, " ").otherwise(F.concat(L("<i>"), w1, L("</i><i>"), w2, L("</i>")))
    return F.concat(L('<a href="/'), pick("blog", "JOB"), L("/"), h, L('">'), text, L("</a>"))


# layout -> (address, company); ``@`` is the page's group of 0 to 4
SITES = {
    "ashby": ("https://jobs.ashbyhq.com/s@", "'ashbyhq'"),
    "greenhouse": ("https://boards.greenhouse.io/s@", "'boards'"),
    "lever": ("https://jobs.lever.co/s@", "'lever'"),
    "teamtailor": ("https://jobs.studio@.teamtailor.com/jobs", "'studio' || g"),
    "workday": ("https://studio@.myworkdayjobs.com/jobs/", "'studio' || g"),
    "smartrecruiters": ("https://careers.smartrecruiters.com/S@", "'smartrecruiters'"),
    "workable": ("https://apply.workable.com/s@/", "'apply'"),
    "simple": ("https://www.studio@.com/jobs?p=@", "'studio' || g"),
}
LABELS = {
    "ashby": "Ashby", "greenhouse": "Greenhouse", "lever": "Lever", "teamtailor": "Teamtailor",
    "workday": "Workday", "smartrecruiters": "SmartRecruiters", "workable": "Workable",
    "simple": "Simple/HTML",
}


def part_pages(spark: SparkSession, sf_dir: str, layout: str | None = None) -> DataFrame:
    """``(page_id, url, html)``: all parts in one layout, or page by page in each of them."""
    page_id, g = F.expr("p_partkey div 8"), F.expr("(p_partkey div 8) % 5").cast("string")

    def url_of(name):
        parts = [F.lit(x) for x in SITES[name][0].split("@")]
        return F.concat(*[p for x in parts for p in (x, g)][:-1])

    if layout is not None:
        item, url = _item(layout), url_of(layout)
    else:
        item = url = None
        for i, name in enumerate(SITES):
            here = page_id % len(SITES) == i
            item = F.when(here, _item(name)) if item is None else item.when(here, _item(name))
            url = F.when(here, url_of(name)) if url is None else url.when(here, url_of(name))
    items = table(spark, sf_dir, "part").select(
        page_id.alias("page_id"), url.alias("url"), F.struct("p_partkey", item.alias("item")).alias("item")
    )
    body = F.array_join(F.transform(F.sort_array("items"), lambda x: x["item"]), "\n")
    return (
        items.groupBy("page_id", "url")
        .agg(F.collect_list("item").alias("items"))  # eight at most
        .select("page_id", "url", F.concat(F.lit(_HEAD), body, F.lit(_FOOT)).alias("html"))
    )


ITEM_SQL = """item AS (
  SELECT p_partkey // 8 AS page_id, p_partkey AS k, p_partkey // 2 AS h,
         p_name || ' & ' || p_brand AS title, replace(p_name, ' ', '') AS tight,
         'City ' || p_size AS city, p_type = 'ECONOMY' AS nowhere, p_size > 40 AS other, p_size,
         (p_partkey // 64) % 2 = 0 AS blocks, (p_partkey // 8) % 5 AS g
  FROM part)"""

_FAR = "CASE WHEN nowhere THEN 'Remote/Unknown' ELSE city END"
_TEAM_PLACE = "CASE WHEN blocks AND NOT nowhere THEN city ELSE 'Remote/Stockholm' END"
# layout -> title, location, url
FIELDS_SQL = {
    "ashby": ("title", "'Remote/Unknown'", "'https://jobs.ashbyhq.com/posting/' || h"),
    "greenhouse": ("title", _FAR, "'https://boards.greenhouse.io/a/jobs/' || h"),
    "lever": (
        "title",
        "CASE WHEN NOT nowhere THEN city WHEN p_size % 2 = 0 THEN 'Else' ELSE 'Remote/Unknown' END",
        "'https://jobs.lever.co/a/' || h",
    ),
    "teamtailor": ("title", _TEAM_PLACE, "'https://h/jobs/' || h"),
    "workday": ("title", _FAR, "'https://studio' || g || '.myworkdayjobs.com/jobs/j/' || h"),
    "smartrecruiters": (
        "CASE WHEN p_size < 5 THEN title || 'note' ELSE title END",
        _FAR,
        "'https://careers.smartrecruiters.com/R/' || h",
    ),
    "workable": ("title", _FAR, "'https://apply.workable.com/j/' || h"),
    "simple": ("tight", "'Remote/Unknown'", "'https://www.studio' || g || '.com/jobs?p=' || g || '/JOB/' || h"),
}


def listing_sql(layout: str, *, plain: bool = False, where: str = "true") -> str:
    title, location, url = FIELDS_SQL[layout]
    if plain and layout == "smartrecruiters":
        location = location.replace("Remote/Unknown", "Unknown")
    provider = "simple_html" if layout == "simple" else layout
    empty = "p_size < 10" if layout == "simple" else "false"
    rows = f"""SELECT page_id, k, h, g, {title} AS title, {location} AS location, {url} AS url,
      '{provider}' AS ats_provider, {SITES[layout][1]} AS company, '{LABELS[layout]}' AS parser
      FROM item WHERE NOT other AND NOT ({empty}) AND {where}"""
    first = "row_number() OVER (PARTITION BY page_id, h ORDER BY k) = 1"
    if layout == "simple":
        return f"SELECT * FROM ({rows}) WHERE {ROLE_SQL} QUALIFY {first}"
    if plain and layout in ("ashby", "greenhouse", "lever"):
        return rows
    if plain:
        return f"SELECT * FROM ({rows}) QUALIFY {first}"
    return f"SELECT * FROM (SELECT * FROM ({rows}) QUALIFY {first}) WHERE {ROLE_SQL}"


def _register(profile: P.Profile, layout: str, plain: bool) -> None:
    name = f"extract_{profile.name}" if layout != "simple" else "extract_simple_part"
    sql = f"""WITH {ITEM_SQL}, listing AS ({listing_sql(layout, plain=plain)})
SELECT page_id, title, location, url, 'acme' AS company, ats_provider FROM listing"""

    @query(name, sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pages = part_pages(spark, sf_dir, layout).withColumn("company", F.lit("acme"))
        return extract(pages, profile).select(
            "page_id", "title", "location", "url", "company", "ats_provider"
        )


for _profile in (P.ASHBY, P.GREENHOUSE, P.LEVER, P.TEAMTAILOR, P.WORKDAY, P.SMARTRECRUITERS, P.WORKABLE, P.SIMPLE):
    _register(replace(_profile, roles=ROLES), _profile.name, False)
for _profile in (P.ASHBY_PLAIN, P.GREENHOUSE_PLAIN, P.LEVER_PLAIN, P.SMARTRECRUITERS_PLAIN, P.TEAMTAILOR_PLAIN):
    _register(_profile, _profile.provider, True)

TEST_PROFILES = {name: replace(p, roles=ROLES) for name, p in P.LIVE_PROFILES.items()}

ALL_SQL = " UNION ALL ".join(
    f"SELECT * FROM ({listing_sql(name, where=f'page_id % {len(SITES)} = {i}')})"
    for i, name in enumerate(SITES)
)


@query(
    "discover",
    f"""WITH {ITEM_SQL}, listing AS ({ALL_SQL})
SELECT page_id, title, location, url, company, parser, ats_provider FROM listing""",
)
def discover_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover(part_pages(spark, sf_dir), profiles=TEST_PROFILES).select(
        "page_id", "title", "location", "url", "company", "parser", "ats_provider"
    )


_DEEP_SQL = "1001 + p_partkey % 500"
_DEEP_PAGES = 500  # of a task, about: some 7 MB of markup


@query(
    "deep_pages",
    f"""SELECT p_partkey AS page_id, CAST({_DEEP_SQL} + 2 AS BIGINT) AS pos, p_name AS title, 'https://careers.smartrecruiters.com/' || p_partkey AS url,
  CAST({_DEEP_SQL} + 1 AS BIGINT) AS depth FROM part""",
)
def deep_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings more than a thousand elements deep, beside items that were closed before."""
    levels = (F.col("p_partkey") % 500 + 1001).cast("int")
    key = F.col("p_partkey").cast("string")
    html = F.concat(
        F.repeat(F.lit("<div>"), levels), F.lit('<section><ul><li class="opening-job"><a href="/'), key,
        F.lit('"><h4>'), F.col("p_name"), F.lit('</h4></a></ul></section>'), F.repeat(F.lit("</div>"), levels),
        F.lit('<li class="opening-job">'),
    )
    # A row becomes some 14 kB of markup, so the rows of one small file are dealt out before.
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    pages = parts.repartition(-(-parts.count() // _DEEP_PAGES) or 1).select(
        F.col("p_partkey").alias("page_id"), F.lit("https://x.io").alias("url"), html.alias("html")
    )
    profile = replace(P.SMARTRECRUITERS, roles=None)
    # One scan for both, and what is found stored, so that no scan has to end within the time limit of a broadcast.
    scanned = html_nodes(pages, "page_id", attributes=profile.attributes()).select(
        "*",
        (F.array_max(F.transform("nodes", lambda n: n["depth"])) - 4).cast("bigint").alias("depth"),
        F.monotonically_increasing_id().alias("page"),
    )
    rows = stored(extract(scanned, profile, keep=("page_id", "page", "depth"), every=True).select("page_id", "page", "depth", "pos", "title", "url"))
    found = rows.where(F.col("url").isNotNull()).select("page_id", "pos", "title", "url")
    depths = rows.groupBy("page_id", "page").agg(F.first("depth").alias("depth"))
    return found.join(depths.drop("page"), "page_id").select("page_id", "pos", "title", "url", "depth")


def _item_markup(item: Column) -> Column:
    quantity = item["l_quantity"].cast("bigint").cast("string")
    return F.concat(
        F.lit("<LI class='a &amp; b'> Q"), quantity, F.lit(" &lt; <!-- x --><b>"), item["l_returnflag"], F.lit("</b><br>")
    )


@query(
    "html_tree",
    """WITH item AS (SELECT l_orderkey AS page_id, l_linenumber, l_quantity, mode, n, count(*) OVER (PARTITION BY l_orderkey) AS m FROM (
  SELECT l_orderkey, l_linenumber, l_returnflag AS mode, CAST(l_quantity AS BIGINT) AS l_quantity,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS n FROM lineitem)),
node AS (
  SELECT DISTINCT page_id, 0 AS pre, -1 AS parent, 5 * m AS last, 0 AS depth, 'ul' AS tag, 'order=' || page_id AS attrs, NULL AS text FROM item
  UNION ALL SELECT page_id, 5 * n + 1, 0, 5 * n + 5, 1, 'li', 'class=a & b', NULL FROM item
  UNION ALL SELECT page_id, 5 * n + 2, 5 * n + 1, 5 * n + 2, 2, '#text', '', 'Q' || l_quantity || ' <' FROM item
  UNION ALL SELECT page_id, 5 * n + 3, 5 * n + 1, 5 * n + 4, 2, 'b', '', NULL FROM item
  UNION ALL SELECT page_id, 5 * n + 4, 5 * n + 3, 5 * n + 4, 3, '#text', '', mode FROM item
  UNION ALL SELECT page_id, 5 * n + 5, 5 * n + 1, 5 * n + 5, 2, 'br', '', NULL FROM item)
SELECT page_id, CAST(pre AS INTEGER) AS pre, CAST(parent AS INTEGER) AS parent, CAST(last AS INTEGER) AS last,
  CAST(depth AS INTEGER) AS depth, tag, attrs, text FROM node""",
)
def html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of every node: orders as lists, whose items are closed by the next one."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    pages = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(F.struct(*order, "l_returnflag"))).alias("items"))
        .select(
            F.col("l_orderkey").alias("page_id"),
            F.concat(
                F.lit("<ul order="), F.col("l_orderkey").cast("string"), F.lit(">"),
                F.array_join(F.transform("items", _item_markup), ""), F.lit("</ul>"),
            ).alias("html"),
        )
    )
    attrs = F.array_join(
        F.transform(F.map_entries("n.attrs"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
    )
    fields = [F.col(f"n.{c}").alias(c) for c in ("pre", "parent", "last", "depth", "tag", "text")]
    return (
        html_nodes(pages, "page_id").select("page_id", F.explode("nodes").alias("n"))
        .select("page_id", *fields, attrs.alias("attrs"))
    )
