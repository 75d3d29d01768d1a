from dataclasses import replace

import pytest

from winnow.operators import profiles as P
from winnow.operators.extract import extract, may_list, page_errors
from winnow.plans.discovery import discover

FAR, STHLM = "Remote/Unknown", "Remote/Stockholm"

# profile, markup, (title, location, url) of each listing
CASES = [
    ("ashby", '<a href="/posting/1"><b>FX</b><b>Artist</b></a><a href="/other/2">FX TD</a>',
     [("FX Artist", FAR, "https://jobs.ashbyhq.com/posting/1")]),
    ("ashby", '<a href="/posting/1"><img></a><a href="/posting/1">FX TD</a>', []),
    ("ashby", '<a href="/x/application/2">Cook</a><a href="/x/application/3">TD</a>',
     [("TD", FAR, "https://jobs.ashbyhq.com/x/application/3")]),
    ("greenhouse", '<div class="opening x"><a href="/a/jobs/1">Tools Engineer</a><span class="location">Paris</span></div>',
     [("Tools Engineer", "Paris", "https://boards.greenhouse.io/a/jobs/1")]),
    ("greenhouse", '<div class="openings x"><a href="/a/jobs/1">Tools Engineer</a><span class="location">Paris</span></div>', []),
    ("greenhouse", '<div class="opening"><a>no link</a><a href="/1">TD</a></div><div class="opening"><a href="/1">Lead</a></div>',
     [("TD", FAR, "https://boards.greenhouse.io/1")]),
    ("greenhouse", '<div class="opening"><div class="opening"><a href="/1">TD</a><span class="location"></span></div></div>',
     [("TD", "", "https://boards.greenhouse.io/1")]),
    ("greenhouse", '<div class="opening"><a href="">TD</a></div>', [("TD", FAR, "https://boards.greenhouse.io/")]),
    ("lever", '<a class="posting-title" href="https://jobs.lever.co/a/1"><h5 data-qa="posting-name">Rigger</h5><span class="location">Oslo</span></a>',
     [("Rigger", "Oslo", "https://jobs.lever.co/a/1")]),
    ("lever", '<a class="posting-title" href="/1">Rigger<span class="location">Oslo</span><span class="sort-by-location x">Rome</span></a>',
     [("RiggerOsloRome", "Rome", "https://jobs.lever.co/1")]),
    ("lever", '<a class="posting-title" href="">TD</a><a class="posting-title">TD</a><span class="location">Oslo</span>', []),
    ("teamtailor", '<li class="block-grid-item"><a href="//h/jobs/1"><span title="t">Unity Developer</span></a><div class="text-md">Umea</div></li>',
     [("Unity Developer", "Umea", "https://h/jobs/1")]),
    ("teamtailor", '<a href="https://h/jobs/12">Nuke Artist<br>x</a><a href="/jobs/abc">FX TD</a>',
     [("Nuke Artist", STHLM, "https://h/jobs/12")]),
    ("teamtailor", '<div class="x-job-list-item-y"><a href="/about">TD</a></div><a href="/jobs/12">Nuke Artist</a>', []),
    ("teamtailor", '<a class="job-list-item" href="/jobs/1"> Lead <i class="meta-location">Rome</i></a><li class="job-list-item"><a href="/jobs/1">TD</a></li>',
     [("Lead", "Rome", "https:/jobs/1")]),
    ("teamtailor", '<a href="/jobs/5"><img></a>', []),
    ("workday", '<ul><li><a data-automation-id="jobTitle" href="/j/1">Graphics Programmer</a><dl><dd data-automation-id="locations">Lyon</dd></dl></li></ul>',
     [("Graphics Programmer", "Lyon", "https://h/jobs/j/1")]),
    ("workday", '<ul><li><dd data-automation-id="locations">Far</dd><ul><li><div><b><a data-automation-id="jobTitle" href="/j/1">TD</a></b></div></li></ul></ul>',
     [("TD", FAR, "https://h/jobs/j/1")]),
    ("workday", '<a data-automation-id="jobTitle" href="/j/1">TD</a><a data-automation-id="jobtitle" href="/j/2">TD</a>',
     [("TD", FAR, "https://h/jobs/j/1")]),
    ("smartrecruiters", '<ul><li class="opening-job"><a href="/R/1"><h4>Lighting TD</h4></a><span class="job-location">Nice</span></li></ul>',
     [("Lighting TD", "Nice", "https://careers.smartrecruiters.com/R/1")]),
    ("smartrecruiters", '<li class="opening-job"><a href="/R/1">TD</a><h4>Cook</h4><li class="opening-job"><a href="/R/1">TD</a>', []),
    ("workable", '<ul><li data-ui="job-opening"><a href="/j/9"><h3>Producer</h3></a></li></ul>',
     [("Producer", FAR, "https://apply.workable.com/j/9")]),
    ("simple", '<a href="/job/1"></a><a href="/job/1">FX TD</a><a href="/job/1">Unity Lead</a><a href="/blog">FX TD</a>',
     [("FX TD", FAR, "https://h/jobs/job/1")]),
    ("simple", '<a href="/job/2"><i>Senior</i><i>Artist</i></a>', [("SeniorArtist", FAR, "https://h/jobs/job/2")]),
    ("simple", '<a href="https://JOBS.x/a">TD</a><a>TD job</a>', [("TD", FAR, "https://h/jobs/https://JOBS.x/a".replace("https://h/jobs/", ""))]),
    ("simple_relaxed", '<a href="/job/3">Read more</a><a href="/job/4">Apply now</a>',
     [("Apply now", "Stockholm/Remote", "https://h/job/4")]),
    ("simple_relaxed", '<a href=" x ">TD</a><a href="x">FX Director</a><a href="https://h/jobs/x">Lead</a><a href="/y">Home of FX</a>',
     [("FX Director", "Stockholm/Remote", "https://h/jobs/x")]),
    ("ashby_plain", '<a href="posting/"></a><a href="/posting/1">Cook</a><a href="/posting/1">Cook</a>',
     [("Cook", FAR, "https://jobs.ashbyhq.com/posting/1")] * 2),
    ("greenhouse_plain", '<div class="opening"><a>x</a><a href="/jobs/1">y</a></div><div class="opening"><a href="?gh_jid=2">Cook</a></div>',
     [("Cook", FAR, "https://boards.greenhouse.io?gh_jid=2")]),
    ("lever_plain", '<a class="posting-title"><span class="location">Oslo</span>x</a>', [("Unknown Role", "Oslo", "")]),
    ("smartrecruiters_plain", '<li class="opening-job"><a href="R/1">Cook</a>', [("Cook", "Unknown", "https://careers.smartrecruiters.comR/1")]),
    ("teamtailor_plain", '<a class="job-list-item" href="/jobs/1"><span class="company-place">Rome</span></a>',
     [("Rome", STHLM, "https:/jobs/1")]),
    ("teamtailor_plain", '<li class="job-list-item"><a>x</a><a href="/jobs/1">y</a></li><div class="block-grid-item"><a href="/jobs/2"></a></div>',
     [("Unknown Role", STHLM, "https:/jobs/2")]),
]


@pytest.fixture(scope="module")
def listings(spark):
    rows = [(i, "https://h/jobs", html, name) for i, (name, html, _) in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, profile string")
    found = extract(pages, P.PROFILES, keep=("page_id", "url")).orderBy("page_id", "pos").collect()
    return found


@pytest.mark.parametrize("i", range(len(CASES)))
def test_golden(listings, i):
    name, _, want = CASES[i]
    rows = [r for r in listings if r.page_id == i]
    assert [(r.title, r.location, r.url) for r in rows] == want
    assert {r.ats_provider for r in rows} <= {P.PROFILES[name].provider}


def test_single_profile_and_dispatch_agree(spark, listings):
    rows = [(i, "https://h/jobs", html) for i, (name, html, _) in enumerate(CASES) if name == "lever"]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    alone = extract(pages, P.LEVER, keep=("page_id", "url")).orderBy("page_id", "pos").collect()
    ids = {r[0] for r in rows}
    assert [tuple(r) for r in alone] == [tuple(r) for r in listings if r.page_id in ids]


def test_dedupe_order_is_a_matter_of_the_profile(spark):
    html = '<a href="/job/1">Cook</a><a href="/job/1">TD</a><a href="/job/1">Lead</a>'
    pages = spark.createDataFrame([(1, "https://h", html)], "page_id long, url string, html string")

    def titles(dedupe):
        found = extract(pages, replace(P.SIMPLE, dedupe=dedupe), keep=("page_id", "url"))
        return [r.title for r in found.orderBy("pos").collect()]

    assert titles("after") == ["TD"]
    assert titles("before") == []
    assert titles("none") == ["TD", "Lead"]


def test_many_links_in_one_page(spark):
    """A large page with few distinct links: order and first places must hold."""
    links = [f"/job/{(i * 7919) % 500}" for i in range(20_000)]
    html = "<ul>" + "".join(f'<li><a href="{h}">TD {i}</a>' for i, h in enumerate(links))
    pages = spark.createDataFrame([(1, "https://h", html)], "page_id long, url string, html string")
    got = [r.title for r in extract(pages, P.SIMPLE, keep=("page_id", "url")).orderBy("pos").collect()]
    assert got == [f"TD {links.index(h)}" for h in dict.fromkeys(links)]


def test_discover_chooses_by_host(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://jobs.lever.co/a", '<a class="posting-title" href="/1">TD</a>'),
            (2, "https://www.acme.com/jobs", '<a class="posting-title" href="/job/1">TD</a>'),
            (3, "https://www.acme.com/none", None),
        ],
        "page_id long, url string, html string",
    )
    rows = discover(pages).orderBy("page_id").collect()
    assert [(r.page_id, r.company, r.parser, r.ats_provider, r.url) for r in rows] == [
        (1, "lever", "Lever", "lever", "https://jobs.lever.co/1"),
        (2, "acme", "Simple/HTML", "simple_html", "https://www.acme.com/jobs/job/1"),
    ]
    assert page_errors(pages).count() == 0


def test_extraction_runs_once_and_without_a_shuffle(spark):
    pages = spark.read.schema("page_id long, url string, html string").parquet("/root/testdata/sf0.01/pages.parquet")
    plan = discover(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert "hashpartitioning" not in plan
    # Once in the test of the markup before the scan, once in the extraction after it.
    assert plan.count("job|career|position|opening") == 2


def test_pages_that_cannot_list_are_not_scanned(spark):
    """The test of the markup lets all pass that may hold a listing, however it is written."""
    item = '<li class="{}"><a href="/1"><h4>Pipeline TD</h4></a></li>'
    rows = [
        (1, item.format("opening-job")), (2, item.format("opening&#45;job")), (3, item.format("&#x6f;pening-job")),
        (4, item.format("other")), (5, None), (6, "<p>no links, AT&amp;T"), (7, item.format("x &amp; opening-job")),
    ]
    pages = spark.createDataFrame([(i, "https://x.io", h) for i, h in rows], "page_id long, url string, html string")
    found = extract(pages, P.SMARTRECRUITERS, keep=("page_id",))
    assert sorted(r.page_id for r in found.collect()) == [1, 2, 3, 7]
    assert sorted(r.page_id for r in pages.where(may_list(P.SMARTRECRUITERS)).collect()) == [1, 2, 3, 7]
    sols = spark.createDataFrame([(1, "https://x.io", '<a href="&sol;application/1">FX TD</a>')], pages.schema)
    assert extract(sols, P.ASHBY, keep=("page_id",)).count() == 1
    assert replace(P.SIMPLE, href_pattern="^/a$").hints() == [] and P.TEAMTAILOR.hints() == ["/jobs/"]
