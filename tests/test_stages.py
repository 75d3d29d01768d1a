import json
from dataclasses import replace

from pyspark.sql import functions as F

from winnow.operators import profiles as P
from winnow.operators.extract import scan_errors
from winnow.plans import stages
from winnow.sources.targets import targets_from

IDENTITY = {"first_name": "Ivo", "last_name": "Test"}


def test_from_pages_to_documents(spark, tmp_path):
    root, out = str(tmp_path / "jobs"), str(tmp_path / "documents")
    schema = "page_id long, url string, html string"
    listings = spark.createDataFrame(
        [
            (1, "https://boards.greenhouse.io/x", '<div class="opening"><a href="/1">Pipeline TD</a><span class="location">Lyon</span></div>'
             '<div class="opening"><a href="/2">Lead Artist</a></div><div class="opening"><a href="/3">Cook</a></div>'),
            (2, "https://www.acme.com/jobs", '<a href="/job/9">Tools Programmer</a><a href="https://boards.greenhouse.io/1">FX TD jobs</a>'),
            (3, "https://www.acme.com/jobs2", '<a href="https://boards.greenhouse.io/1?job">x</a><a href="https://boards.greenhouse.io/1#career">TD</a>'),
        ],
        schema,
    )
    counts = {(r.company, r.parser): (r.found, r.new) for r in stages.run_discovery(listings, root).counts.collect()}
    assert counts[("boards", "Greenhouse")] == (2, 2) and counts[("acme", "Simple/HTML")] == (2, 2)
    assert counts[(None, None)] == (4, 4)
    again = {(r.company, r.parser): r.new for r in stages.run_discovery(listings, root).counts.collect()}
    assert again[(None, None)] == 0
    jobs = {r.title: r for r in stages.jobs_table(spark, root).collect()}
    assert set(jobs) == {"Pipeline TD", "Lead Artist", "Tools Programmer", "TD"}
    assert all(r.status == "new" for r in jobs.values())

    details = spark.createDataFrame(
        [(i, jobs[t].apply_url, f"<h1>{t}</h1><p>Nice work") for i, t in enumerate(("Pipeline TD", "Lead Artist", "Tools Programmer"))],
        schema,
    )
    stages.run_details(details, root, raw=str(tmp_path / "raw"))
    stages.run_details(details, root, raw=str(tmp_path / "raw"))  # nothing is pending any more
    raw = spark.read.parquet(str(tmp_path / "raw")).collect()
    assert {r.html for r in raw} == {r.html for r in details.collect()} and len(raw) == 3
    assert {r.raw_path for r in raw} == {r.raw_path for r in stages.jobs_table(spark, root).collect() if r.raw_path}
    summary = stages.run_triage(spark, root).collect()[0]
    assert (summary.approved, summary.ignored) == (2, 1)
    status = {r.title: r.status for r in stages.jobs_table(spark, root).collect()}
    assert status == {"Pipeline TD": "approved", "Lead Artist": "ignored", "Tools Programmer": "approved", "TD": "new"}

    stages.run_prompts(spark, root, "ME", str(tmp_path / "prompts"))
    prompts = spark.read.parquet(str(tmp_path / "prompts"))
    assert {r.lang for r in prompts.collect()} == {"FR", "EN"}
    responses = prompts.select(
        "id", F.when(F.col("lang") == "FR", json.dumps({"cover_letter_body": ["a_b"]})).otherwise("sorry").alias("raw")
    )
    templates = {"cover": "<< first_name >>: << cover_letter_body >> << cl_closing >> << shift >>"}
    labels = {"FR": {"cl_closing": "Fin", "shift": "nuit"}, "EN": {"cl_closing": "End", "shift": "night"}}
    errors = stages.run_generation(responses, root, IDENTITY, templates, out, labels=labels).collect()
    assert [r.stage for r in errors] == ["response"]
    (document,) = spark.read.parquet(out).collect()
    assert (document.kind, document.folder, document.body) == ("cover", "boards_Pipeline_TD", "Ivo: a\\_b Fin nuit")
    status = {r.title: r.status for r in stages.jobs_table(spark, root).collect()}
    assert status["Pipeline TD"] == "generated" and status["Tools Programmer"] == "approved"
    again = stages.run_generation(responses, root, IDENTITY, templates, out, labels=labels)
    assert again.count() == 1  # nothing usable is left: no documents, no change
    assert {r.title: r.status for r in stages.jobs_table(spark, root).collect()} == status
    assert spark.read.parquet(out).count() == 1
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "cover.log").write_text("ok\n! Undefined\nl.5\n")
    (line,) = stages.run_log_digest(spark, str(tmp_path / "logs")).collect()
    assert (line.kind, line.line, line.context) == ("error", "! Undefined", "l.5")
    stages.run_reset(spark, root)
    assert stages.jobs_table(spark, root).count() == 0


def test_targets_and_failed_pages(spark, tmp_path, monkeypatch):
    """A page that cannot be scanned is reported from the same scan; the first target wins."""
    from winnow.sources import html

    scan = html._NodeColumns._scan

    def broken(self, page, base):
        if "BROKEN" in page:
            raise ValueError("cannot be read")
        scan(self, page, base)

    root = str(tmp_path / "jobs")
    job = '<a href="https://x.io/1">TD job</a>'
    pages = spark.createDataFrame(
        [(1, "https://a.com", job), (2, "https://b.com", job), (3, "https://c.com", '<a href="/job">BROKEN TD</a>'), (4, "https://d.com", job)],
        "page_id long, url string, html string",
    )
    options = dict(rules=(), fallback=("simple", "S"), profiles={"simple": replace(P.SIMPLE, href_pattern="x.io|job")})
    listed = targets_from(spark, ["https://b.com", "https://c.com", "https://a.com"])
    # Workers import the module anew, so the failing scan is handed over by name.
    failing = scan_errors(spark.createDataFrame([(3, "ValueError: cannot be read"), (1, None)], "page_id long, error string"))
    assert [tuple(r) for r in failing.collect()] == [("3", "scan", "ValueError: cannot be read")]
    monkeypatch.setattr(html._NodeColumns, "_scan", broken)
    columns = html._NodeColumns()
    for r in pages.orderBy("page_id").collect():
        columns.add_page(r.html)
    nodes, failed = columns.arrays()
    assert failed.to_pylist() == [None, None, "ValueError: cannot be read", None] and len(nodes[2]) == 0
    monkeypatch.undo()
    found = stages.run_discovery(pages, root, targets=listed, **options)
    assert found.errors.count() == 0
    counts = {r.company: (r.found, r.new) for r in found.counts.where("parser is null").collect()}
    assert counts == {"a": (1, 0), "b": (1, 1), "c": (1, 1), None: (3, 2)}
    assert {(r.apply_url, r.company) for r in stages.jobs_table(spark, root).collect()} == {("https://x.io/1", "b"), ("https://c.com/job", "c")}
