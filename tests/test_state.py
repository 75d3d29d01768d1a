import datetime
import random

import pytest
from pyspark.sql import functions as F

from winnow.operators.state import (
    apply_details,
    empty_jobs,
    evolve,
    fetched_pages,
    insert_new,
    mark_generated,
    pending_details,
    raw_pages,
    status_counts,
    update_by_key,
    write_raw_pages,
)
from winnow.plans import stages
from winnow.operators.triage import apply_triage, triage, triage_report, triage_summary
from winnow.plans.discovery import detect_ats_join, discovery_metrics, in_target_order
from winnow.schemas import JOBS
from winnow.sources import tables
from winnow.sources.targets import load_targets, targets_from

LISTING = "page_id long, pos long, title string, location string, url string, company string, ats_provider string, parser string"
NOW = F.lit(datetime.datetime(2024, 5, 1, 12, 0, 0))


def listing(page, pos, url, title="TD", company="acme"):
    return (page, pos, title, "Nice", url, company, "lever", "Lever")


def jobs_of(spark, *rows):
    """Jobs from dicts; the id follows from the address."""
    names = [f.name for f in JOBS.fields]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], JOBS)
    return df.withColumn("id", F.coalesce("id", F.md5("apply_url")))


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_insert_new(spark):
    known = jobs_of(spark, {"apply_url": "/a", "status": "ignored"})
    batch = spark.createDataFrame(
        [listing(2, 0, "/b", "late"), listing(1, 5, "/b", "first"), listing(1, 9, "/b"), listing(1, 1, "/a")], LISTING
    )
    added = insert_new(known, batch, as_of=NOW)
    (row,) = added.collect()
    assert added.schema.names == JOBS.names
    assert (row.title, row.status, row.relevance_score, row.description) == ("first", "new", 0, None)
    assert row.created_at == datetime.datetime(2024, 5, 1, 12, 0, 0)
    assert insert_new(known.unionByName(added), batch).count() == 0
    assert insert_new(empty_jobs(spark), batch).count() == 2
    stamp = insert_new(known, batch).collect()[0].created_at
    assert stamp.microsecond == 0


def test_metrics(spark):
    batch = spark.createDataFrame(
        [listing(1, 0, "/a"), listing(1, 1, "/b"), listing(2, 0, "/b", company="b"), listing(2, 1, "/c", company="b")], LISTING
    )
    known = jobs_of(spark, {"apply_url": "/a", "status": None})
    got = as_set(discovery_metrics(batch, insert_new(known, batch, extra=["parser"])))
    assert got == {("acme", "Lever", 2, 1), ("b", "Lever", 2, 1), ("acme", None, 2, 1), ("b", None, 2, 1), (None, None, 4, 2)}


@pytest.mark.parametrize("seed", range(3))
def test_insert_laws_with_a_hot_address(spark, seed):
    rnd = random.Random(seed)
    rows = [listing(p, i, "/hot" if rnd.random() < 0.4 else f"/{rnd.randrange(60)}", f"t{p}-{i}") for p in range(100) for i in range(20)]
    rnd.shuffle(rows)
    known_urls = {f"/{i}" for i in range(0, 60, 3)}
    known = jobs_of(spark, *[{"apply_url": u, "status": "new"} for u in known_urls])
    batch = spark.createDataFrame(rows, LISTING).repartition(16)
    got = {r.apply_url: r.title for r in insert_new(known, batch).collect()}
    want = {}
    for r in sorted(rows):
        if r[4] not in known_urls:
            want.setdefault(r[4], r[2])
    assert got == want


def test_pending(spark):
    jobs = jobs_of(
        spark,
        {"apply_url": "1", "status": "new"},
        {"apply_url": "2", "status": "approved"},
        {"apply_url": "3", "status": "ignored"},
        {"apply_url": "4"},
        {"apply_url": "5", "status": "new", "description": "x"},
    )
    assert {r.apply_url for r in pending_details(jobs).collect()} == {"1", "2"}
    assert as_set(status_counts(jobs)) == {("new", 2), ("approved", 1), ("ignored", 1), (None, 1)}


def test_details(spark, tmp_path):
    jobs = jobs_of(
        spark,
        {"apply_url": "/1", "status": "new", "company": "A&B", "title": "TD"},
        {"apply_url": "/1", "status": "approved", "id": "same page", "title": "x"},
        {"apply_url": "/2", "status": "new"},
        {"apply_url": "/3", "status": "ignored"},
        {"apply_url": "/1", "status": "scraped", "description": "old", "id": "kept"},
        {"apply_url": "/1", "id": "no status"},
        {"apply_url": "/5", "status": "new"},
        {"apply_url": "/6", "status": "new"},
    )
    pages = spark.createDataFrame(
        [(7, "/1", "<p>later copy"), (3, "/1", "<title>T</title><p> a </p>b"), (4, "/3", "<p>no"), (5, "/5", "<br>"), (6, "/6", None)],
        "page_id long, url string, html string",
    )
    assert {r.page_id for r in fetched_pages(jobs, pages).collect()} == {3, 5}
    done = apply_details(jobs, pages)
    assert done.schema.names == JOBS.names and done.count() == jobs.count()
    got = {(r.apply_url, r.id if len(r.id) < 32 else ""): (r.description, r.status, r.raw_path) for r in done.collect()}
    first = next(r.id for r in jobs.collect() if r.company)
    assert got == {
        ("/1", ""): ("T\na\nb", "scraped", f"data/raw_jobs/A_B__TD__Unknown__{first[:6]}.html"),
        ("/1", "same page"): ("T\na\nb", "scraped", "data/raw_jobs/Unknown__x__Unknown__same p.html"),
        ("/2", ""): (None, "new", None),
        ("/3", ""): (None, "ignored", None),
        ("/1", "kept"): ("old", "scraped", None),
        ("/1", "no status"): (None, None, None),
        ("/5", ""): ("", "scraped", next(r.raw_path for r in done.collect() if r.apply_url == "/5")),
        ("/6", ""): (None, "new", None),
    }
    kept = raw_pages(done, pages)
    write_raw_pages(kept, str(tmp_path / "raw"))
    back = spark.read.parquet(str(tmp_path / "raw"))
    assert {(r.company, r.html) for r in back.collect()} == {("A&B", "<title>T</title><p> a </p>b"), (None, "<title>T</title><p> a </p>b"), (None, "<br>")}


def test_update_by_key(spark):
    jobs = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y"), (None, "c", "z")], "id string, status string, note string")
    updates = spark.createDataFrame([("1", 1, "first"), ("1", 2, None), ("3", 1, "none"), (None, 1, "null key")], "id string, at int, note string")
    assert as_set(update_by_key(jobs, updates, ["note"], order=["at"])) == {("1", "a", None), ("2", "b", "y"), (None, "c", "z")}
    kept = update_by_key(jobs, updates, ["note"], order=["at"], where=F.col("status") == "b")
    assert as_set(kept) == as_set(jobs)


def test_triage_is_idempotent(spark):
    jobs = jobs_of(
        spark,
        {"apply_url": "1", "status": "scraped", "title": "Pipeline TD", "company": "A"},
        {"apply_url": "2", "status": "scraped", "title": "Lead FX Artist", "company": "B"},
        {"apply_url": "3", "status": "new", "title": "Pipeline TD"},
        {"apply_url": "4", "title": "Pipeline TD"},
    )
    once = apply_triage(jobs)
    got = {r.apply_url: (r.status, r.relevance_score, r.decision_reason) for r in once.collect()}
    assert got == {
        "1": ("approved", 2, "Positive match: pipeline, td"),
        "2": ("ignored", 0, "Negative match: fx, lead"),
        "3": ("new", None, None),
        "4": (None, None, None),
    }
    assert as_set(apply_triage(once)) == as_set(once)
    verdicts = triage(jobs)
    assert as_set(triage_report(verdicts)) == {
        ("A", "Pipeline TD", "approved", 2, "Positive match: pipeline, td"),
        ("B", "Lead FX Artist", "ignored", 0, "Negative match: fx, lead"),
    }
    assert as_set(triage_summary(verdicts)) == {(1, 1)}
    updated = update_by_key(
        jobs, verdicts.selectExpr("id", "status", "score relevance_score", "reason decision_reason"),
        ["status", "relevance_score", "decision_reason"],
    )
    assert as_set(updated) == as_set(once)


def test_mark_generated(spark):
    jobs = jobs_of(spark, {"apply_url": "1", "status": "approved"}, {"apply_url": "2", "status": "approved"}, {"apply_url": "3", "status": "new"})
    done = jobs.where("apply_url in ('1', '3')").select("id")
    got = {r.apply_url: r.status for r in mark_generated(jobs, done.union(done)).collect()}
    assert got == {"1": "generated", "2": "approved", "3": "new"}


def test_evolve(spark):
    old = spark.createDataFrame([("1", "why")], "id string, decision_reason string")
    got = evolve(old)
    assert set(got.columns) == set(JOBS.names)
    row = got.collect()[0]
    assert (row.decision_reason, row.relevance_score, row.title) == ("why", 0, None)
    assert evolve(got).columns == got.columns


def test_targets(spark, tmp_path):
    config = {"one": ["https://a", "https://b"], "roles": {"include": ["x"]}, "custom": None, "two": ["https://b", "https://c"]}
    want = {("one", 0, "https://a"), ("one", 1, "https://b"), ("two", 3, "https://c")}
    assert as_set(targets_from(spark, config)) == want
    assert as_set(targets_from(spark, ["https://a", "https://a"])) == {("", 0, "https://a")}
    assert load_targets(spark, str(tmp_path / "none.yaml")).count() == 0
    pytest.importorskip("yaml")
    path = tmp_path / "targets.yaml"
    path.write_text("one:\n  - https://a\n  - https://b\ncustom:\nroles:\n  include: [x]\ntwo: [https://b, https://c]\n")
    assert as_set(load_targets(spark, str(path))) == want
    (tmp_path / "targets.json").write_text('["https://z"]')
    assert as_set(load_targets(spark, str(tmp_path / "targets.json"))) == {("", 0, "https://z")}
    pages = spark.createDataFrame([(1, "https://c"), (2, "https://x")], "page_id int, url string")
    assert as_set(in_target_order(pages, targets_from(spark, config)).select("page_id", "ord")) == {(1, 3)}


def test_rule_table(spark):
    rules = spark.createDataFrame(
        [(2, "lever.co", "lever", "Lever"), (1, "clever", "c", "C"), (3, "x" * 300, "long", "Long")],
        "priority int, domain string, profile string, label string",
    )
    pages = spark.createDataFrame([("https://CLEVER.com/x",), ("https://lever.co",), ("https://a.io/lever.co",), ("nourl",), (None,)], "url string")
    got = {r.url: r.label for r in detect_ats_join(pages, rules).collect()}
    assert got == {"https://CLEVER.com/x": "C", "https://lever.co": "Lever", "https://a.io/lever.co": "Simple/HTML", "nourl": "Simple/HTML", None: "Simple/HTML"}


def test_versions(spark, tmp_path):
    root = str(tmp_path / "jobs")
    assert tables.read_latest(spark, root, JOBS).count() == 0
    first = jobs_of(spark, {"apply_url": "1", "status": "scraped", "title": "TD"})
    assert tables.write_next(first, root)[0] == 1
    # the newest version can be read while the next is written
    assert tables.write_next(apply_triage(tables.read_latest(spark, root, JOBS)), root)[0] == 2
    assert [r.status for r in tables.read_latest(spark, root, JOBS).collect()] == ["approved"]
    (tmp_path / "jobs" / "v=3").mkdir()  # a write that never finished
    assert [r.status for r in tables.read_latest(spark, root, JOBS).collect()] == ["approved"]
    assert tables.write_next(empty_jobs(spark), root)[0] == 3
    assert tables.read_latest(spark, root, JOBS).count() == 0


def test_rows_that_land_beside_a_version(spark, tmp_path):
    root = str(tmp_path / "jobs")

    def rows(*urls, status="new"):
        return jobs_of(spark, *({"apply_url": u, "status": status} for u in urls))

    def urls():
        return sorted(r.apply_url for r in tables.read_latest(spark, root, JOBS).collect())

    tables.land(rows("0", "1"), root)
    before = tables.newest(spark, root)
    tables.land(rows("2"), root)
    assert urls() == ["0", "1", "2"] and tables.newest(spark, root).number == 0
    # A version made of what was seen before the last batch landed: that one still counts beside it.
    made = tables.read_version(spark, before, JOBS).withColumn("status", F.lit("scraped"))
    assert tables.write_next(made, root, ["status"], before)[0] == 1
    assert urls() == ["0", "1", "2"] and tables.newest(spark, root).last_batch == 2
    jobs = tables.read_latest(spark, root, JOBS)
    assert {(r.apply_url, r.status) for r in jobs.collect()} == {("0", "scraped"), ("1", "scraped"), ("2", "new")}
    plan = jobs.where("status = 'new'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan
    (tmp_path / "jobs" / "batch=3").mkdir()  # a write that never finished: its number is not used again
    assert tables.land(rows("4"), root).endswith("batch=4") and urls() == ["0", "1", "2", "4"]
    assert stages.run_compaction(spark, root) == 2
    assert urls() == ["0", "1", "2", "4"] and not tables.newest(spark, root).batches
    assert stages.run_reset(spark, root) == 3 and urls() == []
    assert tables.land(rows("5"), root).endswith("batch=5") and urls() == ["5"]


def test_markup_is_not_shuffled(spark):
    """Few pages are wanted: their numbers are broadcast and the markup is read where it lies."""
    jobs = jobs_of(spark, {"apply_url": "/1", "status": "new"})
    pages = spark.range(1000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("/"), F.col("id")).alias("url"), F.lit("<p>x").alias("html")
    )
    plan = fetched_pages(jobs, pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_the_shared_folder_must_be_named(spark, monkeypatch):
    unset = spark.newSession()
    monkeypatch.setattr(type(unset.conf), "get", lambda self, key, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_dir(unset)


def test_older_tables_read_defaults(spark, tmp_path):
    root = str(tmp_path / "old")
    old = jobs_of(spark, {"apply_url": "/a", "status": "new"}).drop("relevance_score", "decision_reason")
    tables.write_next(old, root, ("status",))
    (row,) = stages.jobs_table(spark, root).collect()
    assert row.relevance_score == 0 and row.decision_reason is None


def test_only_approved_rows_are_marked(spark, tmp_path):
    root = str(tmp_path / "marks")
    tables.write_next(jobs_of(spark, {"apply_url": "/a", "status": "approved"}, {"apply_url": "/b", "status": "new"}), root, ("status",))
    jobs = stages.jobs_table(spark, root)
    done = jobs.select("id").union(jobs.select("id"))
    out = mark_generated(jobs, done)
    assert {(r.apply_url, r.status) for r in out.collect()} == {("/a", "generated"), ("/b", "new")}
    assert "(status#" in (plan := out._jdf.queryExecution().executedPlan().toString()) and "= approved)" in plan


def test_rows_that_share_a_page_are_split(spark):
    """A page that a third of the rows point at: the join's big partition is divided."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    url = F.when(F.col("id") % 3 == 0, F.lit("/hot")).otherwise(F.concat(F.lit("/"), F.col("id").cast("string")))
    jobs = spark.range(0, 200_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("id"), F.lit("acme").alias("company"), F.lit("TD").alias("title"),
        F.lit("Nice").alias("location"), url.alias("apply_url"), F.lit(None).cast("string").alias("description"),
        F.lit("new").alias("status"), F.lit(None).cast("string").alias("raw_path"),
    )
    pages = spark.range(300).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 100 == 7, "/hot").otherwise(F.concat(F.lit("/"), F.col("id").cast("string"))).alias("url"),
        F.concat(F.lit("<p>page "), F.col("id").cast("string")).alias("html"),
    )
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        done = apply_details(jobs, pages)
        texts = {r.description: r.n for r in done.groupBy("description").agg(F.count("*").alias("n")).collect()}
        done.collect()
        plan = done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert texts["page 7"] == 66_667 and sum(texts.values()) == 200_000
    assert "SortMergeJoin(skew=true)" in plan
