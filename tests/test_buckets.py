"""A stored table in buckets: updates and inserts cost the buckets they touch."""

import random
from glob import glob

from pyspark.sql import functions as F

from winnow.operators.state import update_by_key
from winnow.plans import stages
from winnow.schemas import JOBS
from winnow.sources import tables


def jobs_of(spark, ids, status="new"):
    rows = [tuple({"id": i, "status": status, "title": f"t{i}", "relevance_score": 0}.get(f.name) for f in JOBS) for i in ids]
    return spark.createDataFrame(rows, JOBS)


def listings_of(spark, urls):
    rows = [(u, "x", "c", "ats", "t", "l", 1, i) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "url string, parser string, company string, ats_provider string, title string, location string, page_id long, pos int")


def written(root):
    return sorted(p.split("/bucket=")[1].split("/")[0] for p in glob(f"{root}/**/*.parquet", recursive=True))


def a_table(spark, root, rows=3000, buckets=100):
    tables.land(jobs_of(spark, [f"{i:05}" for i in range(rows)]), root, "id")
    stages.run_compaction(spark, root, buckets)
    return tables.newest(spark, root)


def test_an_update_reads_and_writes_its_buckets(spark, tmp_path):
    root = str(tmp_path / "jobs")
    seen = a_table(spark, root)
    assert seen.n_buckets == 100 and len(seen.buckets) == 100
    before = {r.id: r for r in stages.jobs_table(spark, root).collect()}
    one = tables.bucket_of(F.col("id"), 100)
    ids = [r.id for r in stages.jobs_table(spark, root).where(one == "7-100").collect()]
    updates = spark.createDataFrame([(i, "hit") for i in ids[:3]] + [("unknown", "x")], "id string, title string")
    (spare,) = tables.buckets_of(updates.where("id = 'unknown'"), "id", 100)
    assert stages.run_update(updates, root, ["title"]) == seen.number + 1
    # files written: those of the two buckets with an updated id
    assert set(written(f"{root}/u={seen.number + 1}.b1")) == {"7-100", spare}
    assert len(written(f"{root}/u={seen.number + 1}.b1")) == 2
    # files read for the next one: the bucket's own, where it was written last
    part = tables.read_version(spark, tables.newest(spark, root), JOBS, buckets=["7-100"])
    assert [f"/u={seen.number + 1}.b1/bucket=7-100/" in f for f in part.inputFiles()] == [True]
    assert "PartitionFilters" in part._jdf.queryExecution().executedPlan().toString() and sorted(r.id for r in part.collect()) == sorted(ids)
    after = {r.id: r for r in stages.jobs_table(spark, root).collect()}
    assert {i for i in after if after[i] != before[i]} == set(ids[:3]) and set(after) == set(before)
    assert len(stages.jobs_table(spark, root).inputFiles()) == 100


def test_an_update_of_nothing_writes_nothing(spark, tmp_path):
    root = str(tmp_path / "jobs")
    seen = a_table(spark, root, 50, 4)
    none = spark.createDataFrame([], "id string, title string")
    assert stages.run_update(none, root, ["title"]) == seen.number == tables.newest(spark, root).number
    assert stages.run_triage(spark, root).collect()[0].approved == 0 and tables.newest(spark, root).number == seen.number


def test_an_insert_reads_the_buckets_of_its_ids(spark, tmp_path):
    """The scan of the known ids is pruned to the buckets that the listings' ids fall into."""
    root = str(tmp_path / "jobs")
    seen = a_table(spark, root)
    listings = listings_of(spark, ["https://a/1", "https://a/2", "https://a/1"])
    known, n = stages.known_ids(spark, root, listings)
    assert n == 100 and len(known.inputFiles()) <= 2 and "ReadSchema: struct<id:string>" in known._jdf.queryExecution().executedPlan().toString()
    known_buckets = {f.split("/bucket=")[1].split("/")[0] for f in known.inputFiles()}
    ids = listings.select(F.md5("url").alias("id"))
    assert known_buckets == set(tables.buckets_of(ids, "id", 100)) and known_buckets <= set(seen.buckets)
    # rows that land are found in their buckets as well
    tables.land(jobs_of(spark, [r.id for r in ids.limit(1).collect()]), root, "id", n)
    known, _ = stages.known_ids(spark, root, listings)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan and "PartitionFilters: [" in plan
    assert known.join(ids, "id", "left_semi").count() == 1


def test_rows_dealt_into_another_number_of_buckets(spark, tmp_path):
    root = str(tmp_path / "jobs")
    a_table(spark, root, 200, 8)
    tables.land(jobs_of(spark, ["x1", "x2", "x3"]), root, "id", 5)  # by a writer with another setting
    tables.land(jobs_of(spark, ["y1"]), root)  # and by one that knows no buckets
    (at,) = tables.buckets_of(spark.createDataFrame([("x1",)], "id string"), "id", 8)
    seen = tables.newest(spark, root)
    assert "x1" in {r.id for r in tables.read_version(spark, seen, JOBS, buckets=[at]).collect()}
    stages.run_update(spark.createDataFrame([("x1", "t"), ("y1", "u")], "id string, title string"), root, ["title"])
    rows = {r.id: r.title for r in stages.jobs_table(spark, root).collect()}
    assert len(rows) == stages.jobs_table(spark, root).count() == 204 and (rows["x1"], rows["y1"], rows["x2"]) == ("t", "u", "tx2")


def test_random_steps_against_a_plain_table(spark, tmp_path):
    """Landed batches, updates, whole versions and resets in any order; runs that were cut off leave nothing."""
    root, draw, want, fresh = str(tmp_path / "jobs"), random.Random(4), {}, iter(range(10_000))
    for step in range(22):
        what = draw.choice(["land", "land", "update", "update", "compact", "cut", "reset" if step == 13 else "update"])
        if what == "land":
            ids = [f"k{next(fresh)}" for _ in range(draw.randrange(6))]
            tables.land(jobs_of(spark, ids), root, "id", tables.newest(spark, root).n_buckets)
            want |= {i: f"t{i}" for i in ids}
        elif what == "update":
            ids = draw.sample(sorted(want), min(len(want), draw.randrange(4))) + ["absent"]
            stages.run_update(spark.createDataFrame([(i, f"{step}") for i in ids], "id string, title string"), root, ["title"])
            want |= {i: f"{step}" for i in ids if i in want}
        elif what == "compact":
            stages.run_compaction(spark, root, draw.choice([None, 3, 7]))
        elif what == "reset":
            stages.run_reset(spark, root)
            want = {}
        else:
            for name in (f"u={tables.newest(spark, root).number + 1}", "batch=99"):
                (tmp_path / "jobs" / name / "bucket=0-16").mkdir(parents=True, exist_ok=True)
        rows = stages.jobs_table(spark, root).collect()
        assert len(rows) == len(want) and {r.id: r.title for r in rows} == want, (step, what)


def test_an_update_equals_the_join_of_whole_tables(spark, tmp_path):
    root = str(tmp_path / "jobs")
    a_table(spark, root, 500, 6)
    jobs = stages.jobs_table(spark, root)
    updates = spark.createDataFrame([(f"{i % 40:05}", f"u{i}", i) for i in range(90)] + [("00001", None, 99)], "id string, title string, at int")
    want = sorted(tuple(r) for r in update_by_key(jobs, updates, ["title"], where=F.col("id") != "00003", order=["at"]).select("id", "title").collect())
    stages.run_update(updates, root, ["title"], where=F.col("id") != "00003", order=["at"])
    got = sorted(tuple(r) for r in stages.jobs_table(spark, root).select("id", "title").collect())
    assert sorted(map(str, got)) == sorted(map(str, want))
