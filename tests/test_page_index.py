"""The index of pages by address against grouping all pages anew."""

from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tests.test_state import as_set, jobs_of
from winnow.operators.state import apply_details, fetched_pages, pending_with_page, raw_pages
from winnow.plans import stages
from winnow.sources.page_index import open_index
from winnow.sources.tables import newest, write_next

PAGES = "page_id long, url string, html string"


def an_index(spark, path, buckets=4):
    return open_index(spark, str(path), f"pages_{uuid4().hex}", buckets)


@pytest.fixture
def pages(spark):
    """Every third page is a copy of one address; some lack an address, a number or markup."""
    n = F.col("id")
    url = F.when(n % 3 == 0, "/hot").when(n % 10 != 1, F.concat(F.lit("/"), n % 40))
    html = F.when(n % 7 != 2, F.concat(F.lit("<p>"), n))
    return spark.range(300).select(F.when(n % 50 != 3, n).alias("page_id"), url.alias("url"), html.alias("html"))


@pytest.fixture
def jobs(spark):
    rows = [{"apply_url": "/hot", "id": f"hot {i}", "status": "new"} for i in range(20)]
    rows += [{"apply_url": f"/{i}", "status": "new" if i % 4 else "ignored"} for i in range(60)]
    return jobs_of(spark, *rows, {"id": "no address", "status": "new"})


def test_as_without_it(spark, tmp_path, pages, jobs):
    index = an_index(spark, tmp_path)
    for k in (2, 0, 1, 1):  # out of order, one batch twice
        index.add(pages.where(F.col("page_id") % 3 == k))
    index.add(pages.where("page_id is null"))
    index.add(pages.where("false"))
    assert as_set(fetched_pages(jobs, pages, index)) == as_set(fetched_pages(jobs, pages)) != set()
    assert as_set(pending_with_page(jobs, pages)) <= as_set(pending_with_page(jobs, pages, index))
    done = apply_details(jobs, pages, index=index)
    assert as_set(done) == as_set(apply_details(jobs, pages))
    assert as_set(raw_pages(done, pages, index)) == as_set(raw_pages(done, pages)) != set()


def test_an_index_of_nothing(spark, tmp_path, pages, jobs):
    index = an_index(spark, tmp_path)
    assert index.firsts().count() == 0
    assert as_set(apply_details(jobs, pages, index=index)) == as_set(jobs)


def test_pages_not_yet_in_it_have_not_arrived(spark, tmp_path, pages, jobs):
    index = an_index(spark, tmp_path)
    some = pages.where("page_id < 100")
    index.add(some)
    assert as_set(apply_details(jobs, pages, index=index)) == as_set(apply_details(jobs, some))


def test_one_row_an_address_and_batch_and_one_file_a_bucket(spark, tmp_path, pages):
    index = an_index(spark, tmp_path)
    index.add(pages)
    assert index.rows().groupBy("url").count().where("count > 1").count() == 0
    files = index.rows().select(F.input_file_name().alias("f"), F.pmod(F.hash("url"), F.lit(4)).alias("b")).distinct()
    assert files.count() == 4 == files.select("f").distinct().count()


def test_another_session_finds_it_with_its_buckets(spark, tmp_path, pages):
    an_index(spark, tmp_path, 4).add(pages)
    again = an_index(spark, tmp_path, 32)
    assert again.buckets == 4
    want = pages.where("url is not null").groupBy("url").agg(F.min("page_id"))
    assert as_set(again.firsts()) == as_set(want)


@pytest.mark.parametrize("partitions", ["2", "8", "200"])
def test_pages_are_not_shuffled(spark, tmp_path, pages, jobs, partitions):
    """Whatever the number of shuffle partitions, exchanges are on the side of the wanted addresses."""
    index = an_index(spark, tmp_path)
    index.add(pages)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": partitions}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert "Exchange" not in plan_of(index.firsts())
        wanted = jobs.select(F.col("apply_url").alias("url"))
        found = index.first_copies(wanted)
        page_side = plan_of(found).split("SortMergeJoin")[1].split("RDD")[0].split("LocalTableScan")[0]
        left = page_side[: page_side.index("FileScan")]
        assert "Exchange" not in left and "Bucketed: true" in plan_of(found)
        assert {r.url for r in found.collect()} == {r.url for r in index.firsts().join(wanted, "url").collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_stage_takes_it(spark, tmp_path, pages, jobs):
    index = an_index(spark, tmp_path / "index")
    index.add(pages)
    roots = [str(tmp_path / name) for name in ("with", "without")]
    for root, given in zip(roots, (index, None), strict=True):
        write_next(jobs, root, ("status",), newest(spark, root), "id")
        assert stages.run_details(pages, root, f"{root}-raw", index=given) == 2
    one, other = (as_set(stages.jobs_table(spark, root)) for root in roots)
    assert one == other and any(r.status == "scraped" for r in stages.jobs_table(spark, roots[0]).collect())
    raw = [as_set(spark.read.parquet(f"{root}-raw/version=2")) for root in roots]
    assert raw[0] == raw[1] != set()
