"""The jobs table: insert, update, evolve, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import query, scratch, table
from winnow.functions.urls import job_id
from winnow.operators.state import (
    evolve,
    insert_new,
    pending_details,
    status_counts,
    update_by_key,
)
from winnow.plans import stages
from winnow.plans.discovery import discovery_metrics
from winnow.schemas import JOBS
from winnow.sources.tables import land

_ORDER = ("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")


def line_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as listings: a part is an address, an order a page."""
    return table(spark, sf_dir, "lineitem").select(
        *_ORDER,
        F.concat(F.lit("https://jobs.example/"), F.col("l_partkey").cast("string")).alias("url"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("title"),
        F.lit("Remote/Unknown").alias("location"),
        F.col("l_returnflag").alias("company"),
        F.lit("simple_html").alias("ats_provider"),
        F.col("l_linestatus").alias("parser"),
    )


def known_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large parts are known, under every status."""
    url = F.concat(F.lit("https://jobs.example/"), F.col("p_partkey").cast("string"))
    known = table(spark, sf_dir, "part").where(F.col("p_size") > 25)
    return known.select(job_id(url).alias("id"), F.when(F.col("p_size") > 40, "ignored").otherwise("new").alias("status"))


_FIRST_SQL = """line AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber,
    l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus) AS rn FROM lineitem),
added AS (SELECT line.* FROM line LEFT JOIN part ON p_partkey = l_partkey AND p_size > 25
  WHERE rn = 1 AND p_partkey IS NULL)"""


@query(
    "insert_new",
    f"""WITH {_FIRST_SQL}
SELECT md5('https://jobs.example/' || l_partkey) AS id, l_returnflag AS company, 'order ' || l_orderkey AS title,
  'https://jobs.example/' || l_partkey AS apply_url, 'new' AS status FROM added""",
)
def insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = insert_new(known_parts(spark, sf_dir), line_listings(spark, sf_dir), order=_ORDER)
    return added.select("id", "company", "title", "apply_url", "status")


@query(
    "discovery_metrics",
    f"""WITH {_FIRST_SQL}, c AS (SELECT l_returnflag AS company, l_linestatus AS parser, 1 AS f, 0 AS a FROM lineitem
  UNION ALL SELECT l_returnflag, l_linestatus, 0, 1 FROM added)
SELECT company, parser, CAST(sum(f) AS BIGINT) AS found, CAST(sum(a) AS BIGINT) AS new
FROM c GROUP BY ROLLUP (company, parser)""",
)
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = line_listings(spark, sf_dir)
    added = insert_new(known_parts(spark, sf_dir), listings, order=_ORDER, extra=["parser"])
    return discovery_metrics(listings, added)


def order_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as jobs: F is ignored, P has no status, cheap ones lack a description."""
    status = F.when(F.col("o_orderstatus") == "O", "new").when(F.col("o_orderstatus") == "F", "ignored")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        status.alias("status"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_orderpriority")).alias("description"),
    )


_JOBS_SQL = """jobs AS (SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE o_orderstatus WHEN 'O' THEN 'new' WHEN 'F' THEN 'ignored' END AS status,
  CASE WHEN o_totalprice > 200000 THEN o_orderpriority END AS description, o_orderkey FROM orders)"""


@query(
    "pending_details",
    f"WITH {_JOBS_SQL} SELECT id, status FROM jobs WHERE description IS NULL AND status <> 'ignored'",
)
def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_details(order_jobs(spark, sf_dir)).select("id", "status")


@query(
    "pending_count",
    f"WITH {_JOBS_SQL} SELECT count(*) AS pending FROM jobs WHERE description IS NULL AND status <> 'ignored'",
)
def pending_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_details(order_jobs(spark, sf_dir)).agg(F.count(F.lit(1)).alias("pending"))


@query("status_counts", f"WITH {_JOBS_SQL} SELECT status, count(*) AS n FROM jobs GROUP BY status")
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(order_jobs(spark, sf_dir))


@query(
    "update_by_key",
    f"""WITH {_JOBS_SQL}, u AS (SELECT l_orderkey,
  arg_max(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag)) AS flag
  FROM lineitem GROUP BY 1)
SELECT id, CASE WHEN l_orderkey IS NOT NULL AND status = 'new' THEN 'seen' ELSE status END AS status,
  CASE WHEN l_orderkey IS NOT NULL AND status = 'new' THEN nullif(flag, 'N') ELSE description END AS description
FROM jobs LEFT JOIN u ON l_orderkey = o_orderkey""",
)
def update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last line item of an order updates it; a flag of N sets the text to null."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    updates = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.lit("seen").alias("status"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("description"),
        *order,
    )
    return update_by_key(
        order_jobs(spark, sf_dir), updates, ["status", "description"], where=F.col("status") == "new", order=order
    )


def in_buckets(spark: SparkSession, rows: DataFrame, buckets: int) -> str:
    """A stored jobs table of the rows, dealt into buckets; columns that they lack are null."""
    root = f"{scratch(spark)}/jobs"
    whole = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in JOBS])
    land(whole, root, "id")
    stages.run_compaction(spark, root, buckets)
    return root


@query(
    "update_buckets",
    f"""WITH {_JOBS_SQL}, u AS (SELECT l_orderkey,
  arg_max(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag)) AS flag
  FROM lineitem WHERE l_quantity >= 45 GROUP BY 1),
first AS (SELECT id, CASE WHEN l_orderkey IS NOT NULL THEN 'seen' ELSE status END AS status,
  CASE WHEN l_orderkey IS NOT NULL THEN nullif(flag, 'N') ELSE description END AS description FROM jobs LEFT JOIN u ON l_orderkey = o_orderkey),
dear AS (SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders))
SELECT id, CASE WHEN dear.id IS NOT NULL THEN 'dear' ELSE status END AS status, description FROM first LEFT JOIN dear USING (id)""",
)
def update_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table after two updates of the buckets they touch: one of many rows, one of the dearest order."""
    root = in_buckets(spark, order_jobs(spark, sf_dir), 16)
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    many = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= 45).select(
        F.col("l_orderkey").cast("string").alias("id"), F.lit("seen").alias("status"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("description"), *order,
    )
    stages.run_update(many, root, ["status", "description"], order=order)
    orders = table(spark, sf_dir, "orders")
    dearest = orders.join(orders.agg(F.max("o_totalprice").alias("o_totalprice")), "o_totalprice")
    one = dearest.select(F.col("o_orderkey").cast("string").alias("id"), F.lit("dear").alias("status"))
    stages.run_update(one, root, ["status"])
    return stages.jobs_table(spark, root).select("id", "status", "description")


@query(
    "insert_buckets",
    f"""WITH {_FIRST_SQL}
SELECT md5('https://jobs.example/' || l_partkey) AS id, l_returnflag AS company, 'order ' || l_orderkey AS title,
  'https://jobs.example/' || l_partkey AS apply_url, 'new' AS status FROM added""",
)
def insert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that listings add to a stored table, whose ids are looked up in their buckets."""
    root = in_buckets(spark, known_parts(spark, sf_dir), 16)
    listings = line_listings(spark, sf_dir)
    known, _ = stages.known_ids(spark, root, listings)
    added = insert_new(known, listings, order=_ORDER)
    return added.select("id", "company", "title", "apply_url", "status")


@query(
    "schema_evolve",
    """SELECT p_partkey, p_name, p_size AS relevance_score, p_type AS decision_reason FROM part WHERE p_size > 25
UNION ALL SELECT p_partkey, p_name, 0, NULL FROM part WHERE p_size <= 25""",
)
def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an older table without the late columns, beside rows that have them."""
    part = table(spark, sf_dir, "part")
    schema = T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_name", T.StringType()),
            T.StructField("relevance_score", T.IntegerType()),
            T.StructField("decision_reason", T.StringType()),
        ]
    )
    new = part.where(F.col("p_size") > 25).select(
        "p_partkey", "p_name", F.col("p_size").alias("relevance_score"), F.col("p_type").alias("decision_reason")
    )
    old = part.where(F.col("p_size") <= 25).select("p_partkey", "p_name")
    return evolve(new, schema).unionByName(evolve(old, schema))
