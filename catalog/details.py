"""Page text, file names, and the details step."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query, scratch, table
from catalog.discovery import CLEAN_SQL
from winnow.functions import text as X
from winnow.functions.nodes import page_text
from winnow.operators.state import apply_details, raw_pages
from winnow.sources.html import html_nodes
from winnow.sources.page_index import open_index

_UNESCAPED = r"""replace(replace(replace(replace(replace(x, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '&amp', '&')"""


@query(
    "page_text",
    rf"""WITH c AS (SELECT page_id, regexp_split_to_array({CLEAN_SQL}, '<[^>]*>') AS parts FROM pages),
t AS (SELECT page_id, list_filter(list_transform(parts, lambda x: trim({_UNESCAPED}, chr(9) || chr(10) || chr(13) || ' ')), lambda x: x <> '') AS parts FROM c)
SELECT page_id, array_to_string(parts, chr(10)) AS text FROM t""",
)
def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html_nodes(table(spark, sf_dir, "pages"), "page_id", attributes=())
    return nodes.select("page_id", page_text(F.col("nodes")).alias("text"))


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per part: nested markup, entities, silent elements, odd white space."""
    html = F.concat(
        F.lit("<html><head><title>"), F.col("p_brand"),
        F.lit("</title><script>if (a<b) x('</p>');</script></head><body><!-- no --><ul><li>\xa0"), F.col("p_name"),
        F.lit("\t<li><b>Size</b>: "), F.col("p_size").cast("string"),
        F.lit(" &lt;mm&gt;</ul><template><p>hidden</p></template><p> \xa0 </p>R&amp;D <i>"), F.col("p_type"),
        F.lit("</i><style>p{}</style>"),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("page_id"),
        F.concat(F.lit("https://h/"), F.col("p_partkey").cast("string")).alias("url"),
        html.alias("html"),
    )


_TEXT_SQL = "concat_ws(chr(10), p_brand, p_name, 'Size', ': ' || p_size || ' <mm>', 'R&D', p_type)"


@query("page_text_part", f"SELECT p_partkey AS page_id, {_TEXT_SQL} AS text FROM part")
def part_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = html_nodes(detail_pages(spark, sf_dir), "page_id", attributes=())
    return nodes.select("page_id", page_text(F.col("nodes")).alias("text"))


def _clean_sql(x: str) -> str:
    return (
        rf"trim(regexp_replace(regexp_replace({x}, '[^\p{{L}}\p{{N}}_\-]', '_', 'g'), '_+', '_', 'g'), '_')"
    )


def _file_sql(company: str, title: str, location: str, id_: str) -> str:
    return f"{_clean_sql(company)} || '__' || {_clean_sql(title)} || '__' || {_clean_sql(location)} || '__' || {id_}[1:6] || '.html'"


@query(
    "raw_filename",
    f"""SELECT c_custkey, {_file_sql("c_name", "'(' || c_mktsegment || ') C++ – é '", "n_name", "md5(c_name)")} AS name
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def raw_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == nation["n_nationkey"])
    title = F.concat(F.lit("("), F.col("c_mktsegment"), F.lit(") C++ – é "))
    return rows.select(
        "c_custkey",
        X.raw_filename(F.col("c_name"), title, F.col("n_name"), F.md5("c_name")).alias("name"),
    )


@query(
    "output_folder",
    r"""SELECT c_custkey, regexp_replace(c_name || '_' || c_mktsegment || ' (' || n_name || ')', '[^\p{L}\p{N}_\-]+', '_', 'g') AS folder
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def output_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == nation["n_nationkey"])
    title = F.concat(F.col("c_mktsegment"), F.lit(" ("), F.col("n_name"), F.lit(")"))
    return rows.select("c_custkey", X.output_folder(F.col("c_name"), title).alias("folder"))


def visit_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as jobs that point at customers' numbers, many at one page, some at none."""
    status = (
        F.when(F.col("o_orderstatus") == "O", "new")
        .when(F.col("o_orderpriority") == "5-LOW", "approved")
        .when(F.col("o_orderstatus") == "F", "ignored")
    )
    key = F.when(F.col("o_totalprice") < 150000, F.col("o_custkey")).otherwise(-F.col("o_custkey") - 1)
    return table(spark, sf_dir, "orders").select(
        F.md5(F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderpriority").alias("company"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.lit("Nice").alias("location"),
        F.concat(F.lit("https://h/"), key.cast("string")).alias("apply_url"),
        F.when(F.col("o_totalprice") < 20000, "known").alias("description"),
        status.alias("status"),
        F.lit(None).cast("string").alias("raw_path"),
    )


_VISIT_SQL = f"""job AS (SELECT md5(CAST(o_orderkey AS VARCHAR)) AS id, o_orderpriority AS company,
  'Order ' || o_orderkey AS title, 'Nice' AS location, CASE WHEN o_totalprice < 150000 THEN o_custkey ELSE -o_custkey - 1 END AS page,
  CASE WHEN o_totalprice < 20000 THEN 'known' END AS description,
  CASE WHEN o_orderstatus = 'O' THEN 'new' WHEN o_orderpriority = '5-LOW' THEN 'approved'
       WHEN o_orderstatus = 'F' THEN 'ignored' END AS status FROM orders),
hit AS (SELECT job.*, p_partkey IS NOT NULL AND description IS NULL AND coalesce(status <> 'ignored', false) AS hit,
  {_TEXT_SQL} AS text, p_partkey FROM job LEFT JOIN part ON p_partkey = page),
done AS (SELECT id, company, title, 'https://h/' || page AS apply_url, CASE WHEN hit THEN text ELSE description END AS description,
  CASE WHEN hit THEN 'scraped' ELSE status END AS status,
  CASE WHEN hit THEN 'data/raw_jobs/' || {_file_sql("company", "title", "location", "id")} END AS raw_path, p_partkey FROM hit)"""


@query(
    "apply_details",
    f"WITH {_VISIT_SQL} SELECT id, apply_url, description, status, raw_path FROM done",
)
def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = apply_details(visit_jobs(spark, sf_dir), detail_pages(spark, sf_dir))
    return done.select("id", "apply_url", "description", "status", "raw_path")


@query(
    "apply_details_index",
    f"WITH {_VISIT_SQL} SELECT id, apply_url, description, status, raw_path FROM done",
)
def details_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``apply_details``, by an index that took in the pages in two batches, the later ones first."""
    pages = detail_pages(spark, sf_dir)
    index = open_index(spark, scratch(spark), f"pages_{uuid4().hex}", buckets=16)
    for later in (True, False):
        index.add(pages.where((F.col("page_id") % 2 == 0) == F.lit(later)))
    done = apply_details(visit_jobs(spark, sf_dir), pages, index=index)
    return done.select("id", "apply_url", "description", "status", "raw_path")


_HTML_SQL = """'<html><head><title>' || p_brand || '</title><script>if (a<b) x(''</p>'');</script></head><body><!-- no --><ul><li>' || chr(160)
  || p_name || chr(9) || '<li><b>Size</b>: ' || p_size
  || ' &lt;mm&gt;</ul><template><p>hidden</p></template><p> ' || chr(160) || ' </p>R&amp;D <i>' || p_type || '</i><style>p{}</style>'"""


@query(
    "raw_pages",
    f"""WITH {_VISIT_SQL} SELECT company, raw_path, md5({_HTML_SQL}) AS markup
FROM done JOIN part USING (p_partkey) WHERE raw_path IS NOT NULL""",
)
def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = detail_pages(spark, sf_dir)
    kept = raw_pages(apply_details(visit_jobs(spark, sf_dir), pages), pages)
    return kept.select("company", "raw_path", F.md5("html").alias("markup"))
