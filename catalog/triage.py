"""Tokens, verdicts, reports, word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query, table
from winnow.functions.text import language, tokenize
from winnow.operators.documents import country_of
from winnow.operators.triage import apply_triage, triage, triage_report, triage_summary
from winnow.operators.vocabulary import role_rules, skill_tags, skill_tags_joined

POSITIVE = ("red", "blue", "small", "gear", "widget")
NEGATIVE = ("hot", "old", "Cold")  # tokens are lower case, so the last never applies


@query(
    "tokenize",
    r"""WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS ts FROM documents)
SELECT doc_id, len(ts) AS n_tokens, md5(array_to_string(list_sort(ts), ' ')) AS tokens FROM t""",
)
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", tokenize(F.col("text")).alias("ts"))
    return docs.select(
        "doc_id",
        F.size("ts").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join(F.sort_array("ts"), " ")).alias("tokens"),
    )


def part_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as jobs; those of one type are still new."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("company"),
        F.when(F.col("p_type") == "ECONOMY", "new").otherwise("scraped").alias("status"),
        F.lit(0).alias("relevance_score"),
        F.lit(None).cast("string").alias("decision_reason"),
    )


_VERDICT_SQL = r"""tok AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, p_brand AS company, p_type <> 'ECONOMY' AS scraped,
  list_distinct(regexp_extract_all(lower(p_name), '[\p{L}\p{N}_]+')) AS ts FROM part),
hit AS (SELECT *, list_sort(list_intersect(ts, ['hot', 'old', 'Cold'])) AS neg,
  list_sort(list_intersect(ts, ['red', 'blue', 'small', 'gear', 'widget'])) AS pos FROM tok),
verdict AS (SELECT id, title, company, scraped,
  CASE WHEN len(neg) = 0 AND len(pos) > 0 THEN 'approved' ELSE 'ignored' END AS status,
  CAST(CASE WHEN len(neg) > 0 THEN 0 ELSE len(pos) END AS INTEGER) AS score,
  CASE WHEN len(neg) > 0 THEN 'Negative match: ' || array_to_string(neg, ', ')
       WHEN len(pos) > 0 THEN 'Positive match: ' || array_to_string(pos, ', ')
       ELSE 'No keywords matched' END AS reason FROM hit)"""


@query("triage", f"WITH {_VERDICT_SQL} SELECT id, title, company, status, score, reason FROM verdict WHERE scraped")
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage(part_jobs(spark, sf_dir), POSITIVE, NEGATIVE)


@query("triage_report", f"WITH {_VERDICT_SQL} SELECT company, title, status, score, reason FROM verdict WHERE scraped")
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage_report(verdicts(spark, sf_dir))


@query(
    "triage_summary",
    f"""WITH {_VERDICT_SQL} SELECT count(*) FILTER (status = 'approved') AS approved,
  count(*) FILTER (status = 'ignored') AS ignored FROM verdict WHERE scraped""",
)
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage_summary(verdicts(spark, sf_dir))


@query(
    "apply_triage",
    f"""WITH {_VERDICT_SQL} SELECT id, title, company, CASE WHEN scraped THEN status ELSE 'new' END AS status,
  CASE WHEN scraped THEN score ELSE 0 END AS relevance_score, CASE WHEN scraped THEN reason END AS decision_reason
FROM verdict""",
)
def apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_triage(part_jobs(spark, sf_dir), POSITIVE, NEGATIVE)


_COUNTRY_SQL = """place AS (SELECT doc_id, CASE source WHEN 'src1' THEN 'Paris' WHEN 'src2' THEN 'Stockholm'
    WHEN 'src3' THEN 'Malmö' WHEN 'src4' THEN NULL ELSE source END AS location, text FROM documents),
country AS (SELECT doc_id, CASE
  WHEN regexp_matches(lower(concat_ws(' ', location, text)), 'france|paris|lyon') THEN 'FR'
  WHEN regexp_matches(lower(concat_ws(' ', location, text)), 'sweden|stockholm|gothenburg|malmo') THEN 'SE'
  ELSE 'INT' END AS country FROM place)"""


def place_of(source):
    return (
        F.when(source == "src1", "Paris").when(source == "src2", "Stockholm").when(source == "src3", "Malmö")
        .when(source == "src4", F.lit(None)).otherwise(source)
    )


@query(
    "detect_country",
    f"WITH {_COUNTRY_SQL} SELECT doc_id, country, CASE country WHEN 'FR' THEN 'FR' ELSE 'EN' END AS lang FROM country",
)
def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", country_of(place_of(F.col("source")), F.col("text")).alias("country")
    )
    return docs.withColumn("lang", language(F.col("country")))


VOCABULARY = {"short": ("la", "de", "C++"), "mixed": ("the", "und", "de", "lyon"), "none": ("CI/CD",)}


def _skills_sql() -> str:
    def flag(term):
        t = term.lower().replace("+", "\\+")
        return rf"CASE WHEN regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}]){t}($|[^\p{{L}}\p{{N}}])') THEN '{term}' END"

    rows = " UNION ALL ".join(
        f"SELECT doc_id, '{g}' AS grp, concat_ws(',', {', '.join(flag(t) for t in sorted(terms))}) AS skills FROM documents"
        for g, terms in VOCABULARY.items()
    )
    return f"SELECT * FROM ({rows}) WHERE skills <> ''"


@query("skill_tags", _skills_sql())
def skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return skill_tags(docs, "text", VOCABULARY).select(
        "doc_id", F.col("group").alias("grp"), F.array_join("skills", ",").alias("skills")
    )


_WORDS_SQL = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\p{L}\\p{N}]+')"


@query(
    "skill_tags_table",
    f"""WITH term AS (SELECT DISTINCT lang AS grp, unnest({_WORDS_SQL}) AS w FROM documents),
word AS (SELECT DISTINCT conv_id, turn, unnest({_WORDS_SQL}) AS w FROM conversations)
SELECT conv_id, turn, grp, count(*) AS n, md5(string_agg(w, ',' ORDER BY w)) AS skills FROM word JOIN term USING (w) GROUP BY ALL""",
)
def skills_of_a_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations against a vocabulary of all words of the documents, by language."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.explode_outer(F.regexp_extract_all(lower, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))  # plain, it is worked out twice
    terms = table(spark, sf_dir, "documents").select(F.col("lang").alias("group"), words.alias("term")).distinct()
    found = skill_tags_joined(table(spark, sf_dir, "conversations"), ["conv_id", "turn"], "text", terms)
    return found.select(
        "conv_id", "turn", F.col("group").alias("grp"), F.size("skills").cast("bigint").alias("n"),
        F.md5(F.array_join("skills", ",")).alias("skills"),
    )


@query(
    "role_rules",
    """SELECT p_partkey, p_name, regexp_matches(p_name, '(?i)widget|red r|GEAR') AS role_included,
  regexp_matches(p_name, '(?i)hot|new') AS role_soft_excluded FROM part""",
)
def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return role_rules(parts, "p_name", ("Widget", "Red R", "GEAR"), ("Hot", "New"))
