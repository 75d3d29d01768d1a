"""Prompts, replies and rendered documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query, table
from catalog.triage import _COUNTRY_SQL, place_of
from winnow.functions import replies as R
from winnow.functions import text as X
from winnow.operators.documents import (
    application_payload,
    build_prompts,
    folder_collisions,
    prompt_errors,
    render_documents,
    response_errors,
)
from winnow.operators.state import mark_generated

# An invented person.
IDENTITY = {
    "first_name": "Alba",
    "last_name": "Quill_Stone",
    "location": "Port & Bay",
    "phone": "000",
    "email": "a_q@example.org",
    "linkedin": "albaquill",
}
CANDIDATE = "Name: Alba Quill\nSkills: sorting & sieving"
SKILLS = {"Sorting": "sieve_1, fan", "Tools": "50% rope"}
TEMPLATES = {
    "resume": "\\name{<< first_name >> << last_name >>}<# not shown #>\n\\title{<< job_title_target >>}\n"
    "\\section{<< h_profile >>}\n<< profile_summary >>\n\\section{<< h_experience >>}\n"
    "<% for b in experience_bullets %>\\item << b >>\n<% endfor %>"
    "<% for k, v in skills_dict.items() %>[<< k >>: << v >>]<% endfor %><< missing >>\n",
    "cover": "<< company_name >>, << location >>\n<< cl_opening >>\n<< cover_letter_body >>\n<< cl_closing >>",
}


def document_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as approved jobs; one source has no description, one is only scraped."""
    source = F.col("source")
    return table(spark, sf_dir, "documents").select(
        F.md5(F.col("doc_id").cast("string")).alias("id"),
        F.concat(F.lit("A&B "), source).alias("company"),
        F.concat(F.lit("Clerk "), F.col("lang")).alias("title"),
        place_of(source).alias("location"),
        F.when(source != "src5", F.col("text")).alias("description"),
        F.when(source == "src6", "scraped").otherwise("approved").alias("status"),
    )


_JOB_SQL = f"""{_COUNTRY_SQL},
job AS (SELECT d.*, md5(CAST(d.doc_id AS VARCHAR)) AS id, 'Clerk ' || lang AS title, 'A&B ' || source AS company,
  CASE country WHEN 'FR' THEN 'FR' ELSE 'EN' END AS l FROM documents d JOIN country USING (doc_id) WHERE source <> 'src6')"""


# The wording of the prompt, as in winnow.defaults.
@query(
    "build_prompt",
    rf"""WITH {_JOB_SQL}, p AS (SELECT id, l AS lang, '
You are a professional recruiter and ATS resume writer.

LANGUAGE: ' || CASE l WHEN 'FR' THEN 'FRENCH' ELSE 'ENGLISH' END || '

JOB DESCRIPTION:
' || substring(text, 1, 2500) || '

CANDIDATE PROFILE:
Name: Alba Quill
Skills: sorting & sieving

RETURN PURE JSON ONLY:
{{
  "job_title_target": "' || title || '",
  "profile_summary": "2 sentences, first person",
  "experience_bullets": ["...", "...", "...", "..."],
  "cover_letter_body": "3 paragraphs separated by double newlines"
}}
' AS prompt FROM job WHERE source <> 'src5')
SELECT id, lang, length(prompt) AS n_chars, md5(prompt) AS prompt FROM p""",
)
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_prompts(document_jobs(spark, sf_dir), CANDIDATE).select(
        "id", "lang", F.length("prompt").cast("bigint").alias("n_chars"), F.md5("prompt").alias("prompt")
    )


@query(
    "prompt_errors",
    """SELECT md5(CAST(doc_id AS VARCHAR)) AS id, 'prompt' AS stage, 'no description' AS message
FROM documents WHERE source = 'src5'""",
)
def no_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_errors(document_jobs(spark, sf_dir))


def turn_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as replies: the shape of the reply follows the turn, chatter is put around it."""
    text, twice = F.col("text"), F.array(F.col("text"), F.concat(F.lit(" "), F.col("role"), F.lit(" ")))
    body = (
        F.when(F.col("turn") % 8 == 0, F.to_json(F.struct(text.alias("cover_letter_body"))))
        .when(F.col("turn") % 8 == 1, F.to_json(F.struct(twice.alias("cover_letter_body"))))
        .when(F.col("turn") % 8 == 2, F.to_json(F.struct(F.struct(twice.alias("paragraphs")).alias("cover_letter_body"))))
        .when(F.col("turn") % 8 == 3, F.lit("{bad}"))
        .when(F.col("turn") % 8 == 4, F.lit("{ }"))
        .when(F.col("turn") % 8 == 5, F.concat(F.to_json(F.struct(text.alias("k"))), F.lit(" and "), F.to_json(F.struct(text.alias("k")))))
        .when(F.col("turn") % 8 == 6, F.lit('{"cover_letter_body": 7}'))
        .otherwise(F.lit("none"))
    )
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.concat(F.lit("Sure, "), F.col("role"), F.lit(":\n"), body, F.lit("\nDone.")).alias("raw"),
    )


_BODY_SQL = """CASE turn % 8 WHEN 0 THEN {t} WHEN 1 THEN {t} || chr(10) || chr(10) || role
  WHEN 2 THEN {t} || chr(10) || chr(10) || role ELSE '' END""".format(
    t="trim(text, ' ' || chr(9) || chr(10) || chr(13))"
)


@query(
    "parse_response",
    """SELECT conv_id || '-' || turn AS id, turn % 8 IN (0, 1, 2, 6) AS usable FROM conversations""",
)
def usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_replies(spark, sf_dir).select("id", R.reply_object(F.col("raw")).isNotNull().alias("usable"))


@query(
    "response_errors",
    """SELECT conv_id || '-' || turn AS id, 'response' AS stage, 'no usable reply' AS message
FROM conversations WHERE turn % 8 IN (3, 4, 5, 7)""",
)
def unusable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return response_errors(turn_replies(spark, sf_dir))


@query(
    "cover_body",
    f"""SELECT conv_id || '-' || turn AS id, {_BODY_SQL} AS body FROM conversations WHERE turn % 8 IN (0, 1, 2, 6)""",
)
def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = turn_replies(spark, sf_dir).select("id", R.reply_object(F.col("raw")).alias("reply"))
    return replies.where(F.col("reply").isNotNull()).select(
        "id", R.cover_body(F.try_variant_get("reply", "$.cover_letter_body", "variant")).alias("body")
    )


def tex_sql(x: str) -> str:
    return (
        rf"replace(replace(replace(regexp_replace(replace({x}, '\', chr(1)), '([&%$#_{{}}])', '\\\1', 'g'),"
        r" '~', '\textasciitilde{}'), '^', '\textasciicircum{}'), chr(1), '\textbackslash{}')"
    )


@query(
    "escape_tex",
    rf"""SELECT doc_id, {tex_sql("'a\\b {50%} x_y ~ ^ ' || text")} AS tex FROM documents""".replace("a\\\\b", "a\\b"),
)
def escaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("a\\b {50%} x_y ~ ^ "), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", X.escape_tex(text).alias("tex"))


def document_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply for every document; those of one source lack their last brace."""
    reply = F.to_json(
        F.struct(
            F.concat(F.lit(" "), "source", F.lit("_1 ")).alias("job_title_target"),
            F.concat(F.lit("50% "), "lang").alias("profile_summary"),
            F.array(F.col("lang"), F.concat(F.lit(" #"), "source")).alias("experience_bullets"),
            F.struct(F.array("text", "lang").alias("paragraphs")).alias("cover_letter_body"),
            F.lit("Nobody").alias("first_name"),
        )
    )
    raw = F.when(F.col("source") == "src7", F.regexp_replace(reply, r"\}$", "")).otherwise(reply)
    return table(spark, sf_dir, "documents").select(
        F.md5(F.col("doc_id").cast("string")).alias("id"), raw.alias("raw")
    )


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return application_payload(
        document_jobs(spark, sf_dir), document_replies(spark, sf_dir), IDENTITY, skills=SKILLS
    )


_TRIM = "trim({x}, ' ' || chr(9) || chr(10) || chr(13))"
_PAYLOAD_SQL = f"""{_JOB_SQL},
payload AS (SELECT id, l AS lang, regexp_replace(company || '_' || title, '[^\\p{{L}}\\p{{N}}_\\-]+', '_', 'g') AS folder,
  'A\\&B ' || source AS company_name, source || '\\_1' AS job_title_target, '50\\% ' || lang AS profile_summary,
  lang AS b1, ' \\#' || source AS b2, {tex_sql(_TRIM.format(x="text") + " || chr(10) || chr(10) || lang")} AS cover_letter_body,
  l = 'FR' AS fr, doc_id FROM job WHERE source <> 'src5' AND source <> 'src7')"""


@query(
    "application_payload",
    f"""WITH {_PAYLOAD_SQL} SELECT id, lang, folder, company_name, job_title_target, profile_summary,
  b1 || '|' || b2 AS bullets, cover_letter_body, 'Alba Quill\\_Stone' AS name,
  CASE WHEN fr THEN 'Formation' ELSE 'Education' END AS h_education, 'sieve_1, fan' AS sorting FROM payload""",
)
def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload(spark, sf_dir).select(
        "id", "lang", "folder", "company_name", "job_title_target", "profile_summary",
        F.array_join("experience_bullets", "|").alias("bullets"),
        "cover_letter_body",
        F.concat_ws(" ", "identity.first_name", "identity.last_name").alias("name"),
        F.col("labels")["h_education"].alias("h_education"),
        F.col("skills")["Sorting"].alias("sorting"),
    )


@query(
    "render_documents",
    f"""WITH {_PAYLOAD_SQL}
SELECT id, folder, 'resume' AS kind, '\\name{{Alba Quill\\_Stone}}
\\title{{' || job_title_target || '}}
\\section{{' || CASE WHEN fr THEN 'Profil' ELSE 'Profile' END || '}}
' || profile_summary || '
\\section{{' || CASE WHEN fr THEN 'Expérience professionnelle' ELSE 'Experience' END || '}}
\\item ' || b1 || '
\\item ' || b2 || '
[Sorting: sieve_1, fan][Tools: 50% rope]' AS body FROM payload
UNION ALL SELECT id, folder, 'cover', company_name || ', Port \\& Bay
' || CASE WHEN fr THEN 'Madame, Monsieur,' ELSE 'Dear Hiring Manager,' END || '
' || cover_letter_body || '
' || CASE WHEN fr THEN 'Cordialement,' ELSE 'Sincerely,' END FROM payload""",
)
def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_documents(payload(spark, sf_dir), TEMPLATES)


@query(
    "folder_collisions",
    f"""WITH {_PAYLOAD_SQL} SELECT folder, count(*) AS n, min(id) AS first_id FROM payload GROUP BY folder HAVING count(*) > 1""",
)
def collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folder_collisions(payload(spark, sf_dir))


@query(
    "mark_generated",
    """SELECT md5(CAST(doc_id AS VARCHAR)) AS id, CASE WHEN source = 'src6' THEN 'scraped'
  WHEN source IN ('src5', 'src7') THEN 'approved' ELSE 'generated' END AS status FROM documents""",
)
def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_generated(document_jobs(spark, sf_dir), payload(spark, sf_dir)).select("id", "status")
