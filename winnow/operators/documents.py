"""Prompts out, replies in, documents out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow import defaults
from winnow.functions import replies as R
from winnow.functions.text import (
    detect_country,
    escape_tex,
    escaped_lit,
    language,
    output_folder,
    strip,
)
from winnow.sources.files import write_files
from winnow.sources.tables import write_next
from winnow.sources.templates import render


def country_of(location: Column, description: Column) -> Column:
    return detect_country(location, description, defaults.COUNTRY_RULES, defaults.OTHER_COUNTRY)


def _by_language(lang: Column, choices: Mapping[str, Column]) -> Column:
    return F.when(lang == "FR", choices["FR"]).otherwise(choices["EN"])


def approved(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("status") == "approved")


def build_prompts(
    jobs: DataFrame, candidate: str, template: str = defaults.PROMPT, cut: int = defaults.DESCRIPTION_CUT
) -> DataFrame:
    """``(id, lang, prompt)`` of the approved rows that have a description.

    ``render`` drops a final line break, the prompt keeps it.
    """
    lang = language(country_of(F.col("location"), F.col("description")))
    names = {k: F.lit(v) for k, v in defaults.LANGUAGE_NAMES.items()}
    values = {
        "language": _by_language(F.col("lang"), names),
        "description": F.substring("description", 1, cut),
        "candidate": F.lit(candidate),
        "title": F.coalesce(F.col("title"), F.lit("None")),
    }
    rows = approved(jobs).where(F.col("description").isNotNull()).withColumn("lang", lang)
    return rows.select("id", "lang", render(template + "\n", values).alias("prompt"))


def prompt_errors(jobs: DataFrame) -> DataFrame:
    """Approved rows no prompt can be built for."""
    return approved(jobs).where(F.col("description").isNull()).select(
        "id", F.lit("prompt").alias("stage"), F.lit("no description").alias("message")
    )


def parse_responses(responses: DataFrame) -> DataFrame:
    """``(id, reply)`` with the reply as a variant, null where it is unusable.

    Generated rather than projected, so that a filter on the reply does not make the
    optimizer parse it a second time.
    """
    return responses.select("id", F.explode_outer(F.array(R.reply_object(F.col("raw")))).alias("reply"))


def one_reply(responses: DataFrame, latest: str = "raw") -> DataFrame:
    """``(id, reply)``: the usable reply to each id that is greatest by a column, then by its text."""
    order = F.struct(F.col(latest).alias("latest"), "raw")
    read = responses.select(
        "id", order.alias("order"), F.explode_outer(F.array(R.reply_object(F.col("raw")))).alias("reply")
    )
    usable = read.where(F.col("reply").isNotNull())
    return usable.groupBy("id").agg(F.max_by("reply", "order").alias("reply"))


def response_errors(responses: DataFrame) -> DataFrame:
    return (
        parse_responses(responses)
        .where(F.col("reply").isNull())
        .select("id", F.lit("response").alias("stage"), F.lit("no usable reply").alias("message"))
    )


def _texts(values: Mapping[str, str]) -> Column:
    return F.create_map(*[c for k, v in values.items() for c in (F.lit(k), escaped_lit(v))])


def application_payload(
    jobs: DataFrame,
    responses: DataFrame,
    identity: Mapping[str, str],
    *,
    labels: Mapping[str, Mapping[str, str]] = defaults.LANGUAGE_LABELS,
    skills: Mapping[str, str] | None = None,
    latest: str = "raw",
) -> DataFrame:
    """What the templates need, for each approved row with a usable reply.

    Of several usable replies to an id the one greatest by ``latest`` counts.

    Precedence: labels, then identity, then reply. All texts are trimmed and escaped, list
    items only escaped, ``skills`` left alone. Labels of both languages are literals, so
    choosing them is a ``CASE`` and not a join.
    """
    lang = language(country_of(F.col("location"), F.col("description")))
    # Narrow before the join: descriptions need not be shuffled.
    rows = (
        approved(jobs)
        .where(F.col("description").isNotNull())
        .select("id", "company", "title", lang.alias("lang"))
        .join(one_reply(responses, latest), "id")
    )
    reply = F.col("reply")
    skill_map = (
        F.create_map(*[F.lit(x) for kv in skills.items() for x in kv])
        if skills
        else F.create_map().cast("map<string,string>")
    )
    return rows.select(
        "id",
        "lang",
        output_folder(F.col("company"), F.col("title")).alias("folder"),
        escape_tex(strip(F.col("company"))).alias("company_name"),
        R.text_field(reply, "job_title_target").alias("job_title_target"),
        R.text_field(reply, "profile_summary").alias("profile_summary"),
        R.bullets(F.try_variant_get(reply, "$.experience_bullets", "variant")).alias(
            "experience_bullets"
        ),
        escape_tex(
            R.cover_body(F.try_variant_get(reply, "$.cover_letter_body", "variant"))
        ).alias("cover_letter_body"),
        F.struct(*[escaped_lit(v).alias(k) for k, v in identity.items()]).alias("identity"),
        _by_language(F.col("lang"), {k: _texts(v) for k, v in labels.items()}).alias("labels"),
        skill_map.alias("skills"),
    )


def render_documents(payload: DataFrame, templates: Mapping[str, str], *, id_suffix: bool = False) -> DataFrame:
    """``(id, folder, kind, body)``, a row per payload row and template.

    Rows of equal company and title share a folder; ``id_suffix`` keeps them apart.
    """
    values = {
        c: F.col(c)
        for c in (
            "lang", "company_name", "job_title_target", "profile_summary",
            "experience_bullets", "cover_letter_body",
        )
    }
    values["skills_dict"] = F.col("skills")
    for field in payload.schema["identity"].dataType.names:
        values[field] = F.col(f"identity.{field}")

    def label(name: str) -> Column:
        return F.col("labels")[name]

    # Labels win over identity, and that over the reply; lists and maps have no label.
    for name in values.keys() - {"experience_bullets", "skills_dict"}:
        values[name] = F.coalesce(label(name), values[name])

    folder = F.col("folder")
    if id_suffix:
        folder = F.concat(folder, F.lit("_"), F.substring("id", 1, 6))
    bodies = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), render(t, values, label).alias("body"))
            for kind, t in templates.items()
        ]
    )
    return payload.select("id", folder.alias("folder"), F.explode(bodies).alias("d")).select(
        "id", "folder", "d.kind", "d.body"
    )


def write_documents(documents: DataFrame, path: str) -> str:
    """Write one run's documents and return where: ``path/v=N``, partitioned by kind.

    All runs together are the table ``path``; of equal folders and kinds the greatest ``v``
    is the current one.
    """
    return write_next(documents, path, ['kind'])[1]


def write_document_files(documents: DataFrame, path: str, extension: str = ".tex") -> None:
    """Write each body to ``path/folder/kind``; documents of one folder and kind are refused.

    Render them with ``id_suffix`` where companies and titles coincide.
    """
    name = F.concat_ws("/", "folder", F.concat(F.col("kind"), F.lit(extension)))
    write_files(documents.select(name.alias("name"), "body"), path)


def folder_collisions(payload: DataFrame) -> DataFrame:
    """Folders that several rows would write to."""
    return (
        payload.groupBy("folder")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        .where(F.col("n") > 1)
    )
