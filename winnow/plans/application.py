"""From replies to documents."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from winnow.operators.documents import (
    application_payload,
    prompt_errors,
    render_documents,
    response_errors,
)
from winnow.operators.state import mark_generated


@dataclass(frozen=True)
class Ingested:
    documents: DataFrame  # id, folder, kind, body
    errors: DataFrame  # id, stage, message
    jobs: DataFrame  # the next state of the jobs table


def ingest_responses(
    jobs: DataFrame,
    responses: DataFrame,
    identity: Mapping[str, str],
    templates: Mapping[str, str],
    *,
    id_suffix: bool = False,
    **options,
) -> Ingested:
    """Documents of the approved rows with a usable reply, which become ``generated``.

    All other rows keep their status, so a later run takes them up again.
    """
    payload = application_payload(jobs, responses, identity, **options)
    return Ingested(
        render_documents(payload, templates, id_suffix=id_suffix),
        prompt_errors(jobs).unionByName(response_errors(responses)),
        mark_generated(jobs, payload),
    )
