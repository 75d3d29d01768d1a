"""Approve or ignore scraped rows by the words of their title."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow import defaults
from winnow.functions.text import classify


def triage(
    jobs: DataFrame,
    positive: Iterable[str] = defaults.POSITIVE_KEYWORDS,
    negative: Iterable[str] = defaults.NEGATIVE_KEYWORDS,
) -> DataFrame:
    """Verdicts ``(id, title, company, status, score, reason)`` of the scraped rows."""
    return (
        jobs.where(F.col("status") == "scraped")
        .select("id", "title", "company", classify(F.col("title"), positive, negative).alias("v"))
        .select("id", "title", "company", "v.status", "v.score", "v.reason")
    )


def apply_triage(
    jobs: DataFrame,
    positive: Iterable[str] = defaults.POSITIVE_KEYWORDS,
    negative: Iterable[str] = defaults.NEGATIVE_KEYWORDS,
) -> DataFrame:
    """``jobs`` with the verdicts written in. A verdict depends on its row alone: no join."""
    verdict = F.when(F.col("status") == "scraped", classify(F.col("title"), positive, negative))
    new = {"status": "status", "relevance_score": "score", "decision_reason": "reason"}
    return jobs.withColumn("verdict", verdict).select(
        *[
            F.when(F.col("verdict").isNotNull(), F.col(f"verdict.{new[c]}"))
            .otherwise(F.col(c))
            .alias(c)
            if c in new
            else F.col(c)
            for c in jobs.columns
        ]
    )


def triage_report(verdicts: DataFrame) -> DataFrame:
    return verdicts.select("company", "title", "status", "score", "reason")


def triage_summary(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(
        F.count_if(F.col("status") == "approved").alias("approved"),
        F.count_if(F.col("status") == "ignored").alias("ignored"),
    )
