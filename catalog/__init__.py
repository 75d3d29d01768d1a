"""Registered queries: each reads the given tables whole, most with a SQL counterpart."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from winnow.sources.tables import SHARED_DIR, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    own_folder(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_folder(spark: SparkSession) -> None:
    """Name a folder for intermediate tables where no cluster does: in local mode alone."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED_DIR, None)
    if not named and spark.sparkContext.master.startswith("local["):
        spark.conf.set(SHARED_DIR, tempfile.mkdtemp(prefix="winnow-"))


def scratch(spark: SparkSession) -> str:
    """A new shared folder for a query that stores tables."""
    own_folder(spark)
    return shared_dir(spark)


def load() -> None:
    """Import the modules that register queries."""
    from catalog import details, discovery, documents, layouts, logs, state, triage  # noqa: F401
