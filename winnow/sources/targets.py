"""Target lists: grouped addresses from configuration or from a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.schemas import TARGETS


def targets_from(spark: SparkSession, config) -> DataFrame:
    """Targets of a mapping of group to address list, or of a bare list.

    Groups that do not hold a list are skipped; each address is kept once, at its first place.
    """
    groups = config if isinstance(config, Mapping) else {"": config}
    rows = []
    for group, addresses in groups.items():
        if isinstance(addresses, list):
            rows += [(str(group), len(rows) + i, str(url)) for i, url in enumerate(addresses)]
    return distinct_targets(spark.createDataFrame(rows, TARGETS))


def load_targets(spark: SparkSession, path: str) -> DataFrame:
    """Targets of a YAML or JSON file in any store that Spark reads; a missing file has none."""
    try:
        text = spark.read.text(path, wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], TARGETS)
    text = text[0] if text else ""
    if path.endswith(".json"):
        import json

        config = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise ImportError("YAML targets need PyYAML; use a JSON file instead") from e
        config = yaml.safe_load(text)
    return targets_from(spark, config)


def distinct_targets(targets: DataFrame) -> DataFrame:
    """Each address once, with the group and position of its first mention."""
    first = F.min_by(F.col("group"), F.col("ord")).alias("group")
    return targets.groupBy("url").agg(first, F.min("ord").alias("ord")).select("group", "ord", "url")
