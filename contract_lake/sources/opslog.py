"""Read appended log and metric records (S8) with their fixed schemas, so a
missing field is NULL rather than a schema change, and nothing is inferred.
Date folders are searched recursively; the date itself is in ``timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.observe import LOG_SCHEMA, METRIC_SCHEMA


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log records from a folder (recursively) or a glob."""
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metric records from a folder (recursively) or a glob."""
    return spark.read.schema(METRIC_SCHEMA).option("recursiveFileLookup", "true").json(path)
