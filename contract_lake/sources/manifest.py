"""File manifest scan (S10): one row per file with its size and time.

Uses the ``binaryFile`` source with ``content`` pruned, so only the listing is
read; the content hash (for the duplicate-content check) is opt-in because it
reads every byte.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "dataset string, path string, name string, size long, modified_at timestamp"


def scan_manifest(spark: SparkSession, path: str, dataset: str,
                  recursive: bool = True, with_hash: bool = False,
                  glob: str | None = None) -> DataFrame:
    """``dataset, path, name, size, modified_at`` (plus ``content_hash``).

    A folder that cannot be listed raises ``FileNotFoundError`` (V2 turns that
    into a failure row); an empty folder gives no rows (V3).
    """
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        raw = reader.load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(path) from exc
        raise
    cols = [F.lit(dataset).alias("dataset"), F.col("path"),
            F.element_at(F.split(F.col("path"), "/"), -1).alias("name"),
            F.col("length").alias("size"), F.col("modificationTime").alias("modified_at")]
    if with_hash:
        cols.append(F.sha2(F.col("content"), 256).alias("content_hash"))
    return raw.select(*cols)


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MANIFEST_SCHEMA)
