"""Source-file gate (V1-V8) as jobs over a file manifest.

A manifest is a DataFrame ``dataset, path, name, size, modified_at`` (one
row per file; see ``sources.manifest.scan_manifest``). Each check returns the
offending files as rows, so every failure is reported, not just the first;
only ``gate`` brings a bounded number of failure rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The gate's limits and the completeness expectation.
MIN_FILE_KB = 2
MAX_FILE_AGE_DAYS = 5
EXPECTED_FILES_PER_DATASET = 1
SECONDS_PER_DAY = 86400


def size_kb(size: str | Column = "size") -> Column:
    """Size in KiB rounded to two decimals, as the limit is stated."""
    s = F.col(size) if isinstance(size, str) else size
    return F.round(s / F.lit(1024.0), 2)


def age_days(as_of, modified_at: str | Column = "modified_at") -> Column:
    """Whole days between modification and ``as_of`` (truncated toward zero)."""
    m = F.col(modified_at) if isinstance(modified_at, str) else modified_at
    t = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    seconds = F.timestamp_diff("SECOND", m, t)
    return (seconds / F.lit(SECONDS_PER_DAY)).cast("long")


def small_files(manifest: DataFrame, min_kb: float = MIN_FILE_KB) -> DataFrame:
    """V4: files whose rounded size is under ``min_kb``."""
    return manifest.withColumn("size_kb", size_kb("size")).filter(F.col("size_kb") < F.lit(min_kb))


def stale_files(manifest: DataFrame, as_of, max_days: int = MAX_FILE_AGE_DAYS) -> DataFrame:
    """V5: files more than ``max_days`` whole days old at ``as_of`` (UTC).
    A text ``as_of`` takes the type of ``modified_at``, so a zone-less time is
    compared with a zone-less time whatever the session time zone."""
    if not isinstance(as_of, Column):
        as_of = F.lit(as_of).cast(manifest.schema["modified_at"].dataType)
    return manifest.withColumn("age_days", age_days(as_of)).filter(F.col("age_days") > F.lit(max_days))


def duplicate_names(manifest: DataFrame) -> DataFrame:
    """V6: names seen more than once in a dataset (a recursive listing can
    hold one name in several subfolders)."""
    return manifest.groupBy("dataset", "name").agg(F.count(F.lit(1)).alias("n_copies")) \
                   .filter(F.col("n_copies") > 1)


def duplicate_content(manifest: DataFrame, hash_col: str = "content_hash") -> DataFrame:
    """V6 (content): one content hash under more than one file. The count is
    a combinable aggregate, so a hash shared by millions of files is summed
    map-side before the shuffle."""
    return manifest.groupBy(hash_col).agg(F.count(F.lit(1)).alias("n_copies"),
                                          F.countDistinct("dataset").alias("n_datasets")) \
                   .filter(F.col("n_copies") > 1)


def file_counts(manifest: DataFrame, expected_datasets: DataFrame | None = None,
                expected: int = EXPECTED_FILES_PER_DATASET) -> DataFrame:
    """V1: files per dataset with the expectation and a status from comparing
    them (an empty dataset reports 0 and ``failure``)."""
    counts = manifest.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_files"))
    if expected_datasets is not None:
        counts = expected_datasets.select("dataset").distinct().join(counts, "dataset", "left") \
            .withColumn("n_files", F.coalesce(F.col("n_files"), F.lit(0)))
    return counts.withColumn("expected", F.lit(expected).cast("long")) \
                 .withColumn("status", F.when(F.col("n_files") == F.col("expected"), F.lit("success"))
                             .otherwise(F.lit("failure")))


def empty_datasets(expected_datasets: DataFrame, manifest: DataFrame) -> DataFrame:
    """V3: expected datasets with no file at all. The manifest side is
    reduced to its distinct datasets first (map-side), so a listing of
    millions of files shuffles one row per dataset and task."""
    present = manifest.select("dataset").distinct()
    return expected_datasets.select("dataset").distinct().join(present, "dataset", "left_anti")


def unreachable_row(spark: SparkSession, dataset: str, path: str, reason: str) -> DataFrame:
    """V2: a failure row for a folder that could not be listed."""
    return spark.createDataFrame([(dataset, None, path, "unreachable", reason)],
                                 "dataset string, name string, path string, check string, detail string")


def validate_manifest(manifest: DataFrame, as_of, expected_datasets: DataFrame | None = None,
                      min_kb: float = MIN_FILE_KB, max_days: int = MAX_FILE_AGE_DAYS) -> DataFrame:
    """Every failure of V3-V6 as rows ``dataset, name, path, check, detail``."""
    small = small_files(manifest, min_kb).select(
        "dataset", "name", "path", F.lit("small_file").alias("check"),
        F.format_string("%.2f KB < %s KB", F.col("size_kb"), F.lit(str(min_kb))).alias("detail"))
    stale = stale_files(manifest, as_of, max_days).select(
        "dataset", "name", "path", F.lit("stale_file").alias("check"),
        F.format_string("%d days > %d", F.col("age_days"), F.lit(max_days)).alias("detail"))
    dups = duplicate_names(manifest).select(
        "dataset", "name", F.lit(None).cast("string").alias("path"), F.lit("duplicate_name").alias("check"),
        F.format_string("%d copies", F.col("n_copies")).alias("detail"))
    out = small.unionByName(stale).unionByName(dups)
    if expected_datasets is not None:
        empty = empty_datasets(expected_datasets, manifest).select(
            "dataset", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("path"),
            F.lit("empty_dataset").alias("check"), F.lit("no files").alias("detail"))
        out = out.unionByName(empty)
    return out


class GateError(RuntimeError):
    """Raised by :func:`gate`; ``failures`` holds the rows named in the
    message, ``n_failures`` counts all."""

    def __init__(self, message: str, failures: list, n_failures: int):
        super().__init__(message)
        self.failures, self.n_failures = failures, n_failures


def gate(failures: DataFrame, report: str | None = None, max_shown: int = 20) -> bool:
    """V7: True when there is no failure row; otherwise raise before any
    stream starts. Every failure is written under ``report`` (JSON lines) if
    it is given; the message has their number and names the first few."""
    if report is not None:
        failures.write.mode("errorifexists").json(report)
        failures = failures.sparkSession.read.schema(failures.schema).json(report)
    n = failures.count()
    if not n:
        return True
    shown = failures.orderBy("check", "dataset", "name", "path").limit(max_shown).collect()
    lines = [f"{r['check']}: {r['dataset']}/{r['name'] or ''} {r['detail'] or ''}".strip() for r in shown]
    where = f", all in {report}" if report else ""
    raise GateError(f"source file validation failed: {n} failures{where}; first {len(shown)}:\n" + "\n".join(lines), shown, n)
