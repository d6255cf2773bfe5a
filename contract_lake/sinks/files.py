"""File sinks: JSON-lines appends for logs and metrics (K3, K4) and
changeset documents (K5).

Many records go into each file (one file per task), instead of one file per
record. Output folders are time-stamped per write (O6) so two writes never
overwrite each other.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamped_name(prefix: str, now: datetime | None = None) -> str:
    """``<prefix>_YYYYmmdd_HHMMSS_ffffff`` in UTC."""
    now = now or datetime.now(timezone.utc)
    return f"{prefix}_{now.strftime('%Y%m%d_%H%M%S_%f')}"


def append_jsonl(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows as JSON lines under ``path``."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def _by_date(df: DataFrame) -> DataFrame:
    # the records' ISO timestamp text starts with the date
    return df.withColumn("date", F.substring("timestamp", 1, 10))


def write_metrics(df: DataFrame, path: str) -> None:
    """K3: append metric rows (see ``observe.metric_rows``) under
    ``date=YYYY-MM-DD`` folders."""
    append_jsonl(_by_date(df), path, partition_by=["date"])


def write_log_rows(df: DataFrame, path: str) -> None:
    """K4: append log rows (see ``observe.log_rows``) under
    ``date=YYYY-MM-DD`` folders."""
    append_jsonl(_by_date(df), path, partition_by=["date"])


def write_changeset(docs: DataFrame, folder: str, prefix: str = "changeset",
                    now: datetime | None = None, file_bytes: int = 16 << 20) -> str:
    """K5: write tagged documents (one JSON document per line) into a new
    time-stamped folder under ``folder``; returns that folder. A reader that
    takes files whole holds one in memory, so a file is kept to about
    ``file_bytes`` (at least one document) by the size of the largest."""
    target = f"{folder.rstrip('/')}/{stamped_name(prefix, now)}"
    largest = docs.agg(F.max(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 1
    docs.write.mode("errorifexists").option("maxRecordsPerFile", max(1, file_bytes // largest)).json(target)
    return target
