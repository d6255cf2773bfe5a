"""Logs, metrics and pipeline events as rows.

Instead of one tiny file per event written from the driver, log and metric
records are DataFrame rows with a fixed schema, appended in bulk (many rows
per file) and read back with the same schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import LOG_LEVELS, iso_utc, normalize_level, severity

LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("logger", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("notebook", T.StringType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("task_id", T.StringType()),
])

METRIC_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("metric_type", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("expected", T.LongType()),
    T.StructField("unit", T.StringType()),
    T.StructField("dimensions", T.MapType(T.StringType(), T.StringType())),
    T.StructField("notebook", T.StringType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("task_id", T.StringType()),
])

# The pipeline event type that produces a message, and the
# message text around the event type and the state.
PROGRESS_EVENT = "update_progress"
MESSAGE_TYPE_LABEL = "event type: "
MESSAGE_STATE_LABEL = " state: "


def _c(v, default=None) -> Column:
    if v is None:
        return F.lit(default).cast("string") if default is None else F.lit(default)
    if isinstance(v, Column):
        return v
    return F.lit(v)


def run_id(parent_run_id=None, own_run_id=None) -> Column:
    """The parent (multi-task) run id when present, else the run's own."""
    return F.coalesce(_c(parent_run_id), _c(own_run_id)).cast("string")


def log_rows(df: DataFrame, level, message, logger, notebook, ts,
             job_id=None, run_id_col=None, task_id=None) -> DataFrame:
    """O1: rows in the log schema; ``timestamp`` is UTC ISO text of ``ts``."""
    ts_col = F.col(ts) if isinstance(ts, str) and ts in df.columns else _c(ts)
    return df.select(
        iso_utc(ts_col).alias("timestamp"),
        F.upper(_c(level)).cast("string").alias("level"),
        _c(logger).cast("string").alias("logger"),
        _c(message).cast("string").alias("message"),
        _c(notebook).cast("string").alias("notebook"),
        _c(job_id).cast("string").alias("job_id"),
        _c(run_id_col).cast("string").alias("run_id"),
        _c(task_id).cast("string").alias("task_id"),
    )


def metric_rows(df: DataFrame, metric_type, metric_name, value, expected=None,
                unit=None, dimensions: Column | dict | None = None, notebook=None, ts=None,
                job_id=None, run_id_col=None, task_id=None) -> DataFrame:
    """O2: rows in the metric schema; ``value`` as double, ``unit`` defaults
    to ``Count``, ``dimensions`` to an empty map."""
    if isinstance(dimensions, dict):
        items = []
        for k, v in dimensions.items():
            items += [F.lit(k), _c(v).cast("string")]
        dims = F.create_map(*items) if items else None
    else:
        dims = dimensions
    empty = F.create_map().cast("map<string,string>")
    ts_col = F.current_timestamp() if ts is None else (
        F.col(ts) if isinstance(ts, str) and ts in df.columns else _c(ts))
    return df.select(
        iso_utc(ts_col).alias("timestamp"),
        _c(metric_type).cast("string").alias("metric_type"),
        _c(metric_name).cast("string").alias("metric_name"),
        _c(value).cast("double").alias("value"),
        _c(expected).cast("long").alias("expected"),
        F.coalesce(_c(unit).cast("string"), F.lit("Count")).alias("unit"),
        (F.coalesce(dims, empty) if dims is not None else empty).alias("dimensions"),
        _c(notebook).cast("string").alias("notebook"),
        _c(job_id).cast("string").alias("job_id"),
        _c(run_id_col).cast("string").alias("run_id"),
        _c(task_id).cast("string").alias("task_id"),
    )


def sorted_by_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """O3: all columns, oldest first (a range-partitioned global sort).

    A unique tiebreaker follows the time so that the range partitioner can
    split records sharing one timestamp over several tasks; the order among
    equal times is unspecified either way."""
    return df.select("*").withColumn("_tie", F.monotonically_increasing_id()) \
             .orderBy(F.col(col).asc(), F.col("_tie")).drop("_tie")


def at_level(df: DataFrame, level: str | None, level_col: str = "level") -> DataFrame:
    """Records at or above ``level``; an empty or unknown level is INFO.
    Records with an unknown level name are dropped."""
    threshold = LOG_LEVELS[normalize_level(level)]
    return df.filter(severity(level_col) >= F.lit(threshold))


def event_messages(events: DataFrame, type_col: str = "event_type",
                   details_col: str = "details") -> DataFrame:
    """The notification text for progress events only.

    ``details`` may be a struct or JSON text; the state is
    ``details.update_progress.state`` (empty when absent).
    """
    dtype = events.schema[details_col].dataType
    if isinstance(dtype, T.StringType):
        state = F.get_json_object(F.col(details_col), "$.update_progress.state")
    else:
        state = F.col(f"{details_col}.update_progress.state")
    text = F.concat(F.lit(MESSAGE_TYPE_LABEL), F.col(type_col), F.lit(MESSAGE_STATE_LABEL),
                    F.coalesce(state, F.lit("")))
    return events.filter(F.col(type_col) == F.lit(PROGRESS_EVENT)).withColumn("message", text)
