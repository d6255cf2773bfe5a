"""Records of one run: log lines and metrics, written in bulk as rows.

The run itself produces a handful of records (gate outcome, streams started,
per-entry counts), kept on the driver and written once per run with the log
and metric sinks; metrics computed by Spark (file counts, per-batch counts)
are written straight from their DataFrames. Settings come from the contract's
server block: ``log_name``, ``log_volume``, ``metric_volume``, ``log_level``.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.columns import LOG_LEVELS, normalize_level
from ..operators.observe import log_rows, metric_rows, run_id
from ..sinks.files import write_log_rows, write_metrics

# Fixed value: the logger name used when the contract names none.
DEFAULT_LOG_NAME = "pipeline_operations"


class RunLog:
    def __init__(self, spark: SparkSession, notebook: str, log_path: str | None = None,
                 metric_path: str | None = None, level: str | None = "INFO",
                 logger: str = DEFAULT_LOG_NAME, job_id: str | None = None,
                 run: str | None = None, parent_run: str | None = None, task_id: str | None = None):
        self.spark, self.notebook, self.logger = spark, notebook, logger
        self.log_path, self.metric_path = log_path, metric_path
        self.threshold = LOG_LEVELS[normalize_level(level)]
        self.ids = (job_id, parent_run or run, task_id)
        self.logs: list[tuple] = []
        self.metrics: list[tuple] = []

    @classmethod
    def from_contract(cls, spark: SparkSession, contract: Contract, notebook: str,
                      server: str = "development", **ids) -> "RunLog":
        cfg = contract.server(server)
        log_path = cfg.get("log_volume") or None
        metric_path = cfg.get("metric_volume") or (f"{log_path}/_metric" if log_path else None)
        return cls(spark, notebook, log_path, metric_path, cfg.get("log_level"),
                   cfg.get("log_name") or DEFAULT_LOG_NAME, **ids)

    def log(self, level: str, message: str) -> None:
        level = level.upper()
        if LOG_LEVELS.get(level, 0) >= self.threshold:
            self.logs.append((datetime.now(timezone.utc).replace(tzinfo=None), level, message))

    def info(self, message: str) -> None:
        self.log("INFO", message)

    def error(self, message: str) -> None:
        self.log("ERROR", message)

    def metric(self, metric_type: str, name: str, value: float, expected=None, unit: str = "Count",
               dimensions: dict[str, str] | None = None) -> None:
        self.metrics.append((datetime.now(timezone.utc).replace(tzinfo=None), metric_type, name,
                             float(value), expected, unit, dimensions or {}))

    def write_metric_rows(self, rows: DataFrame) -> None:
        """Metric rows computed by Spark (``observe.metric_rows``), written as they are."""
        if self.metric_path:
            write_metrics(rows, self.metric_path)

    def flush(self) -> None:
        job_id, run, task_id = self.ids
        if self.logs and self.log_path:
            base = self.spark.createDataFrame(self.logs, "ts timestamp_ntz, level string, message string")
            write_log_rows(log_rows(base, F.col("level"), F.col("message"), self.logger, self.notebook, "ts",
                                    job_id=job_id, run_id_col=run_id(None, run), task_id=task_id),
                           self.log_path)
        if self.metrics and self.metric_path:
            base = self.spark.createDataFrame(
                self.metrics, "ts timestamp_ntz, t string, n string, v double, e long, u string, "
                              "d map<string,string>")
            self.write_metric_rows(metric_rows(base, F.col("t"), F.col("n"), F.col("v"), F.col("e"),
                                               F.col("u"), F.col("d"), self.notebook, "ts",
                                               job_id, run_id(None, run), task_id))
        self.logs, self.metrics = [], []
