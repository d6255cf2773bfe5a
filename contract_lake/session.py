"""Session construction and the shared work folder.

Everything the library writes outside a user-given path (fixture documents,
stream checkpoints, landing logs made by the registered queries) goes under
the folder the cluster names in ``spark.checkpoint.dir``. That folder is shared
by all executors, so a lost executor never takes written data with it. Only
when the setting is missing on a ``local`` master (tests, laptops) do we make
one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "contract-lake", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    AQE is on so that shuffle partition counts and join strategies are
    re-planned from runtime sizes; the session time zone is UTC because every
    time rule of the gate and the logs is stated in UTC.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, set for local runs only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            # getCheckpointDir() appends an application folder; use its parent.
            root = current.rstrip("/").rsplit("/", 1)[0]
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster run needs a shared folder "
                "(for example an object-store path) for checkpoints and work tables")
        root = tempfile.mkdtemp(prefix="contract-lake-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path (not yet created, never reused) under the shared root for
    one run of ``name``; Spark's writers create it."""
    return f"{shared_root(spark)}/contract_lake/{name}-{uuid.uuid4().hex[:12]}"
