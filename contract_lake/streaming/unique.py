"""Q5 ``unique`` inside the stream: keys that occur more than once, over all
micro-batches and restarts.

A streaming count per key is the state: how often a key was seen and the least
value of an order column among its rows (its first occurrence). It lives in the
RocksDB state store under the query's checkpoint, so it is larger than memory
without harm, survives restarts and is re-made from the last commit when a
batch is replayed. Counts combine before the shuffle, so a key that fills a
third of a batch costs one row a task. A batch writes the repeated keys that it
changed to a folder of its own, which a replay overwrites.

State grows with the number of distinct keys: a key may come back at any time,
so none is ever forgotten. Rows with a NULL in a key are not compared (as in
``quality.unique_failures``). Nothing but the keys, the count and the order
column reaches the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

COPIES, FIRST, BATCH = "n_copies", "first_seen", "_batch"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def track_unique(rows: DataFrame, keys: list[str], order_by: str, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Follow the stream ``rows`` and keep, under ``out``, the keys seen more
    than once (see ``read_repeated``). ``order_by`` says which occurrence is
    the first. Start it again with the same ``checkpoint`` to go on."""
    spark = rows.sparkSession
    known = rows.select(*keys, F.col(order_by).alias(FIRST)).dropna(subset=list(keys))
    seen = known.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES), F.min(FIRST).alias(FIRST))

    def keep(changed: DataFrame, batch: int) -> None:
        changed.filter(F.col(COPIES) > 1).write.mode("overwrite").parquet(f"{out}/{BATCH}={batch}")

    writer = seen.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"availableNow": True}))
    # A query takes the session's settings as they are when it starts; the caller's own stay.
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def read_repeated(spark: SparkSession, keys: list[str], out: str) -> DataFrame:
    """One row per key seen more than once: the keys, ``n_copies`` and
    ``first_seen``. Batches say more and more of a key; the last word counts."""
    return spark.read.parquet(out).groupBy(*keys).agg(F.max(COPIES).alias(COPIES), F.min(FIRST).alias(FIRST))


def repeated_rows(rows: DataFrame, repeated: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """Rows (of the landing log, say) whose key is among ``repeated``, with
    ``is_first``: whether the row is its key's first occurrence."""
    found = rows.join(repeated.select(*keys, FIRST), keys)
    return found.withColumn("is_first", F.col(order_by).eqNullSafe(F.col(FIRST))).select(*rows.columns, "is_first")
