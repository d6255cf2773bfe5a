"""Bucketed table sink: co-locate rows by key so later per-key work (SCD
Type 2 windows, joins on the key) reads pre-partitioned data with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hashable


def bucket_id(keys: list[str], n_buckets: int):
    """The bucket Spark's bucketed writer gives a row: Murmur3 ``hash`` of
    the keys modulo ``n_buckets``."""
    return F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(n_buckets))


def write_bucketed(df: DataFrame, table: str, keys: list[str], n_buckets: int,
                   path: str | None = None, sort_by: list[str] | None = None,
                   partition_by: list[str] | None = None, n_files: int | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed (and sorted) by ``keys`` and return it
    read back through the catalog, which is what lets the planner use the
    bucketing. ``path`` keeps the data in the shared folder (external table).

    Rows are first range-partitioned on (bucket, sort columns, row hash)
    into ``n_files`` tasks (default ``n_buckets``): each task then writes one
    or a few adjacent buckets, so the table has about ``n_files +
    n_buckets`` files instead of one per bucket and task, and the range
    partitioner's sample splits a hot bucket, even one holding a single hot
    key and sequence value, over as many tasks as its size asks for.

    Choose ``n_buckets`` so one bucket is a comfortable task (for example
    total size / 256 MB); keep it fixed for a table, since readers and joins
    rely on it.
    """
    order = sort_by or keys
    spread = F.xxhash64(*[F.col(f.name) for f in df.schema.fields if hashable(f.dataType)])
    laid = df.repartitionByRange(n_files or n_buckets, bucket_id(keys, n_buckets),
                                 *[F.col(c) for c in order], spread)
    writer = laid.write.mode("overwrite").bucketBy(n_buckets, *keys).sortBy(*order)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
