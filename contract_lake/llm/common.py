"""Helpers shared by the training-data operators: shared-folder tables, views
of Arrow text, group streams over sorted partitions, connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract_lake.session import work_dir


_shipped: set[str] = set()
#: Rows of an Arrow batch, unless the session says otherwise: 10,000 long texts
#: (Spark's default) take a task hundreds of MB on either side.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
DEFAULT_ROWS, FEWER_ROWS = "10000", "2000"


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors' Python, once an
    application (what ``--py-files`` does by hand); and let Arrow batches hold
    fewer rows than Spark's default, if that is what is set."""
    if spark.conf.get(BATCH_ROWS) == DEFAULT_ROWS:
        spark.conf.set(BATCH_ROWS, FEWER_ROWS)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="contract-lake-code-"), "contract_lake_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage
    cut, safe from the loss of an executor."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_views(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text of an Arrow string column, without a copy
    (null: empty)."""
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or data is None:
        for _ in range(len(column)):
            yield np.empty(0, np.uint8)
        return
    at = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1]
    octets = np.frombuffer(data, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        yield octets[at[i]:at[i + 1]] if valid is None or valid[i] else octets[:0]


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The groups of a partition sorted by ``key`` (a non-null integer
    column), one Arrow table each; a group may span input batches. Memory is
    one batch plus one group, so callers bound their groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(keys)) + 1
        if held and held[0].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for cut in cuts:
            held.append(batch.slice(start, cut - start))
            yield pa.Table.from_batches(held)
            held, start = [], cut
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node joined to it) that connect what the pairs
    (a, b) connect: fewer than there are nodes, however many the pairs."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        np.minimum.at(label, x, label[y])
        np.minimum.at(label, y, label[x])
        label = label[label]
        if np.array_equal(label, before):
            break
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node named by ``edges`` (columns a, b, of one
    sortable type); root is the smallest node reachable.

    Contraction: every node points to its smallest neighbour (a combinable
    ``min``), pointers are followed to their end by doubling, edges are
    renamed to the ends and those inside one end leave. A component at least
    halves its nodes each round, a star of any size ends in one. No list of
    neighbours is gathered anywhere; each round is a written table.
    """
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), name)
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = None
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = written(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                         .select("node", F.least("node", "least").alias("root")), name)
        while True:
            jump = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
            hopped = written(points.join(jump, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), name)
            points = hopped.select("node", "root")
            if hopped.where("moved").isEmpty():
                break
        labels = points if labels is None else written(
            labels.join(points.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
            .select("node", F.coalesce("next", "root").alias("root")), name)
        for end in ("a", "b"):
            edges = (edges.join(points.select(F.col("node").alias(end), "root"), end)
                     .select(F.col("root").alias(end), "b" if end == "a" else "a"))
        edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), name)
    return nodes.withColumn("root", F.col("node")) if labels is None else labels
