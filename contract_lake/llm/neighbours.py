"""Embedding near-duplicates by randomised-rotation binary codes.

Each vector is scaled to length one and rotated by a seeded random rotation;
its code is the signs, its stored correction factor the inner product of the
rotated vector with its code (scaled to length one). Then code . rotated other
vector / factor is an unbiased estimate of the cosine, with a known spread:
``spread * sqrt((1 - f^2) / f^2) / sqrt(dim - 1)`` bounds its error with
confidence. Pairs whose upper bound reaches the threshold are recomputed
exactly in double precision; only those at or above it are links.

Which pairs are looked at: sign bits of further rotations are cut into bands,
and vectors that share a band meet. A pair at cosine c shares a sign with
probability 1 - acos(c) / pi, so bands of ``bits`` signs find it with
probability 1 - (1 - p**bits)**bands; ``bits`` follows the number of vectors
(groups stay small) and ``bands`` is what brings that probability to
``recall`` at the threshold itself (closer pairs are found more surely). A
pair that shares several bands counts in the first only.

Equal vectors are compared once, weighted by their number. A band held by many
vectors is cut into pairs of blocks that spread over tasks; a task returns
counts by vector and links that span what it found, never the pairs.

Vectors that are NULL, zero, or hold NULL or non-finite components link with
nothing (component of their own), and so do rows without a vec_id (NULL
component, not kept). Vectors of different dimension never link. Repeated rows
count as vectors of their own. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map, batch_of, connected_components, sorted_groups, spanning_links, written

SPREAD = 4.0
STRIP, PAIRS = 128, 1 << 16

_rotations: dict[tuple[int, int], np.ndarray] = {}


def rotation(dim: int, number: int) -> np.ndarray:
    """A seeded random rotation: the orthogonal part of a Gaussian matrix."""
    if (dim, number) not in _rotations:
        q, r = np.linalg.qr(np.random.default_rng([dim, number]).standard_normal((dim, dim)))
        _rotations[dim, number] = q * np.sign(np.diag(r))
    return _rotations[dim, number]


def band_numbers(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits, bands) for ``n`` vectors."""
    bits = min(30, max(8, math.ceil(math.log2(max(n, 2) / 16))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def bands_of(unit: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """The band values (rows x bands) of unit vectors."""
    dim = unit.shape[1]
    signs = np.concatenate([unit @ rotation(dim, 1 + k) > 0 for k in range(-(-bits * bands // dim))], axis=1)[:, :bits * bands]
    return signs.reshape(len(unit), bands, bits) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def unit_vectors(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, scaled to length one."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])  # no square under- or overflows
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def estimate(signs: np.ndarray, factor: np.ndarray, rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of coded vectors with rotated ones, and the half
    width of the confidence bound for each coded vector."""
    dim = signs.shape[1]
    cosine = (signs @ rotated.T) / (math.sqrt(dim) * factor)[:, None]
    width = SPREAD * np.sqrt(np.maximum(0, 1 - factor ** 2)) / factor / math.sqrt(max(1, dim - 1))
    return cosine, width


def links_between(unit: np.ndarray, signs: np.ndarray, factor: np.ndarray, other: np.ndarray, threshold: float,
                  same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine at least ``threshold``; ``same``: both sides
    are one list, each pair once."""
    rotated = other @ rotation(unit.shape[1], 0)
    for at in range(0, len(unit), STRIP):
        cosine, width = estimate(signs[at:at + STRIP], factor[at:at + STRIP], rotated)
        i, j = np.nonzero(cosine + width[:, None] >= threshold)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), PAIRS):
            a, b = i[k:k + PAIRS], j[k:k + PAIRS]
            exact = np.einsum("ij,ij->i", unit[a], other[b]) >= threshold
            yield a[exact], b[exact]


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.95, cell: int = 1024) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row."""
    # float components are shipped as such and computed with as doubles
    kind = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    value = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    fit = (F.col("vec_id").isNotNull() & F.coalesce(F.forall("embedding", value), F.lit(False))
           & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False)))
    distinct = written(rows.where(fit).groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "vectors-distinct")
    n = distinct.count()
    bits, bands = band_numbers(n, threshold, recall)

    real = pa.float32() if kind == "float" else pa.float64()
    coded = pa.schema([("band", pa.int64()), ("number", pa.int32()), ("rep", pa.int64()), ("weight", pa.int64()), ("embedding", pa.list_(real)),
                       ("signs", pa.binary()), ("factor", pa.float64()), ("values", pa.list_(pa.int32()))])

    def by_dimension(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            dims = np.diff(batch.column("embedding").offsets.to_numpy())
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                yield int(dim), part, unit_vectors(part.column("embedding"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part, unit in by_dimension(batches):
            turned = unit @ rotation(dim, 0)
            factor = np.abs(turned).sum(axis=1) / math.sqrt(dim)
            values = bands_of(unit, bits, bands)
            packed = pa.array([s.tobytes() for s in np.packbits(turned > 0, axis=1)], pa.binary())
            lists = pa.array(list(values.astype(np.int32)), pa.list_(pa.int32()))
            for k in range(bands):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[:, k] * 1024 + dim % 1024), pa.array(np.full(len(unit), k, np.int32)), part.column("rep"), part.column("weight"),
                     part.column("embedding").cast(pa.list_(real)), packed, pa.array(factor), lists], schema=coded)

    def bare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, _, unit in by_dimension(batches):
            values = bands_of(unit, bits, bands)
            for k in range(bands):
                yield batch_of(pa.schema(list(coded)[:2]), values[:, k] * 1024 + dim % 1024, np.full(len(unit), k, np.int32))

    held = arrow_map(distinct, code, f"band long, number int, rep long, weight long, embedding array<{kind}>, signs binary, factor double, values array<int>")
    # Bands of many vectors are cut into blocks; each pair of blocks is a cell.
    cuts = (arrow_map(distinct.select("embedding"), bare, "band long, number int").groupBy("band", "number")
            .agg(F.ceil(F.count("*") / cell).alias("blocks"), F.count("*").alias("size")).where("size > 1").drop("size"))
    cells = (held.join(cuts, ["band", "number"])
             .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
             .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("cell", F.xxhash64("band", "number", F.least("block", "with"), F.greatest("block", "with")))
             .withColumn("side", F.when(F.col("block") == F.col("with"), 0).when(F.col("block") < F.col("with"), 1).otherwise(2))
             .select("cell", "side", "number", "rep", "weight", "embedding", "signs", "factor", "values"))
    result = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "cell"):
            if group.num_rows < 2:
                continue
            side = group.column("side").to_numpy()
            number = group.column("number")[0].as_py()
            rep, weight = group.column("rep").to_numpy(), group.column("weight").to_numpy()
            dims = np.diff(group.column("embedding").combine_chunks().offsets.to_numpy())
            for dim in np.unique(dims):
                same = not side.any()
                left = np.flatnonzero((side <= 1) & (dims == dim))
                right = left if same else np.flatnonzero((side == 2) & (dims == dim))
                if not len(left) or not len(right):
                    continue
                take = lambda rows: unit_vectors(group.column("embedding").take(pa.array(rows)))  # noqa: B023, E731
                unit = take(left)
                other = unit if same else take(right)
                signs = np.unpackbits(np.stack([np.frombuffer(s, np.uint8) for s in group.column("signs").take(pa.array(left)).to_pylist()]),
                                      axis=1, count=int(dim)).astype(np.float64) * 2 - 1
                values = np.stack(group.column("values").to_numpy())
                found, spans = np.zeros(group.num_rows, np.int64), []
                for i, j in links_between(unit, signs, group.column("factor").to_numpy()[left], other, threshold, same):
                    i, j = left[i], right[j]
                    if number:  # a pair that met in an earlier band counted there
                        fresh = ~(values[i, :number] == values[j, :number]).any(axis=1)
                        i, j = i[fresh], j[fresh]
                    if len(i):
                        found += np.bincount(i, weight[j], group.num_rows).astype(np.int64) + np.bincount(j, weight[i], group.num_rows).astype(np.int64)
                        spans.append(spanning_links(rep[i], rep[j]))
                some = np.flatnonzero(found)
                if len(some):
                    a, b = spanning_links(np.concatenate([s[0] for s in spans]), np.concatenate([s[1] for s in spans]))
                    yield batch_of(result, np.concatenate([rep[some], a]), pa.array([None] * len(some) + b.tolist(), pa.int64()),
                                   np.concatenate([found[some], np.zeros(len(a), np.int64)]))

    links = written(arrow_map(cells.repartition("cell").sortWithinPartitions("cell"), compare, "a long, b long, n long"), "vectors-links")
    roots = connected_components(links.where("b is not null").select("a", "b"), "vectors-cc")
    counted = links.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    classes = (distinct.join(counted, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
               .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id")))
    out = rows.where(fit).join(classes, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
