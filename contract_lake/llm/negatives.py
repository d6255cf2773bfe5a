"""Hard-negative mining with exact integer scores from Kronecker-packed products.

A component x becomes floor(scale * x); a score is the integer inner product of
two rows. Candidates' components are made non-negative by a bias and several
candidates are laid side by side in separated fields of one wide integer, each
field wide enough for a whole sum of products. One multiplication of the wide
integer with an (equally biased) anchor component serves all its candidates;
after all components are added up the fields are cut out and the biases taken
off, which leaves the exact scores. Fields that fit a 64-bit word go there;
rows with larger components (over 2^20 after scaling) go by Python's whole
numbers of any width, so nothing overflows. A score beyond a long's range
counts as the nearest end of it.

*Positives*: an anchor's ``positives`` best other rows of its label. *Negatives*:
for each anchor and positive the ``negatives`` best rows of another label whose
score lies between ``low`` and ``high`` hundredths of the positive's, both ends
included. Higher scores come first, ties by smaller vec_id.

*Plan.* Anchors are dealt to blocks of about ``anchor_block``, all rows to
chunks of about ``chunk``; each block meets each chunk in one task (a stated
query set against all rows), which holds the block and streams the chunk, and
passes on only what may still be among the best: a few rows an anchor and
chunk. The first round finds positives, the second their negatives.

Rows with a NULL vec_id or label, or a vector that is NULL, empty or holds NULL
or non-finite components take no part. Vectors of different dimension do not
meet. Rows equal in all of vec_id, label and vector count once; of different
rows with one vec_id each is a candidate and, if it is one, an anchor, but none
for an anchor of the same vec_id. An anchor without positives or negatives has
no rows; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map, batch_of, written

SMALL = 1 << 20
#: Candidates in one Python integer, where 64 bits do not do.
WIDE = 64
#: Rows a task scores at a time.
ROWS = 512
ENDS = np.iinfo(np.int64)


def packed_products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """The inner products of the rows of two integer arrays (of numpy or
    Python integers), exact, as a matrix of the same kind."""
    (m, dim), n = anchors.shape, len(candidates)
    if not m or not n:
        return np.zeros((m, n), anchors.dtype)
    low_a, low_c = int(anchors.min()), int(candidates.min())
    a, c = anchors - low_a, candidates - low_c
    width = max(1, (dim * int(a.max()) * int(c.max())).bit_length())
    if anchors.dtype == object or candidates.dtype == object or width > 62:
        kind, fields = object, WIDE
    else:
        kind, fields = np.uint64, 64 // width
    wide = np.zeros((-(-n // fields), dim), kind)
    for k in range(fields):
        part = c[k::fields].astype(kind)
        wide[:len(part)] += part << (k * width if kind is object else np.uint64(k * width))
    sums = a.astype(kind) @ wide.T
    mask = (1 << width) - 1
    out = np.empty((m, n), object if kind is object else np.int64)
    for k in range(fields):
        columns = out[:, k::fields]
        if kind is object:
            columns[:] = sums[:, :columns.shape[1]] >> k * width & mask
        else:
            columns[:] = (sums[:, :columns.shape[1]] >> np.uint64(k * width) & np.uint64(mask)).astype(np.int64)
    # sum of (a - la)(c - lc) = score - lc * sum(a) - la * sum(c) + dim * la * lc
    total_a, total_c = (x.astype(object if kind is object else np.int64).sum(axis=1) for x in (anchors, candidates))
    return out + low_c * total_a[:, None] + low_a * total_c[None, :] - dim * low_a * low_c


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of a float64 array as int64; as Python integers where
    a component leaves the range of small ones."""
    v = np.floor(np.clip(scale * x, -np.finfo(np.float64).max, np.finfo(np.float64).max))
    if not v.size or np.abs(v).max() <= SMALL:
        return v.astype(np.int64)
    return np.array([int(y) for y in v.ravel()], object).reshape(v.shape)


def scores(anchors: np.ndarray, candidates: np.ndarray, scale: int) -> np.ndarray:
    """All scores of two float64 arrays; large rows apart, so that they slow
    down no others."""
    out = np.empty((len(anchors), len(candidates)), np.int64)
    large = [(np.abs(scale * x).max(axis=1, initial=0) > SMALL) for x in (anchors, candidates)]
    for rows in (np.flatnonzero(large[0]), np.flatnonzero(~large[0])):
        for columns in (np.flatnonzero(large[1]), np.flatnonzero(~large[1])):
            if len(rows) and len(columns):
                found = packed_products(scaled(anchors[rows], scale), scaled(candidates[columns], scale))
                if found.dtype == object:
                    found = np.clip(found, ENDS.min, ENDS.max).astype(np.int64)
                out[np.ix_(rows, columns)] = found
    return out


class Best:
    """The best ``k`` (score, id) of each of ``n`` lists, fed piece by piece."""

    def __init__(self, n: int, k: int):
        self.k, self.least = k, np.full(n, ENDS.min)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """One row of ``score`` and ``allowed`` for each list, one column for
        each of ``ids``."""
        allowed = allowed & (score >= self.least[:, None])
        if score.shape[1] > self.k:
            # what is worse than k others of this piece is out
            kth = np.partition(np.where(allowed, score, ENDS.min), -self.k, axis=1)[:, -self.k]
            self.least = np.maximum(self.least, kth)
            allowed &= score >= self.least[:, None]
        at, column = np.nonzero(allowed)
        self.parts.append((at, score[at, column], ids[column]))
        self.held += len(at)
        if self.held > max(1 << 18, 4 * self.k * len(self.least)):
            self.parts = [self.result()]
            self.held = len(self.parts[0][0])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, score, id), sorted."""
        at, score, ids = (np.concatenate(x) for x in zip(*self.parts, strict=True)) if self.parts else (np.zeros(0, np.int64),) * 3
        # ~score grows as the score falls and never overflows
        order = np.lexsort((ids, ~score, at))
        at, score, ids = at[order], score[order], ids[order]
        start = np.searchsorted(at, at, side="left")
        keep = np.arange(len(at)) - start < self.k
        full = np.flatnonzero(np.bincount(at[keep], minlength=len(self.least)) == self.k)
        last = np.searchsorted(at, full, side="left") + self.k - 1
        self.least[full] = np.maximum(self.least[full], score[last])
        return at[keep], score[keep], ids[keep]


def taking_part(vectors: DataFrame, label: Column) -> DataFrame:
    """``vec_id``, ``label``, ``x``, once each, of the rows that take part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    whole = F.coalesce(F.forall("x", fine) & (F.size("x") > 0), F.lit(False))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole).distinct()


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


FOUND = pa.schema([("anchor", pa.int64()), ("positive", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _met(anchors: DataFrame, rows: DataFrame, n_blocks: int, n_chunks: int, scale: int, k: int, same_label: bool) -> DataFrame:
    """(anchor, positive, vec_id, score): of each anchor row (``anchor``, a
    number of its own, ``vec_id``, ``label``, ``x``, and lists ``positive``,
    ``low``, ``high`` of equal length) and each entry of its lists, the best k
    of each chunk of ``rows`` with a score from low to high and the same or
    another label."""
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(n_blocks)).cast("int")).withColumn("chunk", spread(n_chunks))
    given = rows.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(n_chunks)).cast("int")).withColumn("block", spread(n_blocks))
    both = asked.unionByName(given, allowMissingColumns=True).withColumn("cell", F.col("block").cast("long") * n_chunks + F.col("chunk")).withColumn(
        "dim", F.size("x")).select("cell", "dim", "anchor", "vec_id", "label", "x", "positive", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = held = None
        parts: list[pa.RecordBatch] = []

        def finished() -> Iterator[pa.RecordBatch]:
            if held is not None:
                at, score, ids = held["best"].result()
                if len(at):
                    yield batch_of(FOUND, held["anchor"][at], held["positive"][at], ids, score)

        def meet(batch: pa.RecordBatch) -> None:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
            found = scores(held["x"], _matrix(batch.column("x")), scale)
            fits = (held["label"][:, None] == labels[None, :]) == same_label
            fits &= held["vec_id"][:, None] != ids[None, :]
            found, fits = found[held["owner"]], fits[held["owner"]]
            held["best"].add(found, fits & (found >= held["low"][:, None]) & (found <= held["high"][:, None]), ids)

        for whole in batches:
            cells, dims = whole.column("cell").to_numpy(), whole.column("dim").to_numpy()
            is_anchor = whole.column("anchor").is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(cells) != 0) | (np.diff(dims) != 0) | (np.diff(is_anchor.astype(np.int8)) != 0)) + 1
            for start, end in zip([0, *edges], [*edges, len(cells)]):
                if start == end:
                    continue
                part = whole.slice(start, end - start)
                if (cells[start], dims[start]) != here:
                    yield from finished()
                    here, held, parts = (cells[start], dims[start]), None, []
                if is_anchor[start]:
                    parts.append(part)
                    continue
                if held is None and parts:
                    block = pa.Table.from_batches(parts)
                    lists = block.column("positive").combine_chunks()
                    owner = np.repeat(np.arange(len(block)), lists.value_lengths().to_numpy())
                    flat = {c: block.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("positive", "low", "high")}
                    held = flat | {"x": _matrix(block.column("x")), "owner": owner, "anchor": block.column("anchor").to_numpy()[owner],
                                   "vec_id": block.column("vec_id").to_numpy(), "label": block.column("label").to_numpy(), "best": Best(len(owner), k)}
                if held is not None and len(held["owner"]):
                    for at in range(0, part.num_rows, ROWS):
                        meet(part.slice(at, ROWS))
        yield from finished()

    dealt = both.repartition("cell").sortWithinPartitions("cell", "dim", F.col("anchor").asc_nulls_last())
    return arrow_map(dealt, run, "anchor long, positive long, vec_id long, score long")


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column | str = "label", scale: int = 256, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, anchor_block: int = 2048, chunk: int = 1 << 16) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``. ``is_anchor`` is over ``vec_id``,
    ``label`` over the columns of ``vectors``."""
    rows = written(taking_part(vectors, F.col(label) if isinstance(label, str) else label), "negatives-rows")
    numbered = written(rows.where(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "negatives-anchors")
    n_blocks, n_chunks = (max(1, -(-df.count() // size)) for df, size in ((numbered, anchor_block), (rows, chunk)))
    longs = lambda value: F.array(F.lit(value).cast("long"))
    asked = numbered.withColumns({"positive": longs(0), "low": longs(int(ENDS.min)), "high": longs(int(ENDS.max))})
    order = (F.desc("score"), F.asc("vec_id"))
    near = _met(asked, rows, n_blocks, n_chunks, scale, positives, True)
    near = written(near.withColumn("rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).where(F.col("rank") <= positives)
                   .select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").cast("long").alias("positive")),
                   "negatives-positives")
    # 100 * score between low * positive and high * positive, as bounds of the score (decimal: no overflow).
    share = lambda part: F.col("positive_score").cast("decimal(20,0)") * part / 100
    bounds = near.select("anchor", "positive", F.ceil(share(low)).cast("long").alias("low"), F.floor(share(high)).cast("long").alias("high"))
    lists = bounds.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("positive", "low", "high"))).alias("of"))  # at most `positives` entries
    again = numbered.join(lists, "anchor").select("anchor", "vec_id", "label", "x", *[F.col("of")[c].alias(c) for c in ("positive", "low", "high")])
    far = _met(again, rows, n_blocks, n_chunks, scale, negatives, False)
    far = (far.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*order))).where(F.col("rank") <= negatives)
           .select("anchor", "positive", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))
    named = near.join(numbered.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return far.join(named, ["anchor", "positive"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
