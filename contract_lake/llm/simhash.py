"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is cut into three blocks. Two fingerprints at most ``d``
bits apart are at most ``t = d // 3`` bits apart in one block. Each block is a
point of 23-bit space, which the perfect binary Golay code covers with radius
3: its 4,096 code words are the anchors. A point lies within 3 bits of exactly
one anchor, its home; every fingerprint is replicated to the anchors within
3 + t bits. If x and y are within t bits in a block, the home of x is within
3 + t of y, so comparing each anchor's home points with all points it holds
misses no pair.

Only distinct fingerprints are compared, so copies cost nothing. An anchor
holding many fingerprints is cut into cells of at most about ``cell`` homes by
``cell`` visitors, which spread over tasks; a cell emits links that span what
it found connected, never all pairs.

Null and empty texts have fingerprint zero; repeated rows come back once each.
A component of rows whose doc_id is NULL throughout has a NULL component_id.
Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map, batch_of, byte_views, connected_components, sorted_groups, spanning_links, written

#: Generator polynomial of the binary Golay code [23, 12], covering radius 3.
GOLAY = 0b110001110101
LENGTH, RADIUS, SEED = 23, 3, 42
#: (shift, bits) of the three blocks.
BLOCKS = ((0, 21), (21, 21), (42, 22))


def fingerprint(octets: bytes, words: int = 4) -> int:
    """64-bit SimHash of the shingles of ``words`` words, repeats included."""
    parts = octets.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    length = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(length + 1) - 1
    start = (end - length)[:len(parts) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(start, end[words - 1:].tolist(), strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id``, ``fp`` (signed long) and ``row_key`` for each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.fromiter((fingerprint(v.tobytes(), words) for v in byte_views(batch.column("text"))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(out.view(np.int64))], schema=schema)

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), row_key(docs)),
                     run, "doc_id long, row_key long, fp long")


def row_key(docs: DataFrame):
    """A hash of doc_id and text that names a row of ``docs``."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias("row_key")


@cache
def _cosets(reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bit syndromes; the error patterns of at most RADIUS + reach bits sorted
    by syndrome with the start of each syndrome's run; each syndrome's leader
    (its one pattern of at most RADIUS bits)."""
    bits = []
    for i in range(LENGTH):
        v = 1 << i
        for j in range(LENGTH - 1, 10, -1):
            if v >> j & 1:
                v ^= GOLAY << (j - 11)
        bits.append(v)
    patterns, syndromes = [], []
    for weight in range(RADIUS + reach + 1):
        for places in combinations(range(LENGTH), weight):
            e = s = 0
            for p in places:
                e, s = e | 1 << p, s ^ bits[p]
            patterns.append(e)
            syndromes.append(s)
    e, s = np.array(patterns, np.int64), np.array(syndromes, np.int64)
    order = np.argsort(s, kind="stable")
    leader = np.zeros(2048, np.int64)
    low = np.bitwise_count(e) <= RADIUS
    leader[s[low]] = e[low]
    return np.array(bits, np.int64), e[order], np.searchsorted(s[order], np.arange(2049)), leader


def anchors(fp: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor key, home?) for every anchor within RADIUS + reach bits of
    each fingerprint, block by block. A key is block and code word."""
    bits, patterns, start, leader = _cosets(reach)
    rows, keys, homes = [], [], []
    for block, (shift, size) in enumerate(BLOCKS):
        point = ((fp >> np.uint64(shift)) & np.uint64((1 << size) - 1)).astype(np.int64)
        syndrome = np.zeros(len(fp), np.int64)
        for i in range(size):
            syndrome ^= np.where(point >> i & 1, bits[i], 0)
        n = start[syndrome + 1] - start[syndrome]
        row = np.repeat(np.arange(len(fp)), n)
        within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        error = patterns[start[syndrome[row]] + within]
        rows.append(row)
        keys.append(block << LENGTH | point[row] ^ error)
        homes.append(error == leader[syndrome[row]])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def near_links(distinct: DataFrame, max_bits: int = 4, cell: int = 1024) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` at most
    ``max_bits`` apart."""
    if not 0 <= max_bits <= 11:
        raise ValueError("three Golay blocks serve distances of 0 to 11 bits")
    reach = max_bits // len(BLOCKS)
    replica = pa.schema([("anchor", pa.int32()), ("fp", pa.int64()), ("home", pa.bool_())])
    found = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            row, key, home = anchors(fp.view(np.uint64), reach)
            yield batch_of(replica, key.astype(np.int32), fp[row], home)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "cell_key"):
            fp, role = group.column("fp").to_numpy(), group.column("as_home").to_numpy()
            home, visitor = fp[role], fp[~role]
            if not len(home) or not len(visitor):
                continue
            a, b = [], []
            for at in range(0, len(home), 256):  # a strip of 256 homes at a time bounds memory
                near = np.bitwise_count((home[at:at + 256, None] ^ visitor[None, :]).view(np.uint64)) <= max_bits
                i, j = np.nonzero(near)
                other = home[at + i] != visitor[j]
                if other.any():
                    x, y = spanning_links(home[at + i[other]], visitor[j[other]])
                    a.append(x)
                    b.append(y)
            if a:
                yield batch_of(found, *spanning_links(np.concatenate(a), np.concatenate(b)))

    held = written(arrow_map(distinct.select("fp"), replicate, "anchor int, fp long, home boolean"), "simhash-anchors")
    # At most 3 x 4,096 anchors exist, so their counts are a small table at any scale.
    cuts = held.groupBy("anchor").agg(
        F.ceil(F.count("*") / cell).cast("int").alias("n_visitor"),
        F.ceil(F.count_if("home") / cell).cast("int").alias("n_home")).where("n_home > 0")
    dealt = held.join(F.broadcast(cuts), "anchor")
    spread = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    as_home = dealt.where("home").select(
        "anchor", "fp", F.lit(True).alias("as_home"), spread("n_home").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("n_visitor") - 1)).alias("j"))
    as_visitor = dealt.select(
        "anchor", "fp", F.lit(False).alias("as_home"), F.explode(F.sequence(F.lit(0), F.col("n_home") - 1)).alias("i"),
        spread("n_visitor").alias("j"))
    cells = as_home.union(as_visitor).select("fp", "as_home", F.xxhash64("anchor", "i", "j").alias("cell_key"))
    return arrow_map(cells.repartition("cell_key").sortWithinPartitions("cell_key"), compare, "a long, b long")


def _grouped(docs: DataFrame, words: int, max_bits: int, cell: int = 1024) -> DataFrame:
    """``doc_id``, ``row_key``, ``fp`` and ``group_fp`` for each row of
    ``docs``."""
    rows = written(fingerprints(docs, words), "simhash-fp")
    roots = connected_components(near_links(rows.select("fp").distinct(), max_bits, cell), "simhash-cc")
    return (rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .withColumn("group_fp", F.coalesce("root", "fp")).drop("root"))


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, cell: int = 1024) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest
    doc_id reachable), ``row_key`` and ``group_fp`` for each row of ``docs``."""
    grouped = _grouped(docs, words, max_bits, cell)
    # Written: a join of two plain exchanges can split a hot group.
    least = written(grouped.groupBy("group_fp").agg(F.min("doc_id").alias("component_id")), "simhash-least")
    return grouped.join(least, "group_fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "row_key", "group_fp")


def one_of_each(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest doc_id
    (NULL last), whole equal rows once."""
    # Straight from the rows, so that each task reduces a large group before the shuffle.
    first = (_grouped(docs, words, max_bits).groupBy("group_fp")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("kept")))
    return (docs.withColumn("row_key", row_key(docs))
            .join(first.select(F.col("kept.row_key").alias("row_key")), "row_key", "left_semi")
            .dropDuplicates(["row_key"]).select(*docs.columns))
