"""Best-fit packing of documents into token sequences by a grouping genetic
algorithm on islands.

A document's ids (and a closing id 0) form one piece, or several of
``capacity`` if it is longer. Whole pieces are sequences of their own; the
others are dealt to islands of about ``island`` pieces. On each island a
population of packings evolves: crossover injects whole well-filled sequences
of one parent into the other, sequences that now hold a piece twice are taken
apart and their displaced pieces go back in by best fit (longest first); the
worst packing is replaced. Islands share no pieces, so what migrates between
epochs is the pattern of elite sequences (their piece lengths): the next
island builds them from its own pieces of those lengths, as another parent.

After the epochs the sequences with room to spare are opened and their pieces
move to fewer islands, level by level, until one island is left or as many
islands free no sequence: so every island's last, half-empty sequences are filled from
each other's. An island is bounded (at four times ``island`` when levels
merge), no task ever holds more than a few islands' pieces.

Null and empty texts are one piece, the closing id. Repeated rows are packed
each. Runs are seeded, and pieces are numbered in the order tasks read them:
the same table cut into the same tasks gives the same packing, another cut
another one as good.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map, batch_of, sorted_groups, written
from contract_lake.llm.tokens import Encoder

#: A sequence at least this full is left alone when islands merge.
FULL = 0.998
ELITE = 64


def best_fit(lengths: list[int], items: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """``bins`` and further ones with ``items`` put in, longest first, each
    into the fullest bin that has room."""
    room = [(capacity - sum(lengths[i] for i in b), k) for k, b in enumerate(bins)]
    room = sorted(r for r in room if r[0])
    for item in sorted(items, key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        at = bisect_left(room, (n, -1))
        if at < len(room):
            left, k = room.pop(at)
            bins[k].append(item)
        else:
            left, k = capacity, len(bins)
            bins.append([item])
        if left > n:
            insort(room, (left - n, k))
    return bins


def fitness(lengths: list[int], bins: list[list[int]], capacity: int) -> float:
    """Mean squared fill: fewer and fuller sequences score higher."""
    return sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def crossover(lengths: list[int], mother: list[list[int]], injected: list[list[int]], capacity: int) -> list[list[int]]:
    """``mother`` with the sequences ``injected`` in place of those that share
    a piece with them; what that displaces goes back by best fit."""
    taken = {i for b in injected for i in b}
    child, displaced = [list(b) for b in injected], []
    for b in mother:
        if taken.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    return best_fit(lengths, displaced, child, capacity)


def from_patterns(lengths: list[int], patterns: list[tuple[int, ...]]) -> list[list[int]]:
    """Sequences of own pieces after the patterns, as far as there are any."""
    stock = defaultdict(list)
    for i, n in enumerate(lengths):
        stock[n].append(i)
    out = []
    for pattern in patterns:
        need = defaultdict(int)
        for n in pattern:
            need[n] += 1
        if all(len(stock[n]) >= k for n, k in need.items()):
            out.append([stock[n].pop() for n in pattern])
    return out


def evolve(lengths: list[int], capacity: int, seed: int, start: list[list[int]] | None = None,
           patterns: list[tuple[int, ...]] = (), population: int = 6, children: int = 24) -> list[list[int]]:
    """The best packing found by the grouping genetic algorithm."""
    chance = np.random.default_rng(seed)
    everything = list(range(len(lengths)))
    score = lambda bins: fitness(lengths, bins, capacity)
    people = [best_fit(lengths, everything, [], capacity)]
    bound = -(-sum(lengths) // capacity)
    if start:
        people.append(start)
    if patterns:
        people.append(crossover(lengths, people[0], from_patterns(lengths, list(patterns)), capacity))
    while len(people) < population and len(people[0]) > bound:
        # a shuffled first part, the rest by best fit: other packings of like quality
        some = set(chance.choice(len(lengths), len(lengths) // 4, replace=False).tolist())
        people.append(best_fit(lengths, [i for i in everything if i not in some], best_fit(lengths, list(some), [], capacity), capacity))
    ranked = sorted(((score(p), k, p) for k, p in enumerate(people)), key=lambda x: (-x[0], x[1]))
    for child_no in range(children):
        if len(ranked[0][2]) <= bound:
            break
        a, b = chance.integers(0, len(ranked), 2)
        if a == b:
            b = (b + 1) % len(ranked)
        if a == b:
            break
        full = sorted(ranked[b][2], key=lambda s: -sum(lengths[i] for i in s))
        some = full[:max(1, len(full) // 2)]
        injected = [some[i] for i in np.flatnonzero(chance.random(len(some)) < 0.5)]
        child = crossover(lengths, ranked[a][2], injected, capacity)
        value = score(child)
        if value > ranked[-1][0] and all(abs(value - r[0]) > 1e-12 for r in ranked):
            ranked[-1] = (value, len(people) + child_no, child)
            ranked.sort(key=lambda x: (-x[0], x[1]))
    return min((r[2] for r in ranked), key=lambda p: (len(p), -score(p)))


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, order: Column | None = None) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` of every
    piece and ``turn``, its document's ``order``, written once with ``item``,
    a number of its own."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("turn", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary)
        end = np.zeros(1, np.uint32)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, turn, ids in zip(batch.column("doc_id").to_pylist(), batch.column("turn").to_pylist(), encoder.encoded(batch.column("text")), strict=True):
                octets = np.concatenate([ids, end]).astype("<u4").tobytes()
                for at in range(0, len(octets), 4 * capacity):
                    part = octets[at:at + 4 * capacity]
                    out.append((doc_id, at // (4 * capacity), at // 4, len(part) // 4, zlib.crc32(part), turn))
            if out:
                yield batch_of(schema, *zip(*out, strict=True))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (F.lit(None) if order is None else order).cast("long").alias("turn"))
    found = arrow_map(rows, run, "doc_id long, piece int, start long, length long, ids_crc32 long, turn long")
    return written(found.withColumn("item", F.monotonically_increasing_id()), "packing-pieces")


def _on_islands(items: DataFrame, capacity: int, population: int, children: int, seed: int) -> DataFrame:
    """Pack the ``items`` (item, length, island, bin or NULL, pattern or NULL;
    rows with a pattern are immigrants) of each island: item, length, island,
    bin, offset, fill. With no immigrants and no bins: from scratch."""
    schema = pa.schema([("item", pa.int64()), ("length", pa.int64()), ("island", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("fill", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "island"):
            island = group.column("island")[0].as_py()
            patterns = sorted(tuple(p) for p in group.column("pattern").to_pylist() if p)
            own = sorted(x for x in zip(group.column("item").to_pylist(), group.column("length").to_pylist(), group.column("bin").to_pylist(), strict=True) if x[0] is not None)
            lengths = [n for _, n, _ in own]
            if not own:
                continue
            before = defaultdict(list)
            for k, (_, _, b) in enumerate(own):
                if b is not None:
                    before[b].append(k)
            bins = evolve(lengths, capacity, seed + island, list(before.values()) or None, patterns, population, children)
            rows = []
            for number, content in enumerate(bins):
                fill, at = sum(lengths[k] for k in content), 0
                for k in content:
                    rows.append((own[k][0], lengths[k], island, number, at, fill))
                    at += lengths[k]
            yield batch_of(schema, *zip(*rows, strict=True))

    dealt = items.repartition("island").sortWithinPartitions("island")
    return arrow_map(dealt, run, "item long, length long, island long, bin long, offset long, fill long")


def _dealt(items: DataFrame, n: int, salt: int) -> DataFrame:
    """``items`` (item, length) dealt to ``n`` islands."""
    return items.select("item", "length", F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(n)).alias("island"),
                        F.lit(None).cast("long").alias("bin"), F.lit(None).cast("array<long>").alias("pattern"))


def packed(docs: DataFrame, vocabulary: str, capacity: int = 2048, island: int = 2048, epochs: int = 2,
           population: int = 6, children: int = 24, merge: int = 8, order: Column | None = None) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` of every piece of every document. With
    ``order`` (a long of each row of ``docs``) also ``turn``: the least order
    among the sequence's documents, by which the sequences are to be read."""
    found = pieces(docs, vocabulary, capacity, order)
    loose = found.where(F.col("length") < capacity).select("item", "length")
    n = max(1, -(-loose.count() // island))
    state = written(_on_islands(_dealt(loose, n, 0), capacity, population, children, 1), "packing-epoch")
    for epoch in range(1, epochs if n > 1 else 1):
        # The fullest sequences of more than one piece go, as patterns, to the next island.
        patterns = (state.groupBy("island", "bin").agg(F.sort_array(F.collect_list("length")).alias("pattern"), F.max("fill").alias("fill"))
                    .where(F.size("pattern") > 1)
                    .withColumn("rank", F.row_number().over(Window.partitionBy("island").orderBy(F.desc("fill"), "bin")))
                    .where(F.col("rank") <= ELITE))
        immigrants = patterns.select(
            F.lit(None).cast("long").alias("item"), F.lit(None).cast("long").alias("length"),
            F.pmod(F.col("island") + epoch, F.lit(n)).alias("island"), F.lit(None).cast("long").alias("bin"), "pattern")
        natives = state.select("item", "length", "island", "bin", F.lit(None).cast("array<long>").alias("pattern"))
        state = written(_on_islands(natives.union(immigrants), capacity, population, children, 1 + epoch * 1_000_003), "packing-epoch")
    # Level by level: what is full stays, the pieces of roomy sequences meet on fewer islands.
    done, level = [], 0
    while n > 1:
        done.append(state.where(F.col("fill") >= FULL * capacity).withColumn("level", F.lit(level)))
        state = state.where(F.col("fill") < FULL * capacity)
        left, before = state.agg(F.count("*"), F.count_if(F.col("offset") == 0)).first()
        fewer = min(n, max(1, -(-n // merge), -(-left // (4 * island))))
        merged = written(_on_islands(_dealt(state.select("item", "length"), fewer, level + 1), capacity, population, children, 1 + (level + 1) * 7_000_003), "packing-merge")
        if merged.where("offset = 0").count() < before:
            state, level = merged, level + 1
        elif fewer == n:  # no sequence freed: they stay as they were
            break
        n = fewer
    done.append(state.withColumn("level", F.lit(level)))
    places = done[0]
    for more in done[1:]:
        places = places.union(more)
    places = places.select("item", (F.col("level") * F.lit(1 << 56) + F.col("island") * F.lit(1 << 24) + F.col("bin") * 2).alias("at"), "offset")
    out = found.join(places, "item", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("at", F.col("item") * 2 + 1).alias("sequence_id"), F.coalesce("offset", F.lit(0)).cast("long").alias("offset"), "turn")
    return out.drop("turn") if order is None else out.withColumn("turn", F.min("turn").over(Window.partitionBy("sequence_id")))
