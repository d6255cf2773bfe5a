"""Mixing sources to target weights by Pfair scheduling.

Time runs in slots of one block (``block_bytes`` bytes of text). A source of
weight w is a task of rate w: its k-th block (from 1) is released at
floor((k - 1) / w) and due at ceil(k / w); in each slot the released block
with the earliest deadline runs. At any slot a source has then had its share
of slots to within less than one block.

Weights are rounded to multiples of 1 / Q (largest remainders, at least one;
Q = ``period``, or ten times the number of sources if larger). Then the
schedule repeats every Q slots, so only one period is scheduled (on the
driver, bounded by Q) and each block finds its slot by arithmetic, without
any order of execution between tasks. When a source runs out, a new phase
starts with the other sources' weights scaled up; there are at most as many
phases as sources.

A document belongs to the block in which its first byte falls, counting the
bytes of its source in a fixed pseudo-random order. Every row gets a slot:
nothing is dropped or repeated. Null and empty texts count one byte; a NULL
source is a source of its own; repeated rows are scheduled each. At most
``max_sources`` sources are accepted, beyond that an error is raised.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows per group in which bytes are summed up row by row.
GROUP_ROWS = 2000


def rates(weights: list[float], period: int) -> list[int]:
    """Positive whole numbers adding up to ``period``, near the weights."""
    total = sum(weights)
    exact = [w / total * period for w in weights]
    out = [max(1, int(x)) for x in exact]
    order = sorted(range(len(exact)), key=lambda i: (out[i] - exact[i], i))
    at = 0
    while sum(out) < period:
        out[order[at % len(out)]] += 1
        at += 1
    while sum(out) > period:
        out[max(range(len(out)), key=lambda i: (out[i] - exact[i] if out[i] > 1 else -period, -i))] -= 1
    return out


def one_period(rate: list[int]) -> list[list[int]]:
    """For each source the slots of its blocks in a period, by earliest
    deadline first among released blocks."""
    period = sum(rate)
    slots: list[list[int]] = [[] for _ in rate]
    waiting = [(0, s) for s in range(len(rate))]  # (release, source) of each source's next block
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(slots[s]) + 1) * period // rate[s]), s))
        deadline, s = heapq.heappop(ready)
        assert slot < deadline, "rates add up to one, so no deadline is missed"
        slots[s].append(slot)
        if len(slots[s]) < rate[s]:
            heapq.heappush(waiting, (len(slots[s]) * period // rate[s], s))
    return slots


def phases(blocks: list[int], weights: list[float], period: int) -> list[dict]:
    """The phases of a schedule of ``blocks[s]`` blocks of each source: for
    each source in a phase its first block, number of blocks, rate, slots in a
    period; and the phase's first slot."""
    left, done, start, out = list(blocks), [0] * len(blocks), 0, []
    while any(left):
        active = [s for s in range(len(left)) if left[s]]
        rate = rates([weights[s] for s in active], period)
        slots = one_period(rate)
        # the slot after the last block of the source that runs out first
        length = min((left[s] - 1) // a * period + at[(left[s] - 1) % a] for s, a, at in zip(active, rate, slots, strict=True)) + 1
        for s, a, at in zip(active, rate, slots, strict=True):
            n = length // period * a + bisect_left(at, length % period)
            out.append({"source": s, "first": done[s], "n": n, "rate": a, "slots": at, "start": start})
            done[s], left[s] = done[s] + n, left[s] - n
        start += length
    numbers = {start: i for i, start in enumerate(sorted({p["start"] for p in out}))}
    return [p | {"phase": numbers[p["start"]]} for p in out]


def slots_of(docs: DataFrame, weights: dict[str, float] | None = None, block_bytes: int = 1 << 16, period: int = 1000,
             tempering: float = 0.5, max_sources: int = 500) -> DataFrame:
    """Each row of ``docs`` as struct ``row`` with ``n_bytes``, ``block`` (of its source, from 0), ``slot``,
    ``order_key`` (order inside a block), ``release``, ``deadline`` (slots)
    and ``phase``. Without ``weights`` the target of a source is its bytes to
    the power ``tempering``; a source missing in ``weights`` is an error."""
    spark = docs.sparkSession
    own = docs.columns
    rows = docs.select(
        F.struct(*own).alias("row"), F.col("source").cast("string").alias("source_"),
        F.greatest(F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)), F.lit(1)).cast("long").alias("n_bytes_"),
        F.xxhash64("doc_id", "text").alias("order_"))
    found = rows.groupBy("source_").agg(F.count("*").alias("n"), F.sum("n_bytes_").alias("bytes")).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    found.sort(key=lambda r: (r.source_ is None, r.source_ or ""))
    names = [r.source_ for r in found]
    if weights is None:
        target = [r.bytes ** tempering for r in found]
    else:
        if missing := [n for n in names if not weights.get(n)]:
            raise ValueError(f"no positive weight for {missing}")
        target = [weights[n] for n in names]
    period = max(period, 10 * len(names))
    plan = phases([-(-r.bytes // block_bytes) for r in found], target, period)

    # At most max_sources rows, and as many phases for each: a small table at any scale.
    groups = spark.createDataFrame([(n, i, max(1, -(-r.n // GROUP_ROWS))) for i, (n, r) in enumerate(zip(names, found, strict=True))],
                                   "source_ string, source_no int, n_groups long")
    turns = spark.createDataFrame(
        [(p["source"], p["phase"], p["first"], p["first"] + p["n"], p["rate"], p["start"], p["slots"]) for p in plan if p["n"]],
        "source_no int, phase int, first long, beyond long, rate long, start long, slots array<int>")

    # Bytes before each row of its source: sums of small groups, then a running sum inside each.
    share = F.col("order_") / F.lit(2.0 ** 64) + 0.5
    rows = (rows.join(F.broadcast(groups), rows["source_"].eqNullSafe(groups["source_"])).drop("source_")
            .withColumn("group", F.least(F.floor(share * F.col("n_groups")), F.col("n_groups") - 1)))
    sums = rows.groupBy("source_no", "group").agg(F.sum("n_bytes_").alias("group_bytes"))
    before = sums.withColumn("before", F.sum("group_bytes").over(Window.partitionBy("source_no").orderBy("group")) - F.col("group_bytes"))
    inside = Window.partitionBy("source_no", "group").orderBy("order_").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("upto", F.sum("n_bytes_").over(inside))
              .join(before.drop("group_bytes"), ["source_no", "group"])
              .withColumn("byte", F.col("before") + F.col("upto") - F.col("n_bytes_"))
              .withColumn("block", F.floor(F.col("byte") / block_bytes).cast("long")))
    turn = F.col("block") - F.col("first")
    return (placed.join(F.broadcast(turns), (placed["source_no"] == turns["source_no"]) & (F.col("block") >= F.col("first")) & (F.col("block") < F.col("beyond")))
            .select("row", F.col("n_bytes_").alias("n_bytes"), "block",
                    (F.col("start") + F.floor(turn / F.col("rate")) * period + F.element_at("slots", (turn % F.col("rate") + 1).cast("int"))).alias("slot"),
                    F.struct("order_", "byte").alias("order_key"),
                    (F.col("start") + F.floor(turn * period / F.col("rate"))).alias("release"),
                    (F.col("start") + F.ceil((turn + 1) * period / F.col("rate"))).alias("deadline"), "phase"))


def place() -> Column:
    """A long that grows in the order of the rows ``mixed`` gave, of a table
    read from the files they were written to: number of the task, of its file,
    of the row (Spark's writer keeps the order of partitions in the names)."""
    part = lambda pattern: F.coalesce(F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).try_cast("long"), F.lit(0))
    return F.shiftleft(part(r"^part-(\d+)-"), 42) + F.shiftleft(part(r"-c(\d+)\."), 32) + F.col("_metadata.row_index")


def schedule(docs: DataFrame, **settings) -> DataFrame:
    """The columns of ``docs`` (but for those named alike) and those of ``slots_of``."""
    placed = slots_of(docs, **settings)
    extra = [c for c in placed.columns if c != "row"]
    return placed.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in extra), *extra)


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` in the order of the schedule, columns as they are."""
    return slots_of(docs, **settings).orderBy("slot", "order_key.order_", "order_key.byte").select("row.*")
