"""Change data capture: SCD Type 2 history, current rows, as-of reads.

Plan shape
----------
All per-key order work shares ONE hash exchange on ``(keys, _seg)`` and ONE
sort on ``(seq, tie_break, other columns)``: the tie step, change suppression, run starts and
``valid_to`` are window functions over the same partitioning and ordering, so
Spark stacks them without a second shuffle or sort.

Hot keys
--------
A key's history is ordered, so a plain ``Window.partitionBy(key)`` puts one
key in one task; a key holding a third of all rows would stall the job. Keys
with more than ``max_rows_per_segment`` rows (found on a sample) are therefore
cut into segments of consecutive sequence ranges. The bounds are quantiles of
the key's sampled sequence values, so bursts are cut as finely as the rest and
any orderable sequence works, text too; a NULL or part-NULL key is a key like
any other. Rows of one sequence value always land in the same segment, so the
tie step stays local.
A ``(key, seq)`` group too large for one segment (the usual case when the
sequence is a micro-batch's processing time) is first collapsed to its last
row by a combinable ``max_by``, reduced map-side before any shuffle.
What crosses a segment edge (previous row's tracked values, next row's start,
the running run start) is carried by a per-segment summary: one small row per
hot segment, joined back on ``(keys, _seg)``. That join needs no exchange of
the big side, because the big side is already partitioned on those columns.
The planning passes read only ``(keys, seq)``, shuffle small partial counts
and send a few numbers (counts and byte widths) to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_dir

SEG = "_seg"
HOT = "_hot"
DEL = "_del"
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# per-row allowance for a broadcast relation's own bookkeeping
ROW_OVERHEAD_BYTES = 32
SAMPLE_ROWS_PER_SEGMENT = 200
# Bounds of a key are looked up in two steps of at most about this many.
BOUNDS_PER_STEP = 64
# All key columns as one struct: equal also where both are NULL.
KEY = "_k"


def _byte_width(df: DataFrame, name: str) -> Column:
    """Bytes a value of column ``name`` takes: the length of text and binary
    values, the JSON text length of nested values (a generous stand-in), and
    for other types the slot a row gives them (8 bytes, 16 for decimals)."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    return F.lit(16 if isinstance(dtype, T.DecimalType) else 8)


def _fits(n_bytes: int) -> bool:
    """Whether a relation of ``n_bytes`` raw bytes may be broadcast (twice
    the bytes are allowed for the hashed form)."""
    return 2 * n_bytes <= BROADCAST_LIMIT_BYTES


@dataclass(frozen=True)
class SegmentPlan:
    """What the planning pass found.

    ``hot_plan``: one row per hot key (``_k``, the sorted first sequence
    values of its segments but the first, and every 64th of them), a written
    table, or None when no key is cut.
    ``ties``: ``(_k, seq)`` pairs with more rows than a segment may hold,
    or None. Each comes with its count and whether its proven size fits a
    broadcast (else it is joined with a shuffle, AQE splitting skew).
    """
    hot_plan: DataFrame | None
    n_hot: int
    n_bounds: int
    small: bool
    ties: DataFrame | None = None
    n_ties: int = 0
    ties_small: bool = True


def _key_struct(keys: list[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys])


def _kept(df: DataFrame, name: str) -> DataFrame:
    """A small table in the shared folder: every use reads the same rows."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_segments(df: DataFrame, keys: list[str], seq: str, max_rows_per_segment: int,
                  seed: int = 17) -> SegmentPlan | None:
    """Segment plan for hot keys and hot ties, or None when there are none.

    One pass over a Bernoulli sample, sized so that a group at the limit
    shows about ``SAMPLE_ROWS_PER_SEGMENT`` sampled rows, counts rows per
    key (a few partial counts per task are shuffled; three numbers reach the
    driver). A key with about ``max_rows_per_segment`` rows or more is hot.
    When there is none, that is all. Otherwise the hot keys' sampled rows are
    counted per ``(key, seq)`` and kept, and the rest is read from them: a
    group that large is a hot tie, which sequence ranges cannot split (every
    row of it must meet in the tie step), so ``scd2`` collapses it first with
    a combinable aggregate (the normal case when the sequence is the
    processing time of a micro-batch: every row of a batch shares it); and
    the segment bounds, one every ``max_rows_per_segment`` rows by the sample.
    Both are tables of sampled values, so all uses of a plan agree. Which
    rows were sampled only affects balance, never the result.
    """
    key_bytes = sum((_byte_width(df, k) for k in keys[1:]), _byte_width(df, keys[0]))
    base = df.filter(F.col(seq).isNotNull()).select(_key_struct(keys).alias(KEY), F.col(seq), key_bytes.alias("_kb"),
                                                    _byte_width(df, seq).alias("_sb"))
    fraction = min(1.0, SAMPLE_ROWS_PER_SEGMENT / float(max_rows_per_segment))
    sampled = base if fraction >= 1.0 else base.sample(fraction=fraction, seed=seed)
    # a group is a candidate when its sample says at least half the limit
    threshold = max_rows_per_segment * fraction * (0.5 if fraction < 1.0 else 1.0)
    stats = _kept(sampled.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"), F.max("_kb").alias("_kb"), F.max("_sb").alias("_sb"))
                  .filter(F.col("_n") > F.lit(threshold)), "hot_keys")
    summary = stats.agg(F.count(F.lit(1)).alias("n_big"), F.max("_kb").alias("key_bytes"), F.max("_sb").alias("seq_bytes")).first()
    n_big = int(summary["n_big"] or 0)
    if n_big == 0:
        # a tie group is never larger than its key: no big key, no hot tie
        return None
    # Broadcast bounds from the widest sampled key and sequence: the lists
    # below hold sampled values only, so these sizes are upper bounds.
    kb, sb = int(summary["key_bytes"] or 0), int(summary["seq_bytes"] or 0)
    big = stats.select(KEY)
    big_small = _fits(n_big * (kb + ROW_OVERHEAD_BYTES))
    hot = _kept(sampled.join(F.broadcast(big) if big_small else big, KEY, "left_semi")
                .groupBy(KEY, seq).agg(F.count(F.lit(1)).alias("_c")), "hot_sample")
    tie = F.col("_c") > F.lit(threshold)
    ties = hot.filter(tie).select(KEY, seq)
    n_ties = ties.count()
    # A segment starts at the first value at or past each multiple of the
    # limit in the running count of sampled rows; a collapsed tie is one row.
    per = max(1.0, max_rows_per_segment * fraction)
    upto = F.sum(F.when(tie, F.lit(1)).otherwise(F.col("_c"))).over(
        Window.partitionBy(KEY).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1))
    counted = hot.select(KEY, seq, F.coalesce(upto, F.lit(0)).alias("_before"))
    segment = F.floor(F.col("_before") / per)
    starts = counted.groupBy(KEY, segment.alias("_s")).agg(F.min(seq).alias("_start")).filter(F.col("_s") > 0)
    step = F.lit(BOUNDS_PER_STEP)
    bounds = starts.groupBy(KEY).agg(F.array_sort(F.collect_list("_start")).alias("_bounds"))
    plan = _kept(bounds.withColumn("_coarse", F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_bounds") - 1) / step).cast("int")),
        lambda i: F.get(F.col("_bounds"), (i * step).cast("int")))), "hot_plan")
    size = plan.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("_bounds") + F.size("_coarse")).alias("b")).first()
    n_hot, n_bounds = int(size["n"] or 0), int(size["b"] or 0)
    small = _fits(n_hot * (kb + 2 * ROW_OVERHEAD_BYTES) + n_bounds * (sb + 8))
    ties_small = _fits(n_ties * (kb + sb + ROW_OVERHEAD_BYTES))
    if not n_hot and not n_ties:
        return None
    return SegmentPlan(plan if n_hot else None, n_hot, n_bounds, small, ties if n_ties else None, n_ties, ties_small)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType, T.CalendarIntervalType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def row_order(df: DataFrame, seq: str, tie_break: list[str]) -> list[str]:
    """Total order of a key's rows: sequence, tie-break, then every other
    orderable column. The trailing columns decide only between rows equal in
    sequence and tie-break, so the winner of such a tie is the same in every
    run and every task attempt (a recomputed partition after an executor
    loss picks the same row)."""
    lead = [seq] + tie_break
    return lead + [f.name for f in df.schema.fields
                   if f.name not in lead and _orderable(f.dataType)]


def collapse_ties(df: DataFrame, keys: list[str], seq: str, order: list[str], plan: SegmentPlan) -> DataFrame:
    """Keep only the last row (by ``order``) of each hot ``(keys, seq)``
    group, before any shuffle of it: ``max_by`` is combinable, so every map
    task reduces its share of a group to one row and the exchange carries one
    row per group and task. Other rows pass through unchanged."""
    t = plan.ties.withColumn("_tie", F.lit(True))
    tagged = df.withColumn(KEY, _key_struct(keys)).join(F.broadcast(t) if plan.ties_small else t, [KEY, seq], "left")
    rest = tagged.filter(F.col("_tie").isNull()).select(*df.columns)
    hot = tagged.filter(F.col("_tie")).select(*df.columns)
    others = [c for c in df.columns if c not in keys and c != seq]
    rank = F.struct(*[F.col(c) for c in order if c != seq])
    last = hot.groupBy(*keys, seq).agg(F.max_by(F.struct(*others), rank).alias("_last"))
    last = last.select(*keys, seq, *[F.col("_last")[c].alias(c) for c in others])
    return rest.unionByName(last.select(*df.columns))


def _assign_segments(df: DataFrame, keys: list[str], seq: str, plan: SegmentPlan | None) -> DataFrame:
    """``df`` with its segment and whether its key is hot; segmented plans
    also carry the key struct."""
    if plan is None or plan.hot_plan is None:
        return df.withColumn(SEG, F.lit(0)).withColumn(HOT, F.lit(False))
    hp = plan.hot_plan.withColumn(HOT, F.lit(True))
    joined = df.withColumn(KEY, _key_struct(keys)).join(F.broadcast(hp) if plan.small else hp, KEY, "left")
    value, step = F.col(seq), F.lit(BOUNDS_PER_STEP)
    not_after = lambda bounds: F.size(F.filter(bounds, lambda b: b <= value))
    block = not_after(F.col("_coarse"))
    seg = F.when(block > 0, (block - 1) * step + not_after(F.slice("_bounds", (block - 1) * step + 1, step))).otherwise(F.lit(0))
    return joined.withColumn(SEG, F.when(F.col(HOT), seg.cast("int")).otherwise(F.lit(0))) \
                 .withColumn(HOT, F.coalesce(F.col(HOT), F.lit(False))).drop("_bounds", "_coarse")


def scd2(changes: DataFrame, keys: list[str] | str, sequence_by: str,
         tie_break: list[str] | None = None, track: list[str] | None = None,
         delete_when: str | Column | None = None,
         max_rows_per_segment: int = 2_000_000,
         valid_from: str = "valid_from", valid_to: str = "valid_to",
         is_current: str = "is_current", plan=...) -> DataFrame:
    """SCD Type 2 history of ``changes``.

    * Per key, rows are ordered by ``sequence_by`` then ``tie_break`` (then
      the other columns, so the order is total: see ``row_order``); among
      rows with equal sequence the last one wins. Rows with a NULL sequence
      are not history (route them to quarantine before).
    * ``track``: columns whose change opens a new version. A run of rows with
      equal tracked values is one version: it starts at the run's first
      sequence and carries the run's latest values (an in-place update).
      ``None`` tracks every column, so every row is a version.
    * ``delete_when``: rows matching it are tombstones; they close the open
      version at their sequence and never appear themselves. NULL means no.
    * Output: input columns plus ``valid_from``, ``valid_to`` (NULL while
      open) and ``is_current``.
    * ``plan``: a ``SegmentPlan`` already made by ``plan_segments`` for this
      input (or None for "no hot key, no hot tie"); computed here when not
      given. Hot ties are collapsed before the shuffle (``collapse_ties``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    tie_break = list(tie_break or [])
    cols = changes.columns
    seq = sequence_by
    df = changes.filter(F.col(seq).isNotNull())
    if delete_when is None:
        df = df.withColumn(DEL, F.lit(False))
    else:
        cond = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
        df = df.withColumn(DEL, F.coalesce(cond, F.lit(False)))

    order = row_order(changes, seq, tie_break)
    if plan is ...:
        plan = plan_segments(df, keys, seq, max_rows_per_segment) if max_rows_per_segment else None
    out_cols = [F.col(c) for c in cols] + [F.col("_from").alias(valid_from), F.col("_to").alias(valid_to),
                                           F.col("_to").isNull().alias(is_current)]
    # Segmented: the windowed rows feed both the per-segment summary and the
    # rows joined to it, through one exchange and sort, which are reused.
    return _versions(df, keys, seq, order, plan, track).select(*out_cols)


def _versions(df: DataFrame, keys: list[str], seq: str, order: list[str], plan: SegmentPlan | None,
              track: list[str] | None) -> DataFrame:
    """Steps 1-4 of ``scd2`` on rows with the ``_del`` flag; returns the
    version rows with ``_from`` and ``_to``."""
    if plan is not None and plan.ties is not None:
        df = collapse_ties(df, keys, seq, order, plan)
    df = _assign_segments(df, keys, seq, plan)
    segmented = plan is not None and plan.hot_plan is not None

    part = [KEY, SEG] if segmented else keys + [SEG]
    if segmented:
        # Hot keys: spread their segments over tasks. Explicit, because an
        # input already bucketed by the keys would satisfy the window's
        # requirement and keep every segment of a hot key in one task.
        df = df.repartition(*part)
    w = Window.partitionBy(*part).orderBy(*[F.col(c).asc() for c in order])

    # 1. ties: keep the last row of each (keys, seq); never crosses a segment.
    nxt = F.lead(seq).over(w)
    d = df.withColumn("_nx", nxt).filter(F.col("_nx").isNull() | (F.col("_nx") != F.col(seq))).drop("_nx")

    # 2. neighbours inside the segment.
    tracked = F.struct(*[F.col(c) for c in track]) if track is not None else F.lit(None)
    d = d.withColumn("_trk", tracked).withColumns({
        "_rn": F.row_number().over(w),
        "_p_del": F.lag(DEL).over(w),
        "_p_trk": F.lag("_trk").over(w),
        "_n_seq": F.lead(seq).over(w),
        "_n_del": F.lead(DEL).over(w),
        "_n_trk": F.lead("_trk").over(w)})

    def differs(a: str | Column, b: str | Column) -> Column:
        if track is None:
            return F.lit(True)
        a = F.col(a) if isinstance(a, str) else a
        b = F.col(b) if isinstance(b, str) else b
        return ~a.eqNullSafe(b)

    # change test against the previous row, valid for rows after the first.
    inner_changed = F.col(DEL) | F.col("_p_del") | differs("_trk", "_p_trk")
    # does the next row open a new run? valid while a next row exists here.
    inner_next_changed = F.col("_n_del") | F.col(DEL) | differs("_n_trk", "_trk")

    if not segmented:
        changed = F.when(F.col("_rn") == 1, F.lit(True)).otherwise(inner_changed)
        next_changed = F.when(F.col("_n_seq").isNull(), F.lit(True)).otherwise(inner_next_changed)
        d = d.withColumns({"_chg": changed, "_end": next_changed, "_to": F.col("_n_seq")})
        carry = F.lit(None)
    else:
        # 3. per hot segment: first and last row, last local change.
        edge = F.struct(F.col(seq).alias("s"), F.col(DEL).alias("d"), F.col("_trk").alias("t"))
        summ = d.filter(F.col(HOT)).groupBy(*part).agg(
            F.min_by(edge, F.col("_rn")).alias("_first"),
            F.max_by(edge, F.col("_rn")).alias("_last"),
            F.max(F.when((F.col("_rn") > 1) & inner_changed, F.col(seq))).alias("_lchg"))
        ws = Window.partitionBy(KEY).orderBy(SEG)
        summ = summ.withColumn("_prev", F.lag("_last").over(ws)) \
                   .withColumn("_next", F.lead("_first").over(ws))
        first_changed = F.col("_prev").isNull() | F.col("_first.d") | F.col("_prev.d") | \
            differs(F.col("_first.t"), F.col("_prev.t"))
        next_first_changed = F.col("_next").isNull() | F.col("_next.d") | F.col("_last.d") | \
            differs(F.col("_next.t"), F.col("_last.t"))
        summ = summ.withColumn("_fchg", first_changed) \
                   .withColumn("_nfchg", next_first_changed) \
                   .withColumn("_nfseq", F.col("_next.s"))
        seg_last_change = F.greatest(F.col("_lchg"), F.when(F.col("_fchg"), F.col("_first.s")))
        summ = summ.withColumn("_slc", seg_last_change)
        wc = ws.rowsBetween(Window.unboundedPreceding, -1)
        summ = summ.withColumn("_carry", F.max("_slc").over(wc)) \
                   .select(*part, "_fchg", "_nfchg", "_nfseq", "_carry")
        d = d.join(summ, part, "left")
        # (reading _hot here keeps it in this branch's exchange, as in the
        # summary's, so the two subtrees stay identical and are computed once)
        changed = F.when(F.col("_rn") == 1, F.when(F.col(HOT), F.coalesce(F.col("_fchg"), F.lit(True)))
                         .otherwise(F.lit(True))).otherwise(inner_changed)
        next_changed = F.when(F.col("_n_seq").isNull(), F.coalesce(F.col("_nfchg"), F.lit(True))) \
                        .otherwise(inner_next_changed)
        d = d.withColumns({"_chg": changed, "_end": next_changed,
                           "_to": F.when(F.col("_n_seq").isNull(), F.col("_nfseq")).otherwise(F.col("_n_seq"))})
        carry = F.col("_carry")

    # 4. run start = latest change at or before the row (sequence is sorted).
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run_start = F.max(F.when(F.col("_chg"), F.col(seq))).over(wr)
    d = d.withColumn("_from", F.coalesce(run_start, carry))

    return d.filter(F.col("_end") & ~F.col(DEL))


def current(history: DataFrame, is_current: str = "is_current") -> DataFrame:
    """Open versions only."""
    return history.filter(F.col(is_current))


def as_of(history: DataFrame, ts, valid_from: str = "valid_from",
          valid_to: str = "valid_to") -> DataFrame:
    """Versions valid at ``ts``: ``valid_from <= ts < valid_to``."""
    t = ts if isinstance(ts, Column) else F.lit(ts)
    vf, vt = F.col(valid_from), F.col(valid_to)
    return history.filter((vf <= t.cast(history.schema[valid_from].dataType)) &
                          (vt.isNull() | (t.cast(history.schema[valid_to].dataType) < vt)))


def as_of_each(history: DataFrame, probes: DataFrame, keys: list[str] | str, at: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
               prefix: str = "version_", max_rows_per_segment: int = 2_000_000, plan=...) -> DataFrame:
    """Each row of ``probes`` with the version of its key in force at its time
    ``at`` (C7 for a table of times): the probe's columns, then the history's
    columns other than the keys under ``prefix``, NULL where no version was.

    Versions and probes are one table sorted by key and time, in which a probe
    takes the last version before it (a sweep, no range join): one exchange,
    one sort. Keys with more than ``max_rows_per_segment`` rows are cut into
    ranges of time as in ``scd2``; a range starts with the last version of
    those before it. A probe with a NULL key or time finds nothing."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = [c for c in history.columns if c not in keys]
    time = history.schema[valid_from].dataType
    version, probe = F.struct(*values), F.struct(*probes.columns)
    typed = {k: history.schema[k].dataType for k in keys}
    rows = (history.select(*keys, F.col(valid_from).alias("_t"), F.lit(0).alias("_probes"), version.alias("_v"))
            .unionByName(probes.select(*[F.col(k).cast(t).alias(k) for k, t in typed.items()], F.col(at).cast(time).alias("_t"),
                                       F.lit(1).alias("_probes"), probe.alias("_p")), allowMissingColumns=True))
    if plan is ...:
        plan = plan_segments(rows, keys, "_t", max_rows_per_segment)
    segmented = plan is not None and plan.hot_plan is not None
    part = [KEY, SEG] if segmented else [*keys, SEG]
    rows = _assign_segments(rows, keys, "_t", plan)
    so_far = Window.partitionBy(*part).orderBy("_t", "_probes").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = rows.withColumn("_f", F.last("_v", ignorenulls=True).over(so_far))
    if segmented:
        last = rows.filter(HOT).groupBy(KEY, SEG).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_t"))).alias("_last"))
        before = Window.partitionBy(KEY).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
        carried = last.select(KEY, SEG, F.last("_last", ignorenulls=True).over(before).alias("_carry"))
        swept = swept.join(carried, part, "left").withColumn("_f", F.coalesce("_f", "_carry"))
    to = F.col("_f")[valid_to]
    known = F.col("_t").isNotNull() & F.col("_f").isNotNull() & (to.isNull() | (F.col("_t") < to))
    for k in keys:
        known = known & F.col(k).isNotNull()
    found = swept.filter(F.col("_probes") == 1)
    return found.select(*[F.col("_p")[c].alias(c) for c in probes.columns], *[F.when(known, F.col("_f")[c]).alias(prefix + c) for c in values])
