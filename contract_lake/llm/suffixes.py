"""Repeated-window removal by a depth-limited, most-significant-digit radix
sort of suffixes.

Suffixes are ordered only through ``window`` bytes, so a group of suffixes that
stays together to the end is exactly one repeated window. The digits are not
single bytes but ranges of the window, taken from the most telling one on:

1. the gram of the window's anchor (the least gram hash in it, see
   ``windows.window_anchors``) and its place in the window,
2. the bytes that all windows of an aligned block of 32, then of 8, share,
3. the whole window.

Each range holds the one before it, so a pass splits the groups so far by
further bytes and never joins two of them.

Texts are taken once each: copies are found by a count of their names, one row
of a copied text stands for all with a weight of two, and a copied text itself
is repeated from end to end. So a text's runs are bounded by its own length,
however many copies there are.

Windows of one anchor are neighbours, so a pass handles a *run* of them as one
row. After each pass a run whose digit occurs once leaves (none of its windows
repeats), a run whose whole byte range occurs elsewhere leaves as repeated,
and only the rest is cut finer for the next pass: the edges of copied
passages. A pass is one combinable count by digit and a join back, so a digit
held by a third of all rows is counted map-side and its rows are never
gathered in one task; the ``HEAVY`` most frequent kinds of runs are told apart
without a join. Counts are of whole texts over all documents; nothing is
capped. Digits are 64-bit hashes; a run counts as repeated only where digit
and whole-range hash both agree (128 bits).

Null texts count as empty, texts shorter than a window are kept whole,
repeated rows are copies of each other (each loses all its windows). Very long
texts are hashed in segments. Columns other than ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map, batch_of, byte_views, written
from contract_lake.llm.windows import RangeHashes, mixed, window_anchors
from contract_lake.session import work_dir

GRAM, BLOCKS = 50, (32, 8, 1)
#: Windows hashed at a time; texts are joined up to it or cut at it.
SEGMENT = 1 << 17
ROWS = pa.schema([("digit", pa.int64()), ("whole", pa.int64()), ("key", pa.binary()), ("place", pa.int64()), ("copies", pa.int32())])
#: The most frequent kinds of a pass, marked from a list.
HEAVY = 1024
#: 64-bit words of the bitmap that thins rows before a shuffle: 8 MB at any scale.
BITMAP_WORDS = 1 << 20


def pack(first: np.ndarray, back: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A run of windows in one long: first window, distance from it to the
    anchor, number of windows (both under 256)."""
    return first << 16 | back << 8 | count - 1


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 16, place >> 8 & 255, (place & 255) + 1


def _whole(hashes: RangeHashes, first, last, back, window: int) -> np.ndarray:
    """Hash of all bytes of a run, and of how its anchor lies in it."""
    return mixed(hashes.of(first, last + window, 1) + (back * 512 + last - first).astype(np.uint64))


def _pieces(views: list[np.ndarray], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined into arrays of about SEGMENT bytes: (bytes, start of each
    part in the array, row of each part, its offset in its text). A longer
    text comes in parts of SEGMENT windows."""
    held: list[np.ndarray] = []
    rows: list[int] = []
    offsets: list[int] = []
    size = 0
    for row, view in enumerate(views):
        for at in range(0, max(1, len(view) - window + 1), SEGMENT):
            part = view[at:at + SEGMENT + window - 1]
            if len(part) < window:
                continue
            if held and size + len(part) > SEGMENT:
                yield np.concatenate(held), np.cumsum([0, *map(len, held)]), np.array(rows), np.array(offsets)
                held, rows, offsets, size = [], [], [], 0
            held.append(part)
            rows.append(row)
            offsets.append(at)
            size += len(part)
    if held:
        yield np.concatenate(held), np.cumsum([0, *map(len, held)]), np.array(rows), np.array(offsets)


def anchor_runs(views: list[np.ndarray], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(digit, whole, row, place) of every run of the first pass."""
    for octets, starts, rows, offsets in _pieces(views, window):
        hashes = RangeHashes(octets)
        anchor, first, last, gram = window_anchors(hashes, window, GRAM, starts)
        part = np.searchsorted(starts, first, side="right") - 1
        whole = _whole(hashes, first, last, anchor - first, window)
        yield (gram.view(np.int64), whole.view(np.int64), rows[part],
               pack(first - starts[part] + offsets[part], anchor - first, last - first + 1))


def finer_runs(views: list[np.ndarray], pending: list[np.ndarray], block: int, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The pending runs of each text cut at multiples of ``block`` windows
    before the anchor: (digit, whole, row, place). The digit is the bytes that
    all windows of a whole block share, so runs cut short by their
    surroundings still meet."""
    lists = dict(enumerate(pending))
    for octets, starts, rows, offsets in _pieces(views, window):
        hashes = RangeHashes(octets)
        parts = []
        for part, (row, offset) in enumerate(zip(rows.tolist(), offsets.tolist(), strict=True)):
            first, back, count = unpack(lists[row])
            here = (first >= offset) & (first < offset + SEGMENT)
            parts.append(np.stack([np.full(here.sum(), part), first[here] - offset + starts[part], back[here], count[here]]))
        part, first, back, count = np.concatenate(parts, axis=1)
        if not len(part):
            continue
        low, high = (back - count + 1) // block, back // block  # blocks by distance to the anchor
        n = high - low + 1
        at = np.repeat(np.arange(len(part)), n)
        number = high[at] - (np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n))
        anchor = (first + back)[at]
        begin = np.maximum(anchor - (number + 1) * block + 1, first[at])
        end = np.minimum(anchor - number * block, (first + count - 1)[at])
        shared = hashes.of(anchor - number * block, anchor - (number + 1) * block + 1 + window)
        digit = mixed(shared + number.astype(np.uint64))
        whole = _whole(hashes, begin, end, anchor - begin, window)
        yield (digit.view(np.int64), whole.view(np.int64), rows[part[at]],
               pack(begin - starts[part[at]] + offsets[part[at]], anchor - begin, end - begin + 1))


def _key():
    """A text's name: 128 bits of it."""
    return F.unhex(F.md5("text"))


def _bitmap(df: DataFrame, hashed) -> np.ndarray:
    """A fixed-size bitmap of the values of ``hashed`` (a long expression): a
    value not in ``df`` is mostly absent, one in it never. Rows that pass
    wrongly cost time only; 8 MB reach the driver at any scale."""
    at = df.select(F.pmod(hashed, F.lit(64 * BITMAP_WORDS)).alias("h"))
    words = (at.groupBy(F.shiftright("h", 6).cast("int").alias("i"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(h & 63 AS INT))")).alias("w")).toArrow())
    out = np.zeros(BITMAP_WORDS, np.uint64)
    out[words.column("i").to_numpy()] = words.column("w").to_numpy().view(np.uint64)
    return out


def _in_bitmap(words: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    h = hashed & np.int64(64 * BITMAP_WORDS - 1)
    return (words[h >> 6] >> (h & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def _sorted_out(runs: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeated, pending): (key, place, copies) of runs found repeated and of
    those to cut finer. ``counts`` holds the digits that occur at least twice."""
    name = F.xxhash64("key", "place")
    runs = written(runs.join(counts, "digit"), "suffix-runs")
    several = runs.where("several")
    # Written, as the counts are: a join of two plain exchanges can split a hot digit.
    kinds = written(several.groupBy("digit", "whole").agg(F.sum("weight").alias("n"), F.min(name).alias("first")).where("n > 1"), "suffix-kinds")
    heavy = kinds.orderBy(F.desc("n"), "digit", "whole").limit(HEAVY).collect()  # three longs each

    def among(column: str, values) -> str:
        return f"{column} IN ({', '.join(f'{v}L' if v > -2**63 else 'CAST(-9223372036854775808 AS LONG)' for v in set(values))})"

    columns = ["key", "place", "copies"]
    # All of a kind's bytes have one digit, so its two hashes need not be paired.
    is_heavy = F.expr(f"{among('digit', [k.digit for k in heavy])} AND {among('whole', [k.whole for k in heavy])}") if heavy else F.lit(False)
    stands = F.expr(among("xxhash64(key, place)", [k.first for k in heavy])) if heavy else F.lit(False)
    light = several.where(~is_heavy).join(kinds.where(~is_heavy), ["digit", "whole"], "left")
    repeated = (runs.where("not several").select(columns).union(several.where(is_heavy).select(columns))
                .union(light.where("first IS NOT NULL").select(columns)))
    # Of equal runs one stands for all against the runs that share a part.
    pending = (several.where(is_heavy & stands).select(columns)
               .union(light.where(F.col("first").isNull() | (name == F.col("first"))).select(columns)))
    return repeated, pending


def _digit_counts(runs: DataFrame) -> DataFrame:
    return written(runs.groupBy("digit").agg(F.sum("weight").alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high"))
                   .where("n > 1").select("digit", (F.col("low") != F.col("high")).alias("several")), "suffix-digits")


def distinct_texts(docs: DataFrame, window: int):
    """Rows ``key``, ``text``, ``h``, ``copies`` of the texts of a window or
    more, a function that leaves each text of a batch of them once, ``copies``
    being 1 or 2 (for two or more), and ``key``, ``text`` of those with 2.
    Texts whose name is in the bitmap of copied names are shuffled and come
    with their ``copies``; the others are not, theirs is null. The function is
    for the pass that uses the texts: one in a pass of its own would hold as
    many Python workers again."""
    spark = docs.sparkSession
    texts = docs.select(_key().alias("key"), F.col("text").cast("string")).where(F.octet_length("text") >= window).withColumn("h", F.xxhash64("key"))
    again = texts.groupBy("key", "h").agg(F.count("*").alias("n")).where("n > 1")
    bitmap = spark.sparkContext.broadcast(_bitmap(again, F.col("h")))

    def copied(batches):
        for batch in batches:
            kept = _in_bitmap(bitmap.value, batch.column("h").to_numpy())
            if kept.any():
                yield batch.filter(pa.array(kept)).select(["key", "text"])

    held = written(arrow_map(texts, copied, "key binary, text string").groupBy("key")
                   .agg(F.first("text").alias("text"), F.least(F.count("*"), F.lit(2)).cast("int").alias("copies")), "suffix-copied")

    def once(batches):
        for batch in batches:
            kept = batch.column("copies").is_valid().to_numpy(zero_copy_only=False) | ~_in_bitmap(bitmap.value, batch.column("h").to_numpy())
            if kept.any():
                batch = batch.filter(pa.array(kept))
                at = batch.schema.get_field_index("copies")
                yield batch.set_column(at, batch.schema.field(at), batch.column(at).fill_null(1))

    rows = texts.withColumn("copies", F.lit(None).cast("int")).union(held.select("key", "text", F.xxhash64("key").alias("h"), "copies"))
    return rows, once, held.where("copies = 2")


def repeated_spans(docs: DataFrame, window: int = 200) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``key``, ``places`` (runs of repeated windows, see ``pack``) of each
    text that has any and no copies; the table ``key``, ``text`` of the texts
    that may have some, bucketed by key; and the texts that have copies."""
    if not GRAM + 1 <= window <= GRAM + 206:
        raise ValueError(f"windows of {GRAM + 1} to {GRAM + 206} bytes are served")
    spark = docs.sparkSession
    texts, once, copied = distinct_texts(docs, window)
    digit_rows = pa.schema([ROWS.field("digit"), ROWS.field("whole"), ROWS.field("copies")])

    def digits(batches):
        for batch in once(batches):
            copies = batch.column("copies").to_numpy()
            for digit, whole, row, _ in anchor_runs(list(byte_views(batch.column("text"))), window):
                yield batch_of(digit_rows, digit, whole, copies[row])

    weighted = F.col("copies").cast("long")
    counts = _digit_counts(arrow_map(texts.select("text", "h", "copies"), digits, "digit long, whole long, copies int").withColumn("weight", weighted))
    bitmap = spark.sparkContext.broadcast(_bitmap(counts, F.col("digit")))

    def runs(batches):
        for batch in once(batches):
            keys, copies = np.array(batch.column("key").to_pylist(), object), batch.column("copies").to_numpy()
            for digit, whole, row, place in anchor_runs(list(byte_views(batch.column("text"))), window):
                kept = _in_bitmap(bitmap.value, digit)
                if kept.any():
                    yield batch_of(ROWS, digit[kept], whole[kept], keys[row[kept]], place[kept], copies[row[kept]])

    schema = "digit long, whole long, key binary, place long, copies int"
    repeated, pending = _sorted_out(arrow_map(texts, runs, schema).withColumn("weight", weighted), counts)
    # A copied text is repeated throughout: its runs matter to others only.
    repeated, pending = written(repeated.where("copies = 1"), "suffix-repeated"), written(pending, "suffix-pending")
    found = [repeated]

    # Texts with any repeated digit, in buckets by key: later passes read them without a shuffle.
    touched = spark.sparkContext.broadcast(_bitmap(repeated.union(pending).select("key").distinct(), F.xxhash64("key")))

    def affected(batches):
        for batch in once(batches):
            kept = _in_bitmap(touched.value, batch.column("h").to_numpy())
            if kept.any():
                yield batch.filter(pa.array(kept)).select(["key", "text", "copies"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = work_dir(spark, "suffix_texts").rsplit("/", 1)[1].replace("-", "_")
    (arrow_map(texts, affected, "key binary, text string, copies int").repartition(n, "key")
     .write.bucketBy(n, "key").option("path", work_dir(spark, "suffix-texts")).saveAsTable(name))
    held = spark.table(name)

    for block in BLOCKS:
        def cut(batches, block=block):
            for batch in batches:
                keys, copies = np.array(batch.column("key").to_pylist(), object), batch.column("copies").to_numpy()
                lists = [np.asarray(x, np.int64) for x in batch.column("places").to_pylist()]
                for digit, whole, row, place in finer_runs(list(byte_views(batch.column("text"))), lists, block, window):
                    yield batch_of(ROWS, digit, whole, keys[row], place, copies[row])

        # Texts are distinct, so a list is bounded by its text.
        listed = pending.groupBy("key").agg(F.collect_list("place").alias("places"))
        cutting = written(arrow_map(held.join(listed, "key"), cut, schema).withColumn("weight", F.lit(1)), "suffix-cut")
        repeated, pending = _sorted_out(cutting, _digit_counts(cutting))
        if block > 1:
            pending = written(pending, "suffix-pending")
        found.append(repeated.where("copies = 1"))
    places = found[0]
    for more in found[1:]:
        places = places.union(more)
    return places.groupBy("key").agg(F.collect_list("place").alias("places")), held.drop("copies"), copied


def covered(n: int, places: np.ndarray, window: int) -> tuple[np.ndarray, int]:
    """Which of ``n`` bytes lie in a window of ``places``; number of spans."""
    first, _, count = unpack(places)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + count - 1 + window, -1)
    mask = np.cumsum(steps[:n]) > 0
    return mask, int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())


def _cleaned(docs: DataFrame, window: int, schema: str, finish) -> DataFrame:
    """``finish(view, mask, spans)`` of every text with a repeated window, by key."""
    places, held, copied = repeated_spans(docs, window)
    names = pa.schema([("key", pa.binary()), *({"long": (f, pa.int64()), "string": (f, pa.string())}[t] for f, t in (x.split() for x in schema.split(", ")))])

    def clean(batches):
        for batch in batches:
            out = []
            for view, places in zip(byte_views(batch.column("text")), batch.column("places").to_pylist(), strict=True):
                # no places: a copied text, all of it repeated
                mask, spans = (np.ones(len(view), bool), 1) if places is None else covered(len(view), np.asarray(places, np.int64), window)
                out.append(finish(view, mask, spans))
            if out:
                yield batch_of(names, batch.column("key").to_pylist(), *zip(*out, strict=True))

    cleaned = arrow_map(held.join(places, "key"), clean, f"key binary, {schema}")
    whole = arrow_map(copied.select("key", "text", F.lit(None).cast("array<long>").alias("places")), clean, f"key binary, {schema}")
    return written(cleaned.union(whole), "suffix-clean")


def dedup_report(docs: DataFrame, window: int = 200) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``
    for each row of ``docs``."""
    def finish(view, mask, spans):
        return int(mask.sum()), spans, hashlib.sha256(view[~mask].tobytes()).hexdigest()

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cleaned = _cleaned(docs, window, "n_removed long, n_spans long, kept string", finish)
    rows = docs.select(F.col("doc_id").cast("long"), _key().alias("key"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.sha2(text, 256).alias("sha"))
    return rows.join(cleaned, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept", "sha").alias("kept_sha256"))


def dedup_texts(docs: DataFrame, window: int = 200) -> DataFrame:
    """``docs`` without the repeated windows (bytes cut out of a character go
    with what is left of it); other columns as they are."""
    def finish(view, mask, spans):
        return (view[~mask].tobytes().decode("utf-8", "ignore"),)

    cleaned = _cleaned(docs, window, "kept string", finish).withColumnRenamed("key", "text_key")
    return (docs.withColumn("text_key", _key()).join(cleaned, "text_key", "left")
            .withColumn("text", F.coalesce("kept", "text")).select(*docs.columns))
