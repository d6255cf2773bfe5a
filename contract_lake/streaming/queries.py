"""Registered queries that run through Structured Streaming.

Each writes the event documents (derived from the whole ``events`` table) as
JSON lines under a fresh folder of the shared work root, streams them with an
``availableNow`` trigger in several micro-batches, and reads the result back
as a batch DataFrame. Their oracles are those of the batch twins.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..contract import Contract, Property, read_schema
from ..operators import drift
from ..operators.features import tag_changes
from ..plans import fixtures as fx
from ..plans import flows
from ..session import work_dir
from ..sinks.files import write_changeset
from ..sources.documents import stream_features, stream_variant
from . import ingest, merge, unique

FILES_PER_TRIGGER = 4


def _write_docs(spark, sf) -> str:
    return fx.write_event_documents(fx.table(spark, sf, "events"), work_dir(spark, "docs"))


def q_stream_explode(spark, sf):
    """S1-S4 + P1/P2: stream documents, explode, project; parquet sink."""
    src = _write_docs(spark, sf)
    out = work_dir(spark, "stream_explode")
    docs = stream_features(spark, src, read_schema(fx.EVENTS_ENTRY.properties),
                           max_files=FILES_PER_TRIGGER, multi_line=False)
    staged = flows.stage(docs, fx.EVENTS_ENTRY, with_stamp=True)
    query = staged.writeStream.format("parquet").option("checkpointLocation", out + "/_checkpoint") \
        .trigger(availableNow=True).start(out + "/data")
    query.awaitTermination()
    return spark.read.parquet(out + "/data").select(*fx.EVENTS_ENTRY.property_names)


def q_scd2_stream(spark, sf):
    """X1 on a stream: landing log (K1/K2) + history view."""
    src = _write_docs(spark, sf)
    root = work_dir(spark, "scd2_stream")
    paths = ingest.EntryPaths(source=src, landing=root + "/landing", checkpoint=root + "/_checkpoint")
    ingest.run_entry(spark, fx.EVENTS_ENTRY, paths, max_files=FILES_PER_TRIGGER, multi_line=False)
    hist = ingest.history_from_landing(spark, fx.EVENTS_ENTRY, paths.landing, track=["event_type"])
    return hist.select("user_id", "feature_id", "event_type", "value", "k",
                       "valid_from", "valid_to", "is_current")


def q_scd2_compacted(spark, sf):
    """K1 + compaction + C8: stream into the landing log, compact its valid
    rows into a table bucketed by key, build history from the table."""
    import uuid
    src = _write_docs(spark, sf)
    root = work_dir(spark, "scd2_compacted")
    paths = ingest.EntryPaths(source=src, landing=root + "/landing", checkpoint=root + "/_checkpoint")
    ingest.run_entry(spark, fx.EVENTS_ENTRY, paths, max_files=FILES_PER_TRIGGER, multi_line=False)
    table = f"events_history_{uuid.uuid4().hex[:12]}"
    ingest.compact_landing(spark, fx.EVENTS_ENTRY, paths.landing, table, 16, path=root + "/compacted")
    hist = ingest.history_from_table(spark, fx.EVENTS_ENTRY, table, path=root + "/compacted",
                                     track=["event_type"])
    return hist.select("user_id", "feature_id", "event_type", "value", "k",
                       "valid_from", "valid_to", "is_current")


def _paths(spark, src, name) -> ingest.EntryPaths:
    root = work_dir(spark, name)
    return ingest.EntryPaths(source=src, landing=root + "/landing", checkpoint=root + "/_checkpoint",
                             history=root + "/history", history_checkpoint=root + "/_history_checkpoint")


HISTORY_COLS = ["user_id", "feature_id", "event_type", "value", "k", "valid_from", "valid_to", "is_current"]


def q_scd2_maintained(spark, sf):
    """C8 as a maintained table: landing stream in micro-batches of two files,
    beside it an upkeep stream of as many batches, each merged into the stored
    versions of its keys."""
    src = fx.write_event_layouts(fx.table(spark, sf, "events"), work_dir(spark, "docs"), ("one_line",), per_doc=1024)
    paths = _paths(spark, src, "scd2_maintained")
    landing = ingest.run_entry(spark, fx.EVENTS_ENTRY, paths, max_files=2, wait=False)
    merge.merge_beside(landing, spark, fx.EVENTS_ENTRY, paths.landing, paths.history, paths.history_checkpoint,
                       track=["event_type"], max_files=2)
    return merge.read_merged(spark, fx.EVENTS_ENTRY, paths.history, track=["event_type"]).select(*HISTORY_COLS)


def q_scd2_maintained_deletes(spark, sf):
    """C8 + C4: a second delivery deletes every row of every fifth user at
    its own sequence; their versions go, buckets with no one else are empty."""
    ev = fx.table(spark, sf, "events")
    src = fx.write_event_documents(ev, work_dir(spark, "docs") + "/a")
    paths = _paths(spark, src.rsplit("/", 1)[0] + "/*", "scd2_maintained_deletes")
    for more in (None, ev.filter("user_id % 5 = 0").withColumn("event_type", F.lit("gone"))):
        if more is not None:
            fx.write_event_documents(more, src.rsplit("/", 1)[0] + "/b")
        ingest.run_entry(spark, fx.EVENTS_ENTRY, paths, multi_line=False)
        ingest.maintain_history(spark, fx.EVENTS_ENTRY, paths.landing, paths.history, paths.history_checkpoint, n_buckets=64,
                                track=["event_type"], delete_when="event_type = 'gone'").awaitTermination()
    return ingest.read_history(spark, paths.history).select(*HISTORY_COLS)


CHANGE_ENTRY = replace(fx.EVENTS_ENTRY, sequence_by=None, properties=(
    *[p for p in fx.EVENTS_ENTRY.properties if p.name != "ts"], Property("change", "feature.properties.__change__", "string")))


def q_changeset_roundtrip(spark, sf):
    """P11 + K5 + S2: tag every feature, write the documents as a changeset
    and stream it back with the defaults."""
    docs = tag_changes(fx.event_documents(fx.table(spark, sf, "events"), props_as_object=True).select("features"), "UPDATE")
    src = write_changeset(docs, work_dir(spark, "changesets"))
    paths = _paths(spark, src, "changeset_roundtrip")
    ingest.run_entry(spark, CHANGE_ENTRY, paths)
    return ingest.read_landing(spark, paths.landing, 1, CHANGE_ENTRY).select("feature_id", "user_id", "event_type", "value", "k", "change")


def q_stream_whole_files(spark, sf):
    """S1-S3 with the reference's settings: indented files read whole, one
    file a micro-batch; history from the landing log."""
    src = fx.write_event_layouts(fx.table(spark, sf, "events"), work_dir(spark, "whole_files"), ("indented",))
    paths = _paths(spark, src, "stream_whole_files")
    ingest.run_entry(spark, fx.EVENTS_ENTRY, paths, max_files=1)
    return ingest.history_from_landing(spark, fx.EVENTS_ENTRY, paths.landing, track=["event_type"]).select(*HISTORY_COLS)


def q_collection_lines_mixed(spark, sf):
    """Collections in four layouts read line by line. Every feature is
    landed, but those printed over several lines: theirs are in quarantine."""
    src = fx.write_event_layouts(fx.table(spark, sf, "events"), work_dir(spark, "mixed"), ("pairs", "inline", "one_line", "indented"), per_doc=256)
    paths = _paths(spark, src, "collection_lines_mixed")
    ingest.run_entry(spark, fx.EVENTS_ENTRY, paths, collection_lines=True)
    good = ingest.read_landing(spark, paths.landing, 1, fx.EVENTS_ENTRY).select("feature_id", F.lit("landed").alias("status"))
    line = F.regexp_extract("_corrupt_record", r'^"id"\s*:\s*"([^"]*)"$', 1)
    bad = ingest.quarantine_from_landing(spark, paths.landing).select(line.alias("feature_id"), F.lit("quarantined").alias("status"))
    return good.union(bad.filter("feature_id <> ''"))


TIMELESS_ENTRY = replace(fx.EVENTS_ENTRY, key="doc_key", sequence_by=None, properties=(
    Property("doc_key", "feature.properties.doc_key", "string"), Property("feature_id", "feature.id", "string"),
    Property("event_type", "feature.properties.event_type", "string"), Property("value", "feature.properties.value", "double")))


def q_scd2_processing_time(spark, sf):
    """C3 without a business sequence: all rows of a micro-batch share its
    time, so a key's last row in its file wins, whichever reader read it."""
    src = fx.write_event_layouts(fx.table(spark, sf, "events"), work_dir(spark, "timeless"), ("lines",))
    out = []
    for reader, how in (("whole", {}), ("lines", {"collection_lines": True})):
        paths = _paths(spark, src, f"scd2_processing_time_{reader}")
        ingest.run_entry(spark, TIMELESS_ENTRY, paths, **how)
        hist = ingest.history_from_landing(spark, TIMELESS_ENTRY, paths.landing)
        out.append(hist.select(F.lit(reader).alias("reader"), "doc_key", "feature_id", "event_type", "value", "is_current"))
    return out[0].union(out[1])


def q_stream_evolved_contract(spark, sf):
    """S5 + K1: the even users' documents are landed before ``value`` and
    ``k`` are added to the contract, the odd users' after."""
    ev = fx.table(spark, sf, "events")
    root = work_dir(spark, "evolving")
    paths = _paths(spark, root + "/*", "stream_evolved_contract")
    before = replace(fx.EVENTS_ENTRY, properties=tuple(p for p in fx.EVENTS_ENTRY.properties if p.name not in ("value", "k")))
    for half, entry in ((0, before), (1, fx.EVENTS_ENTRY)):
        fx.write_event_documents(ev.filter(F.col("user_id") % 2 == half), f"{root}/half{half}")
        ingest.run_entry(spark, entry, paths, multi_line=False)
    return ingest.history_from_landing(spark, fx.EVENTS_ENTRY, paths.landing, track=["event_type"]).select(*HISTORY_COLS)


def q_run_all_history(spark, sf):
    """Two entries through the gate into landing logs and history tables."""
    source, output = work_dir(spark, "run_in"), work_dir(spark, "run_out")
    fx.write_event_documents(fx.table(spark, sf, "events"), f"{source}/events")
    fx.write_keyed_documents(fx.table(spark, sf, "documents"), f"{source}/documents")
    contract = Contract(entries=(replace(fx.EVENTS_ENTRY, track=("event_type",)), fx.DOCUMENTS_ENTRY))
    ingest.run_all(spark, contract, source, output, multi_line=False, history_buckets=16)
    events, documents = (ingest.read_history(spark, ingest.paths_for(e, source, output).history) for e in contract.entries)
    return events.select(F.lit("events").alias("entry"), F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("label"), "feature_id", "is_current") \
        .union(documents.select(F.lit("documents").alias("entry"), F.col("feature_id").alias("key"), F.col("lang").alias("label"), "feature_id", "is_current"))


def q_stream_lines_history(spark, sf):
    """S1 for large deliveries: one feature per line, read split across
    tasks with no explode, landed, history built from the log."""
    src = fx.write_event_feature_lines(fx.table(spark, sf, "events"), work_dir(spark, "feature_lines"))
    root = work_dir(spark, "stream_lines")
    paths = ingest.EntryPaths(source=src, landing=root + "/landing", checkpoint=root + "/_checkpoint")
    ingest.run_entry(spark, fx.EVENTS_ENTRY, paths, max_files=FILES_PER_TRIGGER, feature_lines=True)
    hist = ingest.history_from_landing(spark, fx.EVENTS_ENTRY, paths.landing, track=["event_type"])
    return hist.select("user_id", "feature_id", "event_type", "value", "k",
                       "valid_from", "valid_to", "is_current")


def q_stream_collection_lines(spark, sf):
    """S1 for large FeatureCollection files: collections written one feature
    per line are read line by line, split across tasks, landed, and history
    is built from the log."""
    src = fx.write_event_collection_lines(fx.table(spark, sf, "events"), work_dir(spark, "collection_lines"))
    root = work_dir(spark, "stream_collection_lines")
    paths = ingest.EntryPaths(source=src, landing=root + "/landing", checkpoint=root + "/_checkpoint")
    ingest.run_entry(spark, fx.EVENTS_ENTRY, paths, max_files=FILES_PER_TRIGGER, collection_lines=True)
    hist = ingest.history_from_landing(spark, fx.EVENTS_ENTRY, paths.landing, track=["event_type"])
    return hist.select("user_id", "feature_id", "event_type", "value", "k",
                       "valid_from", "valid_to", "is_current")


def q_stream_quarantine(spark, sf):
    """K2: the quarantine partition of a streamed landing log (documents
    whose key is NULL, empty or blank)."""
    src = fx.write_keyed_documents(fx.table(spark, sf, "documents"), work_dir(spark, "keyed_docs"))
    root = work_dir(spark, "stream_quarantine")
    paths = ingest.EntryPaths(source=src, landing=root + "/landing", checkpoint=root + "/_checkpoint")
    ingest.run_entry(spark, fx.DOCUMENTS_ENTRY, paths, max_files=FILES_PER_TRIGGER, multi_line=False)
    return ingest.quarantine_from_landing(spark, paths.landing) \
        .select("feature_id", "doc_id", "lang", "source", "validation_rule_failed", "validation_rule_name",
                (F.col("processing_timestamp").isNotNull() & F.col("quarantine_timestamp").isNotNull()).alias("stamped"))


def q_ingest_counts(spark, sf):
    """Rows in / passed / failed per micro-batch, summed per count."""
    src = _write_docs(spark, sf)
    root = work_dir(spark, "ingest_counts")
    paths = ingest.EntryPaths(source=src, landing=root + "/landing", checkpoint=root + "/_checkpoint")
    ingest.run_entry(spark, fx.EVENTS_ENTRY, paths, max_files=FILES_PER_TRIGGER, multi_line=False)
    metrics = ingest.batch_metrics(spark, paths.landing)
    return metrics.groupBy("metric_name").agg(F.sum("value").cast("long").alias("total"))


def q_stream_unique(spark, sf):
    """Q5 ``unique`` on a stream: orders arrive in files, two a micro-batch,
    and the query is started again for the second delivery; every order whose
    (customer, date) repeats, and whether it was the first of them."""
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    root = work_dir(spark, "stream_unique")
    keys = ["o_custkey", "o_orderdate"]
    for half in (0, 1):
        orders.filter(F.col("o_orderkey") % 2 == half).repartitionByRange(6, "o_orderkey").write.parquet(f"{root}/orders/half{half}")
        stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/orders/*")
        unique.track_unique(stream, keys, "o_orderkey", f"{root}/repeated", f"{root}/_checkpoint").awaitTermination()
    return unique.repeated_rows(orders, unique.read_repeated(spark, keys, f"{root}/repeated"), keys, "o_orderkey")


def q_variant_projection(spark, sf):
    """S5 + P3 (variant form): documents streamed as one VARIANT column,
    exploded and projected by the contract through ``try_variant_get``."""
    from ..operators.features import variant_features
    src = _write_docs(spark, sf)
    out = work_dir(spark, "variant_projection")
    docs = variant_features(stream_variant(spark, src, max_files=FILES_PER_TRIGGER, multi_line=False))
    staged = flows.stage(docs, fx.EVENTS_ENTRY, with_stamp=False)
    query = staged.writeStream.format("parquet").option("checkpointLocation", out + "/_checkpoint") \
        .trigger(availableNow=True).start(out + "/data")
    query.awaitTermination()
    return spark.read.parquet(out + "/data").select(*fx.EVENTS_ENTRY.property_names)


def q_variant_drift(spark, sf):
    """Documents streamed as one VARIANT column; drift of the feature
    properties against the fields the contract reads."""
    src = _write_docs(spark, sf)
    out = work_dir(spark, "variant_docs")
    stream = stream_variant(spark, src, max_files=FILES_PER_TRIGGER, multi_line=False)
    query = stream.writeStream.format("parquet").option("checkpointLocation", out + "/_checkpoint") \
        .trigger(availableNow=True).start(out + "/data")
    query.awaitTermination()
    docs = spark.read.parquet(out + "/data")
    props = docs.select(F.explode(F.variant_get("doc", "$.features", "array<variant>")).alias("f")) \
                .select(F.variant_get("f", "$.properties", "variant").alias("p"))
    prefix = "feature.properties."
    known = sorted({p.source_path[len(prefix):].split(".")[0] for p in fx.EVENTS_ENTRY.properties
                    if p.source_path and p.source_path.startswith(prefix)} - {"value"})
    return drift.schema_drift(props, "p", known)


def queries():
    return {"stream_explode": q_stream_explode, "scd2_stream": q_scd2_stream,
            "scd2_compacted": q_scd2_compacted, "scd2_maintained": q_scd2_maintained,
            "scd2_maintained_deletes": q_scd2_maintained_deletes, "changeset_roundtrip": q_changeset_roundtrip,
            "stream_whole_files": q_stream_whole_files, "collection_lines_mixed": q_collection_lines_mixed,
            "scd2_processing_time": q_scd2_processing_time, "stream_evolved_contract": q_stream_evolved_contract,
            "run_all_history": q_run_all_history,
            "stream_lines_history": q_stream_lines_history,
            "stream_collection_lines": q_stream_collection_lines,
            "stream_quarantine": q_stream_quarantine, "ingest_counts": q_ingest_counts,
            "stream_unique": q_stream_unique,
            "variant_drift": q_variant_drift, "variant_projection": q_variant_projection}
