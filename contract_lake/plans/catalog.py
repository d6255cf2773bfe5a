"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads whole driver tables (or data Spark derives from them) and
returns a DataFrame; every computed column is aliased to the same name in the
oracle. Queries marked stream write derived documents under the shared work
folder, run a Structured Streaming query to completion (``availableNow``),
and read the result back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Property, read_schema
from ..functions.columns import validity_rule
from ..operators import cdc, drift, files, observe, quality
from ..operators.features import explode_features, flatten_features, tag_changes
from ..operators.projection import project_by_contract
from ..session import work_dir
from ..sinks.files import write_log_rows, write_metrics
from ..sources.documents import read_features, stream_features
from ..sources.manifest import empty_manifest, scan_manifest
from ..sources.opslog import read_logs, read_metrics
from . import fixtures as fx
from . import flows

Query = Callable[[SparkSession, str], DataFrame]

AS_OF_EVENTS = "2024-01-15 12:00:00"
AS_OF_ORDERS = "1998-01-01 00:00:00"
METRIC_TIME = "2024-02-01 00:00:00"
EXPECTED_SOURCES = [f"src{i}" for i in range(25)]
BUCKETS = 16


# ---- feature documents -----------------------------------------------------

def q_explode_features(spark, sf):
    docs = fx.event_documents(fx.table(spark, sf, "events"))
    rows = explode_features(docs, keep=["doc_user"])
    return rows.select("doc_user", F.col("feature.id").alias("id"),
                       F.col("feature.properties.event_type").alias("event_type"),
                       F.col("feature.properties.ts").alias("ts"),
                       F.col("feature.properties.value").alias("value"))


def q_flatten_features(spark, sf):
    flat = flatten_features(fx.event_documents(fx.table(spark, sf, "events")))
    return flat.select("id", "type", F.element_at("coordinates", 1).alias("x"),
                       F.element_at("coordinates", 2).alias("y"),
                       "user_id", "event_type", "ts", "value", "props")


def q_contract_projection(spark, sf):
    docs = fx.event_documents(fx.table(spark, sf, "events"))
    staged = flows.stage(docs, fx.EVENTS_ENTRY, with_stamp=False)
    return staged.select(*fx.EVENTS_ENTRY.property_names)


TYPED_PROPERTIES = (
    Property("user_id", "feature.properties.user_id", "long"),
    Property("value_double", "feature.properties.value", "double"),
    Property("value_float", "feature.properties.value", "FLOAT"),
    Property("value_int", "feature.properties.value", "integer"),
    Property("k", "feature.properties.props.k", "integer"),
    Property("k_long", "feature.properties.props.k", "Long"),
    Property("is_error", "feature.properties.is_error", "boolean"),
    Property("event_type", "feature.properties.event_type", "varchar"),
    Property("event_type_default", "feature.properties.event_type", None),
    Property("absent", "feature.properties.not_there", "integer"),
    Property("no_source", None, "double"),
)


def q_typed_casts(spark, sf):
    """P4 on JSON numbers and booleans as a file delivers them; fractions are
    cut off for integers, as the reference's cast of inferred numbers does."""
    path = fx.write_typed_documents(fx.table(spark, sf, "events"), work_dir(spark, "typed_docs"))
    docs = stream_features(spark, path, read_schema(TYPED_PROPERTIES), multi_line=False, streaming=False)
    feats = explode_features(docs, keep=[])
    out = project_by_contract(feats, TYPED_PROPERTIES, with_cast_failures=True, truncate=True)
    return out.withColumn("cast_failed", F.array_join("_cast_failures", ",")).drop("_cast_failures")


def q_batch_inference(spark, sf):
    """S4 + S7: documents read as a batch, types inferred from the files."""
    path = fx.write_event_documents(fx.table(spark, sf, "events"), work_dir(spark, "inferred_docs"))
    flat = flatten_features(read_features(spark, path, multi_line=False))
    return flat.select("id", "type", F.element_at("coordinates", 1).alias("x"), "user_id", "event_type", "value", F.col("props.k").alias("k"))


def q_tag_changes(spark, sf):
    docs = tag_changes(fx.event_documents(fx.table(spark, sf, "events")), "UPDATE")
    rows = explode_features(docs, keep=[])
    return rows.select(F.col("feature.id").alias("id"),
                       F.col("feature.properties.__change__").alias("change"),
                       F.col("feature.properties.event_type").alias("event_type"))


# ---- row quality -------------------------------------------------------------

DOC_RULE = validity_rule("feature_id")


def q_valid_rows(spark, sf):
    kd = fx.keyed_documents(fx.table(spark, sf, "documents"))
    return quality.expect_or_drop(kd, "valid_id", DOC_RULE)


def q_quarantine_rows(spark, sf):
    kd = fx.keyed_documents(fx.table(spark, sf, "documents"))
    bad = quality.quarantine_rows(kd, DOC_RULE, "valid_id")
    return bad.select("feature_id", "doc_id", "validation_rule_failed", "validation_rule_name")


def q_quality_split_counts(spark, sf):
    kd = fx.keyed_documents(fx.table(spark, sf, "documents"))
    return quality.split_counts(kd, [quality.Rule("valid_id", DOC_RULE)])


CUSTOMER_RULES = [
    quality.required("c_custkey"),
    quality.between("c_acctbal", -500, 9000, criticality="warn"),
    quality.one_of("c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]),
    quality.matches("c_name", "^Customer#[0-9]{9}$"),
    quality.between("c_nationkey", 0, 20),
]


def q_contract_rule_failures(spark, sf):
    return quality.rule_failures(fx.table(spark, sf, "customer"), CUSTOMER_RULES, ["c_custkey"])


def q_unique_failures(spark, sf):
    """Q5 ``unique``: orders whose (customer, date) is not unique."""
    orders = fx.table(spark, sf, "orders")
    return quality.unique_failures(orders, ["o_custkey", "o_orderdate"]) \
        .select("o_orderkey", "o_custkey", "o_orderdate")


ORDER_PROPERTIES = (
    Property("o_orderkey", "o_orderkey", "long"),
    Property("o_orderstatus", "o_orderstatus", "boolean"),
    Property("o_totalprice", "o_totalprice", "integer"),
    Property("o_orderdate", "o_orderdate", "date"),
    Property("o_orderpriority", "o_orderpriority", "string"),
    Property("o_clerk", "o_clerk", "string"),
)


def q_cast_failures(spark, sf):
    orders = fx.table(spark, sf, "orders")
    text = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    return quality.check_schema(text, ORDER_PROPERTIES)


# ---- source-file gate ----------------------------------------------------------

def q_small_files(spark, sf):
    m = fx.document_manifest(fx.table(spark, sf, "documents"))
    return files.small_files(m).select("dataset", "name", "path", "size", "size_kb")


def q_duplicate_files(spark, sf):
    return files.duplicate_names(fx.document_manifest(fx.table(spark, sf, "documents")))


def q_duplicate_content(spark, sf):
    return files.duplicate_content(fx.document_manifest(fx.table(spark, sf, "documents")))


def _expected_sources(spark):
    return spark.createDataFrame([(s,) for s in EXPECTED_SOURCES], "dataset string")


def q_empty_datasets(spark, sf):
    m = fx.document_manifest(fx.table(spark, sf, "documents"))
    return files.empty_datasets(_expected_sources(spark), m)


def q_file_metrics(spark, sf):
    m = fx.document_manifest(fx.table(spark, sf, "documents"))
    counts = files.file_counts(m)
    metrics = observe.metric_rows(
        counts, "completeness", "files_in_folder", F.col("n_files"), expected=F.col("expected"),
        unit="Count", dimensions={"dataset": F.col("dataset"), "status": F.col("status")},
        notebook="gate", ts=F.lit(METRIC_TIME).cast("timestamp"))
    path = work_dir(spark, "metrics")
    write_metrics(metrics, path)
    back = read_metrics(spark, path)
    return back.select("timestamp", "metric_type", "metric_name", "value", "expected", "unit",
                       F.col("dimensions")["dataset"].alias("dataset"),
                       F.col("dimensions")["status"].alias("status"))


def q_stale_files(spark, sf):
    m = fx.order_manifest(fx.table(spark, sf, "orders"))
    return files.stale_files(m, AS_OF_ORDERS).select("dataset", "name", "modified_at", "age_days")


def q_gate_failures(spark, sf):
    m = fx.order_manifest(fx.table(spark, sf, "orders"))
    return files.validate_manifest(m, AS_OF_ORDERS)


def q_folder_gate(spark, sf):
    """S10 + V2 + V7 on real folders: customer names, one folder and file a
    nation, and one folder that is missing. Every failure is in the report the
    gate leaves, however many its message names."""
    root, report = work_dir(spark, "gate_in"), work_dir(spark, "gate_report")
    fx.table(spark, sf, "customer").select("c_nationkey", F.col("c_name").alias("value")) \
        .repartition("c_nationkey").write.partitionBy("c_nationkey").text(root)
    manifest, failures = empty_manifest(spark), []
    for nation in range(26):  # nations are 0 to 24
        folder = f"{root}/c_nationkey={nation}"
        try:
            manifest = manifest.unionByName(scan_manifest(spark, folder, f"nation{nation}"))
        except FileNotFoundError:
            failures.append(files.unreachable_row(spark, f"nation{nation}", folder, "cannot list"))
    found = files.validate_manifest(manifest, F.current_timestamp(), min_kb=200)
    for row in failures:
        found = found.unionByName(row)
    try:
        files.gate(found, report)
    except files.GateError:
        pass
    return spark.read.schema(found.schema).json(report).select("dataset", "check", "detail")


# ---- change data capture ---------------------------------------------------------

def _events_history(spark, sf, track=("event_type",), delete_when=None):
    ev = fx.table(spark, sf, "events")
    return cdc.scd2(ev, "user_id", "ts", tie_break=["event_id"],
                    track=list(track) if track is not None else None, delete_when=delete_when)


HIST_COLS = ["user_id", "event_id", "event_type", "value", "valid_from", "valid_to", "is_current"]


def q_scd2_history(spark, sf):
    return _events_history(spark, sf).select(*HIST_COLS)


def q_scd2_segmented(spark, sf):
    """C1 + C5 with every user treated as a hot key (segments of 16 rows), so
    the segment stitching runs on the real table; same result as
    ``scd2_history``."""
    ev = fx.table(spark, sf, "events")
    return cdc.scd2(ev, "user_id", "ts", tie_break=["event_id"], track=["event_type"],
                    max_rows_per_segment=16).select(*HIST_COLS)


def q_scd2_hot_user(spark, sf):
    """C1 + C5 when one key holds a third of all rows: every third event is
    given to user 0 (no row dropped). With a 256-row segment limit only that
    user is found hot (on the sample) and its history runs as many
    sequence-range segments in separate tasks; the result is exact."""
    ev = fx.table(spark, sf, "events")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("long"))
                       .otherwise(F.col("user_id")))
    return cdc.scd2(ev, "user_id", "ts", tie_break=["event_id"], track=["event_type"],
                    max_rows_per_segment=256).select(*HIST_COLS)


def q_scd2_bursty_user(spark, sf):
    """C1 + C5 when a hot key's rows come in one burst: every third event is
    given to user 0, and 99 of 100 of these fall within a fraction of a second.
    Bounds are quantiles, so the burst is cut like the rest."""
    ev = fx.table(spark, sf, "events")
    hot, burst = F.col("event_id") % 3 == 0, F.col("event_id") % 100 != 0
    at = F.expr("TIMESTAMP_NTZ'2024-01-10 00:00:00' + make_dt_interval(0, 0, 0, event_id / 1000000.0BD)")
    ev = ev.withColumn("ts", F.when(hot & burst, at).otherwise(F.col("ts"))) \
           .withColumn("user_id", F.when(hot, F.lit(0).cast("long")).otherwise(F.col("user_id")))
    return cdc.scd2(ev, "user_id", "ts", tie_break=["event_id"], track=["event_type"],
                    max_rows_per_segment=256).select(*HIST_COLS)


def q_scd2_batch_stamp(spark, sf):
    """C1 + C3 with the kind of sequence the reference uses: one stamp shared
    by every row of a delivery (here the event's day), ties broken by
    ``(ts, event_id)``. With a 4-row segment limit, every user-day of more
    than 4 events is a hot tie, collapsed by the combinable path before the
    shuffle, and every user is segmented; same result as the plain plan."""
    ev = fx.table(spark, sf, "events").withColumn("batch_day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    hist = cdc.scd2(ev, "user_id", "batch_day", tie_break=["ts", "event_id"], track=["event_type"],
                    max_rows_per_segment=4)
    return hist.select("user_id", "event_id", "event_type", "value", "batch_day",
                       "valid_from", "valid_to", "is_current")


def q_scd2_track_all(spark, sf):
    return _events_history(spark, sf, track=None).select(*HIST_COLS)


def q_scd_current(spark, sf):
    return cdc.current(_events_history(spark, sf)).select(*HIST_COLS)


def q_scd2_as_of(spark, sf):
    return cdc.as_of(_events_history(spark, sf), AS_OF_EVENTS).select(*HIST_COLS)


def q_scd2_as_of_each(spark, sf):
    """C7 for a table of times: for every event the version its user had some
    hours before or after it; every user is cut into 64-row ranges of time."""
    ev = fx.table(spark, sf, "events")
    hist = cdc.scd2(ev, "user_id", "ts", tie_break=["event_id"], track=["event_type"], delete_when="event_type = 'error'")
    hours = F.make_dt_interval(hours=(F.col("event_id") % 97 - 48).cast("int"))
    probes = ev.select(F.col("event_id").alias("probe_id"), "user_id", (F.col("ts") + hours).alias("asked_at"))
    return cdc.as_of_each(hist.select("user_id", "event_id", "event_type", "valid_from", "valid_to"), probes, "user_id", "asked_at", max_rows_per_segment=64)


def q_scd2_deletes(spark, sf):
    return _events_history(spark, sf, track=None, delete_when="event_type = 'error'").select(*HIST_COLS)


def q_scd2_track_deletes(spark, sf):
    return _events_history(spark, sf, delete_when="event_type = 'error'").select(*HIST_COLS)


def _table_name(prefix: str) -> str:
    import uuid
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def q_scd2_bucketed_deletes(spark, sf):
    """C1 + C4 over events bucketed by the key: the history needs no shuffle."""
    from ..sinks.tables import write_bucketed
    ev = fx.table(spark, sf, "events")
    table = write_bucketed(ev, _table_name("events_by_user"), ["user_id"], BUCKETS,
                           path=work_dir(spark, "events_by_user"), sort_by=["user_id", "ts"])
    hist = cdc.scd2(table, "user_id", "ts", tie_break=["event_id"], delete_when="event_type = 'error'")
    return hist.select(*HIST_COLS)


def q_scd2_ties(spark, sf):
    orders = fx.table(spark, sf, "orders")
    hist = cdc.scd2(orders, "o_custkey", "o_orderdate", tie_break=["o_orderkey"])
    return hist.select("o_custkey", "o_orderkey", "o_totalprice", "valid_from", "valid_to", "is_current")


def q_entry_history(spark, sf):
    docs = fx.event_documents(fx.table(spark, sf, "events"))
    hist, _ = flows.run_entry_batch(docs, fx.EVENTS_ENTRY, track=["event_type"],
                                    landing=work_dir(spark, "entry_landing"))
    return hist.select("user_id", "feature_id", "event_type", "value", "k",
                       "valid_from", "valid_to", "is_current")


# ---- observability ------------------------------------------------------------------

EVENT_STATES = ["QUEUED", "RUNNING", "COMPLETED", "FAILED"]


def _pipeline_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    state = F.element_at(F.array(*[F.lit(s) for s in EVENT_STATES]), (k % len(EVENT_STATES)) + 1)
    etype = F.when(F.col("event_type").isin("view", "click"), F.lit("update_progress")) \
             .otherwise(F.col("event_type"))
    details = F.to_json(F.struct(F.struct(state.alias("state")).alias("update_progress")))
    return events.select("event_id", etype.alias("event_type"), details.alias("details"))


def q_event_messages(spark, sf):
    pe = _pipeline_events(fx.table(spark, sf, "events"))
    return observe.event_messages(pe).select("event_id", "message")


def q_schema_drift(spark, sf):
    known = [p.source_path.rsplit(".", 1)[1] for p in fx.EVENTS_ENTRY.properties
             if p.source_path and p.source_path.startswith("feature.properties.props.")]
    return drift.schema_drift(fx.table(spark, sf, "events"), "props", known)


def _event_logs(events: DataFrame) -> DataFrame:
    level = F.when(F.col("event_type") == "error", "ERROR") \
             .when(F.col("event_type") == "purchase", "WARNING") \
             .when(F.col("event_type") == "view", "DEBUG").otherwise("INFO")
    parent = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("parent-"), F.col("user_id").cast("string")))
    own = F.concat(F.lit("run-"), F.col("event_id").cast("string"))
    return observe.log_rows(
        events, level=level,
        message=F.concat(F.col("event_type"), F.lit(" by user "), F.col("user_id").cast("string")),
        logger="events", notebook="ingest", ts="ts",
        job_id=F.concat(F.lit("job-"), (F.col("user_id") % 10).cast("string")),
        run_id_col=observe.run_id(parent, own), task_id=F.col("event_type"))


def q_ops_log_sorted(spark, sf):
    path = work_dir(spark, "logs")
    write_log_rows(_event_logs(fx.table(spark, sf, "events")), path)
    return observe.sorted_by_time(read_logs(spark, path))


def q_log_level_filter(spark, sf):
    return observe.at_level(_event_logs(fx.table(spark, sf, "events")), "warning")


def queries() -> dict[str, Query]:
    from ..streaming import queries as stream_queries

    batch = {
        "explode_features": q_explode_features,
        "flatten_features": q_flatten_features,
        "contract_projection": q_contract_projection,
        "typed_casts": q_typed_casts,
        "tag_changes": q_tag_changes,
        "valid_rows": q_valid_rows,
        "quarantine_rows": q_quarantine_rows,
        "quality_split_counts": q_quality_split_counts,
        "contract_rule_failures": q_contract_rule_failures,
        "unique_failures": q_unique_failures,
        "cast_failures": q_cast_failures,
        "small_files": q_small_files,
        "duplicate_files": q_duplicate_files,
        "duplicate_content": q_duplicate_content,
        "empty_datasets": q_empty_datasets,
        "file_metrics": q_file_metrics,
        "stale_files": q_stale_files,
        "gate_failures": q_gate_failures,
        "scd2_history": q_scd2_history,
        "scd2_track_all": q_scd2_track_all,
        "scd2_segmented": q_scd2_segmented,
        "scd2_batch_stamp": q_scd2_batch_stamp,
        "scd2_hot_user": q_scd2_hot_user,
        "scd2_bursty_user": q_scd2_bursty_user,
        "folder_gate": q_folder_gate,
        "batch_inference": q_batch_inference,
        "scd_current": q_scd_current,
        "scd2_as_of": q_scd2_as_of,
        "scd2_as_of_each": q_scd2_as_of_each,
        "scd2_deletes": q_scd2_deletes,
        "scd2_track_deletes": q_scd2_track_deletes,
        "scd2_ties": q_scd2_ties,
        "scd2_bucketed_deletes": q_scd2_bucketed_deletes,
        "entry_history": q_entry_history,
        "event_messages": q_event_messages,
        "schema_drift": q_schema_drift,
        "ops_log_sorted": q_ops_log_sorted,
        "log_level_filter": q_log_level_filter,
    }
    batch.update(stream_queries.queries())
    return batch


def oracle_sql() -> dict[str, str]:
    from . import oracles
    return dict(oracles.ORACLES)
