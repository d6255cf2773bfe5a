"""Inputs derived from the driver tables for the registered queries.

The driver tables are flat; the operators consume feature-collection
documents, keyed rows with failing keys, and file manifests. These builders
derive those shapes with Spark from the whole tables, so the work of every
query grows with the data. Document size is bounded: a document holds the
features of one user whose ``event_id`` falls in one block of
``FEATURES_PER_DOC`` ids, so no group can grow with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Entry, Property

FEATURES_PER_DOC = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# JSON text of a timestamp without time zone, to the microsecond.
JSON_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def event_feature() -> F.Column:
    """One GeoJSON-like feature per event: string id, a Point, properties."""
    return F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(F.col("value"), F.col("user_id").cast("double")).alias("coordinates")).alias("geometry"),
        F.struct("user_id", "event_type", "ts", "value", "props").alias("properties"),
    )


def event_documents(events: DataFrame, per_doc: int = FEATURES_PER_DOC,
                    props_as_object: bool = False) -> DataFrame:
    """Feature collections ``doc_user, doc_block, features`` from ``events``.

    ``collect_list`` is bounded by ``per_doc`` per group; the array is sorted
    (struct order, so by feature id first) so that a document's feature order
    and positions are deterministic. ``props_as_object`` then turns the
    ``props`` JSON text into a nested value, as a delivered file has it.
    """
    block = F.floor(F.col("event_id") / F.lit(per_doc))
    features = F.array_sort(F.collect_list(event_feature()))
    if props_as_object:
        features = F.transform(features, lambda f: f.withField(
            "properties.props", F.parse_json(f["properties"]["props"])))
    return events.groupBy(F.col("user_id").alias("doc_user"), block.alias("doc_block")) \
                 .agg(features.alias("features"))


def write_event_documents(events: DataFrame, path: str, per_doc: int = FEATURES_PER_DOC) -> str:
    """Write the documents as JSON lines (one document per line) under a new
    ``path``, with nested ``props`` and microsecond timestamps."""
    event_documents(events, per_doc, props_as_object=True).write \
        .option("timestampNTZFormat", JSON_TIME_FORMAT).json(path)
    return path


def write_typed_documents(events: DataFrame, path: str, per_doc: int = FEATURES_PER_DOC) -> str:
    """The same documents as JSON lines with numbers and booleans as such."""
    feature = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(F.col("value"), F.col("user_id").cast("double")).alias("coordinates")).alias("geometry"),
        F.struct("user_id", "event_type", "ts", "value", F.parse_json("props").alias("props"),
                 (F.col("event_type") == F.lit("error")).alias("is_error")).alias("properties"),
    )
    block = F.floor(F.col("event_id") / F.lit(per_doc))
    events.groupBy(F.col("user_id").alias("doc_user"), block.alias("doc_block")).agg(F.collect_list(feature).alias("features")) \
        .write.option("timestampNTZFormat", JSON_TIME_FORMAT).json(path)
    return path


def write_event_feature_lines(events: DataFrame, path: str) -> str:
    """Write one feature per line (a GeoJSON text sequence) under a new
    ``path``: splittable, unlike one FeatureCollection document per file."""
    feature = event_feature()
    events.select(feature.alias("f")).select("f.*") \
        .withColumn("properties", F.col("properties").withField("props", F.parse_json("properties.props"))) \
        .write.option("timestampNTZFormat", JSON_TIME_FORMAT).json(path)
    return path


# Features per collection file for the line-layout fixture: the reader is
# for large files, so these hold 8 blocks of documents each (still bounded).
FEATURES_PER_COLLECTION_FILE = 8 * FEATURES_PER_DOC


def write_event_collection_lines(events: DataFrame, path: str,
                                 per_doc: int = FEATURES_PER_COLLECTION_FILE) -> str:
    """Write FeatureCollection files laid out one feature per line (a header
    and footer of structure lines, features separated by a trailing comma),
    one collection per file, each holding the events of one block of
    ``per_doc`` ids (bounded)."""
    block = F.floor(F.col("event_id") / F.lit(per_doc))
    feature = event_feature()
    feature = feature.withField("properties.props", F.parse_json(F.col("props")))
    feature_json = F.to_json(feature, {"timestampNTZFormat": JSON_TIME_FORMAT})
    # feature order inside a file does not matter: rows read line by line
    # are ordered by a content hash (see ``plans.flows.stage``)
    lines = F.array_join(F.collect_list(feature_json), ",\n")
    text = F.concat_ws("\n", F.lit("{"), F.lit('"type": "FeatureCollection",'), F.lit('"name": "events",'),
                       F.lit('"features": ['), lines, F.lit("]"), F.lit("}"))
    events.groupBy(block.alias("doc_block")).agg(text.alias("value")).select("value") \
        .write.option("maxRecordsPerFile", 1).text(path)
    return path


# Collection files a table is delivered in, until a file holds this many ids.
LAYOUT_FILES, FEATURES_PER_LAYOUT_FILE = 128, 16 * FEATURES_PER_DOC


def blocks_per_file(events: DataFrame, per_doc: int) -> int:
    """Blocks of ``per_doc`` ids that go into one file: a larger table comes
    in larger files rather than in more, up to a bounded size."""
    wanted = -(-events.count() // (LAYOUT_FILES * per_doc))
    return max(1, min(wanted, FEATURES_PER_LAYOUT_FILE // per_doc))


def write_event_layouts(events: DataFrame, path: str, layouts: tuple[str, ...], per_doc: int = FEATURES_PER_DOC) -> str:
    """FeatureCollections of blocks of ``per_doc`` ids, features in id order,
    block b in layout ``layouts[b mod n]``: ``one_line`` (all in one line),
    ``lines`` (a feature a line), ``pairs`` (two a line), ``inline`` (the
    array on the header's line) or ``indented``. A file holds the blocks
    ``blocks_per_file`` says: of one layout as one collection, of several as
    a collection each, one after the other."""
    n = blocks_per_file(events, per_doc)
    together = n if len(layouts) == 1 else 1
    block = F.floor(F.col("event_id") / F.lit(per_doc))
    kind_of = lambda b: F.get(F.array(*map(F.lit, layouts)), (b % len(layouts)).cast("int"))
    feature = event_feature().withField("properties.props", F.parse_json(F.col("props")))
    feature = feature.withField("properties.doc_key", F.concat_ws("-", block.cast("string"), F.col("user_id").cast("string")))
    times = {"timestampNTZFormat": JSON_TIME_FORMAT}
    said = F.when(kind_of(block) == "indented", F.to_json(feature, times | {"pretty": "true"})).otherwise(F.to_json(feature, times))
    rows = F.array_sort(F.collect_list(F.struct("event_id", said.alias("j"))))
    docs = events.groupBy(F.floor(F.col("event_id") / F.lit(together * per_doc)).alias("b")).agg(rows.alias("r"))
    texts = F.transform("r", lambda x: x["j"])
    head, kind = F.lit('{"type": "FeatureCollection", "features": ['), kind_of(F.col("b"))
    lines = lambda body: F.concat(F.lit('{\n"type": "FeatureCollection",\n"name": "events",\n"features": [\n'), body, F.lit("\n]\n}"))
    pairs = F.array_join(F.transform("r", lambda x, i: F.concat(x["j"], F.when(i % 2 == 0, ", ").otherwise(",\n"))), "")
    text = (F.when(kind == "one_line", F.concat(head, F.array_join(texts, ", "), F.lit("]}")))
            .when(kind == "lines", lines(F.array_join(texts, ",\n")))
            .when(kind == "pairs", lines(F.regexp_replace(pairs, r",\s*$", "")))
            .when(kind == "inline", F.concat(F.lit('{"type": "FeatureCollection",\n"features": ['), F.array_join(texts, ", "), F.lit("]\n}")))
            .when(kind == "indented", F.concat(F.lit('{\n"type" : "FeatureCollection",\n"features" : [\n'), F.array_join(texts, ",\n"), F.lit("\n]\n}"))))
    docs.select(text.alias("value")).write.option("maxRecordsPerFile", n // together).text(path)
    return path


# The contract entry the event queries run under (ours: the reference's own
# contract file is not part of it). ``ts`` uses the opt-in timestamp_ntz type.
EVENTS_ENTRY = Entry(
    name="events", key="user_id", sequence_by="ts", source="events_src",
    table_name="events_history", folder="events",
    properties=(
        Property("feature_id", "feature.id", "string"),
        Property("user_id", "feature.properties.user_id", "long"),
        Property("event_type", "feature.properties.event_type", "string"),
        Property("ts", "feature.properties.ts", "timestamp_ntz"),
        Property("value", "feature.properties.value", "double"),
        Property("k", "feature.properties.props.k", "integer"),
        Property("note", None, "string"),
    ),
)


def keyed_documents(documents: DataFrame) -> DataFrame:
    """``documents`` with a text key ``feature_id`` that is NULL, blank or
    empty for some rows (the table itself has no bad keys). Every row is
    kept; only the key is rewritten."""
    doc = F.col("doc_id")
    fid = F.when(doc % 7 == 0, F.lit(None).cast("string")) \
           .when(doc % 11 == 0, F.lit("  ")) \
           .when(doc % 13 == 0, F.lit("")) \
           .otherwise(doc.cast("string"))
    return documents.select(fid.alias("feature_id"), "doc_id", "lang", "source", "n_chars")


# The contract entry for feature documents built from ``documents`` (ours).
DOCUMENTS_ENTRY = Entry(
    name="documents", key="feature_id", sequence_by="doc_id", folder="documents",
    table_name="documents_history",
    properties=(
        Property("feature_id", "feature.id", "string"),
        Property("doc_id", "feature.properties.doc_id", "long"),
        Property("lang", "feature.properties.lang", "string"),
        Property("source", "feature.properties.source", "string"),
        Property("n_chars", "feature.properties.n_chars", "long"),
    ),
)


def write_keyed_documents(documents: DataFrame, path: str, per_doc: int = FEATURES_PER_DOC) -> str:
    """Feature collections of ``keyed_documents`` (one per source and block
    of ``per_doc`` ids) written as JSON lines under a new ``path``."""
    kd = keyed_documents(documents)
    feature = F.struct(F.col("feature_id").alias("id"),
                       F.struct("doc_id", "lang", "source", "n_chars").alias("properties"))
    block = F.floor(F.col("doc_id") / F.lit(per_doc))
    kd.groupBy("source", block.alias("doc_block")) \
      .agg(F.array_sort(F.collect_list(feature)).alias("features")) \
      .write.json(path)
    return path


def document_manifest(documents: DataFrame) -> DataFrame:
    """A file manifest from ``documents``: dataset = source, one file per
    document named by ``doc_id mod 50`` (so names repeat), size = n_chars,
    content hash of the text."""
    return documents.select(
        F.col("source").alias("dataset"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".json")).alias("path"),
        F.concat(F.lit("part_"), (F.col("doc_id") % 50).cast("string"), F.lit(".json")).alias("name"),
        F.col("n_chars").alias("size"),
        F.sha2(F.col("text"), 256).alias("content_hash"),
    )


def order_manifest(orders: DataFrame) -> DataFrame:
    """A file manifest from ``orders``: dataset = priority, modified at the
    order date."""
    return orders.select(
        F.col("o_orderpriority").alias("dataset"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("path"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("name"),
        F.col("o_totalprice").cast("long").alias("size"),
        F.col("o_orderdate").alias("modified_at"),
    )
