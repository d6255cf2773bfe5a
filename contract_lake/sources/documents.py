"""Feature-collection document sources.

The streaming source is Spark's own file source: it discovers new files,
records each processed file in the checkpoint's file log (exactly once), and
parses JSON on the executors. Files are read as text and parsed with
``from_json``, so that a text the parser did not read to its end is noticed. The read schema comes from the contract, with
every leaf as text (see ``contract.read_schema``), so the parser skips the
fields nobody asked for and a bad value reaches the quarantine instead of
becoming a silent NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"
SOURCE_MTIME = "_source_mtime"
BLOCK_START = "_block_start"
DOC = "_doc"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])


def _with_file_metadata(df: DataFrame) -> DataFrame:
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path")) \
             .withColumn(SOURCE_MTIME, F.col("_metadata.file_modification_time"))


def read_features(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  multi_line: bool = True, keep_corrupt: bool = False,
                  with_file: bool = False) -> DataFrame:
    """Batch read of feature documents (S7). Without ``schema`` the column
    types are inferred (S4). ``multi_line=True`` reads each file as one JSON
    document (not splittable: one task per file); ``False`` reads JSON lines,
    one document per line, split across tasks."""
    reader = spark.read.option("multiLine", str(multi_line).lower())
    if schema is not None:
        if keep_corrupt:
            schema = _with_corrupt(schema)
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.schema(schema)
    df = reader.json(path)
    return _with_file_metadata(df) if with_file else df


def infer_schema(spark: SparkSession, path: str, multi_line: bool = True,
                 sampling_ratio: float = 1.0) -> T.StructType:
    """Inferred document schema from a batch read (S4, exploration aid)."""
    return spark.read.option("multiLine", str(multi_line).lower()) \
                .option("samplingRatio", sampling_ratio).json(path).schema


# Bracket a text as a JSON array that closes with this element: if the parser
# reaches it, it has read the text to its end and nothing was left out.
_END = "_end_of_text"
LINE = "_line"
LIKELY_OBJECTS = r'^[\s\[]*("\s*)?[{\\]'


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once (a parse is not cheap)."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _values(text: Column) -> Column:
    """The JSON objects of ``text`` (separated by commas), each as its own
    text, or NULL when it is anything else: not JSON, more after the last
    value, or a value that is no object."""
    def checked(values: Column) -> Column:
        n = F.size(values) - 1
        kept = F.slice(values, 1, F.greatest(n, F.lit(1)))
        objects = F.forall(kept, lambda v: v.isNotNull() & v.startswith("{"))
        return F.when((n > 0) & (F.element_at(values, -1) == _END) & objects, kept)

    return _let(F.from_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')), T.ArrayType(T.StringType())), checked)


def _parsed(element: T.StructType) -> Column:
    """One object's text ``_d`` as ``element``; what does not fit the types
    leaves its text in ``_corrupt_record``."""
    return F.from_json("_d", _with_corrupt(element), {"columnNameOfCorruptRecord": CORRUPT})


def _typed(text: Column, element: T.StructType, absent: str | None = None) -> Column:
    """The JSON objects of ``text`` as ``element`` structs, or NULL unless the
    text holds nothing else, the parser reached its end, every value fits the
    types and no object has the member ``absent``. One parse."""
    extra = [T.StructField(c, T.StringType()) for c in (_END, absent) if c]
    wrapped = T.StructType([T.StructField("v", T.ArrayType(T.StructType([*element.fields, *extra]))), T.StructField(CORRUPT, T.StringType())])

    def checked(parsed: Column) -> Column:
        n = F.size(parsed["v"]) - 1
        kept = F.slice(parsed["v"], 1, F.greatest(n, F.lit(1)))
        objects = F.forall(kept, lambda v: v.isNotNull() & (v[absent].isNull() if absent else F.lit(True)))
        return F.when(parsed[CORRUPT].isNull() & (n > 0) & (F.element_at(parsed["v"], -1)[_END] == "1") & objects, kept)

    whole = F.concat(F.lit('{"v":['), text, F.lit(f',{{"{_END}":1}}]}}'))
    return _let(F.from_json(whole, wrapped, {"columnNameOfCorruptRecord": CORRUPT}), checked)


def _objects(rows: DataFrame, text: Column, element: T.StructType, fallback: Column, keep: list[str], refused, absent: str | None = None) -> DataFrame:
    """A row per JSON object of ``text`` with its place ``_doc``, its text
    ``_d``, ``_p``, the object as ``element`` with ``_corrupt_record``, and
    the columns ``keep``. A text that parses cleanly is parsed once, straight
    to the types (``_d`` is NULL then); any other is first split into the texts
    of its objects by ``fallback``, and each is parsed by itself. Where that
    finds none either, it gives one row with a NULL ``_d``. ``_bad`` is
    ``refused(d)`` of an object's text (or that NULL): the text to quarantine,
    if any. Only such rows carry the text: a row an object that did would hold
    a text as often as it has objects."""
    # Objects start with a brace (or, in a string, an escaped one): a member
    # line of a printed feature is told at once, a parse that fails is dear.
    likely = text.rlike(LIKELY_OBJECTS)
    if {CORRUPT, _END, absent} & set(element.fieldNames()):
        rows = rows.withColumn("_objects", F.lit(None).cast(T.ArrayType(element)))
    else:
        rows = rows.withColumn("_objects", F.when(likely, _typed(text, element, absent)))
    # an array of neither: one row that says so
    rows = rows.withColumn("_texts", F.when(F.col("_objects").isNull(), F.coalesce(F.when(likely, fallback), F.array(F.lit(None).cast("string")))))
    known = F.transform("_objects", lambda v: F.struct(F.lit(None).cast("string").alias("d"), v.alias("p"), F.lit(None).cast("string").alias("bad")))
    split = F.transform("_texts", lambda d: F.struct(d.alias("d"), F.lit(None).alias("p"), refused(d).alias("bad")))
    rows = rows.select(*keep, F.posexplode(F.coalesce(known, split)).alias(DOC, "_o"))
    rows = rows.select(*keep, DOC, F.col("_o.d").alias("_d"), F.col("_o.p").alias("_v"), F.col("_o.bad").alias("_bad"))
    rows = rows.withColumn("_t", F.when(F.col("_d").isNotNull(), _parsed(element)))
    fields = [F.coalesce(F.col("_v")[f], F.col("_t")[f]).alias(f) for f in element.fieldNames()]
    return rows.withColumn("_p", F.struct(*fields, F.col("_t")[CORRUPT].alias(CORRUPT))).drop("_v", "_t")


def documents_of_text(texts: DataFrame, schema: T.StructType, text_col: str = "value") -> DataFrame:
    """One row per JSON document of each text (a whole file, or a line).

    A text may be one document in any layout, several documents one per line
    (JSON lines, as ``sinks.files.write_changeset`` writes them), or a JSON
    array of documents. Anything else, a text with content after its last
    document included, is one row with the text as ``_corrupt_record``: no
    document is dropped. Blank texts give no row. Rows carry the columns of
    ``schema``, ``_corrupt_record``, the other columns of ``texts`` and
    ``_doc``, the document's place in its text."""
    fields = [f for f in schema.fields if f.name != CORRUPT]
    others = [c for c in texts.columns if c != text_col]
    # Two patterns, as one of both alternatives tries them at every letter of a
    # long text; exploded, so that the filter below does not evaluate it again.
    text = F.regexp_replace(F.regexp_replace(F.col(text_col), r"^[\s\uFEFF]+", ""), r"\s+$", "")
    lines = F.array_join(F.filter(F.split(F.col("_text"), r"[\r\n]+"), lambda x: F.trim(x) != ""), ",")
    whole = F.col("_text")
    docs = F.coalesce(_values(whole), F.when(whole.startswith("["), _values(F.regexp_replace(whole, r"^\[|\]$", ""))), _values(lines))
    rows = texts.select(F.explode(F.array(text)).alias("_text"), *others).filter((whole != "") & ~whole.rlike(r"^\[\s*\]$"))
    rows = _objects(rows, whole, T.StructType(fields), docs, others, lambda d: F.when(d.isNull(), whole))
    return rows.select(*[F.col("_p")[f.name].alias(f.name) for f in fields],
                       F.coalesce("_bad", F.col("_p")[CORRUPT]).alias(CORRUPT), DOC, *others)


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with ``_line``, growing in the order a task reads them. With
    the file and the block's start it gives the order of lines in a file;
    Spark's text source has no line number of its own. One narrow pass over
    Arrow batches, memory of one batch."""
    schema = T.StructType(list(lines.schema.fields) + [T.StructField(LINE, T.LongType(), False)])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        at = 0
        for batch in batches:
            number = pa.array(np.arange(at, at + batch.num_rows, dtype=np.int64))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, number], names=[*batch.schema.names, "_line"])

    return lines.mapInArrow(run, schema)


def _text_reader(spark: SparkSession, path: str, streaming: bool, whole: bool, max_files: int | None) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).format("text").option("wholetext", str(whole).lower())
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    raw = _with_file_metadata(reader.load(path))
    return raw if whole else raw.withColumn(BLOCK_START, F.col("_metadata.file_block_start"))


def stream_features(spark: SparkSession, path: str, schema: T.StructType,
                    max_files: int | None = None, multi_line: bool = True,
                    with_file: bool = True, streaming: bool = True) -> DataFrame:
    """Stream feature documents from a folder.

    ``max_files`` is the rate limit (files per micro-batch; the reference uses
    1, the default is no limit). A stream needs a schema up front; use
    ``contract.read_schema``. ``multi_line=True`` takes each file as one text
    (one task per file; one document in any layout, or JSON lines, see
    ``documents_of_text``); ``False`` reads documents one per line, split
    across tasks, each with its line number for ties. The file path and
    modification time are kept for the deterministic order of rows that share
    a sequence value."""
    raw = _text_reader(spark, path, streaming, multi_line, max_files)
    docs = documents_of_text(raw if multi_line else numbered_lines(raw), schema)
    return docs if with_file else docs.drop(SOURCE_FILE, SOURCE_MTIME, BLOCK_START)


def stream_feature_lines(spark: SparkSession, path: str, schema: T.StructType,
                         max_files: int | None = None, streaming: bool = True) -> DataFrame:
    """Stream GeoJSON text sequences: one Feature object per line (S1 for
    large deliveries). Unlike a FeatureCollection file, which is one JSON
    value parsed whole by one task, these files split across tasks and need
    no explode. Use ``contract.read_schema(..., feature_lines=True)``. The
    result has one ``feature`` struct column plus lineage columns, the shape
    ``plans.flows.stage`` accepts. Several features on a line are all read; a
    line that is anything else is a corrupt row."""
    docs = documents_of_text(numbered_lines(_text_reader(spark, path, streaming, False, max_files)), schema)
    fields = [f for f in schema.fieldNames() if f != CORRUPT]
    return docs.select(F.struct(*fields).alias("feature"), CORRUPT, SOURCE_FILE, SOURCE_MTIME, BLOCK_START, LINE, DOC)


# Members a FeatureCollection has itself, next to its features.
COLLECTION_MEMBERS = ("name", "crs", "bbox", "title", "description", "links", "generator", "copyright", "timeStamp",
                      "numberMatched", "numberReturned", "totalFeatures", "xy_coordinate_resolution", "metadata")
# Lines of a collection that hold nothing but its own structure (trimmed,
# without one trailing comma).
COLLECTION_STRUCTURE = "|".join((
    r"^[\[\]{}\s,]*$",
    r'^\{?\s*"type"\s*:\s*"FeatureCollection"$',
    r'^\{?\s*("type"\s*:\s*"FeatureCollection"\s*,\s*)?"(' + "|".join(COLLECTION_MEMBERS)
    + r')"\s*:\s*("[^"]*"|-?[0-9][0-9.eE+-]*|true|false|null|\{[^"]*("[^"]*"[^"]*)*\}|\[[^"]*("[^"]*"[^"]*)*\])$',
))
# The start of a line that opens the features array, with or without the
# collection's own brace and members before it.
COLLECTION_HEADER = r'^(\{[^{}]*(\{[^{}]*(\{[^{}]*\}[^{}]*)*\}[^{}]*)*)?"features"\s*:\s*\[\s*'


def collection_line_features(lines: DataFrame, schema: T.StructType, text_col: str = "value") -> DataFrame:
    """One row per feature from text lines of feature collections (S1 for
    large FeatureCollection files).

    Lines are read split across tasks (a text file splits at any line), so a
    collection file far larger than one task is parsed in parallel. A line is
    trimmed, loses one trailing comma and a header that opens the features
    array, and is then read as a list of features: as it stands, or without
    the closing ``]`` or ``]}`` of the collection. All features of a line are
    read. Lines with nothing but the collection's own structure (see
    ``COLLECTION_STRUCTURE``; a fixed list of members) are dropped; any other
    line, such as a member of a feature printed over several lines, is kept as
    a ``_corrupt_record`` row, so a file in another layout lands in quarantine
    instead of being dropped. ``schema`` is the feature schema
    (``contract.read_schema(..., feature_lines=True)``); lineage columns of
    ``lines`` are kept.
    """
    lineage = [c for c in lines.columns if c in (SOURCE_FILE, SOURCE_MTIME, BLOCK_START, LINE)]
    element = T.StructType([f for f in schema.fields if f.name != CORRUPT])
    # white space (also the CR of CRLF files) and a byte-order mark at the
    # start; white space and one separating comma at the end
    trimmed = F.regexp_replace(F.col(text_col), r"^[\s\uFEFF]+|\s*,?\s*$", "")
    rows = lines.select(trimmed.alias("_text"), *lineage).filter(~F.col("_text").rlike(COLLECTION_STRUCTURE))
    rows = rows.withColumn("_body", F.regexp_replace("_text", COLLECTION_HEADER, ""))
    # a header with no feature behind it
    rows = rows.filter(~F.col("_body").rlike(r"^[\]}\s]*$"))
    body = F.col("_body")
    feats = F.coalesce(_values(body), _values(F.regexp_replace(body, r"\s*\]\s*\}?$", "")))
    # a collection that kept its header is no feature
    collection = lambda d: d.contains('"features"') & F.get_json_object(d, "$.features").isNotNull()
    rows = _objects(rows, body, element, feats, lineage, lambda d: F.when(d.isNull() | collection(d), F.col("_text")), absent="features")
    corrupt = F.coalesce("_bad", F.col("_p")[CORRUPT])
    return rows.select(corrupt.alias(CORRUPT), F.struct(*[F.col("_p")[f.name].alias(f.name) for f in element.fields]).alias("_f"), DOC, *lineage) \
               .select(F.when(F.col(CORRUPT).isNull(), F.col("_f")).alias("feature"), CORRUPT, DOC, *lineage)


def stream_collection_lines(spark: SparkSession, path: str, schema: T.StructType,
                            max_files: int | None = None, streaming: bool = True) -> DataFrame:
    """Stream (or, with ``streaming=False``, read) FeatureCollection files
    line by line, split across tasks: see ``collection_line_features``. The
    result has the shape ``plans.flows.stage`` accepts."""
    return collection_line_features(numbered_lines(_text_reader(spark, path, streaming, False, max_files)), schema)


def stream_variant(spark: SparkSession, path: str, col: str = "doc",
                   max_files: int | None = None, multi_line: bool = True,
                   streaming: bool = True) -> DataFrame:
    """Documents as one VARIANT column (S5): nothing is dropped, new fields
    included, and fields are read with ``try_variant_get``."""
    base = spark.readStream if streaming else spark.read
    reader = base.format("json").option("singleVariantColumn", col) \
                 .option("multiLine", str(multi_line).lower())
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.load(path)
