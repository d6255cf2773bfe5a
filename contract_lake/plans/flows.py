"""One contract entry end to end, as composable DataFrame steps.

stage:   explode -> project by contract (+ cast failures) -> stamp
rules:   the entry's validity rules (key not blank, sequence present, casts ok)
split:   one flag, two filters: passed and quarantined are an exact partition
history: SCD Type 2 over the passed rows

The same functions serve the batch path (here) and the streaming path
(``streaming.ingest``), which lands the flagged rows once and builds history
from the landing log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Entry, read_schema
from ..functions.columns import validity_rule
from ..operators.cdc import scd2
from ..operators.features import explode_features
from ..operators.projection import CAST_FAILURES, project_by_contract, stamp
from ..operators.quality import FAILED_RULES, VALID_FLAG, Rule, flag
from ..sources.documents import BLOCK_START, CORRUPT, DOC, LINE, SOURCE_FILE, SOURCE_MTIME

PROCESSING_TIME = "processing_timestamp"
POSITION = "_pos"
RULE_TEXT, RULE_NAME, QUARANTINE_TIME = "validation_rule_failed", "validation_rule_name", "quarantine_timestamp"
# Tie-break order for rows that share a sequence value: file time, file,
# block of the file, line of the block, document of the text, position in the
# document (later wins). The same order whatever the reader.
LINEAGE = [SOURCE_MTIME, SOURCE_FILE, BLOCK_START, LINE, DOC, POSITION]


def stage(docs: DataFrame, entry: Entry, extended_types: bool = True,
          with_stamp: bool = True, outer: bool = False) -> DataFrame:
    """Explode the documents and project each feature onto the contract.

    ``docs`` holds either feature collections (a ``features`` array) or one
    ``feature`` per row. Keeps the lineage columns present in ``docs``
    (source file, its modification time, the feature's position) for
    deterministic ties, and ``_cast_failures``. ``outer=True`` keeps documents that yield no feature
    (empty, NULL or corrupt) as one all-NULL row, so they can be quarantined.
    """
    lineage = [c for c in docs.columns if c in (SOURCE_FILE, SOURCE_MTIME, BLOCK_START, LINE, DOC, CORRUPT)]
    if "features" in docs.columns:
        exploded = explode_features(docs, position=POSITION, outer=outer, keep=lineage)
    else:
        # one feature per row already: its line and its place in the line order it
        exploded = docs.select("feature", *lineage, F.lit(0).alias(POSITION))
    keep = [c for c in (*LINEAGE, CORRUPT) if c in exploded.columns]
    staged = project_by_contract(exploded, entry.properties, keep=keep, lenient=True,
                                 with_cast_failures=True, extended_types=extended_types, truncate=entry.truncate)
    return stamp(staged, PROCESSING_TIME) if with_stamp else staged


def entry_rules(entry: Entry, extra: list[Rule] | None = None, parsed: bool = False) -> list[Rule]:
    """Validity rules: the reference's key rule (on the contract key), a
    non-NULL sequence (a NULL one cannot be ordered), and clean casts; with
    ``parsed`` (the rows carry ``_corrupt_record``) also a text that parsed."""
    rules = [Rule("valid_id", validity_rule(entry.key))]
    if parsed:
        rules.append(Rule("text_parsed", f"{CORRUPT} IS NULL"))
    if entry.sequence_by and entry.sequence_by != PROCESSING_TIME:
        rules.append(Rule("sequence_present", f"{entry.sequence_by} IS NOT NULL"))
    rules.append(Rule("casts_ok", f"size({CAST_FAILURES}) = 0"))
    return rules + list(extra or [])


def flagged(staged: DataFrame, entry: Entry, extra: list[Rule] | None = None) -> DataFrame:
    """``staged`` with ``_failed_rules`` and the integer ``_valid`` flag."""
    return flag(staged, entry_rules(entry, extra, CORRUPT in staged.columns))


def passed(flagged_rows: DataFrame) -> DataFrame:
    return flagged_rows.filter(F.col(VALID_FLAG) == 1)


def rule_texts(rules: list[Rule]) -> F.Column:
    """The SQL text of the failed rules, one per line, from their names."""
    texts = F.create_map(*[x for r in rules for x in (F.lit(r.name), F.lit(r.text))])
    return F.array_join(F.transform(F.col(FAILED_RULES), lambda n: F.element_at(texts, n)), "\n")


def quarantine_columns(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """The quarantine stamp of failed rows: text of every failed rule, one per
    line, their names, and the time (NULL for rows that passed)."""
    failed = F.col(VALID_FLAG) == 0
    return rows.withColumn(RULE_TEXT, F.when(failed, rule_texts(rules))) \
               .withColumn(RULE_NAME, F.when(failed, F.array_join(F.col(FAILED_RULES), ","))) \
               .withColumn(QUARANTINE_TIME, F.when(failed, F.current_timestamp()))


def quarantined(flagged_rows: DataFrame, entry: Entry, extra: list[Rule] | None = None) -> DataFrame:
    """Failed rows with the quarantine stamp."""
    rules = entry_rules(entry, extra, CORRUPT in flagged_rows.columns)
    return quarantine_columns(flagged_rows.filter(F.col(VALID_FLAG) == 0), rules)


def landed(staged: DataFrame, entry: Entry, extra: list[Rule] | None = None) -> DataFrame:
    """Staged rows as the landing log holds them: flagged and stamped."""
    return quarantine_columns(flagged(staged, entry, extra), entry_rules(entry, extra, CORRUPT in staged.columns))


def landing_schema(spark: SparkSession, entry: Entry, extended_types: bool = True) -> T.StructType:
    """Schema of the entry's landing log as the contract stands now, with the
    lineage columns of every reader. Files written before a property was added
    lack its column and read as NULL."""
    docs = spark.createDataFrame([], T.StructType([
        *read_schema(entry.properties).fields, T.StructField(CORRUPT, T.StringType()), T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(SOURCE_MTIME, T.TimestampType()), T.StructField(BLOCK_START, T.LongType()), T.StructField(LINE, T.LongType()),
        T.StructField(DOC, T.IntegerType())]))
    return landed(stage(docs, entry, extended_types=extended_types, outer=True), entry).schema


def ties(rows: DataFrame) -> list[str]:
    """The columns that order rows of one sequence value."""
    return [c for c in LINEAGE if c in rows.columns]


def history_rows(valid_rows: DataFrame) -> DataFrame:
    """The columns of valid rows that history has and is ordered by."""
    return valid_rows.select(*[c for c in valid_rows.columns
                               if c not in (VALID_FLAG, FAILED_RULES, CAST_FAILURES, CORRUPT, RULE_TEXT, RULE_NAME, QUARANTINE_TIME)])


def history(valid_rows: DataFrame, entry: Entry, track: list[str] | None = None,
            delete_when=None, max_rows_per_segment: int = 2_000_000, plan=...) -> DataFrame:
    """SCD Type 2 over valid rows, keyed by the contract key and sequenced by
    the entry's sequence (processing time when none is given); ties broken by
    source file time, file and place in the file. ``track`` and
    ``delete_when`` default to the contract's."""
    track = list(entry.track) if track is None and entry.track else track
    delete_when = entry.delete_when if delete_when is None else delete_when
    seq = entry.sequence_by or PROCESSING_TIME
    return scd2(history_rows(valid_rows), entry.key, seq, tie_break=ties(valid_rows), track=track,
                delete_when=delete_when, max_rows_per_segment=max_rows_per_segment, plan=plan)


def land_batch(rows: DataFrame, landing: str) -> DataFrame:
    """Write flagged rows once as the landing table (Parquet, partitioned by
    ``_valid``) and read it back. Both branches then read one materialized
    copy, later passes scan only the columns they need, and the lineage is
    cut, so a lost executor never forces the explode and projection again."""
    rows.write.mode("errorifexists").partitionBy(VALID_FLAG).parquet(landing)
    return rows.sparkSession.read.parquet(landing)


def run_entry_batch(docs: DataFrame, entry: Entry, track: list[str] | None = None,
                    delete_when=None, extended_types: bool = True,
                    landing: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(history, quarantine) for a batch of documents; with ``landing`` the
    flagged rows are landed there first (recommended beyond small inputs)."""
    rows = flagged(stage(docs, entry, extended_types=extended_types), entry)
    if landing is not None:
        rows = land_batch(rows, landing)
    return history(passed(rows), entry, track=track, delete_when=delete_when), quarantined(rows, entry)
