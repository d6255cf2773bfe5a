"""Schema drift of JSON documents (S5): which top-level fields appear, in how
many documents, and whether the contract knows them; plus the merged type
schema of all documents.

Both are combinable aggregations (``count`` and ``schema_of_variant_agg``
merge partial results map-side), so a field present in every document costs
one partial row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_text(docs: DataFrame, col: str) -> Column:
    if docs.schema[col].dataType.typeName() == "variant":
        return F.to_json(F.col(col))
    return F.col(col)


def _as_variant(docs: DataFrame, col: str) -> Column:
    if docs.schema[col].dataType.typeName() == "variant":
        return F.col(col)
    return F.try_parse_json(F.col(col))


def schema_drift(docs: DataFrame, col: str, known: list[str]) -> DataFrame:
    """Rows ``field, n_docs, is_new`` for the top-level fields of the JSON
    text or VARIANT column ``col``."""
    fields = docs.select(F.explode(F.json_object_keys(_as_text(docs, col))).alias("field"))
    return fields.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs")) \
                 .withColumn("is_new", ~F.col("field").isin(list(known)))


def merged_schema(docs: DataFrame, col: str) -> DataFrame:
    """One row: the merged type of all documents, e.g. ``OBJECT<k: BIGINT>``."""
    return docs.agg(F.schema_of_variant_agg(_as_variant(docs, col)).alias("merged_schema"))
