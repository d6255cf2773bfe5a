"""Contract projection (P2-P6) and stamps.

``project_by_contract`` turns one exploded feature row into exactly the
columns a contract entry declares: resolve the source path, cast to the
physical type, rename. A property without a source path is a typed NULL.
The result is a single ``select``, so Catalyst prunes unread fields and the
whole projection runs in one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import Property
from ..functions.columns import cast_failed, resolve_path, typed

CAST_FAILURES = "_cast_failures"


def projection_columns(df: DataFrame, properties: list[Property] | tuple[Property, ...],
                       lenient: bool = True, strict_paths: bool = False,
                       extended_types: bool = False, truncate: bool = False) -> list[Column]:
    """One column per property, in contract order."""
    cols = []
    for prop in properties:
        target = prop.spark_type(extended_types)
        if prop.source_path:
            src, src_type = resolve_path(df, prop.source_path, strict=strict_paths)
            col = typed(src, src_type, target, lenient=lenient, truncate=truncate)
        else:
            col = F.lit(None).cast(target)
        cols.append(col.alias(prop.name))
    return cols


def cast_failure_column(df: DataFrame, properties, extended_types: bool = False, truncate: bool = False) -> Column:
    """Array of the property names whose present source value failed its cast.

    Only text sources can fail (typed sources are cast exactly as Spark casts);
    an empty array means the row converted cleanly.
    """
    checks = []
    for prop in properties:
        if not prop.source_path:
            continue
        target = prop.spark_type(extended_types)
        src, src_type = resolve_path(df, prop.source_path)
        if src_type.typeName() == "string" and target.typeName() != "string":
            checks.append(F.when(cast_failed(src, target, truncate), F.lit(prop.name)))
    if not checks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*checks))


def project_by_contract(df: DataFrame, properties, keep: list[str] | None = None,
                        lenient: bool = True, strict_paths: bool = False,
                        with_cast_failures: bool = False,
                        extended_types: bool = False, truncate: bool = False) -> DataFrame:
    """Select the contract columns (plus ``keep`` pass-through columns).

    ``lenient=True`` uses ``try_cast`` for text, so an unparseable value is
    NULL (``truncate=True``: fractions are cut off for integer types, as the
    reference's cast of inferred numbers does); ``with_cast_failures=True`` adds ``_cast_failures`` (array of
    property names) so those rows can be quarantined rather than silently
    nulled.
    """
    cols = projection_columns(df, properties, lenient=lenient, strict_paths=strict_paths,
                              extended_types=extended_types, truncate=truncate)
    extra = [F.col(c) for c in (keep or [])]
    if with_cast_failures:
        extra.append(cast_failure_column(df, properties, extended_types, truncate).alias(CAST_FAILURES))
    return df.select(*cols, *extra)


def stamp(df: DataFrame, name: str = "processing_timestamp") -> DataFrame:
    """Processing time, one value per query (per micro-batch on a stream)."""
    return df.withColumn(name, F.current_timestamp())


def stamp_quarantine(df: DataFrame, rule_text: str, rule_name: str | None = None,
                     time_col: str = "quarantine_timestamp") -> DataFrame:
    """Quarantine stamp: time, the failed rule's text, and its name."""
    out = df.withColumn(time_col, F.current_timestamp()) \
            .withColumn("validation_rule_failed", F.lit(rule_text))
    if rule_name is not None:
        out = out.withColumn("validation_rule_name", F.lit(rule_name))
    return out
