"""Feature-collection operators: explode (P1), flatten (P9), tag changes.

A feature collection is one document with a ``features`` array; these
operators turn it into one row per feature, or rewrite every feature in place
without leaving the document. All are narrow (no shuffle): each document is
handled inside the task that read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE_FIELD = "__change__"


def explode_features(df: DataFrame, col: str = "features", alias: str = "feature",
                     outer: bool = False, position: str | None = None,
                     keep: list[str] | None = None) -> DataFrame:
    """One row per element of ``col``.

    With ``outer=False`` (the default, as in the reference) a document whose
    array is empty or NULL produces no row; ``outer=True`` keeps it with a NULL
    feature so that corrupt or empty documents can be routed to quarantine.
    ``position`` names a column for the element's index in its document, a
    stable tie-breaker for rows of one document. ``keep`` lists other columns
    to carry (default: all but the array itself).
    """
    others = [c for c in (keep if keep is not None else df.columns) if c != col]
    if position:
        gen = F.posexplode_outer(col) if outer else F.posexplode(col)
        exploded = df.select(*others, gen.alias(position, alias))
    else:
        gen = F.explode_outer(col) if outer else F.explode(col)
        exploded = df.select(*others, gen.alias(alias))
    return exploded


def variant_features(df: DataFrame, col: str = "doc", features_col: str = "features") -> DataFrame:
    """Expose the ``features`` array of a VARIANT document (S5 source) as
    ``array<variant>``, ready for :func:`explode_features`; contract paths
    then resolve inside each feature with ``try_variant_get``."""
    return df.withColumn(features_col, F.try_variant_get(F.col(col), "$.features", "array<variant>")) \
             .drop(col)


def flatten_features(df: DataFrame, col: str = "features") -> DataFrame:
    """Explode and pick ``id``, ``geometry.type``, ``geometry.coordinates`` and
    every field of ``properties`` as top-level columns."""
    feature = explode_features(df, col=col, keep=[])
    return feature.select("feature.id", "feature.geometry.type",
                          "feature.geometry.coordinates", "feature.properties.*")


def tag_changes(df: DataFrame, change: str | Column, col: str = "features",
                field: str = CHANGE_FIELD) -> DataFrame:
    """Set ``properties.<field>`` on every feature of each document.

    Rewrites the array with ``transform`` + ``withField``; the document stays
    one row, so no explode and no regroup are needed.
    """
    value = F.lit(change) if isinstance(change, str) else change
    return df.withColumn(col, F.transform(col, lambda f: f.withField(f"properties.{field}", value)))
