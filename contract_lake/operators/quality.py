"""Row quality: validity rules, pass/quarantine split, contract rules, schema
conformance (Q1-Q6).

Every row-local rule is a Spark expression; all rules of a check are
evaluated in one pass (one ``select``), and the pass/quarantine decision is a
flag computed once, so both branches see the same rows. ``NULL`` results count
as failures, which makes pass and quarantine an exact partition of the input.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Property
from ..functions.columns import cast_failed, passes
from .projection import stamp_quarantine

VALID_FLAG = "_valid"
FAILED_RULES = "_failed_rules"


@dataclass(frozen=True)
class Rule:
    """A named row rule. ``expr`` is SQL text or a Column that is true for a
    good row. ``criticality`` is ``error`` (row is quarantined) or ``warn``
    (row passes, the failure is reported)."""
    name: str
    expr: str | Column
    criticality: str = "error"

    def test(self) -> Column:
        return passes(self.expr)

    @property
    def text(self) -> str:
        return self.expr if isinstance(self.expr, str) else str(self.expr)


# ---- Q1-Q4 -----------------------------------------------------------------

def expect_or_drop(df: DataFrame, name: str, rule: str | Column,
                   observation=None) -> DataFrame:
    """Keep rows that pass ``rule`` (Q3). With a ``pyspark.sql.Observation``
    the rows seen and passed are counted in the same pass
    (``observation.get`` after an action: ``{"rows": n, "passed": m}``)."""
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"),
                        F.sum(passes(rule).cast("long")).alias("passed"))
    return df.filter(passes(rule))


def quarantine_rows(df: DataFrame, rule: str, name: str | None = None,
                    stamp: bool = True) -> DataFrame:
    """Rows where ``NOT rule`` (NULL included), stamped with time, rule text
    and rule name (Q2)."""
    bad = df.filter(~passes(rule))
    return stamp_quarantine(bad, rule, name) if stamp else bad


def flag(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Add ``_failed_rules`` (names of failed error rules) and the integer
    ``_valid`` flag (1 = pass). Integer, because a boolean partition column
    reads back as text."""
    rules = [r for r in rules if r.criticality == "error"]
    failed = F.array_compact(F.array(*[F.when(~r.test(), F.lit(r.name)) for r in rules])) \
        if rules else F.array().cast("array<string>")
    return df.withColumn(FAILED_RULES, failed) \
             .withColumn(VALID_FLAG, F.when(F.size(F.col(FAILED_RULES)) == 0, 1).otherwise(0))


def split(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """(passed, quarantined) as an exact partition of ``df`` (Q4)."""
    flagged = flag(df, rules)
    return (flagged.filter(F.col(VALID_FLAG) == 1),
            flagged.filter(F.col(VALID_FLAG) == 0))


def split_counts(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """One row: rows in, passed, quarantined; one aggregation over one scan."""
    flagged = flag(df, rules)
    return flagged.agg(F.count(F.lit(1)).alias("n_in"),
                       F.sum(F.col(VALID_FLAG)).cast("long").alias("n_pass"),
                       F.sum(1 - F.col(VALID_FLAG)).cast("long").alias("n_quarantine"))


# ---- Q5: rules derived from the contract -----------------------------------

def _ident(col: str) -> str:
    return "`" + col.replace("`", "``") + "`"


def _literal(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


# Rule builders return SQL text, so a rule can be defined before any session
# exists and its text can be stored with the quarantined row.

def required(col: str, criticality: str = "error") -> Rule:
    return Rule(f"{col}_required", f"{_ident(col)} IS NOT NULL", criticality)


def not_blank_rule(col: str, criticality: str = "error") -> Rule:
    c = _ident(col)
    return Rule(f"{col}_not_blank", f"{c} IS NOT NULL AND TRIM({c}) != ''", criticality)


def between(col: str, low=None, high=None, criticality: str = "error") -> Rule:
    """Range rule; meant for typed contract columns (a text column compared
    with numbers fails under ANSI mode, so check its type with ``castable``)."""
    c = _ident(col)
    bounds = []
    if low is not None:
        bounds.append(f"{c} >= {_literal(low)}")
    if high is not None:
        bounds.append(f"{c} <= {_literal(high)}")
    cond = " AND ".join(bounds) or "true"
    return Rule(f"{col}_range", f"{c} IS NULL OR ({cond})", criticality)


def one_of(col: str, values: list, criticality: str = "error") -> Rule:
    c = _ident(col)
    return Rule(f"{col}_allowed", f"{c} IS NULL OR {c} IN ({', '.join(_literal(v) for v in values)})",
                criticality)


def matches(col: str, pattern: str, criticality: str = "error") -> Rule:
    c = _ident(col)
    return Rule(f"{col}_pattern", f"{c} IS NULL OR {c} RLIKE {_literal(pattern)}", criticality)


def castable(col: str, dtype: T.DataType, criticality: str = "error") -> Rule:
    c = _ident(col)
    return Rule(f"{col}_type", f"NOT ({c} IS NOT NULL AND try_cast({c} AS {dtype.simpleString()}) IS NULL)",
                criticality)


def unique_failures(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs more than once (the ``unique`` rule). Not
    row-local: one combinable count per key (pre-aggregated map-side, so a
    key with millions of copies costs one partial row per task), then a semi
    join back; a hot duplicated key on the big side is split by AQE's skew
    join. Run it in batch or on the landing log, not inside the stream."""
    dups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).filter(F.col("_copies") > 1)
    return df.join(dups.select(*keys), keys, "left_semi")


def contract_rules(properties: Iterable[Property], spec: dict | None = None,
                   default_criticality: str = "error") -> list[Rule]:
    """Rules from a contract: a type rule for every typed property, plus the
    explicit ``spec`` per property name: ``{"required": True, "min": .., "max": ..,
    "pattern": .., "values": [..], "criticality": "warn"}``."""
    spec = spec or {}
    rules: list[Rule] = []
    for prop in properties:
        s = spec.get(prop.name, {})
        crit = s.get("criticality", default_criticality)
        if s.get("required"):
            rules.append(required(prop.name, crit))
        if "min" in s or "max" in s:
            rules.append(between(prop.name, s.get("min"), s.get("max"), crit))
        if "values" in s:
            rules.append(one_of(prop.name, s["values"], crit))
        if "pattern" in s:
            rules.append(matches(prop.name, s["pattern"], crit))
        if s.get("check_type"):
            rules.append(castable(prop.name, prop.spark_type(), crit))
    return rules


def check_rows(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Add ``_errors`` and ``_warnings``: arrays of failed rule names, all
    rules evaluated in one projection."""
    rules = list(rules)

    def failed(kind: str) -> Column:
        chosen = [r for r in rules if r.criticality == kind]
        if not chosen:
            return F.array().cast("array<string>")
        return F.array_compact(F.array(*[F.when(~r.test(), F.lit(r.name)) for r in chosen]))

    return df.withColumn("_errors", failed("error")).withColumn("_warnings", failed("warn"))


def rule_failures(df: DataFrame, rules: Iterable[Rule], id_cols: list[str]) -> DataFrame:
    """One row per (row, failed rule): ``id_cols..., rule, criticality``."""
    rules = list(rules)
    failures = F.array_compact(F.array(*[
        F.when(~r.test(), F.struct(F.lit(r.name).alias("rule"),
                                   F.lit(r.criticality).alias("criticality")))
        for r in rules]))
    return df.select(*id_cols, F.explode(failures).alias("f")) \
             .select(*id_cols, "f.rule", "f.criticality")


# ---- Q6: schema conformance --------------------------------------------------

def check_schema(df: DataFrame, properties: Iterable[Property],
                 extended_types: bool = False) -> DataFrame:
    """Compare ``df`` with the contract and count cast failures per column.

    Returns one row per contract property and per extra column: ``column,
    expected_type, actual_type, issue, n_present, n_cast_failed``. ``issue``
    is ``ok``, ``missing``, ``extra``, ``unknown_type`` or ``cast_failures``.
    The counts come from a single aggregation over the data; the comparison
    of names and types is driver-side metadata.
    """
    properties = list(properties)
    actual = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    present = [p for p in properties if p.name in actual]
    for p in present:
        target = p.spark_type(extended_types)
        c = F.col(p.name)
        aggs.append(F.count(c).alias(f"p__{p.name}"))
        if isinstance(actual[p.name], T.StringType) and not isinstance(target, T.StringType):
            aggs.append(F.count_if(cast_failed(c, target)).alias(f"f__{p.name}"))
        else:
            aggs.append(F.lit(0).cast("long").alias(f"f__{p.name}"))
    counts = df.agg(*aggs) if aggs else df.sparkSession.range(1).select()

    rows = []
    for p in properties:
        target = p.spark_type(extended_types)
        if p.name not in actual:
            rows.append(F.struct(F.lit(p.name).alias("column"), F.lit(target.simpleString()).alias("expected_type"),
                                 F.lit(None).cast("string").alias("actual_type"),
                                 F.lit("missing").alias("issue"),
                                 F.lit(None).cast("long").alias("n_present"),
                                 F.lit(None).cast("long").alias("n_cast_failed")))
            continue
        n_fail = F.col(f"f__{p.name}")
        issue = F.when(F.lit(not p.is_known_type(extended_types)), F.lit("unknown_type")) \
                 .when(n_fail > 0, F.lit("cast_failures")).otherwise(F.lit("ok"))
        rows.append(F.struct(F.lit(p.name).alias("column"), F.lit(target.simpleString()).alias("expected_type"),
                             F.lit(actual[p.name].simpleString()).alias("actual_type"),
                             issue.alias("issue"),
                             F.col(f"p__{p.name}").cast("long").alias("n_present"),
                             n_fail.cast("long").alias("n_cast_failed")))
    names = {p.name for p in properties}
    for name, dtype in actual.items():
        if name not in names:
            rows.append(F.struct(F.lit(name).alias("column"), F.lit(None).cast("string").alias("expected_type"),
                                 F.lit(dtype.simpleString()).alias("actual_type"),
                                 F.lit("extra").alias("issue"),
                                 F.lit(None).cast("long").alias("n_present"),
                                 F.lit(None).cast("long").alias("n_cast_failed")))
    return counts.select(F.inline(F.array(*rows)))
