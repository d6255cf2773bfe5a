"""Column expressions shared by the operators. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Log level names in rising severity, with their numeric
# levels, and the level used when a configured one is empty or unknown.
LOG_LEVELS: dict[str, int] = {
    "DEBUG": 10,
    "INFO": 20,
    "WARNING": 30,
    "ERROR": 40,
    "CRITICAL": 50,
}
DEFAULT_LOG_LEVEL = "INFO"

# Fixed value: the shipped validity rule, stated on the contract key column.
VALIDITY_RULE_TEMPLATE = "{key} IS NOT NULL AND TRIM({key}) != ''"


def hashable(dtype: T.DataType) -> bool:
    """Whether Spark's hash functions take values of ``dtype`` (maps and
    VARIANT values are refused, also nested)."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(hashable(f.dataType) for f in dtype.fields)
    return True


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def validity_rule(key: str) -> str:
    """The rule text: key present and not blank after trimming spaces."""
    return VALIDITY_RULE_TEMPLATE.format(key=key)


def not_blank(c: str | Column) -> Column:
    """``c IS NOT NULL AND TRIM(c) != ''``; TRIM strips spaces only, so a tab
    or a no-break space counts as content."""
    c = _col(c)
    return c.isNotNull() & (F.trim(c) != F.lit(""))


def passes(rule: str | Column) -> Column:
    """A rule as a two-valued test: NULL counts as failed, so every row lands
    in exactly one of the pass and quarantine branches."""
    expr = F.expr(rule) if isinstance(rule, str) else rule
    return F.coalesce(expr, F.lit(False))


def resolve_path(df: DataFrame, path: str, strict: bool = False) -> tuple[Column, T.DataType]:
    """Resolve a dotted source path against ``df``'s schema.

    Walks nested structs; if the walk reaches a string column with path left
    over, the rest is read from that JSON text with ``get_json_object``; if it
    reaches a VARIANT, the rest is read with ``try_variant_get`` as text. A
    path that does not exist gives a NULL string (or raises when ``strict``).
    """
    parts = path.split(".")
    dtype: T.DataType = df.schema
    walked: list[str] = []
    for i, part in enumerate(parts):
        if isinstance(dtype, T.StructType) and part in dtype.fieldNames():
            dtype = dtype[part].dataType
            walked.append(part)
            continue
        if isinstance(dtype, T.StringType) and walked:
            base = F.col(".".join(f"`{p}`" for p in walked))
            json_path = "$." + ".".join(parts[i:])
            return F.get_json_object(base, json_path), T.StringType()
        if isinstance(dtype, T.VariantType) and walked:
            base = F.col(".".join(f"`{p}`" for p in walked))
            return F.try_variant_get(base, "$." + ".".join(parts[i:]), "string"), T.StringType()
        if strict:
            raise ValueError(f"source path {path!r} not found in schema {df.schema.simpleString()}")
        return F.lit(None).cast(T.StringType()), T.StringType()
    return F.col(".".join(f"`{p}`" for p in walked)), dtype


def typed(src: Column, src_type: T.DataType, target: T.DataType, lenient: bool = True, truncate: bool = False) -> Column:
    """Cast ``src`` to ``target`` the way the contract means it.

    * nested values asked for as string become JSON text, not display text;
    * text to a non-string type uses ``try_cast`` when lenient, so a bad value
      becomes NULL and is caught by :func:`cast_failed`, instead of stopping
      the job under ANSI mode;
    * everything else is a plain cast (fractional numbers truncate to integers).
    """
    if isinstance(target, T.StringType):
        if isinstance(src_type, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(src)
        return src.cast(target)
    if src_type == target:
        return src
    if lenient:
        return text_try_cast(src, target, truncate) if isinstance(src_type, T.StringType) else src.try_cast(target)
    return src.cast(target)


# The text Spark reads as a boolean (any case, after trimming
# characters up to U+0020 at both ends).
BOOLEAN_TEXT = ("t", "true", "y", "yes", "1", "f", "false", "n", "no", "0")
EDGE_CONTROL = r"^[\x00-\x20]+|[\x00-\x20]+$"
NOT_INTEGRAL_TEXT = r"[^\x00-\x20+\-0-9]"
# A decimal number in text: with a fraction, an exponent, or both.
DECIMAL_TEXT = r"^[\x00-\x20]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?[\x00-\x20]*$"


def text_try_cast(src: Column, target: T.DataType, truncate: bool = False) -> Column:
    """``try_cast`` of text, with values that cannot convert answered NULL
    up front. To integral and boolean types Spark evaluates ``try_cast`` as
    the strict cast inside try/catch, so every failing value costs an
    exception; text holding a character no integer can contain, or a
    boolean word Spark does not know, skips the cast. Every other value still
    goes through ``try_cast``, so the result is the same; but text of a whole
    number in another form (JSON ``7.0`` or ``7e2``) is that number, and with
    ``truncate`` a fraction is cut off as a plain cast of a number does."""
    if isinstance(target, T.IntegralType):
        number = src.try_cast(T.DecimalType(38, 18))
        whole = number.try_cast(target)
        if not truncate:
            whole = F.when(number == whole, whole)
        return F.when(~src.rlike(NOT_INTEGRAL_TEXT), src.try_cast(target)).when(src.rlike(DECIMAL_TEXT), whole)
    if isinstance(target, T.BooleanType):
        word = F.lower(F.regexp_replace(src, EDGE_CONTROL, ""))
        return F.when(word.isin(*BOOLEAN_TEXT), src.try_cast(target)).otherwise(F.lit(None).cast(target))
    return src.try_cast(target)


def cast_failed(src: Column, target: T.DataType, truncate: bool = False) -> Column:
    """True where a present text value does not survive the cast to
    ``target``."""
    return src.isNotNull() & text_try_cast(src, target, truncate).isNull()


def iso_utc(ts: str | Column) -> Column:
    """Python ``datetime.isoformat()`` text of a UTC timestamp: microseconds
    are printed only when non-zero."""
    ts = _col(ts)
    with_fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    without = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == F.lit("000000"), without).otherwise(with_fraction)


def severity(level: str | Column) -> Column:
    """Numeric level of a level name, NULL for an unknown name."""
    level = F.upper(F.trim(_col(level)))
    expr = F.lit(None).cast("int")
    for name, value in LOG_LEVELS.items():
        expr = F.when(level == F.lit(name), F.lit(value)).otherwise(expr)
    return expr


def normalize_level(level: str | None) -> str:
    """Configured threshold: upper-cased, and INFO when empty or unknown."""
    name = (level or "").strip().upper()
    return name if name in LOG_LEVELS else DEFAULT_LOG_LEVEL
