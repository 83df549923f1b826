"""Text forms, key normalisation and ratios as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGRAL = {"tinyint", "smallint", "int", "bigint"}
FRACTIONAL = {"float", "double"}
NESTED = ("array", "map", "struct", "variant")


def is_nested(dtype: str) -> bool:
    return dtype.startswith(NESTED)


def has_text_order(dtype: str) -> bool:
    """Whether MIN / MAX of the text form is reported for a type."""
    return not is_nested(dtype) and dtype != "binary"


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


# The expressions below are SQL text over a column name: a job over many tables applies them to
# hundreds of columns, and ``selectExpr`` takes each as one string.


def text_form(name: str, dtype: str) -> str:
    """The text of a value.  ``-0.0`` reads as ``0.0``: both are one typed value."""
    column = quoted(name)
    if is_nested(dtype):
        json = f"to_json(struct({column} AS v), map('ignoreNullFields', 'false'))"
        return f"CASE WHEN {column} IS NOT NULL THEN {json} END"
    if dtype in FRACTIONAL:
        return f"cast({column} + cast(0 AS {dtype}) AS string)"
    return column if dtype == "string" else f"cast({column} AS string)"


def is_negative_zero(name: str) -> str:
    """Whether a float or double is ``-0.0``, which equals ``0.0`` but has another text."""
    column = quoted(name)
    return f"coalesce({column} = 0 AND cast({column} AS string) = '-0.0', false)"


def common_domain(left: str, right: str) -> str:
    """The type in which equality of two columns is the same as equality of their text.

    Integers of any width print alike, and two columns of one type compare the same typed or
    as text, so only mixed types need the (wider, slower) text comparison.
    """
    if left in INTEGRAL and right in INTEGRAL:
        return "bigint"
    return left if left == right and not is_nested(left) else "string"


def in_domain(name: str, dtype: str, domain: str) -> str:
    if domain == "string":
        return text_form(name, dtype)
    return quoted(name) if domain == dtype else f"cast({quoted(name)} AS {domain})"


def join_key(name: str, dtype: str, domain: str) -> str:
    """Normalised join key: text is trimmed, with blank as NULL; other types need neither."""
    if domain == "string":
        return f"nullif(trim({text_form(name, dtype)}), '')"
    return in_domain(name, dtype, domain)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def watermark_text(value: Column, dtype: str) -> Column:
    """Text of a watermark that casts back to the same value; NaN counts as none."""
    if dtype == "timestamp":
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    if dtype in FRACTIONAL:
        value = F.when(~F.isnan(value), value)
    return value.cast("string")
