"""Rename, coerce and stamp source rows so they fit the target schema."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.names import clean_identifier, target_table_name
from tablescout.functions.types import spark_type, target_type
from tablescout.functions.values import FRACTIONAL, INTEGRAL, is_nested

# Fixed value: blank text.  (?U) makes \s cover all Unicode white space; the four
# separators \x1c-\x1f count as white space as well, which Java leaves out.
BLANK = r"(?U)^[\s\x1c-\x1f]*$"

LINEAGE_COLUMNS = ["_SOURCE_SYSTEM", "_SOURCE_DATABASE", "_SOURCE_SCHEMA", "_SOURCE_TABLE", "_INGESTED_AT"]


@dataclass(frozen=True)
class ColumnPlan:
    source: str
    target: str
    target_type: str
    # The source's own type name; a whole number without one is stored by the type it is read as.
    source_type: str = ""


def planned_columns(source_columns: DataFrame, dialect: str, suffix: str = "") -> DataFrame:
    """Column metadata with target table, target column and target type added."""
    return source_columns.withColumns(
        {
            "TARGET_TABLE": target_table_name(F.col("SOURCE_TABLE"), suffix),
            "TARGET_COLUMN": clean_identifier(F.col("SOURCE_COLUMN")),
            "TARGET_DATA_TYPE": target_type(
                dialect,
                F.col("SOURCE_DATA_TYPE"),
                F.col("SOURCE_CHARACTER_MAXIMUM_LENGTH"),
                F.col("SOURCE_NUMERIC_PRECISION"),
                F.col("SOURCE_NUMERIC_SCALE"),
            ),
        }
    )


def column_plan(planned: Sequence[Row]) -> list[ColumnPlan]:
    """The rename-and-cast plan of one table from its collected column metadata."""
    ordered = sorted(planned, key=lambda r: r.SOURCE_ORDINAL_POSITION)
    return [ColumnPlan(r.SOURCE_COLUMN, r.TARGET_COLUMN, r.TARGET_DATA_TYPE, r.SOURCE_DATA_TYPE or "") for r in ordered]


def conformed(column: Column, dtype: str, target: str, strict_boolean: bool = True, source_type: str = "") -> Column:
    """A source value in its target type.  Bad values become NULL, except bad booleans, which fail."""
    wanted = spark_type(target, source_type or dtype)
    if is_nested(dtype) or dtype == "binary":
        return column
    if isinstance(wanted, T.BooleanType):
        return column.cast(wanted) if strict_boolean else column.try_cast(wanted)
    if isinstance(wanted, T.LongType):
        if dtype in INTEGRAL:
            return column.cast(wanted)
        # Whole numbers may arrive as '12.0' or 1.2e1; go through a decimal, which rounds half up.
        number = F.round(column) if dtype in FRACTIONAL else column
        return number.try_cast(T.DecimalType(38, 0)).try_cast(wanted)
    if isinstance(wanted, T.StringType):
        text = column.cast("string")
        return F.when(~text.rlike(BLANK), text)
    return column.try_cast(wanted)


def conform(rows: DataFrame, plan: Sequence[ColumnPlan], strict_boolean: bool = True) -> DataFrame:
    """Rows with target names and types.  Columns the plan does not know are kept as text."""
    known = {c.source for c in plan}
    plan = list(plan) + [ColumnPlan(name, name, "VARCHAR") for name in rows.columns if name not in known]
    missing = [c.source for c in plan if c.source not in rows.columns]
    if missing:
        raise ValueError(f"columns missing from the source rows: {missing}")
    clashes = [name for name, n in Counter(c.target for c in plan).items() if n > 1]
    if clashes:
        raise ValueError(f"several source columns map to one target column: {clashes}")
    dtypes = dict(rows.dtypes)
    return rows.select(
        [
            conformed(
                rows[f"`{c.source.replace('`', '``')}`"], dtypes[c.source], c.target_type, strict_boolean, c.source_type
            ).alias(c.target)
            for c in plan
        ]
    )


def with_lineage(rows: DataFrame, system: str, database: str, schema: str, table: str) -> DataFrame:
    return rows.withColumns(
        {
            "_SOURCE_SYSTEM": F.lit(system),
            "_SOURCE_DATABASE": F.lit(database),
            "_SOURCE_SCHEMA": F.lit(schema),
            "_SOURCE_TABLE": F.lit(table),
            "_INGESTED_AT": F.current_timestamp(),
        }
    )
