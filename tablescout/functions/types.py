"""Source type → target type rules as a Column, and target type → Spark type."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type names per dialect, by the target type they map to.
DIALECT_TYPES = {
    "sqlserver": {
        "NUMBER(38,0)": ["bigint", "int", "smallint", "tinyint"],
        "BOOLEAN": ["bit"],
        "NUMBER": ["decimal", "numeric", "money", "smallmoney"],
        "FLOAT": ["float", "real"],
        "DATE": ["date"],
        "TIMESTAMP_NTZ": ["datetime", "datetime2", "smalldatetime"],
        "TIMESTAMP_TZ": ["datetimeoffset"],
        "TIME": ["time"],
        "VARCHAR(36)": ["uniqueidentifier"],
        "BINARY": ["binary", "varbinary", "image"],
        "VARCHAR": ["varchar", "nvarchar", "char", "nchar", "text", "ntext", "xml"],
    },
    "redshift": {
        "NUMBER(38,0)": ["smallint", "integer", "bigint"],
        "NUMBER": ["numeric", "decimal"],
        "FLOAT": ["real", "double precision"],
        "BOOLEAN": ["boolean"],
        "DATE": ["date"],
        "TIMESTAMP_NTZ": ["timestamp without time zone", "timestamp"],
        "TIMESTAMP_TZ": ["timestamp with time zone"],
        "VARCHAR": ["character varying", "varchar", "character", "char", "text"],
    },
}

# Defaults for decimals without precision / scale, and the length cap.
MAX_PRECISION = 38
DEFAULT_SCALE = 4
MAX_TEXT_LENGTH = 16777216

# Source types of whole numbers that fit 64 bits.
WHOLE_TYPES = ["bigint", "int", "integer", "smallint", "tinyint"]

# Spark types in the vocabulary of each dialect, for sources that have no information schema.
SPARK_TYPE_NAMES = {
    "redshift": {
        "tinyint": "smallint", "smallint": "smallint", "int": "integer", "bigint": "bigint",
        "float": "real", "double": "double precision", "boolean": "boolean", "date": "date",
        "timestamp_ntz": "timestamp without time zone", "timestamp": "timestamp with time zone",
        "string": "character varying",
    },
    "sqlserver": {
        "tinyint": "tinyint", "smallint": "smallint", "int": "int", "bigint": "bigint",
        "float": "real", "double": "float", "boolean": "bit", "date": "date",
        "timestamp_ntz": "datetime2", "timestamp": "datetimeoffset",
        "string": "nvarchar", "binary": "varbinary",
    },
}


def dialect_type_name(dialect: str, data_type: T.DataType) -> str:
    if isinstance(data_type, T.DecimalType):
        return "decimal"
    simple = data_type.simpleString()
    return SPARK_TYPE_NAMES[dialect].get(simple, simple)


def target_type(dialect: str, data_type: Column, length: Column, precision: Column, scale: Column) -> Column:
    """The target type of a source column; anything unknown is VARCHAR."""
    kinds = DIALECT_TYPES[dialect]
    name = F.lower(data_type)
    unbounded = length.isNull()
    if dialect == "sqlserver":
        unbounded = unbounded | (length < 0)
    number = F.format_string(
        "NUMBER(%d,%d)",
        F.least(F.coalesce(precision.cast("int"), F.lit(MAX_PRECISION)), F.lit(MAX_PRECISION)),
        F.coalesce(scale.cast("int"), F.lit(DEFAULT_SCALE)),
    )
    text = F.when(unbounded, "VARCHAR").otherwise(
        F.format_string("VARCHAR(%d)", F.least(length.cast("long"), F.lit(MAX_TEXT_LENGTH).cast("long")))
    )
    result = None
    for target, names in kinds.items():
        value = {"NUMBER": number, "VARCHAR": text}.get(target, F.lit(target))
        result = F.when(name.isin(names), value) if result is None else result.when(name.isin(names), value)
    return result.otherwise("VARCHAR")


def spark_type(target: str, source_type: str = "") -> T.DataType:
    """The Spark type a target type is stored as.

    NUMBER(38,0) holds both the source's integers, which are stored as LONG, and its decimals of that
    size, which keep all their digits.
    """
    if target.startswith("NUMBER"):
        precision, scale = (int(part) for part in re.findall(r"\d+", target))
        whole = scale == 0 and precision == MAX_PRECISION and source_type.lower() in WHOLE_TYPES
        return T.LongType() if whole else T.DecimalType(precision, scale)
    return {
        "FLOAT": T.DoubleType(),
        "BOOLEAN": T.BooleanType(),
        "DATE": T.DateType(),
        "TIMESTAMP_NTZ": T.TimestampNTZType(),
        "TIMESTAMP_TZ": T.TimestampType(),
        "BINARY": T.BinaryType(),
    }.get(target, T.StringType())
