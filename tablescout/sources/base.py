"""What a source is: named tables, their column metadata, and DataFrame reads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.types import dialect_type_name
from tablescout.local import catalog_rows, local_frame
from tablescout.schemas import SOURCE_COLUMNS

TABLE_NAMES = T.StructType([T.StructField("TABLE_NAME", T.StringType())])


@dataclass(frozen=True)
class Watermark:
    """A stored high-water mark: its text and the Spark type to compare it in."""

    value: str
    type: str

    def literal(self) -> Column:
        return F.lit(self.value).cast(self.type)


class Source:
    """Base of all sources.  Subclasses give ``table_names`` and ``read``."""

    def __init__(self, spark: SparkSession, name: str, database: str, schema: str, dialect: str):
        self.spark = spark
        self.name = name
        self.database = database
        self.schema = schema
        self.dialect = dialect

    def table_names(self) -> list[str]:
        raise NotImplementedError

    def read(self, table: str) -> DataFrame:
        raise NotImplementedError

    def tables(self) -> DataFrame:
        return local_frame(self.spark, [{"TABLE_NAME": t} for t in self.table_names()], TABLE_NAMES)

    def columns(self, table: str) -> DataFrame:
        """Column metadata of a table, in ordinal order, from its schema."""
        return schema_columns(self.spark, table, self.read(table).schema, self.dialect)

    def row_count(self, table: str) -> int:
        return self.read(table).count()

    def read_since(self, table: str, column: str, since: Watermark | None) -> DataFrame:
        """Rows past the watermark; everything when none is stored.  The filter reaches the scan."""
        rows = self.read(table)
        return rows if since is None else rows.where(F.col(column) > since.literal())

    def count_since(self, table: str, column: str, since: Watermark | None) -> int:
        return self.row_count(table) if since is None else self.read_since(table, column, since).count()

    def max_watermark(self, table: str, column: str) -> DataFrame:
        """The newest watermark of a table (NULL when it has none)."""
        return self.read(table).agg(F.max(column).alias("MAX_WATERMARK"))


def schema_columns(spark: SparkSession, table: str, schema: T.StructType, dialect: str) -> DataFrame:
    def row(position: int, field: T.StructField) -> dict:
        decimal = field.dataType if isinstance(field.dataType, T.DecimalType) else None
        return {
            "SOURCE_TABLE": table,
            "SOURCE_COLUMN": field.name,
            "SOURCE_ORDINAL_POSITION": position,
            "SOURCE_DATA_TYPE": dialect_type_name(dialect, field.dataType),
            "SOURCE_NUMERIC_PRECISION": decimal and decimal.precision,
            "SOURCE_NUMERIC_SCALE": decimal and decimal.scale,
            "SOURCE_IS_NULLABLE": "YES" if field.nullable else "NO",
        }

    return local_frame(spark, [row(i, f) for i, f in enumerate(schema, start=1)], SOURCE_COLUMNS)


class FrameSource(Source):
    """DataFrames (or Spark catalog tables / temp views given as DataFrames) as one source schema."""

    def __init__(self, spark, frames: dict[str, DataFrame], name="FRAMES", database="memory", schema="public",
                 dialect="redshift"):
        super().__init__(spark, name, database, schema, dialect)
        self._frames = dict(frames)

    def table_names(self) -> list[str]:
        return sorted(self._frames)

    def read(self, table: str) -> DataFrame:
        return self._frames[table]


def discover_tables(source: Source, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Tables of a source in name order, kept by ``include`` and dropped by ``exclude``, ignoring case."""
    found = source.tables()
    name = F.lower("TABLE_NAME")

    def named(names: Sequence[str]) -> DataFrame:
        return local_frame(source.spark, [{"TABLE_NAME": n.lower()} for n in names], TABLE_NAMES)

    if include:
        wanted = named(include).withColumnRenamed("TABLE_NAME", "WANTED")
        found = found.join(wanted, name == F.col("WANTED"), "left_semi")
    if exclude:
        unwanted = named(exclude).withColumnRenamed("TABLE_NAME", "UNWANTED")
        found = found.join(unwanted, name == F.col("UNWANTED"), "left_anti")
    return found.orderBy("TABLE_NAME")


def unknown_tables(source: Source, include: Sequence[str]) -> list[str]:
    """Included names the source does not have."""
    known = {row.TABLE_NAME.lower() for row in catalog_rows(source.tables())}
    return sorted(name for name in include if name.lower() not in known)
