"""A database schema read over JDBC."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.functions.values import FRACTIONAL, INTEGRAL
from tablescout.local import catalog_rows
from tablescout.sources.base import Source, Watermark

NUMERIC = INTEGRAL | FRACTIONAL


@dataclass(frozen=True)
class Split:
    """How to cut a table into parallel range reads.

    With both bounds the ranges between them are equally long.  Otherwise they hold about equally many of the rows that are
    read: their points come from one query, over a share of the rows where `sample` is below one.
    """

    column: str
    partitions: int
    lower: object | None = None
    upper: object | None = None
    sample: float = 1.0


# Metadata queries per dialect; {schema} and {table} are filled with quoted text.
INFORMATION_SCHEMA = {
    "tables": (
        "SELECT table_name AS TABLE_NAME FROM information_schema.tables "
        "WHERE table_schema = {schema} AND table_type = 'BASE TABLE'"
    ),
    "columns": (
        "SELECT column_name AS SOURCE_COLUMN, ordinal_position AS SOURCE_ORDINAL_POSITION, "
        "data_type AS SOURCE_DATA_TYPE, character_maximum_length AS SOURCE_CHARACTER_MAXIMUM_LENGTH, "
        "numeric_precision AS SOURCE_NUMERIC_PRECISION, numeric_scale AS SOURCE_NUMERIC_SCALE, "
        "is_nullable AS SOURCE_IS_NULLABLE FROM information_schema.columns "
        "WHERE table_schema = {schema} AND table_name = {table}"
    ),
}
# Points that part rows into equal shares: the greatest value of each share.
POINTS = (
    "SELECT MAX(V) AS POINT FROM (SELECT V, NTILE({partitions}) OVER (ORDER BY V) AS SHARE FROM "
    "(SELECT {column} AS V FROM {relation}{conditions}) AS SPLIT_ROWS WHERE V IS NOT NULL) AS SPLIT_SHARES GROUP BY SHARE"
)
# A condition that a share of the rows meets, whatever other conditions there are.
SAMPLES = {"sqlserver": "ABS(CHECKSUM(NEWID()) % 1000000) < {millionths}", "redshift": "RANDOM() < {share}"}
IDENTIFIER_QUOTES = {"sqlserver": "[]", "redshift": '""'}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _literal(value: object) -> str:
    """A value as the database writes it; dates and times as text, which it compares as what the column is."""
    return str(value) if isinstance(value, (int, float, Decimal)) else _text(str(value))


class JdbcSource(Source):
    """Tables of one schema.  ``options`` are Spark's JDBC options (url, driver, user, fetchsize …).

    A read without a ``Split`` is a single task, so large tables should name a split column.  The points of its ranges
    come from the rows that are read: those of an increment from the rows past the watermark, not from the whole table.
    """

    def __init__(self, spark: SparkSession, options: dict[str, str], name: str, database: str, schema: str,
                 dialect: str, splits: dict[str, Split] | None = None, queries: dict[str, str] | None = None):
        super().__init__(spark, name, database, schema, dialect)
        self.options = {"fetchsize": "50000", **options}
        self.splits = splits or {}
        self.queries = queries or INFORMATION_SCHEMA

    def quoted(self, identifier: str) -> str:
        opening, closing = IDENTIFIER_QUOTES[self.dialect]
        return opening + identifier.replace(closing, closing * 2) + closing

    def query(self, sql: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options).option("query", sql).load()

    def _upper_names(self, frame: DataFrame) -> DataFrame:
        return frame.toDF(*[name.upper() for name in frame.columns])

    def tables(self) -> DataFrame:
        found = self.query(self.queries["tables"].format(schema=_text(self.schema)))
        return self._upper_names(found).select("TABLE_NAME")

    def table_names(self) -> list[str]:
        return sorted(row.TABLE_NAME for row in catalog_rows(self.tables()))

    def columns(self, table: str) -> DataFrame:
        found = self.query(self.queries["columns"].format(schema=_text(self.schema), table=_text(table)))
        return self._upper_names(found).select(
            F.lit(table).alias("SOURCE_TABLE"),
            "SOURCE_COLUMN",
            F.col("SOURCE_ORDINAL_POSITION").cast("long").alias("SOURCE_ORDINAL_POSITION"),
            "SOURCE_DATA_TYPE",
            *[
                F.col(name).cast("long").alias(name)
                for name in (
                    "SOURCE_CHARACTER_MAXIMUM_LENGTH",
                    "SOURCE_NUMERIC_PRECISION",
                    "SOURCE_NUMERIC_SCALE",
                )
            ],
            "SOURCE_IS_NULLABLE",
        ).orderBy("SOURCE_ORDINAL_POSITION")

    def _relation(self, table: str) -> str:
        return f"{self.quoted(self.schema)}.{self.quoted(table)}"

    def row_count(self, table: str) -> int:
        return int(self.query(f"SELECT COUNT(*) AS N FROM {self._relation(table)}").head()[0])

    def max_watermark(self, table: str, column: str) -> DataFrame:
        newest = self.query(f"SELECT MAX({self.quoted(column)}) AS MAX_WATERMARK FROM {self._relation(table)}")
        return newest.toDF("MAX_WATERMARK")

    def _points(self, table: str, split: Split, condition: str | None) -> list:
        """Ascending values that part the rows to be read into about equal shares, without the greatest."""
        conditions = [condition] if condition else []
        if split.sample < 1:
            conditions.append(SAMPLES[self.dialect].format(share=split.sample, millionths=round(split.sample * 1_000_000)))
        sql = POINTS.format(
            partitions=split.partitions, column=self.quoted(split.column), relation=self._relation(table),
            conditions=" WHERE " + " AND ".join(conditions) if conditions else "",
        )
        # a row for each partition
        return sorted({row[0] for row in self.query(sql).collect()})[:-1]

    def _predicates(self, table: str, split: Split, condition: str | None = None) -> list[str]:
        """Conditions that part all rows: each row meets one of them, rows without a value the first."""
        column = self.quoted(split.column)
        points = [_literal(p) for p in self._points(table, split, condition)]
        if not points:
            return ["1 = 1"]
        between = [f"{column} > {low} AND {column} <= {high}" for low, high in zip(points, points[1:])]
        return [f"{column} <= {points[0]} OR {column} IS NULL", *between, f"{column} > {points[-1]}"]

    def _read(self, table: str, condition: str | None = None) -> DataFrame:
        split = self.splits.get(table)
        if split and (split.lower is None or split.upper is None):
            return self.spark.read.jdbc(
                self.options["url"], self._relation(table), predicates=self._predicates(table, split, condition),
                properties={k: v for k, v in self.options.items() if k != "url"},
            )
        reader = self.spark.read.format("jdbc").options(**self.options).option("dbtable", self._relation(table))
        if split:
            reader = reader.options(
                partitionColumn=split.column,
                lowerBound=str(split.lower),
                upperBound=str(split.upper),
                numPartitions=str(split.partitions),
            )
        return reader.load()

    def read(self, table: str) -> DataFrame:
        return self._read(table)

    def read_since(self, table: str, column: str, since: Watermark | None) -> DataFrame:
        """Rows past the watermark; Spark sends the filter on with each range."""
        if since is None:
            return self.read(table)
        condition = None
        if since.type in NUMERIC or since.type.startswith("decimal"):
            condition = f"{self.quoted(column)} > {since.value}"
        elif since.type in ("string", "date", "timestamp_ntz"):  # times with a zone are not written alike everywhere
            condition = f"{self.quoted(column)} > {_text(since.value)}"
        return self._read(table, condition).where(F.col(column) > since.literal())
