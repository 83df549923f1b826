"""Moving catalog-sized rows between the driver and Spark."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, rows: Iterable[Mapping], schema: T.StructType) -> DataFrame:
    """A DataFrame over driver rows; planned as a local relation, so its size is known."""
    table = pa.Table.from_pylist(
        [{name: row[name] if name in row else None for name in schema.names} for row in rows],
        schema=to_arrow_schema(schema),
    )
    return spark.createDataFrame(table, schema=schema)


def catalog_rows(frame: DataFrame) -> list[Row]:
    """Rows of which there is one for each table or column, to plan by.

    Not for pairs of columns or relationships: those grow with the square of the columns and stay in Spark.
    """
    return frame.collect()
