"""A directory of tables in files as one source schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.sources.base import Source


class FileSource(Source):
    """``<root>/<table>.<format>`` or ``<root>/<table>/`` (or a given name → path mapping) per table."""

    def __init__(self, spark: SparkSession, root: str, name: str = "FILES", database: str = "files",
                 schema: str = "public", dialect: str = "redshift", file_format: str = "parquet",
                 paths: dict[str, str] | None = None, options: dict[str, str] | None = None):
        super().__init__(spark, name, database, schema, dialect)
        self.root = root.rstrip("/")
        self.file_format = file_format
        self.options = options or {}
        self._paths = paths

    def paths(self) -> dict[str, str]:
        if self._paths is None:
            self._paths = self._list()
        return self._paths

    def _list(self) -> dict[str, str]:
        # One directory listing through Hadoop, so any file system Spark reads works.
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        suffix = f".{self.file_format}"
        found = {}
        for status in files.listStatus(path):
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if status.isDirectory() or name.endswith(suffix):
                found[name.removesuffix(suffix)] = status.getPath().toString()
        return found

    def table_names(self) -> list[str]:
        return sorted(self.paths())

    def read(self, table: str) -> DataFrame:
        return self.spark.read.format(self.file_format).options(**self.options).load(self.paths()[table])


def measured_columns(source: Source, table: str) -> DataFrame:
    """Column metadata with lengths and nullability measured from the rows.

    Files declare no text length and mark every column nullable.  One pass over the table, with
    partial aggregation, gives the longest text and whether NULLs occur.
    """
    rows = source.read(table)
    texts = {name for name, dtype in rows.dtypes if dtype == "string"}
    facts = [
        F.struct(
            F.lit(name).alias("NAME"),
            (F.max(F.length(name)) if name in texts else F.lit(None)).cast("long").alias("MAX_LENGTH"),
            (F.count(F.lit(1)) > F.count(name)).alias("HAS_NULLS"),
        )
        for name in rows.columns
    ]
    measured = rows.agg(F.array(*facts).alias("FACTS")).select(F.inline("FACTS"))
    declared = source.columns(table)
    return declared.join(measured, declared.SOURCE_COLUMN == measured.NAME).select(
        "SOURCE_TABLE", "SOURCE_COLUMN", "SOURCE_ORDINAL_POSITION", "SOURCE_DATA_TYPE",
        F.col("MAX_LENGTH").alias("SOURCE_CHARACTER_MAXIMUM_LENGTH"),
        "SOURCE_NUMERIC_PRECISION", "SOURCE_NUMERIC_SCALE",
        F.when(F.col("HAS_NULLS"), "YES").otherwise("NO").alias("SOURCE_IS_NULLABLE"),
    )
