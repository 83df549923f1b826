"""Queries over the catalog tables: latest runs, column search, shared columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.operators.catalog import (
    catalog_columns,
    column_search,
    latest_cardinality,
    of_latest_run,
    run_log,
    shared_columns,
)
from workload.ingest import LATEST_RUNS, RUNS, TABLE_CATALOG, run_events, table_catalog_rows
from workload.tables import table


def column_catalog_rows(spark, sf_dir) -> DataFrame:
    """A column catalog as many runs would fill it: a run per order, a column per line item."""
    number = F.col("l_linenumber")
    name = (
        F.when(number == 1, F.concat(F.lit("PART"), F.col("l_partkey"), F.lit("_ID")))
        .when(number == 2, F.concat(F.lit("Supp"), F.col("l_suppkey"), F.lit("number")))
        .when(number == 3, "EMAIL")
        .when(number == 4, "CUSTOMER")
        .otherwise(F.concat(F.lit("COL_"), F.col("l_suppkey")))
    )
    suffix = F.concat_ws("_", "l_returnflag", "l_linestatus", "l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("RUN_ID"),
        F.concat(F.lit("SYS_"), F.col("l_returnflag")).alias("SOURCE_SYSTEM"),
        F.lit("testdata").alias("SOURCE_DATABASE"),
        F.lit("public").alias("SOURCE_SCHEMA"),
        F.concat(F.lit("t_"), suffix).alias("SOURCE_TABLE"),
        F.lower(name).alias("SOURCE_COLUMN"),
        F.col("l_partkey").alias("SOURCE_ORDINAL_POSITION"),
        F.lit("bigint").alias("SOURCE_DATA_TYPE"),
        F.lit("LAKE").alias("TARGET_DATABASE"),
        F.lit("RAW").alias("TARGET_SCHEMA"),
        F.concat(F.lit("T_"), suffix).alias("TARGET_TABLE"),
        name.alias("TARGET_COLUMN"),
        F.lit("NUMBER(38,0)").alias("TARGET_DATA_TYPE"),
        F.col("l_shipdate").alias("CATALOGED_AT"),
    )


COLUMN_CATALOG = """column_catalog AS (
  SELECT cast(l_orderkey AS VARCHAR) AS "RUN_ID", 'SYS_' || l_returnflag AS "SOURCE_SYSTEM",
    'testdata' AS "SOURCE_DATABASE", 'public' AS "SOURCE_SCHEMA",
    't_' || l_returnflag || '_' || l_linestatus || '_' || l_linenumber AS "SOURCE_TABLE", lower(name) AS "SOURCE_COLUMN",
    l_partkey AS "SOURCE_ORDINAL_POSITION", 'bigint' AS "SOURCE_DATA_TYPE", 'LAKE' AS "TARGET_DATABASE",
    'RAW' AS "TARGET_SCHEMA", 'T_' || l_returnflag || '_' || l_linestatus || '_' || l_linenumber AS "TARGET_TABLE",
    name AS "TARGET_COLUMN", 'NUMBER(38,0)' AS "TARGET_DATA_TYPE", l_shipdate AS "CATALOGED_AT"
  FROM (SELECT *, CASE l_linenumber WHEN 1 THEN 'PART' || l_partkey || '_ID'
    WHEN 2 THEN 'Supp' || l_suppkey || 'number' WHEN 3 THEN 'EMAIL' WHEN 4 THEN 'CUSTOMER'
    ELSE 'COL_' || l_suppkey END AS name FROM lineitem)
)"""
SEARCH = (
    '"SOURCE_SYSTEM", "SOURCE_DATABASE", "SOURCE_SCHEMA", "SOURCE_TABLE", "SOURCE_COLUMN", "SOURCE_DATA_TYPE", '
    '"TARGET_DATABASE", "TARGET_SCHEMA", "TARGET_TABLE", "TARGET_COLUMN", "TARGET_DATA_TYPE", "CATALOGED_AT"'
)
LATEST_COLUMNS = (
    f"WITH {RUNS}, {LATEST_RUNS}, {COLUMN_CATALOG}, latest_columns AS "
    '(SELECT * FROM column_catalog SEMI JOIN latest USING ("RUN_ID"))'
)
HINTS = (
    "'PROJECTID','STAGEID','QUOTEID','DEALID','JOBNUMBER','ITEMNUMBER','INVOICEID','CUSTOMER','EMAIL'"
)


def latest_tables(spark, sf_dir) -> DataFrame:
    return of_latest_run(table_catalog_rows(spark, sf_dir), run_log(run_events(spark, sf_dir)))


def latest_columns(spark, sf_dir) -> DataFrame:
    return of_latest_run(column_catalog_rows(spark, sf_dir), run_log(run_events(spark, sf_dir)))


def column_search_all(spark, sf_dir) -> DataFrame:
    return column_search(latest_columns(spark, sf_dir))


def column_search_pattern(spark, sf_dir) -> DataFrame:
    return column_search(latest_columns(spark, sf_dir), "%part1%")


def shared(spark, sf_dir) -> DataFrame:
    return shared_columns(column_search(latest_columns(spark, sf_dir)))


def column_catalog_read(spark, sf_dir) -> DataFrame:
    return catalog_columns(latest_columns(spark, sf_dir), "SYS_A", "T_A_F_3")


def cardinality_results(spark, sf_dir) -> DataFrame:
    """Cardinality results of many runs: a check of (supplier, part) edges per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("CARDINALITY_RUN_ID"),
        F.concat(F.lit("SYS_"), F.col("l_linestatus")).alias("SOURCE_SYSTEM"),
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("FROM_TABLE"),
        F.lit("ID").alias("FROM_COLUMN"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("TO_TABLE"),
        F.lit("ID").alias("TO_COLUMN"),
        F.when(F.col("l_orderkey") > F.col("l_partkey"), "1:N").otherwise("N:M").alias("CARDINALITY_TYPE"),
        F.col("l_shipdate").alias("CREATED_AT"),
    )


def latest_cardinalities(spark, sf_dir) -> DataFrame:
    return latest_cardinality(cardinality_results(spark, sf_dir))


QUERIES = {
    "latest_tables": latest_tables,
    "latest_columns": latest_columns,
    "column_search": column_search_all,
    "column_search_pattern": column_search_pattern,
    "shared_columns": shared,
    "column_catalog_read": column_catalog_read,
    "latest_cardinality": latest_cardinalities,
}

ORACLES = {
    "latest_tables": f"WITH {RUNS}, {LATEST_RUNS}, {TABLE_CATALOG} "
    'SELECT t.* FROM table_catalog t JOIN latest r ON t."RUN_ID" = r."RUN_ID"',
    "latest_columns": f"{LATEST_COLUMNS} SELECT * FROM latest_columns",
    "column_search": f"{LATEST_COLUMNS} SELECT {SEARCH} FROM latest_columns",
    "column_search_pattern": f"{LATEST_COLUMNS} SELECT {SEARCH} FROM latest_columns "
    "WHERE \"SOURCE_COLUMN\" ILIKE '%part1%' OR \"TARGET_COLUMN\" ILIKE '%part1%'",
    "shared_columns": f"""{LATEST_COLUMNS}
SELECT "TARGET_COLUMN", count(DISTINCT "TARGET_TABLE") AS "TABLE_COUNT",
  string_agg(DISTINCT "TARGET_TABLE", ', ' ORDER BY "TARGET_TABLE") AS "TABLES"
FROM latest_columns
WHERE "TARGET_COLUMN" ILIKE '%ID' OR "TARGET_COLUMN" ILIKE '%NUMBER' OR "TARGET_COLUMN" IN ({HINTS})
GROUP BY "TARGET_COLUMN" HAVING count(DISTINCT "TARGET_TABLE") > 1""",
    "column_catalog_read": f"{LATEST_COLUMNS} SELECT \"SOURCE_SYSTEM\", \"TARGET_DATABASE\", \"TARGET_SCHEMA\", "
    "\"TARGET_TABLE\", \"TARGET_COLUMN\", \"TARGET_DATA_TYPE\" FROM latest_columns "
    "WHERE \"SOURCE_SYSTEM\" = 'SYS_A' AND \"TARGET_TABLE\" = 'T_A_F_3' ORDER BY \"SOURCE_ORDINAL_POSITION\"",
    "latest_cardinality": """
SELECT * FROM (
  SELECT cast(l_orderkey AS VARCHAR) AS "CARDINALITY_RUN_ID", 'SYS_' || l_linestatus AS "SOURCE_SYSTEM",
    'S' || l_suppkey AS "FROM_TABLE", 'ID' AS "FROM_COLUMN", 'P' || l_partkey AS "TO_TABLE", 'ID' AS "TO_COLUMN",
    CASE WHEN l_orderkey > l_partkey THEN '1:N' ELSE 'N:M' END AS "CARDINALITY_TYPE", l_shipdate AS "CREATED_AT"
  FROM lineitem
) QUALIFY row_number() OVER (
  PARTITION BY "SOURCE_SYSTEM", "FROM_TABLE", "FROM_COLUMN", "TO_TABLE", "TO_COLUMN"
  ORDER BY "CREATED_AT" DESC, "CARDINALITY_RUN_ID" DESC) = 1""",
}
