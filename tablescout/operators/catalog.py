"""Latest-run reads, search and shared columns over the catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.functions.rules import USABLE_LABELS, run_status
from tablescout.operators.merge import latest_per_key
from tablescout.schemas import EDGE_KEY, WATERMARK_KEY

RUN_SCOPE = ["SOURCE_SYSTEM", "SOURCE_DATABASE", "SOURCE_SCHEMA", "TARGET_DATABASE", "TARGET_SCHEMA"]
SEARCH_COLUMNS = [
    "SOURCE_SYSTEM", "SOURCE_DATABASE", "SOURCE_SCHEMA", "SOURCE_TABLE", "SOURCE_COLUMN", "SOURCE_DATA_TYPE",
    "TARGET_DATABASE", "TARGET_SCHEMA", "TARGET_TABLE", "TARGET_COLUMN", "TARGET_DATA_TYPE", "CATALOGED_AT",
]

# Column names that hint at a relationship, besides %ID and %NUMBER.
HINT_COLUMNS = [
    "PROJECTID", "STAGEID", "QUOTEID", "DEALID", "JOBNUMBER", "ITEMNUMBER", "INVOICEID", "CUSTOMER", "EMAIL",
]


def run_log(events: DataFrame) -> DataFrame:
    """One row per run from its start and finish events."""
    return events.groupBy("RUN_ID").agg(
        *[
            F.max(name).alias(name)
            for name in [*RUN_SCOPE, "LOAD_MODE", "STARTED_AT", "FINISHED_AT"]
        ],
        *[
            F.max_by(name, F.struct(F.col("FINISHED_AT").isNotNull(), "FINISHED_AT")).alias(name)
            for name in ("STATUS", "ERROR_MESSAGE")
        ],
    )


def latest_runs(runs: DataFrame, status_in: Sequence[str] | None = None) -> DataFrame:
    """Newest run per source and target, whatever its status unless ``status_in`` says otherwise."""
    if status_in:
        runs = runs.where(F.col("STATUS").isin(list(status_in)))
    return latest_per_key(runs, RUN_SCOPE, [F.desc("STARTED_AT"), F.desc("RUN_ID")])


def of_latest_run(catalog: DataFrame, runs: DataFrame, status_in: Sequence[str] | None = None) -> DataFrame:
    """Catalog rows (tables or columns) written by the latest runs."""
    return catalog.join(latest_runs(runs, status_in).select("RUN_ID"), "RUN_ID", "left_semi")


def column_search(latest_columns: DataFrame, pattern: str | None = None) -> DataFrame:
    """Search view over the latest column catalog, optionally by a column name pattern."""
    found = latest_columns.select(SEARCH_COLUMNS)
    if pattern is None:
        return found
    return found.where(F.col("SOURCE_COLUMN").ilike(pattern) | F.col("TARGET_COLUMN").ilike(pattern))


def shared_columns(search: DataFrame) -> DataFrame:
    """Key-like columns found in more than one table, with the sorted list of tables."""
    name = F.col("TARGET_COLUMN")
    hinted = search.where(name.ilike("%ID") | name.ilike("%NUMBER") | name.isin(HINT_COLUMNS))
    # Distinct first: a column name with many catalog rows reaches the list only once per table.
    pairs = hinted.where(F.col("TARGET_TABLE").isNotNull()).select("TARGET_COLUMN", "TARGET_TABLE").distinct()
    return (
        pairs.groupBy("TARGET_COLUMN")
        .agg(
            F.count(F.lit(1)).alias("TABLE_COUNT"),
            F.array_join(F.array_sort(F.collect_list("TARGET_TABLE")), ", ").alias("TABLES"),
        )
        .where("TABLE_COUNT > 1")
    )


def catalog_columns(latest_columns: DataFrame, source_system: str, target_table: str) -> DataFrame:
    return (
        latest_columns.where((F.col("SOURCE_SYSTEM") == source_system) & (F.col("TARGET_TABLE") == target_table))
        .orderBy("SOURCE_ORDINAL_POSITION")
        .select("SOURCE_SYSTEM", "TARGET_DATABASE", "TARGET_SCHEMA", "TARGET_TABLE", "TARGET_COLUMN",
                "TARGET_DATA_TYPE")
    )


def usable_edges(graph: DataFrame, source_system: str | None = None) -> DataFrame:
    """Edges worth building on, best match first."""
    edges = graph.where(F.col("CONFIDENCE_LABEL").isin(USABLE_LABELS))
    if source_system:
        edges = edges.where(F.col("SOURCE_SYSTEM") == source_system)
    return edges.orderBy(F.desc("MATCH_RATE"), *EDGE_KEY)


def of_system(frame: DataFrame, source_system: str) -> DataFrame:
    return frame.where(F.col("SOURCE_SYSTEM") == source_system)


def latest_watermarks(updates: DataFrame) -> DataFrame:
    """Watermark table after all upserts: the newest value per key."""
    return latest_per_key(updates, WATERMARK_KEY, [F.desc("UPDATED_AT"), F.desc("LAST_SUCCESSFUL_RUN_ID")])


def latest_cardinality(results: DataFrame) -> DataFrame:
    return latest_per_key(
        results, ["SOURCE_SYSTEM", *EDGE_KEY], [F.desc("CREATED_AT"), F.desc("CARDINALITY_RUN_ID")]
    )


def run_summary(table_catalog: DataFrame) -> DataFrame:
    """Tables, failed tables and resulting status per run."""
    failed = F.count_if(F.col("LOAD_STATUS") == "FAILED")
    return table_catalog.groupBy("RUN_ID").agg(
        F.count(F.lit(1)).alias("TABLES"),
        failed.alias("FAILED_TABLES"),
        run_status(failed).alias("STATUS"),
        F.when(failed > 0, F.concat(failed.cast("string"), F.lit(" table(s) failed"))).alias("ERROR_MESSAGE"),
    )
