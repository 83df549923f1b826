"""Whole runs: ingestion and discovery writing their tables and catalogs, read back."""

from __future__ import annotations

import tempfile
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.operators.catalog import latest_watermarks, run_log
from tablescout.operators.cells import union_all
from tablescout.plans.discover import Place, discover, held
from tablescout.plans.ingest import IncrementalTable, LoadOptions, Target, ingest
from tablescout.plans.semantic import (
    catalog_assets,
    catalog_document,
    decided_views,
    document_assets,
    model_document,
    model_relationships,
    read_catalog,
    read_model,
    semantic_relationships,
    view_decisions,
    with_cardinality,
)
from tablescout.plans.store import TableStore
from tablescout.sources.base import FrameSource
from workload import sql
from workload.discovery import NAMING, _injected, injected_frames, td_cardinality_oracle
from workload.ingest import FIRST_OF_2000
from workload.semantic import ASSETS as CATALOG_ROWS
from workload.semantic import DECISIONS, classified_edges, td_entities
from workload.tables import SYSTEM, renamed_views, shown, table

TARGET = Target("LAKE", "RAW", "_TD")
OPTIONS = LoadOptions(
    "incremental",
    incremental={"orders": IncrementalTable("o_orderdate", ["o_orderkey"]), "events": IncrementalTable("ts")},
    merge_buckets=8,
)


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint directory of the cluster; a local one in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tablescout-{uuid4()}"
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tablescout-")


def two_loads(spark, sf_dir) -> tuple[TableStore, list[DataFrame]]:
    """A first load up to cut-off dates, and a second with later rows and re-sent urgent orders."""
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    nation = table(spark, sf_dir, "nation")
    old = orders.where(f"o_orderdate <= {FIRST_OF_2000}")
    early = events.where("ts <= timestamp_ntz '2024-01-15'")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    changed = orders.withColumns(
        {
            "o_orderstatus": F.when(urgent, "X").otherwise(F.col("o_orderstatus")),
            "o_orderdate": F.when(urgent, F.expr("o_orderdate + interval 10 years")).otherwise(F.col("o_orderdate")),
        }
    )
    store = TableStore(spark, scratch(spark))
    sources = [
        {"orders": old, "events": early, "nation": nation},
        {"orders": changed, "events": events, "nation": nation},
    ]
    return store, [ingest(spark, FrameSource(spark, frames, name="TD"), TARGET, store, OPTIONS) for frames in sources]


def ingest_run(spark, sf_dir) -> DataFrame:
    """Table catalog and validation of both loads."""
    store, done = two_loads(spark, sf_dir)
    tables = union_all(frame.withColumn("LOAD", F.lit(number)) for number, frame in enumerate(done, start=1))
    checks = store.read("INGESTION_VALIDATION_RESULTS").select(
        "RUN_ID", "TARGET_TABLE", "VALIDATION_STATUS", "VALIDATION_VALUE"
    )
    statuses = run_log(store.read("INGESTION_RUN_LOG")).select("RUN_ID", F.col("STATUS").alias("RUN_STATUS"))
    return (
        tables.join(checks, ["RUN_ID", "TARGET_TABLE"])
        .join(statuses, "RUN_ID")
        .select(
            "LOAD", "RUN_STATUS", "SOURCE_TABLE", "TARGET_TABLE", "SOURCE_ROW_COUNT", "TARGET_ROW_COUNT",
            "ROW_COUNT_MATCH", "LOAD_STATUS", "VALIDATION_STATUS", "VALIDATION_VALUE",
        )
    )


def ingest_merged(spark, sf_dir) -> DataFrame:
    """The merged orders after both loads."""
    store, _ = two_loads(spark, sf_dir)
    return store.table("ORDERS_TD").drop("_INGESTED_AT")


def ingest_watermarks(spark, sf_dir) -> DataFrame:
    store, _ = two_loads(spark, sf_dir)
    return latest_watermarks(store.read("INGESTION_WATERMARKS")).select(
        "SOURCE_TABLE", "TARGET_TABLE", "WATERMARK_COLUMN", "WATERMARK_VALUE"
    )


def ingest_plan_mode(spark, sf_dir) -> DataFrame:
    """A first load of everything up to the cut-off dates, then a run that only plans the rest."""
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    store = TableStore(spark, scratch(spark))
    early = {"orders": orders.where(f"o_orderdate <= {FIRST_OF_2000}"), "events": events.where("ts <= timestamp_ntz '2024-01-15'")}
    ingest(spark, FrameSource(spark, early, name="TD"), TARGET, store, OPTIONS)
    frames = {"orders": orders, "events": events, "nation": table(spark, sf_dir, "nation")}
    planned = ingest(
        spark, FrameSource(spark, frames, name="TD"), TARGET, store, replace(OPTIONS, mode="incremental_plan")
    )
    return outcomes(store, planned)


def outcomes(store: TableStore, tables: DataFrame) -> DataFrame:
    """Table catalog and validation rows of a run, with the run's status; whole numbers as text, since some are NULL."""
    checks = store.read("INGESTION_VALIDATION_RESULTS").select(
        "RUN_ID", "TARGET_TABLE", "VALIDATION_NAME", "VALIDATION_STATUS", "VALIDATION_VALUE"
    )
    statuses = run_log(store.read("INGESTION_RUN_LOG")).select("RUN_ID", F.col("STATUS").alias("RUN_STATUS"))
    checks = checks.withColumnsRenamed({"RUN_ID": "CHECKED_RUN", "TARGET_TABLE": "CHECKED_TABLE"})
    same = (F.col("RUN_ID") == F.col("CHECKED_RUN")) & F.col("TARGET_TABLE").eqNullSafe(F.col("CHECKED_TABLE"))
    whole = tables.join(checks, same)
    return shown(
        whole.join(statuses, "RUN_ID").select(
            "RUN_STATUS", "SOURCE_TABLE", "TARGET_TABLE", "SOURCE_ROW_COUNT", "TARGET_ROW_COUNT", "ROW_COUNT_MATCH",
            "LOAD_STATUS", "VALIDATION_NAME", "VALIDATION_STATUS", "VALIDATION_VALUE",
        ),
        "SOURCE_ROW_COUNT", "TARGET_ROW_COUNT",
    )


def ingest_failures(spark, sf_dir) -> DataFrame:
    """A run with a good table, an empty one, one whose columns clash, and one that is asked for twice and missing."""
    frames = {
        "nation": table(spark, sf_dir, "nation"),
        "none_left": table(spark, sf_dir, "supplier").where("s_suppkey < 0"),
        "clashing": table(spark, sf_dir, "part").selectExpr("p_partkey AS `a b`", "p_name AS a_b"),
    }
    store = TableStore(spark, scratch(spark))
    options = LoadOptions(include=["nation", "none_left", "clashing", "gone", "gone"])
    done = ingest(spark, FrameSource(spark, frames, name="TD"), TARGET, store, options)
    return outcomes(store, done).withColumn("VALIDATION_VALUE", F.split("VALIDATION_VALUE", ":")[0]).distinct()


def ingest_columns(spark, sf_dir) -> DataFrame:
    """Column catalog rows of the second of two loads."""
    store, done = two_loads(spark, sf_dir)
    run = done[1].select("RUN_ID").distinct()
    return store.read("INGESTION_COLUMN_CATALOG").join(run, "RUN_ID").select(
        "SOURCE_TABLE", "SOURCE_COLUMN", "SOURCE_ORDINAL_POSITION", "SOURCE_DATA_TYPE", "TARGET_TABLE", "TARGET_COLUMN",
        "TARGET_DATA_TYPE",
    )


def registered_views(spark, sf_dir) -> DataFrame:
    """Per view that the decisions name, with child rows as records: its name, kind and number of rows."""
    frames = injected_frames(spark, sf_dir)
    views = decided_views(frames, view_decisions(classified_edges(spark, sf_dir), SYSTEM, NAMING).collect(), "object", NAMING)
    return union_all(
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("view_name"), F.lit(kind).alias("kind"), "row_count"
        )
        for name, kind, rows in views
    )


def stored_documents(spark, sf_dir) -> DataFrame:
    """Model and catalog written as JSON to the shared folder and read back as rows."""
    path = scratch(spark)
    entities, edges = td_entities(spark, sf_dir), held(classified_edges(spark, sf_dir))
    model_document(entities, edges.drop("cardinality_type"), SYSTEM).write.json(f"{path}/model")
    catalog_document(catalog_assets(entities, edges, SYSTEM, NAMING), SYSTEM).write.json(f"{path}/catalog")
    model = model_relationships(read_model(spark, f"{path}/model"))
    related = model.select(
        F.lit("model").alias("document"), F.lit("relationship").alias("item"), "from_table", "to_table", "confidence_label"
    )
    kept = document_assets(read_catalog(spark, f"{path}/catalog"), relationships_only=True).select(
        F.lit("catalog").alias("document"), F.col("asset_type").alias("item"), "from_table", "to_table", "confidence_label"
    )
    return related.unionAll(kept)


def discovery_run(spark, sf_dir) -> DataFrame:
    """Stored relationships of a discovery run with their stored cardinality."""
    store = TableStore(spark, scratch(spark))
    discover(spark, renamed_views(spark, sf_dir), Place(SYSTEM), store, NAMING)
    relationships = semantic_relationships(store.read("RELATIONSHIP_GRAPH"), SYSTEM)
    return with_cardinality(relationships, store.read("RELATIONSHIP_CARDINALITY"))


QUERIES = {
    "ingest_run": ingest_run,
    "ingest_merged": ingest_merged,
    "ingest_watermarks": ingest_watermarks,
    "discovery_run": discovery_run,
    "ingest_plan_mode": ingest_plan_mode,
    "ingest_failures": ingest_failures,
    "ingest_columns": ingest_columns,
    "registered_views": registered_views,
    "stored_documents": stored_documents,
}

# The column catalog of the three tables.
_COLUMN_ROWS = [
    ("orders", "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
     "bigint|bigint|character varying|double precision|timestamp without time zone|character varying", "NUMBER(38,0) NUMBER(38,0) VARCHAR FLOAT TIMESTAMP_NTZ VARCHAR"),
    ("events", "event_id ts user_id event_type value props", "bigint|timestamp without time zone|bigint|character varying|double precision|character varying",
     "NUMBER(38,0) TIMESTAMP_NTZ NUMBER(38,0) VARCHAR FLOAT VARCHAR"),
    ("nation", "n_nationkey n_name n_regionkey", "integer|character varying|integer", "NUMBER(38,0) VARCHAR NUMBER(38,0)"),
]
_COLUMN_VALUES = ", ".join(
    f"('{t}', '{c}', {i}, '{k}', '{t.upper()}_TD', '{'VALUE_COL' if c == 'value' else c.upper()}', '{g}')"
    for t, names, kinds, targets in _COLUMN_ROWS
    for i, (c, k, g) in enumerate(zip(names.split(), kinds.split("|"), targets.split(), strict=True), start=1)
)

_OUTCOME = (
    '"SOURCE_TABLE", "TARGET_TABLE", "SOURCE_ROW_COUNT", "TARGET_ROW_COUNT", "ROW_COUNT_MATCH", "LOAD_STATUS", '
    '"VALIDATION_NAME", "VALIDATION_STATUS", "VALIDATION_VALUE"'
)


def _rows_of(parent: str, parent_column: str, child: str, child_column: str, names) -> str:
    """Rows of the joined view and of the link views of one pair of relations."""
    p, c = (
        f"(SELECT {sql.key(column)} AS k, count(*) AS n FROM {relation} GROUP BY 1)"
        for relation, column in ((parent, parent_column), (child, child_column))
    )
    labels = ", ".join(f"'{v}' AS {n}" for n, v in zip(("pt", "pc", "ct", "cc"), names, strict=True))
    return (
        f"SELECT {labels}, (SELECT sum(p.n * coalesce(c.n, 1)) FROM {p} p LEFT JOIN {c} c ON p.k = c.k)::BIGINT AS joined, "
        f"(SELECT count(*) FROM {p} p JOIN {c} c ON p.k = c.k) AS linked"
    )

_OLD = "o_orderdate <= TIMESTAMP '2000-01-01'"
_DELTA = "o_orderpriority = '1-URGENT' OR o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE {})".format(_OLD)
_COUNTS = f"""
WITH counts AS (
  SELECT (SELECT count(*) FROM orders WHERE {_OLD}) AS old_orders, (SELECT count(*) FROM orders) AS all_orders,
    (SELECT count(*) FROM orders WHERE {_DELTA}) AS delta,
    (SELECT count(*) FROM orders WHERE {_OLD} OR {_DELTA}) AS merged,
    (SELECT count(*) FROM events WHERE ts <= TIMESTAMP '2024-01-15') AS old_events,
    (SELECT count(*) FROM events) AS all_events, (SELECT count(*) FROM nation) AS nations),
loads AS (
  SELECT 1 AS "LOAD", 'orders' AS t, old_orders AS s, old_orders AS l, old_orders AS g, 'LOADED' AS st FROM counts
  UNION ALL SELECT 1, 'events', old_events, old_events, old_events, 'LOADED' FROM counts
  UNION ALL SELECT 1, 'nation', nations, nations, nations, 'LOADED' FROM counts
  UNION ALL SELECT 2, 'orders', all_orders, delta, merged, 'MERGED' FROM counts
  UNION ALL SELECT 2, 'events', all_events, all_events - old_events, all_events, 'LOADED' FROM counts
  UNION ALL SELECT 2, 'nation', nations, nations, nations, 'LOADED' FROM counts)"""

ORACLES = {
    "ingest_plan_mode": f"""{_COUNTS}
SELECT 'SUCCESS' AS "RUN_STATUS", t AS "SOURCE_TABLE", upper(t) || '_TD' AS "TARGET_TABLE",
  s::VARCHAR AS "SOURCE_ROW_COUNT", g::VARCHAR AS "TARGET_ROW_COUNT", true AS "ROW_COUNT_MATCH", 'PLANNED' AS "LOAD_STATUS",
  'SOURCE_LOADED_TARGET_ROW_COUNT_MATCH' AS "VALIDATION_NAME", 'PASS' AS "VALIDATION_STATUS",
  'incremental_plan_only=true; source_total=' || s || '; planned_rows_not_loaded=' || p AS "VALIDATION_VALUE"
FROM (SELECT 'orders' AS t, all_orders AS s, old_orders AS g, all_orders - old_orders AS p FROM counts
  UNION ALL SELECT 'events', all_events, old_events, all_events - old_events FROM counts
  UNION ALL SELECT 'nation', nations, 0, nations FROM counts)""",
    "ingest_failures": f"""
WITH n AS (SELECT count(*)::VARCHAR AS n FROM nation),
facts({_OUTCOME}) AS (
  SELECT 'nation', 'NATION_TD', n, n, true, 'LOADED', 'SOURCE_LOADED_TARGET_ROW_COUNT_MATCH', 'PASS',
    'source=' || n || '; loaded=' || n || '; target=' || n FROM n
  UNION ALL SELECT 'none_left', 'NONE_LEFT_TD', '0', '0', true, 'EMPTY', 'SOURCE_LOADED_TARGET_ROW_COUNT_MATCH', 'PASS',
    'source=0; loaded=0; target=0'
  UNION ALL SELECT 'clashing', 'CLASHING_TD', NULL, NULL, false, 'FAILED', 'TABLE_LOAD_ERROR', 'FAIL',
    'several source columns map to one target column'
  UNION ALL SELECT 'gone', NULL, NULL, NULL, false, 'FAILED', 'TABLE_LOAD_ERROR', 'FAIL', 'table not found in the source')
SELECT 'PARTIAL_SUCCESS' AS "RUN_STATUS", * FROM facts""",
    "ingest_columns": 'SELECT * FROM (VALUES ' + _COLUMN_VALUES + ') AS v("SOURCE_TABLE", "SOURCE_COLUMN", '
    '"SOURCE_ORDINAL_POSITION", "SOURCE_DATA_TYPE", "TARGET_TABLE", "TARGET_COLUMN", "TARGET_DATA_TYPE")',
    "registered_views": f"""{DECISIONS},
sizes AS ({_injected(_rows_of)}),
sized AS (SELECT * FROM decisions JOIN sizes ON pt = from_table AND pc = from_column AND ct = to_table AND cc = to_column)
SELECT relationship_view_name AS view_name, 'object' AS kind, joined AS row_count FROM sized WHERE object_generate
UNION ALL SELECT bridge_view_name, 'bridge', linked FROM sized WHERE link_generate
UNION ALL SELECT summary_view_name, 'summary', linked FROM sized WHERE link_generate""",
    "stored_documents": f"""{CATALOG_ROWS}
SELECT 'model' AS document, 'relationship' AS item, from_table, to_table, confidence_label FROM edges
UNION ALL SELECT 'catalog', asset_type, from_table, to_table, confidence_label FROM assets
WHERE asset_type <> 'entity_views'""",
    "ingest_run": f"""{_COUNTS}
SELECT "LOAD", 'SUCCESS' AS "RUN_STATUS", t AS "SOURCE_TABLE", upper(t) || '_TD' AS "TARGET_TABLE",
  s AS "SOURCE_ROW_COUNT", g AS "TARGET_ROW_COUNT", true AS "ROW_COUNT_MATCH", st AS "LOAD_STATUS",
  'PASS' AS "VALIDATION_STATUS", CASE WHEN "LOAD" = 1 OR t = 'nation'
    THEN 'source=' || s || '; loaded=' || l || '; target=' || g
    ELSE 'source_total=' || s || '; incremental_loaded=' || l || '; target_after_merge=' || g END AS "VALIDATION_VALUE"
FROM loads""",
    "ingest_merged": f"""
SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY",
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS "O_ORDERSTATUS",
  o_totalprice AS "O_TOTALPRICE", CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 10 YEAR
    ELSE o_orderdate END AS "O_ORDERDATE", o_orderpriority AS "O_ORDERPRIORITY", 'TD' AS "_SOURCE_SYSTEM",
  'memory' AS "_SOURCE_DATABASE", 'public' AS "_SOURCE_SCHEMA", 'orders' AS "_SOURCE_TABLE"
FROM orders WHERE {_OLD} OR {_DELTA}""",
    "ingest_watermarks": """
SELECT 'orders' AS "SOURCE_TABLE", 'ORDERS_TD' AS "TARGET_TABLE", 'o_orderdate' AS "WATERMARK_COLUMN",
  cast(max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 10 YEAR ELSE o_orderdate END) AS VARCHAR)
    AS "WATERMARK_VALUE" FROM orders
UNION ALL SELECT 'events', 'EVENTS_TD', 'ts', cast(max(ts) AS VARCHAR) FROM events""",
    "discovery_run": f"""
WITH edges AS ({td_cardinality_oracle(with_overlap=True)})
SELECT "FROM_TABLE" AS from_table, "FROM_COLUMN" AS from_column, "TO_TABLE" AS to_table, "TO_COLUMN" AS to_column,
  'PARENT_CHILD' AS relationship_type, "CONFIDENCE_LABEL" AS confidence_label, "MATCH_RATE" AS match_rate,
  "CARDINALITY_TYPE" AS cardinality_type FROM edges
WHERE "CONFIDENCE_LABEL" IN ('HIGH', 'MEDIUM')""",
}
