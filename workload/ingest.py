"""Queries for scans, conforming, merging and the run life-cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.functions.names import clean_identifier
from tablescout.functions.rules import counts_match, counts_text, load_status
from tablescout.functions.types import target_type
from tablescout.operators.catalog import latest_runs, latest_watermarks, run_log, run_summary
from tablescout.operators.cells import union_all
from tablescout.operators.conform import ColumnPlan, conform, planned_columns, with_lineage
from tablescout.operators.merge import append_rows, latest_per_key, merge_upsert
from tablescout.schemas import WATERMARK_KEY
from tablescout.sources.base import Watermark, discover_tables
from tablescout.sources.files import FileSource, measured_columns
from tablescout.local import catalog_rows
from workload import sql
from workload.tables import TABLES, shown, table

CUTOFFS = {
    "orders": ("o_orderdate", "2000-01-01 00:00:00"),
    "events": ("ts", "2024-01-15 00:00:00"),
    "lineitem": ("l_shipdate", None),
}
EXCLUDED = ["Embeddings", "PAGES"]
CATALOGED = [name for name in sorted(TABLES) if name not in ("embeddings", "pages")]


def files(spark: SparkSession, sf_dir: str) -> FileSource:
    return FileSource(spark, sf_dir, name="TD_FILES", database="testdata")


def watermark(source: FileSource, name: str) -> Watermark | None:
    column, value = CUTOFFS[name]
    return value and Watermark(value, source.read(name).schema[column].dataType.simpleString())


# Scans


def scan_full(spark, sf_dir) -> DataFrame:
    return files(spark, sf_dir).read("orders")


def scan_incremental(spark, sf_dir) -> DataFrame:
    source = files(spark, sf_dir)
    return source.read_since("orders", "o_orderdate", watermark(source, "orders"))


def plan_incremental_count(spark, sf_dir) -> DataFrame:
    source = files(spark, sf_dir)
    return union_all(
        source.read_since(name, column, watermark(source, name)).agg(
            F.lit(name).alias("SOURCE_TABLE"), F.count(F.lit(1)).alias("PLANNED_ROWS")
        )
        for name, (column, _) in CUTOFFS.items()
    )


def max_watermark(spark, sf_dir) -> DataFrame:
    source = files(spark, sf_dir)
    return union_all(
        source.max_watermark(name, column).select(
            F.lit(name).alias("SOURCE_TABLE"), F.col("MAX_WATERMARK").cast("string").alias("MAX_WATERMARK")
        )
        for name, (column, _) in CUTOFFS.items()
    )


def table_discovery(spark, sf_dir) -> DataFrame:
    source = files(spark, sf_dir)
    found = catalog_rows(discover_tables(source, include=[n.upper() for n in TABLES], exclude=EXCLUDED))
    return union_all(
        source.read(row.TABLE_NAME).agg(
            F.lit(row.TABLE_NAME).alias("SOURCE_TABLE"), F.count(F.lit(1)).alias("SOURCE_ROW_COUNT")
        )
        for row in found
    )


def column_catalog(spark, sf_dir) -> DataFrame:
    source = files(spark, sf_dir)
    found = catalog_rows(discover_tables(source, exclude=EXCLUDED))
    measured = union_all(measured_columns(source, row.TABLE_NAME) for row in found)
    return shown(planned_columns(measured, source.dialect, "_TD"), *SIZES)


SIZES = ["SOURCE_CHARACTER_MAXIMUM_LENGTH", "SOURCE_NUMERIC_PRECISION", "SOURCE_NUMERIC_SCALE"]
REDSHIFT_NAMES = {
    "int": "integer",
    "bigint": "bigint",
    "double": "double precision",
    "timestamp_ntz": "timestamp without time zone",
    "string": "character varying",
}
TARGETS = {"int": "NUMBER(38,0)", "bigint": "NUMBER(38,0)", "double": "FLOAT", "timestamp_ntz": "TIMESTAMP_NTZ"}


def _catalog_oracle() -> str:
    parts = []
    for name in CATALOGED:
        for position, column in enumerate(TABLES[name], start=1):
            kind = sql.kind(name, column)
            length = f"max(length({column}))" if kind == "string" else "cast(NULL AS BIGINT)"
            target = "'VARCHAR(' || max(length({})) || ')'".format(column) if kind == "string" else f"'{TARGETS[kind]}'"
            parts.append(
                f"SELECT '{name}' AS \"SOURCE_TABLE\", '{column}' AS \"SOURCE_COLUMN\", "
                f'cast({position} AS BIGINT) AS "SOURCE_ORDINAL_POSITION", '
                f"'{REDSHIFT_NAMES[kind]}' AS \"SOURCE_DATA_TYPE\", {length} AS \"SOURCE_CHARACTER_MAXIMUM_LENGTH\", "
                f'cast(NULL AS BIGINT) AS "SOURCE_NUMERIC_PRECISION", cast(NULL AS BIGINT) AS "SOURCE_NUMERIC_SCALE", '
                f"CASE WHEN count(*) > count({column}) THEN 'YES' ELSE 'NO' END AS \"SOURCE_IS_NULLABLE\", "
                f"{sql.clean(sql.text(name))} || '_TD' AS \"TARGET_TABLE\", "
                f'{sql.clean(sql.text(column))} AS "TARGET_COLUMN", {target} AS "TARGET_DATA_TYPE" FROM {name}'
            )
    return sql.union_all(parts)


# Names and types

NAME_COLUMNS = {
    "part": ["p_name", "p_type", "p_brand"],
    "orders": ["o_orderpriority"],
    "conversations": ["role"],
    "pages": ["url"],
    "customer": ["c_name", "c_mktsegment"],
}


def clean_identifiers(spark, sf_dir) -> DataFrame:
    names = union_all(
        table(spark, sf_dir, name).select(F.col(column).alias("NAME")).distinct()
        for name, columns in NAME_COLUMNS.items()
        for column in columns
    ).distinct()
    return names.select("NAME", clean_identifier(F.col("NAME")).alias("CLEANED"))


# Declared types for rows of lineitem, by line number.
DECLARED = {
    "sqlserver": ["int", "money", "float", "bit", "nvarchar", "datetimeoffset", "uniqueidentifier"],
    "redshift": ["integer", "numeric", "real", "boolean", "character varying", "timestamp with time zone", "super"],
}


def conform_large_numbers(spark, sf_dir) -> DataFrame:
    """Order keys widened beyond 64 bits, as a decimal of 38 digits and as text of a numeric column; shown as text."""
    widened = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "cast(concat(o_orderkey, '00000000000000000000') AS decimal(38,0)) AS big",
        "concat(o_orderkey, '99999999999999999999.4') AS wide_text",
    )
    plan = [
        ColumnPlan("o_orderkey", "O_ORDERKEY", "NUMBER(38,0)", "bigint"), ColumnPlan("big", "BIG", "NUMBER(38,0)", "numeric"),
        ColumnPlan("wide_text", "WIDE_TEXT", "NUMBER(38,0)", "numeric"),
    ]
    return shown(conform(widened, plan), "BIG", "WIDE_TEXT")


# Every declared type name with its target, the short names of DECIMAL and TEXT targets worked out below.
MAPPED = {
    "sqlserver": "bigint=W int=W smallint=W tinyint=W bit=BOOLEAN decimal=N numeric=N money=N smallmoney=N float=FLOAT "
    "real=FLOAT date=DATE datetime=TIMESTAMP_NTZ datetime2=TIMESTAMP_NTZ smalldatetime=TIMESTAMP_NTZ "
    "datetimeoffset=TIMESTAMP_TZ time=TIME uniqueidentifier=VARCHAR(36) binary=BINARY varbinary=BINARY image=BINARY "
    "varchar=T nvarchar=T char=T nchar=T text=T ntext=T xml=T",
    "redshift": "smallint=W integer=W bigint=W numeric=N decimal=N real=FLOAT double_precision=FLOAT boolean=BOOLEAN "
    "date=DATE timestamp_without_time_zone=TIMESTAMP_NTZ timestamp=TIMESTAMP_NTZ timestamp_with_time_zone=TIMESTAMP_TZ "
    "character_varying=T varchar=T character=T char=T text=T",
}
MAPPED_NAMES = [
    (dialect, name.replace("_", " "), target)
    for dialect, pairs in MAPPED.items()
    for name, target in (pair.split("=") for pair in pairs.split())
]


def type_mapping_names(spark, sf_dir) -> DataFrame:
    """All declared type names of both dialects, for every line number as precision and supplier as length."""
    facts = table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("long").alias("PRECISION"), F.pmod("l_suppkey", F.lit(3)).cast("long").alias("SCALE"),
        F.pmod("l_suppkey", F.lit(50)).cast("long").alias("LENGTH"),
    ).distinct()
    named = facts.withColumn(
        "N", F.explode(F.array(*[F.struct(F.lit(d).alias("D"), F.lit(n).alias("T")) for d, n, _ in MAPPED_NAMES]))
    ).select("PRECISION", "SCALE", "LENGTH", F.col("N.D").alias("DIALECT"), F.col("N.T").alias("DATA_TYPE"))
    target = F.coalesce(*[
        F.when(F.col("DIALECT") == d, target_type(d, F.col("DATA_TYPE"), F.col("LENGTH"), F.col("PRECISION"), F.col("SCALE")))
        for d in MAPPED
    ])
    return named.withColumn("TARGET", target)


def _mapped_oracle() -> str:
    names = ", ".join(f"('{d}', '{n}', '{t}')" for d, n, t in MAPPED_NAMES)
    return f"""
WITH facts AS (SELECT DISTINCT l_linenumber::BIGINT AS "PRECISION", (l_suppkey % 3)::BIGINT AS "SCALE",
  (l_suppkey % 50)::BIGINT AS "LENGTH" FROM lineitem)
SELECT "PRECISION", "SCALE", "LENGTH", d AS "DIALECT", n AS "DATA_TYPE", CASE t WHEN 'W' THEN 'NUMBER(38,0)'
  WHEN 'N' THEN 'NUMBER(' || "PRECISION" || ',' || "SCALE" || ')' WHEN 'T' THEN 'VARCHAR(' || "LENGTH" || ')' ELSE t END
  AS "TARGET" FROM facts, (VALUES {names}) v(d, n, t)"""


def type_mapping(spark, sf_dir) -> DataFrame:
    """Every declared type of both dialects with lengths, precisions and scales found in lineitem."""
    facts = table(spark, sf_dir, "lineitem").select(
        "l_linenumber",
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("LENGTH"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("long")).alias("PRECISION"),
        F.when(F.col("l_returnflag") == "A", F.col("l_linenumber").cast("long")).alias("SCALE"),
    ).distinct()
    parts = []
    for dialect, names in DECLARED.items():
        declared = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("l_linenumber"))
        parts.append(
            facts.select(
                F.lit(dialect).alias("DIALECT"),
                declared.alias("DATA_TYPE"),
                "LENGTH",
                "PRECISION",
                "SCALE",
                target_type(dialect, declared, F.col("LENGTH"), F.col("PRECISION"), F.col("SCALE")).alias("TARGET"),
            )
        )
    return shown(union_all(parts), "LENGTH", "PRECISION", "SCALE")


def _type_oracle() -> str:
    number = (
        "'NUMBER(' || least(coalesce(\"PRECISION\", 38), 38) || ',' || coalesce(\"SCALE\", 4) || ')'"
    )
    length = "CASE WHEN \"LENGTH\" IS NULL THEN 'VARCHAR' ELSE 'VARCHAR(' || least(\"LENGTH\", 16777216) || ')' END"
    targets = {
        "sqlserver": ["'NUMBER(38,0)'", number, "'FLOAT'", "'BOOLEAN'", length, "'TIMESTAMP_TZ'", "'VARCHAR(36)'"],
        "redshift": ["'NUMBER(38,0)'", number, "'FLOAT'", "'BOOLEAN'", length, "'TIMESTAMP_TZ'", "'VARCHAR'"],
    }
    parts = []
    for dialect, names in DECLARED.items():
        name_case = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names, start=1))
        target_case = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(targets[dialect], start=1))
        parts.append(
            f"SELECT '{dialect}' AS \"DIALECT\", CASE l_linenumber {name_case} END AS \"DATA_TYPE\", "
            f'"LENGTH", "PRECISION", "SCALE", CASE l_linenumber {target_case} END AS "TARGET" FROM facts'
        )
    return (
        "WITH facts AS (SELECT DISTINCT l_linenumber, "
        "CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS \"LENGTH\", "
        "CASE WHEN l_linestatus = 'F' THEN cast(l_quantity AS BIGINT) END AS \"PRECISION\", "
        "CASE WHEN l_returnflag = 'A' THEN cast(l_linenumber AS BIGINT) END AS \"SCALE\" FROM lineitem)\n"
        + sql.union_all(parts)
    )


# Conform


def raw_events(spark, sf_dir) -> DataFrame:
    """events as a text source would deliver it, with blank and malformed values."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event id"),
        F.when(kind == "click", F.lit("2024-13-01 00:00:00")).otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(kind == "error", F.lit("abc"))
        .when(kind == "view", F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
        .otherwise(F.col("value").cast("string"))
        .alias("2nd-value"),
        F.when(kind == "view", "true").when(kind == "click", "false").alias("is_view"),
        F.when(kind == "signup", F.lit(" \t \n"))
        .when(kind == "purchase", F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.col("props"), F.lit(" ")))
        .alias("props"),
        F.col("user_id").alias("user"),
        kind.alias("extra"),
    )


CONFORM_PLAN = [
    ColumnPlan("event id", "EVENT_ID", "NUMBER(38,0)"),
    ColumnPlan("timestamp", "TIMESTAMP_COL", "TIMESTAMP_NTZ"),
    ColumnPlan("2nd-value", "COL_2ND_VALUE", "NUMBER(12,1)"),
    ColumnPlan("is_view", "IS_VIEW", "BOOLEAN"),
    ColumnPlan("props", "PROPS", "VARCHAR"),
    ColumnPlan("user", "USER_COL", "NUMBER(38,0)"),
]


def conform_rows(spark, sf_dir) -> DataFrame:
    fitted = conform(raw_events(spark, sf_dir), CONFORM_PLAN)
    return with_lineage(fitted, "TD", "testdata", "public", "events").drop("_INGESTED_AT")


CONFORM_ORACLE = """
SELECT event_id AS "EVENT_ID",
  CASE WHEN event_type <> 'click' THEN cast(ts AS TIMESTAMP) END AS "TIMESTAMP_COL",
  CASE WHEN event_type <> 'error' THEN cast(cast(value AS VARCHAR) AS DECIMAL(12,1)) END AS "COL_2ND_VALUE",
  CASE event_type WHEN 'view' THEN true WHEN 'click' THEN false END AS "IS_VIEW",
  CASE WHEN event_type NOT IN ('signup', 'purchase') THEN ' ' || props || ' ' END AS "PROPS",
  user_id AS "USER_COL", event_type AS extra,
  'TD' AS "_SOURCE_SYSTEM", 'testdata' AS "_SOURCE_DATABASE", 'public' AS "_SOURCE_SCHEMA", 'events' AS "_SOURCE_TABLE"
FROM events"""


# Merge

FIRST_OF_2000 = "timestamp_ntz '2000-01-01'"


def base_and_stage(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders up to 2000 as target; later orders and re-sent urgent ones (status X) as stage."""
    orders = table(spark, sf_dir, "orders")
    old = orders.where(f"o_orderdate <= {FIRST_OF_2000}")
    resent = old.where("o_orderpriority = '1-URGENT'").withColumn("o_orderstatus", F.lit("X"))
    return old, resent.unionByName(orders.where(f"o_orderdate > {FIRST_OF_2000}"))


STAGED = """
WITH base AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01'),
stage AS (SELECT * REPLACE ('X' AS o_orderstatus) FROM base WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01')
"""


def merge_orders(spark, sf_dir) -> DataFrame:
    target, stage = base_and_stage(spark, sf_dir)
    return merge_upsert(target, stage, ["o_orderkey"])


def append_delta(spark, sf_dir) -> DataFrame:
    return append_rows(*base_and_stage(spark, sf_dir))


def doc_reviews(spark, sf_dir) -> DataFrame:
    """Documents with the label's document id, NULL where there is no label."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_doc_id"), "quality")
    documents = table(spark, sf_dir, "documents")
    return documents.join(labels, documents.doc_id == labels.label_doc_id, "left").select(
        documents.doc_id.alias("REVIEW_ID"), F.col("label_doc_id").alias("DOC_ID"), "lang", "quality"
    )


DOC_REVIEW = (
    '(SELECT d.doc_id AS "REVIEW_ID", l.doc_id AS "DOC_ID", d.lang, l.quality '
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)


def merge_null_keys(spark, sf_dir) -> DataFrame:
    """NULL keys never match: such stage rows are added again."""
    target = doc_reviews(spark, sf_dir)
    stage = target.where("lang = 'en'").withColumn("quality", F.lit(9))
    return shown(merge_upsert(target, stage, ["DOC_ID"]), "DOC_ID", "quality")


def merge_repeated_keys(spark, sf_dir) -> DataFrame:
    """A target key on several rows: each of them takes the stage's values."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    totals = table(spark, sf_dir, "orders").where(f"o_orderdate > {FIRST_OF_2000}").select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit("T").alias("l_returnflag"),
        F.col("o_totalprice").alias("l_quantity"),
    )
    return merge_upsert(lines, totals, ["l_orderkey"])


def merge_latest_duplicate(spark, sf_dir) -> DataFrame:
    """A delta with several versions of a key: the newest by watermark is merged."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    first = latest_per_key(events, ["user_id"], [F.col("ts")])
    last = latest_per_key(events.where("event_type = 'purchase'"), ["user_id"], [F.desc("ts")])
    return merge_upsert(first, last, ["user_id"])


# Watermarks, run log, validation


def watermark_updates(spark, sf_dir) -> DataFrame:
    """A watermark table as appended by many runs: one update per order."""
    return table(spark, sf_dir, "orders").select(
        F.lit("TD").alias("SOURCE_SYSTEM"),
        F.col("o_orderpriority").alias("SOURCE_DATABASE"),
        F.lit("public").alias("SOURCE_SCHEMA"),
        F.concat(F.lit("T"), F.col("o_custkey")).alias("SOURCE_TABLE"),
        F.lit("LAKE").alias("TARGET_DATABASE"),
        F.lit("RAW").alias("TARGET_SCHEMA"),
        F.concat(F.lit("T"), F.col("o_custkey"), F.lit("_TD")).alias("TARGET_TABLE"),
        F.lit("o_orderdate").alias("WATERMARK_COLUMN"),
        F.col("o_totalprice").cast("string").alias("WATERMARK_VALUE"),
        F.lit("double").alias("WATERMARK_TYPE"),
        F.col("o_orderkey").cast("string").alias("LAST_SUCCESSFUL_RUN_ID"),
        F.col("o_orderdate").alias("UPDATED_AT"),
    )


def watermark_upsert(spark, sf_dir) -> DataFrame:
    return latest_watermarks(watermark_updates(spark, sf_dir))


WATERMARK_ORACLE = f"""
SELECT * FROM (
  SELECT 'TD' AS "SOURCE_SYSTEM", o_orderpriority AS "SOURCE_DATABASE", 'public' AS "SOURCE_SCHEMA",
    'T' || o_custkey AS "SOURCE_TABLE", 'LAKE' AS "TARGET_DATABASE", 'RAW' AS "TARGET_SCHEMA",
    'T' || o_custkey || '_TD' AS "TARGET_TABLE", 'o_orderdate' AS "WATERMARK_COLUMN",
    cast(o_totalprice AS VARCHAR) AS "WATERMARK_VALUE", 'double' AS "WATERMARK_TYPE",
    cast(o_orderkey AS VARCHAR) AS "LAST_SUCCESSFUL_RUN_ID", o_orderdate AS "UPDATED_AT"
  FROM orders
) QUALIFY row_number() OVER (
  PARTITION BY {", ".join(f'"{c}"' for c in WATERMARK_KEY)}
  ORDER BY "UPDATED_AT" DESC, "LAST_SUCCESSFUL_RUN_ID" DESC) = 1"""


def run_events(spark, sf_dir) -> DataFrame:
    """Run log events: every order starts a run, its line items finish it."""
    orders = table(spark, sf_dir, "orders")
    started = orders.select(
        F.col("o_orderkey").cast("string").alias("RUN_ID"),
        F.concat(F.lit("SYS_"), F.col("o_custkey")).alias("SOURCE_SYSTEM"),
        F.col("o_orderpriority").alias("SOURCE_DATABASE"),
        F.lit("public").alias("SOURCE_SCHEMA"),
        F.lit("LAKE").alias("TARGET_DATABASE"),
        F.lit("RAW").alias("TARGET_SCHEMA"),
        F.lit("full_refresh").alias("LOAD_MODE"),
        F.col("o_orderdate").alias("STARTED_AT"),
        F.lit(None).cast("timestamp_ntz").alias("FINISHED_AT"),
        F.lit("RUNNING").alias("STATUS"),
        F.lit(None).cast("string").alias("ERROR_MESSAGE"),
    )
    failed = F.count_if(F.col("l_returnflag") == "R")
    finished = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("FINISHED_AT"), failed.alias("N"))
        .select(
            F.col("l_orderkey").cast("string").alias("RUN_ID"),
            "FINISHED_AT",
            F.when(F.col("N") > 0, "PARTIAL_SUCCESS").otherwise("SUCCESS").alias("STATUS"),
            F.when(F.col("N") > 0, F.concat(F.col("N").cast("string"), F.lit(" table(s) failed"))).alias(
                "ERROR_MESSAGE"
            ),
        )
    )
    return started.unionByName(finished, allowMissingColumns=True)


RUNS = """runs AS (
  SELECT cast(o_orderkey AS VARCHAR) AS "RUN_ID", 'SYS_' || o_custkey AS "SOURCE_SYSTEM",
    o_orderpriority AS "SOURCE_DATABASE", 'public' AS "SOURCE_SCHEMA", 'LAKE' AS "TARGET_DATABASE",
    'RAW' AS "TARGET_SCHEMA", 'full_refresh' AS "LOAD_MODE", o_orderdate AS "STARTED_AT", f AS "FINISHED_AT",
    CASE WHEN f IS NULL THEN 'RUNNING' WHEN n > 0 THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS "STATUS",
    CASE WHEN n > 0 THEN n || ' table(s) failed' END AS "ERROR_MESSAGE"
  FROM orders LEFT JOIN (
    SELECT l_orderkey, max(l_shipdate) AS f, count(*) FILTER (l_returnflag = 'R') AS n FROM lineitem GROUP BY 1
  ) ON o_orderkey = l_orderkey
)"""
LATEST_RUNS = """latest AS (
  SELECT * FROM runs QUALIFY row_number() OVER (
    PARTITION BY "SOURCE_SYSTEM", "SOURCE_DATABASE", "SOURCE_SCHEMA", "TARGET_DATABASE", "TARGET_SCHEMA"
    ORDER BY "STARTED_AT" DESC, "RUN_ID" DESC) = 1
)"""


def run_log_collapsed(spark, sf_dir) -> DataFrame:
    return run_log(run_events(spark, sf_dir))


def run_log_latest(spark, sf_dir) -> DataFrame:
    return latest_runs(run_log(run_events(spark, sf_dir)))


def run_log_latest_finished(spark, sf_dir) -> DataFrame:
    return latest_runs(run_log(run_events(spark, sf_dir)), status_in=["SUCCESS"])


def validate_counts(spark, sf_dir) -> DataFrame:
    """Validation and load status of one load per part, counted from its line items."""
    strategy = F.when(F.col("l_linestatus") == "F", "full_refresh").otherwise("timestamp")
    counted = table(spark, sf_dir, "lineitem").groupBy("l_partkey", strategy.alias("STRATEGY")).agg(
        F.count(F.lit(1)).alias("SOURCE_ROWS"),
        F.count_if(F.col("l_quantity") < 50).alias("LOADED_ROWS"),
        F.count_if(F.col("l_extendedprice") > 1000).alias("TARGET_ROWS"),
        (F.count_if(F.col("l_returnflag") == "A") > 3).alias("MERGED"),
        F.max(F.when(F.col("l_discount") > 0.05, "incremental_plan").otherwise("incremental")).alias("MODE"),
    )
    counts = [F.col(f"{n}_ROWS") for n in ("SOURCE", "LOADED", "TARGET")]
    return counted.select(
        "*",
        F.when(counts_match(F.col("STRATEGY"), *counts), "PASS").otherwise("FAIL").alias("VALIDATION_STATUS"),
        counts_text(F.col("STRATEGY"), *counts).alias("VALIDATION_VALUE"),
        load_status(F.col("MODE"), F.col("STRATEGY"), F.col("MERGED"), counts[0]).alias("LOAD_STATUS"),
    )


VALIDATE_ORACLE = """
SELECT *,
  CASE WHEN "STRATEGY" <> 'full_refresh' AND "LOADED_ROWS" >= 0 THEN 'PASS'
    WHEN "STRATEGY" = 'full_refresh' AND "SOURCE_ROWS" = "LOADED_ROWS" AND "LOADED_ROWS" = "TARGET_ROWS" THEN 'PASS'
    ELSE 'FAIL' END AS "VALIDATION_STATUS",
  CASE WHEN "STRATEGY" = 'full_refresh'
    THEN 'source=' || "SOURCE_ROWS" || '; loaded=' || "LOADED_ROWS" || '; target=' || "TARGET_ROWS"
    ELSE 'source_total=' || "SOURCE_ROWS" || '; incremental_loaded=' || "LOADED_ROWS" || '; target_after_merge='
      || "TARGET_ROWS" END AS "VALIDATION_VALUE",
  CASE WHEN "MODE" = 'incremental_plan' AND "STRATEGY" <> 'full_refresh' THEN 'PLANNED' WHEN "MERGED" THEN 'MERGED'
    WHEN "SOURCE_ROWS" > 0 THEN 'LOADED' ELSE 'EMPTY' END AS "LOAD_STATUS"
FROM (
  SELECT l_partkey, CASE WHEN l_linestatus = 'F' THEN 'full_refresh' ELSE 'timestamp' END AS "STRATEGY",
    count(*) AS "SOURCE_ROWS", count(*) FILTER (l_quantity < 50) AS "LOADED_ROWS",
    count(*) FILTER (l_extendedprice > 1000) AS "TARGET_ROWS",
    count(*) FILTER (l_returnflag = 'A') > 3 AS "MERGED",
    max(CASE WHEN l_discount > 0.05 THEN 'incremental_plan' ELSE 'incremental' END) AS "MODE"
  FROM lineitem GROUP BY 1, 2
)"""


def table_catalog_rows(spark, sf_dir) -> DataFrame:
    """A table catalog as many runs would fill it: a run per order, a table per line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("RUN_ID"),
        F.concat(F.lit("T"), F.col("l_partkey")).alias("SOURCE_TABLE"),
        F.concat(F.lit("T"), F.col("l_partkey"), F.lit("_TD")).alias("TARGET_TABLE"),
        F.col("l_quantity").cast("long").alias("SOURCE_ROW_COUNT"),
        (F.col("l_quantity") - F.col("l_linenumber")).cast("long").alias("TARGET_ROW_COUNT"),
        F.when(F.col("l_returnflag") == "R", "FAILED").when(F.col("l_returnflag") == "A", "MERGED")
        .otherwise("LOADED").alias("LOAD_STATUS"),
        F.col("l_tax").alias("LOAD_SECONDS"),
        F.col("l_shipdate").alias("LOADED_AT"),
    )


TABLE_CATALOG = """table_catalog AS (
  SELECT cast(l_orderkey AS VARCHAR) AS "RUN_ID", 'T' || l_partkey AS "SOURCE_TABLE",
    'T' || l_partkey || '_TD' AS "TARGET_TABLE", cast(l_quantity AS BIGINT) AS "SOURCE_ROW_COUNT",
    cast(l_quantity - l_linenumber AS BIGINT) AS "TARGET_ROW_COUNT",
    CASE l_returnflag WHEN 'R' THEN 'FAILED' WHEN 'A' THEN 'MERGED' ELSE 'LOADED' END AS "LOAD_STATUS",
    l_tax AS "LOAD_SECONDS", l_shipdate AS "LOADED_AT"
  FROM lineitem
)"""


def run_summaries(spark, sf_dir) -> DataFrame:
    return run_summary(table_catalog_rows(spark, sf_dir))


QUERIES = {
    "scan_full": scan_full,
    "scan_incremental": scan_incremental,
    "plan_incremental_count": plan_incremental_count,
    "max_watermark": max_watermark,
    "table_discovery": table_discovery,
    "column_catalog": column_catalog,
    "clean_identifiers": clean_identifiers,
    "type_mapping": type_mapping,
    "conform_rows": conform_rows,
    "conform_large_numbers": conform_large_numbers,
    "type_mapping_names": type_mapping_names,
    "merge_upsert": merge_orders,
    "append_delta": append_delta,
    "merge_null_keys": merge_null_keys,
    "merge_repeated_keys": merge_repeated_keys,
    "merge_latest_duplicate": merge_latest_duplicate,
    "watermark_upsert": watermark_upsert,
    "run_log_collapsed": run_log_collapsed,
    "run_log_latest": run_log_latest,
    "run_log_latest_finished": run_log_latest_finished,
    "validate_counts": validate_counts,
    "run_summary": run_summaries,
}

_DOC_REVIEW_COLUMNS = '"REVIEW_ID", "DOC_ID", lang'

ORACLES = {
    "scan_full": "SELECT * FROM orders",
    "scan_incremental": "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'",
    "plan_incremental_count": """
SELECT 'orders' AS "SOURCE_TABLE", count(*) AS "PLANNED_ROWS" FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'
UNION ALL SELECT 'events', count(*) FROM events WHERE ts > TIMESTAMP '2024-01-15'
UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    "max_watermark": """
SELECT 'orders' AS "SOURCE_TABLE", cast(max(o_orderdate) AS VARCHAR) AS "MAX_WATERMARK" FROM orders
UNION ALL SELECT 'events', cast(max(ts) AS VARCHAR) FROM events
UNION ALL SELECT 'lineitem', cast(max(l_shipdate) AS VARCHAR) FROM lineitem""",
    "table_discovery": sql.union_all(
        f"SELECT '{n}' AS \"SOURCE_TABLE\", count(*) AS \"SOURCE_ROW_COUNT\" FROM {n}" for n in CATALOGED
    ),
    "column_catalog": sql.shown(_catalog_oracle(), *SIZES),
    "clean_identifiers": 'SELECT "NAME", '
    + sql.clean('"NAME"')
    + ' AS "CLEANED" FROM ('
    + "\nUNION ".join(
        f'SELECT {column} AS "NAME" FROM {name}' for name, columns in NAME_COLUMNS.items() for column in columns
    )
    + ")",
    "type_mapping": sql.shown(_type_oracle(), "LENGTH", "PRECISION", "SCALE"),
    "conform_rows": CONFORM_ORACLE,
    "conform_large_numbers": """
SELECT o_orderkey AS "O_ORDERKEY", (o_orderkey::HUGEINT * 100000000000000000000)::VARCHAR AS "BIG",
  (o_orderkey::HUGEINT * 100000000000000000000 + 99999999999999999999)::VARCHAR AS "WIDE_TEXT" FROM orders""",
    "type_mapping_names": _mapped_oracle(),
    "merge_upsert": STAGED
    + "SELECT * FROM base ANTI JOIN stage USING (o_orderkey) UNION ALL SELECT * FROM stage",
    "append_delta": STAGED + "SELECT * FROM base UNION ALL SELECT * FROM stage",
    "merge_null_keys": sql.shown(
        f"""
WITH target AS (SELECT * FROM {DOC_REVIEW}),
stage AS (SELECT {_DOC_REVIEW_COLUMNS}, 9 AS quality FROM target WHERE lang = 'en')
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM stage s WHERE s."DOC_ID" = t."DOC_ID")
UNION ALL SELECT * FROM stage""",
        "DOC_ID",
        "quality",
    ),
    "merge_repeated_keys": """
WITH stage AS (SELECT o_orderkey AS k, o_totalprice AS p FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01')
SELECT l_orderkey, CASE WHEN k IS NULL THEN l_returnflag ELSE 'T' END AS l_returnflag,
  CASE WHEN k IS NULL THEN l_quantity ELSE p END AS l_quantity
FROM lineitem LEFT JOIN stage ON l_orderkey = k
UNION ALL SELECT k, 'T', p FROM stage WHERE k NOT IN (SELECT l_orderkey FROM lineitem)""",
    "merge_latest_duplicate": """
WITH e AS (SELECT user_id, ts, event_type, value FROM events),
first_rows AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts) = 1),
last_rows AS (SELECT * FROM e WHERE event_type = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
SELECT * FROM first_rows ANTI JOIN last_rows USING (user_id) UNION ALL SELECT * FROM last_rows""",
    "watermark_upsert": WATERMARK_ORACLE,
    "run_log_collapsed": f"WITH {RUNS} SELECT * FROM runs",
    "run_log_latest": f"WITH {RUNS}, {LATEST_RUNS} SELECT * FROM latest",
    "run_log_latest_finished": "WITH "
    + RUNS.replace("runs AS (", "all_runs AS (", 1)
    + ", runs AS (SELECT * FROM all_runs WHERE \"STATUS\" = 'SUCCESS'), "
    + LATEST_RUNS
    + " SELECT * FROM latest",
    "validate_counts": VALIDATE_ORACLE,
    "run_summary": f"""
WITH {TABLE_CATALOG}
SELECT "RUN_ID", count(*) AS "TABLES", count(*) FILTER ("LOAD_STATUS" = 'FAILED') AS "FAILED_TABLES",
  CASE WHEN count(*) FILTER ("LOAD_STATUS" = 'FAILED') > 0 THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS "STATUS",
  CASE WHEN count(*) FILTER ("LOAD_STATUS" = 'FAILED') > 0
    THEN count(*) FILTER ("LOAD_STATUS" = 'FAILED') || ' table(s) failed' END AS "ERROR_MESSAGE"
FROM table_catalog GROUP BY "RUN_ID\"""",
}
