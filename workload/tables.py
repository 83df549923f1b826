"""The given tables, and the renamed views the discovery queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SYSTEM = "TD_SQLSERVER"

TABLES = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "embeddings": "vec_id embedding label",
}
TABLES = {name: columns.split() for name, columns in TABLES.items()}

RENAMED = {
    "REGION_TD": ("region", "REGION_ID REGION_NAME"),
    "NATION_TD": ("nation", "NATION_ID NATION_NAME REGION_ID"),
    "CUSTOMER_TD": ("customer", "CUSTOMER_ID CUSTOMER_NAME NATION_ID ACCOUNT_BALANCE MARKET_SEGMENT"),
    "SUPPLIER_TD": ("supplier", "SUPPLIER_ID SUPPLIER_NAME NATION_ID ACCOUNT_BALANCE"),
    "PART_TD": ("part", "PART_ID PART_NAME BRAND PART_TYPE PART_SIZE RETAIL_PRICE"),
    "ORDERS_TD": ("orders", "ORDER_ID CUSTOMER_ID ORDER_STATUS TOTAL_PRICE ORDER_DATE ORDER_PRIORITY"),
    "LINEITEM_TD": (
        "lineitem",
        "ORDER_ID PART_ID SUPPLIER_ID LINE_NUMBER QUANTITY EXTENDED_PRICE DISCOUNT TAX RETURN_FLAG LINE_STATUS "
        "SHIP_DATE",
    ),
    "DOCUMENTS_TD": ("documents", "DOC_ID TEXT_COL LANG SOURCE N_CHARS"),
    "LABELS_TD": ("labels", "DOC_ID QUALITY TOXIC"),
}
RENAMED = {view: (table, names.split()) for view, (table, names) in RENAMED.items()}


# Schemas of files read before; the given tables do not change, so they are inferred once.
_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in TABLES}


def renamed_view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    source, names = RENAMED[view]
    return table(spark, sf_dir, source).selectExpr(
        *[f"{old} AS {new}" for old, new in zip(TABLES[source], names, strict=True)]
    )


def renamed_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {view: renamed_view(spark, sf_dir, view) for view in RENAMED}


def shown(rows: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers that may be NULL as text, so every client shows them alike (not as 1.0 and NaN)."""
    return rows.withColumns({name: rows[name].cast("string") for name in columns})
