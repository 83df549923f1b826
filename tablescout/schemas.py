"""Schemas of the catalog, log and discovery tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _schema(*groups: tuple[str, str]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _TYPES[kind], True) for kind, names in groups for name in names.split()]
    )


RUN_LOG = _schema(
    ("string", "RUN_ID SOURCE_SYSTEM SOURCE_DATABASE SOURCE_SCHEMA TARGET_DATABASE TARGET_SCHEMA LOAD_MODE"),
    ("timestamp", "STARTED_AT FINISHED_AT"),
    ("string", "STATUS ERROR_MESSAGE"),
)

TABLE_CATALOG = _schema(
    ("string", "RUN_ID SOURCE_SYSTEM SOURCE_DATABASE SOURCE_SCHEMA SOURCE_TABLE"),
    ("string", "TARGET_DATABASE TARGET_SCHEMA TARGET_TABLE"),
    ("long", "SOURCE_ROW_COUNT TARGET_ROW_COUNT"),
    ("boolean", "ROW_COUNT_MATCH"),
    ("string", "LOAD_STATUS"),
    ("double", "LOAD_SECONDS"),
    ("timestamp", "LOADED_AT"),
)

COLUMN_CATALOG = _schema(
    ("string", "RUN_ID SOURCE_SYSTEM SOURCE_DATABASE SOURCE_SCHEMA SOURCE_TABLE SOURCE_COLUMN"),
    ("long", "SOURCE_ORDINAL_POSITION"),
    ("string", "SOURCE_DATA_TYPE"),
    ("long", "SOURCE_CHARACTER_MAXIMUM_LENGTH SOURCE_NUMERIC_PRECISION SOURCE_NUMERIC_SCALE"),
    ("string", "SOURCE_IS_NULLABLE TARGET_DATABASE TARGET_SCHEMA TARGET_TABLE TARGET_COLUMN TARGET_DATA_TYPE"),
    ("timestamp", "CATALOGED_AT"),
)

VALIDATION_RESULTS = _schema(
    ("string", "RUN_ID SOURCE_SYSTEM TARGET_DATABASE TARGET_SCHEMA TARGET_TABLE"),
    ("string", "VALIDATION_NAME VALIDATION_STATUS VALIDATION_VALUE"),
    ("timestamp", "VALIDATED_AT"),
)

WATERMARK_KEY = [
    "SOURCE_SYSTEM",
    "SOURCE_DATABASE",
    "SOURCE_SCHEMA",
    "SOURCE_TABLE",
    "TARGET_DATABASE",
    "TARGET_SCHEMA",
    "TARGET_TABLE",
    "WATERMARK_COLUMN",
]

WATERMARKS = _schema(
    ("string", " ".join(WATERMARK_KEY)),
    ("string", "WATERMARK_VALUE WATERMARK_TYPE LAST_SUCCESSFUL_RUN_ID"),
    ("timestamp", "UPDATED_AT"),
)

SOURCE_COLUMNS = _schema(
    ("string", "SOURCE_TABLE SOURCE_COLUMN"),
    ("long", "SOURCE_ORDINAL_POSITION"),
    ("string", "SOURCE_DATA_TYPE"),
    ("long", "SOURCE_CHARACTER_MAXIMUM_LENGTH SOURCE_NUMERIC_PRECISION SOURCE_NUMERIC_SCALE"),
    ("string", "SOURCE_IS_NULLABLE"),
)

COLUMN_PROFILE = _schema(
    ("string", "PROFILE_RUN_ID SOURCE_SYSTEM TARGET_DATABASE TARGET_SCHEMA TARGET_TABLE TARGET_COLUMN DATA_TYPE"),
    ("long", "ROW_COUNT NON_NULL_COUNT NULL_COUNT DISTINCT_COUNT"),
    ("double", "DISTINCT_RATIO NON_NULL_RATIO"),
    ("string", "MIN_VALUE MAX_VALUE"),
    ("timestamp", "PROFILED_AT"),
)

# Tables that a discovery run could not profile, with the error.
PROFILE_FAILURES = _schema(
    ("string", "PROFILE_RUN_ID SOURCE_SYSTEM TARGET_DATABASE TARGET_SCHEMA TARGET_TABLE ERROR_MESSAGE"),
    ("timestamp", "FAILED_AT"),
)

KEY_CANDIDATES = _schema(
    ("string", "PROFILE_RUN_ID SOURCE_SYSTEM TARGET_DATABASE TARGET_SCHEMA TARGET_TABLE TARGET_COLUMN"),
    ("string", "DATA_TYPE CANDIDATE_TYPE"),
    ("double", "CONFIDENCE_SCORE"),
    ("string", "REASON"),
    ("timestamp", "CREATED_AT"),
)

RELATIONSHIP_CANDIDATES = _schema(
    ("string", "RELATIONSHIP_RUN_ID PROFILE_RUN_ID SOURCE_SYSTEM PARENT_TABLE PARENT_COLUMN CHILD_TABLE CHILD_COLUMN"),
    ("long", "MATCH_COUNT CHILD_NON_NULL_COUNT"),
    ("double", "MATCH_RATE CONFIDENCE_SCORE"),
    ("string", "CONFIDENCE_LABEL DISCOVERY_METHOD"),
    ("timestamp", "CREATED_AT"),
)

RELATIONSHIP_GRAPH = _schema(
    ("string", "SOURCE_SYSTEM FROM_TABLE FROM_COLUMN TO_TABLE TO_COLUMN RELATIONSHIP_TYPE CONFIDENCE_LABEL"),
    ("double", "MATCH_RATE"),
    ("timestamp", "CREATED_AT"),
)

ENTITY_MAP = _schema(
    ("string", "ENTITY_NAME SOURCE_SYSTEM TARGET_TABLE ENTITY_ROLE CONFIDENCE_LABEL"),
    ("timestamp", "CREATED_AT"),
)

CARDINALITY = _schema(
    ("string", "CARDINALITY_RUN_ID SOURCE_SYSTEM FROM_TABLE FROM_COLUMN TO_TABLE TO_COLUMN"),
    ("long", "FROM_DISTINCT_KEYS TO_DISTINCT_KEYS FROM_DUPLICATE_KEYS TO_DUPLICATE_KEYS"),
    ("string", "CARDINALITY_TYPE REASON"),
    ("timestamp", "CREATED_AT"),
)

VALUE_INDEX = T.StructType(
    [
        T.StructField("TARGET_TABLE", T.StringType()),
        T.StructField("TABLE_VERSION", T.StringType()),
        T.StructField("FOLDERS", T.ArrayType(T.StringType())),
        T.StructField("BUCKETS", T.IntegerType()),
        T.StructField(
            "COLUMNS",
            T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("NAME", "DATA_TYPE", "TEXT_LO", "TEXT_HI")])),
        ),
        T.StructField("COMMITTED_AT", T.TimestampType()),
    ]
)

EDGE_KEY = ["FROM_TABLE", "FROM_COLUMN", "TO_TABLE", "TO_COLUMN"]

# Documents at the JSON edge.
MODEL_ENTITY = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("entity_name", "source_table", "view_name")]
    + [
        T.StructField(name, T.ArrayType(T.StringType()))
        for name in ("primary_keys", "business_keys", "unique_attributes")
    ]
)
MODEL_RELATIONSHIP = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("from_table", "from_column", "to_table", "to_column", "relationship_type", "confidence_label")
    ]
    + [T.StructField("match_rate", T.DoubleType())]
)
MODEL_DOCUMENT = T.StructType(
    [
        T.StructField("source_system", T.StringType()),
        T.StructField("generated_at", T.StringType()),
        T.StructField("entities", T.ArrayType(MODEL_ENTITY)),
        T.StructField("relationships", T.ArrayType(MODEL_RELATIONSHIP)),
    ]
)
CATALOG_RELATIONSHIP = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("from_table", "from_column", "to_table", "to_column", "confidence_label")
    ]
    + [T.StructField("match_rate", T.DoubleType())]
    + [
        T.StructField(name, T.StringType())
        for name in ("cardinality_type", "view_name", "skip_reason", "unsafe_flat_view_name")
    ]
)
CATALOG_DOCUMENT = T.StructType(
    [
        T.StructField("source_system", T.StringType()),
        T.StructField("generated_at", T.StringType()),
        T.StructField("entity_views", T.ArrayType(MODEL_ENTITY)),
    ]
    + [
        T.StructField(name, T.ArrayType(CATALOG_RELATIONSHIP))
        for name in ("safe_relationship_views", "bridge_views", "summary_views", "skipped_relationships")
    ]
)
