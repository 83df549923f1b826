import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions import rules
from tablescout.functions.names import Naming, clean_identifier, compatible_names
from tablescout.functions.types import spark_type, target_type
from tablescout.local import local_frame

NAME = T.StructType([T.StructField("n", T.StringType())])


def cleaned(spark, names):
    frame = local_frame(spark, [{"n": n} for n in names], NAME)
    return [r[0] for r in frame.select(clean_identifier(F.col("n"))).collect()]


def test_identifier_cleaning(spark):
    vectors = {
        "order": "ORDER_COL", "Job Number": "JOB_NUMBER", "2nd-Qty": "COL_2ND_QTY", "__a--b__": "A_B",
        "%%%": "UNNAMED_COL", "Timestamp": "TIMESTAMP_COL", "": "UNNAMED_COL", "straße": "STRASSE", "a_é_b": "A_B",
    }
    assert cleaned(spark, vectors) == list(vectors.values())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=30))
def test_identifier_cleaning_is_idempotent(spark, names):
    names = [n.encode("utf-8", "ignore").decode() for n in names]
    once = cleaned(spark, names)
    assert cleaned(spark, once) == once


def test_name_compatibility(spark):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("p", "c")])
    vectors = [
        ("ID", "CUSTOMER_ID", True), ("ORDER_ID", "ORDERNUMBER", True), ("JOB_CODE", "JOB_KEY", True),
        ("VALIDITY_ID", "VALITY_KEY", True), ("ID", "NUMBER", False), ("CUSTOMER_ID", "NATION_ID", False),
        ("customer_id", "CUSTOMER_ID", True),
    ]
    frame = local_frame(spark, [{"p": p, "c": c} for p, c, _ in vectors], schema)
    assert [r[0] for r in frame.select(compatible_names(F.col("p"), F.col("c"))).collect()] == [v for *_, v in vectors]


SQLSERVER = [
    ("bigint", None, None, None, "NUMBER(38,0)"), ("TINYINT", None, None, None, "NUMBER(38,0)"),
    ("bit", None, None, None, "BOOLEAN"), ("decimal", None, 12, 2, "NUMBER(12,2)"),
    ("money", None, None, None, "NUMBER(38,4)"), ("numeric", None, 40, 6, "NUMBER(38,6)"),
    ("real", None, None, None, "FLOAT"), ("date", None, None, None, "DATE"),
    ("datetime2", None, None, None, "TIMESTAMP_NTZ"), ("datetimeoffset", None, None, None, "TIMESTAMP_TZ"),
    ("time", None, None, None, "TIME"), ("uniqueidentifier", None, None, None, "VARCHAR(36)"),
    ("varbinary", 10, None, None, "BINARY"), ("nvarchar", 50, None, None, "VARCHAR(50)"),
    ("nvarchar", -1, None, None, "VARCHAR"), ("text", 2147483647, None, None, "VARCHAR(16777216)"),
    ("xml", None, None, None, "VARCHAR"), ("geography", 5, None, None, "VARCHAR"),
]
REDSHIFT = [
    ("integer", None, None, None, "NUMBER(38,0)"), ("int", None, None, None, "VARCHAR"),
    ("numeric", None, 10, 0, "NUMBER(10,0)"), ("double precision", None, None, None, "FLOAT"),
    ("boolean", None, None, None, "BOOLEAN"), ("timestamp without time zone", None, None, None, "TIMESTAMP_NTZ"),
    ("timestamp", None, None, None, "TIMESTAMP_NTZ"), ("timestamp with time zone", None, None, None, "TIMESTAMP_TZ"),
    ("character varying", 256, None, None, "VARCHAR(256)"), ("text", None, None, None, "VARCHAR"),
    ("time", None, None, None, "VARCHAR"), ("super", None, None, None, "VARCHAR"),
]


@pytest.mark.parametrize(("dialect", "vectors"), [("sqlserver", SQLSERVER), ("redshift", REDSHIFT)])
def test_target_types(spark, dialect, vectors):
    schema = "t string, len long, p long, s long"
    frame = spark.createDataFrame([v[:4] for v in vectors], schema)
    mapped = frame.select(target_type(dialect, *[F.col(c) for c in ("t", "len", "p", "s")])).collect()
    assert [r[0] for r in mapped] == [v[4] for v in vectors]


def test_spark_types():
    assert spark_type("NUMBER(38,0)", "bigint") == T.LongType()
    assert spark_type("NUMBER(38,0)", "numeric") == T.DecimalType(38, 0)
    assert spark_type("NUMBER(12,2)") == T.DecimalType(12, 2)
    assert spark_type("TIMESTAMP_NTZ") == T.TimestampNTZType()
    assert spark_type("TIMESTAMP_TZ") == T.TimestampType()
    assert spark_type("VARCHAR(36)") == spark_type("TIME") == T.StringType()


def test_key_scoring(spark):
    vectors = [
        ("ID", 100, 100, 100, "PRIMARY_KEY", 1.0), ("X_ID", 1000, 999, 999, "PRIMARY_KEY", 0.90),
        ("ID", 100, 100, 10, "FOREIGN_KEY", 0.70), ("CUSTOMERID", 100, 100, 10, "FOREIGN_KEY", 0.55),
        ("JOB_NUMBER", 100, 96, 50, "BUSINESS_KEY", 0.65), ("PO_NUMBER", 100, 90, 50, "BUSINESS_KEY", 0.55),
        ("CUSTOMER", 100, 100, 10, "BUSINESS_KEY", 0.65), ("EMAIL", 100, 100, 100, "UNIQUE_ATTRIBUTE", 0.70),
        ("STATUS_CODE", 100, 100, 10, None, None), ("CITY", 100, 100, 10, None, None), ("ID", 0, 0, 0, None, None),
    ]
    frame = spark.createDataFrame(
        [(n, r, d / r if r else 0.0, f / r if r else 0.0) for n, r, f, d, *_ in vectors],
        "n string, r long, d double, f double",
    )
    scored = frame.select(rules.key_candidate(*[F.col(c) for c in "nrdf"]).alias("k")).collect()
    for (_, _, _, _, kind, score), row in zip(vectors, scored, strict=True):
        assert row.k.CANDIDATE_TYPE == kind
        if kind:
            assert row.k.CONFIDENCE_SCORE == pytest.approx(score)
    assert scored[0].k.REASON == (
        "unique, non-null, and naming pattern indicates primary key; generic ID-style column; mostly non-null"
    )


def test_confidence_bands(spark):
    rates = [1.0, 0.98, 0.9799, 0.90, 0.8999, 0.70, 0.6999, 0.0]
    frame = spark.createDataFrame([(r,) for r in rates], "r double")
    found = frame.select(rules.confidence_label(F.col("r")), rules.confidence_score(F.col("r"))).collect()
    assert [tuple(r) for r in found] == [
        ("HIGH", 0.95), ("HIGH", 0.95), ("MEDIUM", 0.80), ("MEDIUM", 0.80), ("LOW", 0.60), ("LOW", 0.60),
        ("WEAK", 0.30), ("WEAK", 0.30),
    ]


def test_cardinality_and_decisions(spark):
    frame = spark.createDataFrame([(0, 0), (0, 3), (3, 0), (1, 1)], "p long, c long")
    kinds = [r[0] for r in frame.select(rules.cardinality_type(F.col("p"), F.col("c"))).collect()]
    assert kinds == ["1:1", "1:N", "N:1", "N:M"]

    cases = [
        ("LOW", "1:1", False, rules.LOW_CONFIDENCE, False), ("HIGH", "N:M", False, rules.NEEDS_BRIDGE, False),
        ("HIGH", "1:N", False, "1:N is not safe for flat view", True),
        ("MEDIUM", None, False, "UNKNOWN is not safe for flat view", True), ("HIGH", "1:1", True, rules.SAFE, True),
    ]
    frame = spark.createDataFrame([c[:2] for c in cases], "l string, k string")
    made = frame.select(
        rules.view_decision(F.col("l"), F.col("k"), "flat").alias("f"),
        rules.view_decision(F.col("l"), F.col("k"), "object").alias("o"),
    ).collect()
    assert [(r.f.generate, r.f.reason, r.o.generate) for r in made] == [c[2:] for c in cases]


def test_names(spark):
    naming = Naming(suffixes=("_TD",), prefixes=("SRC_",), ignored_parts=("REGIONAL_",))
    one = spark.range(1)

    def value(column):
        return one.select(column).head()[0]

    system = F.lit("TD_SQLSERVER")
    parent, child = F.lit("SRC_ORDERS_TD"), F.lit("LINEITEM_TD")
    assert value(naming.relationship_view(parent, child, system)) == "V_ORDERS_WITH_LINEITEM_TD"
    assert value(naming.bridge_view(parent, child, F.lit("order_id"), system)) == "V_BRIDGE_ORDERS_TO_LINEITEM_BY_ORDER_ID_TD"
    assert value(naming.summary_view(parent, child, F.lit("order_id"), system)) == "V_SUMMARY_ORDERS_TO_LINEITEM_BY_ORDER_ID_TD"
    assert naming.column_alias("LINEITEM_TD", "order_id") == "LINEITEM_ORDER_ID"
    assert value(naming.graph_entity(F.lit("X_ESTIMATE_LINE_TD"))) == "ESTIMATE"
    assert value(naming.model_entity(F.lit("X_ESTIMATE_LINE_TD"))) == "ESTIMATE_LINE"
    assert value(naming.model_entity(F.lit("ESTIMATE_REGIONAL_LINE"))) == "ESTIMATE_LINE"
    assert value(naming.model_entity(F.lit("src_plain_td"))) == "SRC_PLAIN"
    assert value(naming.view_entity(F.lit("src_plain_td"))) == "PLAIN"


def test_counts_and_status(spark):
    frame = spark.createDataFrame(
        [("full_refresh", 5, 5, 5), ("full_refresh", 5, 5, 4), ("timestamp", 9, 2, 7)], "s string, a long, b long, c long"
    )
    columns = [F.col(c) for c in "sabc"]
    found = frame.select(rules.counts_match(*columns), rules.counts_text(*columns)).collect()
    assert [tuple(r) for r in found] == [
        (True, "source=5; loaded=5; target=5"), (False, "source=5; loaded=5; target=4"),
        (True, "source_total=9; incremental_loaded=2; target_after_merge=7"),
    ]
