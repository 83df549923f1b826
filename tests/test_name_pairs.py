"""Pairs of column names: containment by an automaton, hub names spread."""

import random

import pytest
from pyspark.sql import functions as F

from tablescout.functions.names import compatible_names
from tablescout.operators.relate import PARENT_TYPES, _with_columns, candidate_pairs, contained_names

SCHEMA = "SOURCE_SYSTEM string, TARGET_TABLE string, TARGET_COLUMN string, CANDIDATE_TYPE string"


@pytest.mark.parametrize("name_bytes", [12, 1 << 24])
def test_contained_names(spark, name_bytes):
    names = ["ID", "ORDER_ID", "ORDER", "OR", "R", "ÜBER_ID", "X", "", "ID_ID"]
    found = sorted(map(tuple, contained_names(spark, [n for n in names if n], name_bytes).collect()))
    assert found == sorted((o, i) for o in names for i in names if i and i in o)


@pytest.mark.parametrize("hub", [2, 1000])
def test_pairs_equal_the_name_rule(spark, hub):
    random_ = random.Random(hub)
    parts = ["ID", "_ID", "ORDER", "order", "NUMBER", "_KEY", "CUSTOMER", "CODE", "A"]
    rows = [
        (f"S{k % 2}", f"T{k % 17}", "".join(random_.choices(parts, k=random_.randint(1, 3))), random_.choice([*PARENT_TYPES, "FOREIGN_KEY"]))
        for k in range(150)
    ] + [("S0", f"T{k}", "ID", "PRIMARY_KEY") for k in range(9)]
    frame = spark.createDataFrame(rows, SCHEMA)
    p, c = frame.alias("p"), frame.alias("c")
    rule = compatible_names(F.col("p.TARGET_COLUMN"), F.col("c.TARGET_COLUMN"))
    expected = p.join(c, F.col("p.SOURCE_SYSTEM") == F.col("c.SOURCE_SYSTEM")).where(
        (F.col("p.TARGET_TABLE") != F.col("c.TARGET_TABLE")) & rule
        & F.col("p.CANDIDATE_TYPE").isin(PARENT_TYPES) & F.col("c.CANDIDATE_TYPE").isin("BUSINESS_KEY", "FOREIGN_KEY")
    ).selectExpr("p.SOURCE_SYSTEM", "p.TARGET_TABLE", "p.TARGET_COLUMN", "c.TARGET_TABLE", "c.TARGET_COLUMN").distinct()
    assert sorted(map(tuple, candidate_pairs(frame, hub).collect())) == sorted(map(tuple, expected.collect()))


def test_a_hub_name_is_no_hot_key(spark):
    """200,000 columns, 50,000 of them named ..._ID: the columns of the hub end up in even shares."""
    columns = spark.range(200_000).select(
        F.lit("S").alias("SOURCE_SYSTEM"), F.concat(F.lit("T"), (F.col("id") % 5000).cast("string")).alias("TARGET_TABLE"),
        F.when(F.col("id") < 20, F.concat(F.lit("K"), F.col("id").cast("string"), F.lit("_ID")))
        .when(F.col("id") < 50_020, F.lit("K7_ID")).otherwise(F.concat(F.lit("VALUE_"), F.col("id").cast("string"))).alias("TARGET_COLUMN"),
        F.when(F.col("id") < 20, "PRIMARY_KEY").when(F.col("id") < 50_020, "FOREIGN_KEY").otherwise("UNIQUE_ATTRIBUTE").alias("CANDIDATE_TYPE"),
    )
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for key, value in zip(keep, ("16", "-1", "false"), strict=True):
            spark.conf.set(key, value)
        assert candidate_pairs(columns).count() == 4999  # of 5,000 tables all but T7 itself
        # the join that gives a name its columns: the largest share of a partition with and without salts
        hub = columns.where("TARGET_COLUMN = 'K7_ID'").select("TARGET_TABLE", F.col("TARGET_COLUMN").alias("CHILD_NAME"), F.col("CANDIDATE_TYPE").alias("TYPE"))
        pairs = spark.createDataFrame([("K7_ID", "K7_ID")], "PARENT_NAME string, CHILD_NAME string")
        largest = {}
        for salts in (1, 50):
            hubs = spark.createDataFrame([("K7_ID", salts)], "CHILD_NAME string, SALTS long")
            joined = _with_columns(pairs, hub, "CHILD_NAME", [], hubs).groupBy(F.spark_partition_id()).count()
            largest[salts] = joined.agg(F.max("count")).head()[0]
        assert largest[1] == 50_001 and largest[50] <= 3 * 50_001 / 16
    finally:
        for key, value in keep.items():
            spark.conf.set(key, value)
