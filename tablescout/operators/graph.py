"""Usable relationships as a directed graph, and the tables taking part in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.functions.names import Naming
from tablescout.functions.rules import USABLE_LABELS, label_rank

# Fixed value.
EDGE_TYPE = "PARENT_CHILD"


def usable_relationships(candidates: DataFrame) -> DataFrame:
    """HIGH and MEDIUM relationships of the newest discovery run of each system."""
    newest = (
        candidates.groupBy("SOURCE_SYSTEM")
        .agg(F.max(F.struct("CREATED_AT", "RELATIONSHIP_RUN_ID")).alias("R"))
        .select("SOURCE_SYSTEM", "R.RELATIONSHIP_RUN_ID")
    )
    return candidates.join(newest, ["SOURCE_SYSTEM", "RELATIONSHIP_RUN_ID"], "left_semi").where(
        F.col("CONFIDENCE_LABEL").isin(USABLE_LABELS)
    )


def relationship_graph(relationships: DataFrame) -> DataFrame:
    return relationships.select(
        "SOURCE_SYSTEM",
        F.col("PARENT_TABLE").alias("FROM_TABLE"),
        F.col("PARENT_COLUMN").alias("FROM_COLUMN"),
        F.col("CHILD_TABLE").alias("TO_TABLE"),
        F.col("CHILD_COLUMN").alias("TO_COLUMN"),
        F.lit(EDGE_TYPE).alias("RELATIONSHIP_TYPE"),
        "CONFIDENCE_LABEL",
        "MATCH_RATE",
    )


def entity_map(relationships: DataFrame, naming: Naming = Naming()) -> DataFrame:
    """Each table once per role, with the best label of its relationships."""
    roles = relationships.select(
        "SOURCE_SYSTEM",
        "CONFIDENCE_LABEL",
        F.inline(
            F.array(
                *[
                    F.struct(F.col(f"{role}_TABLE").alias("TARGET_TABLE"), F.lit(role).alias("ENTITY_ROLE"))
                    for role in ("PARENT", "CHILD")
                ]
            )
        ),
    )
    best = roles.groupBy("SOURCE_SYSTEM", "TARGET_TABLE", "ENTITY_ROLE").agg(
        F.min_by("CONFIDENCE_LABEL", label_rank(F.col("CONFIDENCE_LABEL"))).alias("CONFIDENCE_LABEL")
    )
    return best.select(
        naming.graph_entity(F.col("TARGET_TABLE")).alias("ENTITY_NAME"),
        "SOURCE_SYSTEM",
        "TARGET_TABLE",
        "ENTITY_ROLE",
        "CONFIDENCE_LABEL",
    )
