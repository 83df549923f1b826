"""Semantic model, view decisions and the catalog of what is safe to join."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.functions.names import Naming
from tablescout.functions.rules import (
    LOW_CONFIDENCE,
    UNKNOWN_CARDINALITY,
    UNSAFE_FLAT,
    USABLE_LABELS,
    chain,
    link_views_allowed,
    view_decision,
)
from tablescout.operators.catalog import latest_cardinality
from tablescout.operators.views import Edge, bridge_view, entity_view, flat_view, object_view, summary_view
from tablescout.schemas import CATALOG_DOCUMENT, EDGE_KEY, MODEL_DOCUMENT

# The kinds of catalog assets.
ASSET_TYPES = [
    "entity_views", "safe_relationship_views", "bridge_views", "summary_views", "skipped_relationships",
]
KEY_LISTS = {"primary_keys": "PRIMARY_KEY", "business_keys": "BUSINESS_KEY", "unique_attributes": "UNIQUE_ATTRIBUTE"}

_RELATIONSHIP_FIELDS = [
    "from_table", "from_column", "to_table", "to_column", "confidence_label", "match_rate", "cardinality_type",
]


def key_lists(candidates: DataFrame) -> DataFrame:
    """Key columns per table and kind, best score first, then by name."""

    def ordered(kind: str) -> Column:
        entry = F.when(
            F.col("CANDIDATE_TYPE") == kind,
            F.struct((-F.col("CONFIDENCE_SCORE")).alias("rank"), F.col("TARGET_COLUMN").alias("name")),
        )
        return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["name"])

    return candidates.groupBy("TARGET_TABLE").agg(*[ordered(kind).alias(name) for name, kind in KEY_LISTS.items()])


def semantic_entities(
    entity_map: DataFrame, candidates: DataFrame, source_system: str, naming: Naming = Naming()
) -> DataFrame:
    """One entity per table of the entity map, with its key lists."""
    tables = (
        entity_map.where(F.col("SOURCE_SYSTEM") == source_system).select("TARGET_TABLE").dropna().distinct()
    )
    lists = key_lists(candidates.where(F.col("SOURCE_SYSTEM") == source_system))
    none = F.array().cast("array<string>")
    entity = naming.model_entity(F.col("TARGET_TABLE"))
    return (
        tables.join(lists, "TARGET_TABLE", "left")
        .select(
            entity.alias("entity_name"),
            F.col("TARGET_TABLE").alias("source_table"),
            naming.entity_view(entity, F.lit(source_system)).alias("view_name"),
            *[F.coalesce(name, none).alias(name) for name in KEY_LISTS],
        )
        .orderBy("source_table")
    )


def semantic_relationships(graph: DataFrame, source_system: str) -> DataFrame:
    return graph.where(F.col("SOURCE_SYSTEM") == source_system).select(
        *[F.col(n).alias(n.lower()) for n in (*EDGE_KEY, "RELATIONSHIP_TYPE", "CONFIDENCE_LABEL", "MATCH_RATE")]
    )


def with_cardinality(relationships: DataFrame, cardinality: DataFrame) -> DataFrame:
    """Model relationships with the class of their latest check (NULL when never checked)."""
    classes = latest_cardinality(cardinality).select(
        *[F.col(n).alias(n.lower()) for n in EDGE_KEY], F.col("CARDINALITY_TYPE").alias("cardinality_type")
    )
    return relationships.join(classes, [n.lower() for n in EDGE_KEY], "left")


def view_decisions(classified: DataFrame, source_system: str, naming: Naming = Naming()) -> DataFrame:
    """For every relationship: whether flat, object and bridge / summary views are made, and why not."""
    system = F.lit(source_system)
    sides = (F.col("from_table"), F.col("to_table"))
    label, kind = F.col("confidence_label"), F.col("cardinality_type")
    link = (*sides, F.col("from_column"), system)
    decided = classified.withColumns({f"_{mode}": view_decision(label, kind, mode) for mode in ("flat", "object")})
    return decided.select(
        *classified.columns,
        *[
            F.col(f"_{mode}.{field}").alias(f"{mode}_{field}")
            for mode in ("flat", "object")
            for field in ("generate", "reason")
        ],
        link_views_allowed(label, kind).alias("link_generate"),
        naming.relationship_view(*sides, system).alias("relationship_view_name"),
        naming.bridge_view(*link).alias("bridge_view_name"),
        naming.summary_view(*link).alias("summary_view_name"),
    )


def decision_counts(decisions: DataFrame) -> DataFrame:
    """Generated and skipped views per mode; a bridge decision makes two views."""
    return (
        decisions.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(mode).alias("mode"), F.col(f"{mode}_generate").alias("generate"),
                            F.lit(views).alias("views"),
                        )
                        for mode, views in (("flat", 1), ("object", 1), ("link", 2))
                    ]
                )
            )
        )
        .groupBy("mode")
        .agg(
            F.sum(F.when(F.col("generate"), F.col("views")).otherwise(0)).alias("generated"),
            F.count_if(~F.col("generate")).alias("skipped"),
        )
    )


def catalog_assets(
    entities: DataFrame, classified: DataFrame, source_system: str, naming: Naming = Naming()
) -> DataFrame:
    """Every catalog asset as a row: entities, safe joins, bridges, summaries and skipped joins.

    ``name_collision`` marks view names that more than one generated asset would take.
    """
    system = F.lit(source_system)
    sides = (F.col("from_table"), F.col("to_table"))
    kind = F.coalesce("cardinality_type", F.lit("UNKNOWN"))
    low = ~F.coalesce(F.col("confidence_label").isin(USABLE_LABELS), F.lit(False))
    joined_name = naming.relationship_view(*sides, system)
    nothing = F.lit(None).cast("string")

    def asset(name: str, condition: Column, view: Column = nothing, reason: Column = nothing,
              unsafe: Column = nothing) -> Column:
        return F.when(
            condition,
            F.struct(
                F.lit(name).alias("asset_type"), view.alias("view_name"), reason.alias("skip_reason"),
                unsafe.alias("unsafe_flat_view_name"),
            ),
        )

    linked = ~low & kind.isin("1:N", "N:1", "N:M")
    link = (*sides, F.col("from_column"), system)
    skip_reason = chain([(low, LOW_CONFIDENCE), (kind == "N:M", UNSAFE_FLAT)], UNKNOWN_CARDINALITY)
    skipped = low | (kind == "N:M") | ~kind.isin("1:1", "1:N", "N:1")
    assets = F.array(
        asset("safe_relationship_views", ~low & (kind == "1:1"), joined_name),
        asset("bridge_views", linked, naming.bridge_view(*link)),
        asset("summary_views", linked, naming.summary_view(*link)),
        asset("skipped_relationships", skipped, reason=skip_reason, unsafe=F.when(~low & (kind == "N:M"), joined_name)),
    )
    related = classified.withColumn("cardinality_type", kind).select(
        *_RELATIONSHIP_FIELDS, F.inline(F.filter(assets, lambda a: a.isNotNull()))
    )
    whole = entities.withColumn("asset_type", F.lit("entity_views")).unionByName(related, allowMissingColumns=True)
    # View names are counted by an aggregate joined back, not over a window.
    clashes = (
        whole.where("view_name is not null").groupBy("view_name").count().where("count > 1").select("view_name")
        .withColumn("_clash", F.lit(True))
    )
    return whole.join(clashes, "view_name", "left").select(
        "asset_type",
        *[c for c in whole.columns if c != "asset_type"],
        F.coalesce("_clash", F.lit(False)).alias("name_collision"),
    )


def asset_counts(assets: DataFrame) -> DataFrame:
    """Number of assets of every type, zeros included."""
    counters = [F.count_if(F.col("asset_type") == name).alias(name) for name in ASSET_TYPES]
    return assets.agg(*counters).unpivot([], ASSET_TYPES, "asset_type", "assets")


def model_document(entities: DataFrame, relationships: DataFrame, source_system: str) -> DataFrame:
    """The semantic model as one nested row, ready for ``write.json``."""
    entity_fields = MODEL_DOCUMENT["entities"].dataType
    edge_fields = MODEL_DOCUMENT["relationships"].dataType
    rows = entities.select(F.struct(*entity_fields.elementType.names).alias("entity")).unionByName(
        relationships.select(F.struct(*edge_fields.elementType.names).alias("edge")), allowMissingColumns=True
    )
    return rows.agg(
        F.sort_array(F.collect_list("entity")).alias("entities"),
        F.sort_array(F.collect_list("edge")).alias("relationships"),
    ).select(
        F.lit(source_system).alias("source_system"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at"),
        "entities",
        "relationships",
    )


def catalog_document(assets: DataFrame, source_system: str) -> DataFrame:
    """The semantic catalog as one nested row."""
    lists = []
    for name in ASSET_TYPES:
        fields = CATALOG_DOCUMENT[name].dataType.elementType.names
        lists.append(
            F.sort_array(F.collect_list(F.when(F.col("asset_type") == name, F.struct(*fields)))).alias(name)
        )
    return assets.agg(*lists).select(
        F.lit(source_system).alias("source_system"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at"),
        *ASSET_TYPES,
    )


def read_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_DOCUMENT).option("multiLine", True).json(path)


def model_entities(document: DataFrame) -> DataFrame:
    return document.select(F.inline("entities"))


def model_relationships(document: DataFrame) -> DataFrame:
    return document.select(F.inline("relationships"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOG_DOCUMENT).option("multiLine", True).json(path)


def document_assets(document: DataFrame, relationships_only: bool = False) -> DataFrame:
    """Rows of a catalog document with their asset type; optionally only the relationship lists."""
    names = ASSET_TYPES[1:] if relationships_only else ASSET_TYPES
    parts = [document.select(F.lit(name).alias("asset_type"), F.inline(name)) for name in names]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def build_view(frames: Mapping[str, DataFrame], asset: Mapping, mode: str = "flat", naming: Naming = Naming()) -> DataFrame:
    """The DataFrame behind a catalog asset row."""
    kind = asset["asset_type"]
    if kind == "entity_views":
        return entity_view(frames[asset["source_table"]], asset["entity_name"], asset["source_table"])
    edge = Edge(
        asset["from_table"], asset["from_column"], asset["to_table"], asset["to_column"], asset["cardinality_type"]
    )
    parent, child = frames[edge.from_table], frames[edge.to_table]
    if kind == "safe_relationship_views":
        return flat_view(parent, child, edge, naming) if mode == "flat" else object_view(parent, child, edge)
    if kind == "bridge_views":
        return bridge_view(parent, child, edge)
    if kind == "summary_views":
        return summary_view(parent, child, edge)
    raise ValueError(f"no view is built for {kind}")


def decided_views(
    frames: Mapping[str, DataFrame], decisions: Iterable[Mapping], mode: str = "flat", naming: Naming = Naming()
) -> list[tuple[str, str, DataFrame]]:
    """(view name, kind, rows) of the views that decision rows of ``view_decisions`` name.

    The mode says whether joined views are flat or carry the child row as a record; each has its own
    decision.  Bridge and summary views are made where ``link_generate`` says so.
    """
    if mode not in ("flat", "object"):
        raise ValueError(f"unknown view mode: {mode}")
    views = []
    for row in decisions:
        edge = Edge(row["from_table"], row["from_column"], row["to_table"], row["to_column"], row["cardinality_type"])
        parent, child = frames[edge.from_table], frames[edge.to_table]
        if row[f"{mode}_generate"]:
            joined = flat_view(parent, child, edge, naming) if mode == "flat" else object_view(parent, child, edge)
            views.append((row["relationship_view_name"], mode, joined))
        if row["link_generate"]:
            views.append((row["bridge_view_name"], "bridge", bridge_view(parent, child, edge)))
            views.append((row["summary_view_name"], "summary", summary_view(parent, child, edge)))
    return views


def register_views(frames: Mapping[str, DataFrame], entities: Iterable[Mapping], decisions: Iterable[Mapping],
                   mode: str = "flat", naming: Naming = Naming()) -> list[str]:
    """Temp views of entities and of what the decisions name, later ones replacing earlier of the same name."""
    views = [
        (e["view_name"], entity_view(frames[e["source_table"]], e["entity_name"], e["source_table"])) for e in entities
    ]
    views += [(name, rows) for name, _, rows in decided_views(frames, decisions, mode, naming)]
    for name, rows in views:
        rows.createOrReplaceTempView(name)
    return [name for name, _ in views]
