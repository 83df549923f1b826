import tempfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablescout.functions.names import Naming
from tablescout.operators.graph import entity_map, relationship_graph, usable_relationships
from tablescout.operators.relate import value_overlap
from tablescout.plans.discover import Place, discover, find_relationships, store_profiles
from tablescout.plans.semantic import (
    asset_counts,
    catalog_assets,
    catalog_document,
    document_assets,
    model_document,
    model_entities,
    model_relationships,
    read_catalog,
    read_model,
    register_views,
    view_decisions,
    semantic_entities,
    semantic_relationships,
    with_cardinality,
)
from tablescout.plans.store import TableStore
from workload import runs
from workload.discovery import INJECTED
from workload.tables import renamed_views

NAMING = Naming(suffixes=("_TD",))
SYSTEM = "TD_SQLSERVER"
CANDIDATE = (
    "RELATIONSHIP_RUN_ID string, SOURCE_SYSTEM string, PARENT_TABLE string, PARENT_COLUMN string, CHILD_TABLE string, "
    "CHILD_COLUMN string, CONFIDENCE_LABEL string, MATCH_RATE double, CREATED_AT string"
)


@pytest.fixture(scope="module")
def worked_example(spark):
    """Four entities and three many-to-many relationships, as a repeated discovery would store them."""
    edges = [
        ("ESTIMATE_TD", "ESTIMATE_NUMBER", "REGIONAL_ESTIMATE_LINE_TD", "ESTIMATE_NUMBER", "HIGH", 1.0),
        ("ORDER_TD", "ESTIMATE_NUMBER", "INVOICE_TD", "ESTIMATE_NUMBER", "HIGH", 0.9965),
        ("ORDER_TD", "PO_NUMBER", "INVOICE_TD", "PO_NUMBER", "MEDIUM", 0.9569),
        ("ORDER_TD", "PO_NUMBER", "ESTIMATE_TD", "PO_NUMBER", "LOW", 0.75),
    ]
    runs = [("r1", "2024-01-01"), ("r2", "2024-01-02")]
    return spark.createDataFrame([(r, SYSTEM, *e, at) for r, at in runs for e in edges], CANDIDATE)


def test_usable_relationships_of_latest_run(worked_example):
    usable = usable_relationships(worked_example)
    assert usable.count() == 3 and usable.select("RELATIONSHIP_RUN_ID").distinct().collect() == [("r2",)]
    members = {(r.TARGET_TABLE, r.ENTITY_ROLE): (r.ENTITY_NAME, r.CONFIDENCE_LABEL) for r in entity_map(usable, NAMING).collect()}
    assert members["INVOICE_TD", "CHILD"] == ("INVOICE", "HIGH")
    assert len(members) == 4


def test_worked_example_catalog(spark, worked_example):
    usable = usable_relationships(worked_example)
    graph = relationship_graph(usable)
    keys = spark.createDataFrame(
        [
            (SYSTEM, "ESTIMATE_TD", "ESTIMATE_NUMBER", "PRIMARY_KEY", 0.9),
            (SYSTEM, "ORDER_TD", "PO_NUMBER", "BUSINESS_KEY", 0.65),
            (SYSTEM, "ORDER_TD", "ESTIMATE_NUMBER", "BUSINESS_KEY", 0.65),
            (SYSTEM, "ORDER_TD", "JOB_NUMBER", "BUSINESS_KEY", 0.7),
            ("OTHER", "ORDER_TD", "X", "BUSINESS_KEY", 0.9),
        ],
        "SOURCE_SYSTEM string, TARGET_TABLE string, TARGET_COLUMN string, CANDIDATE_TYPE string, CONFIDENCE_SCORE double",
    )
    entities = semantic_entities(entity_map(usable, NAMING), keys, SYSTEM, NAMING)
    found = {r.source_table: r for r in entities.collect()}
    assert found["ORDER_TD"].business_keys == ["JOB_NUMBER", "ESTIMATE_NUMBER", "PO_NUMBER"]
    assert found["REGIONAL_ESTIMATE_LINE_TD"].entity_name == "ESTIMATE_LINE"
    assert found["INVOICE_TD"].primary_keys == [] and found["ESTIMATE_TD"].view_name == "V_ESTIMATE_TD"

    stamped = graph.withColumns({"CARDINALITY_RUN_ID": F.lit("c1"), "CREATED_AT": F.lit("2024"), "CARDINALITY_TYPE": F.lit("1:1")})
    checks = stamped.unionByName(
        stamped.withColumns({"CARDINALITY_RUN_ID": F.lit("c2"), "CREATED_AT": F.lit("2025"), "CARDINALITY_TYPE": F.lit("N:M")})
    )
    classified = with_cardinality(semantic_relationships(graph, SYSTEM), checks)
    assets = catalog_assets(entities, classified, SYSTEM, NAMING)
    expected = {
        "entity_views": 4, "safe_relationship_views": 0, "bridge_views": 3, "summary_views": 3, "skipped_relationships": 3,
    }
    assert dict(asset_counts(assets).collect()) == expected
    names = {r.view_name for r in assets.where("asset_type = 'bridge_views'").collect()}
    assert "V_BRIDGE_ORDER_TO_INVOICE_BY_PO_NUMBER_TD" in names
    unsafe = assets.where("skip_reason like 'N:M%'").select("unsafe_flat_view_name")
    assert rows(unsafe.distinct()) == [("V_ESTIMATE_WITH_REGIONAL_ESTIMATE_LINE_TD",), ("V_ORDER_WITH_INVOICE_TD",)]

    path = tempfile.mkdtemp(prefix="tablescout-")
    model_document(entities, semantic_relationships(graph, SYSTEM), SYSTEM).coalesce(1).write.json(f"{path}/model")
    model = read_model(spark, f"{path}/model")
    assert rows(model_entities(model)) == rows(entities.select(model_entities(model).columns))
    assert model_relationships(model).count() == 3 and model.head().source_system == SYSTEM
    catalog_document(assets, SYSTEM).coalesce(1).write.json(f"{path}/catalog")
    document = read_catalog(spark, f"{path}/catalog")
    assert dict(asset_counts(document_assets(document)).collect()) == expected
    bag = document_assets(document, relationships_only=True)
    assert bag.count() == 9 and "unsafe_flat_view_name" in bag.columns


def test_classes_lead_to_assets(spark):
    edges = [(f"A{i}_TD", "ID", f"B{i}_TD", "A_ID", "PARENT_CHILD", label, 1.0, kind) for i, (label, kind) in enumerate(
        [("HIGH", "1:1"), ("HIGH", "1:N"), ("HIGH", "N:1"), ("HIGH", "N:M"), ("HIGH", None), ("LOW", "1:1"), (None, "1:1")]
    )]
    classified = spark.createDataFrame(
        edges, "from_table string, from_column string, to_table string, to_column string, relationship_type string, "
        "confidence_label string, match_rate double, cardinality_type string",
    )
    none = spark.createDataFrame(
        [], "entity_name string, source_table string, view_name string, primary_keys array<string>, "
        "business_keys array<string>, unique_attributes array<string>",
    )
    assets = catalog_assets(none, classified, SYSTEM, NAMING)
    found = {}
    for row in assets.collect():
        found.setdefault(row.from_table[1], []).append(row.asset_type.split("_")[0])
    assert {k: sorted(v) for k, v in found.items()} == {
        "0": ["safe"], "1": ["bridge", "summary"], "2": ["bridge", "summary"], "3": ["bridge", "skipped", "summary"],
        "4": ["skipped"], "5": ["skipped"], "6": ["skipped"],
    }
    reasons = {r.from_table[1]: r.skip_reason for r in assets.where("skip_reason is not null").collect()}
    assert reasons["4"] == "unknown cardinality" and reasons["5"].startswith("confidence below")


def test_discovery_stores_every_step(spark, sf_dir):
    frames = {k: v for k, v in renamed_views(spark, sf_dir).items() if k in ("REGION_TD", "NATION_TD", "CUSTOMER_TD", "ORDERS_TD")}
    store = TableStore(spark, tempfile.mkdtemp(prefix="tablescout-"))
    discover(spark, frames, Place(SYSTEM), store, NAMING)
    assert store.read("COLUMN_PROFILE").count() == 16
    graph = store.read("RELATIONSHIP_GRAPH")
    direct = find_relationships(spark, frames, Place(SYSTEM))
    expected = rows(direct.where("CONFIDENCE_LABEL in ('HIGH', 'MEDIUM')").select("PARENT_TABLE", "CHILD_TABLE"))
    assert rows(graph.select("FROM_TABLE", "TO_TABLE")) == expected
    cards = store.read("RELATIONSHIP_CARDINALITY")
    assert cards.select("CARDINALITY_TYPE").distinct().collect() == [("1:N",)]

    entities = semantic_entities(store.read("ENTITY_MAP"), store.read("KEY_CANDIDATES"), SYSTEM, NAMING)
    classified = with_cardinality(semantic_relationships(graph, SYSTEM), cards)
    decisions = view_decisions(classified, SYSTEM, NAMING).collect()
    names = register_views(frames, entities.collect(), decisions, "object", NAMING)
    joined = spark.table("V_CUSTOMER_WITH_ORDERS_TD")
    assert "V_CUSTOMER_TD" in names and joined.where("_SEMANTIC_CHILD_RECORD.ORDER_ID is not null").count() == frames["ORDERS_TD"].count()
    assert not [name for name in names if "SUMMARY" in name or "BRIDGE" in name]
    flat = register_views(frames, [], decisions, "flat", NAMING)
    assert flat == [d.relationship_view_name for d in decisions if d.flat_generate]
    assert spark.table("V_CUSTOMER_TD").select("_SEMANTIC_ENTITY_NAME").distinct().collect() == [("CUSTOMER",)]


def test_unreadable_tables_and_columns_are_skipped(spark):
    good = spark.createDataFrame([(1, "a")], "A_ID int, NAME string")
    bad = spark.createDataFrame([("x",)], "T string").select(F.col("T").cast("int").alias("B_ID"))
    store = TableStore(spark, tempfile.mkdtemp(prefix="tablescout-"))
    with pytest.warns(UserWarning, match="BAD could not be profiled"):
        store_profiles(spark, {"GOOD": good, "BAD": bad}, Place(SYSTEM), store, "run")
    assert rows(store.read("COLUMN_PROFILE").select("TARGET_COLUMN")) == [("A_ID",), ("NAME",)]

    pairs = spark.createDataFrame(
        [("GOOD", "A_ID", "GOOD", "NAME"), ("GOOD", "A_ID", "GONE", "X"), ("GOOD", "GONE", "GOOD", "NAME")],
        "PARENT_TABLE string, PARENT_COLUMN string, CHILD_TABLE string, CHILD_COLUMN string",
    )
    with pytest.warns(UserWarning, match="not readable"):
        assert value_overlap(spark, {"GOOD": good}, pairs).count() == 1


def test_stored_documents_find_their_edges_once(spark, sf_dir, monkeypatch):
    seen, real = spark.sparkContext.accumulator(0), runs.classified_edges

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def edges(spark, sf_dir):
        found = real(spark, sf_dir)
        return found.mapInArrow(counted, found.schema)

    monkeypatch.setattr(runs, "classified_edges", edges)
    assert runs.stored_documents(spark, sf_dir).count() > 0
    assert 0 < seen.value <= len(INJECTED)
