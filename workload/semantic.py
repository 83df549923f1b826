"""Queries for entity and relationship views, the semantic model and the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.functions.names import Naming
from tablescout.operators.graph import entity_map, relationship_graph, usable_relationships
from tablescout.operators.relate import candidate_pairs, value_overlap
from tablescout.operators.views import Edge, bridge_view, entity_view, flat_view, object_view, summary_view
from tablescout.plans.discover import held
from tablescout.plans.semantic import (
    KEY_LISTS,
    asset_counts,
    catalog_assets,
    catalog_document,
    decision_counts,
    document_assets,
    model_document,
    model_entities,
    model_relationships,
    semantic_entities,
    semantic_relationships,
    view_decisions,
    with_cardinality,
)
from workload import sql
from workload.discovery import (
    INJECTED_CARDINALITY,
    INJECTED_FRAMES,
    INJECTED_OVERLAP,
    NAMING,
    injected_cardinality,
    injected_overlap,
    td_candidates,
)
from workload.ingest import DOC_REVIEW
from workload.tables import SYSTEM, TABLES, renamed_view, renamed_views, shown, table

# Views


def entity_rows(spark, sf_dir) -> DataFrame:
    return entity_view(renamed_view(spark, sf_dir, "ORDERS_TD"), "ORDER", "ORDERS_TD")


def _view(build, parent: str, parent_column: str, child: str, child_column: str, kind: str | None, *args):
    def query(spark, sf_dir) -> DataFrame:
        sides = [
            INJECTED_FRAMES[name](spark, sf_dir) if name in INJECTED_FRAMES else renamed_view(spark, sf_dir, name)
            for name in (parent, child)
        ]
        return build(*sides, Edge(parent, parent_column, child, child_column, kind), *args)

    return query


def _opened(query):
    """Child record fields as columns, so rows compare without nested values."""

    def opened(spark, sf_dir) -> DataFrame:
        rows = query(spark, sf_dir)
        fields = rows.schema["_SEMANTIC_CHILD_RECORD"].dataType.names
        return rows.select(
            *[c for c in rows.columns if c != "_SEMANTIC_CHILD_RECORD"],
            *[F.col("_SEMANTIC_CHILD_RECORD")[name].alias(f"CHILD_{name}") for name in fields],
        )

    return opened


VIEW_EDGES = {
    # One to one, and parents whose key is NULL.
    "flat_view": ("documents", "doc_id", "doc_review", "DOC_ID", "1:1"),
    "flat_view_null_keys": ("doc_review", "DOC_ID", "documents", "doc_id", "1:1"),
    # A small parent with many children; many line items to one order; unknown class.
    "object_view": ("NATION_TD", "NATION_ID", "CUSTOMER_TD", "NATION_ID", "1:N"),
    "object_view_many_to_one": ("LINEITEM_TD", "ORDER_ID", "ORDERS_TD", "ORDER_ID", "N:1"),
    "object_view_unknown": ("orders", "o_orderkey", "lineitem", "l_orderkey", None),
    "bridge_view": ("events", "user_id", "conversations", "conv_id", "N:M"),
    "bridge_view_trimmed": ("pages", "url", "page_links", "link", "N:M"),
    "summary_view": ("events", "user_id", "conversations", "conv_id", "N:M"),
    # Seven keys a side: the row-level join would have 171,838,812 rows at sf0.01.
    "summary_view_hot_keys": ("lineitem", "l_linenumber", "line_r", "l_linenumber", "N:M"),
}
BUILDERS = {"flat": flat_view, "object": object_view, "bridge": bridge_view, "summary": summary_view}


# Whole-number columns of left joins that are NULL in some rows.
MAYBE_NULL = {
    "flat_view": ["REVIEW_ID", "DOC_REVIEW_DOC_ID", "quality"],
    "flat_view_null_keys": ["DOC_ID", "quality", "DOCUMENTS_DOC_ID", "n_chars"],
    "object_view_unknown": ["CHILD_l_orderkey", "CHILD_l_partkey", "CHILD_l_suppkey", "CHILD_l_linenumber"],
}


def _shown(query, columns: list[str]):
    return lambda spark, sf_dir: shown(query(spark, sf_dir), *columns)


def _view_queries() -> dict:
    made = {}
    for name, edge in VIEW_EDGES.items():
        kind = name.split("_")[0]
        query = _view(BUILDERS[kind], *edge, *((NAMING,) if kind == "flat" else ()))
        query = _opened(query) if kind == "object" else query
        made[name] = _shown(query, MAYBE_NULL[name]) if name in MAYBE_NULL else query
    return made


RELATIONS = {
    "doc_review": DOC_REVIEW,
    "line_r": "(SELECT * FROM lineitem WHERE l_returnflag = 'R')",
    "page_links": "(SELECT ' ' || url || ' ' AS link FROM pages)",
}


def _renamed(view: str) -> str:
    columns = ", ".join(f'{old} AS "{new}"' for v, new, _, old, _ in sql.renamed_columns() if v == view)
    source = next(s for v, _, s, _, _ in sql.renamed_columns() if v == view)
    return f"(SELECT {columns} FROM {source})"


def _relation(name: str) -> str:
    return RELATIONS.get(name) or (_renamed(name) if name.endswith("_TD") else name)


def _labels(parent, parent_column, child, child_column) -> str:
    return (
        f"'{parent}' AS \"_SEMANTIC_PARENT_TABLE\", '{child}' AS \"_SEMANTIC_CHILD_TABLE\", "
        f"'{parent_column}' AS \"_SEMANTIC_PARENT_COLUMN\", '{child_column}' AS \"_SEMANTIC_CHILD_COLUMN\""
    )


def _join_oracle(name: str, select: str) -> str:
    """The row-level join the view stands for."""
    parent, parent_column, child, child_column, kind = VIEW_EDGES[name]
    left, right = sql.key(f'p."{parent_column}"'), sql.key(f'c."{child_column}"')
    outer = "LEFT JOIN" if kind != "N:M" else "JOIN"
    select = select.format(left=left, right=right, kind=kind)
    tail = " GROUP BY 1" if "count(*)" in select else ""
    return (
        f"SELECT {select}, {_labels(parent, parent_column, child, child_column)} "
        f"FROM {_relation(parent)} p {outer} {_relation(child)} c ON {left} = {right}{tail}"
    )


FLAT_DOCUMENTS = (
    'p.doc_id, p.text, p.lang, p.source, p.n_chars, c."REVIEW_ID", c."DOC_ID" AS "DOC_REVIEW_DOC_ID", '
    'c.lang AS "DOC_REVIEW_LANG", c.quality'
)
FLAT_REVIEWS = (
    'p."REVIEW_ID", p."DOC_ID", p.lang, p.quality, c.doc_id AS "DOCUMENTS_DOC_ID", c.text, '
    'c.lang AS "DOCUMENTS_LANG", c.source, c.n_chars'
)


def _object_columns(parent: str, child: str) -> str:
    def names(table_name: str) -> list[str]:
        if table_name.endswith("_TD"):
            return [new for v, new, _, _, _ in sql.renamed_columns() if v == table_name]
        return TABLES[table_name]

    return ", ".join(
        [f'p."{n}"' for n in names(parent)] + [f'c."{n}" AS "CHILD_{n}"' for n in names(child)]
    )


_BRIDGE = (
    'DISTINCT {left} AS "PARENT_KEY_VALUE", {right} AS "CHILD_KEY_VALUE", \'{kind}\' AS "_SEMANTIC_CARDINALITY_TYPE"'
)
_SUMMARY = (
    '{left} AS "PARENT_KEY_VALUE", count(*) AS "JOINED_ROW_COUNT", count(DISTINCT {right}) AS '
    '"DISTINCT_CHILD_KEY_COUNT", \'{kind}\' AS "_SEMANTIC_CARDINALITY_TYPE"'
)


def _view_oracles() -> dict:
    selects = {"flat_view": FLAT_DOCUMENTS, "flat_view_null_keys": FLAT_REVIEWS}
    for name, edge in VIEW_EDGES.items():
        if name.startswith("object"):
            selects[name] = _object_columns(edge[0], edge[2])
        elif name.startswith("bridge"):
            selects[name] = _BRIDGE
        elif name.startswith("summary"):
            selects[name] = _SUMMARY
    made = {name: _join_oracle(name, select) for name, select in selects.items()}
    made |= {name: sql.shown(made[name], *columns) for name, columns in MAYBE_NULL.items()}
    # The same row-level join, on the integers themselves: text keys take DuckDB far longer.
    for column in ("p", "c"):
        made["summary_view_hot_keys"] = made["summary_view_hot_keys"].replace(
            sql.key(f'{column}."l_linenumber"'), f"{column}.l_linenumber"
        )
    made["summary_view_hot_keys"] = (
        f"SELECT * REPLACE (cast(\"PARENT_KEY_VALUE\" AS VARCHAR) AS \"PARENT_KEY_VALUE\") "
        f"FROM ({made['summary_view_hot_keys']})"
    )
    return made


# Model and catalog


def _joined_lists(frame: DataFrame) -> DataFrame:
    return frame.withColumns({name: F.array_join(name, ",") for name in KEY_LISTS})


def td_graph(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Key candidates and graph of the renamed views, each found once."""
    candidates = held(td_candidates(spark, sf_dir))
    overlap = value_overlap(spark, renamed_views(spark, sf_dir), candidate_pairs(candidates))
    stamped = held(overlap).withColumns(
        {"RELATIONSHIP_RUN_ID": F.lit("run-1"), "CREATED_AT": F.lit("2024-01-01").cast("timestamp")}
    )
    return candidates, usable_relationships(stamped)


def td_entities(spark, sf_dir) -> DataFrame:
    candidates, usable = td_graph(spark, sf_dir)
    return semantic_entities(entity_map(usable, NAMING), candidates, SYSTEM, NAMING)


def entity_list(spark, sf_dir) -> DataFrame:
    return _joined_lists(td_entities(spark, sf_dir))


def classified_edges(spark, sf_dir) -> DataFrame:
    """Injected edges of all labels with their class; url edges are left without a check (unknown)."""
    graph = relationship_graph(injected_overlap(spark, sf_dir).withColumn("SOURCE_SYSTEM", F.lit(SYSTEM)))
    checked = injected_cardinality(spark, sf_dir).withColumns(
        {
            "SOURCE_SYSTEM": F.lit(SYSTEM), "CARDINALITY_RUN_ID": F.lit("run-1"),
            "CREATED_AT": F.lit("2024-01-01").cast("timestamp"),
        }
    )
    known = checked.where("FROM_TABLE <> 'customer_code'")
    return with_cardinality(semantic_relationships(graph, SYSTEM), known)


def decisions(spark, sf_dir) -> DataFrame:
    return view_decisions(classified_edges(spark, sf_dir), SYSTEM, NAMING)


def decision_totals(spark, sf_dir) -> DataFrame:
    return decision_counts(decisions(spark, sf_dir))


def assets(spark, sf_dir) -> DataFrame:
    return catalog_assets(td_entities(spark, sf_dir), held(classified_edges(spark, sf_dir)), SYSTEM, NAMING)


def asset_rows(spark, sf_dir) -> DataFrame:
    return _joined_lists(assets(spark, sf_dir))


def asset_totals(spark, sf_dir) -> DataFrame:
    return asset_counts(assets(spark, sf_dir))


def model_round_trip(spark, sf_dir) -> DataFrame:
    """The model packed into its nested document and opened again."""
    candidates, usable = td_graph(spark, sf_dir)
    graph = relationship_graph(usable)
    entities = semantic_entities(entity_map(usable, NAMING), candidates, SYSTEM, NAMING)
    document = held(model_document(entities, semantic_relationships(graph, SYSTEM), SYSTEM))
    opened = _joined_lists(model_entities(document))
    return opened.unionByName(model_relationships(document), allowMissingColumns=True)


def catalog_relationships(spark, sf_dir) -> DataFrame:
    """The four relationship lists of a packed catalog document as one bag."""
    return document_assets(catalog_document(assets(spark, sf_dir), SYSTEM), relationships_only=True)


MODEL_WORDS = ["ESTIMATE_LINE", "INVOICE", "ORDER", "ESTIMATE", "CONTACT", "CUSTOMER", "CAMPUS"]
SHORT = "TD"


def _base(name: str) -> str:
    return f"replace(upper({name}), '_TD', '')"


def _joined_name(parent: str = "from_table", child: str = "to_table") -> str:
    return f"'V_' || {_base(parent)} || '_WITH_' || {_base(child)} || '_{SHORT}'"


def _link_name(kind: str) -> str:
    return (
        f"'V_{kind}_' || {_base('from_table')} || '_TO_' || {_base('to_table')} || '_BY_' || upper(from_column) "
        f"|| '_{SHORT}'"
    )


ENTITIES = f"""{sql.discovery_ctes()},
members AS (SELECT "PARENT_TABLE" AS t FROM overlap WHERE "CONFIDENCE_LABEL" IN ('HIGH', 'MEDIUM')
  UNION SELECT "CHILD_TABLE" FROM overlap WHERE "CONFIDENCE_LABEL" IN ('HIGH', 'MEDIUM')),
named AS (SELECT t, {sql.entity("t", MODEL_WORDS, _base("t"))} AS e FROM members),
entities AS (
  SELECT e AS entity_name, t AS source_table, 'V_' || e || '_{SHORT}' AS view_name,
    {", ".join(
        f'''coalesce((SELECT string_agg("TARGET_COLUMN", ',' ORDER BY "CONFIDENCE_SCORE" DESC, "TARGET_COLUMN")
      FROM keyed WHERE "TARGET_TABLE" = t AND "CANDIDATE_TYPE" = '{kind}'), '') AS {name}'''
        for name, kind in KEY_LISTS.items()
    )}
  FROM named)"""

CLASSIFIED = f"""{INJECTED_OVERLAP},
checked AS ({INJECTED_CARDINALITY}),
edges AS (
  SELECT "PARENT_TABLE" AS from_table, "PARENT_COLUMN" AS from_column, "CHILD_TABLE" AS to_table,
    "CHILD_COLUMN" AS to_column, 'PARENT_CHILD' AS relationship_type, "CONFIDENCE_LABEL" AS confidence_label,
    "MATCH_RATE" AS match_rate, CASE WHEN "PARENT_TABLE" <> 'customer_code' THEN "CARDINALITY_TYPE" END
      AS cardinality_type
  FROM overlap o JOIN checked k ON k."FROM_TABLE" = o."PARENT_TABLE" AND k."FROM_COLUMN" = o."PARENT_COLUMN"
    AND k."TO_TABLE" = o."CHILD_TABLE" AND k."TO_COLUMN" = o."CHILD_COLUMN")"""

_FLAT_REASON = """CASE WHEN confidence_label NOT IN ('HIGH', 'MEDIUM') THEN 'confidence below generation threshold'
    WHEN cardinality_type = 'N:M' THEN 'N:M relationship requires bridge/manual modeling'
    WHEN coalesce(cardinality_type, 'UNKNOWN') <> '1:1'
      THEN coalesce(cardinality_type, 'UNKNOWN') || ' is not safe for flat view'
    ELSE 'safe to generate' END"""
_OBJECT_REASON = """CASE WHEN confidence_label NOT IN ('HIGH', 'MEDIUM') THEN 'confidence below generation threshold'
    WHEN cardinality_type = 'N:M' THEN 'N:M relationship requires bridge/manual modeling'
    ELSE 'safe to generate' END"""
_LINK = "coalesce(confidence_label IN ('HIGH', 'MEDIUM') AND cardinality_type = 'N:M', false)"

DECISIONS = f"""{CLASSIFIED},
decisions AS (SELECT *, {_FLAT_REASON} AS flat_reason, {_OBJECT_REASON} AS object_reason,
  {_FLAT_REASON} = 'safe to generate' AS flat_generate, {_OBJECT_REASON} = 'safe to generate' AS object_generate,
  {_LINK} AS link_generate, {_joined_name()} AS relationship_view_name, {_link_name("BRIDGE")} AS bridge_view_name,
  {_link_name("SUMMARY")} AS summary_view_name FROM edges)"""

_EDGE_COLUMNS = "from_table, from_column, to_table, to_column, confidence_label, match_rate, kind AS cardinality_type"
ASSETS = (
    ENTITIES
    + ",\n"
    + CLASSIFIED.removeprefix("WITH ").replace("counted AS", "ecounted AS").replace("FROM counted", "FROM ecounted")
    .replace("rated AS (SELECT *", "erated AS (SELECT *", 1).replace("FROM rated", "FROM erated")
    .replace("overlap AS (", "eoverlap AS (").replace("FROM overlap o", "FROM eoverlap o")
    + f""",
kinds AS (SELECT *, coalesce(cardinality_type, 'UNKNOWN') AS kind,
  confidence_label IN ('HIGH', 'MEDIUM') AS usable FROM edges),
assets AS (
  SELECT 'entity_views' AS asset_type, entity_name, source_table, view_name, primary_keys, business_keys,
    unique_attributes, NULL AS from_table, NULL AS from_column, NULL AS to_table, NULL AS to_column,
    NULL AS confidence_label, cast(NULL AS DOUBLE) AS match_rate, NULL AS cardinality_type, NULL AS skip_reason,
    NULL AS unsafe_flat_view_name FROM entities
  UNION ALL BY NAME
  SELECT 'safe_relationship_views' AS asset_type, {_joined_name()} AS view_name, {_EDGE_COLUMNS} FROM kinds
    WHERE usable AND kind = '1:1'
  UNION ALL BY NAME
  SELECT 'bridge_views' AS asset_type, {_link_name("BRIDGE")} AS view_name, {_EDGE_COLUMNS} FROM kinds
    WHERE usable AND kind IN ('1:N', 'N:1', 'N:M')
  UNION ALL BY NAME
  SELECT 'summary_views' AS asset_type, {_link_name("SUMMARY")} AS view_name, {_EDGE_COLUMNS} FROM kinds
    WHERE usable AND kind IN ('1:N', 'N:1', 'N:M')
  UNION ALL BY NAME
  SELECT 'skipped_relationships' AS asset_type, {_EDGE_COLUMNS},
    CASE WHEN NOT usable THEN 'confidence below generation threshold'
      WHEN kind = 'N:M' THEN 'N:M relationship is unsafe for flat joined view' ELSE 'unknown cardinality' END
      AS skip_reason,
    CASE WHEN usable AND kind = 'N:M' THEN {_joined_name()} END AS unsafe_flat_view_name
  FROM kinds WHERE NOT usable OR kind IN ('N:M', 'UNKNOWN'))"""
)
_COLLISION = (
    "coalesce(view_name IN (SELECT view_name FROM assets WHERE view_name IS NOT NULL GROUP BY 1 "
    "HAVING count(*) > 1), false) AS name_collision"
)

# Entity and view names

_NAME_PARTS = Naming(suffixes=("_TD", "_LAKE"), prefixes=("SRC_",))


def entity_names(spark, sf_dir) -> DataFrame:
    """Entity and view names of table names built from part names and types."""
    word = F.upper(F.replace("p_name", F.lit(" "), F.lit("_")))
    keyword = F.element_at(
        F.array(*[F.lit(w) for w in ("_ORDER", "_ESTIMATE_LINE", "_CUSTOMER", "", "_CONTACT", "_ESTIMATE", "")]),
        F.pmod(F.col("p_size"), F.lit(7)) + 1,
    )
    name = F.concat(
        F.when(F.col("p_size") > 25, "SRC_").otherwise(""), word, keyword,
        F.when(F.col("p_type") == "PROMO", "_LAKE").otherwise("_TD"),
    )
    system = F.concat("p_type", F.when(F.col("p_size") > 40, "_Redshift").otherwise("_SqlServer"))
    names = table(spark, sf_dir, "part").select("p_partkey", name.alias("T"), system.alias("S"))
    t, s = F.col("T"), F.col("S")
    entity = _NAME_PARTS.view_entity(t)
    return names.select(
        "*",
        _NAME_PARTS.graph_entity(t).alias("GRAPH_ENTITY"),
        _NAME_PARTS.model_entity(t).alias("MODEL_ENTITY"),
        entity.alias("VIEW_ENTITY"),
        _NAME_PARTS.entity_view(entity, s).alias("ENTITY_VIEW"),
        _NAME_PARTS.relationship_view(t, F.lit("src_child_td"), s).alias("RELATIONSHIP_VIEW"),
        _NAME_PARTS.bridge_view(t, F.lit("src_child_td"), F.lit("id"), s).alias("BRIDGE_VIEW"),
        _NAME_PARTS.summary_view(t, F.lit("src_child_td"), F.lit("id"), s).alias("SUMMARY_VIEW"),
    )


def _names_oracle() -> str:
    bare = "replace(replace(upper(\"T\"), '_TD', ''), '_LAKE', '')"
    base = f"replace({bare}, 'SRC_', '')"
    system = "replace(replace(upper(\"S\"), '_REDSHIFT', ''), '_SQLSERVER', '')"
    view = sql.entity('"T"', MODEL_WORDS, base)
    return f"""
WITH names AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN 'SRC_' ELSE '' END || upper(replace(p_name, ' ', '_'))
  || CASE p_size % 7 WHEN 0 THEN '_ORDER' WHEN 1 THEN '_ESTIMATE_LINE' WHEN 2 THEN '_CUSTOMER' WHEN 4 THEN '_CONTACT'
    WHEN 5 THEN '_ESTIMATE' ELSE '' END
  || CASE WHEN p_type = 'PROMO' THEN '_LAKE' ELSE '_TD' END AS "T",
  p_type || CASE WHEN p_size > 40 THEN '_Redshift' ELSE '_SqlServer' END AS "S" FROM part)
SELECT *, {sql.entity('"T"', MODEL_WORDS[1:], bare)} AS "GRAPH_ENTITY", {sql.entity('"T"', MODEL_WORDS, bare)} AS
  "MODEL_ENTITY", {view} AS "VIEW_ENTITY", 'V_' || ({view}) || '_' || {system} AS "ENTITY_VIEW",
  'V_' || {base} || '_WITH_CHILD_' || {system} AS "RELATIONSHIP_VIEW",
  'V_BRIDGE_' || {base} || '_TO_CHILD_BY_ID_' || {system} AS "BRIDGE_VIEW",
  'V_SUMMARY_' || {base} || '_TO_CHILD_BY_ID_' || {system} AS "SUMMARY_VIEW" FROM names"""


QUERIES = {
    "entity_view": entity_rows,
    **_view_queries(),
    "semantic_entities": entity_list,
    "view_decisions": decisions,
    "decision_counts": decision_totals,
    "semantic_catalog": asset_rows,
    "asset_counts": asset_totals,
    "model_document": model_round_trip,
    "catalog_relationships": catalog_relationships,
    "entity_names": entity_names,
}

ORACLES = {
    "entity_view": f"SELECT *, 'ORDER' AS \"_SEMANTIC_ENTITY_NAME\", 'ORDERS_TD' AS \"_SEMANTIC_SOURCE_TABLE\" "
    f"FROM {_renamed('ORDERS_TD')}",
    **_view_oracles(),
    "semantic_entities": f"{ENTITIES} SELECT * FROM entities",
    "view_decisions": f"{DECISIONS} SELECT * FROM decisions",
    "decision_counts": f"""{DECISIONS}
SELECT 'flat' AS mode, cast(count(*) FILTER (flat_generate) AS BIGINT) AS generated,
  count(*) FILTER (NOT flat_generate) AS skipped FROM decisions
UNION ALL SELECT 'object', count(*) FILTER (object_generate), count(*) FILTER (NOT object_generate) FROM decisions
UNION ALL SELECT 'link', 2 * count(*) FILTER (link_generate), count(*) FILTER (NOT link_generate) FROM decisions""",
    "semantic_catalog": f"{ASSETS} SELECT *, {_COLLISION} FROM assets",
    "asset_counts": f"{ASSETS} SELECT t AS asset_type, count(asset_type) AS assets FROM "
    "(VALUES ('entity_views'), ('safe_relationship_views'), ('bridge_views'), ('summary_views'), "
    "('skipped_relationships')) v(t) LEFT JOIN assets ON t = asset_type GROUP BY t",
    "model_document": f"""{ENTITIES}
SELECT *, NULL AS from_table, NULL AS from_column, NULL AS to_table, NULL AS to_column, NULL AS relationship_type,
  NULL AS confidence_label, cast(NULL AS DOUBLE) AS match_rate FROM entities
UNION ALL BY NAME
SELECT "PARENT_TABLE" AS from_table, "PARENT_COLUMN" AS from_column, "CHILD_TABLE" AS to_table,
  "CHILD_COLUMN" AS to_column, 'PARENT_CHILD' AS relationship_type, "CONFIDENCE_LABEL" AS confidence_label,
  "MATCH_RATE" AS match_rate FROM overlap WHERE "CONFIDENCE_LABEL" IN ('HIGH', 'MEDIUM')""",
    "catalog_relationships": f"{ASSETS} SELECT asset_type, from_table, from_column, to_table, to_column, "
    "confidence_label, match_rate, cardinality_type, view_name, skip_reason, unsafe_flat_view_name FROM assets "
    "WHERE asset_type <> 'entity_views'",
    "entity_names": _names_oracle(),
}
