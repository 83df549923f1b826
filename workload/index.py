"""Queries over the value index: discovery of all tables by one scan each, and its upkeep by deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.operators.keys import key_candidates
from tablescout.operators.relate import candidate_pairs
from tablescout.operators.views import Edge
from tablescout.plans.discover import Place, discover
from tablescout.plans.semantic import semantic_relationships, with_cardinality
from tablescout.plans.store import TableStore
from tablescout.plans.value_index import ValueIndex
from workload import sql
from workload.discovery import NAMING
from workload.runs import scratch
from workload.tables import RENAMED, SYSTEM, TABLES, all_tables, table

# All tables, under names that let columns be paired.
EVERY = RENAMED | {
    "EVENTS_TD": ("events", "EVENT_ID EVENT_TIME CUSTOMER_ID EVENT_TYPE EVENT_VALUE PROPS".split()),
    "CONVERSATIONS_TD": ("conversations", "CONVERSATION_ID TURN_NUMBER ROLE TEXT_COL".split()),
    "PAGES_TD": ("pages", "PAGE_ID URL HTML".split()),
    "BENCHMARK_TD": ("benchmark", "ITEM_ID TEXT_COL".split()),
    "EMBEDDINGS_TD": ("embeddings", "VEC_ID EMBEDDING LABEL".split()),
}


def every_view(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        view: table(spark, sf_dir, source).selectExpr(*[f"{old} AS {new}" for old, new in zip(TABLES[source], names, strict=True)])
        for view, (source, names) in EVERY.items()
    }


def new_index(spark, frames) -> ValueIndex:
    index = ValueIndex(TableStore(spark, scratch(spark)), buckets=8)
    if failures := index.build(frames):
        raise ValueError(f"not indexed: {failures}")
    return index


def profile_index(spark, sf_dir) -> DataFrame:
    """Profile of every column of every table, from the index."""
    return new_index(spark, all_tables(spark, sf_dir)).profile(signed_zeros=True)


def _candidates(index: ValueIndex) -> DataFrame:
    profile = index.profile().withColumn("SOURCE_SYSTEM", F.lit(SYSTEM))
    return index.held(key_candidates(profile), "candidates")


def key_candidates_all(spark, sf_dir) -> DataFrame:
    return _candidates(new_index(spark, every_view(spark, sf_dir)))


def value_overlap_all(spark, sf_dir) -> DataFrame:
    index = new_index(spark, every_view(spark, sf_dir))
    return index.overlap(candidate_pairs(_candidates(index)))


def value_overlap_high(spark, sf_dir) -> DataFrame:
    """Pairs of at least a HIGH label; others are out after a share of the values."""
    index = new_index(spark, every_view(spark, sf_dir))
    return index.overlap(candidate_pairs(_candidates(index)), "HIGH")


def cardinality_all(spark, sf_dir) -> DataFrame:
    """Cardinality of all pairs of columns with compatible names, of all tables."""
    index = new_index(spark, every_view(spark, sf_dir))
    edges = candidate_pairs(_candidates(index)).withColumnsRenamed(
        {"PARENT_TABLE": "FROM_TABLE", "PARENT_COLUMN": "FROM_COLUMN", "CHILD_TABLE": "TO_TABLE", "CHILD_COLUMN": "TO_COLUMN"}
    )
    return index.cardinality(index.held(edges, "edges"))


def discovery_index(spark, sf_dir) -> DataFrame:
    """Stored relationships, with cardinality, of a discovery run over all tables that scans each table once."""
    store = TableStore(spark, scratch(spark))
    discover(spark, every_view(spark, sf_dir), Place(SYSTEM), store, NAMING, index=ValueIndex(store, buckets=8))
    relationships = semantic_relationships(store.read("RELATIONSHIP_GRAPH"), SYSTEM)
    return with_cardinality(relationships, store.read("RELATIONSHIP_CARDINALITY"))


# Orders before 2000, then all of them with the urgent ones changed.
CUT = "timestamp_ntz '2000-01-01'"
EDGE = Edge("ORDERS_TD", "CUSTOMER_ID", "EVENTS_TD", "CUSTOMER_ID", "N:M")


def _loads(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Orders as first loaded and as they are after a merge; rows the merge removes and adds."""
    orders = every_view(spark, sf_dir)["ORDERS_TD"]
    urgent = F.col("ORDER_PRIORITY") == "1-URGENT"
    # urgent orders go to the next customer
    after = orders.withColumns({
        "ORDER_STATUS": F.when(urgent, "X").otherwise(F.col("ORDER_STATUS")),
        "CUSTOMER_ID": F.when(urgent, F.col("CUSTOMER_ID") + 1).otherwise(F.col("CUSTOMER_ID")),
    })
    old = F.expr(f"ORDER_DATE < {CUT}")
    return orders.where(old), after, orders.where(old & urgent), after.where(~old | urgent)


def profile_after_delta(spark, sf_dir) -> DataFrame:
    """Profile of orders kept up by the index of a merge's delta."""
    before, after, removed, added = _loads(spark, sf_dir)
    index = new_index(spark, {"ORDERS_TD": before})
    index.follow("ORDERS_TD", removed, added, after)
    return index.profile(["ORDERS_TD"], signed_zeros=True)


def _summaries(spark, sf_dir) -> tuple[ValueIndex, dict, DataFrame]:
    """An index, its state before the deltas of both tables of the edge, and the summary stored then."""
    before, after, removed, added = _loads(spark, sf_dir)
    events = every_view(spark, sf_dir)["EVENTS_TD"]
    early = F.col("EVENT_TYPE") != "click"
    index = new_index(spark, {"ORDERS_TD": before, "EVENTS_TD": events.where(early)})
    state = index.entries()
    stored = index.held(index.summary(EDGE), "summary")
    index.follow("ORDERS_TD", removed, added, after)
    index.follow("EVENTS_TD", events.limit(0), events.where(~early), events)
    return index, state, stored


def summary_after_merge(spark, sf_dir) -> DataFrame:
    """A stored summary brought up to date by the deltas of both its tables."""
    index, state, stored = _summaries(spark, sf_dir)
    return index.summary_after(EDGE, stored, state)


def summary_index(spark, sf_dir) -> DataFrame:
    """Summary view of line numbers of all order lines with themselves, from the index."""
    index = new_index(spark, {"LINEITEM_TD": every_view(spark, sf_dir)["LINEITEM_TD"]})
    return index.summary(Edge("LINEITEM_TD", "SUPPLIER_ID", "LINEITEM_TD", "LINE_NUMBER", "N:M"))


def bridge_index(spark, sf_dir) -> DataFrame:
    """Bridge view of two tables, from the index."""
    frames = every_view(spark, sf_dir)
    index = new_index(spark, {t: frames[t] for t in ("ORDERS_TD", "EVENTS_TD")})
    return index.bridge(EDGE)


QUERIES = {
    "profile_index": profile_index,
    "key_candidates_all": key_candidates_all,
    "value_overlap_all": value_overlap_all,
    "value_overlap_high": value_overlap_high,
    "cardinality_all": cardinality_all,
    "discovery_index": discovery_index,
    "profile_after_delta": profile_after_delta,
    "summary_after_merge": summary_after_merge,
    "summary_index": summary_index,
    "bridge_index": bridge_index,
}

# SQL: the cells of all tables in one list, and all else from that.


def _kinds() -> str:
    rows = [(v, n, sql.kind(t, o)) for v, (t, names) in EVERY.items() for o, n in zip(TABLES[t], names, strict=True)]
    return ", ".join(f"('{v}', '{n}', '{'timestamp_ntz' if k == 'timestamp' else k}')" for v, n, k in rows)


def _cells_of(view: str, relation: str, names: list[str]) -> str:
    return f"SELECT '{view}' AS t, c, v FROM ({relation}) UNPIVOT INCLUDE NULLS (v FOR c IN ({', '.join(names)}))"


def _cells() -> str:
    return sql.union_all(
        _cells_of(view, "SELECT " + ", ".join(f"{old}::VARCHAR AS {new}" for old, new in zip(TABLES[t], names, strict=True)) + f" FROM {t}", names)
        for view, (t, names) in EVERY.items()
    )


def _profile(cells: str = "cells") -> str:
    return f"""
SELECT t AS "TARGET_TABLE", c AS "TARGET_COLUMN", any_value(k) AS "DATA_TYPE", count(*) AS "ROW_COUNT", count(v) AS "NON_NULL_COUNT",
  count(*) - count(v) AS "NULL_COUNT", count(DISTINCT v) AS "DISTINCT_COUNT",
  CASE WHEN count(*) > 0 THEN count(DISTINCT v)::DOUBLE / count(*)::DOUBLE ELSE 0 END AS "DISTINCT_RATIO",
  CASE WHEN count(*) > 0 THEN count(v)::DOUBLE / count(*)::DOUBLE ELSE 0 END AS "NON_NULL_RATIO",
  CASE WHEN any_value(k) NOT LIKE 'array%' THEN min(v) END AS "MIN_VALUE", CASE WHEN any_value(k) NOT LIKE 'array%' THEN max(v) END AS "MAX_VALUE"
FROM {cells} JOIN (VALUES {_kinds()}) AS kinds(t, c, k) USING (t, c) GROUP BY t, c"""


FOUND = f"""
WITH cells AS MATERIALIZED ({_cells()}),
keyed AS MATERIALIZED ({sql.key_scores(_profile())}),
pairs AS MATERIALIZED ({sql.pair_query("keyed")})"""
HELD = """held AS MATERIALIZED (SELECT DISTINCT t, c, v FROM cells SEMI JOIN (
  SELECT "PARENT_TABLE" AS t, "PARENT_COLUMN" AS c FROM pairs UNION SELECT "CHILD_TABLE", "CHILD_COLUMN" FROM pairs) USING (t, c)
  WHERE v IS NOT NULL)"""
RATED = f"""{HELD},
counted AS (
  SELECT pairs.*, count(ch.v) AS "CHILD_NON_NULL_COUNT", count(pa.v) AS "MATCH_COUNT" FROM pairs
  LEFT JOIN held ch ON ch.t = "CHILD_TABLE" AND ch.c = "CHILD_COLUMN"
  LEFT JOIN held pa ON pa.t = "PARENT_TABLE" AND pa.c = "PARENT_COLUMN" AND pa.v = ch.v GROUP BY ALL),
rated AS (SELECT *, {sql.RATE} FROM counted),
overlap AS MATERIALIZED (SELECT *, {sql.LABELS} FROM rated)"""
CLASSES = f"""keys AS MATERIALIZED (SELECT t, c, count(*) AS d, count(*) FILTER (n > 1) AS dup FROM (
  SELECT t, c, trim(v) AS k, count(*) AS n FROM cells SEMI JOIN held USING (t, c) WHERE trim(v) <> '' GROUP BY ALL) GROUP BY ALL),
classes AS (SELECT *, {sql.CLASS} FROM (
  SELECT "PARENT_TABLE" AS "FROM_TABLE", "PARENT_COLUMN" AS "FROM_COLUMN", "CHILD_TABLE" AS "TO_TABLE", "CHILD_COLUMN" AS "TO_COLUMN",
    p.d AS "FROM_DISTINCT_KEYS", ch.d AS "TO_DISTINCT_KEYS", p.dup AS "FROM_DUPLICATE_KEYS", ch.dup AS "TO_DUPLICATE_KEYS"
  FROM pairs JOIN keys p ON p.t = "PARENT_TABLE" AND p.c = "PARENT_COLUMN" JOIN keys ch ON ch.t = "CHILD_TABLE" AND ch.c = "CHILD_COLUMN"))"""

_URGENT = "o_orderpriority = '1-URGENT'"
AFTER = f"""SELECT o_orderkey AS "ORDER_ID", CASE WHEN {_URGENT} THEN o_custkey + 1 ELSE o_custkey END AS "CUSTOMER_ID",
  CASE WHEN {_URGENT} THEN 'X' ELSE o_orderstatus END AS "ORDER_STATUS", o_totalprice AS "TOTAL_PRICE", o_orderdate AS "ORDER_DATE",
  o_orderpriority AS "ORDER_PRIORITY" FROM orders"""
_AFTER_CELLS = f"({_cells_of('ORDERS_TD', f'SELECT COLUMNS(*)::VARCHAR FROM ({AFTER})', EVERY['ORDERS_TD'][1])})"


def _edge_constants(edge: Edge) -> str:
    return (
        f"'{edge.from_table}' AS \"_SEMANTIC_PARENT_TABLE\", '{edge.to_table}' AS \"_SEMANTIC_CHILD_TABLE\", '{edge.from_column}' AS "
        f"\"_SEMANTIC_PARENT_COLUMN\", '{edge.to_column}' AS \"_SEMANTIC_CHILD_COLUMN\", '{edge.cardinality_type}' AS \"_SEMANTIC_CARDINALITY_TYPE\""
    )


def _summary(parent: str, child: str, edge: Edge) -> str:
    return f"""
SELECT p.k::VARCHAR AS "PARENT_KEY_VALUE", p.n * c.n AS "JOINED_ROW_COUNT", 1::BIGINT AS "DISTINCT_CHILD_KEY_COUNT", {_edge_constants(edge)}
FROM (SELECT k, count(*) AS n FROM ({parent}) GROUP BY 1) p JOIN (SELECT k, count(*) AS n FROM ({child}) GROUP BY 1) c USING (k)"""


ORACLES = {
    "profile_index": sql.profile([(n, c, n, c, "timestamp_ntz" if sql.kind(n, c) == "timestamp" else sql.kind(n, c)) for n, cs in TABLES.items() for c in cs]),
    "key_candidates_all": f"""{FOUND}
SELECT '{SYSTEM}' AS "SOURCE_SYSTEM", "TARGET_TABLE", "TARGET_COLUMN", "DATA_TYPE", "CANDIDATE_TYPE", "CONFIDENCE_SCORE", "REASON" FROM keyed""",
    "value_overlap_all": f"{FOUND}, {RATED} SELECT '{SYSTEM}' AS \"SOURCE_SYSTEM\", * FROM overlap",
    "value_overlap_high": f"{FOUND}, {RATED} SELECT '{SYSTEM}' AS \"SOURCE_SYSTEM\", * FROM overlap WHERE \"CONFIDENCE_LABEL\" = 'HIGH'",
    "cardinality_all": f"{FOUND}, {HELD}, {CLASSES} SELECT '{SYSTEM}' AS \"SOURCE_SYSTEM\", * FROM classes",
    "discovery_index": f"""{FOUND}, {RATED}, {CLASSES}
SELECT "FROM_TABLE" AS from_table, "FROM_COLUMN" AS from_column, "TO_TABLE" AS to_table, "TO_COLUMN" AS to_column,
  'PARENT_CHILD' AS relationship_type, "CONFIDENCE_LABEL" AS confidence_label, "MATCH_RATE" AS match_rate, "CARDINALITY_TYPE" AS cardinality_type
FROM overlap JOIN classes ON "PARENT_TABLE" = "FROM_TABLE" AND "PARENT_COLUMN" = "FROM_COLUMN" AND "CHILD_TABLE" = "TO_TABLE" AND "CHILD_COLUMN" = "TO_COLUMN"
WHERE "CONFIDENCE_LABEL" IN ('HIGH', 'MEDIUM')""",
    "profile_after_delta": _profile(_AFTER_CELLS),
    "summary_after_merge": _summary(f'SELECT "CUSTOMER_ID" AS k FROM ({AFTER})', "SELECT user_id AS k FROM events", EDGE),
    "summary_index": _summary("SELECT l_suppkey AS k FROM lineitem", "SELECT l_linenumber::BIGINT AS k FROM lineitem",
                              Edge("LINEITEM_TD", "SUPPLIER_ID", "LINEITEM_TD", "LINE_NUMBER", "N:M")),
    "bridge_index": f"""
SELECT k::VARCHAR AS "PARENT_KEY_VALUE", k::VARCHAR AS "CHILD_KEY_VALUE", {_edge_constants(EDGE)}
FROM (SELECT o_custkey AS k FROM orders INTERSECT SELECT user_id FROM events)""",
}
