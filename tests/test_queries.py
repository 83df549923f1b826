"""Registered queries against their oracle SQL in DuckDB.

A quick selection by default; ALL_QUERIES=1 compares every one.
"""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload import ORACLES, QUERIES

QUICK = [
    "scan_incremental", "type_mapping", "conform_rows", "merge_upsert", "merge_null_keys", "merge_repeated_keys",
    "watermark_upsert", "run_log_latest", "validate_counts", "run_summary", "latest_tables", "shared_columns",
    "latest_cardinality", "value_overlap", "cardinality_edges", "name_compatibility", "flat_view_null_keys",
    "object_view_unknown", "bridge_view", "summary_view", "view_decisions", "entity_names", "conform_large_numbers",
    "ingest_failures", "registered_views", "cardinality", "profile_index", "value_overlap_all", "value_overlap_high",
    "discovery_index", "profile_after_delta", "summary_after_merge", "summary_index", "bridge_index",
]
NAMES = sorted(ORACLES) if os.environ.get("ALL_QUERIES") else QUICK


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        files = f"{path}/*.parquet" if path.is_dir() else path
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{files}'")
    return connection


def normal(names, rows) -> list[tuple]:
    """Rows with columns in name order and values as text, sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(value):
        return repr(float(value)) if isinstance(value, float) else None if value is None else str(value)

    return sorted((tuple(text(row[i]) for i in order) for row in rows), key=str)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, sf_dir, duck, name):
    found = entry_points.queries()[name](spark, sf_dir)
    expected = duck.execute(entry_points.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(found.columns) == sorted(names)
    assert normal(found.columns, found.collect()) == normal(names, expected.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
