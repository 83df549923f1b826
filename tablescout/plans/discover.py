"""Discovery end to end: profile → key candidates → overlap → graph → cardinality."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.functions.names import Naming
from tablescout.local import catalog_rows, local_frame
from tablescout.operators.cardinality import detect_cardinality
from tablescout.operators.graph import entity_map, relationship_graph, usable_relationships
from tablescout.operators.keys import key_candidates
from tablescout.operators.profile import profile_tables
from tablescout.operators.relate import candidate_pairs, value_overlap
from tablescout.plans.store import TableStore, new_run_id
from tablescout.plans.value_index import ValueIndex


@dataclass(frozen=True)
class Place:
    """Where the profiled tables live; stamped on every row of a discovery run."""

    source_system: str
    database: str = "LAKE"
    schema: str = "RAW"


def stamped_profile(profile: DataFrame, place: Place, run_id: str) -> DataFrame:
    return profile.withColumns(
        {
            "PROFILE_RUN_ID": F.lit(run_id),
            "SOURCE_SYSTEM": F.lit(place.source_system),
            "TARGET_DATABASE": F.lit(place.database),
            "TARGET_SCHEMA": F.lit(place.schema),
            "PROFILED_AT": F.current_timestamp(),
        }
    )


def held(frame: DataFrame) -> DataFrame:
    """A frame of a row per column evaluated once: later steps reuse its rows instead of its plan."""
    return local_frame(frame.sparkSession, [r.asDict() for r in catalog_rows(frame)], frame.schema)


def find_relationships(spark: SparkSession, frames: Mapping[str, DataFrame], place: Place) -> DataFrame:
    """Relationship candidates of a set of tables, without storing anything in between."""
    profile = profile_tables(spark, frames).withColumn("SOURCE_SYSTEM", F.lit(place.source_system))
    candidates = held(key_candidates(profile))
    return value_overlap(spark, frames, candidate_pairs(candidates))


def store_profiles(
    spark: SparkSession, frames: Mapping[str, DataFrame], place: Place, store: TableStore, run_id: str,
    tables_per_job: int = 50,
) -> None:
    """Profile tables a group per job; when a group fails, its tables one by one.

    A table that fails alone as well is stored in PROFILE_FAILURES with its error, and the others go on.
    """

    def profile(group: Mapping[str, DataFrame]) -> None:
        store.append("COLUMN_PROFILE", stamped_profile(profile_tables(spark, group), place, run_id))

    for group in batched(frames.items(), tables_per_job):
        try:
            profile(dict(group))
        except Exception:  # find out which table it is
            for table, frame in group:
                try:
                    profile({table: frame})
                except Exception as error:
                    store_failures(store, place, run_id, {table: str(error)})


def store_failures(store: TableStore, place: Place, run_id: str, failures: Mapping[str, str]) -> None:
    """Tables that could not be read, with their errors."""
    for table, error in failures.items():
        warnings.warn(f"{table} could not be profiled: {error}", stacklevel=2)
        store.append_rows("PROFILE_FAILURES", [{
            "PROFILE_RUN_ID": run_id, "SOURCE_SYSTEM": place.source_system, "TARGET_DATABASE": place.database,
            "TARGET_SCHEMA": place.schema, "TARGET_TABLE": table, "ERROR_MESSAGE": error, "FAILED_AT": datetime.now(UTC),
        }])


def discover(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    place: Place,
    store: TableStore,
    naming: Naming = Naming(),
    min_label: str = "WEAK",
    index: ValueIndex | None = None,
) -> None:
    """Run all discovery steps and append each result to its catalog table.

    With an index every table is scanned once, to write the index; all steps read that.  Tables whose columns are in the
    index already, in the version that it names, are not scanned at all when `frames` leaves them out.
    """
    now = F.current_timestamp()
    profile_run, relationship_run, cardinality_run = (new_run_id() for _ in range(3))
    if index:
        failures = index.build(frames)
        store_failures(store, place, profile_run, failures)
        store.append("COLUMN_PROFILE", stamped_profile(index.profile(), place, profile_run))
    else:
        store_profiles(spark, frames, place, store, profile_run)
    profile = store.read("COLUMN_PROFILE").where(F.col("PROFILE_RUN_ID") == profile_run)
    store.append("KEY_CANDIDATES", key_candidates(profile).withColumn("CREATED_AT", now))
    candidates = store.read("KEY_CANDIDATES").where(F.col("PROFILE_RUN_ID") == profile_run)
    pairs = candidate_pairs(candidates)
    overlap = index.overlap(pairs, min_label) if index else value_overlap(spark, frames, pairs, min_label)
    store.append(
        "RELATIONSHIP_CANDIDATES",
        overlap.withColumns({"RELATIONSHIP_RUN_ID": F.lit(relationship_run), "CREATED_AT": now}),
    )
    found = store.read("RELATIONSHIP_CANDIDATES").where(F.col("RELATIONSHIP_RUN_ID") == relationship_run)
    usable = usable_relationships(found)
    graph = relationship_graph(usable)
    store.append("RELATIONSHIP_GRAPH", graph.withColumn("CREATED_AT", now))
    store.append("ENTITY_MAP", entity_map(usable, naming).withColumn("CREATED_AT", now))
    cardinality = index.cardinality(graph) if index else detect_cardinality(spark, frames, graph)
    store.append(
        "RELATIONSHIP_CARDINALITY",
        cardinality.withColumns({"CARDINALITY_RUN_ID": F.lit(cardinality_run), "CREATED_AT": now}),
    )
