"""Key candidates from column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.functions.rules import key_candidate


def latest_profile(profiles: DataFrame, source_system: str | None = None) -> DataFrame:
    """Profile rows of the newest run (of one system when given, else of all)."""
    if source_system:
        profiles = profiles.where(F.col("SOURCE_SYSTEM") == source_system)
    # A one-row aggregate, not an unpartitioned window, which would sort everything in one task.
    newest = profiles.agg(F.max(F.struct("PROFILED_AT", "PROFILE_RUN_ID")).alias("R")).select("R.PROFILE_RUN_ID")
    return profiles.join(newest, "PROFILE_RUN_ID", "left_semi")


def key_candidates(profiles: DataFrame) -> DataFrame:
    """Profile rows that look like keys, with type, score and reason."""
    scored = profiles.withColumn(
        "_key",
        key_candidate(
            F.col("TARGET_COLUMN"), F.col("ROW_COUNT"), F.col("DISTINCT_RATIO"), F.col("NON_NULL_RATIO")
        ),
    )
    kept = [
        name
        for name in (
            "PROFILE_RUN_ID", "SOURCE_SYSTEM", "TARGET_DATABASE", "TARGET_SCHEMA",
            "TARGET_TABLE", "TARGET_COLUMN", "DATA_TYPE",
        )
        if name in profiles.columns
    ]
    return scored.where("_key.CANDIDATE_TYPE is not null").select(*kept, "_key.*")
