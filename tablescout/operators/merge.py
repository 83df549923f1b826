"""Keyed upserts as joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(stage: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys a stage holds more than once; NULL keys never match, so they do not count."""
    filled = stage.dropna(subset=list(key))
    return filled.groupBy(*key).agg(F.count(F.lit(1)).alias("N")).where("N > 1")


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    Spark keeps at most one row per key in each map task before the shuffle (window group limit),
    so a key with a large share of the rows does not pile up in one reducer.
    """
    first = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def merge_upsert(target: DataFrame, stage: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target after merging ``stage``: matched rows take the stage's values, the rest is added.

    Stage keys must be unique.  Every target row with a matching key is replaced (also repeated
    ones).  Rows with a NULL key never match: they are added as they are and skip the joins, where they
    would meet in one partition.  A small stage is broadcast by Spark and the target is then not
    shuffled: the second join only needs the target's keys that occur in the stage.
    """
    key = list(key)
    columns = target.columns
    filled = reduce(Column.__and__, (F.col(name).isNotNull() for name in key))
    keyless = target.where(~filled).unionByName(stage.where(~filled).select(columns))
    target, stage = target.where(filled), stage.where(filled)
    replaced = stage.select(*key, F.struct(*columns).alias("_new"))
    kept = (
        target.join(replaced, key, "left")
        .select(
            [
                F.when(F.col("_new").isNotNull(), F.col("_new")[name]).otherwise(F.col(name)).alias(name)
                for name in columns
            ]
        )
    )
    matched = target.select(*key).join(stage.select(*key), key, "left_semi").distinct()
    added = stage.select(columns).join(matched, key, "left_anti")
    return kept.unionByName(added).unionByName(keyless)


def append_rows(target: DataFrame, delta: DataFrame) -> DataFrame:
    """Incremental load without a key: the delta is added as it is."""
    return target.unionByName(delta.select(target.columns))


def key_bucket(columns: Sequence[str], key: Sequence[str], buckets: int) -> Column:
    """Stable bucket of a row by its key.

    A row with a NULL key part never matches anything, so it may live anywhere: it is placed by a
    hash of the whole row, which spreads a large NULL group over all buckets.
    """
    has_key = F.lit(True)
    for name in key:
        has_key = has_key & F.col(name).isNotNull()
    placed = F.when(has_key, F.xxhash64(*key)).otherwise(F.xxhash64(*columns))
    return F.pmod(placed, F.lit(buckets)).cast("int")
