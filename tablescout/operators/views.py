"""Entity views and the four relationship views, as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablescout.functions.names import Naming
from tablescout.functions.values import INTEGRAL, join_key, quoted
from tablescout.operators.cells import union_all
from tablescout.operators.conform import LINEAGE_COLUMNS

# Classes whose child keys occur once, so one left join does.
UNIQUE_CHILD = ("1:1", "N:1")


@dataclass(frozen=True)
class Edge:
    """A relationship between two tables."""

    from_table: str
    from_column: str
    to_table: str
    to_column: str
    cardinality_type: str | None = None


def entity_view(rows: DataFrame, entity_name: str, source_table: str) -> DataFrame:
    return rows.withColumns(
        {"_SEMANTIC_ENTITY_NAME": F.lit(entity_name), "_SEMANTIC_SOURCE_TABLE": F.lit(source_table)}
    )


def _constants(edge: Edge, with_class: bool = False) -> list[Column]:
    constants = [
        F.lit(edge.from_table).alias("_SEMANTIC_PARENT_TABLE"),
        F.lit(edge.to_table).alias("_SEMANTIC_CHILD_TABLE"),
        F.lit(edge.from_column).alias("_SEMANTIC_PARENT_COLUMN"),
        F.lit(edge.to_column).alias("_SEMANTIC_CHILD_COLUMN"),
    ]
    if with_class:
        constants.append(F.lit(edge.cardinality_type).alias("_SEMANTIC_CARDINALITY_TYPE"))
    return constants


def _keys(parent: DataFrame, child: DataFrame, edge: Edge) -> tuple[Column, Column]:
    """Normalised keys of both sides: whole numbers as they are, everything else as text.

    Columns of one integer type stay uncast, so their NULL tests reach the scan.
    """
    left, right = dict(parent.dtypes)[edge.from_column], dict(child.dtypes)[edge.to_column]
    domain = "string"
    if left in INTEGRAL and right in INTEGRAL:
        domain = left if left == right else "bigint"
    return (
        F.expr(join_key(edge.from_column, left, domain)),
        F.expr(join_key(edge.to_column, right, domain)),
    )


def _check_names(names: Sequence[str]) -> None:
    lowered = [name.lower() for name in names]
    clashes = sorted({name for name in lowered if lowered.count(name) > 1})
    if clashes:
        raise ValueError(f"view columns clash: {clashes}")


def _side(rows: DataFrame, prefix: str, key: Column) -> DataFrame:
    """Columns renamed by position (still prunable), with the join key added."""
    return rows.select(*[F.col(quoted(c)).alias(f"{prefix}{i}") for i, c in enumerate(rows.columns)], key.alias(prefix))


def _joined(parent: DataFrame, child: DataFrame, edge: Edge) -> DataFrame:
    """Parent LEFT JOIN child on the normalised key; columns P0… and C0….

    Parents without a key skip the join, so they do not meet in one NULL partition.  With unique
    child keys the rest is one left join.  With repeated child keys it is an inner join, which can
    broadcast a small parent and lets AQE split a hot key on either side, plus the parents that
    match nothing (a left join can do neither for its right side).
    """
    parent_key, child_key = _keys(parent, child, edge)
    left = _side(parent, "P", parent_key)
    right = _side(child, "C", child_key).where("C is not null")
    keyed = left.where("P is not null")
    alone = [left.where("P is null")]
    same_key = F.col("P") == F.col("C")
    if edge.cardinality_type in UNIQUE_CHILD:
        matched = keyed.join(right, same_key, "left")
    else:
        matched = keyed.join(right, same_key)
        alone.append(keyed.join(right.select("C").distinct(), same_key, "left_anti"))
    unmatched = union_all(alone)
    return matched.unionByName(unmatched, allowMissingColumns=True)


def flat_view(parent: DataFrame, child: DataFrame, edge: Edge, naming: Naming = Naming()) -> DataFrame:
    """Parent and child columns side by side; child columns the parent also has are prefixed."""
    parent = parent.drop(*LINEAGE_COLUMNS)
    child = child.drop(*LINEAGE_COLUMNS)
    taken = {name.lower() for name in parent.columns}
    aliases = {
        name: naming.column_alias(edge.to_table, name) if name.lower() in taken else name for name in child.columns
    }
    _check_names([*parent.columns, *aliases.values()])
    return _joined(parent, child, edge).select(
        *[F.col(f"P{i}").alias(name) for i, name in enumerate(parent.columns)],
        *[F.col(f"C{i}").alias(alias) for i, alias in enumerate(aliases.values())],
        *_constants(edge),
    )


def object_view(parent: DataFrame, child: DataFrame, edge: Edge) -> DataFrame:
    """Parent columns with the whole child row as a record; a record of NULLs where none matches."""
    record = F.struct(*[F.col(f"C{i}").alias(name) for i, name in enumerate(child.columns)])
    return _joined(parent, child, edge).select(
        *[F.col(f"P{i}").alias(name) for i, name in enumerate(parent.columns)],
        record.alias("_SEMANTIC_CHILD_RECORD"),
        *_constants(edge),
    )


def _key_rows(parent: DataFrame, child: DataFrame, edge: Edge) -> tuple[DataFrame, DataFrame]:
    parent_key, child_key = _keys(parent, child, edge)
    return (
        parent.select(parent_key.alias("K")).where("K is not null"),
        child.select(child_key.alias("K")).where("K is not null"),
    )


def bridge_view(parent: DataFrame, child: DataFrame, edge: Edge) -> DataFrame:
    """Distinct matching key pairs.  The keys are equal, so each side is reduced to its distinct
    keys before the join and the row-level join never happens."""
    parents, children = _key_rows(parent, child, edge)
    return bridge_of_keys(parents.distinct(), children.distinct(), edge)


def bridge_of_keys(parents: DataFrame, children: DataFrame, edge: Edge) -> DataFrame:
    """The bridge of distinct keys K of both sides."""
    text = F.col("K").cast("string")
    return parents.join(children, "K").select(
        text.alias("PARENT_KEY_VALUE"), text.alias("CHILD_KEY_VALUE"), *_constants(edge, with_class=True)
    )


def summary_view(parent: DataFrame, child: DataFrame, edge: Edge) -> DataFrame:
    """Joined rows and distinct child keys per parent key.

    A key with n parent and m child rows joins to n·m rows, so both sides are counted per key
    first and the counts multiplied; a hot key costs one row a side instead of a cross product.
    """
    parents, children = _key_rows(parent, child, edge)
    counts = [
        rows.groupBy("K").agg(F.count(F.lit(1)).alias(name))
        for rows, name in ((parents, "PARENT_ROWS"), (children, "CHILD_ROWS"))
    ]
    joined = counts[0].join(counts[1], "K")
    return summary_of_keys(joined.select("K", (F.col("PARENT_ROWS") * F.col("CHILD_ROWS")).alias("JOINED_ROW_COUNT")), edge)


def summary_of_keys(joined: DataFrame, edge: Edge) -> DataFrame:
    """The summary of keys (K, JOINED_ROW_COUNT)."""
    return joined.select(
        F.col("K").cast("string").alias("PARENT_KEY_VALUE"),
        "JOINED_ROW_COUNT",
        F.lit(1).cast("long").alias("DISTINCT_CHILD_KEY_COUNT"),
        *_constants(edge, with_class=True),
    )
