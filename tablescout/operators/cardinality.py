"""Duplicate-key counts and the cardinality class of relationships."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.rules import cardinality_reason, cardinality_type
from tablescout.functions.values import INTEGRAL, is_nested, join_key
from tablescout.local import catalog_rows, local_frame
from tablescout.operators.cells import Cell, digested, union_all, unpivoted
from tablescout.schemas import EDGE_KEY

_COLUMNS = T.StructType([T.StructField(n, T.StringType()) for n in ("T", "N")] + [T.StructField("C", T.IntegerType())])


def key_counts(frames: Mapping[str, DataFrame], columns: Mapping[tuple[str, str], str]) -> DataFrame:
    """Per column id: distinct normalised keys, and keys on more than one row.

    Rows are counted per (column, key) with map-side combining, so a key with a large share of
    the rows costs one row per map task.
    """
    dtypes = {table: dict(frames[table].dtypes) for table, _ in columns}
    kinds: dict[str, list[Cell]] = {}
    for (table, column), cell_id in columns.items():
        dtype = dtypes[table][column]
        kind = "bigint" if dtype in INTEGRAL else "string" if is_nested(dtype) else dtype
        kinds.setdefault(kind, []).append(Cell(cell_id, table, join_key(column, dtype, kind)))
    parts = []
    for kind, cells in kinds.items():
        rows = unpivoted(frames, cells).where(F.col("V").isNotNull())
        keys = ["C", "V"]
        if kind == "string":
            rows, keys = digested(rows), ["C", "HASHED", "K"]
        parts.append(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("N")).select("C", "N"))
    return (
        union_all(parts)
        .groupBy("C")
        .agg(F.count(F.lit(1)).alias("DISTINCT_KEYS"), F.count_if(F.col("N") > 1).alias("DUPLICATE_KEYS"))
    )


def detect_cardinality(spark: SparkSession, frames: Mapping[str, DataFrame], edges: DataFrame) -> DataFrame:
    """Distinct and duplicate keys on both sides of each edge, with class and reason.

    Every column is counted once however many edges it takes part in.
    """
    known = sorted((r.T, r.N) for r in catalog_rows(edge_columns(edges)))  # a row a column; edges stay in Spark
    ids = {column: str(number) for number, column in enumerate(known)}
    counts = None
    if ids:
        numbered = local_frame(spark, [{"T": t, "N": n, "C": int(c)} for (t, n), c in ids.items()], _COLUMNS)
        counts = numbered.join(key_counts(frames, ids), "C", "left")
    return classified(edges, counts)


_SIDES = [(side, f"{side}_TABLE", f"{side}_COLUMN") for side in ("FROM", "TO")]


def edge_columns(edges: DataFrame) -> DataFrame:
    """The distinct columns (T, N) of edges."""
    return union_all(edges.select(F.col(t).alias("T"), F.col(n).alias("N")) for _, t, n in _SIDES).distinct()


def classified(edges: DataFrame, counts: DataFrame | None) -> DataFrame:
    """Edges with the key counts (T, N, DISTINCT_KEYS, DUPLICATE_KEYS) of both sides, class and reason."""
    carried = [n for n in ("SOURCE_SYSTEM",) if n in edges.columns]
    if "SOURCE_SYSTEM" not in edges.columns:
        edges = edges.withColumn("SOURCE_SYSTEM", F.lit(None).cast("string"))
    key = ["SOURCE_SYSTEM", *EDGE_KEY]
    # One row per edge and side, so the counts are computed and joined once.
    ends = edges.select(
        *key, F.inline(F.array(*[F.struct(F.lit(side).alias("SIDE"), F.col(t).alias("T"), F.col(n).alias("N")) for side, t, n in _SIDES]))
    )
    if counts is not None:
        counted = ends.join(counts, ["T", "N"], "left")
    else:
        counted = ends.withColumns({f"{kind}_KEYS": F.lit(None).cast("long") for kind in ("DISTINCT", "DUPLICATE")})
    sided = counted.groupBy(*key).agg(
        *[
            F.max(F.when(F.col("SIDE") == side, F.coalesce(f"{kind}_KEYS", F.lit(0)))).alias(f"{side}_{kind}_KEYS")
            for kind in ("DISTINCT", "DUPLICATE")
            for side in ("FROM", "TO")
        ]
    )
    kind = cardinality_type(F.col("FROM_DUPLICATE_KEYS"), F.col("TO_DUPLICATE_KEYS"))
    return sided.select(
        *carried,
        *EDGE_KEY,
        "FROM_DISTINCT_KEYS",
        "TO_DISTINCT_KEYS",
        "FROM_DUPLICATE_KEYS",
        "TO_DUPLICATE_KEYS",
        kind.alias("CARDINALITY_TYPE"),
        cardinality_reason(kind).alias("REASON"),
    )
