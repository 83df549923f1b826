"""Column profiles of many tables in one job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.values import (
    FRACTIONAL, INTEGRAL, has_text_order, in_domain, is_negative_zero, is_nested, quoted, ratio, text_form,
)
from tablescout.local import catalog_rows, local_frame
from tablescout.operators.cells import Cell, digested, has_column, union_all, unpivoted
from tablescout.operators.conform import LINEAGE_COLUMNS

_NOTHING = "cast(NULL AS string)"
_IDS = T.StructType(
    [T.StructField("C", T.IntegerType())] + [T.StructField(n, T.StringType()) for n in ("TARGET_TABLE", "TARGET_COLUMN", "DATA_TYPE")]
)


def columns_to_profile(
    latest_columns: DataFrame, source_system: str | None = None, limit: int | None = None
) -> DataFrame:
    """Cataloged columns in profiling order, optionally of one system and only the first few."""
    if source_system:
        latest_columns = latest_columns.where(F.col("SOURCE_SYSTEM") == source_system)
    ordered = latest_columns.select(
        "SOURCE_SYSTEM", "TARGET_DATABASE", "TARGET_SCHEMA", "TARGET_TABLE", "TARGET_COLUMN", "TARGET_DATA_TYPE"
    ).orderBy("SOURCE_SYSTEM", "TARGET_TABLE", "TARGET_COLUMN")
    return ordered if limit is None else ordered.limit(limit)


def profile_cataloged(
    spark: SparkSession, frames: Mapping[str, DataFrame], columns: DataFrame, signed_zeros: bool = False
) -> DataFrame:
    """Profile of the cataloged columns given by ``columns_to_profile``."""
    rows = catalog_rows(columns)
    return profile_tables(
        spark,
        frames,
        [(r.TARGET_TABLE, r.TARGET_COLUMN) for r in rows],
        {(r.TARGET_TABLE, r.TARGET_COLUMN): r.TARGET_DATA_TYPE for r in rows},
        signed_zeros,
    )


def _distinct_cells(frames: Mapping[str, DataFrame], kind: str, cells: list[Cell], signed_zeros: bool) -> DataFrame:
    """Per distinct value: its rows, filled rows, values, and its text where that is cheap to carry.

    A zero has two texts when signs count: the least and the greatest of them are carried.
    """
    rows = unpivoted(frames, cells)
    if kind in ("string", "nested"):
        rows, keys, value, text = digested(rows), ["C", "HASHED", "K"], "K", _NOTHING
    else:
        keys, value, text = ["C", "V"], "V", text_form("V", kind) if has_text_order(kind) else _NOTHING
    filled, low, high, counts = f"{value} IS NOT NULL", text, text, [F.count(F.lit(1)).alias("N")]
    if signed_zeros and kind in FRACTIONAL:
        counts.append(F.count_if(F.expr(is_negative_zero("V"))).alias("SIGNED"))
        low, high = (f"CASE WHEN {test} THEN '-0.0' ELSE {text} END" for test in ("SIGNED > 0", "SIGNED = N"))
    return rows.groupBy(*keys).agg(*counts).selectExpr(
        "C",
        "N AS ROWS",
        f"CASE WHEN {filled} THEN N ELSE 0L END AS FILLED",
        f"cast({filled} AS bigint) AS VALUES",
        f"{low} AS LO",
        f"{high} AS HI",
    )


def _extremes(frame: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """MIN and MAX of text columns: a partial aggregate per task, no shuffle of the texts."""
    pairs = [f"struct({i} AS C, min({quoted(c)}) AS LO, max({quoted(c)}) AS HI)" for i, c in columns]
    found = frame.agg(F.expr(f"array({', '.join(pairs)})").alias("E")).selectExpr("inline(E)")
    return found.selectExpr("C", "0L AS ROWS", "0L AS FILLED", "0L AS VALUES", "LO", "HI")


def profile_tables(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    columns: Iterable[tuple[str, str]] | None = None,
    data_types: Mapping[tuple[str, str], str] | None = None,
    signed_zeros: bool = False,
) -> DataFrame:
    """Rows, non-NULL, NULL and distinct counts, ratios, and MIN / MAX of the text form per column.

    Each column is unpivoted and counted once per distinct value with map-side combining, so
    neither wide tables nor frequent values blow up the shuffle.  (Several COUNT(DISTINCT)s in one
    aggregate would expand every row once per column with all columns in it.)  MIN / MAX of text
    columns come from a second, shuffle-free pass over just those columns, so that long texts
    need not be shuffled.

    ``-0.0`` and ``0.0`` are one value.  With `signed_zeros` the bounds are those of the texts that SQL casts them to,
    ``-0.0`` among them; without, both read as ``0.0``.
    """
    if columns is None:
        columns = [(t, c) for t, frame in frames.items() for c in frame.columns if c not in LINEAGE_COLUMNS]
    kinds: dict[str, list[Cell]] = {}
    texts: dict[str, list[tuple[str, str]]] = {}
    columns = [(table, column) for table, column in columns if has_column(frames, table, column)]
    dtypes = {table: dict(frame.dtypes) for table, frame in frames.items()}
    ids = []
    for position, (table, column) in enumerate(columns):
        cell_id, dtype = str(position), dtypes[table][column]
        declared = (data_types or {}).get((table, column), dtype)
        ids.append({"C": position, "TARGET_TABLE": table, "TARGET_COLUMN": column, "DATA_TYPE": declared})
        if dtype == "string":
            texts.setdefault(table, []).append((cell_id, column))
        kind = "bigint" if dtype in INTEGRAL else "nested" if is_nested(dtype) else dtype
        value = in_domain(column, dtype, "string" if kind == "nested" else kind)
        kinds.setdefault(kind, []).append(Cell(cell_id, table, value))

    if not ids:
        raise ValueError("no columns to profile")
    measured = union_all(
        [_distinct_cells(frames, kind, cells, signed_zeros) for kind, cells in kinds.items()]
        + [_extremes(frames[table], group) for table, group in texts.items()]
    )
    names = ["TARGET_TABLE", "TARGET_COLUMN", "DATA_TYPE"]
    # The column names join the same final aggregate as rows of their own.
    seeds = local_frame(spark, ids, _IDS).selectExpr(
        "C", "0L AS ROWS", "0L AS FILLED", "0L AS VALUES", f"{_NOTHING} AS LO", f"{_NOTHING} AS HI", *names
    )
    counted = (
        measured.unionByName(seeds, allowMissingColumns=True)
        .groupBy("C")
        .agg(
            *[F.max(n).alias(n) for n in names],
            F.sum("ROWS").alias("ROW_COUNT"),
            F.sum("FILLED").alias("NON_NULL_COUNT"),
            F.sum("VALUES").alias("DISTINCT_COUNT"),
            F.min("LO").alias("MIN_VALUE"),
            F.max("HI").alias("MAX_VALUE"),
        )
    )
    return counted.select(
        "TARGET_TABLE",
        "TARGET_COLUMN",
        "DATA_TYPE",
        "ROW_COUNT",
        "NON_NULL_COUNT",
        (F.col("ROW_COUNT") - F.col("NON_NULL_COUNT")).alias("NULL_COUNT"),
        "DISTINCT_COUNT",
        ratio(F.col("DISTINCT_COUNT"), F.col("ROW_COUNT")).alias("DISTINCT_RATIO"),
        ratio(F.col("NON_NULL_COUNT"), F.col("ROW_COUNT")).alias("NON_NULL_RATIO"),
        "MIN_VALUE",
        "MAX_VALUE",
    )
