"""Turning columns of many tables into (column id, value) rows, each column read once.

Columns are unpivoted with columns of the same type, so values stay typed: grouping on longs
or doubles is far cheaper than grouping on their text, and text is only made per distinct value.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

# Longer texts are grouped by their SHA-256, so whole documents are not shuffled.
LONG_TEXT_BYTES = 64

# Columns unpivoted at once.  Wide tables are read in groups of columns: no column is read twice,
# and the generated code of one unpivot stays small.
COLUMNS_PER_UNPIVOT = 64


@dataclass(frozen=True)
class Cell:
    """A column to unpivot: its id (a number), table, and the SQL expression of its value."""

    id: str
    table: str
    value: str


def has_column(frames: Mapping[str, DataFrame], table: str, column: str) -> bool:
    """Whether a cataloged column is there; one that is not is skipped with a warning."""
    found = table in frames and column in frames[table].columns
    if not found:
        warnings.warn(f"{table}.{column} is cataloged but not readable; skipped", stacklevel=3)
    return found


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def unpivoted(frames: Mapping[str, DataFrame], cells: Iterable[Cell]) -> DataFrame:
    """(C, V) rows of all given cells, which must have one type; each column is scanned once.

    C is a number: what is grouped by (C, V) is then of fixed width, which is a fifth to a third cheaper than with text.
    """
    by_table: dict[str, list[str]] = {}
    for cell in cells:
        by_table.setdefault(cell.table, []).append(f"{cell.value} AS `{cell.id}`")
    return union_all(
        frames[table].selectExpr(*values[start : start + COLUMNS_PER_UNPIVOT]).unpivot([], None, "C", "V")
        .selectExpr("cast(C AS int) AS C", "V")
        for table, values in by_table.items()
        for start in range(0, len(values), COLUMNS_PER_UNPIVOT)
    )


def digested(rows: DataFrame) -> DataFrame:
    """(C, HASHED, K): long texts replaced by their digest, kept apart from equal-looking short ones."""
    hashed = f"octet_length(V) > {LONG_TEXT_BYTES}"
    return rows.selectExpr(
        "C", f"coalesce({hashed}, false) AS HASHED", f"CASE WHEN {hashed} THEN sha2(V, 256) ELSE V END AS K"
    )
