"""Identifier cleaning, entity names and view names as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifiers that get a _COL suffix.
RESERVED_WORDS = [
    "START", "END", "TEXT", "DATE", "TIME", "TIMESTAMP", "USER",
    "CURRENT", "GROUP", "ORDER", "BY", "SELECT", "FROM", "WHERE",
    "TABLE", "COLUMN", "VALUE", "VALUES", "TYPE", "LEVEL", "COPY",
]

# Entity keywords, first match wins.  The graph list has no line-level entity,
# the model list tests it first.
GRAPH_KEYWORDS = ["INVOICE", "ORDER", "ESTIMATE", "CONTACT", "CUSTOMER", "CAMPUS"]
MODEL_KEYWORDS = ["ESTIMATE_LINE", "INVOICE", "ORDER", "ESTIMATE", "CONTACT", "CUSTOMER", "CAMPUS"]

# Parts removed from a column name, in this order, before comparing bases.
KEY_NAME_PARTS = ["_ID", "ID", "_NUMBER", "NUMBER", "_CODE", "CODE", "_KEY", "KEY"]

# Suffixes naming the kind of database in a source system name.
SYSTEM_SUFFIXES = ("_REDSHIFT", "_SQLSERVER")


def clean_identifier(name: Column) -> Column:
    spaced = F.regexp_replace(F.upper(name), "[^A-Z0-9_]+", "_")
    bare = F.regexp_replace(F.regexp_replace(spaced, "_+", "_"), "^_|_$", "")
    named = F.when(bare == "", "UNNAMED_COL").otherwise(bare)
    lettered = F.when(named.rlike("^[0-9]"), F.concat(F.lit("COL_"), named)).otherwise(named)
    return F.when(lettered.isin(RESERVED_WORDS), F.concat(lettered, F.lit("_COL"))).otherwise(lettered)


def target_table_name(source_table: Column, suffix: str) -> Column:
    return F.concat(clean_identifier(source_table), F.lit(suffix))


def remove_all(text: Column, parts: Iterable[str]) -> Column:
    """Drop every occurrence of each part, in order, wherever it stands."""
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(""))
    return text


@dataclass(frozen=True)
class Naming:
    """What to strip from table and source system names, set per deployment."""

    suffixes: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    ignored_parts: tuple[str, ...] = ()
    system_suffixes: tuple[str, ...] = SYSTEM_SUFFIXES

    def without_suffix(self, table: Column) -> Column:
        return remove_all(F.upper(table), self.suffixes)

    def base_name(self, table: Column) -> Column:
        return remove_all(self.without_suffix(table), self.prefixes)

    def system_name(self, source_system: Column) -> Column:
        return remove_all(F.upper(source_system), self.system_suffixes)

    def _entity(self, table: Column, keywords: list[str], fallback: Column) -> Column:
        upper = F.upper(table)
        result = None
        for word in keywords:
            hit = upper.contains(word)
            if word == "ESTIMATE_LINE" and self.ignored_parts:
                hit = hit | remove_all(upper, self.ignored_parts).contains(word)
            result = F.when(hit, word) if result is None else result.when(hit, word)
        return result.otherwise(fallback)

    def graph_entity(self, table: Column) -> Column:
        return self._entity(table, GRAPH_KEYWORDS, self.without_suffix(table))

    def model_entity(self, table: Column) -> Column:
        return self._entity(table, MODEL_KEYWORDS, self.without_suffix(table))

    def view_entity(self, table: Column) -> Column:
        return self._entity(table, MODEL_KEYWORDS, self.base_name(table))

    def entity_view(self, entity: Column, source_system: Column) -> Column:
        return F.concat(F.lit("V_"), entity, F.lit("_"), self.system_name(source_system))

    def relationship_view(self, parent: Column, child: Column, source_system: Column) -> Column:
        return F.concat(
            F.lit("V_"), self.base_name(parent), F.lit("_WITH_"), self.base_name(child),
            F.lit("_"), self.system_name(source_system),
        )

    def _link_view(self, kind: str, parent: Column, child: Column, column: Column, system: Column) -> Column:
        return F.concat(
            F.lit(f"V_{kind}_"), self.base_name(parent), F.lit("_TO_"), self.base_name(child),
            F.lit("_BY_"), F.upper(column), F.lit("_"), self.system_name(system),
        )

    def bridge_view(self, parent: Column, child: Column, column: Column, source_system: Column) -> Column:
        return self._link_view("BRIDGE", parent, child, column, source_system)

    def summary_view(self, parent: Column, child: Column, column: Column, source_system: Column) -> Column:
        return self._link_view("SUMMARY", parent, child, column, source_system)

    def column_alias(self, table: str, column: str) -> str:
        """Alias of a child column whose name the parent already has (driver-side, per column)."""
        base = table.upper()
        for part in (*self.suffixes, *self.prefixes):
            base = base.replace(part, "")
        return f"{base}_{column.upper()}"


def name_base(column: Column) -> Column:
    return remove_all(F.upper(column), KEY_NAME_PARTS)


def compatible_names(parent: Column, child: Column) -> Column:
    up_parent, up_child = F.upper(parent), F.upper(child)
    base = name_base(parent)
    return (
        up_child.contains(up_parent)
        | up_parent.contains(up_child)
        | ((base != "") & (base == name_base(child)))
    )
