"""The value index of a store: written once for a version of a table, then followed by deltas.

All tables of a job are indexed together.  A folder holds the rows of the tables of one job, laid out by table and by
hash bucket of the value, so that equal values of different tables are in one bucket.  The newest row of VALUE_INDEX
names the folders of a table and its columns; a delta adds a folder, and folders are folded into one when there are
more than MOST_FOLDERS.  Profile, overlap, cardinality and the key views read these folders, not the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping
from datetime import UTC, datetime
from itertools import batched
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.values import quoted
from tablescout.local import catalog_rows, local_frame
from tablescout.operators.cardinality import classified, edge_columns
from tablescout.operators.cells import LONG_TEXT_BYTES, union_all
from tablescout.operators.merge import latest_per_key
from tablescout.operators.value_index import (
    column_profiles, column_sets, distinct_values, folded, indexed_columns, is_own_key, joined_delta, joined_keys, key_counts,
    key_rows, least_rate, matches, negated, overlap_of, profile_of, still_possible, text_extremes, value_rows, values_of_sets,
    with_ids, with_keys,
)
from tablescout.operators.views import Edge, bridge_of_keys, summary_of_keys
from tablescout.plans.store import TableStore, new_run_id

ROWS = "C int, V string, K string, N long, SIGNED long, T string, BUCKET int"
_COLUMNS = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("ID", "C")]
    + [T.StructField(n, T.StringType()) for n in ("T", "TARGET_TABLE", "TARGET_COLUMN", "DATA_TYPE", "TEXT_LO", "TEXT_HI")]
)

MOST_FOLDERS = 8
# Share of the buckets that is looked at first when pairs below a label are not wanted.
FIRST_SHARE = 8


class Entry(NamedTuple):
    """What the catalog knows of an indexed table."""

    version: str | None
    folders: tuple[str, ...]
    buckets: int
    columns: tuple[tuple[str, str, str | None, str | None], ...]  # name, type, least and greatest text


class ValueIndex:
    """The indexes of the tables of a store."""

    def __init__(self, store: TableStore, buckets: int = 16):
        self.store = store
        self.spark = store.spark
        self.buckets = buckets

    # Writing

    def _path(self, folder: str) -> str:
        return f"{self.store.root}/_index/{folder}"

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Write rows (T, C, V, K, N, SIGNED); AQE gives writers even shares whatever the number of tables and buckets."""
        placed = rows.withColumn("BUCKET", F.pmod(F.xxhash64("V"), F.lit(self.buckets)).cast("int"))
        placed.hint("rebalance", F.col("T"), F.col("BUCKET")).write.partitionBy("T", "BUCKET").parquet(self._path(folder))

    def _commit(self, entries: Mapping[str, Entry]) -> None:
        now = datetime.now(UTC)
        names = ("NAME", "DATA_TYPE", "TEXT_LO", "TEXT_HI")
        self.store.append_rows("VALUE_INDEX", [
            {
                "TARGET_TABLE": table, "TABLE_VERSION": entry.version, "FOLDERS": list(entry.folders), "BUCKETS": entry.buckets,
                "COLUMNS": [dict(zip(names, column, strict=True)) for column in entry.columns], "COMMITTED_AT": now,
            }
            for table, entry in entries.items()
        ])

    def build(self, frames: Mapping[str, DataFrame], versions: Mapping[str, str] | None = None, tables_per_job: int = 50) -> dict[str, str]:
        """Index tables anew, many by one job; gives the errors of tables that could not be read.

        When a job fails, its tables are indexed one by one.
        """
        failures: dict[str, str] = {}
        for group in batched(frames.items(), tables_per_job):
            try:
                self._build(dict(group), versions or {})
            except Exception:  # find out which table it is
                for table, frame in group:
                    try:
                        self._build({table: frame}, versions or {})
                    except Exception as error:
                        failures[table] = str(error)
        return failures

    def _build(self, frames: Mapping[str, DataFrame], versions: Mapping[str, str]) -> None:
        folder, parts, seen = new_run_id(), [], {}
        for table, frame in frames.items():
            if indexed_columns(frame):
                rows, seen[table] = self._observed(frame)
                parts.append(rows.withColumn("T", F.lit(table)))
        if parts:
            self._write(union_all(parts), folder)
        self._commit({
            table: Entry(versions.get(table), (folder,) if table in seen else (), self.buckets, _with_extremes(frame, seen.get(table, dict)()))
            for table, frame in frames.items()
        })

    @staticmethod
    def _observed(frame: DataFrame) -> tuple[DataFrame, Callable[[], Mapping]]:
        """Index rows, and a function that gives the least and greatest texts seen when these have been written."""
        watched = [c.alias(name) for name, c in text_extremes(frame).items()]
        if not watched:
            return value_rows(frame), dict
        seen = Observation()

        def found() -> Mapping:
            try:
                return seen.get
            except Py4JJavaError:  # of a table that is empty for the optimizer nothing is observed
                return frame.agg(*watched).first().asDict()

        return value_rows(frame, frame.observe(seen, *watched)), found

    def follow(self, table: str, removed: DataFrame, added: DataFrame, current: DataFrame, version: str | None = None) -> None:
        """Bring the index of a table to its next version, from the rows that are gone and those that are new.

        An update is both.  Costs what the two are in size; `current`, the table after the change, is read only for
        text columns with long texts whose least or greatest text was among the removed ones.
        """
        entry = self.entries()[table]
        if indexed_columns(removed) != indexed_columns(added) or [c[:2] for c in entry.columns] != indexed_columns(added):
            raise ValueError(f"columns differ from the index of {table}, build it anew")
        folder = new_run_id()
        (minus, gone), (plus, new) = self._observed(removed), self._observed(added)
        self._write(folded(union_all([negated(minus), plus]), ["C"]).withColumn("T", F.lit(table)), folder)
        columns = self._followed(table, entry, gone(), new(), current)
        entry = Entry(version, (*entry.folders, folder), entry.buckets, columns)
        if len(entry.folders) > MOST_FOLDERS:
            whole = new_run_id()
            self._write(self._read(table, entry), whole)
            entry = entry._replace(folders=(whole,))
        self._commit({table: entry})

    def _followed(self, table: str, entry: Entry, gone: Mapping, new: Mapping, current: DataFrame) -> tuple:
        """Columns with their extremes after a delta."""
        out, stale = [], {}
        for number, (name, dtype, low, high) in enumerate(entry.columns):
            if dtype == "string":
                lost = {bound: gone[f"{bound}{number}"] for bound in ("LO", "HI")}
                came = {bound: new[f"{bound}{number}"] for bound in ("LO", "HI")}
                if low is not None and (lost["LO"] == low or lost["HI"] == high):
                    stale[number] = name
                low = min((x for x in (low, came["LO"]) if x is not None), default=None)
                high = max((x for x in (high, came["HI"]) if x is not None), default=None)
            out.append((name, dtype, low, high))
        if stale:
            # short texts are in the index themselves
            long = self._read(table, entry).where(f"octet_length(V) > {LONG_TEXT_BYTES}").where(F.col("C").isin(*stale))
            stale = {r.C: stale[r.C] for r in long.select("C").distinct().collect()}
        if stale:
            bounds = [f(F.col(quoted(name))).alias(f"{b}{c}") for c, name in stale.items() for b, f in (("LO", F.min), ("HI", F.max))]
            found = current.agg(*bounds).first()
            for c, name in stale.items():
                out[c] = (name, "string", found[f"LO{c}"], found[f"HI{c}"])
        return tuple(out)

    # Reading

    def entries(self) -> dict[str, Entry]:
        """The current index of every table."""
        newest = latest_per_key(self.store.read("VALUE_INDEX"), ["TARGET_TABLE"], [F.desc("COMMITTED_AT")])
        return {
            row.TARGET_TABLE: Entry(row.TABLE_VERSION, tuple(row.FOLDERS), row.BUCKETS, tuple(tuple(c) for c in row.COLUMNS))
            for row in catalog_rows(newest)
        }

    def _chosen(self, tables: Iterable[str] | None) -> dict[str, Entry]:
        entries = self.entries()
        return entries if tables is None else {t: entries[t] for t in tables if t in entries}

    def columns(self, entries: Mapping[str, Entry], used: Collection[tuple[str, str]] | None = None) -> DataFrame:
        """Numbered columns of indexed tables; of those (table, column) only that are used, where they are given."""
        known = [
            (t, c, column) for t in sorted(entries) for c, column in enumerate(entries[t].columns)
            if used is None or (t, column[0]) in used
        ]
        return local_frame(self.spark, [
            {"ID": i, "T": t, "C": c, "TARGET_TABLE": t, "TARGET_COLUMN": name, "DATA_TYPE": dtype, "TEXT_LO": low, "TEXT_HI": high}
            for i, (t, c, (name, dtype, low, high)) in enumerate(known)
        ], _COLUMNS)

    def _folder(self, folder: str) -> DataFrame:
        return self.spark.read.schema(ROWS).parquet(self._path(folder))

    def _read(self, table: str, entry: Entry) -> DataFrame:
        parts = [self._folder(f).where(F.col("T") == table) for f in entry.folders]
        return parts[0].drop("BUCKET") if len(parts) == 1 else folded(union_all(parts), ["T", "C"])

    def rows(self, entries: Mapping[str, Entry], wanted: Column | None = None, columns: DataFrame | None = None) -> DataFrame:
        """(ID, V, K, N, SIGNED) of indexed tables, of the wanted buckets, with the numbers of the given columns; rows of
        other columns are not there."""
        single: dict[str, list[str]] = {}
        several: dict[str, list[str]] = {}
        for table, entry in entries.items():
            for folder in entry.folders:
                (single if len(entry.folders) == 1 else several).setdefault(folder, []).append(table)

        def read(folders: Mapping[str, list[str]]) -> list[DataFrame]:
            parts = [self._folder(f).where(F.col("T").isin(tables)) for f, tables in folders.items()]
            return [p if wanted is None else p.where(wanted) for p in parts]

        names = ["V", "K", "N", "SIGNED"]
        parts = [p.select("T", "C", *names) for p in read(single)]
        if several:
            parts.append(folded(union_all(read(several)), ["T", "C"]).select("T", "C", *names))
        if not parts:
            return self.spark.createDataFrame([], "ID int, V string, K string, N long, SIGNED long")
        numbered = self.columns(entries) if columns is None else columns
        return with_keys(union_all(parts).join(numbered.select("T", "C", "ID"), ["T", "C"]).select("ID", *names))

    def profile(self, tables: Iterable[str] | None = None, signed_zeros: bool = False) -> DataFrame:
        """Column profiles as `profile_tables` gives them, from the index."""
        entries = self._chosen(tables)
        return profile_of(column_profiles(self.rows(entries), signed_zeros), self.columns(entries))

    def held(self, frame: DataFrame, name: str) -> DataFrame:
        """A frame written to the store's folder and read back, for steps that need it more than once."""
        path = f"{self.store.root}/_index/_{name}/{new_run_id()}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def overlap(self, pairs: DataFrame, min_label: str = "WEAK") -> DataFrame:
        """Overlap rows as `value_overlap` gives them, from the index.

        Every value is reduced to the set of columns that hold it; sets, not pairs, are shuffled.  With a least label
        a share of the hash buckets is looked at first: pairs that can no longer reach it are out, and of the other
        buckets only columns of the remaining pairs are read.
        """
        entries, pairs = self.entries(), self.held(pairs, "pairs")
        sides = [pairs.select(F.col(f"{side}_TABLE").alias("T"), F.col(f"{side}_COLUMN").alias("N")) for side in ("PARENT", "CHILD")]
        entries, used = _used(entries, union_all(sides).distinct())
        columns = self.columns(entries, used)
        pairs = with_ids(pairs, columns, {"PARENT": "PARENT_ID", "CHILD": "CHILD_ID"})

        def sets(left: DataFrame, wanted: Column | None) -> DataFrame:
            rows = self.rows(entries, wanted, columns)
            if wanted is not None:
                rows = rows.join(union_all(left.select(F.col(c).alias("ID")) for c in ("PARENT_ID", "CHILD_ID")).distinct(), "ID", "left_semi")
            return self.held(column_sets(rows, len(used)), "sets")

        rate = least_rate(min_label)
        first = max(1, self.buckets // FIRST_SHARE)
        if rate == 0 or first == self.buckets:
            whole = sets(pairs, None)
            return overlap_of(pairs, matches(whole, pairs), values_of_sets(whole), min_label)
        totals = self.held(distinct_values(self.rows(entries, None, columns)), "totals")
        seen = sets(pairs, F.col("BUCKET") < first)
        found = self.held(matches(seen, pairs), "matches")
        pairs = self.held(still_possible(pairs, found, values_of_sets(seen), totals, rate), "pairs")
        found = union_all([found, matches(sets(pairs, F.col("BUCKET") >= first), pairs)])
        summed = found.groupBy("PARENT_ID", "CHILD_ID").agg(F.sum("MATCH_COUNT").alias("MATCH_COUNT"))
        return overlap_of(pairs, summed, totals, min_label)

    def cardinality(self, edges: DataFrame) -> DataFrame:
        """Edges with key counts and class as `detect_cardinality` gives them, from the index.

        Only values that may share a key are grouped by it; others are counted as they are.
        """
        entries, used = _used(self.entries(), edge_columns(edges))
        columns = self.columns(entries, used)
        own = F.col("DATA_TYPE").isin([d for d in sorted({c[1] for entry in entries.values() for c in entry.columns}) if is_own_key(d)])

        plain, texts = (self.rows(entries, columns=columns.where(some)) for some in (own, ~own))
        counts = union_all([key_counts(plain.where("V IS NOT NULL").select("ID", "N")), key_counts(key_rows(texts))])
        numbered = columns.select("ID", "T", F.col("TARGET_COLUMN").alias("N"))
        return classified(edges, numbered.join(counts, "ID", "left").drop("ID"))

    def keys(self, table: str, column: str, folders: Iterable[str] | None = None) -> DataFrame:
        """(K, N): rows of each normalised key of a column; of some of its folders only, where they are given."""
        entry = self.entries()[table]
        if folders is not None:
            entry = entry._replace(folders=tuple(folders))
        number = [c[0] for c in entry.columns].index(column)
        rows = with_keys(self._read(table, entry).where(F.col("C") == number))
        return key_rows(rows.withColumnRenamed("C", "ID")).select("K", "N").where("N <> 0")

    def _short_keys(self, edge: Edge) -> list[DataFrame]:
        sides = [self.keys(edge.from_table, edge.from_column), self.keys(edge.to_table, edge.to_column)]
        long = sides[0].join(sides[1], "K").where(f"octet_length(K) > {LONG_TEXT_BYTES}")
        if not long.isEmpty():
            raise ValueError("keys of long texts are in the index as digests, make the view from the tables")
        return sides

    def bridge(self, edge: Edge) -> DataFrame:
        """The bridge view of an edge, from the index."""
        parents, children = self._short_keys(edge)
        return bridge_of_keys(parents.select("K"), children.select("K"), edge)

    def summary(self, edge: Edge) -> DataFrame:
        """The summary view of an edge, from the index."""
        return summary_of_keys(joined_keys(*self._short_keys(edge)), edge)

    def summary_delta(self, edge: Edge, before: Mapping[str, Entry]) -> DataFrame:
        """(K, JOINED_ROW_COUNT): what the deltas since `before` add to the summary of an edge.

        Only keys of a delta are looked up.  A table whose folders were folded since has no delta any more.
        """
        now, sides = self.entries(), []
        for table, column in ((edge.from_table, edge.from_column), (edge.to_table, edge.to_column)):
            old = before[table].folders
            if now[table].folders[: len(old)] != old:
                raise ValueError(f"{table} was indexed anew, make the summary anew")
            new = now[table].folders[len(old) :]
            empty = self.spark.createDataFrame([], "K string, N long")
            sides.append((self.keys(table, column, old), self.keys(table, column, new) if new else empty))
        (parent, parent_delta), (child, child_delta) = sides
        return joined_delta(parent, parent_delta, child, child_delta)

    def summary_after(self, edge: Edge, summary: DataFrame, before: Mapping[str, Entry]) -> DataFrame:
        """A stored summary view brought up to date; keys that join no more are gone."""
        known = summary.select(F.col("PARENT_KEY_VALUE").alias("K"), "JOINED_ROW_COUNT")
        total = union_all([known, self.summary_delta(edge, before)]).groupBy("K").agg(F.sum("JOINED_ROW_COUNT").alias("JOINED_ROW_COUNT"))
        return summary_of_keys(total.where("JOINED_ROW_COUNT <> 0"), edge)


def _with_extremes(frame: DataFrame, found: Mapping) -> tuple:
    return tuple(
        (name, dtype, found.get(f"LO{number}"), found.get(f"HI{number}"))
        for number, (name, dtype) in enumerate(indexed_columns(frame))
    )


def _used(entries: Mapping[str, Entry], columns: DataFrame) -> tuple[dict[str, Entry], set[tuple[str, str]]]:
    """Tables with any of the columns (T, N), and those of the columns that are indexed."""
    asked = {(r.T, r.N) for r in catalog_rows(columns)}
    used = {(t, c[0]) for t, entry in entries.items() for c in entry.columns} & asked
    return {t: entries[t] for t in sorted({t for t, _ in used})}, used
