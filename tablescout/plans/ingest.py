"""Ingestion: discover, conform, load, merge, validate, watermark and catalog a source schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime
from time import perf_counter

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.names import target_table_name
from tablescout.functions.rules import counts_match, counts_text, load_status
from tablescout.functions.values import watermark_text
from tablescout.local import catalog_rows, local_frame
from tablescout.operators.catalog import latest_watermarks
from tablescout.operators.conform import ColumnPlan, column_plan, conform, planned_columns, with_lineage
from tablescout.operators.merge import duplicate_keys, key_bucket, latest_per_key, merge_upsert
from tablescout.plans.store import BUCKET, FILE, State, TableStore, Version, new_run_id
from tablescout.schemas import WATERMARK_KEY
from tablescout.sources.base import Source, Watermark, discover_tables, unknown_tables

MODES = ("full_refresh", "incremental", "incremental_plan")
FULL = "full_refresh"
APPENDED, MERGED = "appended", "merged"
BY_TIMESTAMP = "timestamp"

# Names of validations, and how much of an error is kept.
COUNT_CHECK = "SOURCE_LOADED_TARGET_ROW_COUNT_MATCH"
LOAD_ERROR = "TABLE_LOAD_ERROR"
ERROR_TEXT_LENGTH = 500

# Folders that the buckets of a version may be spread over before a merge writes it whole.
MOST_PARTS = 32

# Keys of a delta that are looked up one by one in the files of a table; more are joined.
MOST_LOOKUPS = 1000


@dataclass(frozen=True)
class IncrementalTable:
    """How a table is loaded incrementally; without a primary key its delta is appended."""

    watermark_column: str
    primary_key: Sequence[str] = ()
    # What to do when a delta holds a key twice: "raise", or keep the "latest" by watermark.
    on_duplicate: str = "raise"


@dataclass(frozen=True)
class Target:
    database: str
    schema: str
    suffix: str = ""


@dataclass(frozen=True)
class LoadOptions:
    mode: str = FULL
    include: Sequence[str] = ()
    exclude: Sequence[str] = ()
    incremental: Mapping[str, IncrementalTable] = field(default_factory=dict)
    strict_boolean: bool = True
    # Buckets of tables with a primary key; a merge rewrites only touched buckets.  Size them to
    # about a gigabyte each: 64 suits a table of tens of gigabytes, thousands one of terabytes.
    merge_buckets: int = 64
    # Tables loaded at the same time.
    parallel_tables: int = 4


# What happened to one table; the catalogs are derived from these rows.
FACTS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("SOURCE_TABLE", "TARGET_TABLE", "STRATEGY", "ERROR")]
    + [T.StructField(n, T.LongType()) for n in ("SOURCE_ROWS", "LOADED_ROWS", "TARGET_ROWS", "PLANNED_ROWS")]
    + [
        T.StructField("MERGED", T.BooleanType()),
        T.StructField("LOAD_SECONDS", T.DoubleType()),
        T.StructField("LOADED_AT", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Change:
    """What a load has written of a table, and upon what: enough to bring it upon a later version."""

    target_table: str
    kind: str
    base: Version | None
    version: Version | None = None
    folder: str | None = None
    # of a merge: the buckets that its folder holds, the files it stands for, the staged rows and their key
    touched: tuple[int, ...] = ()
    files: tuple[str, ...] = ()
    stage: DataFrame | None = None
    key: tuple[str, ...] = ()
    # the watermark that the load started from, and the one it reached
    mark_key: tuple | None = None
    since: Watermark | None = None
    new_watermark: dict | None = None


def load_strategy(mode: str, config: IncrementalTable | None, since: Watermark | None) -> str:
    """full_refresh, or timestamp for a configured table with a stored watermark."""
    if mode not in MODES:
        raise ValueError(f"unknown load mode: {mode}")
    return BY_TIMESTAMP if mode != FULL and config and since else FULL


def observed_write(
    rows: DataFrame, watermark: str | None, write: Callable[[DataFrame], None]
) -> tuple[int, str | None]:
    """Write rows and return (row count, newest watermark) measured by that same write.

    The observation sits directly under the write, in the final stage of the job, where Spark
    counts every task once even if tasks are retried.
    """
    seen = Observation()
    newest = F.lit(None).cast("string")
    if watermark:
        newest = watermark_text(F.max(watermark), rows.schema[watermark].dataType.simpleString())
    write(rows.observe(seen, F.count(F.lit(1)).alias("n"), newest.alias("newest")))
    result = seen.get
    return result["n"], result["newest"]


def gathered(rows: DataFrame) -> DataFrame:
    """Rows shuffled by bucket for writing.  Rebalancing lets AQE split large and join small buckets,
    so writers get even shares whatever the number of buckets or shuffle partitions."""
    return rows.hint("rebalance", F.col(BUCKET))


def laid_out(rows: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Rows of a keyed table carry their bucket and are gathered by it before the write."""
    if not key:
        return rows
    # maps and variants cannot be hashed
    hashed = [c for c, kind in rows.dtypes if c != "_INGESTED_AT" and "map<" not in kind and "variant" not in kind]
    return gathered(rows.withColumn(BUCKET, key_bucket(hashed, key, buckets)))


def check_schema(rows: DataFrame, current: Version) -> None:
    """There is no schema evolution: a delta must have the columns and types of its target."""
    expected = {f.name: f.dataType for f in current.schema if f.name != BUCKET}
    found = {f.name: f.dataType for f in rows.schema}
    changed = sorted(n for n in expected.keys() | found.keys() if expected.get(n) != found.get(n))
    if changed:
        raise ValueError(f"columns differ from the target, load it in full: {changed}")


def key_columns(plan: Sequence[ColumnPlan], names: Sequence[str]) -> tuple[str, ...]:
    """Target columns of key columns given by source or target name, in any case."""
    found = {c.target.lower(): c.target for c in plan} | {c.source.lower(): c.target for c in plan}
    missing = [name for name in names if name.lower() not in found]
    if missing:
        raise ValueError(f"no such key columns: {missing}")
    return tuple(found[name.lower()] for name in names)


def row_count_match() -> Column:
    """Whether the counts of a fact agree; never for a failed table, always for a planned one."""
    counts = [F.col(n) for n in ("SOURCE_ROWS", "LOADED_ROWS", "TARGET_ROWS")]
    failed, planned = F.col("ERROR").isNotNull(), F.col("PLANNED_ROWS").isNotNull()
    return F.when(failed, False).when(planned, True).otherwise(counts_match(F.col("STRATEGY"), *counts))


def table_catalog(facts: DataFrame, mode: str) -> DataFrame:
    """Table catalog rows of a run."""
    failed, planned = F.col("ERROR").isNotNull(), F.col("PLANNED_ROWS").isNotNull()
    counts = [F.col(n) for n in ("SOURCE_ROWS", "LOADED_ROWS", "TARGET_ROWS")]
    status = load_status(F.lit(mode), F.col("STRATEGY"), F.col("MERGED"), counts[0])
    return facts.select(
        "SOURCE_TABLE",
        "TARGET_TABLE",
        F.col("SOURCE_ROWS").alias("SOURCE_ROW_COUNT"),
        F.col("TARGET_ROWS").alias("TARGET_ROW_COUNT"),
        row_count_match().alias("ROW_COUNT_MATCH"),
        F.when(failed, "FAILED").when(planned, "PLANNED").otherwise(status).alias("LOAD_STATUS"),
        "LOAD_SECONDS",
        "LOADED_AT",
    )


def validation_results(facts: DataFrame, mode: str) -> DataFrame:
    """Validation rows of a run: the row count check, or the error of a failed table."""
    failed, planned = F.col("ERROR").isNotNull(), F.col("PLANNED_ROWS").isNotNull()
    counts = [F.col(n) for n in ("SOURCE_ROWS", "LOADED_ROWS", "TARGET_ROWS")]
    plan_text = F.format_string(
        "incremental_plan_only=true; source_total=%d; planned_rows_not_loaded=%d",
        F.col("SOURCE_ROWS"), F.col("PLANNED_ROWS"),
    )
    return facts.select(
        "TARGET_TABLE",
        F.when(failed, LOAD_ERROR).otherwise(COUNT_CHECK).alias("VALIDATION_NAME"),
        F.when(row_count_match(), "PASS").otherwise("FAIL").alias("VALIDATION_STATUS"),
        F.when(failed, F.left(F.col("ERROR"), F.lit(ERROR_TEXT_LENGTH)))
        .when(planned, plan_text)
        .otherwise(counts_text(F.col("STRATEGY"), *counts))
        .alias("VALIDATION_VALUE"),
        F.col("LOADED_AT").alias("VALIDATED_AT"),
    )


class Ingestion:
    """One run over the tables of a source."""

    def __init__(self, spark: SparkSession, source: Source, target: Target, store: TableStore,
                 options: LoadOptions = LoadOptions()):
        if options.mode not in MODES:
            raise ValueError(f"unknown load mode: {options.mode}")
        self.spark = spark
        self.source = source
        self.target = target
        self.store = store
        self.options = options
        self.run_id = new_run_id()
        self._place = {
            "RUN_ID": self.run_id,
            "SOURCE_SYSTEM": source.name,
            "SOURCE_DATABASE": source.database,
            "SOURCE_SCHEMA": source.schema,
            "TARGET_DATABASE": target.database,
            "TARGET_SCHEMA": target.schema,
        }
        self._versions: dict[str, Version] = {}
        self._watermarks: dict[tuple, Watermark] = {}
        # What the loads of this run have written, by source table, made current together at its end.
        self._changes: dict[str, Change] = {}
        self._attempt = 0

    # Run life-cycle

    def run(self) -> DataFrame:
        """Load every table, write the catalogs and return this run's table catalog rows."""
        base = {**self._place, "LOAD_MODE": self.options.mode, "STARTED_AT": datetime.now(UTC)}
        self.store.append_rows("INGESTION_RUN_LOG", [{**base, "STATUS": "RUNNING"}])
        try:
            outcomes = self._committed(self._load_all())
            self._write_catalogs(outcomes)
            failed = sum(fact["ERROR"] is not None for fact, _ in outcomes)
            self._finish(base, "PARTIAL_SUCCESS" if failed else "SUCCESS", f"{failed} table(s) failed" if failed else None)
        except Exception as error:
            self._finish(base, "FAILED", str(error))
            raise
        return self.store.read("INGESTION_TABLE_CATALOG").where(F.col("RUN_ID") == self.run_id)

    def _committed(self, outcomes: list[tuple[dict, list[dict]]]) -> list[tuple[dict, list[dict]]]:
        """Make all changes current by one record; where other runs have committed in between, upon what they left."""
        while True:
            state = self.store.state()
            for table, change in list(self._changes.items()):
                if self._outdated(change, state):
                    outcomes = self._rebased(table, change, state, outcomes)
            changes = self._changes.values()
            versions = {c.target_table: c.version for c in changes}
            marks = [c.new_watermark for c in changes if c.new_watermark]
            if not changes or self.store.commit(state.number + 1, versions, marks):
                return outcomes

    def _outdated(self, change: Change, state: State) -> bool:
        return state.versions.get(change.target_table) != change.base or self._moved(change, state)

    def _moved(self, change: Change, state: State) -> bool:
        """Whether the watermark is no longer the one that the load started from."""
        return change.mark_key in state.watermarks and _watermark(state.watermarks[change.mark_key]) != change.since

    def _rebased(self, table: str, change: Change, state: State, outcomes: list) -> list:
        """Bring a change upon what is current now; gives the outcomes of the run.

        A full load replaces whatever there is.  A delta whose rows others may have loaded is loaded again from the new
        watermark.  Other deltas keep what was written, unless their buckets have changed: then the staged rows are
        merged again.
        """
        self._attempt += 1
        current = state.versions.get(change.target_table)
        if change.kind == FULL:
            self._changes[table] = replace(change, base=current, since=self._since(change, state))
            return outcomes
        if self._moved(change, state) or current is None or change.kind == MERGED and current.key != change.version.key:
            del self._changes[table]
            self._versions, self._watermarks = state.versions, self._stored_watermarks()
            again = self._load_table(table, change.target_table)
            return [again if fact["SOURCE_TABLE"] == table else (fact, columns) for fact, columns in outcomes]
        if change.kind == APPENDED:
            version = current.with_part(change.folder)
        elif change.touched and current.buckets == change.version.buckets and current.layout(change.touched) == change.base.layout(change.touched):
            version = current.with_files(change.folder, change.files)
        elif change.stage is None:  # nothing was merged
            version = current
        else:
            version, change = self._merge_staged(change, current)
        self._changes[table] = replace(change, base=current, version=version)
        present = self.store.open(change.target_table, version).count()
        return [({**f, "TARGET_ROWS": present} if f["SOURCE_TABLE"] == table else f, columns) for f, columns in outcomes]

    def _since(self, change: Change, state: State) -> Watermark | None:
        row = state.watermarks.get(change.mark_key)
        return _watermark(row) if row else None

    def _finish(self, base: dict, status: str, message: str | None) -> None:
        row = {**base, "FINISHED_AT": datetime.now(UTC), "STATUS": status, "ERROR_MESSAGE": message}
        self.store.append_rows("INGESTION_RUN_LOG", [row])

    def _write_catalogs(self, outcomes: list[tuple[dict, list[dict]]]) -> None:
        place = {name: F.lit(value) for name, value in self._place.items()}
        if outcomes:
            facts = local_frame(self.spark, [fact for fact, _ in outcomes], FACTS)
            mode = self.options.mode
            self.store.append("INGESTION_TABLE_CATALOG", table_catalog(facts, mode).withColumns(place))
            self.store.append("INGESTION_VALIDATION_RESULTS", validation_results(facts, mode).withColumns(place))
        columns = [{**row, **self._place} for _, rows in outcomes for row in rows]
        self.store.append_rows("INGESTION_COLUMN_CATALOG", columns)

    def _load_all(self) -> list[tuple[dict, list[dict]]]:
        options = self.options
        missing = unknown_tables(self.source, options.include) if options.include else []
        found = discover_tables(self.source, options.include, options.exclude).select(
            "TABLE_NAME", target_table_name(F.col("TABLE_NAME"), self.target.suffix).alias("TARGET_TABLE")
        )
        pairs = [(row.TABLE_NAME, row.TARGET_TABLE) for row in catalog_rows(found)]
        # Versions and watermarks are read once for all tables.
        self._versions = self.store.versions()
        self._watermarks = self._stored_watermarks() if options.incremental else {}
        outcomes = [(self._failure(name, None, "table not found in the source", 0.0), []) for name in missing]
        with ThreadPoolExecutor(max(1, options.parallel_tables)) as pool:
            outcomes += pool.map(inheritable_thread_target(self.spark)(lambda pair: self._load_table(*pair)), pairs)
        return outcomes

    def _failure(self, table: str, target_table: str | None, error: str, seconds: float) -> dict:
        return {
            "SOURCE_TABLE": table, "TARGET_TABLE": target_table, "ERROR": error, "LOAD_SECONDS": seconds,
            "LOADED_AT": datetime.now(UTC),
        }

    def _load_table(self, table: str, target_table: str) -> tuple[dict, list[dict]]:
        """Facts and column catalog rows of one table; a failure is recorded, not raised."""
        start = perf_counter()
        try:
            planned = catalog_rows(planned_columns(self.source.columns(table), self.source.dialect))
            fact = {
                "SOURCE_TABLE": table, "TARGET_TABLE": target_table, "ERROR": None,
                **self._load(table, target_table, column_plan(planned)),
                "LOAD_SECONDS": perf_counter() - start, "LOADED_AT": datetime.now(UTC),
            }
            columns = [
                {**row.asDict(), "TARGET_TABLE": target_table, "CATALOGED_AT": fact["LOADED_AT"]} for row in planned
            ]
            return fact, columns
        except Exception as error:  # one bad table must not stop the others
            return self._failure(table, target_table, str(error), perf_counter() - start), []

    # Watermarks

    def _watermark_key(self, table: str, target_table: str, column: str) -> tuple:
        values = {**self._place, "SOURCE_TABLE": table, "TARGET_TABLE": target_table, "WATERMARK_COLUMN": column}
        return tuple(values[name] for name in WATERMARK_KEY)

    def _stored_watermarks(self) -> dict[tuple, Watermark]:
        own = self.store.read("INGESTION_WATERMARKS").where(F.col("SOURCE_SYSTEM") == self.source.name)
        return {
            tuple(row[name] for name in WATERMARK_KEY): Watermark(row.WATERMARK_VALUE, row.WATERMARK_TYPE)
            for row in catalog_rows(latest_watermarks(own))
        }

    def _new_watermark(self, key: tuple, newest: str, dtype: str) -> dict:
        return {
            **dict(zip(WATERMARK_KEY, key, strict=True)), "WATERMARK_VALUE": newest, "WATERMARK_TYPE": dtype,
            "LAST_SUCCESSFUL_RUN_ID": self.run_id, "UPDATED_AT": datetime.now(UTC),
        }

    def _folder(self) -> str:
        """Where this run writes: a folder of its own for each attempt."""
        return f"{self.run_id}-{self._attempt}" if self._attempt else self.run_id

    # Loading

    def _load(self, table: str, target_table: str, plan: list[ColumnPlan]) -> dict:
        options, source = self.options, self.source
        config = options.incremental.get(table)
        mark_key = config and self._watermark_key(table, target_table, config.watermark_column)
        # A watermark without a target is of no use: the table is loaded in full.
        since = self._watermarks.get(mark_key) if config and target_table in self._versions else None
        strategy = load_strategy(options.mode, config, since)
        current = self._versions.get(target_table)
        fact = {"STRATEGY": strategy, "SOURCE_ROWS": source.row_count(table), "MERGED": False}
        if options.mode == "incremental_plan":
            # Planning never writes rows, whatever is stored.
            planned = source.count_since(table, config.watermark_column, since) if config else fact["SOURCE_ROWS"]
            present = self.store.open(target_table, current).count() if current else 0
            return {**fact, "PLANNED_ROWS": planned, "LOADED_ROWS": 0, "TARGET_ROWS": present}

        rows = source.read_since(table, config.watermark_column, since) if strategy != FULL else source.read(table)
        conformed = with_lineage(
            conform(rows, plan, options.strict_boolean), source.name, source.database, source.schema, table
        )
        # The newest watermark comes from the very rows being written.
        watermark = key_columns(plan, [config.watermark_column])[0] if config else None
        key = key_columns(plan, config.primary_key) if config else ()
        fact["MERGED"] = strategy != FULL and bool(key)
        change = Change(target_table, FULL, self._versions.get(target_table), mark_key=mark_key, since=self._watermarks.get(mark_key))
        if strategy != FULL:
            check_schema(conformed, current)
        if strategy == FULL:
            version, loaded, newest = self._new_version(conformed, target_table, key, watermark)
            change = replace(change, version=version)
        elif fact["MERGED"]:
            change, loaded, newest = self._merge(change, conformed, key, watermark, config.on_duplicate)
        else:
            folder = self._folder()
            loaded, newest = self._write(laid_out(conformed, current.key, current.buckets), watermark, target_table, folder)
            change = replace(change, kind=APPENDED, version=current.with_part(folder), folder=folder)
        present = self.store.open(target_table, change.version).count()
        if newest is not None:
            change = replace(change, new_watermark=self._new_watermark(mark_key, newest, dict(rows.dtypes)[config.watermark_column]))
        self._changes[table] = change
        return {**fact, "LOADED_ROWS": loaded, "TARGET_ROWS": present}

    def _write(self, rows: DataFrame, watermark: str | None, table: str, folder: str, key: Sequence[str] = ()) -> tuple[int, str | None]:
        path = self.store.path(table, folder)

        def write(observed: DataFrame) -> None:
            writer = self._saved(observed, key) if BUCKET in observed.columns else observed.write
            writer.mode("overwrite").parquet(path)

        return observed_write(rows, watermark, write)

    def _new_version(self, rows: DataFrame, target_table: str, key: tuple[str, ...],
                     watermark: str | None) -> tuple[Version, int, str | None]:
        """Write rows as a version of their own."""
        placed = laid_out(rows, key, self.options.merge_buckets)
        version = Version(self._folder(), placed.schema, key, self.options.merge_buckets if key else 0)
        loaded, newest = self._write(placed, watermark, target_table, version.name, key)
        return version, loaded, newest

    def _merge(self, change: Change, rows: DataFrame, key: tuple[str, ...], watermark: str,
               on_duplicate: str) -> tuple[Change, int, str | None]:
        """Stage the delta, then write the buckets it touches anew, in a folder of their own.

        Staging reads the source once; the duplicate check, the touched buckets and the merge read
        the staged files.  Nothing that readers see is overwritten: the new version reads the touched
        buckets from the new folder and the others from where they were.  A table that is not laid out
        by this key, or is spread over MOST_PARTS folders, is rewritten whole.
        """
        current, target_table = change.base, change.target_table
        in_place = current.key == key and len(current.all_parts()) < MOST_PARTS
        placed = laid_out(rows, key, current.buckets if in_place else self.options.merge_buckets)
        stage_table, folder = f"{target_table}_STG", self._folder()
        loaded, newest = self._write(placed, watermark, stage_table, folder)
        change = replace(change, kind=MERGED, version=current)
        if loaded == 0:
            return change, loaded, newest
        stage = self.store.open(stage_table, Version(folder, placed.schema))
        if on_duplicate == "latest":
            keyless = stage.where(" or ".join(f"`{name}` is null" for name in key))
            stage = latest_per_key(stage.dropna(subset=list(key)), key, [F.desc(watermark)]).unionByName(keyless)
        elif duplicate_keys(stage, key).limit(1).count():
            raise ValueError(f"the delta of {target_table} holds a key more than once")
        version, change = self._merge_staged(replace(change, stage=stage, key=key), current)
        return replace(change, version=version), loaded, newest

    def _merge_staged(self, change: Change, current: Version) -> tuple[Version, Change]:
        """Write the rows of a version that a staged delta touches anew; gives the version that reads them."""
        stage, key, folder = change.stage, change.key, self._folder()
        target = self.store.open(change.target_table, current)
        # a stage of another number of buckets has other buckets
        in_place = current.key == key and len(current.all_parts()) < MOST_PARTS and current.buckets == (
            change.version.buckets if change.version.key == key else self.options.merge_buckets
        )
        if not in_place:
            target = target.drop(BUCKET)
            merged = merge_upsert(target, stage.select(target.columns), key)
            version = self._new_version(merged, change.target_table, key, None)[0]
            return version, replace(change, folder=folder, touched=())
        # At most one row per bucket comes to the driver; the list prunes the scan to these buckets.
        touched = tuple(row[0] for row in stage.select(BUCKET).distinct().collect())
        held = self.store.open(change.target_table, current, files=True).where(F.col(BUCKET).isin(*touched))
        # Of these only files with a key of the delta are written anew: one row per file comes to the driver.
        files = [row[0] for row in self._files_with(held.select(*key, FILE), stage.select(*key), key).collect()]
        target = held.where(F.col(FILE).isin(*files)).drop(FILE) if files else held.limit(0).drop(FILE)
        merged = gathered(merge_upsert(target, stage.select(target.columns), key))
        self._saved(merged, key).mode("overwrite").parquet(self.store.path(change.target_table, folder))
        return current.with_files(folder, files), replace(change, folder=folder, touched=touched, files=tuple(files))

    @staticmethod
    def _files_with(held: DataFrame, stage: DataFrame, key: tuple[str, ...]) -> DataFrame:
        """The files that hold a key of the delta.

        A small delta by one column is looked up by the keys themselves, which ranges and Bloom filters of the files
        answer for most of them.
        """
        keys = stage.dropna().distinct()
        if len(key) == 1:
            few = keys.limit(MOST_LOOKUPS + 1).collect()
            if len(few) <= MOST_LOOKUPS:
                return held.where(F.col(key[0]).isin(*(row[0] for row in few))).select(FILE).distinct()
        return held.join(keys, list(key), "left_semi").select(FILE).distinct()

    @staticmethod
    def _saved(rows: DataFrame, key: Sequence[str]):
        """A writer of rows by bucket, with Bloom filters of the key."""
        writer = rows.write.partitionBy(BUCKET)
        for name in key:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        return writer


def _watermark(row: Mapping) -> Watermark:
    return Watermark(row["WATERMARK_VALUE"], row["WATERMARK_TYPE"])


def ingest(spark: SparkSession, source: Source, target: Target, store: TableStore,
           options: LoadOptions = LoadOptions()) -> DataFrame:
    """Run an ingestion and return its table catalog rows."""
    return Ingestion(spark, source, target, store, options).run()
