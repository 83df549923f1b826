import tempfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tablescout.operators.catalog import latest_runs, latest_watermarks, of_latest_run, run_log
from tablescout.plans.ingest import IncrementalTable, LoadOptions, Target, ingest, load_strategy
from tablescout.plans.store import TableStore
from tablescout.sources.base import FrameSource, Watermark, discover_tables
from tablescout.sources.files import FileSource, measured_columns

TARGET = Target("LAKE", "RAW", "_TD")
INCREMENTAL = {"orders": IncrementalTable("o_orderdate", ["o_orderkey"]), "events": IncrementalTable("ts")}


@pytest.fixture
def store(spark):
    return TableStore(spark, tempfile.mkdtemp(prefix="tablescout-"))


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("orders", "events", "nation")}


def outcome(frame):
    return {r.TARGET_TABLE: r for r in frame.collect()}


def split(tables):
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    return (
        tables | {"orders": tables["orders"].where(F.col("o_orderdate") <= cut)},
        tables["orders"].where(F.col("o_orderdate") > cut),
    )


def test_full_refresh_and_catalogs(spark, sf_dir, store):
    source = FileSource(spark, sf_dir, name="TD")
    options = LoadOptions(include=["ORDERS", "nation", "missing"], exclude=["Nation"])
    assert rows(discover_tables(source, ["ORDERS", "nation"], ["Nation"])) == [("orders",)]
    done = outcome(ingest(spark, source, TARGET, store, options))
    assert done["ORDERS_TD"].LOAD_STATUS == "LOADED" and done["ORDERS_TD"].ROW_COUNT_MATCH
    assert done[None].SOURCE_TABLE == "missing" and done[None].LOAD_STATUS == "FAILED"
    loaded = store.table("ORDERS_TD")
    n = source.row_count("orders")
    assert loaded.count() == n == done["ORDERS_TD"].TARGET_ROW_COUNT
    assert loaded.columns[:2] == ["O_ORDERKEY", "O_CUSTKEY"] and loaded.columns[-1] == "_INGESTED_AT"
    assert loaded.select("_SOURCE_SYSTEM", "_SOURCE_TABLE").distinct().collect() == [("TD", "orders")]
    columns = store.read("INGESTION_COLUMN_CATALOG")
    assert columns.where("SOURCE_COLUMN = 'o_orderdate'").head().TARGET_DATA_TYPE == "TIMESTAMP_NTZ"
    checks = {r.TARGET_TABLE: r for r in store.read("INGESTION_VALIDATION_RESULTS").collect()}
    assert checks["ORDERS_TD"].VALIDATION_VALUE == f"source={n}; loaded={n}; target={n}"
    log = run_log(store.read("INGESTION_RUN_LOG")).collect()
    assert [(r.STATUS, r.ERROR_MESSAGE) for r in log] == [("PARTIAL_SUCCESS", "1 table(s) failed")]
    assert log[0].FINISHED_AT >= log[0].STARTED_AT


def test_incremental_merge_append_and_watermarks(spark, tables, store):
    base, later = split(tables)
    options = LoadOptions("incremental", incremental=INCREMENTAL, merge_buckets=4)
    first = outcome(ingest(spark, FrameSource(spark, base, name="TD"), TARGET, store, options))
    assert {r.LOAD_STATUS for r in first.values()} == {"LOADED"}
    before = store.table("ORDERS_TD").count()
    assert before == base["orders"].count()

    resent = base["orders"].where("o_orderpriority = '1-URGENT'").select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), "o_totalprice",
        F.lit("2002-01-01").cast("timestamp_ntz").alias("o_orderdate"), "o_orderpriority",
    )
    n_resent = resent.count()
    kept = base["orders"].join(resent, "o_orderkey", "left_anti")
    changed = tables | {"orders": kept.select(later.columns).unionByName(later).unionByName(resent)}
    source = FrameSource(spark, changed, name="TD")

    plan = outcome(
        ingest(spark, source, TARGET, store, LoadOptions("incremental_plan", incremental=INCREMENTAL))
    )
    assert plan["ORDERS_TD"].LOAD_STATUS == "PLANNED" and store.table("ORDERS_TD").count() == before
    planned = store.read("INGESTION_VALIDATION_RESULTS").where("VALIDATION_VALUE like 'incremental_plan_only%'")
    expected = later.count() + n_resent
    assert f"planned_rows_not_loaded={expected}" in planned.where("TARGET_TABLE = 'ORDERS_TD'").head().VALIDATION_VALUE

    second = outcome(ingest(spark, source, TARGET, store, options))
    assert second["ORDERS_TD"].LOAD_STATUS == "MERGED" and second["EVENTS_TD"].LOAD_STATUS == "LOADED"
    assert second["EVENTS_TD"].TARGET_ROW_COUNT == tables["events"].count()
    merged = store.table("ORDERS_TD")
    assert merged.count() == tables["orders"].count()
    assert merged.where("O_ORDERSTATUS = 'X'").count() == n_resent
    assert merged.select("O_ORDERKEY").distinct().count() == merged.count()

    third = outcome(ingest(spark, source, TARGET, store, options))
    assert third["ORDERS_TD"].LOAD_STATUS == "MERGED"
    assert rows(store.table("ORDERS_TD").drop("_INGESTED_AT")) == rows(merged.drop("_INGESTED_AT"))
    marks = {r.SOURCE_TABLE: r for r in latest_watermarks(store.read("INGESTION_WATERMARKS")).collect()}
    assert marks["orders"].WATERMARK_VALUE == "2002-01-01 00:00:00"
    assert marks["events"].WATERMARK_TYPE == "timestamp_ntz"

    log = run_log(store.read("INGESTION_RUN_LOG"))
    assert log.count() == 4 and latest_runs(log).count() == 1
    assert of_latest_run(store.read("INGESTION_TABLE_CATALOG"), log).count() == 3


def test_null_keys_are_added_again_and_duplicates_fail(spark, store):
    def source(data):
        frame = spark.createDataFrame(data, "id int, at timestamp_ntz, v string")
        return FrameSource(spark, {"t": frame}, name="TD")

    from datetime import datetime

    day = lambda d: datetime(2024, 1, d)
    options = LoadOptions("incremental", incremental={"t": IncrementalTable("at", ["id"])}, merge_buckets=2)
    ingest(spark, source([(1, day(1), "a"), (None, day(1), "n")]), TARGET, store, options)
    ingest(spark, source([(1, day(2), "b"), (None, day(2), "m"), (2, day(2), "c")]), TARGET, store, options)
    assert rows(store.table("T_TD").select("ID", "V")) == [(None, "m"), (None, "n"), (1, "b"), (2, "c")]

    twice = source([(1, day(3), "x"), (1, day(4), "y")])
    failed = outcome(ingest(spark, twice, TARGET, store, options))["T_TD"]
    assert failed.LOAD_STATUS == "FAILED" and failed.TARGET_ROW_COUNT is None
    assert "more than once" in store.read("INGESTION_VALIDATION_RESULTS").where("VALIDATION_STATUS = 'FAIL'").head().VALIDATION_VALUE
    assert store.table("T_TD").count() == 4
    latest = LoadOptions("incremental", incremental={"t": IncrementalTable("at", ["id"], "latest")}, merge_buckets=2)
    ingest(spark, twice, TARGET, store, latest)
    assert rows(store.table("T_TD").where("ID = 1").select("V")) == [("y",)]


def test_empty_and_failing_tables(spark, store):
    frames = {
        "empty": spark.createDataFrame([], "id int, name string"),
        "clash": spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int"),
        "good": spark.createDataFrame([("yes ",), (" ",)], "name string"),
    }
    options = LoadOptions(incremental={"empty": IncrementalTable("id", ["id"])})
    done = outcome(ingest(spark, FrameSource(spark, frames), TARGET, store, options))
    assert {t: r.LOAD_STATUS for t, r in done.items()} == {"EMPTY_TD": "EMPTY", "CLASH_TD": "FAILED", "GOOD_TD": "LOADED"}
    assert store.table("EMPTY_TD").count() == 0 and store.table("EMPTY_TD").columns[0] == "ID"
    assert rows(store.table("GOOD_TD").select("NAME")) == [(None,), ("yes ",)]
    assert store.read("INGESTION_WATERMARKS").count() == 0


def test_full_refresh_replaces_atomically(spark, store):
    one = FrameSource(spark, {"t": spark.range(5)})
    ingest(spark, one, TARGET, store)
    held = store.table("T_TD")
    ingest(spark, FrameSource(spark, {"t": spark.range(3)}), TARGET, store)
    assert store.table("T_TD").count() == 3
    assert held.count() == 5  # a reader of the old version still sees it


def test_modes():
    config, mark = IncrementalTable("ts"), Watermark("1", "int")
    assert load_strategy("full_refresh", config, mark) == "full_refresh"
    assert load_strategy("incremental", config, mark) == "timestamp"
    assert load_strategy("incremental", config, None) == load_strategy("incremental", None, None) == "full_refresh"
    with pytest.raises(ValueError, match="unknown load mode"):
        load_strategy("sometimes", None, None)


def test_incremental_filter_reaches_the_scan(spark, sf_dir):
    source = FileSource(spark, sf_dir)
    delta = source.read_since("orders", "o_orderdate", Watermark("2000-01-01", "timestamp_ntz"))
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan


def test_measured_columns(spark, sf_dir):
    frames = {"t": spark.createDataFrame([("abc", None), ("é", 1)], "s string, n int")}
    found = {r.SOURCE_COLUMN: r for r in measured_columns(FrameSource(spark, frames), "t").collect()}
    assert found["s"].SOURCE_CHARACTER_MAXIMUM_LENGTH == 3 and found["s"].SOURCE_IS_NULLABLE == "NO"
    assert found["n"].SOURCE_CHARACTER_MAXIMUM_LENGTH is None and found["n"].SOURCE_IS_NULLABLE == "YES"


def test_concurrent_catalog_appends(spark, store):
    from concurrent.futures import ThreadPoolExecutor
    from datetime import UTC, datetime

    def add(i):
        row = {"SOURCE_SYSTEM": f"S{i}", "WATERMARK_VALUE": str(i), "UPDATED_AT": datetime.now(UTC)}
        store.append_rows("INGESTION_WATERMARKS", [row])

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(add, range(24)))
    assert store.read("INGESTION_WATERMARKS").select("SOURCE_SYSTEM").distinct().count() == 24


def test_layout_changes_between_loads(spark, store):
    """Another bucket count, then another key, then no key: rows stay whole."""
    from datetime import datetime

    def load(day, data, key, buckets):
        rows_ = [(k, g, datetime(2024, 1, day)) for k, g in data]
        source = FrameSource(spark, {"t": spark.createDataFrame(rows_, "id int, grp int, at timestamp_ntz")})
        options = LoadOptions("incremental", incremental={"t": IncrementalTable("at", key)}, merge_buckets=buckets)
        return outcome(ingest(spark, source, TARGET, store, options))["T_TD"].LOAD_STATUS

    def now():
        return rows(store.table("T_TD").select("ID", "GRP"))

    assert load(1, [(1, 1), (2, 2), (3, 3)], ["id"], 2) == "LOADED"
    assert load(2, [(1, 10), (4, 4)], ["ID"], 7) == "MERGED"
    assert now() == [(1, 10), (2, 2), (3, 3), (4, 4)]
    assert load(3, [(9, 2), (5, 5)], ["grp"], 3) == "MERGED"
    assert now() == sorted([(1, 10), (9, 2), (3, 3), (4, 4), (5, 5)], key=lambda r: [(True, str(v)) for v in r])
    assert load(4, [(7, 7)], [], 3) == "LOADED"
    assert (7, 7) in now() and len(now()) == 6
    assert load(5, [(8, 7)], ["grp"], 3) == "MERGED"
    assert (8, 7) in now() and len(now()) == 6
    assert load(6, [(8, 7)], ["nope"], 3) == "FAILED"


def test_changed_columns_fail_an_increment(spark, store):
    options = LoadOptions("incremental", incremental={"t": IncrementalTable("n")})

    def load(frame):
        return outcome(ingest(spark, FrameSource(spark, {"t": frame}), TARGET, store, options))["T_TD"].LOAD_STATUS

    assert load(spark.createDataFrame([(1, "a")], "n int, s string")) == "LOADED"
    assert load(spark.createDataFrame([(2, "a", 1)], "n int, s string, extra int")) == "FAILED"
    assert load(spark.createDataFrame([(2, 5)], "n int, s int")) == "FAILED"
    assert load(spark.createDataFrame([(2, "b")], "n bigint, s string")) == "LOADED"
    assert store.table("T_TD").count() == 2


def test_large_whole_numbers_are_kept(spark, store):
    frame = spark.sql("SELECT cast('99999999999999999999' AS decimal(38,0)) AS n, 7L AS k")
    ingest(spark, FrameSource(spark, {"t": frame}), TARGET, store)
    assert store.table("T_TD").select(F.col("N").cast("string"), "K").collect() == [("99999999999999999999", 7)]


def test_readers_see_the_old_rows_during_and_after_a_failed_merge(spark, store, monkeypatch):
    from datetime import datetime

    def load(day, data):
        frame = spark.createDataFrame([(k, v, datetime(2024, 1, day)) for k, v in data], "id int, v string, at timestamp_ntz")
        options = LoadOptions("incremental", incremental={"t": IncrementalTable("at", ["id"])}, merge_buckets=3)
        return outcome(ingest(spark, FrameSource(spark, {"t": frame}), TARGET, store, options))["T_TD"].LOAD_STATUS

    assert load(1, [(1, "a"), (2, "b"), (3, "c")]) == "LOADED"
    before = store.table("T_TD")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(type(store), "commit", lost)
        with pytest.raises(RuntimeError):
            load(2, [(1, "x"), (4, "d")])
    assert rows(store.table("T_TD").select("ID", "V")) == rows(before.select("ID", "V")) == [(1, "a"), (2, "b"), (3, "c")]
    assert load(2, [(1, "x"), (4, "d")]) == "MERGED"
    assert rows(store.table("T_TD").select("ID", "V")) == [(1, "x"), (2, "b"), (3, "c"), (4, "d")]
    assert rows(before.select("ID", "V")) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_watermark_without_target_loads_in_full(spark, store):
    options = LoadOptions("incremental", incremental={"t": IncrementalTable("n")})
    ingest(spark, FrameSource(spark, {"t": spark.createDataFrame([(1,), (2,)], "n int")}), TARGET, store, options)
    other = store.__class__(spark, f"{store.root}-other")
    other.append("INGESTION_WATERMARKS", store.read("INGESTION_WATERMARKS"))
    source = FrameSource(spark, {"t": spark.createDataFrame([(1,), (2,), (3,)], "n int")})
    done = outcome(ingest(spark, source, TARGET, other, options))["T_TD"]
    assert (done.LOAD_STATUS, done.TARGET_ROW_COUNT) == ("LOADED", 3)


def test_map_columns_and_repeated_includes(spark, store):
    frame = spark.sql("SELECT * FROM VALUES (1, map('a', 1), timestamp_ntz'2024-01-01'), (null, map(), timestamp_ntz'2024-01-02') AS t(id, m, at)")
    options = LoadOptions("incremental", include=["t", "gone", "gone"], incremental={"t": IncrementalTable("at", ["id"])}, merge_buckets=2)
    ingest(spark, FrameSource(spark, {"t": frame}), TARGET, store, options)
    assert store.table("T_TD").count() == 2
    assert store.read("INGESTION_VALIDATION_RESULTS").where("VALIDATION_STATUS = 'FAIL'").count() == 2


def test_stored_aggregates_are_not_narrowed_to_one_task(spark, store):
    plans = []
    frame = spark.range(1000).selectExpr("cast(id % 7 AS string) AS TARGET_TABLE").groupBy("TARGET_TABLE").count()
    real = type(frame).write
    try:
        type(frame).write = property(lambda self: plans.append(self._jdf.queryExecution().optimizedPlan().toString()) or real.fget(self))
        store.append("COLUMN_PROFILE", frame)
    finally:
        type(frame).write = real
    assert plans and not any("Repartition 1" in plan for plan in plans)
