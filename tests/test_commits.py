"""The commit log: runs at the same time, runs that are lost, compaction and retention."""

from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablescout.operators.catalog import latest_runs, latest_watermarks, run_log
from tablescout.plans import commits, ingest as ingest_module, store as store_module
from tablescout.plans.commits import CommitLog, Files
from tablescout.plans.ingest import IncrementalTable, LoadOptions, Target, ingest
from tablescout.plans.store import TableStore
from tablescout.sources.base import FrameSource

TARGET = Target("LAKE", "RAW", "_TD")


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def load(spark, store, data, key=("id",), name="SRC", buckets=4, mode="incremental"):
    """A run over rows (id, day, text)."""
    frame = spark.createDataFrame([(k, datetime(2024, 1, d), v) for k, d, v in data], "id int, at timestamp_ntz, v string")
    options = LoadOptions(mode, incremental={"t": IncrementalTable("at", list(key))}, merge_buckets=buckets)
    return {r.TARGET_TABLE: r for r in ingest(spark, FrameSource(spark, {"t": frame}, name=name), TARGET, store, options).collect()}["T_TD"]


def content(store):
    return sorted(tuple(r) for r in store.table("T_TD").select("ID", "V").collect())


@pytest.fixture
def meanwhile(monkeypatch):
    """Lets something happen between the load of the next run and its commit."""
    real, waiting = TableStore.commit, []

    def commit(self, *args):
        if waiting:
            waiting.pop()()
        return real(self, *args)

    monkeypatch.setattr(TableStore, "commit", commit)
    return waiting.append


@pytest.mark.parametrize("local", [True, False])
def test_one_of_many_gets_a_number(spark, tmp_path, local):
    logs = [CommitLog(spark, str(tmp_path), ["K"]) for _ in range(6)]
    for log in logs:
        log._files._local = local
    if local:  # a rename of this local file system, unlike a link, is not what only one can do
        with ThreadPoolExecutor(6) as pool:
            assert sum(pool.map(lambda log: log.put(1, {}), logs)) == 1
            list(pool.map(lambda log: [log.add({"catalogs": [["c", f"0-{id(log)}-{k}", []]]}) for k in range(5)], logs))
        assert len(logs[0].state()["catalogs"]["c"]) == 30 and logs[1].state() == logs[2].state()
    else:
        assert [log.put(1, {"n": k}) for k, log in enumerate(logs)] == [True] + [False] * 5
    assert not [n for n, *_ in Files(spark, str(tmp_path)).list(".") if n.endswith(".draft")]


def test_state_follows_from_snapshot_and_later_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 4)
    log = CommitLog(spark, str(tmp_path), ["K"])
    for k in range(1, 11):
        record = {"versions": {f"t{k % 3}": {"VERSION": k}}, "watermarks": [{"K": k % 2, "WATERMARK_VALUE": k}], "catalogs": [["c", f"0-{k}", ["0-1"] if k == 9 else []]]}
        assert log.put(k, record)
    opened = []
    fresh = CommitLog(spark, str(tmp_path), ["K"])
    monkeypatch.setattr(fresh._files, "read", lambda name, real=fresh._files.read: opened.append(name) or real(name))
    assert fresh.state() == log.state()
    assert [o.split("/")[1].split(".")[1] for o in opened] == ["snapshot", "commit", "commit"]
    assert {t: v["VERSION"] for t, v in fresh.state()["versions"].items()} == {"t0": 9, "t1": 10, "t2": 8}
    assert sorted(r["WATERMARK_VALUE"] for r in fresh.state()["watermarks"].values()) == [9, 10]
    assert fresh.state()["catalogs"]["c"] == [f"0-{k}" for k in range(2, 11)]
    log.forget(datetime.now(UTC) + timedelta(1))
    assert CommitLog(spark, str(tmp_path), ["K"]).state() == log.state()
    assert [r["number"] for r in log.records()] == [9, 10]
    assert not log.add({}, lambda state: False)


@pytest.mark.parametrize("key", [("id",), ()])
def test_a_run_lost_at_any_step_can_be_run_again(spark, store, monkeypatch, key):
    """Stopped before or behind any write of the log, a run leaves all or nothing, and its rerun nothing twice."""
    load(spark, store, [(1, 1, "a"), (2, 1, "b")], key)
    data = [(1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, 2, "d")]
    expected = [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    real, day = CommitLog.put, 2
    for stop in range(3):  # the second write is that of versions and watermarks
        for behind in (False, True):
            count = iter(range(100))

            def lost(self, number, record):
                here = next(count) == stop
                if here and not behind:
                    raise SystemExit("lost")
                done = real(self, number, record)
                if here:
                    raise SystemExit("lost")
                return done

            with monkeypatch.context() as patch:
                patch.setattr(CommitLog, "put", lost)
                try:
                    load(spark, store, data, key)
                except SystemExit:
                    pass
            mark = latest_watermarks(store.read("INGESTION_WATERMARKS")).head().WATERMARK_VALUE
            # rows and watermark are both there or both not
            assert (content(store) == expected) == mark.startswith(f"2024-01-{day:02}")
            load(spark, store, data, key)
            assert content(store) == expected
            day += 1
            data.append((day * 10, day, "x"))
            expected.append((day * 10, "x"))


def test_two_runs_at_once_leave_both_deltas(spark, store, meanwhile):
    """Merges of other and of the same buckets, and two sources of one table."""
    load(spark, store, [(k, 1, "old") for k in range(8)])
    meanwhile(lambda: load(spark, store, [(1, 2, "b"), (9, 2, "b")], name="OTHER"))
    # OTHER has no watermark of its own, so it loads in full; from then on both are increments
    load(spark, store, [(1, 2, "a"), (10, 2, "a")])
    assert content(store) == [(1, "a"), (9, "b"), (10, "a")]
    for day, mine, other in [(3, [20, 21], [30]), (4, [1], [1, 40]), (5, list(range(50, 70)), list(range(60, 80)))]:
        before = dict(content(store))
        meanwhile(lambda day=day, other=other: load(spark, store, [(k, day, f"other{day}") for k in other], name="OTHER"))
        done = load(spark, store, [(k, day, f"mine{day}") for k in mine])
        expected = before | dict.fromkeys(other, f"other{day}") | dict.fromkeys(mine, f"mine{day}")
        assert dict(content(store)) == expected and len(content(store)) == len(expected)
        assert done.LOAD_STATUS == "MERGED" and done.TARGET_ROW_COUNT == len(expected)
    marks = {r.SOURCE_SYSTEM: r.WATERMARK_VALUE for r in latest_watermarks(store.read("INGESTION_WATERMARKS")).collect()}
    assert marks == dict.fromkeys(("SRC", "OTHER"), "2024-01-05 00:00:00")


def test_two_runs_of_one_source_add_a_delta_once(spark, store, meanwhile):
    """Without a key nothing tells a row that was added twice: the second run starts again from the new watermark."""
    load(spark, store, [(1, 1, "a")], key=())
    meanwhile(lambda: load(spark, store, [(1, 1, "a"), (2, 2, "b")], key=()))
    done = load(spark, store, [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], key=())
    assert content(store) == [(1, "a"), (2, "b"), (3, "c")]
    assert (done.LOAD_STATUS, done.TARGET_ROW_COUNT) == ("LOADED", 3)


def test_a_delta_upon_another_layout_or_an_appended_part(spark, store, meanwhile):
    load(spark, store, [(k, 1, "old") for k in range(6)])
    load(spark, store, [(0, 1, "b")], name="OTHER")
    load(spark, store, [(k, 1, "old") for k in range(6)])
    meanwhile(lambda: load(spark, store, [(0, 2, "new"), (7, 2, "new")], name="OTHER", buckets=7, mode="full_refresh"))
    load(spark, store, [(0, 3, "mine"), (8, 3, "mine")])
    assert content(store) == [(0, "mine"), (7, "new"), (8, "mine")]
    meanwhile(lambda: load(spark, store, [(9, 4, "added")], key=(), name="OTHER"))
    load(spark, store, [(9, 4, "x"), (8, 4, "y")])
    assert content(store) == [(0, "mine"), (7, "new"), (8, "y"), (9, "x")]


def test_many_appends_are_read_from_few_folders(spark, store, monkeypatch):
    monkeypatch.setattr(store_module, "FAN", 4)
    for k in range(70):
        at = datetime(2024, 1, 1, tzinfo=UTC) + timedelta(minutes=k)
        store.append_rows("INGESTION_RUN_LOG", [{"RUN_ID": f"r{k:02}", "SOURCE_SYSTEM": "S", "STATUS": "SUCCESS", "STARTED_AT": at, "FINISHED_AT": at}])
    folders = store.log.state()["catalogs"]["INGESTION_RUN_LOG"]
    assert len(folders) < 4 * 4 and len(store.read("INGESTION_RUN_LOG").inputFiles()) < 40
    found = store.read("INGESTION_RUN_LOG")
    assert found.count() == 70 and latest_runs(run_log(found)).head().RUN_ID == "r69"


def test_retention_keeps_what_is_read(spark, store, monkeypatch):
    load(spark, store, [(k, 1, "a") for k in range(20)])
    opened = store.table("T_TD")
    load(spark, store, [(k, 2, "b") for k in range(20)])
    load(spark, store, [(k, 3, "c") for k in range(20)])
    old = {f for _, f in [(r.V, r[1]) for r in opened.select("V", F.col("_metadata.file_path")).collect()]}
    # within the horizon nothing goes, though two versions are no longer current
    assert not store.clean(timedelta(hours=1))
    assert opened.count() == 20
    now = store.table("T_TD")
    gone = store.clean(timedelta(0))
    assert {g.split("/")[0] for g in gone} >= {"T_TD", "T_TD_STG"}
    assert now.count() == 20 and content(store) == [(k, "c") for k in range(20)]
    assert all(any(g in f for g in gone) for f in old)
    with pytest.raises(Exception, match="does not exist|FILE_NOT_EXIST|FileNotFound"):
        opened.select("V").collect()
    # a load goes on from what is left
    load(spark, store, [(k, 4, "d") for k in range(3)])
    assert len(content(store)) == 20 and not store.clean(timedelta(hours=1))


def test_a_table_that_is_merged_often_is_rewritten(spark, store, monkeypatch):
    monkeypatch.setattr(ingest_module, "MOST_PARTS", 3)
    for day in range(1, 9):
        load(spark, store, [(k, day, f"v{day}") for k in range(day)])
    assert len(store.versions()["T_TD"].all_parts()) <= 3
    assert content(store) == [(k, "v8") for k in range(8)]
