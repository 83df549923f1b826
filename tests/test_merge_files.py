"""A merge writes the files anew that hold keys of its delta, and no others."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablescout.plans import ingest as ingest_module
from tablescout.plans.ingest import IncrementalTable, LoadOptions, Target, ingest
from tablescout.plans.store import TableStore
from tablescout.sources.base import FrameSource

COLUMNS = "id int, part string, at timestamp_ntz, v string"


def load(spark, store, data, key, buckets=4):
    frame = spark.createDataFrame([(k, p, datetime(2024, 1, d), v) for k, p, d, v in data], COLUMNS)
    options = LoadOptions("incremental", incremental={"t": IncrementalTable("at", list(key))}, merge_buckets=buckets)
    return ingest(spark, FrameSource(spark, {"t": frame}), Target("LAKE", "RAW", ""), store, options).head()


def files(store):
    return {r[0] for r in store.open("T", store.versions()["T"], files=True).select("_FILE").distinct().collect()}


def content(store):
    return sorted(((r.ID, r.V) for r in store.table("T").collect()), key=str)


@pytest.mark.parametrize("key, lookups", [(("id",), 1000), (("id",), 0), (("id", "part"), 1000)])
def test_only_touched_files_are_written(spark, tmp_path, monkeypatch, key, lookups):
    monkeypatch.setattr(ingest_module, "MOST_LOOKUPS", lookups)
    store = TableStore(spark, str(tmp_path))
    table = {k: "a" for k in range(200)}
    load(spark, store, [(k, "p", 1, v) for k, v in table.items()] + [(None, "p", 1, "n")], key)
    first = files(store)
    assert len(first) >= 4

    def merged(day, delta):
        before, version = files(store), store.versions()["T"]
        held = {r[0] for r in store.open("T", version, files=True).where(F.col("ID").isin(*delta) if delta else F.lit(False)).select("_FILE").distinct().collect()}
        done = load(spark, store, [(k, "p", day, v) for k, v in delta.items()], key)
        assert done.LOAD_STATUS == "MERGED"
        table.update(delta)
        assert content(store) == sorted([*table.items(), (None, "n")], key=str)
        after = files(store)
        assert before - after == held  # files with a key of the delta are gone, all others are read as they were
        return before, after

    # one changed row: one file; new rows only: none is gone
    before, after = merged(2, {7: "b"})
    assert len(before - after) == 1 and len(after & before) == len(before) - 1
    before, after = merged(3, {1000: "new", 1001: "new"})
    assert before < after
    before, after = merged(4, {7: "c", 1000: "d", 55: "e"})
    assert 1 <= len(before - after) <= 3
    before, after = merged(5, {k: "all" for k in range(200)})
    assert len(before & after) <= 2


def test_files_that_are_not_read_are_not_listed(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    load(spark, store, [(k, "p", 1, "a") for k in range(100)], ["id"])
    load(spark, store, [(3, "p", 2, "b")], ["id"])
    version = store.versions()["T"]
    assert [len(p.without) for p in version.all_parts()] == [1, 0]
    rows = store.open("T", version).select("ID")
    assert rows.count() == 100
    plan, read = rows._jdf.queryExecution().executedPlan(), 0
    rows.collect()
    scans = [plan]
    while scans:
        node = scans.pop()
        if node.metrics().contains("numFiles"):
            read += node.metrics().apply("numFiles").value()
        scans += [node.children().apply(i) for i in range(node.children().size())]
    assert read == len(files(store))


def test_key_lookups_reach_the_files(spark, tmp_path):
    """Keys of a small delta are pushed to the scan, where ranges and Bloom filters of the files answer them."""
    store = TableStore(spark, str(tmp_path))
    load(spark, store, [(k, "p", 1, "a") for k in range(50)], ["id"])
    held = store.open("T", store.versions()["T"], files=True).select("ID", "_FILE")
    found = ingest_module.Ingestion._files_with(held, spark.createDataFrame([(3,), (None,), (99,)], "ID int"), ("ID",))
    assert "PushedFilters: [In(ID, [3,99])]" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 1
