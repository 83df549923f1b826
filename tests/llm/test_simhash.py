"""SimHash fingerprints and their components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from helpers import DOCUMENTS, awkward_rows, documents, empty, prose, words  # noqa: F401
from pyspark.sql import functions as F

from tablescout.llm import simhash
from tablescout.llm.common import text_bytes
from tablescout.llm.queries import QUERIES


def plain_print(text, k=3):
    w = words(text)
    if not w:
        return 0
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[tuple]) -> dict:
    """doc_id to the smallest reachable one, rows of one id being one document."""
    known = [(d, p) for d, p in prints if d is not None]
    parent = {d: d for d, _ in known}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array([p for _, p in known], np.uint64)
    for i, (a, p) in enumerate(known):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ np.uint64(p)) <= 3):
            low, high = sorted((root(a), root(known[j][0])))
            parent[high] = low
    return {d: root(d) for d in parent}


def check(found, rows):
    prints = [(r[0], plain_print(r[1])) for r in rows]
    assert sorted((str(r.doc_id), r.fingerprint) for r in found) == sorted((str(d), f"{p:016x}") for d, p in prints)
    expected = plain_components(prints)
    assert all(r.component_id == expected.get(r.doc_id) for r in found)
    return expected


def test_awkward_rows(documents):  # noqa: F811
    found = simhash.near_duplicates(documents).collect()
    expected = check(found, awkward_rows())
    assert expected[106] == expected[105] and expected[102] == expected[101] == expected[100]
    assert all(r.component_id is None for r in found if r.doc_id is None)


def test_spark_hash_is_the_same(documents):  # noqa: F811
    """XXH64 with this seed is also what Spark's own function gives for the text of a single shingle."""
    texts = [("one",), ("Éa b ß",), (prose(3, 90),)]
    frame = documents.sparkSession.createDataFrame(texts, "text string")
    for row in frame.select("text", F.xxhash64("text").alias("h")).collect():
        assert row.h % (1 << 64) == xxhash.xxh64_intdigest(row.text.encode(), 42)
    assert frame.select(text_bytes(F.col("text"))).count() == 3


def test_empty_table(spark):
    found = simhash.near_duplicates(empty(spark))
    assert found.columns == ["doc_id", "fingerprint", "component_id"] and not found.collect()


@pytest.mark.parametrize("segment", [1, 2, 4])
@pytest.mark.parametrize("block", [7, 4096])
def test_links_connect_what_is_near(spark, segment, block):
    """Random prints, chains and dense balls of prints, in small and large cells, blocks and batches."""
    random_ = random.Random(segment * block)
    prints = {random_.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1}
    for _ in range(6):
        at = random_.getrandbits(64)
        for _ in range(40):  # a chain of steps of up to three bits
            at ^= sum(1 << b for b in set(random_.choices(range(64), k=3)))
            prints.add(at)
    centre = random_.getrandbits(64)
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(64)}
    nodes = [(k, int(np.uint64(p).view(np.int64))) for k, p in enumerate(sorted(prints))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "333")
    try:
        classes = spark.createDataFrame(nodes, "node long, print long")
        found = [tuple(r) for r in simhash.links(classes, segment, block).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    values = np.array([p % (1 << 64) for _, p in nodes], np.uint64)
    assert all(np.bitwise_count(values[a] ^ values[b]) <= 3 and a < b for a, b in found)
    parent = list(range(len(nodes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    expected = plain_components([(k, p % (1 << 64)) for k, p in nodes])
    assert {k: root(k) for k in range(len(nodes))} == expected
    dense = sum(int((np.bitwise_count(values[:k] ^ values[k]) <= 3).sum()) for k in range(len(values)))
    assert len(set(found)) < dense  # not all pairs of the ball


def test_counts_bound_the_differing_bits(spark):
    random_ = random.Random(1)
    values = [random_.getrandbits(32) for _ in range(200)]
    for segment in (1, 2, 4):
        frame = spark.createDataFrame([(v,) for v in values], "v long").select("v", simhash.segment_counts(F.col("v"), segment).alias("c"))
        counts = {r.v: r.c for r in frame.collect()}
        for v in values:
            assert counts[v] == sum((v >> k & (1 << segment) - 1).bit_count() << k for k in range(0, 32, segment))


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op13_simhash"](spark, sf_dir).collect(), rows)


def test_hot_print_is_joined_in_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", 10)
    rows = [(k, "the same text for all of these", None, None, None) for k in range(55)] + [(99, prose(4, 30), None, None, None)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, DOCUMENTS)).collect()
    check(found, rows)
    assert len(found) == 56
