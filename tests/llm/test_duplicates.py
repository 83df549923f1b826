"""Near-duplicates against all pairs, components against union-find."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOCUMENTS, awkward_rows, duplicate_components, empty, prose, shingles, documents  # noqa: F401

import tablescout.llm.near_duplicates as near_duplicates_module
from tablescout.llm.near_duplicates import (
    MISSED, ROWS, bands_for, circulant_signatures, components, first_of_each_id, least_agreement, near_duplicates, stars,
)


def check(frame, rows, k, percent):
    found = near_duplicates(frame, k, percent).collect()
    expected = duplicate_components(rows, k, percent)
    assert sorted((str(r.doc_id), r.n_shingles) for r in found) == sorted((str(d), len(shingles(t, k))) for d, t in rows)
    for r in found:
        assert r.component_id == (None if r.doc_id is None else expected[r.doc_id])
        assert r.kept == (r.component_id == r.doc_id)


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_awkward_rows(spark, documents, k, percent):
    check(documents, [(d, t) for d, t, *_ in awkward_rows()], k, percent)


def test_nothing(spark):
    assert near_duplicates(empty(spark), 3, 85).collect() == []


def test_chains_around_the_threshold(spark, monkeypatch):
    """A group of near copies whose similarities lie about the threshold, in several blocks of a bucket."""
    monkeypatch.setattr("tablescout.llm.near_duplicates.BLOCK", 8)
    monkeypatch.setattr("tablescout.llm.near_duplicates.TOGETHER", 20)
    monkeypatch.setattr("tablescout.llm.near_duplicates.STARS", 1)
    random_ = random.Random(3)
    base = prose(9, 150).split()
    rows = []
    for k in range(90):
        own = list(base)
        for at in random_.sample(range(len(own)), random_.randint(0, 6)):
            own[at] = f"w{random_.randint(0, 10**6)}"
        rows.append((k, " ".join(own)))
    rows += [(200 + k, prose(1000 + k, 60)) for k in range(30)]
    frame = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCUMENTS).repartition(4)
    check(frame, rows, 3, 85)
    assert 1 < len(set(duplicate_components(rows[:90], 3, 85).values())) < 90


def test_components(spark):
    random_ = random.Random(1)
    links = [(random_.randrange(200), random_.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: root(x) for a, b in links if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stars_end_at_once_and_go_on(spark, monkeypatch):
    """Links that are stars already are written once, later links go on from what is known."""
    written = []
    staged = near_duplicates_module.staged
    monkeypatch.setattr(near_duplicates_module, "staged", lambda frame, name: written.append(name) or staged(frame, name))
    first = stars(spark.createDataFrame([(1, k) for k in range(2, 9)] + [(10, 11), (3, 1)], "a long, b long"))
    assert written == ["stars"]
    assert {tuple(r) for r in first.collect()} == {(k, 1) for k in range(2, 9)} | {(11, 10)}
    assert stars(spark.createDataFrame([], "a long, b long"), first) is first
    both = stars(spark.createDataFrame([(11, 5)], "a long, b long"), first)
    assert {tuple(r) for r in both.collect()} == {(k, 1) for k in range(2, 9)} | {(10, 1), (11, 1)}


def test_signatures_estimate_similarity():
    random_ = np.random.default_rng(1)
    shared = random_.integers(0, 1 << 63, 400).astype(np.uint64)
    one = np.concatenate([shared, random_.integers(0, 1 << 63, 40).astype(np.uint64)])
    other = np.concatenate([shared, random_.integers(0, 1 << 63, 60).astype(np.uint64)])
    signs = circulant_signatures(np.concatenate([one, other]), np.array([0, 440]), 1024)
    assert abs((signs[0] == signs[1]).mean() - 400 / 500) < 0.05
    assert least_agreement(85) < 0.85 * 88


def test_first_of_each_id(spark):
    rows = [(1, "b"), (1, "a"), (2, "c"), (None, "d"), (None, "d")]
    found = first_of_each_id(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, "a"), (2, "c"), (None, "d"), (None, "d")], key=str)


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_bands_and_agreement_miss_no_more_than_promised(percent):
    s, bands = percent / 100, bands_for(percent)
    k = ROWS * bands
    below = lambda least: sum(math.comb(k, i) * s**i * (1 - s) ** (k - i) for i in range(least))
    unbanded = (1 - s**ROWS) ** bands
    assert below(least_agreement(percent)) + unbanded <= MISSED < below(least_agreement(percent) + 1) + unbanded


def test_members_are_dealt_to_few_block_pairs(spark, monkeypatch):
    """A member goes with its signature to one pair for each wide block, whatever the number of blocks."""
    monkeypatch.setattr(near_duplicates_module, "BLOCK", 10)
    rows = [(1, k % 3, k, k, 100, 80) for k in range(80)] + [(2, 0, k, k, 100, 10) for k in range(10)]
    members = spark.createDataFrame(rows, "bucket long, band int, node long, label long, size long, members long")
    nodes = spark.createDataFrame([(k, b"x") for k in range(80)], "node long, signature binary")
    found = near_duplicates_module._dealt(members, nodes).collect()
    assert len(found) == 80 * 2 + 10
    for bucket, places in ((1, {0, 1}), (2, {0})):
        assert {p for r in found if r.bucket == bucket for p in (r.low, r.high)} == places
        assert {(r.node, *sorted((r.own // 4, p))) for r in found if r.bucket == bucket for p in places} == {
            (r.node, r.low, r.high) for r in found if r.bucket == bucket
        }


def test_texts_are_hashed_in_pieces(monkeypatch):
    texts = [prose(k, 30).encode() for k in range(20)] + [b"", b"one two", b"  "]
    whole = near_duplicates_module.piecewise_sets(pa.chunked_array([texts[:7], texts[7:]]), 3)
    monkeypatch.setattr(near_duplicates_module, "PIECE", 100)
    cut = near_duplicates_module.piecewise_sets(pa.chunked_array([texts]), 3)
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True)) and len(whole[1]) == len(texts) + 1
    none = near_duplicates_module.piecewise_sets(pa.chunked_array([], pa.binary()), 3)
    assert len(none[0]) == 0 and list(none[1]) == [0]
