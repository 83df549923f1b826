"""Neighbours, licences, benchmark passages and mixing, against brute force."""

import hashlib
import json
import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
from helpers import DOCUMENTS, UPPER, awkward_rows, empty, prose, words, documents  # noqa: F401

import tablescout.llm.neighbours as neighbours_module
from tablescout.llm import decontaminate, licences, mixing
from tablescout.llm.neighbours import few_copies, nearest

VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(count=400, width=8):
    random_ = np.random.default_rng(5)
    rows = [(k, [float(x) for x in np.float32(random_.normal(size=width))], None) for k in range(count)]
    rows += [(1000 + k, rows[k % 7][1], 1) for k in range(30)]  # ties
    return rows + [
        (2000, None, 1), (2001, [0.0] * width, 1), (2002, [float("nan")] * width, 1), (2003, [None] + [1.0] * (width - 1), 1),
        (2004, [float("inf")] + [1.0] * (width - 1), 1), (None, [1.0] * width, 1), (2005, [1.0, 2.0], 1), (2006, [], 1),
    ]


def brute_nearest(rows, k, queries):
    good = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = []
    for q, x in good:
        if q in queries:
            scored = [(-(x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y)), i) for i, y in good if i != q and len(y) == len(x)]
            scored = sorted((round(s, 12), i) for s, i in scored)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], start=1)]
    return out


@pytest.mark.parametrize("shard, block", [(4096, 1024), (150, 5)])
def test_neighbours_are_exact_at_factor_one(spark, shard, block):
    rows = vectors()
    frame = spark.createDataFrame(rows, VECTORS).withColumnRenamed("label", "score")
    found = sorted(map(tuple, nearest(frame, frame.where("vec_id % 50 = 0"), 5, shard=shard, block=block).collect()))
    expected = sorted(brute_nearest(rows, 5, {i for i, *_ in rows if i is not None and i % 50 == 0}))
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in expected])


def test_scaled_copies_are_ranked_by_exact_scores(spark):
    """Scores that differ in the last place only: nothing that rounding holds equal may be left out."""
    random_ = np.random.default_rng(7)
    base = random_.normal(size=8)
    rows = [(k, [float(x) for x in np.float32(base * s)], None) for k, s in enumerate(random_.uniform(0.1, 9, 200))]
    rows += [(3, rows[8][1], None), (3, rows[9][1], None)]  # an id of several vectors
    frame = spark.createDataFrame(rows, VECTORS)
    found = sorted(map(tuple, nearest(frame, frame.where("vec_id % 50 = 0 AND vec_id <> 0"), 5, shard=64).collect()))

    def dot(x, y):
        out = 0.0
        for a, b in zip(x, y, strict=True):
            out += a * b
        return out

    expected = []
    for q in (50, 100, 150):
        x = rows[q][1]
        scored = sorted((-(dot(x, y) / (math.sqrt(dot(x, x)) * math.sqrt(dot(y, y)))), i) for i, y, _ in rows if i != q)
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:5], start=1)]
    assert found == expected


def test_larger_factors_skip_more_and_few_candidates_give_few_rows(spark):
    rows = vectors(2000, 6)
    frame = spark.createDataFrame(rows, VECTORS)
    queries = frame.where("vec_id % 50 = 0 AND vec_id < 1000")
    exact = {(r.query_id, r.vec_id) for r in nearest(frame, queries).collect()}
    loose = {(r.query_id, r.vec_id) for r in nearest(frame, queries, factor=1.5).collect()}
    assert len(exact & loose) >= 0.5 * len(exact) and len(loose) == len(exact)
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1)], VECTORS)
    assert [tuple(r)[:3] for r in nearest(few, few.where("vec_id = 0")).collect()] == [(0, 1, 1)]
    assert nearest(few.limit(0), few).count() == 0 and nearest(few, few.limit(0)).count() == 0


def test_queries_are_not_sent_again_for_every_shard(spark):
    """They were multiplied by the shards and joined to them, which outgrew any disk."""
    frame = spark.createDataFrame(vectors(), VECTORS)
    plan = nearest(frame, frame, shard=20, block=20)._jdf.queryExecution().toString()
    assert "Join" not in plan and "Generate" not in plan


@pytest.mark.parametrize("kind", ["float", "double"])
def test_neighbours_in_parts_and_two_rounds(spark, monkeypatch, kind):
    """Queries in several broadcasts and shares, a first round that bounds the second, small leaves."""
    monkeypatch.setattr(neighbours_module, "PAIRS", 500)
    monkeypatch.setattr(neighbours_module, "TOGETHER", 64)
    monkeypatch.setattr(neighbours_module, "SCORED", 16)
    rows = vectors(900)
    rows += [(3000 + k, [3.0, *([0.25] * (2 + k % 2))], 1) for k in range(40)]  # of lengths 3 and 4
    frame = spark.createDataFrame(rows, VECTORS.replace("float", kind)).repartition(3)
    found = sorted(map(tuple, nearest(frame, frame.where("vec_id % 10 = 0"), 5, shard=30, block=7, leaf=8, part_bytes=900).collect()))
    expected = sorted(brute_nearest(rows, 5, {i for i, *_ in rows if i is not None and i % 10 == 0}))
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in expected])


def test_one_vector_in_most_rows(spark):
    """Copies beyond those that a query can be answered with are not compared; the answer is that of all."""
    rows = [(k, [1.0, 2.0, 3.0], None) for k in range(300)] + [(1, [1.0, 2.0, 3.0], None)] * 9
    rows += [(1000 + k, v, None) for k, v, _ in vectors(60, 3)[:60]]
    frame = spark.createDataFrame(rows, VECTORS)
    found = sorted(map(tuple, nearest(frame, frame.where("vec_id IN (0, 1, 50)"), 5, shard=64, leaf=16).collect()))
    least = {0: [1] * 5, 1: [0, 2, 3, 4, 5], 50: [0, 1, 1, 1, 1]}
    assert [r[:3] for r in found] == [(q, r, i) for q, ids in least.items() for r, i in enumerate(ids, start=1)]
    ids, matrix = few_copies(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32), 5)
    assert sorted(ids[ids < 1000]) == [0, 1, 1, 1, 1, 1, 2, 3, 4, 5] and len(ids) == len(matrix) == 70


def plain_normalised(text):
    out = re.sub(licences.COPYRIGHT_LINE, r"\1", text.translate(UPPER))
    for one, other in licences.SPELLINGS:
        out = out.replace(one, other)
    out = re.sub(r" ?\n[\n ]*", "\n", re.sub(licences.PUNCTUATION, " ", out))
    return re.sub(r"^[\n ]+|[\n ]+\Z", "", out)


def test_licences(spark):
    texts = {
        1: "Released under the MIT License.", 2: "  released under\tthe MIT Licence \n", 3: "Some prose.\nLicensed under CC BY-NC 4.0.\nMore.",
        4: "Copyright (c) 2020 Somebody\nReleased under the MIT License.", 5: None, 6: "", 7: "..!", 8: "x Released under the MIT License.",
        9: prose(3, 30000) + "\nAll rights reserved.", 10: "Copyright law is a subject.",
    }
    rows = [(d, t, None, None, None) for d, t in texts.items()] + [(1, texts[8], None, None, None), (None, texts[1], None, None, None)]
    rows.append((None, "nothing here", None, None, None))
    frame = spark.createDataFrame(rows, DOCUMENTS).withColumnsRenamed({"lang": "license_id", "source": "digest"})
    found = licences.scan_licences(frame, licences.builtin_licences(spark)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert by[2].license_id == by[4].license_id == "MIT"
    assert sorted((str(r.license_id), r.notices) for r in found if r.doc_id is None) == [("MIT", ["MIT"]), ("None", [])]
    assert [r.license_id for r in found if r.doc_id == 1].count("MIT") == 1
    assert sorted(r.notices for r in found if r.doc_id == 1) == [[], ["MIT"]]  # each row its own
    assert by[3].license_id is None and by[3].notices == ["CC-BY-NC-4.0"]
    assert by[9].notices == ["all-rights-reserved"]
    assert by[5].text_sha256 is None and all(by[d].notices == [] and by[d].license_id is None for d in (5, 6, 7, 8, 10))
    for d, text in texts.items():
        if text is not None and d != 1:
            assert by[d].text_sha256 == hashlib.sha256(plain_normalised(text).replace("\n", " ").encode()).hexdigest()
    assert licences.scan_licences(frame.limit(0), licences.builtin_licences(spark)).count() == 0
    none = licences.scan_licences(frame, licences.builtin_licences(spark).limit(0)).collect()
    assert len(none) == len(rows) and not any(r.license_id or r.notices for r in none)


def plain_scan(text, items, n=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
    w, hit, found = split(text), set(), set()
    for item, body in items:
        v = split(body)
        for k in range(max(len(v) - n + 1, 1 if v else 0)):
            gram = v[k : k + n]
            for at in range(len(w) - len(gram) + 1):
                if w[at : at + len(gram)] == gram:
                    hit |= set(range(at, at + len(gram)))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), sorted(found)


def benchmark_case(spark):
    passage = prose(77, 25)
    items = [(1, passage), (2, "Short one here"), (10, passage), (3, None), (4, ""), (5, "!!"), (None, prose(78, 12)), (2, "Short one here")]
    rows = awkward_rows()[:12] + awkward_rows()[20:32]
    rows += [
        (300, prose(50, 20) + " " + passage.upper() + " " + prose(51, 20), None, None, None), (301, passage[:200], None, None, None),
        (302, "a short, one; HERE. b short one here", None, None, None), (303, prose(78, 12) + "x", None, None, None),
    ]
    return rows, items, spark.createDataFrame(rows, DOCUMENTS).repartition(3), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("part_bytes", [1 << 20, 60])
def test_benchmark(spark, part_bytes):
    rows, items, documents, benchmark = benchmark_case(spark)
    found = decontaminate.scan_benchmark(documents, benchmark, part_bytes=part_bytes, clean=True).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in found) == sorted(
        (str(d), *plain_scan(t, items)) for d, t, *_ in rows
    )
    cleaned = {r.doc_id: r.text for r in found}
    assert cleaned[302] == "a ; b " or plain_scan(cleaned[302], items)[1] == 0
    kept = decontaminate.without_benchmark(documents, benchmark, part_bytes=part_bytes)
    assert kept.columns == documents.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(
        map(str, documents.select("doc_id", "text").where("doc_id IS NULL OR doc_id < 300").collect())
    )


def test_benchmark_edges(spark):
    _, _, documents, benchmark = benchmark_case(spark)
    assert decontaminate.scan_benchmark(documents.limit(0), benchmark).count() == 0
    assert {r.n_hit for r in decontaminate.scan_benchmark(documents, benchmark.limit(0)).collect()} == {0}
    assert decontaminate.without_benchmark(documents, benchmark.limit(0)).count() == documents.count()


def test_mix_does_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    """Null and repeated ids of equal size, copies among them: the same rows are taken the same number of times."""
    monkeypatch.setattr(mixing, "PIECE", 4)
    rows = [(None if k % 3 else k % 7, prose(k % 40, 12), "en", f"s{k % 2}", k % 5) for k in range(121)]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    found = []
    for parts in (1, 3, 8):
        mixed = mixing.mix(frame.repartition(parts), group=16, fan_in=4, keep=["text", "n_chars"]).collect()
        assert len(mixed) == len(rows)
        found.append(sorted(map(str, mixed)))
    assert found[0] == found[1] == found[2]


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, stopped, target = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(most * sizes[s] for s in stopped)
        open_ = sum(weight[s] for s in order if s not in stopped)
        target = {s: most * sizes[s] if s in stopped else rest * weight[s] / open_ for s in order}
        over = {s for s in order if s not in stopped and target[s] > most * sizes[s]}
        if not over:
            return target
        stopped |= over


def test_targets_with_stops(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, "d": 3, None: 7, "é": 90, "Z": 40}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    assert found == pytest.approx(plain_targets(sizes))


def test_mix(spark, documents):
    found = mixing.mix(documents, group=4, fan_in=2).collect()
    assert sorted(str((r.doc_id, r.source, r.size)) for r in found) == sorted(
        str((d, s, len(words(t)))) for d, t, _, s, _ in awkward_rows()
    )
    sizes = {}
    for _, t, _, s, _ in awkward_rows():
        sizes[s] = sizes.get(s, 0) + len(words(t))
    targets = plain_targets(sizes)
    for r in found:
        assert r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    again = mixing.mix(documents.repartition(7), group=4, fan_in=2)
    assert sorted(map(str, again.collect())) == sorted(map(str, found))
    assert mixing.mix(empty(spark)).count() == 0


def test_mix_comes_near_its_targets_and_keeps_probabilities(spark):
    random_ = random.Random(2)
    rows = [(k, f"s{k % 3}", random_.randint(1, 400), 1) for k in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long, nth int")
    taken = {}
    for seed in range(3):
        found = mixing.mix_sizes(frame, seed=seed, group=64, fan_in=4).collect()
        for s in ("s0", "s1", "s2"):
            mine = [r for r in found if r.source == s]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= 400
        for r in found:
            ratio = r.target / r.source_size
            assert int(ratio) <= r.copies <= int(ratio) + 1
            taken.setdefault(r.source, []).append(r.copies - ratio)
    assert all(abs(np.mean(x)) < 0.05 for x in taken.values())


def test_rounding_keeps_the_sum():
    random_ = np.random.default_rng(1)
    p, size = random_.random(500), random_.integers(1, 1000, 500).astype(float)
    out = mixing._rounded(p, size, random_)
    assert ((out > 0) & (out < 1)).sum() <= 1
    assert (out * size).sum() == pytest.approx((p * size).sum())


def test_mix_keeps_columns(spark, documents):
    found = mixing.mix(documents, keep=["text", "lang"]).collect()
    assert sorted(str((r.doc_id, r.text, r.lang)) for r in found) == sorted(str((d, t, l)) for d, t, l, *_ in awkward_rows())


OWNERS = [
    "Copyright (c) 2020 Somebody", "Copyright Acme Corp", "(c) Acme Corp", "© Acme Corp", "Copyright: 2001-2003, Acme", "Copyright by Acme",
    "(C)2020 Acme Corp\nCopyright The Acme Authors. All rights reserved.", "  copyright acme  \n  COPYRIGHT (C) The Regents", "Copyright© Élan SA",
    "Copyright (c) Acme\nAll rights reserved.",
]


def test_full_licence_texts(spark):
    """Whole texts under owner lines of any form, as they stand, all in one line, and wrapped before each 'copyright'."""
    rows, wanted = [], {}
    for line in (Path(licences.__file__).parent / licences.TEXTS).read_text(encoding="utf-8").splitlines():
        row = json.loads(line)
        own = re.compile(r"(?i)copyright\s+(\(c\)|[0-9\[<])")  # the licence's own owner lines stay in one piece
        wrapped = "\n".join(x if own.search(x) else re.sub(r"(?i)\s+(copyright|\(c\))", r"\n\1", x) for x in row["text"].split("\n"))
        flat = " ".join(re.sub(r"(?im)^\s*copyright (\(c\)|[0-9\[<]).*\n", "", row["text"]).split())
        for title in ["", *row["titles"]]:
            for owner in OWNERS if row["titles"] else [""]:
                for text in (row["text"], wrapped, flat):
                    wanted[len(rows)] = row["license_id"]
                    rows.append((len(rows), f"{title}\n\n{owner}\n\n{text}", None, None, None))
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-2.0", "LGPL-2.1"} <= set(wanted.values())
    frame = spark.createDataFrame(rows, DOCUMENTS)
    found = {r.doc_id: r.license_id for r in licences.scan_licences(frame, licences.builtin_licences(spark)).collect()}
    assert [(d, i, found[d], rows[d][1][:80]) for d, i in wanted.items() if found[d] != i] == []


def test_licence_texts_with_owners_in_clauses_and_changed_clauses(spark):
    texts = dict(t for t in licences.licence_texts() if t[0] in ("BSD-3-Clause", "ISC", "MIT"))
    rows = [
        texts["BSD-3-Clause"].replace("the copyright holder nor", "Acme Corp. nor").replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "ACME"),
        texts["ISC"].replace("THE AUTHOR", "ACME").replace("THE\nAUTHOR", "ACME"),
        texts["MIT"].replace("without restriction", "for no evil"), texts["MIT"].replace("The above copyright notice", "The notice"),
        texts["BSD-3-Clause"].replace("the copyright holder nor", "Acme, " * 100 + "and others nor"),
    ]
    frame = spark.createDataFrame([(d, t, None, None, None) for d, t in enumerate(rows)], DOCUMENTS)
    found = {r.doc_id: r.license_id for r in licences.scan_licences(frame, licences.builtin_licences(spark)).collect()}
    assert found == {0: "BSD-3-Clause", 1: "ISC", 2: None, 3: None, 4: "BSD-3-Clause"}
