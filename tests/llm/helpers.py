"""Small tables with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = {k: k + 32 for k in range(65, 91)}


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(UPPER))


def fold(doc_id, modulus: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def prose(seed: int, count: int, lang: str = "en") -> str:
    random_ = random.Random(seed)
    parts = {"en": "th er ing on re at ou nd", "fr": "é eau ou ment è tion que ai", "de": "sch ung ü ein lich ß heit er"}[lang].split()
    return " ".join("".join(random_.choices(parts, k=random_.randint(1, 3))) for _ in range(count)).capitalize() + "."


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, one very long text, repeated rows and ids, no letters."""
    base = prose(1, 60)
    rows = [(k, prose(k, 20 + 7 * k % 90, ("en", "fr", "de")[k % 3]), ("en", "fr", "de")[k % 3], f"s{k % 4}", 5) for k in range(20)]
    rows += [
        (100, None, "en", "s0", None), (101, "", "en", "s1", 0), (102, " \t\n ", None, "s2", 4), (103, "one", "en", None, 3),
        (104, "ONE", None, "s1", 3), (105, base, "en", "s0", 9), (106, base, "en", "s0", 9), (107, base + " tail", "en", "s3", 9),
        (107, base + " tail", "en", "s3", 9), (108, "12345 !!! 😀 \x00", "en", "s0", 9), (None, base, "en", "s0", 9),
        (None, None, None, None, None), (109, prose(5, 30000), "en", "s2", 1), (110, "two words", "en", "s2", 9),
        (111, prose(2, 40), "en", "s1", 1), (111, prose(3, 40), "en", "s1", 1), (-5, "Éa " * 50, "fr", "s1", 7),
    ]
    return rows


def awkward(spark):
    """The rows above in a table that also has columns of names the operators use inside."""
    frame = spark.createDataFrame(awkward_rows(), DOCUMENTS).repartition(5)
    clashing = ["score", "block", "node", "label", "features", "target", "size", "training", "mark", "bucket", "shard", "nth"]
    return frame.withColumns({name: F.lit("x") for name in clashing})


@pytest.fixture(scope="module")
def documents(spark):
    return awkward(spark)


def empty(spark, schema: str = DOCUMENTS):
    return spark.createDataFrame([], schema)


def shingles(text: str | None, k: int) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def duplicate_components(rows: list[tuple], k: int, percent: int) -> dict:
    """doc_id to the smallest reachable doc_id, rows of one id being one document."""
    known = [(d, shingles(t, k)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in known}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(known):
        for b, y in known[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d in parent}
