"""Benchmark passages in training documents, by a broadcast set of word n-grams.

Words of both sides are numbered by the benchmark's own vocabulary; a word outside it can be in no window.
Documents are scanned window by window with a rolling hash of these numbers, and every hit is compared with
the benchmark's windows word by word before it counts.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import LOWER, UPPER, staged

NGRAM = 10
#: Words are runs of digits, ASCII letters and anything beyond ASCII, in lower case.
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Text of the benchmark that may be broadcast, in bytes; a larger one is scanned in parts of this size.
BROADCAST_BYTES = 32 << 20
_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _lower(text: str) -> str:
    return text.encode().translate(_TO_LOWER).decode()


def words_of(text: str | None) -> list[str]:
    return TOKEN.findall(_lower(text)) if text else []


class Windows:
    """The windows of benchmark items: n words, or the whole item where it has fewer."""

    def __init__(self, items: list[tuple[object, str | None]], n: int):
        self.number: dict[str, int] = {}
        self.items: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            for k in range(max(len(ids) - n + 1, min(1, len(ids)))):
                self.items[tuple(ids[k : k + n])].add("" if item is None else str(item))
        self.hashes = {
            size: np.unique(self._rolled(np.array([w for w in self.items if len(w) == size], np.uint64), size).ravel())
            for size in {len(w) for w in self.items}
        }

    @staticmethod
    def _rolled(rows: np.ndarray, size: int) -> np.ndarray:
        """Hash of every `size` numbers in a row (last axis)."""
        last = rows.shape[-1] - size + 1
        out = np.zeros((*rows.shape[:-1], last), np.uint64)
        for k in range(size):
            out = out * _MULTIPLIER + rows[..., k : k + last]
        return out

    def scan(self, words: list[str]) -> tuple[np.ndarray, set[str]]:
        """Which words lie inside a window, and the items whose windows occur."""
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        hit, found = np.zeros(len(ids), bool), set()
        for size, hashes in self.hashes.items():
            if len(ids) < size:
                continue
            unknown = np.concatenate([[0], np.cumsum(ids == 0)])
            starts = np.flatnonzero(unknown[size:] == unknown[:-size])  # windows of known words only
            if not len(starts):
                continue
            rolled = self._rolled(ids.astype(np.uint64), size)[starts]
            at = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
            for start in starts[hashes[at] == rolled]:
                items = self.items.get(tuple(ids[start : start + size].tolist()))
                if items:
                    hit[start : start + size] = True
                    found |= items
        return hit, found


def _without(text: str, hit: np.ndarray) -> str:
    """The text without its hit words and what stands between two of them."""
    out, end, before = [], 0, False
    for match, gone in zip(TOKEN.finditer(_lower(text)), hit, strict=True):
        if not (gone and before):
            out.append(text[end : match.start()])
        if not gone:
            out.append(text[match.start() : match.end()])
        end, before = match.end(), gone
    out.append(text[end:])
    return "".join(out)


def _runs(hit: np.ndarray) -> list[int]:
    """First and last-plus-one places of each run of hits, one after another."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).tolist()


def scan_benchmark(
    documents: DataFrame, benchmark: DataFrame, n: int = NGRAM, clean: bool = False, part_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_hit, items (item_ids as sorted text), and with `clean` the
    text without the hit spans.

    Null and empty texts, of either side, have no words.  A null item_id counts as the empty text; repeated
    items count once by their id.  Null and repeated doc_ids stay as they are, a row for a row; an empty
    benchmark hits nothing.  Other columns are ignored.

    The benchmark is broadcast after its size is measured.  One beyond `part_bytes` goes in parts of that size:
    each scans all documents, what it hits is written, and the spans of all parts are joined to the documents.
    """
    wanted = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items, parts = _parts(benchmark, part_bytes)
    if parts == 1:
        return _scanned(wanted, items, n, lambda batch, hits, found: _summary(batch, hits, found, clean), _schema(clean))
    key = F.sha2("text", 256)
    found = []
    for part in range(parts):
        some = items.where(_part_of(parts) == part)
        hits = _scanned(wanted, some, n, _spans, _SPANS).where(F.size("runs") > 0)
        found.append(staged(hits.select("doc_id", key.alias("key"), "runs", "items").distinct(), "benchmark-hits"))
    merged = reduce(DataFrame.unionAll, found).groupBy("doc_id", "key").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    keyed = wanted.withColumn("key", key)
    same = keyed["doc_id"].eqNullSafe(merged["doc_id"]) & (keyed["key"] == merged["key"])
    rows = keyed.join(merged, same, "left").select(
        keyed["doc_id"], keyed["text"], F.coalesce("runs", F.array().cast("array<int>")).alias("runs"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return _finished(rows, clean)


_SPANS = "doc_id long, text string, runs array<int>, items array<string>"


def _spans(batch: pa.RecordBatch, hits: list[np.ndarray], found: list[set[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("text"), pa.array([_runs(h) for h in hits], pa.list_(pa.int32())),
         pa.array([sorted(x) for x in found], pa.list_(pa.string()))],
        names=["doc_id", "text", "runs", "items"],
    )


def _schema(clean: bool) -> str:
    return "doc_id long, n_words long, n_hit long, items array<string>" + ", text string" * clean


def _summary(batch: pa.RecordBatch, hits: list[np.ndarray], found: list[set[str]], clean: bool) -> pa.RecordBatch:
    counts = [int(hit.sum()) for hit in hits]
    columns = [batch.column("doc_id"), pa.array(map(len, hits), pa.int64()), pa.array(counts, pa.int64()),
               pa.array([sorted(x) for x in found], pa.list_(pa.string()))]
    names = ["doc_id", "n_words", "n_hit", "items"]
    if clean:
        texts = [_without(t.as_py(), h) if c else t.as_py() for t, h, c in zip(batch.column("text"), hits, counts, strict=True)]
        columns, names = [*columns, pa.array(texts, pa.string())], [*names, "text"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def without_benchmark(
    documents: DataFrame, benchmark: DataFrame, n: int = NGRAM, part_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows, with all their columns, whose text holds no window of the benchmark; the rest goes whole.

    Edge cases as in `scan_benchmark`.  Of a benchmark in parts, each part scans what the one before has left.
    """
    items, parts = _parts(benchmark, part_bytes)
    schema = documents.schema
    for part in range(parts):
        some = items if parts == 1 else items.where(_part_of(parts) == part)
        documents = _scanned(
            documents, some, n, lambda batch, hits, _: batch.filter(pa.array([not h.any() for h in hits], pa.bool_())), schema
        )
        if part + 1 < parts:
            documents = staged(documents, "clean-so-far")
    return documents


def _parts(benchmark: DataFrame, part_bytes: int) -> tuple[DataFrame, int]:
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    # of rows that are repeated one is enough, and parts by hash are even
    items = items.where(F.length("text") > 0).distinct()
    size = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    return items, max(1, -(-size // part_bytes))


def _part_of(parts: int):
    return F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))


def _scanned(documents: DataFrame, items: DataFrame, n: int, out, schema) -> DataFrame:
    """What `out` makes of each batch, its rows' hit words and its rows' items."""
    shared = documents.sparkSession.sparkContext.broadcast([tuple(r) for r in items.collect()])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(shared.value, n)
        for batch in batches:
            scans = [windows.scan(words_of(text.as_py())) for text in batch.column("text")]
            yield out(batch, [hit for hit, _ in scans], [found for _, found in scans])

    return documents.mapInArrow(scanned, schema)


def _finished(rows: DataFrame, clean: bool) -> DataFrame:
    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [np.zeros(len(words_of(text.as_py())), bool) for text in batch.column("text")]
            for hit, runs in zip(hits, batch.column("runs").to_pylist(), strict=True):
                for a, b in zip(runs[::2], runs[1::2], strict=True):
                    hit[a:b] = True
            yield _summary(batch, hits, batch.column("items").to_pylist(), clean)

    return rows.mapInArrow(finished, _schema(clean))
