"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each decision has a tree of contexts, the 0 to DEPTH bytes before it.  Every
node holds counts of zeros and ones and their Krichevsky-Trofimov probability; its weighted probability is half
that and half the product of its children's.  The probability of a coming bit mixes the estimates of all depths
on its path by these weights, so the whole tree gives one code length for a text.

A text is coded as its lower-cased (A-Z) words, one blank between them and a new line at the end.

How it is spread: documents are dealt into blocks of about BLOCK_BYTES by a hash of their ids.  Each block gives
the byte grams and words it holds, with their training counts.  Spark adds them up, builds the tree level by
level, each level an aggregate of the one below, and takes weights down again by joins.  Each block then gets
back the probabilities of its own grams and the counts of its own words only, however large the model is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablescout.llm.common import fold, lowered, pieces, separators, staged, text_bytes, word_hashes

DEPTH = 5  # bytes of context
BLOCK_BYTES = 32 << 20
_GAPS = separators(b" \n")
_LOWER = bytes(lowered(np.arange(256, dtype=np.uint8)))
_GRAM, _WORD, _END = 0, 1, 2
_LN2 = math.log(2)


def coded(text: bytes) -> bytes:
    return b" ".join(text.translate(_LOWER).split()) + b"\n"


def grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all bytes of coded texts: the byte with its context as one number; and the texts' bytes and offsets."""
    pad = b"\n" * depth
    data = np.frombuffer(b"".join(pad + text for text in texts), np.uint8)
    lengths = np.array([len(text) for text in texts], np.int64)
    keys = np.zeros(max(len(data) - depth, 0), np.int64)
    for k in range(depth + 1):
        keys = (keys << 8) | data[k : k + len(keys)]
    ends = np.cumsum(lengths + depth) - depth
    inside = np.ones(len(keys), bool)
    for k in range(depth):  # what is coded in a pad belongs to no text
        inside[ends[:-1] + k] = False
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return keys[inside], np.frombuffer(b"".join(texts), np.uint8), offsets


class _Counts:
    """Distinct keys with added counts, merged from time to time."""

    def __init__(self, most: int = 1 << 20):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.most = 0, most

    def add(self, keys: np.ndarray, training: np.ndarray) -> None:
        for chosen, weight in ((keys[training], 1), (keys[~training], 0)):
            found, counts = np.unique(chosen, return_counts=True)
            self.parts.append((found, counts * weight))
            self.size += len(found)
        if self.size > self.most:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])
            self.most = max(self.most, 2 * self.size)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([p[0] for p in self.parts]) if self.parts else np.zeros(0, np.int64)
        counts = np.concatenate([p[1] for p in self.parts]) if self.parts else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = batch.column("text")
    lengths = np.array([len(t.as_buffer()) for t in texts], np.int64)
    for a, b in pieces(lengths, 1 << 20):
        yield a, b, [coded(t.as_py()) for t in texts[a:b]]


def _counted(documents: DataFrame, depth: int) -> DataFrame:
    """(block, kind, key, n): grams and words of each block with their training counts, 0 for none."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, words, ends, block = _Counts(), _Counts(), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column("block")[0].as_py()
            training = batch.column("training").to_numpy(zero_copy_only=False)
            ends += int(training.sum())
            for a, b, texts in _texts(batch):
                keys, data, offsets = grams(texts, depth)
                found.add(keys, np.repeat(training[a:b], np.diff(offsets)))
                hashes, bounds = word_hashes(data, offsets, _GAPS)
                words.add(hashes.view(np.int64), np.repeat(training[a:b], np.diff(bounds)))
        for kind, (keys, counts) in (
            (_GRAM, found.merged()), (_WORD, words.merged()), (_END, (np.zeros(1, np.int64), np.array([ends])))
        ):
            for first in range(0, len(keys), 1 << 18):
                some = slice(first, first + (1 << 18))
                count = len(keys[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(count, block, np.int32)), pa.array(np.full(count, kind, np.int32)),
                     pa.array(keys[some]), pa.array(counts[some])],
                    names=["block", "kind", "key", "n"],
                )

    return documents.groupBy("block").applyInArrow(
        _batchwise(counted), "block int, kind int, key long, n long"
    )


def _batchwise(function):
    """With the types in its signature that tell Spark to stream batches."""

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)

    streamed.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return streamed


def _ln_gamma(x: Column) -> Column:
    """Stirling's series eight above, taken back by the product below it."""
    x = x.cast("double")
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    below = reduce(lambda p, k: p * (x + k), range(1, 8), x)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(below)


def _ln_kt(zeros: Column, ones: Column) -> Column:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _ln_gamma(zeros + 0.5) + _ln_gamma(ones + 0.5) - math.log(math.pi) - _ln_gamma(zeros + ones + 1)


def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight decisions of each gram's last byte: place (context * 256 + decision) and bit, a column each."""
    byte, context = keys & 255, (keys >> 8) << 8
    steps = range(8)
    return (
        np.column_stack([context + (1 << k) + (byte >> (8 - k)) for k in steps]),
        np.column_stack([byte >> (7 - k) & 1 for k in steps]),
    )


def _by_context(function):
    """Batches of rows sorted by context, cut so that no context is parted between two calls."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            kept = table if kept is None else pa.concat_tables([kept, table])
            context = kept.column("context").to_numpy()
            done = int(np.searchsorted(context, context[-1]))
            if done:
                yield function(kept.slice(0, done))
                kept = kept.slice(done)
        if kept is not None:
            yield function(kept)

    return whole


def _deepest(counts: DataFrame) -> DataFrame:
    """(place, zeros, ones) of all decisions at full depth, from rows (key, n)."""

    def summed(rows: pa.Table) -> pa.RecordBatch:
        places, bits = _places(rows.column("key").to_numpy())
        n = np.repeat(rows.column("n").to_numpy(), 8).astype(float)
        found, at = np.unique(places.ravel(), return_inverse=True)
        ones = np.bincount(at, n * bits.ravel(), len(found))
        zeros = np.bincount(at, n, len(found)) - ones
        return pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(zeros.astype(np.int64)), pa.array(ones.astype(np.int64))],
            names=["place", "zeros", "ones"],
        )

    rows = counts.withColumn("context", F.shiftright("key", 8)).repartition("context").sortWithinPartitions("context")
    return rows.mapInArrow(_by_context(summed), "place long, zeros long, ones long")


def _gram_values(counts: DataFrame, ones: DataFrame) -> DataFrame:
    """(key, value): the log10 probabilities of the eight bits of each gram added up, from rows (place, p)."""

    def added(rows: pa.Table) -> pa.RecordBatch:
        number, p = rows.column("number").to_numpy(), rows.column("p").to_numpy(zero_copy_only=False)
        is_gram = np.isnan(p)
        order = np.argsort(number[~is_gram])
        places, chance = number[~is_gram][order], p[~is_gram][order]
        keys = number[is_gram]
        wanted, bits = _places(keys)
        found = chance[np.searchsorted(places, wanted)]
        value = np.log10(np.where(bits == 1, found, 1 - found)).sum(axis=1)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(value)], names=["key", "value"])

    grams = counts.select(F.col("key").alias("number"), F.lit(float("nan")).alias("p"))
    rows = grams.unionAll(ones).withColumn("context", F.shiftright("number", 8))
    return rows.repartition("context").sortWithinPartitions("context").mapInArrow(_by_context(added), "key long, value double")


def gram_scores(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, value): log10 probability of each gram's byte in its context, from rows (key, n) of distinct keys.

    Grams with n = 0 are scored by what the tree knows of shorter contexts.
    """
    kt = _ln_kt(F.col("zeros"), F.col("ones"))
    levels = [staged(_deepest(counts).withColumns({"own": kt, "weighted": kt}), f"context-{depth}")]
    for d in range(depth - 1, -1, -1):
        above = levels[-1].groupBy(F.col("place").bitwiseAND((1 << 8 * (d + 1)) - 1).alias("place")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below")
        )
        above = above.withColumn("own", kt)
        most = F.greatest("own", "below")
        weighted = most + F.log(F.exp(F.col("own") - most) + F.exp(F.col("below") - most)) - _LN2
        levels.append(staged(above.select("place", "zeros", "ones", "own", weighted.alias("weighted")), f"context-{d}"))
    # downwards: what is mixed so far, and the weight left for deeper contexts
    estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    mixed = None
    for d in range(depth + 1):
        level = levels[depth - d].withColumn("estimate", estimate)
        stop = F.exp(F.col("own") - F.col("weighted") - _LN2) if d < depth else F.lit(1.0)
        if mixed is None:
            level = level.withColumns({"so_far": F.lit(0.0), "left": F.lit(1.0)})
        else:
            parent = mixed.withColumnRenamed("place", "parent")
            up = F.col("place").bitwiseAND((1 << 8 * d) - 1)
            level = level.withColumn("up", up).join(parent, F.col("up") == F.col("parent"))
        mixed = level.select(
            "place", (F.col("so_far") + F.col("left") * stop * F.col("estimate")).alias("so_far"),
            (F.col("left") * (1 - stop)).alias("left"),
        )
    return _gram_values(counts, mixed.select(F.col("place").alias("number"), F.col("so_far").alias("p")))


def _scored(documents: DataFrame, slices: DataFrame, depth: int, tokens: int, known: int) -> DataFrame:
    """Each block's documents by its own slice of grams and words."""
    floor = 0.1
    whole = tokens + floor * (known + 1)

    def looked_up(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
        rows = table.filter(pa.compute.equal(table.column("kind"), kind))
        keys, values = rows.column("key").to_numpy(), rows.column("value").to_numpy()
        order = np.argsort(keys)
        return keys[order], values[order]

    def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bounds) - 1)
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            out[full] = np.add.reduceat(values, bounds[full])
        return out

    def scored(rows: pa.Table, slice_: pa.Table) -> pa.Table:
        gram_keys, gram_values = looked_up(slice_, _GRAM)
        word_keys, word_values = looked_up(slice_, _WORD)
        end = float(looked_up(slice_, _END)[1].sum()) if slice_.num_rows else 0.0
        out = []
        for batch in rows.to_batches():
            for a, b, texts in _texts(batch):
                keys, data, offsets = grams(texts, depth)
                score = sums(gram_values[np.searchsorted(gram_keys, keys)], offsets)
                hashes, bounds = word_hashes(data, offsets, _GAPS)
                counts = word_values[np.searchsorted(word_keys, hashes.view(np.int64))] if len(hashes) else np.zeros(0)
                base = sums(np.log10((counts + floor) / whole), bounds) + math.log10((end + floor) / whole)
                n_known = sums((counts > 0).astype(float), bounds).astype(np.int64) + int(end > 0)
                size = np.diff(offsets)
                out.append(pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], pa.array(~batch.column("training").to_numpy(zero_copy_only=False)[a:b]),
                     pa.array(np.diff(bounds) + 1), pa.array(n_known), pa.array(np.full(b - a, tokens, np.int64)),
                     pa.array(base), pa.array(score), pa.array(-score * math.log2(10) / size)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
                ))
        return pa.Table.from_batches(out)

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, bits_per_byte double"
    )
    return documents.groupBy("block").cogroup(slices.groupBy("block")).applyInArrow(scored, schema)


def score_documents(documents: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of documents: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from rows whose crc32(doc_id as text) mod 10 is not 0; a null id counts as the empty text and is held
    out.  Null and blank texts are the end token alone.  Null and repeated ids stay, a row for a row, and each
    repeated training row counts again.  An empty table gives no rows; without training rows every bit has
    probability a half.  Words are told apart by 64-bit hashes.  Other columns are ignored.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), 10) != 0).alias("training"),
        text_bytes(F.col("text")).alias("text"),
    )
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    # rows of a repeated id are spread by their texts
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(blocks)).cast("int"))
    # One shuffle by key both adds up the blocks' counts and gives them back to each block.
    of_key = Window.partitionBy("kind", "key")
    totals = _counted(rows, depth).withColumns({
        "total": F.sum("n").over(of_key), "first": F.row_number().over(of_key.orderBy("block")) == 1,
    })
    totals = staged(totals.drop("n"), "totals")
    distinct = totals.where("first")
    known = distinct.where(F.col("kind") != _GRAM).agg(F.sum("total"), F.sum((F.col("total") > 0).cast("long"))).first()
    values = staged(
        gram_scores(distinct.where(F.col("kind") == _GRAM).select("key", F.col("total").alias("n")), depth), "gram-values"
    )
    grams_of = totals.where(F.col("kind") == _GRAM).select("block", "kind", "key").join(values, "key")
    words_of = totals.where(F.col("kind") != _GRAM).select("block", "kind", "key", F.col("total").cast("double").alias("value"))
    slices = words_of.unionByName(grams_of)
    return _scored(rows, slices, depth, int(known[0] or 0), int(known[1] or 0))
