"""Near-duplicates by SimHash fingerprints that differ in few bits.

Fingerprints are embedded as the numbers of set bits in their segments.  One bit that differs moves one of
these counts by one at most, so the Manhattan distance of two embeddings is a lower bound of the differing
bits.  Of two fingerprints at DISTANCE or less, one half of the embedding is therefore at distance one or less:
the counts of that half are a cell of a grid, and a fingerprint meets all others in the cells of its two
halves and in those that are one count higher.  Pairs that meet are compared on all 64 bits.

What keeps hot groups apart: documents of one fingerprint are one class from the start.  A cell with more
classes than BLOCK is dealt out in blocks, and whatever probes it meets every block.  Of the pairs of a large
cell only those leave the task that join parts which were still apart in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import flat_bytes, staged, text_bytes
from tablescout.llm.near_duplicates import components

DISTANCE = 3
SEED = 42
SEGMENT = 2  # bits of a segment: 1, 2 or 4
BLOCK = 4096  # classes of a cell that are compared by one task
LARGE = 64  # rows of a cell from which on its pairs are reduced to joining ones
HOT_ROWS = 100_000  # documents of one fingerprint that are joined back in one partition
_HALF = 32


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """Unsigned XXH64 of every run of `words` words, repeats included; of the whole sequence where there are fewer."""
    found = text.lower().split()
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if found else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    bounds = zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in bounds), np.uint64, len(found) - words + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; zero without any."""
    counts = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        some = hashes[first : first + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, words: int) -> DataFrame:
    """(doc_id, print) for each row."""

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch.column("text"))
            prints = [fingerprint(shingle_hashes(data[a:b].tobytes(), words)) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["doc_id", "print"]
            )

    wanted = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("text"))
    return wanted.mapInArrow(printed, "doc_id long, print long")


def _every(bits: int, field: int) -> int:
    """A mask with the lowest `bits` bits of each field of a half set."""
    return sum(((1 << bits) - 1) << k for k in range(0, _HALF, field))


def segment_counts(half: Column, segment: int) -> Column:
    """Numbers of set bits of the segments of a half, each in the place of its segment."""
    counts, width = half, 1
    while width < segment:
        low = F.lit(_every(width, 2 * width))
        counts = counts.bitwiseAND(low) + F.shiftrightunsigned(counts, width).bitwiseAND(low)
        width *= 2
    return counts


def _cells(print_: Column, segment: int) -> Column:
    """Array of (cell, probe): the cells of both halves, and as probes those one count higher in one segment."""
    out = []
    for half in (0, 1):
        bits = F.shiftrightunsigned(print_, _HALF * half).bitwiseAND(F.lit((1 << _HALF) - 1))
        counts = segment_counts(bits, segment)
        cell = counts + F.lit(half << _HALF)
        out.append(F.struct(cell.alias("cell"), F.lit(False).alias("probe")))
        for k in range(0, _HALF, segment):
            more = F.shiftrightunsigned(counts, k).bitwiseAND(F.lit((1 << segment) - 1)) < segment
            out.append(F.when(more, F.struct((cell + F.lit(1 << k)).alias("cell"), F.lit(True).alias("probe"))))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between members of a block of a cell and all that come later in it, from sorted rows.

    Rows of the block's members (no probe) come first; they are held until the last row of the block is
    there, BLOCK rows or so.  Probes pass by.
    """
    names = ["cell", "block", "own", "probe", "node", "print"]
    held = {c: np.zeros(0, np.int64) for c in names}
    for batch in batches:
        if not batch.num_rows:
            continue
        new = {c: batch.column(c).cast(pa.int64()).to_numpy() for c in names}
        rows = {c: np.concatenate([held[c], new[c]]) for c in names}
        old = len(held["cell"])
        bounds = np.flatnonzero((np.diff(rows["cell"]) != 0) | (np.diff(rows["block"]) != 0)) + 1
        starts, ends = np.concatenate([[0], bounds]), np.concatenate([bounds, [len(rows["cell"])]])
        sizes = ends - starts
        small = np.flatnonzero(sizes < LARGE)
        found = [_small_groups(rows, starts[small], sizes[small], old)]
        found += [_large_group({c: v[a:b] for c, v in rows.items()}, max(old - a, 0))
                  for a, b in zip(starts[sizes >= LARGE], ends[sizes >= LARGE], strict=True)]
        pairs = np.concatenate(found)
        if len(pairs):
            low, high = np.minimum(pairs[:, 0], pairs[:, 1]), np.maximum(pairs[:, 0], pairs[:, 1])
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])
        last = slice(starts[-1], ends[-1])
        member = _member(rows["own"][last], rows["block"][last], rows["probe"][last])
        held = {c: v[last][member] for c, v in rows.items()}


def _member(own: np.ndarray, block: np.ndarray, probe: np.ndarray) -> np.ndarray:
    return (probe == 0) & (own == block)


def _small_groups(rows: dict[str, np.ndarray], starts: np.ndarray, sizes: np.ndarray, old: int) -> np.ndarray:
    """Links within many small groups at once, by comparing rows that are 1, 2, ... apart.  Rows before `old`
    have been compared with each other."""
    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    group = np.repeat(np.arange(len(sizes)), sizes)
    prints, node = rows["print"][at].view(np.uint64), rows["node"][at]
    member = _member(rows["own"][at], rows["block"][at], rows["probe"][at])
    found = [np.zeros((0, 2), np.int64)]
    for apart in range(1, int(sizes.max(initial=1))):
        i = np.flatnonzero((group[apart:] == group[:-apart]) & member[:-apart] & (at[apart:] >= old))
        near = i[np.bitwise_count(prints[i] ^ prints[i + apart]) <= DISTANCE]
        found.append(np.stack([node[near], node[near + apart]], axis=1))
    return np.concatenate(found)


def _large_group(rows: dict[str, np.ndarray], old: int) -> np.ndarray:
    """Links within one group that join what no earlier link of this call has joined.  Its first `old` rows are
    members that have been compared with each other."""
    member = _member(rows["own"], rows["block"], rows["probe"])
    count = int(member.sum())  # members come first
    prints, node = rows["print"].view(np.uint64), rows["node"]
    label, found = np.arange(count), []
    step = max(1, (1 << 20) // max(count, 1))
    for first in range(old, len(node), step):
        last = min(first + step, len(node))
        near = np.bitwise_count(prints[first:last, None] ^ prints[None, :count]) <= DISTANCE
        near &= np.arange(count) < np.arange(first, last)[:, None]
        for i in np.flatnonzero(near.any(axis=1)):
            with_ = np.flatnonzero(near[i])
            labels, where = np.unique(label[with_], return_index=True)
            found += [(node[first + i], node[k]) for k in with_[where]]
            if first + i < count:  # a member takes its place in what it has joined
                labels = np.append(labels, label[first + i])
                label[np.isin(label, labels)] = labels.min()
    return np.array(found, np.int64).reshape(-1, 2)


def links(classes: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """Links (a, b) of nodes that connect all classes (node, print) whose prints differ in DISTANCE bits or less.

    Every such pair is connected by the links; of large cells not every pair is a link of its own.
    """
    placed = classes.select("node", "print", F.explode(_cells(F.col("print"), segment)).alias("c")).select("node", "print", "c.*")
    hot = placed.where("NOT probe").groupBy("cell").count().where(F.col("count") > block)
    # written first, so that Spark knows its size: a few cells as a rule
    hot = staged(hot.select("cell", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "hot-cells")
    # a member is compared with its block and, as a probe, with the blocks after it; a real probe with all of them
    dealt = (
        placed.join(hot, "cell", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("print", F.lit(block)), F.col("blocks")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.when(F.col("probe"), 0).otherwise(F.col("own")), F.col("blocks") - 1)))
        .select("cell", "block", "own", "probe", "node", "print")
    )
    # members before probes; of those that probe as members of other blocks the same holds
    in_groups = dealt.repartition("cell", "block").sortWithinPartitions(
        "cell", "block", (F.col("probe") | (F.col("own") != F.col("block"))), "print"
    )
    return in_groups.mapInArrow(_linked, "a long, b long")


def near_duplicates(documents: DataFrame, words: int = 3, segment: int = SEGMENT) -> DataFrame:
    """Per row of documents: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id that can be
    reached over fingerprints which differ in DISTANCE bits or less).

    Texts are lower-cased (A-Z) and parted at ASCII white space.  Null, empty and blank texts have fingerprint
    zero, which is linked like any other.  Rows that share a doc_id count as one document: what is linked to one is
    linked to all.  A row without doc_id has its fingerprint but is linked with nothing, its component is null.  An
    empty table gives no rows; other columns are ignored.
    """
    printed = staged(fingerprints(documents, words), "fingerprints")
    named = printed.where("doc_id IS NOT NULL")
    classes = named.groupBy("print").agg(F.min("doc_id").alias("node"), F.count("*").alias("n"))
    classes = staged(classes, "classes")
    found = staged(links(classes, segment).distinct(), "links")
    # a doc_id with several fingerprints links them
    several = named.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low <> high")
    same_id = (
        named.join(several, "doc_id", "left_semi").distinct().join(classes, "print")
        .where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    labels = components(found.unionByName(same_id))
    # frequent fingerprints, at most one for HOT_ROWS documents, are joined back in several partitions
    of_print = (
        classes.join(labels, "node", "left")
        .select("print", F.coalesce("label", "node").alias("component_id"), F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("salts"))
    )
    of_print = staged(of_print, "components")
    hot = staged(of_print.where("salts > 1").select("print", "salts"), "hot-prints")
    salted = printed.join(hot, "print", "left").withColumn(
        "salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("salts"))).cast("int")
    )
    spread = of_print.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    joined = salted.join(spread, ["print", "salt"], "left")
    return joined.select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
