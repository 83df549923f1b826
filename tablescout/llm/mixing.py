"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with ratio r = target / size is due r copies: floor(r) of them certain, the rest with
probability p = r - floor(r).  Two documents with probabilities strictly between 0 and 1 are paired, and words
of expectation are moved from one to the other, in a random direction that keeps both expectations, until one
of the two is integral.  Each step keeps the source's expected words exactly, so a source misses its target by
at most a part of one document.  Groups of documents are rounded on their own, each leaves one fractional
document at most, and those are combined level by level in a reduction tree.  Where the last one leaves a source
off its target, a document of fitting size makes up for it, twice at most, the only steps that are not random.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablescout.llm.common import WORD, staged

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
GROUP = 4096  # documents rounded together at the leaves of the tree
PIECE = 1 << 16  # neighbouring rows, of which equal ones are numbered by one task
FAN_IN = 256  # fractional documents combined by one node above
CORRECTIONS = 2
_SURE = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, weight, target) from rows (source, size).

    Sources in code point order, null last, take the weights in turn.  Targets share the total by weight; those
    above `most` times their source stop there and the rest is shared anew until none is above.  One row a
    source passes through one task for its place in the order; the sharing adds up sums in Spark.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cases = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = staged(sources.withColumn("weight", cases.cast("double")), "sources")
    room = most * F.col("source_size")
    total = float(sources.select(F.sum("source_size")).first()[0] or 0)
    stopped, share = 0, 0.0
    while True:
        full = room <= F.lit(share) * F.col("weight") if stopped else F.lit(False)
        free = sources.select(
            F.sum(F.when(full, room).otherwise(0)).alias("held"), F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not free.open:
            break
        share = (total - free.held) / free.open
        over = sources.where(room < F.lit(share) * F.col("weight")).count()
        if over == stopped:
            break
        stopped = over
    shared = F.least(room.cast("double"), F.lit(share) * F.col("weight"))
    return sources.withColumn("target", shared)


def _rounded(p: np.ndarray, size: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Probabilities after pairing: all 0 or 1 but one at most, with the sum of p * size unchanged."""
    p = p.copy()
    held = -1
    draws = random.random(len(p))
    for k in range(len(p)):
        if not _SURE < p[k] < 1 - _SURE:
            continue
        if held < 0:
            held = k
            continue
        i, j = held, k
        up = min((1 - p[i]) * size[i], p[j] * size[j])  # words that can go from j to i
        down = min(p[i] * size[i], (1 - p[j]) * size[j])
        moved = up if draws[k] * (up + down) < down else -down
        p[i] += moved / size[i]
        p[j] -= moved / size[j]
        for x in (i, j):
            p[x] = 0.0 if p[x] <= _SURE else 1.0 if p[x] >= 1 - _SURE else p[x]
        held = i if 0 < p[i] < 1 else j if 0 < p[j] < 1 else -1
    return p


_ROW = "row long, doc_id long, source string, size long, nth long, source_size long, target double, sure long, rank long, node long, p double"
_NAMES = [column.split()[0] for column in _ROW.split(", ")]


def _level(rows: DataFrame, level: int, seed: int) -> DataFrame:
    """The rows with p rounded within each (source, node), large documents first: what stays fractional to the
    end is then a small one as a rule."""

    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of one node, which may cross batches

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key = [seed, level, rows.column("node")[0].as_py(), *(rows.column("source")[0].as_py() or "").encode(), 0]
            size = rows.column("size").to_numpy(zero_copy_only=False).astype(float)
            p = _rounded(rows.column("p").to_numpy(zero_copy_only=False), size, np.random.default_rng(key))
            return pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(p)], names=_NAMES)

        last = None
        for batch in batches:
            keys = list(zip(batch.column("source").to_pylist(), batch.column("node").to_pylist(), strict=True))
            first = 0
            for row, key in enumerate([*keys, None]):
                if key != last or row == len(keys):
                    if row > first:
                        held.append(batch.slice(first, row - first))
                    if row < len(keys) and held:
                        yield done()
                        held = []
                    first, last = row, key if row < len(keys) else last
        if held:
            yield done()

    return (
        rows.repartition("source", "node")
        .sortWithinPartitions("source", "node", F.col("size").desc(), "rank", "doc_id")
        .mapInArrow(rounded, _ROW)
    )


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 42,
    group: int = GROUP,
    fan_in: int = FAN_IN,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row of documents: doc_id, source, size, source_size, target (its source's), copies and taken words,
    and the columns to keep.

    Null texts have size 0.  Documents of size 0 have no copies and take nothing.  A null source is a source of
    its own; null and repeated doc_ids are rows like others, and rows equal in doc_id, source, text and the columns to
    keep share their copies in an order of no meaning.  An empty table gives no rows; other columns are ignored.  The
    choice depends on seed and data only, not on how Spark deals them out.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"), F.xxhash64("text", *keep).alias("mark"),
        F.monotonically_increasing_id().alias("row"), *keep,
    )
    # with what is to be kept, so that a row has its number for good and is joined back by that
    rows = staged(rows, "rows")
    mixed = mix_sizes(numbered(rows.select("row", "doc_id", "source", "size", "mark")), weights, most, seed, group, fan_in)
    if not keep:
        return mixed.drop("row", "nth")
    return mixed.join(rows.select("row", *keep), "row").drop("row").select(
        "doc_id", "source", "size", *keep, "source_size", "target", "copies", "taken"
    )


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with nth: 1, 2, ... among those equal in doc_id, source, size and mark.

    Done in two steps, so that a group of a third of all rows is not numbered by one task: within pieces of at most
    PIECE neighbouring rows, and for each piece how many come before it.
    """
    key = ["doc_id", "source", "size", "mark"]
    pieces = rows.withColumn("piece", F.expr(f"row div {PIECE}"))
    counts = pieces.groupBy(*key, "piece").count()
    earlier = Window.partitionBy(*key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*(F.col(c).alias(f"of_{c}") for c in [*key, "piece"]), F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    within = pieces.withColumn("within", F.row_number().over(Window.partitionBy(*key, "piece").orderBy("row")))
    same = reduce(Column.__and__, (within[c].eqNullSafe(counts[f"of_{c}"]) for c in [*key, "piece"]))
    return within.join(counts, same).select("row", *key, (F.col("within") + F.col("before")).alias("nth"))


def mix_sizes(rows: DataFrame, weights=WEIGHTS, most=MOST_COPIES, seed=42, group=GROUP, fan_in=FAN_IN) -> DataFrame:
    """`mix` for rows (doc_id, source, size, nth), nth telling apart rows that are equal else.

    They may have a unique `row` to be known by, and a `mark` of what else tells them apart.
    """
    if "row" not in rows.columns:
        rows = rows.withColumns({"row": F.monotonically_increasing_id(), "mark": F.lit(0)})
    rows = staged(rows, "numbered")
    targets = source_targets(rows, weights, most)
    groups = max(1, -(-rows.count() // group))
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sure = F.when(F.col("size") > 0, F.floor(due + _SURE)).otherwise(0).cast("long")
    rank = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size", "mark", "nth")
    joined = rows.join(targets, rows["source"].eqNullSafe(targets["source"]), "inner").drop(targets["source"])
    rated = staged(
        joined.select(
            "row", "doc_id", "source", "size", F.col("nth").cast("long").alias("nth"), "source_size", "target", sure.alias("sure"), rank.alias("rank"),
            F.pmod(rank, F.lit(groups)).alias("node"),
            F.when(F.col("size") > 0, F.greatest(due - F.floor(due + _SURE), F.lit(0.0))).otherwise(0.0).alias("p"),
        ),
        "rated",
    )
    open_ = F.col("p").between(_SURE, 1 - _SURE)
    settled, pending, level = [rated.where(~open_).withColumn("whole", F.lit(True))], rated.where(open_), 0
    while True:
        done = staged(_level(pending, level, seed), f"rounded-{level}")
        if groups == 1:
            settled.append(done.withColumn("whole", F.lit(False)))  # with one fractional document a source, taken if that is the likelier
            break
        settled.append(done.where(~open_).withColumn("whole", F.lit(False)))
        groups, level = -(-groups // fan_in), level + 1
        pending = done.where(open_).withColumn("node", F.pmod("node", F.lit(groups)))
    rows = staged(reduce(DataFrame.unionAll, settled).withColumn("extra", (F.col("p") >= 0.5).cast("long")), "drawn")
    for _ in range(CORRECTIONS):
        rows = staged(_corrected(rows, most), "corrected")
    copies = F.col("sure") + F.col("extra")
    return rows.withColumn("copies", copies).select(
        "row", "doc_id", "source", "size", "nth", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def _corrected(rows: DataFrame, most: int) -> DataFrame:
    """The rows with one document of each source changed by one copy where that brings it nearer its target.

    What is left of the last fractional document can be much in a source of few, very unequal documents.
    """
    copies = F.col("sure") + F.col("extra")
    misses = rows.groupBy("source").agg((F.max("target") - F.sum(copies * F.col("size"))).alias("miss"))
    misses = misses.withColumnRenamed("source", "missing")
    cost = F.abs(F.abs("miss") - F.col("size"))
    can = F.when(F.col("miss") > 0, (F.col("extra") == 0) & (copies < most)).otherwise(F.col("extra") == 1)
    picks = (
        rows.join(misses, rows["source"].eqNullSafe(misses["missing"]))
        .where(can & (F.col("size") > 0) & (cost < F.abs("miss")) & ~F.col("whole"))
        .groupBy("source", "miss")
        .agg(F.min(F.struct(cost.alias("cost"), "rank", "row")).alias("pick"))
        .select(F.col("source").alias("picked"), "pick", F.signum("miss").cast("long").alias("step"))
    )
    this = F.col("row").eqNullSafe(F.col("pick.row"))
    joined = rows.join(picks, rows["source"].eqNullSafe(picks["picked"]), "left")
    changed = F.col("extra") + F.when(this, F.col("step")).otherwise(0)
    return joined.withColumn("extra", changed).drop("picked", "pick", "step")
