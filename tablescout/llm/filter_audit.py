"""What each filter of a chain removes, in every order of the filters, by counting paths through the subset lattice.

A state is the set of filters that were applied, an edge applies one more.  What an edge removes depends on
its two states only, not on the order in which the first was reached, so documents are counted once for each
set of filters that they fail.  Each edge then stands for (orders reaching its start) x (orders leaving its end)
orders; with these weights its removals sum to the Shapley value of its filter, and the steps of one order are
read from the edges of its path.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablescout.llm.common import UPPER

FILTERS = "ABCDE"
TEXT_FILTERS = 4  # those of FILTERS that see one text only; the last sees all
MOST_FILTERS = 7  # 5,040 orders of seven steps for each part
MARKS = "[#$%&*|]"
BLANKS = "\t\n\x0b\x0c\r"


class Edge(NamedTuple):
    state: int  # filters that were applied before, as bits
    filter: int
    reaching: int  # orders from no filter to the state
    leaving: int  # orders from the state after this edge to all filters


def lattice(count: int) -> list[Edge]:
    """The edges of the subset lattice with their path counts: forward from the empty set, backward from the full."""
    full = (1 << count) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(full + 1):
        for f in range(count):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in range(full, -1, -1):
        for f in range(count):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return [
        Edge(state, f, forward[state], backward[state | 1 << f])
        for state in range(full + 1) for f in range(count) if not state >> f & 1
    ]


def text_failures(documents: DataFrame) -> DataFrame:
    """Adds `failed`: bits of the filters that see one text - A few words, B repeated words, C capitals, D marks."""
    capitals = F.octet_length(F.regexp_replace("text", f"[^{UPPER[0]}-{UPPER[-1]}]+", ""))
    in_words = F.filter(F.split(F.translate("text", BLANKS, " " * len(BLANKS)), " "), lambda w: w != "")
    counted = documents.withColumn("words", in_words).withColumns(
        {"count": F.size("words"), "distinct": F.size(F.array_distinct("words"))}
    )
    fails = [
        F.col("count") < 100,
        F.col("distinct") * 100 < F.col("count") * 80,
        capitals.cast("long") * 100 > F.length("text") * 10,
        F.col("text").rlike(MARKS),
    ]
    failed = reduce(Column.__add__, (F.when(x, 1 << k).otherwise(0) for k, x in enumerate(fails)))
    return counted.withColumn("failed", failed).drop("words", "count", "distinct")


def document_failures(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic, n): documents counted by the filters A to E that they fail, as bits.

    Part is the language, empty for null.  E fails a document whose text is that of a smaller doc_id, wherever
    that is.  A document is good (toxic) if any label of its doc_id says so.  Null texts are empty and fail A;
    every row counts, also repeated ones.  A row without doc_id makes no other one fail E, nor does it fail it.
    An empty table gives no rows; other columns are ignored.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
    )
    seen = text_failures(rows).select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), "failed")
    seen = seen.groupBy("doc_id", "part", "digest", "failed").agg(F.count("*").alias("n"))
    marked = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    # rows without doc_id have no label and do not meet in the join
    unmarked = {name: F.lit(None).cast("boolean") for name in ("good", "toxic")}
    labelled = seen.where("doc_id IS NOT NULL").join(marked, "doc_id", "left").unionByName(
        seen.where("doc_id IS NULL").withColumns(unmarked)
    )
    labelled = labelled.withColumns({name: F.coalesce(name, F.lit(False)) for name in unmarked})
    # Copies of a text fail the same filters but E, which only its smallest doc_id passes.  So they are counted
    # together first, and the smallest doc_id is looked for among a few counts of a text, however many its copies.
    copies = labelled.groupBy("digest", "failed", "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    passing = F.col("nameless") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    split = copies.withColumn("least", least).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct("failed", passing.alias("n")),
            F.struct((F.col("failed") + (1 << TEXT_FILTERS)).alias("failed"), (F.col("n") - passing).alias("n")),
        )),
    )
    return split.where("n > 0").groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))


def edge_counts(counts: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Per part and edge (state, filter): what the filter keeps, removes and loses there, and its Shapley value.

    `counts` has rows (part, failed, good, toxic, n), at most four for each part and set of failed filters.
    """
    size = len(filters)
    if not 1 <= size <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters can be audited, not {size}")
    edges = counts.sparkSession.createDataFrame(lattice(size), "state int, filter int, reaching long, leaving long")
    met = (
        counts.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit((1 << size) - 1))))
        .withColumn("filter", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
        .withColumn("bit", F.expr("shiftleft(1, filter)"))
        .where(F.col("state").bitwiseAND(F.col("bit")) == 0)
    )
    before, fails = (F.col("failed").bitwiseAND(F.col(c)) != 0 for c in ("state", "bit"))
    removed = fails & ~before
    conditions = {
        "kept": ~before & ~fails, "removed": removed, "redundant": before & fails, "unique_fails": F.col("failed") == F.col("bit"),
        "good_lost": removed & F.col("good"), "toxic_lost": removed & F.col("toxic"),
    }
    summed = met.groupBy("part", "state", "filter").agg(
        *(F.sum(F.when(x, F.col("n")).otherwise(0)).alias(name) for name, x in conditions.items())
    )
    weight = F.col("removed") * F.col("reaching") * F.col("leaving")
    shapley = F.sum(weight).over(Window.partitionBy("part", "filter"))
    return summed.join(edges, ["state", "filter"]).withColumn("shapley", shapley).drop("reaching", "leaving")


def audit_orders(counts: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Per part, order of all filters and step: the counts of the edge that the order takes there.

    Parts are those of `counts`; zeros are included.
    """
    steps = []
    for order in permutations(range(len(filters))):
        name, state = "".join(filters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            steps.append((name, step, state, f))
            state |= 1 << f
    path = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, filter int")
    return edge_counts(counts, filters).join(path, ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
