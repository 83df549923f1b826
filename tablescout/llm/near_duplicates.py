"""Near-duplicates by circulant MinHash, banding and exact Jaccard similarity.

A signature needs two permutations: one shuffles the shingles, the other is shifted circularly by 0, 1, 2, ... to
give all coordinates.  Four coordinates make a band; texts that share a band are candidates, and candidates
are compared on their full shingle sets.  The number of bands follows from the wanted similarity, so that a
link is missed with a probability of MISSED at most.

What keeps hot groups apart: texts with one shingle set are one class from the start.  A bucket's classes are
first compared with one leader only, another one in each of the buckets that they share, and what is similar
is joined; this is done STARS times.  Then only pairs between still unconnected parts of a bucket are left.
These are compared to the last one, in pairs of blocks, so no link that joins two components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import SPACES, flat_bytes, lowered, mixed, pieces, separators, staged, text_bytes, word_hashes

ROWS = 4  # coordinates in a band
MISSED = 1e-7
STARS = 2
BLOCK = 512  # classes in a block of a bucket
WIDE = 4  # blocks that are compared as one by their signatures, which are short
PIECE = 1 << 20  # bytes of texts that are hashed at once
TOGETHER = 2048  # rows of small groups that are compared by one call
_SPACE = separators(SPACES)
_FIRST, _SECOND = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** ROWS))


def least_agreement(percent: int) -> int:
    """Equal coordinates that a pair of the wanted similarity has but for what the bands leave of MISSED: the exact
    binomial tail below the limit and the chance that no band is shared are MISSED at most together."""
    s, k = percent / 100, ROWS * bands_for(percent)
    left = MISSED - (1 - s**ROWS) ** bands_for(percent)
    least, tail = 0, 0.0
    while least < k and (tail := tail + math.comb(k, least) * s**least * (1 - s) ** (k - least)) <= left:
        least += 1
    return least


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of each text, and the bounds of the texts among them.

    A shingle is `words` words in a row, or the whole text where it has fewer; a text without words has none.
    """
    hashes, bounds = word_hashes(lowered(data), offsets, _SPACE)
    rolled = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for k in range(words):
        rolled = mixed(rolled + hashes[k : k + len(rolled)])
    sets, ends = [], [0]
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        count = last - first
        if count >= words:
            sets.append(np.unique(rolled[first : last - words + 1]))
        elif count:
            short = np.full(1, count, np.uint64)
            for k in range(first, last):
                short = mixed(short + hashes[k : k + 1])
            sets.append(short)
        ends.append(ends[-1] + (len(sets[-1]) if count else 0))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.array(ends)


def piecewise_sets(column: pa.ChunkedArray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """`shingle_sets` of many texts, of which about PIECE bytes are hashed at once: hashing takes many times their size."""
    data, offsets = flat_bytes(column)
    sets, ends = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b in pieces(np.diff(offsets), PIECE):
        found, bounds = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
        sets.append(found)
        ends.append(ends[-1][-1] + bounds[1:])
    return np.concatenate(sets), np.concatenate(ends)


def circulant_signatures(shingles: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """Signatures of consecutive sets, 16 bits a coordinate: minima of shifts of one permutation."""
    out = np.empty((len(starts), coordinates), np.uint16)
    shuffled = (mixed(shingles ^ _FIRST) >> np.uint64(32)).astype(np.uint32)
    value, shift = np.empty_like(shuffled), np.empty_like(shuffled)
    for k in range(coordinates):
        np.add(shuffled, np.uint32(k), out=value)
        for bits, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            np.right_shift(value, np.uint32(bits), out=shift)
            np.bitwise_xor(value, shift, out=value)
            np.multiply(value, np.uint32(factor), out=value)
        np.right_shift(value, np.uint32(16), out=shift)
        np.bitwise_xor(value, shift, out=value)
        out[:, k] = np.minimum.reduceat(value, starts).astype(np.uint16)
    return out


def signatures(documents: DataFrame, words: int, coordinates: int) -> DataFrame:
    """(doc_id, mark, n_shingles, set_key, signature) for each row; key and signature are null for empty sets."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_bytes(batch.column("text"))
            for a, b in pieces(np.diff(offsets), PIECE):
                shingles, bounds = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                counts = np.diff(bounds)
                full = np.flatnonzero(counts)
                keys, signs = [None] * (b - a), [None] * (b - a)
                if len(full):
                    starts = bounds[full]
                    sums = [np.add.reduceat(mixed(shingles ^ c), starts) for c in (_FIRST, _SECOND)]
                    found = circulant_signatures(shingles, starts, coordinates)
                    for row, one, other, sign in zip(full, *sums, found, strict=True):
                        keys[row] = one.tobytes() + other.tobytes()
                        signs[row] = sign.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], batch.column("mark")[a:b], pa.array(counts, pa.int64()),
                     pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
                    names=["doc_id", "mark", "n_shingles", "set_key", "signature"],
                )

    wanted = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), text_bytes(F.col("text")).alias("text")
    )
    return wanted.mapInArrow(signed, "doc_id long, mark long, n_shingles long, set_key binary, signature binary")


_PAIRS = "a long, b long"


def _labelled(crowded: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """Members of buckets that hold several labels, with their label and the leader of their bucket, which each turn draws anew."""
    if labels is None:
        found = crowded.withColumn("label", F.col("node"))
    else:
        found = crowded.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    draw = F.xxhash64("bucket", "node", F.lit(turn))
    mixed_ = found.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min("label").alias("low_label"), F.max("label").alias("high_label"),
        *(F.min_by(c, draw).alias(name) for c, name in (("node", "leader"), ("label", "lead_label"), ("size", "lead_size"))),
    )
    return found.join(mixed_.where("low_label <> high_label").drop("low_label", "high_label"), "bucket")


def _alike_in_size(a: Column, b: Column, percent: int) -> Column:
    """Sets can only be similar enough if the smaller has the wanted share of the larger."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _star_pairs(members: DataFrame, signs: DataFrame, least: int, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of a bucket's leader and its members of other labels that agree in `least` coordinates."""
    other_label = (F.col("label") != F.col("lead_label")) & _alike_in_size(F.col("size"), F.col("lead_size"), percent)
    # a node has a row a band at most, so its rows are made distinct where they meet its signature
    pairs = members.where(other_label).select("node", "leader").repartition("node").distinct()

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = (flat_bytes(batch.column(c))[0].view(np.uint16).reshape(batch.num_rows, -1) for c in ("x", "y"))
                keep = pa.array((one == other).sum(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    one = signs.select("node", F.col("signature").alias("x"))
    other = signs.select(F.col("node").alias("leader"), F.col("signature").alias("y"))
    ends = (F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
    return pairs.join(one, "node").join(other, "leader").select(*ends, "x", "y").mapInArrow(agreeing, _PAIRS)


_MEMBER = "bucket long, low long, high long, own long, band int, node long, label long, size long, signature binary"


def _dealt(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members with their signatures, once for each pair of wide blocks of their bucket that they are in."""
    blocks = F.ceil(F.col("members") / BLOCK)
    place = F.floor(F.col("own") / WIDE)
    signed = members.join(nodes, "node").withColumn("own", F.pmod(F.xxhash64("node", "band"), blocks))
    return (
        signed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((blocks - 1) / WIDE))))
        .withColumns({"low": F.least(place, "other"), "high": F.greatest(place, "other")})
        .select(*(c.split()[0] for c in _MEMBER.split(", ")))
    )


def _remaining_links(
    members: DataFrame, nodes: DataFrame, texts: DataFrame, bands: int, least: int, words: int, percent: int
) -> DataFrame:
    """Links (a, b) among all pairs of different labels that share a bucket, from rows of `_labelled`.

    Buckets are dealt out in pairs of blocks.  Pairs never leave a block pair: a first pass over signatures, of WIDE
    blocks at once, keeps the members that have a candidate and names the block pairs of those, a second brings their
    texts and compares the full sets.
    """

    def paired(rows: dict[str, np.ndarray], signs: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of candidates within groups: different labels, alike in size, enough equal coordinates, and
        no earlier band in common."""
        own = rows["own"] // wide
        group = _groups(rows)
        found = [(np.zeros(0, np.int64),) * 2]
        for shift in range(1, len(signs)):
            i = np.flatnonzero(group[shift:] == group[:-shift])
            if not len(i):
                break
            j = i + shift
            small, large = np.minimum(rows["size"][i], rows["size"][j]), np.maximum(rows["size"][i], rows["size"][j])
            keep = (
                (rows["label"][i] != rows["label"][j]) & (100 * small >= percent * large)
                & ((rows["low"][i] == rows["high"][i]) | (own[i] != own[j]))
            )
            i, j = i[keep], j[keep]
            equal = signs[i] == signs[j]
            good = equal.sum(axis=1) >= least
            i, j, equal = i[good], j[good], equal[good]
            here = equal.reshape(len(i), bands, ROWS).all(axis=2).argmax(axis=1) == rows["band"][i]
            found.append((i[here], j[here]))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def pairs_of(table: pa.Table, wide: int = 1) -> tuple[np.ndarray, np.ndarray]:
        rows = {c: table.column(c).to_numpy() for c in table.column_names if c not in ("signature", "text")}
        data, _ = flat_bytes(table.column("signature"))
        return paired(rows, data.view(np.uint16).reshape(table.num_rows, -1), wide)

    def ends(table: pa.Table) -> pa.Table:
        one, other = pairs_of(table, WIDE)
        own = table.column("own").to_numpy()
        low, high = np.minimum(own[one], own[other]), np.maximum(own[one], own[other])
        row, low, high = np.unique(np.array([np.append(one, other), np.append(low, low), np.append(high, high)]), axis=1)
        out = table.take(row)
        for name, values in (("low", low), ("high", high)):
            out = out.set_column(out.column_names.index(name), name, pa.array(values, pa.int64()))
        return out

    def links(table: pa.Table) -> pa.Table:
        one, other = pairs_of(table)
        shingles, bounds = piecewise_sets(table.column("text"), words)
        node, found = table.column("node").to_numpy(), []
        for i, j in zip(one, other, strict=True):
            a, b = shingles[bounds[i] : bounds[i + 1]], shingles[bounds[j] : bounds[j + 1]]
            shared = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                found.append((min(node[i], node[j]), max(node[i], node[j])))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    def by_group(function):
        """The function over pieces of about TOGETHER rows, cut between groups."""

        def pieces_of(table: pa.Table, last_too: bool) -> tuple[list[pa.Table], pa.Table]:
            group = _groups({c: table.column(c).to_numpy() for c in ("bucket", "low", "high")})
            out, first = [], 0
            end = len(group) if last_too else int(np.searchsorted(group, group[-1]))
            while first < end:
                last = end
                if first + TOGETHER < end:
                    last = int(np.searchsorted(group, group[first + TOGETHER]))
                    last = last if last > first else int(np.searchsorted(group, group[first], "right"))
                out.append(table.slice(first, last - first))
                first = last
            return out, table.slice(end)

        def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: pa.Table | None = None
            for batch in batches:
                if batch.num_rows:
                    table = pa.Table.from_batches([batch])
                    done, kept = pieces_of(table if kept is None else pa.concat_tables([kept, table]), False)
                    for piece in done:
                        yield from function(piece).to_batches()
            if kept is not None:
                for piece in pieces_of(kept, True)[0]:
                    yield from function(piece).to_batches()

        return streamed

    def in_groups(rows: DataFrame) -> DataFrame:
        return rows.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "node")

    candidates = in_groups(_dealt(members, nodes)).mapInArrow(by_group(ends), _MEMBER)
    return in_groups(candidates.join(texts, "node")).mapInArrow(by_group(links), _PAIRS)


def _groups(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Numbers, in rising order, of the runs of equal (bucket, low, high)."""
    same = np.ones(len(rows["bucket"]), bool)
    for c in ("bucket", "low", "high"):
        same[1:] &= rows[c][1:] == rows[c][:-1]
    return np.cumsum(~same)


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough: 100 * intersection >= percent * union."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            keep = []
            columns = [batch.column(c) for c in ("a", "b", "text_a", "text_b")]
            for a, b, text_a, text_b in zip(*columns, strict=True):
                sets = []
                for node, text in ((a.as_py(), text_a), (b.as_py(), text_b)):
                    if node not in known:
                        if len(known) >= 64:
                            known.clear()
                        raw = np.frombuffer(text.as_py(), np.uint8)
                        known[node] = shingle_sets(raw, np.array([0, len(raw)]), words)[0]
                    sets.append(known[node])
                shared = len(np.intersect1d(*sets, assume_unique=True))
                keep.append(100 * shared >= percent * (len(sets[0]) + len(sets[1]) - shared))
            yield pa.RecordBatch.from_arrays([x.filter(pa.array(keep)) for x in columns[:2]], names=["a", "b"])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b").mapInArrow(similar, _PAIRS)


def stars(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, label) for the nodes of links (a, b) but for the smallest of each component, which is the others' label.

    Links may repeat.  With `known`, what this gave for earlier links, it goes on from there.  Alternates two steps, each
    a join and an aggregate: large stars hang a node's larger neighbours on its smallest, small stars its smaller ones.
    Neither makes more rows than there were links.  What both make is written; it ends when only stars are left: no node
    hangs on two, and none that others hang on hangs itself.
    """
    if known is not None:
        if links.isEmpty():
            return known
        links = links.unionAll(known.toDF("a", "b"))
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionAll(lowest.select("u", F.col("m").alias("v"))).distinct(), "stars")
        ends = edges.selectExpr("u AS node", "1 AS hangs").unionAll(edges.selectExpr("v", "0"))
        ends = ends.groupBy("node").agg(F.sum("hangs").alias("above"), F.min("hangs").alias("least"))
        if not ends.agg(F.bool_or(F.expr("above > 1 OR (above = 1 AND least = 0)"))).first()[0]:
            return edges.toDF("node", "label")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of links (a, b): the smallest node that can be reached."""
    hung = stars(links)
    return hung.unionAll(hung.select(F.col("label").alias("node"), "label").distinct())


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row of documents: doc_id, n_shingles, component_id (the smallest doc_id reachable), kept
    (doc_id = component_id).

    Texts are lower-cased (A-Z) and parted at ASCII white space.  Null, empty and blank texts have no shingles
    and are linked with nothing, each its own component.  Texts with the same shingles are linked.  Rows that
    share a doc_id count as one document: what is linked to one is linked to all.  A row without doc_id is
    linked with nothing; its component is null, and it is kept.  An empty table gives no rows; other columns
    are ignored.
    """
    bands, least = bands_for(percent), least_agreement(percent)
    signed = staged(signatures(documents, words, ROWS * bands), "signatures")
    own = F.col("doc_id").isNotNull() & F.col("set_key").isNotNull()
    # one class for each shingle set, named by its smallest doc_id
    classes = (
        signed.where(own)
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.first("signature").alias("signature"),
             F.first("n_shingles").alias("size"))
        .select("set_key", F.col("first.doc_id").alias("node"), F.col("first.mark").alias("mark"), "signature", "size")
    )
    classes = staged(classes, "classes")
    # the sets of a doc_id that has several are linked
    several = signed.where(own).groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high"))
    same_id = signed.join(several.where("low <> high"), "doc_id", "left_semi").join(classes.select("set_key", "node"), "set_key")
    same_id = same_id.where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))

    slots = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("signature"), i * (2 * ROWS) + 1, F.lit(2 * ROWS))),
    )
    members = classes.select("node", "size", F.posexplode(slots).alias("band", "bucket"))
    shared = members.groupBy("bucket").count().where("count > 1").select("bucket")
    crowded = staged(members.join(shared, "bucket"), "crowded")
    nodes = staged(crowded.select("node").distinct().join(classes, "node").select("node", "mark", "signature"), "nodes")
    texts, signs = staged(_texts(documents, nodes), "texts"), nodes.select("node", "signature")
    labels = None
    for turn in range(STARS + 1):
        labelled = _labelled(crowded, labels, turn)
        if turn < STARS:
            links = _verified(_star_pairs(labelled, signs, least, percent), texts, words, percent)
        else:
            links = _remaining_links(labelled, signs, texts, bands, least, words, percent)
        labels = stars(staged(links if turn else links.unionAll(same_id), "links"), labels)
    of_set = classes.select("set_key", "node")
    found = signed.join(of_set, "set_key", "left").join(labels, "node", "left")
    component = F.when(own, F.least("doc_id", F.coalesce("label", "node"))).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def _texts(documents: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, text) of the classes needed: the text of doc_id and hash, once."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("node"), F.xxhash64("text").alias("mark"), text_bytes(F.col("text")).alias("text")
    )
    rows = rows.join(needed, ["node", "mark"], "left_semi").groupBy("node", "mark").agg(F.first("text").alias("text"))
    return rows.select("node", "text")


def one_of_each_group(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of documents but for near-duplicates: of each group one row stays, that of the smallest doc_id.

    Groups are those of rows: rows that share a doc_id but not their text are no duplicates and stay, copies go
    whatever their ids.  Rows without doc_id are linked like others and come last.  Of rows of one id the first by a hash
    of the text stays.  Null, empty and blank texts are no duplicates of anything.  An empty table gives no rows.
    """
    row = "row number of the table"
    numbered = staged(documents.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), words, percent)
    named = numbered.select(row, F.col("doc_id").isNull().alias("nameless"), "doc_id", F.xxhash64("text").alias("mark"))
    grouped = found.select(F.col("doc_id").alias(row), "component_id").join(named, row)
    first = grouped.groupBy("component_id").agg(F.min(F.struct("nameless", "doc_id", "mark", row)).alias("first"))
    return numbered.join(first.select(F.col("first")[row].alias(row)), row, "left_semi").drop(row)


def first_of_each_id(documents: DataFrame) -> DataFrame:
    """Of rows that share a doc_id, the first by its other columns; rows without doc_id stay.

    Only rows of repeated ids are shuffled whole.
    """
    several = documents.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if several.isEmpty():
        return documents
    rest = [F.col(c) for c in documents.columns if c != "doc_id"]
    first = documents.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("first"))
    return documents.join(several, "doc_id", "left_anti").unionByName(first.select("doc_id", "first.*"))
