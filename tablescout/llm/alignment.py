"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of the token pairs that end together.

Both tokenizers cut a text's bytes; where cuts of both meet, a group ends, and the two tokens that end there are
a link.  How often a pair of ids is linked is counted over all documents, and every document gets back the
counts of its own links.  The counting spills outside memory:

1. A task holds the links of its documents until RUN_LINKS are there, then sorts them by radix of the B id, B id
   and A id, and writes a run for each radix: the distinct pairs with their counts, and for each pair the
   documents that hold it, both as zstandard frames.
2. The runs of a radix are merged block by block with a heap of their next pairs.  Many runs are dealt to several
   tasks, so a frequent pair costs one entry a run, however many documents hold it; Spark adds up what is left.
3. In order of the B ids their highest counts follow, and each run, once more read with the counts of its radix,
   turns into sums for its documents.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablescout.llm.common import flat_bytes, gathered, mixed, pieces, staged, text_bytes

RADIX = 16  # a power of two
RUN_LINKS = 1 << 21
MERGE_BYTES = 1 << 25  # of pair frames that one task merges
MERGE_BLOCK = 1 << 13  # pairs of a run that are in memory while it is merged
LEVEL = 3
TOGETHER = 1 << 21  # bytes of texts that are aligned by one call
KNOWN_WORDS = 300_000  # whose groups a worker remembers before it starts anew
# A blank between white space; the white space of A is among what this takes for it.
_SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
RUN = f"{_SPACE} {_SPACE}|  | $"
A_BITS = 24  # ids of both tokenizers are below this power of two

_PAIR = np.dtype([("pair", "<i8"), ("n", "<i8")])
_TOTAL = np.dtype([("pair", "<i8"), ("n", "<i8"), ("best", "<i8")])
_FOUND = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "radix int, run long, pairs binary, records binary"
)


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, then from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """The two tokenizers, and the groups of the words that they have met.

    A parts a text at every single blank before a word, and no piece of B has a blank behind anything else, so both
    cut between words: the groups of a text that starts with a blank are those of its words, and each word is
    aligned once.  Only blanks in runs of white space may belong to what is before them; RUN finds such texts, and
    they are aligned whole, as are all texts where a piece of B has a blank inside.
    """

    def __init__(self, file_a: str, file_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True  # their strings are ordinary text
        letters = _byte_letters()
        known = {i: token for token, i in self.a.get_vocab(with_added_tokens=False).items()}
        bytes_a = [bytes(letters[c] for c in known.get(i, "")) for i in range(max(known) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        spelled = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        bytes_b = [
            bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode() for i, piece in enumerate(spelled)
        ]
        self.by_words = not any("▁" in piece.lstrip("▁") for piece in spelled)
        self.bytes_a, self.bytes_b = _flat(bytes_a), _flat(bytes_b)
        # an id with what follows it in the text of the groups
        self.written = [f"{i}{mark}" for i in range(max(len(bytes_a), len(bytes_b))) for mark in ",|;"]
        self._forget()

    def _forget(self) -> None:
        self.word: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.counts, self.pairs, self.fine = np.zeros((3, 0), np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def whole(self, texts: list[str]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Of each text, encoded whole: its groups in writing (None where the bytes of A or B are not those of blank and
        text), its numbers of A tokens, B tokens and groups, and of all links in order the pair (B id, A id)."""
        if not texts:
            return [], np.zeros((3, 0), np.int64), np.zeros(0, np.int64)
        lists_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        lists_b = self.b.encode(texts, num_threads=1)
        sizes = pc.binary_length(pa.array(texts, pa.large_string())).to_numpy() + 1
        letters = np.frombuffer((" " + " ".join(texts)).encode(), np.uint8)
        good, counts, ids = np.ones(len(texts), bool), [], []
        for lists, spelled in ((lists_a, self.bytes_a), (lists_b, self.bytes_b)):
            counts.append(np.fromiter(map(len, lists), np.int64, len(texts)))
            ids.append(np.fromiter(chain.from_iterable(lists), np.int64, counts[-1].sum()))
            good &= _spelling(ids[-1], counts[-1], spelled, letters, sizes)
        a, b = (x[np.repeat(good, n)] for x, n in zip(ids, counts, strict=True))
        n_a, n_b = (n * good for n in counts)
        ends_a, ends_b = np.cumsum(self.bytes_a[2][a]), np.cumsum(self.bytes_b[2][b])
        cut = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, bool)
        cut[ends_a] = True
        last_b = np.flatnonzero(cut[ends_b])  # the last tokens of each group
        common = ends_b[last_b]
        last_a = np.searchsorted(ends_a, common)
        # groups, one after another, A before B: each token's place behind the other side's earlier ones
        place_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[np.searchsorted(common, ends_a)]
        place_b = np.arange(len(b)) + (last_a + 1)[np.searchsorted(common, ends_b)]
        written = np.empty(len(a) + len(b), np.int64)
        after_a, after_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        after_a[last_a], after_b[last_b] = 1, 2
        written[place_a], written[place_b] = 3 * a + after_a, 3 * b + after_b
        ends = np.cumsum(n_a + n_b)
        groups = [
            "".join(map(self.written.__getitem__, written[first:last].tolist()))[:-1] if fine else None
            for first, last, fine in zip(ends - n_a - n_b, ends, good, strict=True)
        ]
        n_groups = np.bincount(np.repeat(np.arange(len(texts)), n_b)[last_b], minlength=len(texts))
        return groups, np.array([n_a, n_b, n_groups]), (b[last_b] << A_BITS) | a[last_a]

    def _places(self, words: list[str]) -> np.ndarray:
        if len(self.word) > KNOWN_WORDS:
            self._forget()
        if new := [w for w in words if w not in self.word]:
            groups, counts, pairs = self.whole(new)
            self.word.update(zip(new, range(len(self.word), len(self.word) + len(new)), strict=True))
            self.groups += groups
            self.fine = np.concatenate([self.fine, [g is not None for g in groups]])
            self.counts = np.concatenate([self.counts, counts], axis=1)
            self.pairs = np.concatenate([self.pairs, pairs])
        return np.fromiter(map(self.word.__getitem__, words), np.int64, len(words))

    def aligned(self, raws: list[bytes]) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
        """Columns of the texts, and of all links the pair (B id, A id) and the place of its text, in text order."""
        texts = []
        for raw in raws:
            try:
                texts.append(raw.decode())
            except UnicodeDecodeError:
                texts.append("")  # not a text that its tokens could spell
        runs = pc.match_substring_regex(pa.array([" " + t for t in texts], pa.large_string()), RUN if self.by_words else "").to_pylist()
        alone = [k for k, (t, run) in enumerate(zip(texts, runs, strict=True)) if run and t]
        groups, counts, pairs = self.whole([texts[k] for k in alone])
        parts = pc.split_pattern(pa.array(["" if run else t for t, run in zip(texts, runs, strict=True)], pa.large_string()), " ")
        words = parts.flatten().dictionary_encode()
        of_word = self._places(words.dictionary.to_pylist())[words.indices.to_numpy()]
        bounds = parts.offsets.to_numpy()
        good = np.logical_and.reduceat(self.fine[of_word], bounds[:-1])
        good &= np.array([bool(t) and not run for t, run in zip(texts, runs, strict=True)])
        # links of a text: none, those of its words, or its own
        sizes = self.counts[2][of_word] * np.repeat(good, np.diff(bounds))
        first = np.cumsum(self.counts[2]) - self.counts[2]
        found, ends = gathered(self.pairs, first[of_word], sizes, np.arange(len(of_word)))
        ends = ends[bounds]
        totals = np.add.reduceat(self.counts[:, of_word], bounds[:-1], axis=1) * good
        out = [found[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        written = ["" for _ in texts]
        for k in np.flatnonzero(good):
            written[k] = ";".join(map(self.groups.__getitem__, of_word[bounds[k] : bounds[k + 1]].tolist()))
        own = np.cumsum(counts[2]) - counts[2]
        for k, group, start, count in zip(alone, groups, own, counts.T, strict=True):
            written[k], out[k], totals[:, k] = group or "", pairs[start : start + count[2]], count
        digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
        columns = dict(zip(("n_a", "n_b", "n_groups", "n_links"), [*totals, totals[2]], strict=True)) | {"groups_sha256": digests}
        return columns, np.concatenate(out), np.repeat(np.arange(len(raws)), [*map(len, out)])


def _spelling(ids: np.ndarray, counts: np.ndarray, spelled: np.ndarray, letters: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which texts are spelled by their ids: texts of `counts` ids and of `sizes` bytes, one after another."""
    flat, first, lengths = spelled
    ends = np.concatenate([[0], np.cumsum(counts)])
    total = np.concatenate([[0], np.cumsum(lengths[ids])])[ends]
    good = np.diff(total) == sizes
    found, _ = gathered(flat, first, lengths, ids[np.repeat(good, counts)])
    differs = np.concatenate([[0], np.cumsum(found != letters[np.repeat(good, sizes)])])
    bounds = np.concatenate([[0], np.cumsum(sizes[good])])
    good[good] = np.diff(differs[bounds]) == 0
    return good


def _flat(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and where each value starts and how long it is."""
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    return np.frombuffer(b"".join(values), np.uint8), np.cumsum(lengths) - lengths, lengths


@functools.cache
def _aligner(file_a: str, file_b: str) -> Aligner:
    return Aligner(file_a, file_b)


def _radix(pairs: np.ndarray) -> np.ndarray:
    return (mixed((pairs >> A_BITS).astype(np.uint64)) & np.uint64(RADIX - 1)).astype(np.int64)


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Places where a run of equal rows starts."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def spilled(pairs: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Runs (radix, first row, pair frame, record frame) of links given in order of their rows.

    Pairs are in order of B id and A id; records give for each pair its number of rows, then all rows less the
    first, then how often each holds the pair.
    """
    if not len(pairs):
        return
    base, compress = int(rows[0]), zstandard.ZstdCompressor(level=LEVEL).compress
    radix = _radix(pairs)
    order = np.argsort(radix << (2 * A_BITS) | pairs, kind="stable")
    radix, pairs, rows = radix[order], pairs[order], rows[order] - base
    records = _firsts(pairs, rows)
    times = np.diff(records, append=len(pairs))
    radix, pairs, rows = radix[records], pairs[records], rows[records]
    bounds = np.searchsorted(radix, np.arange(RADIX + 1))
    for k, (first, last) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if first < last:
            starts = _firsts(pairs[first:last])
            found = np.empty(len(starts), _PAIR)
            found["pair"], found["n"] = pairs[first:last][starts], np.add.reduceat(times[first:last], starts)
            lists = (np.diff(starts, append=last - first), rows[first:last], times[first:last])
            yield k, base, compress(found.tobytes()), compress(b"".join(x.astype("<u4").tobytes() for x in lists))


def merged(frames: list[bytes]) -> Iterator[np.ndarray]:
    """Distinct pairs of sorted runs with the sums of their counts, in ascending order, in blocks.

    Every run has one block in memory.  A heap holds the last pair of each: up to the smallest of these all
    runs are known, and that much of every block is added up.
    """
    readers = [zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True) for f in frames]

    def block(k: int) -> np.ndarray:
        return np.frombuffer(readers[k].read(MERGE_BLOCK * _PAIR.itemsize), _PAIR)

    blocks = {k: x for k in range(len(readers)) if len(x := block(k))}
    ends = [(int(x["pair"][-1]), k) for k, x in blocks.items()]
    heapq.heapify(ends)
    while ends:
        limit = ends[0][0]
        taken = []
        for k, x in blocks.items():
            if x["pair"][0] <= limit:
                count = int(np.searchsorted(x["pair"], limit, "right"))
                taken.append(x[:count])
                blocks[k] = x[count:]
        while ends and ends[0][0] == limit:  # these are used up
            k = heapq.heappop(ends)[1]
            blocks[k] = block(k)
            if len(blocks[k]):
                heapq.heappush(ends, (int(blocks[k]["pair"][-1]), k))
            else:
                del blocks[k]
        together = np.concatenate(taken)
        together = together[np.argsort(together["pair"], kind="stable")]
        starts = _firsts(together["pair"])
        out = np.empty(len(starts), _PAIR)
        out["pair"], out["n"] = together["pair"][starts], np.add.reduceat(together["n"], starts)
        yield out


def contributions(records: bytes, pairs: bytes, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a run's rows that hold links (less its first row): the row, its links of highest count, its sum of counts."""
    expand = zstandard.ZstdDecompressor().decompress
    found = np.frombuffer(expand(pairs), _PAIR)["pair"]
    lists = np.frombuffer(expand(records), "<u4").astype(np.int64)
    documents, rest = lists[: len(found)], lists[len(found) :]
    rows, times = rest[: len(rest) // 2], rest[len(rest) // 2 :]
    at = np.repeat(np.searchsorted(totals["pair"], found), documents)
    order = np.argsort(rows, kind="stable")
    starts = _firsts(rows[order])
    best, total = ((times * totals[c][at])[order] for c in ("best", "n"))
    return rows[order][starts], np.add.reduceat(best, starts), np.add.reduceat(total, starts)


def _by_group(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[list[dict]]:
    """Rows of sorted batches, group by group."""
    group, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            found = tuple(row[k] for k in keys)
            if rows and found != group:
                yield rows
                rows = []
            group = found
            rows.append(row)
    if rows:
        yield rows


def _runs(documents: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """A row per document, and rows of runs, which have a radix."""
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = _aligner(file_a, file_b).aligned
        held_pairs, held_rows, held = [], [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            if held:
                runs = [*zip(*spilled(np.concatenate(held_pairs), np.concatenate(held_rows)), strict=True)]
                yield filled(dict(zip(("radix", "run", "pairs", "records"), runs, strict=True)), len(runs[0]))

        def filled(columns: dict, count: int) -> pa.RecordBatch:
            kinds = dict(zip(names, (c.split()[1] for c in _FOUND.split(", ")), strict=True))
            types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[c], types[kinds[c]]) if c in columns else pa.nulls(count, types[kinds[c]]) for c in names],
                names=names,
            )

        for batch in batches:
            data, offsets = flat_bytes(batch.column("text"))
            rows = batch.column("row").to_numpy()
            for i, j in pieces(np.diff(offsets), TOGETHER):
                columns, pairs, where = align([data[offsets[k] : offsets[k + 1]].tobytes() for k in range(i, j)])
                columns |= {"row": rows[i:j], "doc_id": batch.column("doc_id")[i:j].to_pylist()}
                yield filled(columns, j - i)
                if held and rows[i:j][-1] - held_rows[0][0] >= 1 << 32:  # rows of a run are told apart by 32 bits
                    yield from flushed()
                    held_pairs, held_rows, held = [], [], 0
                if len(pairs):
                    held_pairs.append(pairs)
                    held_rows.append(rows[i:j][where])
                    held += len(pairs)
                if held >= RUN_LINKS:
                    yield from flushed()
                    held_pairs, held_rows, held = [], [], 0
        yield from flushed()

    wanted = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        text_bytes(F.col("text")).alias("text"),
    )
    return wanted.mapInArrow(found, _FOUND)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n) of the runs of each (radix, part)."""
    for rows in _by_group(batches, ("radix", "part")):
        for out in merged([r["pairs"] for r in rows]):
            yield pa.RecordBatch.from_arrays([pa.array(out["pair"]), pa.array(out["n"])], names=["pair", "n"])


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, n_best, count_sum) of the runs of each (radix, part), whose packed totals come first."""
    totals, group, seen = [], None, None
    for batch in batches:
        for row in batch.to_pylist():
            if (row["radix"], row["part"]) != group:
                group, totals, seen = (row["radix"], row["part"]), [], None
            if row["records"] is None:
                totals.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(row["pairs"]), _TOTAL))
                continue
            if seen is None:
                seen = np.concatenate(totals)
                seen = seen[np.argsort(seen["pair"])]
            rows, best, total = contributions(row["records"], row["pairs"], seen)
            yield pa.RecordBatch.from_arrays([pa.array(rows + row["run"]), pa.array(best), pa.array(total)], names=["row", "n_best", "count_sum"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (pair, n, best) as frames of the pairs of one radix."""

    def frames(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        rows = np.empty(table.num_rows, _TOTAL)
        for c in _TOTAL.names:
            rows[c] = table.column(c).to_numpy()
        radix = _radix(rows["pair"])
        for k in np.unique(radix):
            frame = zstandard.ZstdCompressor(level=LEVEL).compress(rows[radix == k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([frame], pa.binary())], names=["radix", "pairs"])

    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= RUN_LINKS:
            yield from frames(held)
            held, count = [], 0
    if count:
        yield from frames(held)


def align_tokenizers(documents: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """Per row of documents: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair has the highest
    count among the pairs of its B id, ties included), count_sum (over its links) and groups_sha256.

    A is a byte-level tokenizer and gets a blank before the text, B a model of pieces with byte fallback that adds
    one itself.  Null and empty texts, and those whose tokens do not spell blank and text, have no tokens: zeros
    and an empty digest.  Repeated rows count as often as they are there; doc_id may be null.  An empty table
    gives no rows; other columns are ignored.
    """
    found = staged(_runs(documents, file_a, file_b), "runs")
    runs = found.where("radix IS NOT NULL")
    # a row for each radix comes to the driver
    sizes = {r.radix: r.size for r in runs.groupBy("radix").agg(F.sum(F.octet_length("pairs")).alias("size")).collect()}
    parts = F.element_at(F.lit([max(1, -(-sizes.get(k, 0) // MERGE_BYTES)) for k in range(RADIX)]), F.col("radix") + 1)
    part = F.pmod(F.xxhash64("run"), parts).cast("int").alias("part")

    grouped = runs.select("radix", part, "pairs").repartition("radix", "part").sortWithinPartitions("radix", "part")
    counts = grouped.mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    side = F.shiftrightunsigned("pair", A_BITS)
    # the pairs of a B id are no more than the A ids
    totals = counts.withColumn("b", side).withColumn("best", (F.col("n") == F.max("n").over(Window.partitionBy("b"))).cast("long"))
    frames = staged(totals.select("pair", "n", "best").mapInArrow(_packed, "radix int, pairs binary"), "totals")
    columns = ["radix", "part", "run", "pairs", "records"]
    spread = frames.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumns(
        {"run": F.lit(None).cast("long"), "records": F.lit(None).cast("binary")}
    )
    both = runs.select("radix", part, "run", "pairs", "records").unionByName(spread.select(columns))
    in_order = both.repartition("radix", "part").sortWithinPartitions("radix", "part", F.col("records").isNotNull())
    sums = in_order.mapInArrow(_returned, "row long, n_best long, count_sum long")
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return found.where("radix IS NULL").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
