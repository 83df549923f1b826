"""Token ids in a binary store: one zstandard frame per document, a shared dictionary, an offset index.

Layout of a store, all written by Spark in the folder given:

  dictionary/  one row: its SHA-256, the zstandard dictionary, tokenizer name, bytes per id
  blocks/      rows (shard, block, dictionary_sha256, payload, and per document: doc_id, offset in the payload,
               frame length, number of ids, ids of the block's documents before it)
  index/       rows (doc_id, shard, block, slot, start, n_tokens, offset, length) in ascending doc_id order

Ids are little-endian unsigned numbers of two bytes, or four where the vocabulary needs it.  One document is
read by its index row, its block and one frame.  A frame is refused if the store's dictionary has not the
hash that its block names.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablescout.llm.common import flat_bytes, gathered, pieces, text_bytes

END_ID = 1
LEVEL = 3
SAMPLE_DOCUMENTS = 2000  # fits the dictionary; every document is written whatever the sample
SAMPLE_BYTES = 1 << 13
DICTIONARY_BYTES = 1 << 16
SHARD_BYTES = 1 << 24  # of text
BLOCK_BYTES = 1 << 22  # of frames
MOST_SHARDS = 20_000
NO_ID = int(np.iinfo(np.int64).min)
KNOWN_UNITS = 1 << 19  # whose ids a worker remembers before it starts anew
TOGETHER = 1 << 22  # bytes of texts that are encoded by one call
# Letters that no normalising turns into letter and mark, and marks without the apostrophe, which starts
# pre-tokens of its own.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
SPLIT = f"^(?P<letters>[{_LETTERS}]+)(?P<marks>[{_MARKS}]*)$"
SIMPLE = re.compile(f"[{_LETTERS}]+|[{_MARKS}]+")

BLOCK_SCHEMA = (
    "shard int, block int, dictionary_sha256 string, n_tokens long, payload binary, doc_ids array<long>, "
    "offsets array<long>, lengths array<long>, counts array<long>, befores array<long>"
)


@functools.cache
def _tokenizer(file: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(file)


class Words:
    """Ids of texts by way of their words, each encoded once.

    Only for tokenizers whose pre-tokens never hold white space (the pattern of this one leaves it out), so a
    text's ids are those of its parts between ASCII white space, one after another.  Python sees the distinct
    words of a call only; splitting and counting them is done by Arrow.  A word of the letters of SPLIT with
    ASCII marks behind them is two pre-tokens, so it is looked up as two units, the letters in lower case as
    the tokenizer takes them.  Any other word is a unit as it is: normalising may move marks from one
    pre-token to the next.  Many units of one pre-token are encoded by one call; each ends with its only token
    that closes a word, and where the number of those is not that of the units, they are encoded one by one.
    """

    def __init__(self, file: str):
        tokenizer = _tokenizer(file)
        self._encode = tokenizer.encode_batch_fast
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self._closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self._closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.unit: dict[str, int] = {"": 0}
        self.ids, self.lengths, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _learn(self, new: list[str]) -> None:
        simple = [u for u in new if SIMPLE.fullmatch(u)]
        others = [u for u in new if not SIMPLE.fullmatch(u)]
        lengths, ids = [self.lengths], [self.ids]

        def one_by_one(units: list[str]) -> None:
            found = [np.array(e.ids, np.uint32) for e in self._encode(units, add_special_tokens=False)]
            lengths.append(np.array([*map(len, found)], np.int64))
            ids.extend(found)

        for some in batched(simple, 2048):
            found = np.array(self._encode([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self._closes[found])
            if len(ends) == len(some) and ends[-1] == len(found) - 1:
                lengths.append(np.diff(ends, prepend=-1))
                ids.append(found)
            else:
                one_by_one([*some])
        if others:
            one_by_one(others)
        self.unit.update(zip([*simple, *others], range(len(self.unit), len(self.unit) + len(new)), strict=True))
        self.lengths, self.ids = np.concatenate(lengths), np.concatenate(ids)
        self.first = np.cumsum(self.lengths) - self.lengths

    def _places(self, units: list[str]) -> np.ndarray:
        if len(self.unit) > KNOWN_UNITS:
            self._forget()
        if new := [u for u in units if u not in self.unit]:
            self._learn(new)
        return np.fromiter(map(self.unit.__getitem__, units), np.int64, len(units))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of the texts among them."""
        parts = pc.ascii_split_whitespace(texts)
        words = parts.flatten().dictionary_encode()
        word_ends = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        halves = pc.extract_regex(words.dictionary, SPLIT)
        letters = pc.coalesce(pc.utf8_lower(pc.struct_field(halves, "letters")), words.dictionary)
        marks = pc.coalesce(pc.struct_field(halves, "marks"), "")
        units = pa.concat_arrays([letters, marks]).dictionary_encode()
        of_word = self._places(units.dictionary.to_pylist())[units.indices.to_numpy()].reshape(2, -1).T.ravel()
        ids, ends = gathered(self.ids, self.first, self.lengths, of_word)  # of the distinct words
        ends = ends[::2]
        ids, ends = gathered(ids, ends[:-1], np.diff(ends), words.indices.to_numpy())
        return ids, ends[word_ends]


@functools.cache
def _words(file: str) -> Words:
    """One for each worker, so that what it has learned serves its later tasks."""
    return Words(file)


def _id_arrays(batch: pa.RecordBatch, words: Words) -> Iterator[np.ndarray]:
    data, offsets = flat_bytes(batch.column("text"))
    for a, b in pieces(np.diff(offsets), TOGETHER):
        if offsets[b] - offsets[a] >= 1 << 31:
            texts = pa.array([data[offsets[a] : offsets[b]].tobytes().decode("utf-8", "replace")], pa.large_string())
        else:
            raw = pa.Array.from_buffers(
                pa.binary(), b - a, [None, pa.py_buffer((offsets[a : b + 1] - offsets[a]).astype(np.int32)), pa.py_buffer(data[offsets[a] : offsets[b]])]
            )
            try:
                texts = raw.cast(pa.string())
            except pa.ArrowInvalid:
                texts = pa.array([t.decode("utf-8", "replace") for t in raw.to_pylist()], pa.string())
        ids, ends = words.encode(texts)
        for k in range(b - a):
            yield np.append(ids[ends[k] : ends[k + 1]], np.uint32(END_ID))
    pa.default_memory_pool().release_unused()  # workers live on, and so does what they once had


def fit_dictionary(documents: DataFrame, tokenizer_file: str, dtype: str) -> bytes:
    """A zstandard dictionary fitted to id arrays of SAMPLE_DOCUMENTS different texts or fewer.

    Texts are chosen by a hash of all of it, so copies count once and the choice does not depend on where
    rows are; the first SAMPLE_BYTES of each are encoded.  With too few samples to train on, the dictionary is
    their raw content, or empty.
    """

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer_file)
        for batch in batches:
            samples = [ids.astype(dtype).tobytes() for ids in _id_arrays(batch, words)]
            yield pa.RecordBatch.from_arrays([pa.array(samples, pa.binary())], names=["sample"])

    total = documents.count()
    mark = F.xxhash64("text", F.lit("dictionary"))
    # about twice as many as wanted if all texts differ; a third of all rows may be copies
    chosen = documents.select(mark.alias("mark"), F.substring("text", 1, SAMPLE_BYTES).alias("text"))
    chosen = chosen.where(F.pmod("mark", F.lit(max(total, 1))) < 2 * SAMPLE_DOCUMENTS)
    chosen = chosen.groupBy("mark").agg(F.min("text").alias("text")).orderBy("mark").limit(SAMPLE_DOCUMENTS)
    samples = [bytes(r.sample) for r in chosen.select("text").mapInArrow(serialized, "sample binary").collect()]
    samples.sort()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def _bounds(documents: DataFrame) -> list[int]:
    """Ascending doc_ids, null as the least, that part the table into shards of about SHARD_BYTES of text; larger
    ones where that would be more than MOST_SHARDS.  A doc_id of many rows is there several times."""
    size = documents.select(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(MOST_SHARDS, max(1, -(-size // SHARD_BYTES)))
    if shards == 1:
        return []
    cuts = [k / shards for k in range(1, shards)]
    found = documents.select(F.percentile_approx(F.coalesce("doc_id", F.lit(NO_ID)), cuts, 10 * shards)).first()[0]
    return sorted(found or [])


def write_store(documents: DataFrame, path: str, tokenizer_file: str) -> None:
    """Write the ids of every whole text, an end id after each, in ascending doc_id order.

    Null texts are empty and have the end id only.  Null doc_ids come first, rows of one doc_id in the order of
    the crc32 and number of their ids; none is dropped.  An empty table gives a store without blocks.  Other
    columns are ignored.  Frames, not texts, are shuffled; a shard is written block by block.
    """
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("text"))
    dtype = "<u2" if _tokenizer(tokenizer_file).get_vocab_size() <= 1 << 16 else "<u4"
    dictionary = fit_dictionary(documents, tokenizer_file, dtype)
    digest = hashlib.sha256(dictionary).hexdigest()
    bounds = np.array(_bounds(documents), np.int64)
    shared = spark.sparkContext.broadcast(dictionary)  # DICTIONARY_BYTES at most
    spark.createDataFrame(
        [(digest, bytearray(dictionary), tokenizer_file.rpartition("/")[2], np.dtype(dtype).itemsize)],
        "dictionary_sha256 string, dictionary binary, tokenizer string, id_bytes int",
    ).coalesce(1).write.parquet(f"{path}/dictionary")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer_file)
        held = zstandard.ZstdCompressionDict(shared.value)
        held.precompute_compress(level=LEVEL)
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=held).compress
        for batch in batches:
            frames, counts, checks = [], [], []
            for ids in _id_arrays(batch, words):
                counts.append(len(ids))
                checks.append(zlib.crc32(ids.astype("<u4").tobytes()))
                frames.append(compress(ids.astype(dtype).tobytes()))
            doc_ids = batch.column("doc_id")
            # rows of a doc_id that is itself a bound go to the shards on its sides, in order of their checks
            known = doc_ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
            low, high = (np.searchsorted(bounds, known, side) for side in ("left", "right"))
            shard = low + ((high - low + 1) * np.array(checks, np.int64) >> 32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), doc_ids, pa.array(counts, pa.int64()), pa.array(checks, pa.int64()),
                 pa.array(frames, pa.binary())],
                names=["shard", "doc_id", "n_tokens", "check", "frame"],
            )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, shard, rows, size = 0, None, [], 0

        def flushed() -> pa.RecordBatch:
            counts = np.array([r[1] for r in rows], np.int64)
            lengths = np.array([len(r[2]) for r in rows], np.int64)
            lists = [[r[0] for r in rows], np.cumsum(lengths) - lengths, lengths, counts, np.cumsum(counts) - counts]
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([digest]),
                 pa.array([counts.sum()], pa.int64()), pa.array([b"".join(r[2] for r in rows)], pa.binary()),
                 *(pa.array([list(x)], pa.list_(pa.int64())) for x in lists)],
                names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")],
            )

        for batch in batches:
            for s, d, n, f in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "n_tokens", "frame")), strict=True):
                if rows and (s != shard or size >= BLOCK_BYTES):
                    yield flushed()
                    block, rows, size = block + 1 if s == shard else 0, [], 0
                shard, size = s, size + len(f)
                rows.append((d, n, f))
        if rows:
            yield flushed()

    frames = documents.mapInArrow(encoded, "shard int, doc_id long, n_tokens long, check long, frame binary")
    ordered = frames.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", "doc_id", "check", "n_tokens")
    ordered.mapInArrow(packed, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").drop("payload", "dictionary_sha256")
    sums = blocks.groupBy("shard").agg(F.sum("n_tokens")).collect()  # a row per shard, MOST_SHARDS at most
    starts, before = [], 0
    for shard, tokens in sorted(tuple(r) for r in sums):
        starts.append((shard, before))
        before += tokens
    shard_starts = spark.createDataFrame(starts, "shard int, shard_start long")
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    (
        blocks.withColumn("block_start", F.coalesce(F.sum("n_tokens").over(in_shard), F.lit(0)))
        .join(shard_starts, "shard")
        .select(
            "shard", "block", (F.col("shard_start") + F.col("block_start")).alias("base"),
            F.posexplode(F.arrays_zip("doc_ids", "offsets", "lengths", "counts", "befores")).alias("slot", "d"),
        )
        .select(
            F.col("d.doc_ids").alias("doc_id"), "shard", "block", "slot", (F.col("base") + F.col("d.befores")).alias("start"),
            F.col("d.counts").alias("n_tokens"), F.col("d.offsets").alias("offset"), F.col("d.lengths").alias("length"),
        )
        .sortWithinPartitions("shard", "block", "slot")
        .write.parquet(f"{path}/index")
    )


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes, str]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    return row.dictionary_sha256, bytes(row.dictionary), f"<u{row.id_bytes}"


def _opened(spark: SparkSession, path: str):
    """A function that gives the ids of a frame, for use in tasks."""
    digest, dictionary, dtype = _dictionary(spark, path)
    if hashlib.sha256(dictionary).hexdigest() != digest:
        raise ValueError(f"the dictionary of {path} is not the one it names")

    def opener():
        decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress

        def ids(named: str, frame: bytes) -> np.ndarray:
            if named != digest:
                raise ValueError(f"a block names dictionary {named}, the store has {digest}")
            return np.frombuffer(decompress(frame), dtype).astype("<u4")

        return ids

    return opener


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of a store."""
    opener = _opened(spark, path)

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = opener()
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                read = [
                    ids(one["dictionary_sha256"], one["payload"][a : a + n])
                    for a, n in zip(one["offsets"], one["lengths"], strict=True)
                ]
                count = len(read)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([one["shard"]] * count, pa.int32()), pa.array([one["block"]] * count, pa.int32()),
                     pa.array(range(count), pa.int32()), pa.array([len(x) for x in read], pa.int64()),
                     pa.array([zlib.crc32(x.tobytes()) for x in read], pa.int64())],
                    names=["shard", "block", "slot", "n_tokens", "ids_crc32"],
                )

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    blocks = blocks.select("shard", "block", "dictionary_sha256", "payload", "offsets", "lengths")
    documents = blocks.mapInArrow(checked, "shard int, block int, slot int, n_tokens long, ids_crc32 long")
    index = spark.read.parquet(f"{path}/index").select("doc_id", "shard", "block", "slot", "start")
    return index.join(documents, ["shard", "block", "slot"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: their index rows, their blocks, one frame each."""
    opener = _opened(spark, path)
    places = spark.read.parquet(f"{path}/index").where(F.col("doc_id").isin(doc_ids))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    frames = places.join(blocks.select("shard", "block", "dictionary_sha256", "payload"), ["shard", "block"]).select(
        "doc_id", "dictionary_sha256", F.expr("substring(payload, int(offset) + 1, int(length))").alias("frame")
    )

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = opener()
        for batch in batches:
            named, frame = batch.column("dictionary_sha256").to_pylist(), batch.column("frame").to_pylist()
            read = [ids(n, f).astype(np.int64) for n, f in zip(named, frame, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(read, pa.list_(pa.int64()))], names=["doc_id", "ids"]
            )

    return frames.mapInArrow(decoded, "doc_id long, ids array<long>")
