"""Token counts of whole texts, with huge texts encoded in overlapping chunks.

A text longer than a chunk is encoded chunk by chunk with offsets.  Two neighbouring chunks are spliced
behind a token that both have at the same bytes.  That is proof, not a guess: BPE has one result for a
text, and a sequence of tokens is that result exactly if each pair of neighbours is what BPE makes of the
two together.  Up to the shared token every pair of neighbours comes from the left chunk's encoding, from
it on every pair comes from the right chunk's, so all pairs hold.  Where the overlap has no shared token,
it is doubled; in the end the overlap is the whole text, encoded at once.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescout.llm.common import flat_bytes, pieces, text_bytes

CHUNK = 1 << 16
OVERLAP = 1 << 9
TOGETHER = 1 << 20  # bytes of short texts that are encoded by one call


@functools.cache
def _model(file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=file)


def _boundary(data: bytes, at: int) -> int:
    """The first start of a character at or before a byte."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _with_offsets(model, data: bytes, start: int, end: int) -> np.ndarray:
    """Rows of (first byte, end byte, id) of the tokens of data[start:end]."""
    found = model.encode(data[start:end].decode("utf-8", "replace"), out_type="proto").pieces
    rows = np.array([(p.begin, p.end, p.id) for p in found], np.int64).reshape(-1, 3)
    rows[:, :2] += start
    return rows


def _shared(left: np.ndarray, right: np.ndarray) -> tuple[int, int] | None:
    """Places, one in each encoding, of a token of both at the same bytes."""
    mine = {(b, e, i): k for k, (b, e, i) in enumerate(left.tolist()) if e > b}
    for k, (b, e, i) in enumerate(right.tolist()):
        if (b, e, i) in mine:
            return mine[b, e, i], k
    return None


def spliced(model, data: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[np.ndarray]:
    """Runs of token ids that together are the encoding of the whole text."""
    end = _boundary(data, chunk)
    if end >= len(data) or end <= 0:
        yield np.array(model.encode(data.decode("utf-8", "replace")), np.int64)
        return
    start, first, held = 0, 0, _with_offsets(model, data, 0, end)
    done: list[np.ndarray] = []
    while end < len(data):
        width, found = overlap, None
        while end - width > start:
            begin = _boundary(data, end - width)
            until = _boundary(data, min(len(data), end + chunk))
            until = until if until > end else len(data)
            following = _with_offsets(model, data, begin, until)
            low = first + int(np.searchsorted(held[first:, 0], begin))
            found = _shared(held[low:], following[following[:, 1] <= end])
            if found:
                done.append(held[first : low + found[0] + 1, 2])
                start, end, first, held = begin, until, found[1] + 1, following
                break
            width *= 2
        if not found:  # no common token in a whole chunk: the overlap becomes the text
            yield np.array(model.encode(data.decode("utf-8", "replace")), np.int64)
            return
    yield from done
    yield held[first:, 2]


def count_tokens(
    documents: DataFrame, model_file: str, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and n_chunked (1 for a spliced text) for each row of documents.

    Null texts count as empty and have no tokens.  Null and repeated doc_ids are kept as they come, a row
    for a row; an empty table gives no rows; other columns are ignored, whatever their names.  There is no
    shuffle: each task holds about a megabyte of short texts, or one long text and a chunk's offsets.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_file)
        for batch in batches:
            data, offsets = flat_bytes(batch.column("text"))
            lengths = np.diff(offsets)
            tokens = np.zeros(len(lengths), np.int64)
            long = lengths > chunk
            for row in np.flatnonzero(long):
                whole = data[offsets[row] : offsets[row + 1]].tobytes()
                tokens[row] = sum(map(len, spliced(model, whole, chunk, overlap)))
            short = np.flatnonzero(~long)
            for a, b in pieces(lengths[short], TOGETHER):
                texts = [data[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8", "replace") for r in short[a:b]]
                tokens[short[a:b]] = [len(ids) for ids in model.encode(texts, num_threads=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths), pa.array(tokens), pa.array(tokens > limit),
                 pa.array(long.astype(np.int32))],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunked"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("text")).mapInArrow(
        counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunked int"
    )
