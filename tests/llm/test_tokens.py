"""Token counts and the token store, against the tokenizers' own results."""

import random
import sys
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from helpers import awkward_rows, empty, prose, documents  # noqa: F401
from tokenizers import Tokenizer

from tablescout.llm import token_store
from tablescout.llm.common import scratch
from tablescout.llm.token_counts import count_tokens, spliced

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("chunk, overlap", [(40, 4), (300, 16), (4096, 256)])
@pytest.mark.parametrize(
    "text",
    [prose(1, 2000), prose(2, 2000, "fr"), "a" * 4000, "ab" * 3000, "日本語の" * 900, " " * 3000, "\n" * 999, "😀🏽\x00x ﬁ① " * 300, ""],
)
def test_spliced_chunks_are_the_encoding(text, chunk, overlap):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = [int(i) for run in spliced(model, text.encode(), chunk, overlap) for i in run]
    assert found == model.encode(text)


def test_overlap_is_widened_where_alignment_fails():
    """Runs of one letter have no common token until the overlap covers what fixes their phase."""
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = "x" + "a" * 501 + " end of it " + "b" * 777
    assert [int(i) for run in spliced(model, text.encode(), 100, 2) for i in run] == model.encode(text)


@pytest.mark.parametrize("chunk", [200, 1 << 16])
def test_counts(spark, documents, chunk):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = sorted(map(tuple, count_tokens(documents, PIECES, chunk=chunk).drop("n_chunked").collect()), key=str)
    expected = [(d, len((t or "").encode()), len(model.encode(t or ""))) for d, t, *_ in awkward_rows()]
    assert found == sorted(((d, b, n, n > 4096) for d, b, n in expected), key=str)
    assert count_tokens(empty(spark), PIECES).count() == 0


def test_store_round_trip(spark, documents, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_BYTES", 20_000)  # several shards and blocks
    monkeypatch.setattr(token_store, "BLOCK_BYTES", 5_000)
    path = scratch(spark, "test-store")
    token_store.write_store(documents, path, WORDS)
    rows = token_store.read_store(spark, path).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(WORDS)
    expected = {}
    for d, t, *_ in awkward_rows():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, token_store.END_ID]
        expected.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [r.doc_id for r in rows] == sorted((d for d, *_ in awkward_rows()), key=lambda d: (d is not None, d))
    start = 0
    for row in rows:
        assert row.start == start
        assert (row.n_tokens, row.ids_crc32) in expected[row.doc_id]
        start += row.n_tokens
    one = token_store.read_documents(spark, path, [109, 104]).collect()
    texts = {d: t for d, t, *_ in awkward_rows()}
    assert {r.doc_id: r.ids[:-1] for r in one} == {
        d: tokenizer.encode(texts[d], add_special_tokens=False).ids for d in (104, 109)
    }
    assert spark.read.parquet(f"{path}/blocks").count() > 3


def test_store_of_nothing_and_wrong_dictionary(spark, documents):
    path = scratch(spark, "test-store")
    token_store.write_store(empty(spark), path, WORDS)
    assert token_store.read_store(spark, path).count() == 0
    path = scratch(spark, "test-store")
    token_store.write_store(documents.where("doc_id < 5"), path, WORDS)
    spark.read.parquet(f"{path}/dictionary").selectExpr(
        "repeat('0', 64) AS dictionary_sha256", "dictionary", "tokenizer", "id_bytes"
    ).write.parquet(f"{path}/other/dictionary")
    with pytest.raises(ValueError, match="not the one it names"):
        token_store.read_store(spark, f"{path}/other")


def encoded_like_whole_texts(texts):
    tokenizer, words = Tokenizer.from_file(WORDS), token_store.Words(WORDS)
    ids, ends = words.encode(pa.array(texts, pa.string()))
    expected = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    wrong = [t for t, a, b, x in zip(texts, ends[:-1], ends[1:], expected, strict=True) if ids[a:b].tolist() != x]
    assert not wrong, wrong[:20]


def test_words_are_encoded_like_whole_texts():
    encoded_like_whole_texts([
        "It's we'll\tΣΑΣ ΟΔΟΣ x́ ́y", "<|startoftext|>a b<|endoftext|> <|endoftext|>", "a b c\x1cd", "İ 1234 !?!", "", " \n",
        "BİLGİ.", "İ!", "İ, a", "Ünïcode, ÀÉÎ! naïve... ÿ", "\x0bab\x0c cd\r", "a\u00a0b\u2003c, d\u0085e", "don't!", "x" * 3000 + "!",
    ])


def test_every_letter_with_marks_behind():
    """Normalising may turn a letter into letter and mark, which is then part of what follows."""
    letters = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "LM"]
    encoded_like_whole_texts([f"{c}! a{c}, {c}b?" for c in letters])


def test_any_characters(random_=random.Random(8)):
    some = "aZéÉ İıßΣςक़ড়́̈'!.,-_09 \t\n\x1c\u00a0\u2028ﬁ"
    encoded_like_whole_texts(["".join(random_.choices(some, k=random_.randint(1, 30))) for _ in range(20000)])


def test_units_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_store, "KNOWN_UNITS", 5)
    tokenizer, words = Tokenizer.from_file(WORDS), token_store.Words(WORDS)
    for text in ("one two three, four; five", "six seven two!", "one, seven eight nine ten"):
        assert words.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_hot_id_is_spread_over_shards(spark, monkeypatch):
    """Rows without doc_id and of one doc_id go to several shards and are still read in order, twice alike."""
    monkeypatch.setattr(token_store, "SHARD_BYTES", 2000)
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, prose(k, 40)) for k in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for parts in (3, 8):
        path = scratch(spark, "test-store")
        token_store.write_store(frame.repartition(parts), path, WORDS)
        read = sorted(map(tuple, token_store.read_store(spark, path).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
        index = spark.read.parquet(f"{path}/index")
        assert index.where("doc_id IS NULL").select("shard").distinct().count() > 3 < index.where("doc_id = 7").select("shard").distinct().count()
        assert [r[0] for r in read] == [sum(n for *_, n, _ in read[:k]) for k in range(len(read))]
        assert [r[1] for r in read] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
        found.append((read, bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)))
    assert found[0] == found[1]
