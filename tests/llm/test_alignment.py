"""Cross-tokenizer alignment against a plain walk over both token lists."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from helpers import DOCUMENTS, awkward_rows, documents, empty, prose  # noqa: F401

from tablescout.llm import alignment
from tablescout.llm.queries import QUERIES, tokenizer

FILES = [tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")]


def plain(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    letters = alignment._byte_letters()
    out, links = [], []
    for doc_id, text, *_ in rows:
        groups, mine = [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            spell_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
            spell_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
                assert ByteLevel().decode([a.id_to_token(i) for i in ids_a]) == " " + text
                left, right, at_a, at_b, j = [], [], 0, 0, 0
                for i, piece in zip(ids_a, spell_a, strict=True):
                    left.append(i)
                    at_a += len(piece)
                    while at_b < at_a:
                        right.append(ids_b[j])
                        at_b += len(spell_b[j])
                        j += 1
                    if at_a == at_b:
                        groups.append((left, right))
                        mine.append((left[-1], right[-1]))
                        left, right = [], []
        links.append(mine)
        text_ = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text_.encode()).hexdigest() if groups else ""
        out.append([doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(mine), 0, 0, digest])
    counts = Counter(pair for mine in links for pair in mine)
    best: dict[int, int] = {}
    for (_, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    for row, mine in zip(out, links, strict=True):
        row[5] = sum(counts[p] == best[p[1]] for p in mine)
        row[6] = sum(counts[p] for p in mine)
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(found, rows):
    assert found.columns == COLUMNS
    assert sorted(map(str, map(list, found.collect()))) == sorted(map(str, plain(rows)))


ODD = [
    (400, "a  b  c\n\n\td", None, None, 1), (401, "▁ is a piece's blank", None, None, 1),
    (402, "<|endoftext|> and <s> are text </s><unk> <0x41>", None, None, 1), (403, "日本語 हिन्दी 😀👩‍👩‍👧 ́x", None, None, 1),
    (404, " ", None, None, 1), (405, "the " * 5000, None, None, 1), (406, "�\u0000\u0001", None, None, 1), (407, "ﬁne Å ½", None, None, 1),
]


def test_awkward_rows(spark, documents):  # noqa: F811
    odd = spark.createDataFrame(ODD, DOCUMENTS)
    clashing = documents.selectExpr("*", "'x' AS row", "'x' AS radix", "'x' AS run", "'x' AS pairs", "'x' AS n_a")
    rows = [tuple(r) for r in awkward_rows()] + ODD
    check(alignment.align_tokenizers(clashing.unionByName(odd, allowMissingColumns=True), *FILES), rows)


def test_any_white_space(spark):
    """Words are aligned alone only where both tokenizers cut between them."""
    random_ = np.random.default_rng(5)
    some = list("ab,. \n\t") + ["\u00a0", "\u2003", "▁", " ", "é", "'s", "12", "\x1c", "\u3000", "the", "</s>", " <unk>"]
    texts = ["".join(random_.choice(some, random_.integers(1, 25))) for _ in range(3000)]
    aligner = alignment.Aligner(*FILES)
    columns, pairs, place = aligner.aligned([t.encode() for t in texts])
    expected = plain([(k, t) for k, t in enumerate(texts)])
    for k, row in enumerate(expected):
        assert [columns[c][k] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")] == [*row[1:5], row[7]], texts[k]
    assert np.bincount(place, minlength=len(texts)).tolist() == [row[4] for row in expected]
    assert sum(columns["n_a"] > 0) > 1000 and not aligner.aligned([b"\xff\xfe", b"a\xc3"])[1].size


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_WORDS", 3)
    aligner = alignment.Aligner(*FILES)
    for k in range(5):
        text = prose(k, 30)
        assert aligner.aligned([text.encode()])[0]["groups_sha256"] == [plain([(0, text)])[0][7]]


def test_empty_table(spark):
    found = alignment.align_tokenizers(empty(spark), *FILES)
    assert found.columns == COLUMNS and not found.collect()
    nothing = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None)], DOCUMENTS)
    assert sorted(map(tuple, alignment.align_tokenizers(nothing, *FILES).collect())) == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op11_token_alignment"](spark, sf_dir), rows)


@pytest.mark.parametrize("block", [1, 3, 1 << 13])
def test_runs_and_their_merge(monkeypatch, block):
    """Spilled in many runs, merged block by block, and given back, against plain counting."""
    monkeypatch.setattr(alignment, "MERGE_BLOCK", block)
    random_ = np.random.default_rng(block)
    runs, every = [], []
    for base in range(0, 700, 100):
        rows = np.sort(random_.integers(base, base + 100, 900))
        pairs = (random_.zipf(1.3, 900) % 50 << alignment.A_BITS) | random_.zipf(1.5, 900) % 30
        runs += alignment.spilled(pairs, rows)
        every += zip(rows.tolist(), pairs.tolist(), strict=True)
    counts = Counter(p for _, p in every)
    totals = []
    for radix in range(alignment.RADIX):
        mine = [*alignment.merged([pairs for r, _, pairs, _ in runs if r == radix])]
        pairs = [int(p) for x in mine for p in x["pair"]]
        assert pairs == sorted(set(pairs))  # in order of the B ids, each pair once
        totals += mine
    totals = np.concatenate(totals)
    assert dict(zip(totals["pair"].tolist(), totals["n"].tolist(), strict=True)) == counts
    seen = np.zeros(len(totals), alignment._TOTAL)
    seen["pair"], seen["n"], seen["best"] = totals["pair"], totals["n"], totals["pair"] % 2
    seen = seen[np.argsort(seen["pair"])]
    found = Counter(), Counter()
    for _, base, pairs, records in runs:
        for row, best, total in zip(*alignment.contributions(records, pairs, seen), strict=True):
            found[0][int(row) + base] += int(best)
            found[1][int(row) + base] += int(total)
    expected = Counter(), Counter()
    for row, pair in every:
        expected[0][row] += pair % 2
        expected[1][row] += counts[pair]
    assert +found[0] == +expected[0] and found[1] == expected[1]


def test_many_runs_and_parts(spark, monkeypatch, documents):  # noqa: F811
    """Every text its own runs, every radix in several parts: the results stay."""
    monkeypatch.setattr(alignment, "MERGE_BYTES", 200)
    rows = [(k, prose(k % 7, 30 + k % 5), None, None, 1) for k in range(60)]
    frame = spark.createDataFrame(rows, DOCUMENTS).repartition(20)
    check(alignment.align_tokenizers(frame, *FILES), rows)
