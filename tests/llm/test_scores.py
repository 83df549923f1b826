"""Context trees against a plain recursive tree, quality, language."""

import math
from collections import Counter, defaultdict

import pytest
from helpers import DOCUMENTS, awkward_rows, empty, fold, prose, words, documents  # noqa: F401

from tablescout.llm import language, quality
from tablescout.llm.context_tree import score_documents


def tree_scores(rows, depth):
    """log10 probabilities by the recursive definition, with counts of (context, decision) in dicts."""
    counts = defaultdict(lambda: [0, 0])

    def steps(text):
        data = b"\n" * depth + " ".join(words(text)).encode() + b"\n"
        for at in range(depth, len(data)):
            decision = 1
            for k in range(7, -1, -1):
                bit = data[at] >> k & 1
                yield [(data[at - d : at], decision) for d in range(depth + 1)], bit
                decision = decision * 2 + bit

    children = defaultdict(set)
    for d, text in rows:
        for path, bit in steps(text):
            for shorter, longer in zip(path, path[1:]):
                children[shorter].add(longer)
            if fold(d, 10):
                for place in path:
                    counts[place][bit] += 1

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    known = {}

    def weighted(place, d):
        if place not in known:
            own = kt(*counts[place])
            if d < depth:
                below = sum(weighted(child, d + 1) for child in children[place])
                most = max(own, below)
                known[place] = most + math.log(math.exp(own - most) / 2 + math.exp(below - most) / 2)
            else:
                known[place] = own
        return known[place]

    def probability(path, bit):
        left, out = 1.0, 0.0
        for d, place in enumerate(path):
            stop = math.exp(kt(*counts[place]) - weighted(place, d)) / 2 if d < depth else 1.0
            out += left * stop * (counts[place][bit] + 0.5) / (sum(counts[place]) + 1)
            left *= 1 - stop
        return out

    return [sum(math.log10(probability(path, bit)) for path, bit in steps(text)) for _, text in rows]


def test_context_tree(spark):
    rows = [(k, prose(k, 12)) for k in range(25)] + [(30, None), (31, ""), (None, "The Er"), (32, "éa \x00 zz"), (32, "éa \x00 zz")]
    frame = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCUMENTS).repartition(3)
    found = {}
    for r in score_documents(frame, depth=2, block_bytes=500).collect():
        found.setdefault(r.doc_id, r)
    tokens = Counter(w for d, t in rows if fold(d, 10) for w in [*words(t), "\n"])
    total, distinct = sum(tokens.values()), len(tokens)
    for (d, text), score in zip(rows, tree_scores(rows, 2), strict=True):
        r = found[d]
        mine = [*words(text), "\n"]
        base = sum(math.log10((tokens[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in mine)
        assert r.score == pytest.approx(score, rel=1e-9)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (fold(d, 10) == 0, len(mine), total)
        assert r.n_known == sum(tokens[w] > 0 for w in mine)


def test_context_tree_probabilities_sum_to_one(spark):
    """After one context, the probabilities of all 256 bytes."""
    from tablescout.llm.context_tree import gram_scores

    seen = spark.createDataFrame([(0x616200 + b, 0 if b % 3 else b) for b in range(256)], "key long, n long")
    assert sum(10**r.value for r in gram_scores(seen, 2).collect()) == pytest.approx(1)


def test_context_tree_edges(spark, documents):
    assert score_documents(empty(spark)).count() == 0
    assert score_documents(documents).count() == len(awkward_rows())
    held_out = next(k for k in range(100) if fold(k, 10) == 0)
    row = score_documents(spark.createDataFrame([(held_out, "ab", None, None, None)], DOCUMENTS)).first()
    assert row.train_tokens == 0 and row.n_known == 0
    assert row.score == pytest.approx(3 * 8 * math.log10(0.5))


def quality_tables(spark):
    rows, labels = [], []
    for k in range(160):
        bad = k % 4 == 0
        text = prose(k, 30 + k)
        rows.append((k, " ".join(w + "$$$" for w in text.split()) if bad else text, "en", "s", 1))
        labels.append((k, int(not bad), None))
    labels += [(None, 1, 1), (1, None, 0), (2, 0, 0), (3, 1, 0), (3, 1, 0), (9999, 1, 0), (5, 7, None)]
    return spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_learns_and_ignores_held_out_labels(spark):
    documents, labels = quality_tables(spark)
    found = {r.doc_id: r for r in quality.classify(documents, labels).collect()}
    held_out = [d for d in found if fold(d, 4) == 2]
    assert all(found[d].predicted == int(d % 4 != 0) for d in held_out)
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    again = {r.doc_id: r.score for r in quality.classify(documents, other).collect()}
    assert again == pytest.approx({d: r.score for d, r in found.items()})
    kept = quality.classify(documents, labels, keep=["text", "source"])
    assert kept.columns == ["doc_id", "text", "source", "score", "predicted"]
    assert {r.doc_id: r.score for r in kept.collect()} == pytest.approx(again)


def test_quality_edges(spark, documents):
    _, labels = quality_tables(spark)
    rows = quality.classify(documents, labels).collect()
    assert len(rows) == len(awkward_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(empty(spark), labels).count() == 0
    unlabelled = quality.classify(documents, labels.limit(0))
    assert {r.score for r in unlabelled.collect()} == {0.5}
    one_class = quality.classify(documents, labels.where("quality = 1"))
    assert len({r.score for r in one_class.collect()}) == 1


def test_language(spark, documents):
    learned = documents.where("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 <> 2")
    dictionaries = language.fit_dictionaries(learned)
    assert set(dictionaries) == {"en", "fr", "de"}
    found = language.identify(documents, dictionaries).collect()
    assert len(found) == len(awkward_rows())
    langs = {d: (l, t) for d, t, l, *_ in awkward_rows()}
    for r in found:
        assert 0 <= r.score <= 1 and r.lang_pred in {"en", "fr", "de", "und"}
        if r.doc_id is not None and r.doc_id < 20 and r.doc_id >= 0:
            assert r.lang_pred == langs[r.doc_id][0]
        if r.doc_id in (100, 101, 102):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert language.identify(documents.where("doc_id = 108"), dictionaries).first().lang_pred == "und"
    assert language.fit_dictionaries(empty(spark)) == {}
    assert {r.lang_pred for r in language.identify(documents, {}).collect()} == {"und"}


def test_language_rejects_narrow_margins(spark):
    same = {"aa": prose(1, 300).lower().encode(), "bb": prose(1, 300).lower().encode()}
    row = language.identify(spark.createDataFrame([(1, prose(7, 50), None, None, 1)], DOCUMENTS), same).first()
    assert row.rejected and row.lang_pred == "aa" and row.score == pytest.approx(0.5)


def test_dictionaries_hold_different_pieces(spark):
    """Copies and texts with one opening do not use up the sample."""
    copies = [prose(k, 80) for k in range(12) for _ in range(40)]
    opening = prose(50, 200)
    near = [opening + " " + prose(100 + k, 300) for k in range(60)]
    rows = [(k, t, lang, None, 1) for lang, texts in (("en", copies), ("fr", near)) for k, t in enumerate(texts)]
    dictionaries = language.fit_dictionaries(spark.createDataFrame(rows, DOCUMENTS), sample=10)
    for lang, texts in (("en", copies), ("fr", near)):
        pieces = dictionaries[lang].decode().split("\n")
        assert len(pieces) == len(set(pieces)) == 10
        assert all(any(p in t.lower() for t in texts) for p in pieces)
    assert sum(p in opening.lower() for p in dictionaries["fr"].decode().split("\n")) < 10


def test_dictionaries_sample_in_two_steps(spark, monkeypatch):
    """The sample of a language does not depend on the parts it is taken from."""
    frame = spark.createDataFrame([(k, prose(k, 60), "en", None, 1) for k in range(80)], DOCUMENTS)
    found = set()
    for parts in (1, 3, 64):
        monkeypatch.setattr(language, "PARTS", parts)
        found.add(language.fit_dictionaries(frame, sample=7)["en"])
    assert len(found) == 1 and len(found.pop().decode().split("\n")) == 7
