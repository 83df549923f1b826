"""The filter audit against a plain run of every order, on awkward rows."""

import re
from itertools import permutations
from math import factorial

import pytest
from helpers import WORD, awkward_rows, documents, empty, prose  # noqa: F401

from tablescout.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def plain_audit(rows, labels):
    """Runs every order over every part, document by document."""
    smallest: dict[str, int] = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))

    def fails(doc_id, text):
        words = WORD.findall(text)
        return {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": doc_id is not None and doc_id > smallest[text],
        }

    good, toxic = ({d for d, *marks in labels if marks[k] == 1 and d is not None} for k in (0, 1))
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r[0], fails(r[0], r[1] or "")) for r in rows if (r[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = list(mine), []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(d[1][f] for d in gone), sum(d[1][f] and sum(d[1].values()) == 1 for d in mine),
                    sum(d[0] in good for d in removed), sum(d[0] in toxic for d in removed),
                ]
                shapley[f] += len(removed)
                gone += removed
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


def audited(documents, labels):  # noqa: F811
    counts = filter_audit.document_failures(documents, labels)
    return filter_audit.audit_orders(counts, filter_audit.FILTERS)


def test_awkward_rows(spark, documents):  # noqa: F811
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 120, 2)] + [(2, 1, 1), (2, 0, None), (105, 1, 1), (None, 1, 1), (107, None, 1)]
    labels = [(d, q, None if t is None else int(t)) for d, q, t in labels]
    frame = spark.createDataFrame(labels, LABELS).selectExpr("*", "'x' AS text", "'y' AS lang", "1 AS failed", "2L AS n")
    extra = [(300, "A#B " * 200, "en", None, 1), (301, "A#B " * 200, "fr", None, 1), (301, "A#B " * 200, "fr", None, 1),
             (-9, "A#B " * 200, None, None, 1), (302, "WORDS " + prose(8, 150), "", None, 1)]
    more = spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long")
    found = audited(documents.unionByName(more, allowMissingColumns=True), frame).collect()
    rows = [tuple(r) for r in awkward_rows()] + extra
    expected = plain_audit(rows, labels)
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in found} == expected
    assert len(found) == len(expected) == 600 * 4


def test_empty_tables(spark, documents):  # noqa: F811
    assert not audited(empty(spark), empty(spark, LABELS)).collect()
    found = audited(documents, empty(spark, LABELS)).collect()
    assert len(found) == 600 * 4 and not any(r.good_lost or r.toxic_lost for r in found)


@pytest.mark.parametrize("size", range(1, 7))
def test_path_counts(size):
    """Orders through an edge are those before it times those after it; the edges of a filter share all orders."""
    edges = filter_audit.lattice(size)
    assert len(edges) == size << size - 1
    for e in edges:
        done = e.state.bit_count()
        assert (e.reaching, e.leaving) == (factorial(done), factorial(size - 1 - done))
    for f in range(size):
        assert sum(e.reaching * e.leaving for e in edges if e.filter == f) == factorial(size)


def test_any_number_of_filters(spark):
    counts = spark.createDataFrame([("p", 3, True, False, 5), ("p", 0, True, False, 2)], "part string, failed int, good boolean, toxic boolean, n long")
    found = {(r.filter_order, r.step): r for r in filter_audit.audit_orders(counts, "XY").collect()}
    assert len(found) == 4 and found["XY", 1].removed == 5 and found["XY", 2].redundant == 5 and found["YX", 2].shapley == 5
    with pytest.raises(ValueError, match="1 to 7"):
        filter_audit.audit_orders(counts, "ABCDEFGH")
