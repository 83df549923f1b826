"""The registered queries of the subpackage: their SQL where there is some, and the pipeline stage by stage."""

from pathlib import Path

import duckdb
import pytest
from helpers import DOCUMENTS, awkward_rows, duplicate_components, fold, prose, words
from test_search import plain_scan, plain_targets

import corpus_pipeline
from tablescout.llm.queries import ORACLES, QUERIES, tokenizer


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        files = f"{path}/*.parquet" if path.is_dir() else path
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{files}'")
    asked = duck.execute(ORACLES[name])
    names = [c[0] for c in asked.description]
    found = QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(str, found.select(names).collect())) == sorted(
        map(str, spark.createDataFrame(asked.fetchall(), found.select(names).schema).collect())
    )


def test_every_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with good and bad documents, copies, benchmark passages and awkward rows."""
    path = str(tmp_path_factory.mktemp("tables"))
    passage = prose(900, 30)
    rows, labels = [], []
    for k in range(200, 360):
        text = prose(k, 40 + k % 60)
        bad = k % 5 == 0
        if bad:
            text = " ".join(w + "###" for w in text.split())
        elif k % 31 == 0:
            text = f"{text} {passage} {prose(k + 1000, 30)}"
        elif k % 17 == 0:
            text = prose(k - 1, 40 + (k - 1) % 60) + " tail"
        rows.append((k, text, "en", f"s{k % 3}", len(text)))
        labels.append((k, int(not bad), 0))
    rows += [r for r in awkward_rows() if r[0] not in (109,)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_stages(spark, folder):
    """Each stage on what its predecessor kept, against brute force."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    def rows(frame):
        return [tuple(r) for r in frame.collect()]

    def step(name, docs):
        out = stages[name](spark, docs, folder)
        kept = spark.createDataFrame(rows(out), out.schema)
        if name != "token store":
            assert kept.columns == docs.columns
        return kept

    good = step("quality classifier", docs)
    before, after = rows(docs), rows(good)
    assert set(after) <= set(before)
    synthetic = {r[0] for r in before if r[0] is not None and 200 <= r[0] < 360}
    assert {r[0] for r in after} & synthetic == {k for k in synthetic if k % 5}

    unique = step("near-duplicates", good)
    groups: dict = {}
    for row, group in duplicate_components([(k, r[1]) for k, r in enumerate(after)], 5, 80).items():
        groups.setdefault(group, []).append(after[row][0])
    expected = [min(ids, key=lambda d: (d is None, d)) for ids in groups.values()]
    assert sorted(str(r[0]) for r in rows(unique)) == sorted(map(str, expected))

    clean = step("benchmark decontamination", unique)
    items = [(1, prose(900, 30))]
    assert sorted(map(str, rows(clean))) == sorted(str(r) for r in rows(unique) if not plain_scan(r[1], items)[1])
    assert clean.count() < unique.count()

    mixed = step("mixing", clean)
    sizes = {}
    for _, text, _, source, _ in rows(clean):
        sizes[source] = sizes.get(source, 0) + len(words(text))
    for source, target in plain_targets(sizes).items():
        mine = [r for r in rows(mixed) if r[3] == source]
        largest = max(len(words(r[1])) for r in rows(clean) if r[3] == source)
        assert abs(sum(len(words(r[1])) for r in mine) - target) <= largest
    assert all(rows(mixed).count(r) <= 3 * rows(clean).count(r) for r in set(rows(mixed)))

    stored = stages["token store"](spark, mixed, folder)
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer("word_bpe_49k.json")).encode
    counts = sorted((str(d), len(encode(t or "", add_special_tokens=False).ids) + 1) for d, t, *_ in rows(mixed))
    assert sorted((str(r.doc_id), r.n_tokens) for r in stored.collect()) == counts


def test_pipeline_runs_whole(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert sorted(found.columns) == ["doc_id", "ids_crc32", "n_tokens", "start"] and found.count() > 0


def test_held_out_quality_and_language(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op9_quality"](spark, sf_dir).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) >= 0.9 * len(rows)
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op6_language_id"](spark, sf_dir).collect() if r.held_out and langs[r.doc_id]]
    assert all(fold(r.doc_id, 4) == 2 for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.9 * len(rows)
