"""The value index against the operators that read the tables themselves."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.local import local_frame
from tablescout.operators import value_index
from tablescout.operators.cardinality import detect_cardinality
from tablescout.operators.profile import profile_tables
from tablescout.operators.relate import PAIR_KEY, value_overlap
from tablescout.operators.views import Edge, bridge_view, summary_view
from tablescout.plans.discover import Place, discover
from tablescout.plans.store import TableStore
from tablescout.plans.value_index import ValueIndex
from tablescout.schemas import EDGE_KEY

LONG = "long text " * 20
SCHEMA = "id int, big long, price double, part float, day date, at timestamp_ntz, flag boolean, name string, amount decimal(10,2), tags array<string>, raw binary"


def mixed_frames(spark):
    one = [
        (1, 1, 1.0, 0.5, None, None, True, " a ", Decimal("1.50"), ["x"], b"\x00\xff"), (2, 2, -0.0, 0.5, None, None, False, "a", Decimal("1.5"), ["x"], b"x"),
        (2, None, 0.0, None, None, None, None, "", None, [], None), (None, 5, float("nan"), 1e10, None, None, None, LONG, None, None, b"y" * 100),
        (4, 5, 2.5, 1.0, None, None, None, LONG + " ", None, [LONG], b"y" * 100), (4, 5, 2.5, 1.0, None, None, None, None, None, None, None),
        (7, 8, 1.0, 1.0, None, None, None, "  ", None, [""], None), (7, 8, 1.0, 1.0, None, None, None, "zz", None, [""], None), (9, 9, 9.0, 9.0, None, None, None, "b" * 64, None, [""], None),
    ]
    two = spark.range(6).select(
        F.col("id").cast("string").alias("code"), (F.col("id") * 2).alias("id"), F.when(F.col("id") > 2, F.lit(LONG)).otherwise("a").alias("name"),
        F.expr("timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, id)").alias("at"),
    )
    none = spark.createDataFrame([], "id int, name string")
    return {"one": spark.createDataFrame(one, SCHEMA), "two": two, "none": none, "numbers": spark.range(3).toDF("id")}


@pytest.fixture()
def index(spark, tmp_path):
    return ValueIndex(TableStore(spark, str(tmp_path)), buckets=4)


def pairs_of(spark, frames, names):
    columns = [(t, c) for t, frame in frames.items() for c in frame.columns]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return local_frame(spark, [dict(zip(names, (*a, *b), strict=True)) for a in columns for b in columns if a != b and a[0] <= b[0]], schema)


def test_index_equals_the_tables(spark, index):
    """Values of every type: texts to trim, blank and long ones, doubles that are equal, nested and binary values, no rows."""
    frames = mixed_frames(spark)
    assert not index.build(frames)
    assert rows(index.profile()) == rows(profile_tables(spark, frames).select(index.profile().columns))
    pairs = pairs_of(spark, frames, PAIR_KEY)
    for label in ("WEAK", "LOW", "HIGH"):
        found = index.overlap(pairs, label)
        assert rows(found) == rows(value_overlap(spark, frames, pairs, label).select(found.columns))
    edges = pairs_of(spark, frames, EDGE_KEY)
    found = index.cardinality(edges)
    assert rows(found) == rows(detect_cardinality(spark, frames, edges).select(found.columns))


def test_views_equal_those_of_the_tables(spark, index):
    frames = mixed_frames(spark)
    index.build(frames)
    for edge in (Edge("one", "id", "two", "id", "N:M"), Edge("one", "big", "two", "code", "N:M"), Edge("one", "price", "one", "part", "N:M")):
        sides = frames[edge.from_table], frames[edge.to_table]
        assert rows(index.bridge(edge)) == rows(bridge_view(*sides, edge))
        assert rows(index.summary(edge)) == rows(summary_view(*sides, edge))
    with pytest.raises(ValueError, match="digests"):
        index.bridge(Edge("one", "name", "two", "name", "N:M"))


def counting(frame, seen):
    """The frame, counting the rows that are read of it."""

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return frame.mapInArrow(passed, frame.schema)


def test_discovery_scans_each_table_once(spark, tmp_path, sf_dir):
    names = {"orders": "o_orderkey ORDER_ID o_custkey CUSTOMER_ID", "customer": "c_custkey CUSTOMER_ID c_name NAME", "documents": "doc_id DOC_ID text TEXT"}
    frames, seen, counts = {}, {}, {}
    for table, pairs in names.items():
        old, new = pairs.split()[::2], pairs.split()[1::2]
        frames[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*[f"{o} AS {n}" for o, n in zip(old, new, strict=True)])
        counts[table] = frames[table].count()
        seen[table] = spark.sparkContext.accumulator(0)
    store, other = TableStore(spark, str(tmp_path / "indexed")), TableStore(spark, str(tmp_path / "plain"))
    discover(spark, {t: counting(f, seen[t]) for t, f in frames.items()}, Place("S"), store, index=ValueIndex(store, buckets=4))
    assert {t: a.value for t, a in seen.items()} == counts
    discover(spark, frames, Place("S"), other)
    for name in ("COLUMN_PROFILE", "KEY_CANDIDATES", "RELATIONSHIP_CANDIDATES", "RELATIONSHIP_GRAPH", "ENTITY_MAP", "RELATIONSHIP_CARDINALITY"):
        columns = [c for c in store.read(name).columns if not c.endswith(("_RUN_ID", "_AT"))]
        assert rows(store.read(name).select(columns)) == rows(other.read(name).select(columns))
    assert store.read("RELATIONSHIP_CANDIDATES").count() > 0


def test_tables_that_cannot_be_read_are_named(spark, index):
    bad = spark.range(3).select(F.expr("assert_true(id < 0)").cast("string").alias("x"), "id")
    failures = index.build({"bad": bad, "good": spark.range(3).toDF("id")})
    assert list(failures) == ["bad"] and index.profile().select("TARGET_TABLE").distinct().collect() == [("good",)]


def test_deltas_fold_into_the_index(spark, index, monkeypatch):
    """Rows come and go, extremes among them, until folders are folded; the profile stays that of the table."""
    monkeypatch.setattr("tablescout.plans.value_index.MOST_FOLDERS", 3)
    schema = "id int, name string, word string"
    table = [(k, f"{chr(97 + k)} {LONG}" if k % 2 else f"w{k}", f"w{k % 3}") for k in range(12)]
    index.build({"t": spark.createDataFrame(table, schema), "other": spark.range(3).toDF("id")})
    steps = [([0, 1], [(20, "0" + LONG, None)]), ([20], []), ([], [(21, None, "w0")] * 3), ([11, 2], [(11, "zz", "w9")]), ([3, 4, 5, 6, 7, 8, 9, 10, 11, 21], [])]
    for gone, new in steps:
        removed = [r for r in table if r[0] in gone]
        table = [r for r in table if r[0] not in gone] + new
        current = spark.createDataFrame(table, schema)
        index.follow("t", spark.createDataFrame(removed, schema), spark.createDataFrame(new, schema), current)
        expected = profile_tables(spark, {"t": current})
        assert rows(index.profile(["t"]).select(expected.columns)) == rows(expected)
        assert len(index.entries()["t"].folders) <= 3
    assert not table
    with pytest.raises(ValueError, match="columns differ"):
        index.follow("t", spark.range(1).toDF("id"), spark.range(1).toDF("id"), spark.range(1).toDF("id"))


def test_summary_follows_both_sides(spark, index):
    def sides(parent, child):
        return [spark.createDataFrame([(k,) for k in keys], "k string") for keys in (parent, child)]

    edge = Edge("p", "k", "c", "k", "N:M")
    parent, child = ["a", "a", "b", " b", "c", None, ""], ["a", "b", "b", "d"]
    old = sides(parent, child)
    index.build(dict(zip("pc", old, strict=True)))
    stored, before = index.summary(edge), index.entries()
    stored = index.held(stored, "summary")
    gone, new = (["a", "c", None], ["b"]), (["d", "d", "e"], ["a", "a", "f", "e "])
    after = sides([k for k in parent if k not in ("c", None)][1:] + new[0], ["a", "b", "d", *new[1]])
    for table, minus, plus, now in zip("pc", sides(*gone), sides(*new), after, strict=True):
        index.follow(table, minus, plus, now)
    assert rows(index.summary_after(edge, stored, before)) == rows(summary_view(*after, edge)) == rows(index.summary(edge))
    index.build({"p": after[0]})
    with pytest.raises(ValueError, match="anew"):
        index.summary_delta(edge, before)


def test_sets_of_five_thousand_columns(spark):
    """Value v is in the columns that divide it or follow it; a row is as wide as the columns of its value."""
    columns = 5000
    held = [(c, v) for v in range(1, 400) for c in ({d for d in range(1, v + 1) if v % d == 0} | {columns - v})]
    held += [(c, 0) for c in range(columns)]  # one value is everywhere
    index_rows = spark.createDataFrame([(c, str(v), str(v), 1) for c, v in held], "ID int, V string, K string, N long")
    pairs = [(p, c) for c in range(1, 60) for p in (1, c, 2 * c, columns - c) if p != c]
    frame = spark.createDataFrame(pairs, "PARENT_ID int, CHILD_ID int").distinct()
    sets = value_index.column_sets(index_rows)
    assert sets.dtypes == [("IDS", "array<int>"), ("N", "bigint")]
    assert sets.select(F.max(F.size("IDS")), F.expr("percentile(size(IDS), 0.5)")).first()[0] == columns
    assert sets.where("size(IDS) < 40").count() == sets.count() - 1
    by_column = {}
    for c, v in held:
        by_column.setdefault(c, set()).add(v)
    found = {(r.PARENT_ID, r.CHILD_ID): r.MATCH_COUNT for r in value_index.matches(sets, frame).collect()}
    expected = {(p, c): len(by_column[p] & by_column[c]) for p, c in set(pairs)}
    assert found == {k: n for k, n in expected.items() if n}


def test_pairs_are_refuted_by_a_share_of_the_values(spark):
    pairs = spark.createDataFrame([(1, 2), (3, 2), (5, 2)], "PARENT_ID int, CHILD_ID int")
    found = spark.createDataFrame([(1, 2, 10), (3, 2, 9)], "PARENT_ID int, CHILD_ID int, MATCH_COUNT long")
    seen, totals = (spark.createDataFrame([(2, n)], "ID int, VALUES long") for n in (10, 50))
    left = value_index.still_possible(pairs, found, seen, totals, 0.98)
    assert rows(left) == [(1, 2), (3, 2)]  # 49 of 50 are still possible, 40 are not
    assert value_index.least_rate("WEAK") == 0.0
    with pytest.raises(ValueError, match="unknown label"):
        value_index.least_rate("BEST")


@pytest.mark.parametrize("zeros,bounds", [([-0.0], ("-0.0", "-0.0")), ([-0.0, 0.0], ("-0.0", "0.0")), ([0.0], ("0.0", "0.0"))])
def test_signed_zeros_are_bounds(spark, index, zeros, bounds):
    """The bounds are those of SQL's texts, from tables and from the index; a delta may take a sign away."""
    frame = spark.createDataFrame([(z, z, 1) for z in zeros] + [(None, None, 1)], "d double, f float, n int")
    index.build({"t": frame})
    for profile in (profile_tables(spark, {"t": frame}, signed_zeros=True), index.profile(signed_zeros=True)):
        found = {r.TARGET_COLUMN: (r.MIN_VALUE, r.MAX_VALUE, r.DISTINCT_COUNT) for r in profile.collect()}
        assert found == {"d": (*bounds, 1), "f": (*bounds, 1), "n": ("1", "1", 1)}
    signed = frame.where("cast(d AS string) = '-0.0'")
    plain = spark.createDataFrame([(0.0, 0.0, 1)], frame.schema)
    index.follow("t", signed, plain, plain)
    found = {r.TARGET_COLUMN: (r.MIN_VALUE, r.MAX_VALUE) for r in index.profile(signed_zeros=True).collect()}
    assert found["d"] == found["f"] == ("0.0", "0.0")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("columns", [1, 3, 63, 64, 130])
def test_masks_are_the_sets_of_columns(spark, columns):
    """Values of a few known columns are grouped by masks of fixed width, which says the same as sets do."""
    held = [(c, str(v)) for v in range(1, 300) for c in range(columns) if (c + 1) % v == 0 or c in (v % 70, v % 7) or v == 299]
    index_rows = spark.createDataFrame([*held, (0, None)], "ID int, V string").withColumn("N", F.lit(1))
    masked, sets = value_index.column_sets(index_rows, columns), value_index.column_sets(index_rows)
    assert "ObjectHashAggregate" in plan(sets) and "ObjectHashAggregate" not in plan(masked)
    assert masked.dtypes == sets.dtypes and rows(masked) == rows(sets)
    totals = value_index.distinct_values(index_rows)
    assert rows(value_index.values_of_sets(masked)) == rows(totals) == rows(value_index.values_of_sets(sets))


def test_no_columns_have_no_sets(spark, index):
    index.build({"t": spark.range(3).toDF("id")})
    names = T.StructType([T.StructField(n, T.StringType()) for n in PAIR_KEY])
    gone = local_frame(spark, [dict(zip(PAIR_KEY, ("t", "x", "u", "y"), strict=True))], names)
    for label in ("WEAK", "HIGH"):
        assert index.overlap(gone, label).collect() == []


def test_values_that_are_their_own_keys_are_not_grouped_again(spark, index):
    """Numbers are counted as they are in the index, without a shuffle of them; texts by their trimmed keys."""
    frames = {
        "one": spark.createDataFrame([(1, "a", 0.0), (1, " a", -0.0), (2, "b", 1.5), (None, " ", None)], "id long, name string, price double"),
        "two": spark.createDataFrame([(2, "a ", 0.0), (3, None, 2.5)], "id int, name string, price double"),
    }
    index.build(frames)
    names = T.StructType([T.StructField(n, T.StringType()) for n in EDGE_KEY])
    for columns, grouped in ((["id", "price"], False), (["name"], True), (["id", "name"], True)):
        edges = local_frame(spark, [dict(zip(EDGE_KEY, ("one", c, "two", c), strict=True)) for c in columns], names)
        found = index.cardinality(edges)
        assert rows(found) == rows(detect_cardinality(spark, frames, edges).select(found.columns))
        assert ("K#" in plan(found)) == grouped
