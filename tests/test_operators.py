import itertools

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import NumberFormatException, SparkRuntimeException
from pyspark.sql import functions as F

from tablescout.functions.values import common_domain
from tablescout.operators.cardinality import detect_cardinality
from tablescout.operators.conform import ColumnPlan, conform, with_lineage
from tablescout.operators.keys import key_candidates
from tablescout.operators.merge import duplicate_keys, key_bucket, latest_per_key, merge_upsert
from tablescout.operators.profile import profile_tables
from tablescout.operators.relate import PAIR_KEY, candidate_pairs, value_overlap
from tablescout.operators.views import Edge, bridge_view, flat_view, object_view, summary_view
from tablescout.schemas import EDGE_KEY


def test_conform_text_numbers_and_dates(spark):
    raw = spark.createDataFrame(
        [("", "abc", "2024-13-01", "12.5"), ("  ", " 12 ", "2024-01-31", "1e2"), ("\t", None, "x", "-0.4"),
         (" ", "7", None, "9"), (" a ", "7.6", "2024-02-29", "99999999999999999999"), ("\x1c", "1", "1", "")],
        "t string, n string, d string, f string",
    )
    plan = [
        ColumnPlan("t", "T", "VARCHAR(5)"), ColumnPlan("n", "N", "NUMBER(38,0)"), ColumnPlan("d", "D", "DATE"),
        ColumnPlan("f", "F", "FLOAT"),
    ]
    out = conform(raw, plan).collect()
    assert [r["T"] for r in out] == [None, None, None, None, " a ", None]
    assert [r["N"] for r in out] == [None, 12, None, 7, 8, 1]
    assert [str(r["D"]) for r in out][:3] == ["None", "2024-01-31", "None"]
    assert [r["F"] for r in out] == [12.5, 100.0, -0.4, 9.0, 1e20, None]


def test_conform_boolean_is_strict(spark):
    raw = spark.createDataFrame([("true",), ("maybe",)], "b string")
    plan = [ColumnPlan("b", "B", "BOOLEAN")]
    with pytest.raises(SparkRuntimeException):
        conform(raw, plan).collect()
    assert [r.B for r in conform(raw, plan, strict_boolean=False).collect()] == [True, None]


def test_conform_column_problems(spark):
    raw = spark.createDataFrame([(1, 2)], "`a b` int, a_b int")
    with pytest.raises(ValueError, match="one target column"):
        conform(raw, [ColumnPlan("a b", "A_B", "NUMBER(38,0)"), ColumnPlan("a_b", "A_B", "NUMBER(38,0)")])
    with pytest.raises(ValueError, match="missing"):
        conform(raw, [ColumnPlan("gone", "GONE", "VARCHAR")])
    out = conform(raw, [ColumnPlan("a b", "A", "NUMBER(38,0)")])
    assert out.dtypes == [("A", "bigint"), ("a_b", "string")]


def test_conform_passes_binary_and_nested(spark):
    raw = spark.sql("select cast('x' as binary) b, array(1, 2) a")
    out = conform(raw, [ColumnPlan("b", "B", "BINARY"), ColumnPlan("a", "A", "VARCHAR")])
    assert out.dtypes == [("B", "binary"), ("A", "array<int>")]
    stamped = with_lineage(out, "S", "D", "C", "T")
    assert stamped.columns[-5:] == ["_SOURCE_SYSTEM", "_SOURCE_DATABASE", "_SOURCE_SCHEMA", "_SOURCE_TABLE", "_INGESTED_AT"]


PAIRS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 9)), max_size=12)


@settings(max_examples=8, deadline=None)
@given(target=PAIRS, stage=st.dictionaries(st.one_of(st.none(), st.integers(0, 4)), st.integers(10, 19), max_size=5))
def test_merge_equals_row_by_row_merge(spark, target, stage):
    expected = [(k, stage[k] if k is not None and k in stage else v) for k, v in target]
    present = {k for k, _ in target if k is not None}
    expected += [(k, v) for k, v in stage.items() if k is None or k not in present]
    left = spark.createDataFrame(target, "k int, v int")
    right = spark.createDataFrame(list(stage.items()), "k int, v int")
    merged = merge_upsert(left, right, ["k"])
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert rows(merged) == sorted(expected, key=key)
    filled = right.dropna()
    once = merge_upsert(left, filled, ["k"])
    assert rows(merge_upsert(once, filled, ["k"])) == rows(once)


def test_duplicate_keys_and_latest(spark):
    stage = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 1), (None, 2)], "k int, v int")
    assert rows(duplicate_keys(stage, ["k"])) == [(1, 2)]
    assert rows(latest_per_key(stage.dropna(), ["k"], [F.desc("v")])) == [(1, 2), (2, 1)]


def test_null_keys_spread_over_buckets(spark):
    frame = spark.range(1000).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"))
    buckets = frame.select(key_bucket(["k", "v"], ["k"], 8).alias("b")).groupBy("b").count().collect()
    assert len(buckets) == 8 and max(r["count"] for r in buckets) < 250
    same = spark.createDataFrame([(5, 1), (5, 2)], "k long, v long").select(key_bucket(["k", "v"], ["k"], 8)).distinct()
    assert same.count() == 1


def test_profile_known_values(spark):
    frame = spark.createDataFrame(
        [(1, 1.5, "a", True, [1]), (2, -0.0, "B", None, [1]), (10, 0.0, None, True, [2]), (10, None, "x" * 100, False, None)],
        "i int, d double, s string, b boolean, a array<int>",
    )
    empty = spark.createDataFrame([], "e string, n long")
    found = {
        (r.TARGET_TABLE, r.TARGET_COLUMN): r for r in profile_tables(spark, {"t": frame, "none": empty}).collect()
    }
    pick = lambda t, c: tuple(
        found[t, c][n] for n in ("ROW_COUNT", "NON_NULL_COUNT", "NULL_COUNT", "DISTINCT_COUNT", "MIN_VALUE", "MAX_VALUE")
    )
    assert pick("t", "i") == (4, 4, 0, 3, "1", "2")
    assert pick("t", "d") == (4, 3, 1, 2, "0.0", "1.5")
    assert pick("t", "s") == (4, 3, 1, 3, "B", "x" * 100)
    assert pick("t", "b") == (4, 3, 1, 2, "false", "true")
    assert pick("t", "a") == (4, 3, 1, 2, None, None)
    assert pick("none", "e") == (0, 0, 0, 0, None, None)
    assert found["none", "n"].DISTINCT_RATIO == 0.0 and found["t", "i"].DISTINCT_RATIO == 0.75


def test_profile_keeps_lineage_out_and_long_texts_apart(spark):
    long_a, long_b = "p" * 70 + "a", "p" * 70 + "b"
    digest = spark.range(1).select(F.sha2(F.lit(long_a), 256)).head()[0]
    frame = spark.createDataFrame([(long_a,), (long_b,), (digest,), (long_a,)], "s string").withColumn(
        "_SOURCE_TABLE", F.lit("x")
    )
    only = profile_tables(spark, {"t": frame}).collect()
    assert [(r.TARGET_COLUMN, r.DISTINCT_COUNT) for r in only] == [("s", 3)]


def test_profile_against_brute_force(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/orders.parquet")
    data = frame.toPandas()
    for row in profile_tables(spark, {"orders": frame}).collect():
        column = data[row.TARGET_COLUMN]
        assert row.ROW_COUNT == len(data) and row.DISTINCT_COUNT == column.nunique()


def test_candidates_on_renamed_views(spark, sf_dir):
    from workload.tables import renamed_views

    counts = dict(
        key_candidates(profile_tables(spark, renamed_views(spark, sf_dir))).groupBy("CANDIDATE_TYPE").count().collect()
    )
    assert counts == {"PRIMARY_KEY": 9, "UNIQUE_ATTRIBUTE": 9, "FOREIGN_KEY": 6, "BUSINESS_KEY": 1}


NAMES = ["ID", "CUSTOMER_ID", "CUSTOMERID", "ORDER_ID", "ORDERNUMBER", "JOB_CODE", "JOB_KEY", "NUMBER", "NAME", "KEY"]


def compatible(parent, child):
    def base(name):
        for part in ("_ID", "ID", "_NUMBER", "NUMBER", "_CODE", "CODE", "_KEY", "KEY"):
            name = name.replace(part, "")
        return name

    return parent in child or child in parent or bool(base(parent)) and base(parent) == base(child)


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["A", "B", "C"]), st.sampled_from(NAMES),
            st.sampled_from(["PRIMARY_KEY", "BUSINESS_KEY", "UNIQUE_ATTRIBUTE", "FOREIGN_KEY"]),
        ),
        max_size=12, unique_by=lambda c: c[:2],
    )
)
def test_candidate_pairs_equal_nested_loops(spark, candidates):
    frame = spark.createDataFrame(candidates, "TARGET_TABLE string, TARGET_COLUMN string, CANDIDATE_TYPE string")
    expected = sorted(
        (p[0], p[1], c[0], c[1])
        for p, c in itertools.product(candidates, candidates)
        if p[2] != "FOREIGN_KEY" and c[2] in ("BUSINESS_KEY", "FOREIGN_KEY") and p[0] != c[0] and compatible(p[1], c[1])
    )
    assert rows(candidate_pairs(frame).select(*PAIR_KEY)) == expected


def test_overlap_of_many_columns_and_types(spark):
    """More columns than one mask word holds, and every comparison domain."""
    wide = spark.range(50).select(*[(F.col("id") * (i % 7 + 1)).alias(f"c{i}") for i in range(70)])
    other = spark.createDataFrame(
        [("0", 0.0, "x" * 90), ("3", -0.0, "y" * 90), ("999", 2.5, None), (None, None, "x" * 90)],
        "s string, d double, t string",
    )
    twin = other.select(F.col("t").alias("t2"), F.col("d").alias("d2")).where("t2 like 'x%'")
    frames = {"wide": wide, "other": other, "twin": twin, "void": other.where("false")}
    edges = [("wide", f"c{i}", "wide", f"c{i + 1}") for i in range(69)] + [
        ("wide", "c0", "other", "s"), ("twin", "t2", "other", "t"), ("twin", "d2", "other", "d"),
        ("wide", "c0", "void", "s"),
    ]
    pairs = spark.createDataFrame(edges, ", ".join(f"{n} string" for n in PAIR_KEY))
    found = {
        (r.PARENT_TABLE, r.PARENT_COLUMN, r.CHILD_TABLE, r.CHILD_COLUMN): (r.CHILD_NON_NULL_COUNT, r.MATCH_COUNT)
        for r in value_overlap(spark, frames, pairs).collect()
    }
    for i in range(69):
        parent = {x * (i % 7 + 1) for x in range(50)}
        child = {x * ((i + 1) % 7 + 1) for x in range(50)}
        assert found["wide", f"c{i}", "wide", f"c{i + 1}"] == (len(child), len(child & parent))
    assert found["wide", "c0", "other", "s"] == (3, 2)
    assert found["twin", "t2", "other", "t"] == (2, 1)
    assert found["twin", "d2", "other", "d"] == (2, 1)
    assert found["wide", "c0", "void", "s"] == (0, 0)
    assert len(found) == len(edges)


def test_comparison_domains():
    assert common_domain("int", "bigint") == "bigint"
    assert common_domain("date", "date") == "date"
    assert common_domain("double", "bigint") == common_domain("array<int>", "array<int>") == "string"


def test_cardinality_trims_text_keys(spark):
    left = spark.createDataFrame([("a",), (" a ",), ("b",), ("",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("b",), ("  ",)], "k string")
    edges = spark.createDataFrame([("l", "k", "r", "k"), ("r", "k", "l", "k")], ", ".join(f"{n} string" for n in EDGE_KEY))
    found = {r.FROM_TABLE: r for r in detect_cardinality(spark, {"l": left, "r": right}, edges).collect()}
    assert found["l"].CARDINALITY_TYPE == "N:1" and found["r"].CARDINALITY_TYPE == "1:N"
    assert (found["l"].FROM_DISTINCT_KEYS, found["l"].FROM_DUPLICATE_KEYS) == (2, 1)


KEYS = st.lists(st.one_of(st.none(), st.sampled_from(["a", " a", "b", "", "  ", "c"])), max_size=8)


@settings(max_examples=6, deadline=None)
@given(parents=KEYS, children=KEYS, kind=st.sampled_from(["1:N", "N:M", None]))
def test_views_equal_the_row_level_join(spark, parents, children, kind):
    parent = spark.createDataFrame(list(enumerate(parents)), "p int, k string")
    child = spark.createDataFrame(list(enumerate(children)), "c int, k string")
    edge = Edge("P", "k", "C", "k", kind)
    norm = lambda k: k.strip(" ") or None if k is not None else None
    joined = [
        (p, norm(pk), c) for (p, pk), (c, ck) in itertools.product(enumerate(parents), enumerate(children))
        if norm(pk) is not None and norm(pk) == norm(ck)
    ]
    expected = [(p, c) for p, _, c in joined]
    expected += [(p, None) for p in range(len(parents)) if p not in {j[0] for j in joined}]
    order = lambda r: [(v is not None, str(v)) for v in r]
    assert rows(flat_view(parent, child, edge).select("p", "c")) == sorted(expected, key=order)
    nested = object_view(parent, child, edge)
    assert rows(nested.select("p", "_SEMANTIC_CHILD_RECORD.c")) == sorted(expected, key=order)
    assert nested.where("_SEMANTIC_CHILD_RECORD is null").count() == 0
    keys = sorted({k for _, k, _ in joined})
    assert rows(bridge_view(parent, child, edge).select("PARENT_KEY_VALUE", "CHILD_KEY_VALUE")) == [(k, k) for k in keys]
    summary = summary_view(parent, child, edge)
    assert rows(summary.select("PARENT_KEY_VALUE", "JOINED_ROW_COUNT", "DISTINCT_CHILD_KEY_COUNT")) == [
        (k, sum(1 for j in joined if j[1] == k), 1) for k in keys
    ]


def test_flat_view_unique_child_and_names(spark):
    parent = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "ID long, NAME string")
    child = spark.createDataFrame([(1, "n"), (3, "m")], "id int, extra string").withColumn("_SOURCE_TABLE", F.lit("c"))
    view = flat_view(parent, child, Edge("PARENT", "ID", "CHILD", "id", "1:1"))
    assert view.columns[:4] == ["ID", "NAME", "CHILD_ID", "extra"]
    assert rows(view.select(*view.columns[:4])) == [(None, "z", None, None), (1, "x", 1, "n"), (2, "y", None, None)]
    clash = child.withColumn("CHILD_ID", F.lit(1))
    with pytest.raises(ValueError, match="clash"):
        flat_view(parent, clash, Edge("PARENT", "ID", "CHILD", "id", "1:1"))


def test_views_prune_columns(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    view = object_view(orders, lines, Edge("orders", "o_orderkey", "lineitem", "l_orderkey", "1:N"))
    plan = view.select("o_orderkey", "_SEMANTIC_CHILD_RECORD.l_tax")._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "l_shipdate" not in plan


def test_summary_never_joins_rows(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    view = summary_view(lines, lines, Edge("l", "l_linenumber", "l", "l_linenumber", "N:M"))
    n = dict(lines.groupBy("l_linenumber").count().collect())
    assert {int(r[0]): r[1] for r in view.collect()} == {k: v * v for k, v in n.items()}


def test_ansi_is_on(spark):
    with pytest.raises(NumberFormatException):
        spark.sql("select cast('x' as int)").collect()


def test_overlap_shuffles_do_not_grow_with_pairs(spark):
    wide = spark.range(20).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(40)])

    def shuffles(count):
        edges = [("wide", f"c{i}", "wide", f"c{i + 1}") for i in range(count)]
        pairs = spark.createDataFrame(edges, ", ".join(f"{n} string" for n in PAIR_KEY))
        plan = value_overlap(spark, {"wide": wide}, pairs)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    assert shuffles(1) == shuffles(39)


def test_latest_row_is_limited_before_the_shuffle(spark):
    runs = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = latest_per_key(runs, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hot_and_null_keys_in_joined_views(spark):
    """A third of the child rows on one key, a third of the parents without one."""
    parent = spark.range(300).select(
        F.when(F.col("id") < 200, F.col("id")).alias("k"), F.col("id").alias("p")
    )
    child = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id") % 250).cast("long").alias("k"), F.col("id").alias("c")
    )
    view = flat_view(parent, child, Edge("P", "k", "C", "k", "1:N"))
    expected = parent.join(child, parent.k == child.k, "left").select("p", "c")
    assert rows(view.select("p", "c")) == rows(expected)


def test_profile_bounds_of_signed_zeros(spark):
    """-0.0 and 0.0 are one value, of which the bounds have the text that SQL casts it to."""
    frame = spark.createDataFrame([(-0.0, -0.0, -0.0), (-0.0, 0.0, 0.5), (None, None, -2.5)], "n double, b double, f float")
    found = {r.TARGET_COLUMN: r for r in profile_tables(spark, {"t": frame}, signed_zeros=True).collect()}
    assert [(found[c].MIN_VALUE, found[c].MAX_VALUE, found[c].DISTINCT_COUNT) for c in "nbf"] == [
        ("-0.0", "-0.0", 1), ("-0.0", "0.0", 1), ("-0.0", "0.5", 3),
    ]


def test_unpivoted_numbers_are_of_fixed_width(spark):
    from tablescout.operators.cells import Cell, unpivoted

    frame = spark.createDataFrame([(1, 2)], "a long, b long")
    found = unpivoted({"T": frame}, [Cell("0", "T", "a"), Cell("1", "T", "b")])
    assert found.dtypes == [("C", "int"), ("V", "bigint")]
    assert rows(found) == [(0, 1), (1, 2)]
