"""The value index: the distinct values of all columns of a table with their counts, made by one scan.

A row is (C, V, K, N): column number, text of the value, normalised join key, rows.  Texts of over LONG_TEXT_BYTES
are there as a digest that is longer than any short text, so V alone tells values apart.  K is stored where V does not
tell it, for long texts with blanks around them; `with_keys` puts in the others.  Everything that
discovery asks of a table can be had from these rows: profiles, value overlap, cardinality, bridge and summary
views.  Counts are signed: the rows of a delta are added to those of the table, and what adds up to nothing is
gone, so the index follows a table without reading it again.  SIGNED is how many of a zero's rows are ``-0.0``, which
only the bounds of a profile may tell from ``0.0``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablescout.functions.rules import CONFIDENCE_BANDS, LABEL_ORDER
from tablescout.functions.values import FRACTIONAL, INTEGRAL, is_negative_zero, is_nested, quoted, ratio, text_form
from tablescout.operators.cells import COLUMNS_PER_UNPIVOT, LONG_TEXT_BYTES, union_all
from tablescout.operators.conform import LINEAGE_COLUMNS
from tablescout.operators.relate import PAIR_KEY, WORD_BITS, labelled_overlap

# So many columns at most are told apart by the bits of masks.
MASKED_COLUMNS = 4 * WORD_BITS

# Longer than any text that is kept as it is: a name and 64 hexadecimal digits.
_DIGEST = "concat('sha256:', sha2({}, 256))"
_IS_DIGEST = f"octet_length({{}}) > {LONG_TEXT_BYTES}"


def indexed_columns(frame: DataFrame) -> list[tuple[str, str]]:
    """Name and type of the columns that are indexed, in order of their numbers."""
    return [(name, dtype) for name, dtype in frame.dtypes if name not in LINEAGE_COLUMNS]


def _kind(dtype: str) -> str:
    """The type a column's values are grouped in: their own, but one for all integers, and text for nested and binary ones."""
    return "bigint" if dtype in INTEGRAL else "string" if is_nested(dtype) or dtype == "binary" else dtype


def _text(name: str, dtype: str) -> str:
    return f"hex({quoted(name)})" if dtype == "binary" else text_form(name, dtype)


def _short(text: str) -> str:
    return f"CASE WHEN {_IS_DIGEST.format(text)} THEN {_DIGEST.format(text)} ELSE {text} END"


def _cell(number: int, name: str, dtype: str, kinds: Sequence[str]) -> str:
    """Arguments of stack for one column: its number, its value in the column of its kind, and the key of a long text
    where that is not the text itself."""
    mine = _kind(dtype)
    value = _text(name, dtype) if mine == "string" else f"cast({quoted(name)} AS {mine})"
    key = f"nullif(trim({value}), {value})" if mine == "string" else None
    values = [
        (_short(value) if mine == "string" else value) if kind == mine else f"cast(NULL AS {kind})" for kind in kinds
    ]
    long_key = f"CASE WHEN {_IS_DIGEST.format(value)} THEN {_short(key)} END" if key else "cast(NULL AS string)"
    return ", ".join([str(number), *values, long_key])


def value_rows(frame: DataFrame, observed: DataFrame | None = None) -> DataFrame:
    """The index rows of a table: each column is read once, by one scan for up to COLUMNS_PER_UNPIVOT columns.  The first
    of these scans is that of `observed`, the same table with an observation on it.

    Values are grouped typed, with map-side combining, and long texts as digests, so that neither frequent values
    nor whole documents are shuffled.  A column without a filled row has one row for NULL; a table without rows has
    none.
    """
    columns = list(enumerate(indexed_columns(frame)))
    parts = []
    for start in range(0, len(columns), COLUMNS_PER_UNPIVOT):
        some = columns[start : start + COLUMNS_PER_UNPIVOT]
        kinds = sorted({_kind(dtype) for _, (_, dtype) in some} | {"string"})
        values = [f"V{k}" for k in range(len(kinds))]
        cells = ", ".join(_cell(number, name, dtype, kinds) for number, (name, dtype) in some)
        source = observed if observed is not None and not start else frame
        stacked = source.selectExpr(f"stack({len(some)}, {cells}) AS (C, {', '.join(values)}, LONG_KEY)")
        signed = [is_negative_zero(v) for v, kind in zip(values, kinds, strict=True) if kind in FRACTIONAL]
        counted = stacked.groupBy("C", *values, "LONG_KEY").agg(
            F.count(F.lit(1)).alias("N"),
            (F.count_if(F.expr(" OR ".join(signed))) if signed else F.max(F.lit(0).cast("long"))).alias("SIGNED"),
        )
        text = "coalesce(" + ", ".join(text_form(v, kind) for v, kind in zip(values, kinds, strict=True)) + ")"
        parts.append(counted.selectExpr("C", f"{text} AS V", "LONG_KEY AS K", "N", "SIGNED"))
    return union_all(parts)


def with_keys(rows: DataFrame) -> DataFrame:
    """Index rows with the normalised key of every value: texts are trimmed, with blank as NULL.  Texts of other types
    have no blanks around them."""
    key = f"nullif(CASE WHEN {_IS_DIGEST.format('V')} THEN coalesce(K, V) ELSE trim(V) END, '')"
    return rows.withColumn("K", F.expr(key))


def text_extremes(frame: DataFrame) -> dict[str, Column]:
    """Aggregates for the least and greatest text of each text column, to be observed while the index is written."""
    return {
        f"{bound}{number}": function(F.col(quoted(name)))
        for number, (name, dtype) in enumerate(indexed_columns(frame)) if dtype == "string"
        for bound, function in (("LO", F.min), ("HI", F.max))
    }


def folded(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed rows added up; values that no row has any more are gone."""
    return rows.groupBy(*keys, "V", "K").agg(F.sum("N").alias("N"), F.sum("SIGNED").alias("SIGNED")).where("N <> 0 OR SIGNED <> 0")


def negated(rows: DataFrame) -> DataFrame:
    """Index rows of rows that are no longer there."""
    return rows.withColumns({"N": -F.col("N"), "SIGNED": -F.col("SIGNED")})


def column_profiles(rows: DataFrame, signed_zeros: bool = False) -> DataFrame:
    """(ID, ROW_COUNT, NON_NULL_COUNT, DISTINCT_COUNT, LO, HI) of index rows (ID, V, K, N, SIGNED); bounds are those of the
    values that are kept as text, and HAS_LONG tells whether there are others.  With `signed_zeros` they tell ``-0.0`` from
    ``0.0``."""
    filled = F.col("V").isNotNull()
    long = F.expr(_IS_DIGEST.format("V"))
    short = F.when(~long, F.col("V"))
    low, high = short, short
    if signed_zeros:
        low, high = (
            F.when((F.col("SIGNED") > 0) & test, F.lit("-0.0")).otherwise(short)
            for test in (F.lit(True), F.col("SIGNED") == F.col("N"))
        )
    return rows.groupBy("ID").agg(
        F.sum("N").alias("ROW_COUNT"),
        F.coalesce(F.sum(F.when(filled, F.col("N"))), F.lit(0)).alias("NON_NULL_COUNT"),
        F.count("V").alias("DISTINCT_COUNT"),
        F.coalesce(F.bool_or(long), F.lit(False)).alias("HAS_LONG"),
        F.min(low).alias("LO"),
        F.max(high).alias("HI"),
    )


def profile_of(counted: DataFrame, columns: DataFrame) -> DataFrame:
    """Profile rows from `column_profiles` and the columns (ID, TARGET_TABLE, TARGET_COLUMN, DATA_TYPE, TEXT_LO, TEXT_HI)."""
    zero = F.lit(0).cast("long")
    found = columns.join(counted, "ID", "left").withColumns(
        {name: F.coalesce(name, zero) for name in ("ROW_COUNT", "NON_NULL_COUNT", "DISTINCT_COUNT")}
    )
    ordered = ~F.col("DATA_TYPE").rlike("^(array|map|struct|variant|binary)")
    bounds = [
        F.when(F.col("HAS_LONG"), F.col(f"TEXT_{bound}")).when(ordered, F.col(bound)).alias(name)
        for bound, name in (("LO", "MIN_VALUE"), ("HI", "MAX_VALUE"))
    ]
    return found.select(
        "TARGET_TABLE", "TARGET_COLUMN", "DATA_TYPE", "ROW_COUNT", "NON_NULL_COUNT",
        (F.col("ROW_COUNT") - F.col("NON_NULL_COUNT")).alias("NULL_COUNT"),
        "DISTINCT_COUNT",
        ratio(F.col("DISTINCT_COUNT"), F.col("ROW_COUNT")).alias("DISTINCT_RATIO"),
        ratio(F.col("NON_NULL_COUNT"), F.col("ROW_COUNT")).alias("NON_NULL_RATIO"),
        *bounds,
    )


def column_sets(rows: DataFrame, columns: int | None = None) -> DataFrame:
    """(IDS, N): how many values occur in exactly the columns of a sorted array.

    A row is as wide as the columns that hold the value, not as all columns are.  Where the ids are known to be those
    from 0 to `columns` and few, a value is a bit mask of them: that is of fixed width, so no sort groups the values.
    """
    filled = rows.where("V IS NOT NULL")
    if columns is None or columns > MASKED_COLUMNS:
        held = filled.groupBy("V").agg(F.collect_set("ID").alias("IDS"))
        return held.select(F.sort_array("IDS").alias("IDS")).groupBy("IDS").agg(F.count(F.lit(1)).alias("N"))
    words = [f"W{word}" for word in range(-(-columns // WORD_BITS))] or ["W0"]
    bit = f"shiftleft(1L, ID % {WORD_BITS})"
    masks = [F.bit_or(F.expr(f"CASE WHEN ID div {WORD_BITS} = {n} THEN {bit} ELSE 0L END")).alias(w) for n, w in enumerate(words)]
    counted = filled.groupBy("V").agg(*masks).groupBy(*words).agg(F.count(F.lit(1)).alias("N"))
    held = F.array(*[F.when(F.getbit(words[c // WORD_BITS], F.lit(c % WORD_BITS)) == 1, F.lit(c)) for c in range(columns)])
    return counted.select(F.array_compact(held).cast("array<int>").alias("IDS"), "N")


def matches(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(PARENT_ID, CHILD_ID, MATCH_COUNT): values of a pair's child that the parent also holds."""
    # No more parents than columns for a child.  A set meets only the children in it, and of their parents those in it.
    by_child = pairs.groupBy("CHILD_ID").agg(F.collect_set("PARENT_ID").alias("PARENTS"))
    met = sets.where("size(IDS) > 1").select("IDS", "N", F.explode("IDS").alias("CHILD_ID")).join(by_child, "CHILD_ID")
    return (
        met.select("CHILD_ID", F.explode(F.array_intersect("PARENTS", "IDS")).alias("PARENT_ID"), "N")
        .groupBy("PARENT_ID", "CHILD_ID").agg(F.sum("N").alias("MATCH_COUNT"))
    )


def least_rate(min_label: str) -> float:
    """The match rate from which on a pair has at least this label."""
    floors = {label: floor for floor, label, _ in CONFIDENCE_BANDS}
    if min_label not in LABEL_ORDER:
        raise ValueError(f"unknown label: {min_label}")
    return floors.get(min_label, 0.0)


def still_possible(pairs: DataFrame, found: DataFrame, seen: DataFrame, totals: DataFrame, rate: float) -> DataFrame:
    """Pairs that can still reach the rate when `found` matches of `seen` child values, of `totals` in all, are known."""
    known = (
        pairs.join(found, ["PARENT_ID", "CHILD_ID"], "left")
        .join(seen.select(F.col("ID").alias("CHILD_ID"), F.col("VALUES").alias("SEEN")), "CHILD_ID", "left")
        .join(totals.select(F.col("ID").alias("CHILD_ID"), F.col("VALUES").alias("TOTAL")), "CHILD_ID", "left")
    )
    missed = F.coalesce("SEEN", F.lit(0)) - F.coalesce("MATCH_COUNT", F.lit(0))
    best = ratio(F.coalesce("TOTAL", F.lit(0)) - missed, F.coalesce("TOTAL", F.lit(0)))
    return known.where(best >= rate).select(*pairs.columns)


def overlap_of(pairs: DataFrame, found: DataFrame, totals: DataFrame, min_label: str) -> DataFrame:
    """Overlap rows from the matches of pairs (with their ids) and the distinct values of each column."""
    zero = F.lit(0).cast("long")
    children = totals.select(F.col("ID").alias("CHILD_ID"), F.col("VALUES").alias("CHILD_NON_NULL_COUNT"))
    carried = [n for n in ("SOURCE_SYSTEM", "PROFILE_RUN_ID") if n in pairs.columns]
    counted = pairs.join(children, "CHILD_ID", "left").join(found, ["PARENT_ID", "CHILD_ID"], "left").select(
        *carried, *PAIR_KEY, F.coalesce("MATCH_COUNT", zero).alias("MATCH_COUNT"),
        F.coalesce("CHILD_NON_NULL_COUNT", zero).alias("CHILD_NON_NULL_COUNT"),
    )
    return labelled_overlap(counted, min_label)


def distinct_values(rows: DataFrame) -> DataFrame:
    """(ID, VALUES): distinct filled values of each column."""
    return rows.where("V IS NOT NULL").groupBy("ID").agg(F.count(F.lit(1)).alias("VALUES"))


def values_of_sets(sets: DataFrame) -> DataFrame:
    """(ID, VALUES) of the rows that `column_sets` was made from."""
    return sets.select(F.explode("IDS").alias("ID"), "N").groupBy("ID").agg(F.sum("N").alias("VALUES"))


def key_rows(rows: DataFrame) -> DataFrame:
    """(ID, K, N): rows of each normalised key; values that differ in blanks only have one key."""
    return rows.where("K IS NOT NULL").groupBy("ID", "K").agg(F.sum("N").alias("N"))


def key_counts(rows: DataFrame) -> DataFrame:
    """(ID, DISTINCT_KEYS, DUPLICATE_KEYS): of rows (ID, N), one for each normalised key of a column."""
    return rows.groupBy("ID").agg(
        F.count(F.lit(1)).alias("DISTINCT_KEYS"), F.count_if(F.col("N") > 1).alias("DUPLICATE_KEYS")
    )


def is_own_key(dtype: str) -> bool:
    """Whether different values of a type have different keys; texts may differ in blanks, and a zone may print two instants alike."""
    return dtype in INTEGRAL | FRACTIONAL | {"date", "timestamp_ntz", "boolean"} or dtype.startswith("decimal")


def joined_keys(parent: DataFrame, child: DataFrame) -> DataFrame:
    """(K, JOINED_ROW_COUNT) of the keys (K, N) that both sides have."""
    return parent.join(child.withColumnRenamed("N", "M"), "K").select("K", (F.col("N") * F.col("M")).alias("JOINED_ROW_COUNT"))


def joined_delta(
    parent: DataFrame, parent_delta: DataFrame, child: DataFrame, child_delta: DataFrame
) -> DataFrame:
    """(K, JOINED_ROW_COUNT): what deltas (K, N) of both sides add to the joined rows of each key.

    The product of counts grows by old x new + new x old + new x new, so only keys of a delta are looked up in the
    other side, and only these are in the result.
    """
    terms = [joined_keys(parent, child_delta), joined_keys(parent_delta, child), joined_keys(parent_delta, child_delta)]
    return union_all(terms).groupBy("K").agg(F.sum("JOINED_ROW_COUNT").alias("JOINED_ROW_COUNT"))


def with_ids(frame: DataFrame, columns: DataFrame, sides: Mapping[str, str]) -> DataFrame:
    """Pairs or edges with the ids of their columns; `sides` maps the prefix of a side to the name of its id.

    Rows with a column that is not indexed are gone.
    """
    for side, name in sides.items():
        known = columns.select(
            F.col("TARGET_TABLE").alias(f"{side}_TABLE"), F.col("TARGET_COLUMN").alias(f"{side}_COLUMN"), F.col("ID").alias(name)
        )
        frame = frame.join(known, [f"{side}_TABLE", f"{side}_COLUMN"])
    return frame

