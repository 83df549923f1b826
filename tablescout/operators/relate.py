"""Candidate column pairs, and how far the child's values are found in the parent."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from ahocorasick import Automaton
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.functions.names import name_base
from tablescout.functions.rules import LABEL_ORDER, confidence_label, confidence_score, label_rank
from tablescout.functions.values import common_domain, in_domain, is_nested, ratio
from tablescout.local import catalog_rows, local_frame
from tablescout.operators.cells import Cell, digested, has_column, union_all, unpivoted

# Fixed values.
PARENT_TYPES = ["PRIMARY_KEY", "BUSINESS_KEY", "UNIQUE_ATTRIBUTE"]
CHILD_TYPES = ["BUSINESS_KEY", "FOREIGN_KEY"]
DISCOVERY_METHOD = "candidate_key_value_overlap"

PAIR_KEY = ["PARENT_TABLE", "PARENT_COLUMN", "CHILD_TABLE", "CHILD_COLUMN"]

# Bytes of names in one automaton, and columns of one name from which on it is a hub.
NAME_BYTES = 1 << 24
HUB = 1000
_CONTAINED = pa.schema([("OUTER_NAME", pa.string()), ("INNER_NAME", pa.string())])

# Bits used per mask word; the sign bit is left alone.
WORD_BITS = 63

_KINDS = T.StructType([T.StructField(n, T.StringType()) for n in ("T", "N", "KIND")])
_IDS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("DOMAIN", "T", "N")] + [T.StructField("ID", T.IntegerType())]
)


def contained_names(spark: SparkSession, names: Sequence[str], name_bytes: int = NAME_BYTES) -> DataFrame:
    """(OUTER_NAME, INNER_NAME): every name with each of the names that are a part of it, itself among them.

    Each distinct name is read once, by an automaton of all names (Aho and Corasick), or of parts of `name_bytes` of
    them where they are more; no substring is made that is not a name.
    """
    parts: list[list[str]] = [[]]
    size = 0
    for name in sorted(names):
        if parts[-1] and size + len(name) > name_bytes:
            parts.append([])
            size = 0
        parts[-1].append(name)
        size += len(name)
    outer = local_frame(spark, [{"OUTER_NAME": n} for n in sorted(names)], T.StructType([T.StructField("OUTER_NAME", T.StringType())]))

    def found_in(part: list[str]) -> DataFrame:
        shared = spark.sparkContext.broadcast(part)

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = Automaton()
            for name in shared.value:
                automaton.add_word(name, name)
            automaton.make_automaton()
            for batch in batches:
                pairs = [(name, inner) for name in batch.column(0).to_pylist() for inner in {i for _, i in automaton.iter(name)}]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*pairs)] or [[], []], schema=_CONTAINED)

        return outer.repartition("OUTER_NAME").mapInArrow(found, "OUTER_NAME string, INNER_NAME string")

    return union_all(found_in(part) for part in parts)


def _with_columns(pairs: DataFrame, columns: DataFrame, name: str, on: Sequence[str], hubs: DataFrame) -> DataFrame:
    """Pairs of names joined with the columns of one of the names; columns of a hub are spread over its salts."""
    salted = columns.join(hubs, name, "left").withColumn(
        "SALT", F.pmod(F.xxhash64(*columns.columns), F.coalesce("SALTS", F.lit(1))).cast("int")
    )
    spread = pairs.join(hubs, name, "left").withColumn("SALT", F.explode(F.sequence(F.lit(0), F.coalesce("SALTS", F.lit(1)) - 1)))
    return spread.drop("SALTS").join(salted.drop("SALTS"), [*on, name, "SALT"]).drop("SALT")


def candidate_pairs(candidates: DataFrame, hub: int = HUB) -> DataFrame:
    """Parent and child columns of different tables with compatible names.

    Distinct names are paired first, by one reading of each and by an equi-join on base names; then names become
    columns.  A name of more than `hub` columns is spread over several partitions in that step.  So the work grows
    with the names, and with the pairs that are found.
    """
    spark = candidates.sparkSession
    keep = [n for n in ("SOURCE_SYSTEM", "PROFILE_RUN_ID") if n in candidates.columns]
    system = [n for n in keep if n == "SOURCE_SYSTEM"]

    def side(types: list[str], prefix: str, carried: list[str]) -> DataFrame:
        return candidates.where(F.col("CANDIDATE_TYPE").isin(types)).select(
            *carried,
            F.col("TARGET_TABLE").alias(f"{prefix}_TABLE"),
            F.col("TARGET_COLUMN").alias(f"{prefix}_COLUMN"),
            F.upper("TARGET_COLUMN").alias(f"{prefix}_NAME"),
        )

    parents, children = side(PARENT_TYPES, "PARENT", keep), side(CHILD_TYPES, "CHILD", system)
    # a row for each name of a side comes to the driver
    counted = union_all(
        side_.groupBy(F.col(f"{prefix}_NAME").alias("NAME")).agg(F.count(F.lit(1)).alias("N")).withColumn("SIDE", F.lit(prefix))
        for side_, prefix in ((parents, "PARENT"), (children, "CHILD"))
    )
    names = catalog_rows(counted)
    of_side = {p: {r.NAME: r.N for r in names if r.SIDE == p and r.NAME is not None} for p in ("PARENT", "CHILD")}
    known = {p: local_frame(spark, [{f"{p}_NAME": n} for n in sorted(found)], T.StructType([T.StructField(f"{p}_NAME", T.StringType())]))
             for p, found in of_side.items()}
    inside = contained_names(spark, of_side["PARENT"].keys() | of_side["CHILD"].keys())
    based = {p: known[p].withColumn("BASE", F.nullif(name_base(F.col(f"{p}_NAME")), F.lit(""))) for p in known}
    matches = [
        inside.toDF("CHILD_NAME", "PARENT_NAME"), inside.toDF("PARENT_NAME", "CHILD_NAME").select("CHILD_NAME", "PARENT_NAME"),
        based["CHILD"].join(based["PARENT"], "BASE").select("CHILD_NAME", "PARENT_NAME"),
    ]
    pairs = union_all(matches).join(known["PARENT"], "PARENT_NAME", "left_semi").join(known["CHILD"], "CHILD_NAME", "left_semi").distinct()
    hubs = {
        p: local_frame(spark, [{f"{p}_NAME": n, "SALTS": -(-c // hub)} for n, c in sorted(found.items()) if c > hub],
                       T.StructType([T.StructField(f"{p}_NAME", T.StringType()), T.StructField("SALTS", T.LongType())]))
        for p, found in of_side.items()
    }
    with_parents = _with_columns(pairs, parents, "PARENT_NAME", [], hubs["PARENT"])
    found = _with_columns(with_parents, children, "CHILD_NAME", system, hubs["CHILD"])
    return found.where("PARENT_TABLE <> CHILD_TABLE").select(*keep, *PAIR_KEY).distinct()


def _word(column_id: Column) -> Column:
    return F.floor(column_id / WORD_BITS).cast("int")


def _has(column_id: Column) -> Column:
    """Whether the column with this id is in the mask."""
    word = F.element_at(F.col("WORDS"), _word(column_id) + 1)
    return F.getbit(word, F.pmod(column_id, F.lit(WORD_BITS)).cast("int")) == 1


def _mask(words: int) -> list[str]:
    """Mask words of a cell: the bit of its column id, in its word."""
    bit = f"shiftleft(1L, C % {WORD_BITS})"
    return [
        f"CASE WHEN C div {WORD_BITS} = {word} THEN {bit} ELSE 0L END AS W{word}"
        for word in range(words)
    ]


def _signatures(frames: Mapping[str, DataFrame], domain: str, cells: list[Cell]) -> DataFrame:
    """(WORDS, N): for every set of columns, how many values occur in exactly those columns.

    One shuffle by value, combined map-side, whatever the number of pairs: a value ends as one
    mask of the columns holding it, and only counts per mask go further.
    """
    words = -(-len(cells) // WORD_BITS)
    rows = unpivoted(frames, cells).where(F.col("V").isNotNull())
    if domain == "string":
        rows, key = digested(rows), ["HASHED", "K"]
    else:
        key = ["V"]
    names = [f"W{word}" for word in range(words)]
    per_value = rows.selectExpr(*key, *_mask(words)).groupBy(*key).agg(*[F.bit_or(n).alias(n) for n in names])
    return per_value.groupBy(*names).agg(F.count(F.lit(1)).alias("N")).select(F.array(*names).alias("WORDS"), "N")


def _readable(frames: Mapping[str, DataFrame], pairs: DataFrame) -> list[tuple[str, str]]:
    """The distinct columns of pairs that can be read."""
    sides = union_all(
        pairs.select(F.col(f"{side}_TABLE").alias("T"), F.col(f"{side}_COLUMN").alias("N")) for side in ("PARENT", "CHILD")
    )
    return [(r.T, r.N) for r in sorted(catalog_rows(sides.distinct()), key=str) if has_column(frames, r.T, r.N)]


def _kind(dtype: str) -> str:
    """Columns of one kind are compared typed; nested ones have none and are compared as text."""
    return "" if is_nested(dtype) else common_domain(dtype, dtype)


def _named(pairs: DataFrame, columns: DataFrame, what: str, side: str) -> DataFrame:
    """Pairs with what is known of the column on one side; pairs of other columns go."""
    names = {"T": f"{side}_TABLE", "N": f"{side}_COLUMN", what: f"{side}_{what}"}
    mine = columns.withColumnsRenamed(names)
    return pairs.join(mine, [c for c in mine.columns if c != f"{side}_{what}"])


def value_overlap(
    spark: SparkSession, frames: Mapping[str, DataFrame], pairs: DataFrame, min_label: str = "WEAK"
) -> DataFrame:
    """Match rate, score and label of every pair: distinct non-NULL child values found in the parent.

    Values compare as text; columns of one kind are compared typed, which is the same and cheaper.
    """
    dtypes = {table: dict(frame.dtypes) for table, frame in frames.items()}
    columns = _readable(frames, pairs)
    kinds = local_frame(spark, [{"T": t, "N": c, "KIND": _kind(dtypes[t][c])} for t, c in columns], _KINDS)
    same = (F.col("PARENT_KIND") == F.col("CHILD_KIND")) & (F.col("PARENT_KIND") != "")
    placed = _named(_named(pairs, kinds, "KIND", "PARENT"), kinds, "KIND", "CHILD").withColumn(
        "DOMAIN", F.when(same, F.col("PARENT_KIND")).otherwise("string")
    )
    # Columns by the domain they are compared in come to the driver, pairs do not.
    used = union_all(
        placed.select("DOMAIN", F.col(f"{side}_TABLE").alias("T"), F.col(f"{side}_COLUMN").alias("N"),
                      F.lit(side == "CHILD").alias("CHILD"))
        for side in ("PARENT", "CHILD")
    )
    used = used.groupBy("DOMAIN", "T", "N").agg(F.max("CHILD").alias("CHILD"))
    ids: dict[str, list] = {}
    for row in sorted(catalog_rows(used), key=lambda r: (r.DOMAIN, r.T, r.N)):
        ids.setdefault(row.DOMAIN, []).append(row)
    numbered = local_frame(
        spark,
        [{"DOMAIN": d, "T": r.T, "N": r.N, "ID": i} for d, known in ids.items() for i, r in enumerate(known)],
        _IDS,
    )
    identified = _named(_named(placed, numbered, "ID", "PARENT"), numbered, "ID", "CHILD")

    compared = identified.select("DOMAIN", "PARENT_ID", "CHILD_ID").distinct()
    counted = []
    for domain, known in ids.items():
        cells = [Cell(str(i), r.T, in_domain(r.N, dtypes[r.T][r.N], domain)) for i, r in enumerate(known)]
        children = [i for i, r in enumerate(known) if r.CHILD]
        present = F.filter(F.array(*[F.lit(i) for i in children]), _has)
        counted.append(
            _signatures(frames, domain, cells)
            .withColumn("CHILD_ID", F.explode(present))
            .join(compared.where(F.col("DOMAIN") == domain), "CHILD_ID")
            .groupBy("DOMAIN", "PARENT_ID", "CHILD_ID")
            .agg(
                F.sum("N").alias("CHILD_NON_NULL_COUNT"),
                F.sum(F.when(_has(F.col("PARENT_ID")), F.col("N")).otherwise(F.lit(0).cast("long"))).alias("MATCH_COUNT"),
            )
        )
    carried = [n for n in ("SOURCE_SYSTEM", "PROFILE_RUN_ID") if n in pairs.columns]
    if counted:
        result = identified.join(union_all(counted), ["DOMAIN", "PARENT_ID", "CHILD_ID"], "left")
    else:
        result = identified.withColumns({n: F.lit(0) for n in ("CHILD_NON_NULL_COUNT", "MATCH_COUNT")})
    zero = F.lit(0).cast("long")
    result = result.select(
        *carried,
        *PAIR_KEY,
        F.coalesce("MATCH_COUNT", zero).alias("MATCH_COUNT"),
        F.coalesce("CHILD_NON_NULL_COUNT", zero).alias("CHILD_NON_NULL_COUNT"),
    )
    return labelled_overlap(result, min_label)


def labelled_overlap(counted: DataFrame, min_label: str = "WEAK") -> DataFrame:
    """Pairs with their counts, rated, scored and labelled; those below the least label go."""
    rate = F.col("MATCH_RATE")
    labelled = counted.withColumn("MATCH_RATE", ratio(F.col("MATCH_COUNT"), F.col("CHILD_NON_NULL_COUNT"))).withColumns(
        {
            "CONFIDENCE_SCORE": confidence_score(rate),
            "CONFIDENCE_LABEL": confidence_label(rate),
            "DISCOVERY_METHOD": F.lit(DISCOVERY_METHOD),
        }
    )
    return labelled.where(label_rank(F.col("CONFIDENCE_LABEL")) <= LABEL_ORDER.index(min_label))
