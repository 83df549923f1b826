"""Scoring, labelling and decision rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name patterns, thresholds, scores and texts of the key rules.
KEY_NAME_ENDINGS = ["ID", "NUMBER", "CODE", "KEY"]
BUSINESS_KEY_NAMES = ["CUSTOMER", "CUSTOMERID", "JOBNUMBER", "ORDERNUMBER", "INVOICENUMBER"]
GENERIC_ID_NAMES = ["ID", "ROWID"]
UNIQUE_RATIO = 0.999
MOSTLY_FILLED_RATIO = 0.95
KEY_RULES = {
    "PRIMARY_KEY": (0.80, "unique, non-null, and naming pattern indicates primary key"),
    "UNIQUE_ATTRIBUTE": (0.60, "unique attribute but not likely primary key"),
    "FOREIGN_KEY": (0.45, "column name looks like an ID/reference"),
    "BUSINESS_KEY": (0.55, "column name looks like a business key"),
}
GENERIC_ID_RULE = (0.15, "generic ID-style column")
MOSTLY_FILLED_RULE = (0.10, "mostly non-null")

# Match rate floor, label, score.
CONFIDENCE_BANDS = [(0.98, "HIGH", 0.95), (0.90, "MEDIUM", 0.80), (0.70, "LOW", 0.60)]
WEAK_BAND = ("WEAK", 0.30)
LABEL_ORDER = ["HIGH", "MEDIUM", "LOW", "WEAK"]
USABLE_LABELS = ["HIGH", "MEDIUM"]

# Cardinality reasons and the texts of view decisions.
CARDINALITY_REASONS = {
    "1:1": "both sides have unique join keys",
    "1:N": "parent side is unique; child side has repeated join keys",
    "N:1": "parent side has repeated join keys; child side is unique",
    "N:M": "both sides have repeated join keys",
}
LOW_CONFIDENCE = "confidence below generation threshold"
NEEDS_BRIDGE = "N:M relationship requires bridge/manual modeling"
SAFE = "safe to generate"
UNSAFE_FLAT = "N:M relationship is unsafe for flat joined view"
UNKNOWN_CARDINALITY = "unknown cardinality"


def chain(cases: list[tuple[Column, object]], default: object = None) -> Column:
    result = None
    for condition, value in cases:
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result if default is None else result.otherwise(default)


def key_candidate(name: Column, rows: Column, distinct_ratio: Column, filled_ratio: Column) -> Column:
    """struct(CANDIDATE_TYPE, CONFIDENCE_SCORE, REASON) of a profiled column; type NULL = no candidate."""
    upper = F.upper(name)
    distinct = F.coalesce(distinct_ratio, F.lit(0.0))
    filled = F.coalesce(filled_ratio, F.lit(0.0))
    unique = (distinct >= UNIQUE_RATIO) & (filled >= UNIQUE_RATIO)
    key_name = upper.rlike(f"({'|'.join(KEY_NAME_ENDINGS)})$")
    kind = F.when(
        rows > 0,
        chain(
            [
                (unique & key_name, "PRIMARY_KEY"),
                (unique, "UNIQUE_ATTRIBUTE"),
                (upper.endswith("ID"), "FOREIGN_KEY"),
                (upper.isin(BUSINESS_KEY_NAMES) | upper.endswith("NUMBER"), "BUSINESS_KEY"),
            ]
        ),
    )
    base = chain([(kind == k, F.lit(score)) for k, (score, _) in KEY_RULES.items()])
    reason = chain([(kind == k, F.lit(text)) for k, (_, text) in KEY_RULES.items()])
    generic = upper.isin(GENERIC_ID_NAMES)
    mostly = filled >= MOSTLY_FILLED_RATIO
    score = (
        base
        + F.when(generic, GENERIC_ID_RULE[0]).otherwise(0.0)
        + F.when(mostly, MOSTLY_FILLED_RULE[0]).otherwise(0.0)
    )
    return F.struct(
        kind.alias("CANDIDATE_TYPE"),
        F.least(score, F.lit(1.0)).alias("CONFIDENCE_SCORE"),
        F.concat_ws(
            "; ", reason, F.when(generic, GENERIC_ID_RULE[1]), F.when(mostly, MOSTLY_FILLED_RULE[1])
        ).alias("REASON"),
    )


def confidence_label(rate: Column) -> Column:
    return chain([(rate >= floor, label) for floor, label, _ in CONFIDENCE_BANDS], WEAK_BAND[0])


def confidence_score(rate: Column) -> Column:
    return chain([(rate >= floor, F.lit(score)) for floor, _, score in CONFIDENCE_BANDS], F.lit(WEAK_BAND[1]))


def label_rank(label: Column) -> Column:
    """Position of a label, best first."""
    return chain([(label == name, F.lit(rank)) for rank, name in enumerate(LABEL_ORDER)], F.lit(len(LABEL_ORDER)))


def cardinality_type(parent_duplicates: Column, child_duplicates: Column) -> Column:
    return F.concat(
        F.when(parent_duplicates > 0, "N").otherwise("1"),
        F.lit(":"),
        F.when(child_duplicates == 0, "1")
        .when(parent_duplicates > 0, "M")
        .otherwise("N"),
    )


def cardinality_reason(kind: Column) -> Column:
    return chain([(kind == name, text) for name, text in CARDINALITY_REASONS.items()])


def view_decision(label: Column, cardinality: Column, mode: str) -> Column:
    """struct(generate, reason) for a joined view; ``cardinality`` may be NULL = unknown."""
    if mode not in ("flat", "object"):
        raise ValueError(f"unknown view mode: {mode}")
    known = F.coalesce(cardinality, F.lit("UNKNOWN"))
    refusals = [
        (~F.coalesce(label.isin(USABLE_LABELS), F.lit(False)), F.lit(LOW_CONFIDENCE)),
        (known == "N:M", F.lit(NEEDS_BRIDGE)),
    ]
    if mode == "flat":
        refusals.append((known != "1:1", F.concat(known, F.lit(" is not safe for flat view"))))
    reason = chain(refusals, F.lit(SAFE))
    return F.struct((reason == SAFE).alias("generate"), reason.alias("reason"))


def link_views_allowed(label: Column, cardinality: Column) -> Column:
    """Whether bridge and summary views are generated."""
    return F.coalesce(label.isin(USABLE_LABELS) & (cardinality == "N:M"), F.lit(False))


def counts_match(strategy: Column, source: Column, loaded: Column, target: Column) -> Column:
    return F.when(strategy == "full_refresh", (source == loaded) & (loaded == target)).otherwise(loaded >= 0)


def counts_text(strategy: Column, source: Column, loaded: Column, target: Column) -> Column:
    full = F.format_string("source=%d; loaded=%d; target=%d", source, loaded, target)
    delta = F.format_string("source_total=%d; incremental_loaded=%d; target_after_merge=%d", source, loaded, target)
    return F.when(strategy == "full_refresh", full).otherwise(delta)


def load_status(mode: Column, strategy: Column, merged: Column, source: Column) -> Column:
    planned = (mode == "incremental_plan") & (strategy != "full_refresh")
    return chain([(planned, "PLANNED"), (merged, "MERGED"), (source > 0, "LOADED")], "EMPTY")


def run_status(failed: Column) -> Column:
    return F.when(failed > 0, "PARTIAL_SUCCESS").otherwise("SUCCESS")
