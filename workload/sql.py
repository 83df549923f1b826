"""SQL pieces the oracle queries are put together from."""

from __future__ import annotations

from workload.tables import RENAMED, TABLES

# Column types of the given tables where they are not text.
NUMBERS = {
    "int": "r_regionkey n_nationkey n_regionkey c_nationkey s_nationkey p_size l_linenumber",
    "bigint": "c_custkey s_suppkey p_partkey o_orderkey o_custkey l_orderkey l_partkey l_suppkey event_id user_id "
    "doc_id n_chars conv_id turn page_id item_id vec_id",
    "double": "c_acctbal s_acctbal p_retailprice o_totalprice l_quantity l_extendedprice l_discount l_tax value",
    "timestamp_ntz": "o_orderdate l_shipdate ts",
    "array<float>": "embedding",
}
TYPES = {column: kind for kind, columns in NUMBERS.items() for column in columns.split()}
# Column names that occur in several tables with their own types.
TYPES |= {("labels", "quality"): "int", ("labels", "toxic"): "int", ("embeddings", "label"): "int"}


def kind(table: str, column: str) -> str:
    return TYPES.get((table, column)) or TYPES.get(column, "string")


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def union_all(selects) -> str:
    return "\nUNION ALL ".join(selects)


def profile(columns) -> str:
    """Per-column profile of (table name, column name, relation, expression, declared type) items."""
    parts = []
    for table, column, relation, expression, declared in columns:
        ordered = not declared.startswith("array")
        low, high = (
            (f"min(cast({expression} AS VARCHAR))", f"max(cast({expression} AS VARCHAR))")
            if ordered
            else ("cast(NULL AS VARCHAR)", "cast(NULL AS VARCHAR)")
        )
        parts.append(
            f'SELECT {text(table)} AS "TARGET_TABLE", {text(column)} AS "TARGET_COLUMN", {text(declared)} AS '
            f'"DATA_TYPE", count(*) AS "ROW_COUNT", count({expression}) AS "NON_NULL_COUNT", '
            f'count(*) - count({expression}) AS "NULL_COUNT", count(DISTINCT {expression}) AS "DISTINCT_COUNT", '
            f'{low} AS "MIN_VALUE", {high} AS "MAX_VALUE" FROM {relation}'
        )
    return (
        'SELECT "TARGET_TABLE", "TARGET_COLUMN", "DATA_TYPE", "ROW_COUNT", "NON_NULL_COUNT", "NULL_COUNT", '
        '"DISTINCT_COUNT", "MIN_VALUE", "MAX_VALUE", '
        'CASE WHEN "ROW_COUNT" > 0 THEN cast("DISTINCT_COUNT" AS DOUBLE) / cast("ROW_COUNT" AS DOUBLE) '
        'ELSE cast(0 AS DOUBLE) END AS "DISTINCT_RATIO", '
        'CASE WHEN "ROW_COUNT" > 0 THEN cast("NON_NULL_COUNT" AS DOUBLE) / cast("ROW_COUNT" AS DOUBLE) '
        'ELSE cast(0 AS DOUBLE) END AS "NON_NULL_RATIO" '
        f"FROM ({union_all(parts)})"
    )


def renamed_columns():
    for view, (table, names) in RENAMED.items():
        for old, new in zip(TABLES[table], names, strict=True):
            yield view, new, table, old, kind(table, old)


def key_scores(profile_relation: str) -> str:
    """Key candidates of a profile relation."""
    name = 'upper("TARGET_COLUMN")'
    unique = '"DISTINCT_RATIO" >= 0.999 AND "NON_NULL_RATIO" >= 0.999'
    generic = f"{name} IN ('ID', 'ROWID')"
    filled = '"NON_NULL_RATIO" >= 0.95'
    return f"""
SELECT * FROM (
  SELECT *,
    least(
      CASE "CANDIDATE_TYPE" WHEN 'PRIMARY_KEY' THEN cast(0.80 AS DOUBLE) WHEN 'UNIQUE_ATTRIBUTE' THEN cast(0.60 AS DOUBLE)
        WHEN 'FOREIGN_KEY' THEN cast(0.45 AS DOUBLE) WHEN 'BUSINESS_KEY' THEN cast(0.55 AS DOUBLE) END
      + CASE WHEN {generic} THEN cast(0.15 AS DOUBLE) ELSE cast(0 AS DOUBLE) END
      + CASE WHEN {filled} THEN cast(0.10 AS DOUBLE) ELSE cast(0 AS DOUBLE) END, cast(1 AS DOUBLE)) AS "CONFIDENCE_SCORE",
    CASE "CANDIDATE_TYPE"
      WHEN 'PRIMARY_KEY' THEN 'unique, non-null, and naming pattern indicates primary key'
      WHEN 'UNIQUE_ATTRIBUTE' THEN 'unique attribute but not likely primary key'
      WHEN 'FOREIGN_KEY' THEN 'column name looks like an ID/reference'
      WHEN 'BUSINESS_KEY' THEN 'column name looks like a business key' END
    || CASE WHEN {generic} THEN '; generic ID-style column' ELSE '' END
    || CASE WHEN {filled} THEN '; mostly non-null' ELSE '' END AS "REASON"
  FROM (
    SELECT *, CASE
      WHEN "ROW_COUNT" = 0 THEN NULL
      WHEN {unique} AND ({name} LIKE '%ID' OR {name} LIKE '%NUMBER' OR {name} LIKE '%CODE' OR {name} LIKE '%KEY')
        THEN 'PRIMARY_KEY'
      WHEN {unique} THEN 'UNIQUE_ATTRIBUTE'
      WHEN {name} LIKE '%ID' THEN 'FOREIGN_KEY'
      WHEN {name} LIKE '%NUMBER' OR {name} IN ('CUSTOMER','CUSTOMERID','JOBNUMBER','ORDERNUMBER','INVOICENUMBER')
        THEN 'BUSINESS_KEY' END AS "CANDIDATE_TYPE"
    FROM ({profile_relation})
  )
) WHERE "CANDIDATE_TYPE" IS NOT NULL"""


def base_name(name: str) -> str:
    expression = f"upper({name})"
    for part in ("_ID", "ID", "_NUMBER", "NUMBER", "_CODE", "CODE", "_KEY", "KEY"):
        expression = f"replace({expression}, '{part}', '')"
    return expression


def compatible(parent: str, child: str) -> str:
    return (
        f"(contains(upper({child}), upper({parent})) OR contains(upper({parent}), upper({child})) OR "
        f"({base_name(parent)} <> '' AND {base_name(parent)} = {base_name(child)}))"
    )


def pair_query(candidates: str) -> str:
    return (
        'SELECT p."TARGET_TABLE" AS "PARENT_TABLE", p."TARGET_COLUMN" AS "PARENT_COLUMN", '
        'c."TARGET_TABLE" AS "CHILD_TABLE", c."TARGET_COLUMN" AS "CHILD_COLUMN" '
        f"FROM {candidates} p JOIN {candidates} c ON p.\"TARGET_TABLE\" <> c.\"TARGET_TABLE\" "
        f"AND {compatible('p.\"TARGET_COLUMN\"', 'c.\"TARGET_COLUMN\"')} "
        "WHERE p.\"CANDIDATE_TYPE\" IN ('PRIMARY_KEY','BUSINESS_KEY','UNIQUE_ATTRIBUTE') "
        "AND c.\"CANDIDATE_TYPE\" IN ('BUSINESS_KEY','FOREIGN_KEY')"
    )


LABELS = """CASE WHEN "MATCH_RATE" >= 0.98 THEN 'HIGH' WHEN "MATCH_RATE" >= 0.90 THEN 'MEDIUM'
 WHEN "MATCH_RATE" >= 0.70 THEN 'LOW' ELSE 'WEAK' END AS "CONFIDENCE_LABEL",
 cast(CASE WHEN "MATCH_RATE" >= 0.98 THEN 0.95 WHEN "MATCH_RATE" >= 0.90 THEN 0.80
 WHEN "MATCH_RATE" >= 0.70 THEN 0.60 ELSE 0.30 END AS DOUBLE) AS "CONFIDENCE_SCORE",
 'candidate_key_value_overlap' AS "DISCOVERY_METHOD" """

RATE = (
    'CASE WHEN "CHILD_NON_NULL_COUNT" > 0 THEN cast("MATCH_COUNT" AS DOUBLE) / cast("CHILD_NON_NULL_COUNT" AS DOUBLE) '
    'ELSE cast(0 AS DOUBLE) END AS "MATCH_RATE"'
)


def discovery_ctes() -> str:
    """profile → keys → pairs → overlap of the renamed views, over every cell of every column."""
    cells = union_all(
        f"SELECT DISTINCT {text(view)} AS t, {text(new)} AS c, cast({old} AS VARCHAR) AS v FROM {table} "
        f"WHERE {old} IS NOT NULL"
        for view, new, table, old, _ in renamed_columns()
    )
    return f"""
WITH profiled AS MATERIALIZED ({profile(renamed_columns())}),
keyed AS MATERIALIZED ({key_scores("SELECT * FROM profiled")}),
pairs AS MATERIALIZED ({pair_query("keyed")}),
paired AS MATERIALIZED (
  SELECT "PARENT_TABLE" AS t, "PARENT_COLUMN" AS c FROM pairs UNION SELECT "CHILD_TABLE", "CHILD_COLUMN" FROM pairs),
cells AS MATERIALIZED (SELECT * FROM ({cells}) SEMI JOIN paired USING (t, c)),
counted AS MATERIALIZED (
  SELECT pairs.*, count(ch.v) AS "CHILD_NON_NULL_COUNT", count(pa.v) AS "MATCH_COUNT"
  FROM pairs
  LEFT JOIN cells ch ON ch.t = "CHILD_TABLE" AND ch.c = "CHILD_COLUMN"
  LEFT JOIN cells pa ON pa.t = "PARENT_TABLE" AND pa.c = "PARENT_COLUMN" AND pa.v = ch.v
  GROUP BY ALL
),
rated AS (SELECT *, {RATE} FROM counted),
overlap AS (SELECT *, {LABELS} FROM rated)"""


def overlap_of(parent: str, parent_column: str, child: str, child_column: str, names) -> str:
    """Naive overlap of one pair of relations; ``names`` are the four labels to report."""
    labels = ", ".join(
        f"{text(value)} AS \"{name}\""
        for name, value in zip(("PARENT_TABLE", "PARENT_COLUMN", "CHILD_TABLE", "CHILD_COLUMN"), names, strict=True)
    )
    return (
        f'SELECT {labels}, count(c.v) AS "CHILD_NON_NULL_COUNT", count(p.v) AS "MATCH_COUNT" '
        f"FROM (SELECT DISTINCT cast({child_column} AS VARCHAR) AS v FROM {child} WHERE {child_column} IS NOT NULL) c "
        f"LEFT JOIN (SELECT DISTINCT cast({parent_column} AS VARCHAR) AS v FROM {parent} "
        f"WHERE {parent_column} IS NOT NULL) p ON c.v = p.v"
    )


def key(expression: str) -> str:
    return f"nullif(trim(cast({expression} AS VARCHAR)), '')"


def cardinality_of(parent: str, parent_column: str, child: str, child_column: str, names) -> str:
    """Naive cardinality of one pair of relations."""
    labels = ", ".join(
        f"{text(value)} AS \"{name}\""
        for name, value in zip(("FROM_TABLE", "FROM_COLUMN", "TO_TABLE", "TO_COLUMN"), names, strict=True)
    )

    def keys(relation: str, column: str, having: str) -> str:
        k = key(column)
        return (
            f"(SELECT count(*) FROM (SELECT {k} AS k, count(*) AS n FROM {relation} WHERE {k} IS NOT NULL "
            f"GROUP BY 1 {having}))"
        )

    return (
        f"SELECT {labels}, {keys(parent, parent_column, '')} AS \"FROM_DISTINCT_KEYS\", "
        f"{keys(child, child_column, '')} AS \"TO_DISTINCT_KEYS\", "
        f"{keys(parent, parent_column, 'HAVING count(*) > 1')} AS \"FROM_DUPLICATE_KEYS\", "
        f"{keys(child, child_column, 'HAVING count(*) > 1')} AS \"TO_DUPLICATE_KEYS\""
    )


CLASS = """CASE WHEN "FROM_DUPLICATE_KEYS" = 0 AND "TO_DUPLICATE_KEYS" = 0 THEN '1:1'
 WHEN "FROM_DUPLICATE_KEYS" = 0 THEN '1:N' WHEN "TO_DUPLICATE_KEYS" = 0 THEN 'N:1' ELSE 'N:M' END AS "CARDINALITY_TYPE",
 CASE WHEN "FROM_DUPLICATE_KEYS" = 0 AND "TO_DUPLICATE_KEYS" = 0 THEN 'both sides have unique join keys'
 WHEN "FROM_DUPLICATE_KEYS" = 0 THEN 'parent side is unique; child side has repeated join keys'
 WHEN "TO_DUPLICATE_KEYS" = 0 THEN 'parent side has repeated join keys; child side is unique'
 ELSE 'both sides have repeated join keys' END AS "REASON" """

RESERVED = (
    "'START','END','TEXT','DATE','TIME','TIMESTAMP','USER','CURRENT','GROUP','ORDER','BY','SELECT','FROM','WHERE',"
    "'TABLE','COLUMN','VALUE','VALUES','TYPE','LEVEL','COPY'"
)


def clean(name: str) -> str:
    """Identifier cleaning of a SQL text expression."""
    bare = f"trim(regexp_replace(regexp_replace(upper({name}), '[^A-Z0-9_]', '_', 'g'), '_+', '_', 'g'), '_')"
    named = f"CASE WHEN {bare} = '' THEN 'UNNAMED_COL' ELSE {bare} END"
    lettered = f"CASE WHEN regexp_matches({bare}, '^[0-9]') THEN 'COL_' || {bare} ELSE {named} END"
    return f"CASE WHEN ({lettered}) IN ({RESERVED}) THEN ({lettered}) || '_COL' ELSE ({lettered}) END"


def entity(name: str, words, fallback: str) -> str:
    cases = " ".join(f"WHEN contains(upper({name}), '{word}') THEN '{word}'" for word in words)
    return f"CASE {cases} ELSE {fallback} END"


def shown(query: str, *columns: str) -> str:
    """A query with the given columns as text."""
    casts = ", ".join(f'cast("{c}" AS VARCHAR) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({query})"
