"""The registered queries of this subpackage, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.llm import (
    alignment, context_tree, decontaminate, filter_audit, language, licences, mixing, near_duplicates, neighbours, quality, simhash,
    token_counts, token_store,
)
from tablescout.llm.common import fold, scratch, table

TOKENIZERS = None  # a folder of vocabulary files; by default the installed package of public ones


def tokenizer(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_documents(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"), licences.builtin_licences(spark))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    dictionaries = language.fit_dictionaries(documents.where(fold(F.col("doc_id"), 4) != 2))
    found = language.identify(documents, dictionaries)
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"))
    return token_store.read_store(spark, path)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return alignment.align_tokenizers(documents, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.document_failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit_orders(counts, filter_audit.FILTERS)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3)


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_near_duplicates, op3_context_tree, op4_nearest_neighbours, op5_licence_scan, op6_language_id,
        op7_decontamination, op8_token_store, op9_quality, op10_mixing, op11_token_alignment, op12_filter_audit, op13_simhash,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""

_NEIGHBOURS = """
WITH ready AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) AS n
  FROM embeddings WHERE list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) / (sqrt(q.n) * sqrt(c.n)) AS score
  FROM ready q JOIN ready c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
WHERE rank <= 5"""


def _licence_sql() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def normalised(column: str) -> str:
        out = f"regexp_replace({_LOWER.format(column)}, {text(licences.COPYRIGHT_LINE)}, '\\1', 'g')"
        for one, other in licences.SPELLINGS:
            out = f"replace({out}, {text(one)}, {text(other)})"
        out = f"regexp_replace({out}, {text(licences.PUNCTUATION)}, ' ', 'g')"
        out = f"regexp_replace({out}, {text(r' ?\n[\n ]*')}, chr(10), 'g')"
        return f"regexp_replace({out}, {text(r'^[\n ]+|[\n ]+\z')}, '', 'g')"

    known = ", ".join(f"({text(i)}, {text(t)})" for i, t in licences.KNOWN)
    return f"""
WITH known AS (
  SELECT sha256(replace({normalised("t")}, chr(10), ' ')) AS digest, min(i) AS license_id
  FROM (VALUES {known}) AS k(i, t) GROUP BY 1),
rows AS (SELECT doc_id, {normalised("text")} AS lines FROM documents),
notices AS (
  SELECT doc_id, list_sort(list(DISTINCT license_id)) AS notices
  FROM (SELECT doc_id, unnest(string_split(lines, chr(10))) AS line FROM rows) l
  JOIN known ON sha256(line) = digest WHERE line <> '' GROUP BY doc_id)
SELECT r.doc_id, sha256(replace(lines, chr(10), ' ')) AS text_sha256, license_id, coalesce(notices, []) AS notices
FROM rows r LEFT JOIN known ON sha256(replace(lines, chr(10), ' ')) = digest LEFT JOIN notices n ON n.doc_id = r.doc_id"""


_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_DECONTAMINATION = f"""
WITH items AS (
  SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id::VARCHAR AS item_id, least(len(w), 10) AS size, w[i : i + least(len(w), 10) - 1] AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS i FROM items)),
docs AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
places AS (
  SELECT doc_id, size, i, w[i : i + size - 1] AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows))),
hits AS (SELECT doc_id, p.size, i, item_id FROM places p JOIN windows v ON v.size = p.size AND v.gram = p.gram),
words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY 1),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
  FROM hits GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)"""

_FILTER_AUDIT = """
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents),
marked AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN r.doc_id > least THEN 'E' ELSE '' END AS fails
  FROM rows r LEFT JOIN marked m ON m.doc_id = r.doc_id),
counts AS (SELECT part, fails, good, toxic, count(*) AS n FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, step::INTEGER AS step, filter_order[step] AS f, filter_order[: step - 1] AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders)),
met AS (
  SELECT *, contains(fails, f) AS hit, translate(fails, earlier, '') <> fails AS gone FROM steps, counts),
summed AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM summed"""

ORACLES = {
    "op12_filter_audit": _FILTER_AUDIT,
    "op2_near_duplicates": _NEAR_DUPLICATES,
    "op4_nearest_neighbours": _NEIGHBOURS,
    "op5_licence_scan": _licence_sql(),
    "op7_decontamination": _DECONTAMINATION,
}
