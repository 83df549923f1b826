"""Licence texts by canonical digest.

A text is normalised - case, copyright lines, equivalent spellings, punctuation, white space - and the SHA-256
of all of it is joined to the digests of known licences.  The same goes for each line of a text, since a
notice is an entire text in one line; both are done by one pass.  Only DataFrame functions are used.
"""

from __future__ import annotations

import json
import pkgutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablescout.llm.common import ascii_lower
from tablescout.local import local_frame

# fixed values: licence identifiers with the one-line notices that stand for them; whole texts are in TEXTS
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("ISC", "Licensed under the ISC License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
]

# fixed values: spellings that the matching guidelines of licence lists hold equal, after lower case
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sub-license", "sublicense"),
    ("sub license", "sublicense"),
    ("copyright holder", "copyright owner"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("merchantibility", "merchantability"),
    ("non-commercial", "noncommercial"),
    ("per cent", "percent"),
    ("whilst", "while"),
]

#: Rows (license_id, source, titles, text): canonical texts, the titles that may stand before them, where they are from.
TEXTS = "licence_texts.jsonl"
RESERVED = "All rights reserved."

COPYRIGHT_LINE = r"(^|\n)[ \t\x0B\f\r]*(copyright|\(c\)|©)[ \t\x0B\f\r]+(\(c\)|©|[0-9]|\[|<)[^\n]*"
# fixed values: what follows "copyright" or "(c)" where a clause of a licence happens to be wrapped before it
_CLAUSE = (
    r"(and|also|are|if|in|is|of|on|or|doctrines?|disclaimers?|holders?|interests?|laws?|licen[sc]es?|lines?|notices?|owners?|"
    r"ownership|permission|protection|resulting|statements?|treat(y|ies)|the[ \t]*(?=\n)|the[ \t]+(software|library|program|work))(?![a-z0-9])"
)
_ITEM = r"(any|each|if|representations|under|you|the[ \t]+licenses[ \t]+granted)\b"
#: Lines that name an owner in any other way: "copyright Acme", "copyright: Acme", "(c) Acme", a sign and whatever follows.
OWNER_LINE = (
    r"(^|\n)[ \t\x0B\f\r]*((copyright[ \t]*(:[ \t]*|[ \t]))?(©|\(c\)[ \t]*(?!" + _ITEM + r")[^ \t\n])|copyright(©|\(c\))|"
    r"copyright[ \t]*(:[ \t]*|[ \t])[ \t]*(?!" + _CLAUSE + r")[a-z0-9\x80-\x{10FFFF}\"'<\[{])[^\n]*"
)
# fixed values: clauses of the BSD, ISC and MIT texts that name an owner - what stands before and after the name, and
# what matching guidelines put in its place
OWNER_CLAUSES = [
    ("neither the name ", " nor the names of its contributors", "of the copyright owner"),
    ("this software is provided by ", " as is and", "the copyright owners and contributors"),
    ("as is and ", " disclaim all warranties", "the author"),
    ("in no event shall ", " be liable", "the author"),
]
# fixed values: wordings of these clauses that depend on the number of owners
CLAUSE_SPELLINGS = [
    ("neither the names ", "neither the name "),
    (" nor the names of their contributors", " nor the names of its contributors"),
    (" nor the names of the contributors", " nor the names of its contributors"),
    (" disclaims all warranties", " disclaim all warranties"),
]
PUNCTUATION = r"[!-/:-@\[-`{-~\x00-\x09\x0B-\x1F\x7F ]+"


def normalised(frame: DataFrame, column: str) -> DataFrame:
    """The frame with a column of text turned into lines of words, parted by new lines: lower case, no copyright
    lines, one spelling, no punctuation, one blank between words.  Letters beyond ASCII are kept as they are."""

    def step(out: Column) -> None:
        nonlocal frame
        frame = frame.withColumn(column, out)

    text = F.col(column)
    step(ascii_lower(text))
    owned = text.contains("copyright") | text.contains("(c)") | text.contains("©")
    step(F.when(owned, F.regexp_replace(F.regexp_replace(text, COPYRIGHT_LINE, "$1"), OWNER_LINE, "$1")).otherwise(text))
    out = text
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    out = F.regexp_replace(out, PUNCTUATION, " ")
    out = F.regexp_replace(out, r" ?\n[\n ]*", "\n")
    step(F.regexp_replace(out, r"^[\n ]+|[\n ]+\z", ""))
    return frame


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _named_alike(text: Column, before: str, after: str, usual: str) -> Column:
    """The usual owner wherever one is named: what follows `before` up to the next `after`, unless `before` stands
    between them."""
    parts = F.split(text, r"\b" + before)

    def mended(part: Column) -> Column:
        at = F.instr(part, after)
        return F.when(at > 1, F.concat(F.lit(usual), F.substr(part, at))).otherwise(part)

    rest = F.transform(F.slice(parts, 2, F.size(parts)), mended)
    return F.array_join(F.concat(F.slice(parts, 1, 1), rest), before)


def _whole(frame: DataFrame, column: str) -> DataFrame:
    """The frame with all lines of a column of normalised text in one; spellings of two words that were on two lines,
    and owners named in clauses, as in the known texts."""
    text = F.col(column)
    out = F.replace(text, F.lit("\n"), F.lit(" "))
    for one, other in SPELLINGS:
        if " " in one:
            out = F.replace(out, F.lit(one), F.lit(other))
    frame = frame.withColumn(column, out)
    for before, after, usual in OWNER_CLAUSES:
        spelled = text
        for one, other in CLAUSE_SPELLINGS:
            if other in (before, after):
                spelled = F.replace(spelled, F.lit(one), F.lit(other))
        # most texts have no such clause: two searches instead of the rest
        start, end = (c.split()[:3] for c in (before, after))
        found = text.contains(" ".join(start)) & text.contains(" ".join(end[:1]))
        frame = frame.withColumn(column, F.when(found, _named_alike(spelled, before, after, usual)).otherwise(text))
    return frame


def known_digests(known: DataFrame) -> DataFrame:
    """(license_id, digest) from rows (license_id, text); texts without words are no licence."""
    rows = known.where(F.col("license_id").isNotNull() & F.col("text").isNotNull()).select("license_id", F.col("text").alias("piece"))
    rows = _whole(normalised(rows, "piece"), "piece").where("piece <> ''")
    return rows.groupBy(_digest(F.col("piece")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def licence_texts() -> list[tuple[str, str]]:
    """Rows (license_id, text) of TEXTS: each text alone and under its titles, where owners stand also with RESERVED."""
    out = []
    for line in pkgutil.get_data(__package__, TEXTS).decode().splitlines():
        row = json.loads(line)
        for title in ["", *row["titles"]]:
            for rights in ["", RESERVED] if row["titles"] else [""]:
                out.append((row["license_id"], "\n".join([title, rights, row["text"]])))
    return out


def builtin_licences(spark: SparkSession) -> DataFrame:
    """KNOWN and the licence texts as rows (license_id, text)."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in ("license_id", "text")])
    return local_frame(spark, [dict(zip(schema.names, row, strict=True)) for row in KNOWN + licence_texts()], schema)


def scan_licences(documents: DataFrame, known: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, text_sha256 of the normalised text, license_id of the known licence that
    the entire text is (or null), and notices: the licences that one of its lines entirely is, sorted.

    Null texts have a null digest and match nothing; nor does a text without words.  Where known licences
    share a digest, the first by name is given.  Rows that share a doc_id, or have none, each have their own.  An
    empty table gives no rows; other columns are ignored.
    """
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("lines"),
    )
    rows = normalised(rows, "lines")
    # one row for the whole text and one for each of its lines, so a text is normalised once
    lines = F.filter(F.array_distinct(F.split(F.coalesce("lines", F.lit("")), "\n")), lambda x: x != "")
    pieces = F.concat(F.array(F.struct(F.lit(True).alias("entire"), F.col("lines").alias("piece"))),
                      F.transform(lines, lambda x: F.struct(F.lit(False).alias("entire"), x.alias("piece"))))
    digested = _whole(rows.select("row", "doc_id", F.inline(pieces)), "piece").select(
        "row", "doc_id", "entire", _digest(F.col("piece")).alias("digest")
    )
    found = digested.join(known_digests(known), "digest", "left").where("entire OR license_id IS NOT NULL")
    entire = {c: F.max(F.when(F.col("entire"), F.col(c))).alias(name) for c, name in (("digest", "text_sha256"), ("license_id", "license_id"))}
    notices = F.sort_array(F.collect_set(F.when(~F.col("entire"), F.col("license_id"))))
    return found.groupBy("row", "doc_id").agg(*entire.values(), notices.alias("notices")).drop("row")
