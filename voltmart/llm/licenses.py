"""Licence scans by digests of canonical texts, in DataFrame functions only.

A text is made canonical (case, punctuation, copyright lines, equivalent spellings) and digested; digests
of whole documents are hash-joined with those of known licence texts, and digests of single lines that
speak of licences with those of known one-line notices. The known sides have the size of a fixed list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltmart.llm.license_texts import IDENTIFIERS, NOTICES, SPELLINGS, TEXTS

# A line that opens like this names the owner, not the terms.
COPYRIGHT = r"(^|\n)[ \t#*/;-]*(copyright[ \t]*(\(c\)|©|[0-9])|\(c\)[ \t]|©|all rights reserved)[^\n]*"
MARKS = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"  # all of ASCII but lower-case letters and digits
# Every known notice has one of these; lines are picked by them only where no other notices are given.
HINTS = ("licens", "licenc")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """Words of a text in one spelling, set apart by single spaces."""
    out = F.translate(text, UPPER, LOWER)
    out = F.regexp_replace(out, COPYRIGHT, "\n")
    out = F.concat(F.lit(" "), F.regexp_replace(out, MARKS, "  "), F.lit(" "))
    for given, wanted in SPELLINGS:
        # Words have two spaces between them, so that neighbours can be replaced in one pass.
        out = F.replace(out, F.lit(f" {given.replace(' ', '  ')} "), F.lit(f" {wanted} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_texts(spark: SparkSession) -> DataFrame:
    """(license, text) of the whole texts this module knows."""
    return spark.createDataFrame(TEXTS, "license string, text string")


def known_notices(spark: SparkSession) -> DataFrame:
    """(license, text) of one-line notices, SPDX tags among them."""
    tags = [(name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS]
    return spark.createDataFrame(NOTICES + tags, "license string, text string")


def _digests(known: DataFrame) -> DataFrame:
    """One licence per digest: the smallest name, should two texts have one canonical form."""
    return known.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, texts: DataFrame | None = None, notices: DataFrame | None = None) -> DataFrame:
    """(doc_id, text, ...) -> (doc_id, text_digest, license, notices), one row per row of docs.

    license: the licence whose whole text the document is, null if none. notices: the licences named by
    lines that are known notices, distinct, sorted and set apart by commas, empty if none. Null and empty
    texts have the digest of nothing and no licence. Equal rows get equal results. `texts` and `notices`
    are (license, text) tables of a fixed, small size; an empty canonical text is never a licence. Columns
    other than doc_id and text are not looked at.
    """
    spark = docs.sparkSession
    usable = lambda known: _digests(known).where(F.col("digest") != F.sha2(F.lit(""), 256))
    whole = usable(known_texts(spark) if texts is None else texts)
    lines_known = usable(known_notices(spark) if notices is None else notices)
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        # 96 bits that stand for the row: what is found for one of several equal rows holds for all.
        F.xxhash64("doc_id", "text").alias("key"),
        F.hash("doc_id", "text").alias("copy"),
    )
    if notices is None:
        hinted = lambda x: F.lower(x).contains(HINTS[0]) | F.lower(x).contains(HINTS[1])
    else:
        hinted = lambda x: x != ""
    lines = rows.where(hinted(F.col("text"))).select(
        "key", "copy", F.explode(F.filter(F.split("text", "\n"), hinted)).alias("line")
    )
    found = (
        lines.select("key", "copy", digest(F.col("line")).alias("digest"))
        .join(F.broadcast(lines_known), "digest")
        .groupBy("key", "copy")
        .agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"))
    )
    return (
        rows.select("doc_id", "key", "copy", digest(F.col("text")).alias("digest"))
        .join(F.broadcast(whole), "digest", "left")
        .join(found, ["key", "copy"], "left")
        .select(
            "doc_id",
            F.col("digest").alias("text_digest"),
            "license",
            F.coalesce("notices", F.lit("")).alias("notices"),
        )
    )


# ---- the same in DuckDB's SQL --------------------------------------------------------------------


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_digest(text: str) -> str:
    out = f"translate({text}, '{UPPER}', '{LOWER}')"
    out = f"regexp_replace({out}, {_quoted(COPYRIGHT)}, chr(10), 'g')"
    out = f"' ' || regexp_replace({out}, {_quoted(MARKS)}, '  ', 'g') || ' '"
    for given, wanted in SPELLINGS:
        out = f"replace({out}, ' {given.replace(' ', '  ')} ', ' {wanted} ')"
    return f"sha256(trim(regexp_replace({out}, ' +', ' ', 'g')))"


def _sql_known(known: list[tuple[str, str]]) -> str:
    rows = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in known)
    return (
        f"SELECT {_sql_digest('t')} AS digest, min(l) AS license FROM (VALUES {rows}) AS k(l, t) GROUP BY 1"
    )


def oracle() -> str:
    """SQL for scan(documents)."""
    tags = [(name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS]
    hinted = "(lower(line) LIKE '%licens%' OR lower(line) LIKE '%licenc%')"
    return f"""
    WITH texts AS ({_sql_known(TEXTS)}), notices AS ({_sql_known(NOTICES + tags)}),
    rows AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
    lines AS (SELECT n, unnest(string_split(text, chr(10))) AS line FROM rows),
    named AS (
      SELECT n, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
      FROM (SELECT n, {_sql_digest('line')} AS digest FROM lines WHERE {hinted}) JOIN notices USING (digest)
      GROUP BY n
    ), whole AS (SELECT n, doc_id, {_sql_digest('text')} AS digest FROM rows)
    SELECT doc_id, digest AS text_digest, license, coalesce(named.notices, '') AS notices
    FROM whole LEFT JOIN texts USING (digest) LEFT JOIN named USING (n)
    """
