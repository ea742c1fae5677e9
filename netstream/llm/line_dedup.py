"""Line dedup: overlapping windows of three lines.

A window is three consecutive lines of a document (cut at ``\\n``), at least
one of them not blank.  A window whose three lines already stand together
earlier in the corpus - in a document of smaller id, or further up in the same
document - is a repeat, and the lines that repeats cover are removed; the first
occurrence stays.  Windows are judged on the input.

Lines hash to 128 bits per window.  The first place of each window is a
partial ``min``, so a window that a third of all documents share reaches the
shuffle once per map task; marking its other places is a plain equi-join of
which adaptive execution splits the large side.

Defined cases: a null text has no lines and stays null; an empty text is one
empty line; documents of fewer than three lines have no window and stay whole.
Rows that share an id or have none are documents of their own, by text order; rows
equal in id and text are one document, what is removed from one is removed from
each.  Other columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.llm.common import KEY, TEXT, Rows, let
from netstream.session import cut_lineage

WINDOW = 3
STATS = "line_dedup"


def line_windows(texts: DataFrame) -> DataFrame:
    """``(KEY, start, h1, h2)`` of each window of ``texts(KEY, TEXT)``."""
    lines = F.col("_nx_lines")
    n = F.size(lines)
    shifted = [F.slice(lines, i + 1, n).alias(f"l{i}") for i in range(WINDOW)]
    parts = [F.col(f"w.l{i}") for i in range(WINDOW)]
    return (texts.select(KEY, F.split(TEXT, "\n", -1).alias("_nx_lines"))
            .where(n >= WINDOW)
            .select(KEY, F.posexplode(F.arrays_zip(*shifted)).alias("start", "w"))
            .where(parts[-1].isNotNull() & (F.trim(F.translate(F.concat(*parts), "\t\r\x0b\x0c", "    ")) != ""))
            .select(KEY, F.col("start").cast("long").alias("start"),
                    F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(WINDOW), *parts).alias("h2")))


def covered_lines(windows: DataFrame) -> DataFrame:
    """``(KEY, covered)``: line numbers below repeated windows, merged."""
    first = (windows.groupBy("h1", "h2")
             .agg(F.min(F.struct(KEY, "start")).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("h1", "h2", "first"))
    repeats = windows.join(first, ["h1", "h2"]).where(F.struct(KEY, "start") > F.col("first"))
    return (repeats.select(KEY, F.explode(F.sequence("start", F.col("start") + WINDOW - 1)).alias("line"))
            .groupBy(KEY).agg(F.collect_set("line").alias("_nx_covered")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stats_col: str | None = STATS) -> DataFrame:
    """``docs`` with ``text_col`` freed of repeated windows; ``stats_col``
    (unless None) holds ``struct(n_lines, n_removed)``."""
    rows = Rows(docs, id_col, text_col)
    windows = cut_lineage(line_windows(rows.texts()), name="line-windows")
    text = rows.column(text_col).cast("string")
    joined = rows.table.join(covered_lines(windows), KEY, "left")
    covered = F.col("_nx_covered")

    def kept(lines):
        left = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), covered)
        return F.array_join(F.transform(left, lambda i: F.element_at(lines, (i + 1).cast("int"))), "\n")

    n_lines = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1))).cast("long")
    stats = F.struct(n_lines.alias("n_lines"),
                     F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_removed"))
    cut = F.when(covered.isNull(), text).otherwise(let(F.split(text, "\n", -1), kept))
    out = [(cut if c == text_col else rows.column(c)).alias(c) for c in docs.columns if c != stats_col]
    return joined.select(*out, *([stats.alias(stats_col)] if stats_col else []))


def query(spark, sf_dir: str) -> DataFrame:
    """Per document of ``documents``: lines, lines removed, digest of what is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", F.col(f"{STATS}.n_lines").alias("n_lines"), F.col(f"{STATS}.n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = """
WITH t AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM t),
w AS (SELECT doc_id, i, line,
             lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c FROM l
      WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
v AS (SELECT doc_id, i, row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, i) AS rn
      FROM w WHERE c IS NOT NULL AND NOT regexp_full_match(line || b || c, '[ \\t\\r\\x0b\\x0c]*')),
gone AS (SELECT DISTINCT doc_id, i + d AS i FROM v, (VALUES (0), (1), (2)) AS s(d) WHERE rn > 1),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
                coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS txt
         FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT t.doc_id, CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.txt, '')) AS kept_sha256
FROM t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
