"""Edge-list sources: whitespace text (S1), headerless CSV (S2), any table (S3).

Gzip files are not splittable, so a single file arrives as one partition; we
repartition right after the scan so the rest of the plan runs wide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netstream.session import shuffle_partitions


def _spread(spark: SparkSession, df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions or shuffle_partitions(spark))


def _tokens(lines: DataFrame) -> DataFrame:
    """``(src, dst)`` texts of each line that is not blank or a comment."""
    tokens = F.split(F.trim(F.regexp_replace("value", "#.*$", "")), r"\s+")
    return (lines.select(tokens.alias("t")).where(F.col("t")[0] != "")
            .select(F.col("t")[0].alias("src"), F.get(F.col("t"), 1).alias("dst")))


def _as_long(name: str):
    return F.expr(f"try_cast({name} AS BIGINT)")


def read_edge_list(spark: SparkSession, path: str, numeric: bool = True,
                   partitions: int | None = None) -> DataFrame:
    """Whitespace-separated edge list; ``#`` starts a comment; extra columns
    are ignored.  ``numeric`` casts ids to BIGINT, and a line that does not
    parse is left out (``edge_line_counts`` tells how many); otherwise ids stay
    strings (see ``index_named_edges``)."""
    df = _tokens(spark.read.text(path)).where(F.col("dst").isNotNull())
    if numeric:
        df = (df.select(_as_long("src").alias("src"), _as_long("dst").alias("dst"))
                .where(F.col("src").isNotNull() & F.col("dst").isNotNull()))
    return _spread(spark, df, partitions)


def edge_line_counts(spark: SparkSession, path: str, numeric: bool = True) -> DataFrame:
    """``(kind, n)``: lines of an edge list read as ``edge`` and ``rejected``
    (one id only, or an id that is no number)."""
    ok = F.col("dst").isNotNull()
    if numeric:
        ok = _as_long("src").isNotNull() & _as_long("dst").isNotNull()
    kind = F.when(F.coalesce(ok, F.lit(False)), "edge").otherwise("rejected")
    return _tokens(spark.read.text(path)).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def read_edge_csv(spark: SparkSession, path: str, src_pos: int = 0, dst_pos: int = 1,
                  partitions: int | None = None) -> DataFrame:
    """Headerless CSV; columns are addressed by position like ``_c0``; a row
    whose ids are no numbers is left out (``csv_line_counts`` tells how many)."""
    df = _csv_ids(spark, path, src_pos, dst_pos).where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return _spread(spark, df, partitions)


def _csv_ids(spark: SparkSession, path: str, src_pos: int, dst_pos: int) -> DataFrame:
    """``(src, dst)`` of every row; null where there is no such column or no
    number in it.  The columns are named, so that the first line of a file does
    not decide how many are read."""
    names = [f"_c{i}" for i in range(max(src_pos, dst_pos) + 1)]
    raw = spark.read.option("header", False).schema(", ".join(f"{c} STRING" for c in names)).csv(path)
    return raw.select(_as_long(f"_c{src_pos}").alias("src"), _as_long(f"_c{dst_pos}").alias("dst"))


def csv_line_counts(spark: SparkSession, path: str, src_pos: int = 0, dst_pos: int = 1) -> DataFrame:
    """``(kind, n)``: rows of a headerless CSV read as ``edge`` and
    ``rejected`` (a column is missing or holds no whole number)."""
    ok = F.col("src").isNotNull() & F.col("dst").isNotNull()
    return (_csv_ids(spark, path, src_pos, dst_pos).groupBy(F.when(ok, "edge").otherwise("rejected").alias("kind"))
            .agg(F.count(F.lit(1)).alias("n")))


def edges_from_table(df: DataFrame, source: str, target: str) -> DataFrame:
    """Any two columns of a table as an edge list."""
    return df.select(F.col(source).alias("src"), F.col(target).alias("dst"))


def write_edge_list(edges: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write ``src dst`` lines, the format ``read_edge_list`` reads."""
    (edges.select(F.concat_ws(" ", F.col("src").cast("string"),
                              F.col("dst").cast("string")).alias("value"))
          .write.mode("overwrite").option("compression", compression).text(path))


def write_edge_csv(edges: DataFrame, path: str, compression: str = "gzip") -> None:
    (edges.select("src", "dst").write.mode("overwrite")
          .option("header", False).option("compression", compression).csv(path))
