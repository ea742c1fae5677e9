"""The corpus pipeline: five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet to the shared scratch folder and the next stage reads it
again.  All stages but the last return the columns of ``documents``:

1. ``language_id`` drops documents whose language is undetermined;
2. ``line_dedup`` cuts repeated runs of three lines out of the texts (and drops
   a document of which nothing is left);
3. ``near_dedup`` keeps one document of each group of near duplicates;
4. ``decontaminate`` drops documents that leak a benchmark item;
5. ``pack`` lays the rest out in sequences and returns the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netstream.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from netstream.session import cut_lineage, ship_package


def identify_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a determined language.  Learns from the labelled documents
    whose crc32 of the id leaves no 1 modulo 3."""
    ship_package(spark)
    return language_id.keep_identified(docs, language_id.learn(language_id.training_rows(docs)))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated line windows, ``n_chars`` brought up to date;
    a document whose every line was a repeat goes."""
    ship_package(spark)
    stats = "lines"
    while stats in docs.columns:  # a name that the table does not have
        stats += "_"
    out = line_dedup.dedup_lines(docs, stats_col=stats)
    emptied = (F.col(f"{stats}.n_removed") > 0) & (F.trim(F.translate("text", "\n\r\t", "   ")) == "")
    n_chars = F.when(F.col(f"{stats}.n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return (out.where(~F.coalesce(emptied, F.lit(False)))
            .withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).drop(stats))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    ship_package(spark)
    return near_dedup.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of ``benchmark``."""
    ship_package(spark)
    return decontaminate.remove_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    import public_tokenizers
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pack", pack_stage),
]

#: Language identification, near duplicates by minhash and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name=f"pipeline-{name}")
    return cut_lineage(STAGES[-1][1](spark, docs, sf_dir), name="pipeline-packed")
