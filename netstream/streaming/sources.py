"""Streaming sources (S4-S7) and a replay harness for tests.

``stream_reader`` is the one entry point for unbounded input: ``socket``,
``kafka``, ``rate`` or a file format.  Tests and registered queries replay
a table through the file source: ``stage_replay`` writes it once, in parallel,
as files of consecutive sequence numbers, and ``maxFilesPerTrigger`` sets how
many of them make a micro-batch.  No port is opened.  ``replay_source`` has
sources with offsets of their own (random bits, lines of a file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netstream.session import shuffle_partitions

FILES_PER_TRIGGER = 4  # files of one micro-batch
ROWS_PER_FILE = 1_000  # sequence numbers of one file
REPLAY_BATCHES = 24  # micro-batches of a replay in epochs, if its files then stay below ...
EPOCHS_PER_FILE = 128  # ... this many epochs; beyond it there are more micro-batches
_FIRST_TIME = 1_600_000_000_000  # modification time of file 0 (ms)


def stream_reader(spark: SparkSession, fmt: str, schema=None, path: str | None = None,
                  **options) -> DataFrame:
    """``spark.readStream.format(fmt)`` with options; file formats need a
    schema (no inference on streams)."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path) if path else reader.load()


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a TCP socket (column ``value``) - S4/S5."""
    return stream_reader(spark, "socket", host=host, port=port)


def stage_replay(df: DataFrame, order: str, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``df`` as one parquet file per ``rows_per_file`` consecutive
    values of ``order`` - one parallel write, a file is one task's - and give the
    files modification times in that order (the file source takes files oldest
    first).  ``order`` should be dense; values that are missing make a smaller
    file.  A replay harness: production streams come from a real source
    through ``stream_reader``."""
    spark = df.sparkSession
    numbered = df.withColumn("part_no", F.floor(F.col(order) / rows_per_file).cast("long"))
    (numbered.repartition(shuffle_partitions(spark), "part_no").write.mode("append")
     .partitionBy("part_no").parquet(path))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for part in fs.listStatus(folder):
        number = part.getPath().getName().partition("part_no=")[2]
        for file in fs.listStatus(part.getPath()) if number.lstrip("-").isdigit() else []:
            fs.setTimes(file.getPath(), _FIRST_TIME + int(number), -1)


def in_epochs(table: DataFrame, order: str, epoch_rows: int) -> tuple[DataFrame, int]:
    """``table`` with ``epoch`` = ``order`` div ``epoch_rows``, and their number; rows
    without a position come after all others."""
    last = table.agg(F.max(order)).first()[0]
    after = 0 if last is None else (last // ROWS_PER_FILE + 1) * ROWS_PER_FILE // epoch_rows
    return table.withColumn("epoch", F.coalesce(F.floor(F.col(order) / epoch_rows).cast("long"), F.lit(after).cast("long"))), \
        0 if last is None else last // epoch_rows + 1


def epochs_per_file(epochs: int) -> int:
    """Epochs of one file: one in a short replay, more in a longer one, up to
    ``EPOCHS_PER_FILE``, which bounds the rows of a micro-batch."""
    return min(EPOCHS_PER_FILE, max(1, -(-epochs // (REPLAY_BATCHES * FILES_PER_TRIGGER))))


def replay_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    return stream_reader(spark, "parquet", schema=schema, path=path, maxFilesPerTrigger=files_per_trigger,
                         recursiveFileLookup="true")
