"""Replayable stream sources with offsets and a rate limit.

* ``random_bits`` - the reference's bit producer: bit ``i`` is a function of the
  seed and ``i`` alone, an offset is a number of bits, and the executors compute the
  bits of a range.  ``rate`` bits a second are offered since ``start_ms`` (a clock, not
  a counter, so a restarted query goes on where the clock is), up to ``count``.
* ``line_replay`` - the reference's CSV producer: the lines of a text file from a
  byte offset on, at most ``rows_per_batch`` of them per micro-batch.  The lines of a
  micro-batch pass through the driver, as Spark's simple Python sources do; for more
  than a rate-limited replay use the file source.

No port is opened.  ``register`` makes both formats known to a session."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader

P_ONE = 0.3        # fixed value: probability of a 1 in the reference's bit producer
BITS_A_SECOND = 10  # fixed value: its 0.1 s between bits


def bit_of(seed: int, i: int, p: float) -> int:
    """The bit that ``operators.bits.random_bits`` gives the row ``i``."""
    return int(int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:8], 16) / float(1 << 32) < p)


class RandomBits(DataSource):
    """Options: ``rate`` (bits a second; 0: all at once), ``count``,
    ``start_ms``, ``p``, ``seed``, ``partitions``."""

    @classmethod
    def name(cls) -> str:
        return "random_bits"

    def schema(self) -> str:
        return "seq LONG, bit INT"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _BitReader(self.options)


class _Range(InputPartition):
    def __init__(self, begin: int, end: int):
        self.begin, self.end = begin, end


class _BitReader(DataSourceStreamReader):
    def __init__(self, options):
        self.rate, self.count = float(options.get("rate", BITS_A_SECOND)), int(options.get("count", 1 << 62))
        self.start = int(options.get("start_ms", time.time() * 1000))
        self.p, self.seed, self.partitions_ = float(options.get("p", P_ONE)), int(options.get("seed", 42)), int(options.get("partitions", 8))

    def initialOffset(self) -> dict:
        return {"bits": 0}

    def latestOffset(self) -> dict:
        offered = self.count if not self.rate else int((time.time() * 1000 - self.start) * self.rate / 1000)
        return {"bits": max(0, min(self.count, offered))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        begin, stop = start["bits"], max(start["bits"], end["bits"])
        step = max(1, -(-(stop - begin) // self.partitions_))
        return [_Range(a, min(stop, a + step)) for a in range(begin, stop, step)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        for a in range(partition.begin, partition.end, 10_000):
            seq = range(a, min(partition.end, a + 10_000))
            yield pa.RecordBatch.from_arrays([pa.array(seq, pa.int64()), pa.array([bit_of(self.seed, i, self.p) for i in seq], pa.int32())],
                                             names=["seq", "bit"])

    def commit(self, end: dict) -> None:
        pass


class LineReplay(DataSource):
    """Options: ``path`` (a text file, local or any address that Arrow's file
    systems read), ``rows_per_batch``."""

    @classmethod
    def name(cls) -> str:
        return "line_replay"

    def schema(self) -> str:
        return "seq LONG, value STRING"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _LineReader(self.options)


class _LineReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.path, self.rows = options["path"], int(options.get("rows_per_batch", 1000))

    def initialOffset(self) -> dict:
        return {"line": 0, "byte": 0}

    def _lines(self, start: dict, rows: int, until: int | None = None) -> tuple[list[tuple[int, str]], dict]:
        from pyarrow import fs
        system, path = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (
            fs.LocalFileSystem(), self.path)
        out, line, at = [], start["line"], start["byte"]
        with system.open_input_file(path) as file:
            file.seek(at)
            held = b""
            while len(out) < rows and (until is None or at < until):
                cut = held.find(b"\n")
                if cut < 0:
                    more = file.read(1 << 16)
                    if not more:
                        break  # a line without an end may still grow
                    held += more
                    continue
                out.append((line, held[:cut].rstrip(b"\r").decode("utf-8", "replace")))
                held, line, at = held[cut + 1:], line + 1, at + cut + 1
        return out, {"line": line, "byte": at}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        out, end = self._lines(start, self.rows)
        return iter(out), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._lines(start, end["line"] - start["line"], end["byte"])[0])

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RandomBits)
    spark.dataSource.register(LineReplay)


def random_bit_stream(spark: SparkSession, **options) -> DataFrame:
    register(spark)
    return spark.readStream.format("random_bits").options(**{k: str(v) for k, v in options.items()}).load()


def replayed_lines(spark: SparkSession, path: str, rows_per_batch: int) -> DataFrame:
    register(spark)
    return spark.readStream.format("line_replay").option("path", path).option("rows_per_batch", rows_per_batch).load()
