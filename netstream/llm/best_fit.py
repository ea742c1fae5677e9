"""Best-fit packing, bulk-synchronous.

Documents become token ids followed by an end id.  Only a document longer than a
sequence is cut, into pieces of ``seq_len`` ids, each a sequence of its own; what
is left of it, and every shorter document, is a rest to be placed whole in the gap
of some sequence.

Rests are range-sorted by length and numbered within each length; so are gaps by
size.  A round places the rests above a threshold (half of the one before) by
sweeps: from the greatest size down, the rests of a length take the smallest gaps
that hold them (as many of one length as fit a gap, which is what best fit does
with equal lengths).  A longer rest goes first, and equal ones by their number, so
no two claim one place.  After a sweep the gaps have new sizes and the next sweep
places what found none; sequences are opened only for rests that no gap can hold.

A sweep needs to know how many rests and gaps there are of each size - at most
twice ``seq_len`` numbers, whatever the corpus - and yields runs: the rests of one
length and a range of numbers, the gaps of one size and a range of numbers.  The
runs of a round go to the tasks that hold the gaps, which follow each gap through
the round and write the places they fill; a join on (length, number) then hands
each place to its rest.  No task and no driver holds rows of the whole corpus.

Defined cases: a null or empty text is the end id alone; a null id is a document
like any other; repeated rows are placed as often as they stand in the table;
equal lengths go by document; an empty table gives no pieces.  Only the id and the
text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netstream.llm.common import KEY, forget, id_of, keyed_texts
from netstream.llm.tokens import token_ids
from netstream.operators.indexing import row_index
from netstream.session import cut_lineage

SEQ_LEN = 2048
END_ID = 0
PIECES = (f"pid long, {KEY} long, piece int, start long, length long, ids_crc32 long, ids binary")
GAPS = "sequence long, gap long, number long, birth int"
PLACES = "length long, number long, sequence long, offset long"
TASK_BITS = 40  # a piece's number is its task's and its place there
GAPS_PER_TASK = 1_000_000


def token_pieces(docs: DataFrame, tokenizer_path: str, seq_len: int, end_id: int,
                 id_col: str, text_col: str) -> DataFrame:
    """The pieces of each document, with a number ``pid`` of its own."""
    def cut(batches: Iterable[pa.RecordBatch]):
        pid = TaskContext.get().partitionId() << TASK_BITS
        for keys, texts in token_ids(batches, tokenizer_path, end_id):
            rows = [(key, i, s, ids[s:s + seq_len].astype("<u4").tobytes())
                    for key, ids in zip(keys.tolist(), texts) for i, s in enumerate(range(0, len(ids), seq_len))]
            key, piece, start, data = zip(*rows)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(pid, pid + len(rows))), pa.array(key, pa.int64()), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array([len(d) // 4 for d in data], pa.int64()),
                pa.array([zlib.crc32(d) for d in data], pa.int64()), pa.array(data, pa.binary())],
                names=["pid", KEY, "piece", "start", "length", "ids_crc32", "ids"])
            pid += len(rows)

    return keyed_texts(docs, id_col, text_col).mapInArrow(cut, PIECES)


# -- sweeps -------------------------------------------------------------------

@dataclass
class Sweep:
    """Sequences that were opened before it, and its runs: gaps ``size, first,
    count`` that each take ``each`` rests of ``length`` from number ``rest`` on and
    become gaps numbered from ``becomes`` on."""
    opened: int
    used: np.ndarray  # gaps of each size that it fills
    runs: list[tuple[int, int, int, int, int, int, int]] = field(default_factory=list)

    def columns(self) -> np.ndarray:
        return np.array(sorted(self.runs), np.int64).reshape(-1, 7).T


class Plan:
    """Counts of rests and gaps by size, and the sweeps over them."""

    def __init__(self, rests: np.ndarray):
        self.seq_len = len(rests) - 1
        self.left, self.taken = rests.copy(), np.zeros_like(rests)
        self.gaps = np.zeros_like(rests)
        self.sequences = 0

    def to_open(self, threshold: int) -> int:
        """Sequences that rests above every gap need at least."""
        size = np.arange(self.seq_len + 1)
        largest = int(np.flatnonzero(self.gaps).max(initial=0))
        alone = np.where(size > max(largest, threshold - 1), self.left, 0)
        return int(max(-(-(alone * size).sum() // self.seq_len), alone[self.seq_len // 2 + 1:].sum()))

    def sweep(self, threshold: int) -> Sweep:
        """Place rests of at least ``threshold``, each length in the smallest gaps."""
        out = Sweep(self.to_open(threshold), np.zeros_like(self.gaps))
        self.gaps[self.seq_len] += out.opened
        self.sequences += out.opened
        before, used, free, found = self.gaps.copy(), out.used, [], []
        for size in range(self.seq_len, threshold - 1, -1):
            if before[size]:
                free.append(size)
            while self.left[size] and free:
                gap, rests = free[-1], int(self.left[size])
                fit, some = gap // size, int(before[gap] - used[gap])
                count, each = (min(some, rests // fit), fit) if rests >= fit else (1, rests)
                found.append((gap, int(used[gap]), count, size, int(self.taken[size]), each))
                self.left[size] -= count * each
                self.taken[size] += count * each
                used[gap] += count
                if used[gap] == before[gap]:
                    free.pop()
        self.gaps = before - used  # those that stay are numbered anew from 0
        for gap, first, count, size, rest, each in found:
            becomes = gap - each * size
            out.runs.append((gap, first, count, size, rest, each, int(self.gaps[becomes])))
            self.gaps[becomes] += count
        self.gaps[0] = 0
        return out


def follow(gap: np.ndarray, number: np.ndarray, birth: np.ndarray, sequence: np.ndarray, sweeps: list, seq_len: int):
    """Lead gaps through the sweeps ``(columns, used)`` of a round (those of
    ``birth`` i from sweep i on).  Places ``(length, number, sequence, offset)``
    that they fill, and the gaps' sizes and numbers afterwards."""
    gap, number, places = gap.copy(), number.copy(), []
    for i, (runs, used) in enumerate(sweeps):
        size, first, count, length, rest, each, becomes = runs
        at = np.searchsorted(size << 40 | first, gap << 40 | number, side="right") - 1
        at = np.maximum(at, 0)
        hit = (birth <= i) & (gap > 0)
        hit &= (size[at] == gap) & (number >= first[at]) & (number < first[at] + count[at]) if len(size) else False
        stay = (birth <= i) & (gap > 0) & ~hit
        at, rows = at[hit], np.flatnonzero(hit)
        nth = number[rows] - first[at]
        copies = each[at]
        row = np.repeat(np.arange(len(rows)), copies)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
        places.append((length[at][row], (rest[at] + nth * copies)[row] + inner, sequence[rows][row],
                       (seq_len - gap[rows])[row] + inner * length[at][row]))
        number[stay] -= used[gap[stay]]
        gap[rows] -= copies * length[at]
        number[rows] = becomes[at] + nth
    return [np.concatenate(c) for c in zip(*places)], gap, number


def play_round(gaps: DataFrame, sweeps: list[Sweep], seq_len: int) -> DataFrame:
    """Rows ``PLACES`` that the gaps fill in a round, and the gaps that are
    left as ``(gap, number, sequence, null)``."""
    plan = [(s.columns(), s.used) for s in sweeps]

    def play(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {c: batch.column(c).to_numpy().astype(np.int64) for c in batch.schema.names}
            places, gap, number = follow(columns["gap"], columns["number"], columns["birth"], columns["sequence"], plan, seq_len)
            left = gap > 0
            filled = np.concatenate([np.ones(len(places[0]), bool), np.zeros(left.sum(), bool)])
            both = [np.concatenate(c) for c in zip(places[:3], (gap[left], number[left], columns["sequence"][left]))]
            offset = np.concatenate([places[3], np.zeros(left.sum(), np.int64)])
            yield pa.RecordBatch.from_arrays([*map(pa.array, both), pa.array(offset, mask=~filled)],
                                             names=["length", "number", "sequence", "offset"])

    return gaps.mapInArrow(play, PLACES)


def opened(spark: SparkSession, first: int, sweeps: list[Sweep], numbers: list[int], seq_len: int) -> DataFrame | None:
    """The sequences ``first ..`` that a round opens, as gaps."""
    out = None
    for birth, (sweep, number) in enumerate(zip(sweeps, numbers)):
        if sweep.opened:
            tasks = max(1, -(-sweep.opened // GAPS_PER_TASK))
            rows = spark.range(first, first + sweep.opened, 1, tasks).select(
                F.col("id").alias("sequence"), F.lit(seq_len).cast("long").alias("gap"),
                (F.col("id") - first + number).alias("number"), F.lit(birth).alias("birth"))
            out, first = rows if out is None else out.unionByName(rows), first + sweep.opened
    return out


def place_rests(ranked: DataFrame, seq_len: int) -> DataFrame:
    """``(pid, sequence, offset)`` of rests ``(pid, length, number)``."""
    spark = ranked.sparkSession
    counts = np.zeros(seq_len + 1, np.int64)
    for row in ranked.groupBy("length").count().collect():  # at most seq_len rows
        counts[row["length"]] = row["count"]
    plan = Plan(counts)
    gaps, rounds, threshold = None, [], seq_len
    while plan.left.any():
        threshold = max(1, threshold // 2)
        first, numbers, sweeps = plan.sequences, [], []
        while plan.left[threshold:].any():
            numbers.append(int(plan.gaps[seq_len]))
            sweeps.append(plan.sweep(threshold))
        if not sweeps:
            continue
        new = opened(spark, first, sweeps, numbers, seq_len)
        both = new if gaps is None else gaps if new is None else gaps.unionByName(new)
        rounds.append(cut_lineage(play_round(both, sweeps, seq_len), name="round"))
        gaps = (rounds[-1].where("offset IS NULL")
                .select("sequence", F.col("length").alias("gap"), "number", F.lit(0).alias("birth")))
    if not rounds:
        return spark.createDataFrame([], "pid long, sequence long, offset long")
    places = rounds[0]
    for more in rounds[1:]:  # one round per halving of seq_len
        places = places.unionByName(more)
    placed = cut_lineage(ranked.join(places.where("offset IS NOT NULL"), ["length", "number"])
                         .select("pid", "sequence", "offset"), name="places")
    forget(*rounds)
    return placed


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         seq_len: int = SEQ_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32,
    sequence_id, offset, ids`` (ids: unsigned 32-bit numbers, little-endian).
    ``tokenizer_path`` must be readable on each executor."""
    pieces = cut_lineage(token_pieces(docs, tokenizer_path, seq_len, end_id, id_col, text_col), name="pieces")
    rests = pieces.where(F.col("length") < seq_len).select("pid", KEY, "length")
    ranked = row_index(rests, [KEY, "pid"], group=["length"], index_col="number")
    ranked = cut_lineage(ranked.select("pid", "length", "number"), name="ranked")
    placed = place_rests(ranked, seq_len)
    forget(ranked)
    whole = F.col("length") == seq_len
    return (pieces.join(placed, "pid", "left").select(
        id_of().alias(id_col), "piece", "start", "length", "ids_crc32",
        F.when(whole, -1 - F.col("pid")).otherwise(F.col("sequence")).alias("sequence_id"),
        F.when(whole, 0).otherwise(F.col("offset")).cast("long").alias("offset"), "ids"))


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` packed with the word tokenizer."""
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")
