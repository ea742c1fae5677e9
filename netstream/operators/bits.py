"""Counting ones in a bit stream (B1-B10), batch form.

Streams are keyed; ``seq`` orders the bits of a key; a NULL key is a stream of
its own.

* Exact counts (running total, last N, last K) start from prefix sums: range
  partitions over ``(key, seq)`` split a hot key over many tasks.  The counts of
  the last N are windows over blocks of ``BLOCK_ROWS`` positions, each with a
  halo of the N - 1 rows before it - one shuffle, no key in one task.
* The as-written DGIM needs only a bounded head per stream and prefix sums.
* The published DGIM folds the blocks of a stream in parallel: a block is folded
  for every state it may start with, the blocks' results are chained, and each
  block is folded once more from its state.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netstream.functions.dgim import (QUERY_K, WINDOW_N, buckets_of, follow_totals, oldest_size, possible_totals,
                                      suffix_totals)
from netstream.operators.indexing import keyed_prefix_sum
from netstream.session import cut_lineage

BLOCK_ROWS = 100_000  # positions of one stream that go to one task
FOLD_ROWS = 4_096  # positions of one stream that are folded as one block
FOLD_TOGETHER = 65_536  # rows whose blocks are folded at once
CHAINED_BLOCKS = 1_024  # blocks of a stream that one task chains
P_ONE = 0.3  # fixed value: probability of a 1 in the reference's bit producer


# ---------------------------------------------------------------------------
# B1 / S6
# ---------------------------------------------------------------------------

def parse_bits(lines: DataFrame, value: str = "value") -> DataFrame:
    """Text -> ``bit`` (1 only for the integer 1; any other integer is a 0)
    and ``valid`` (false for text that is not an integer; such rows are kept
    and flagged rather than failing the job)."""
    as_int = F.expr(f"try_cast(trim({value}) AS INT)")
    return lines.withColumn("valid", as_int.isNotNull()) \
                .withColumn("bit", F.when(as_int == 1, 1).otherwise(0))


def random_bits(rows: DataFrame, seq: str, p: float = P_ONE, seed: int = 42) -> DataFrame:
    """One pseudo-random bit per row with ``P(1) = p``: the first 32 bits of
    the MD5 of ``seed:seq`` as the uniform, so the bit depends on neither
    partitioning nor retries (``rand()`` does), and any engine can repeat it."""
    return rows.withColumn("bit", (hash_uniform(F.col(seq), seed) < F.lit(p)).cast("int"))


def hash_uniform(value, seed: int):
    """A uniform number in [0, 1) from an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), value.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double") / float(1 << 32)


# ---------------------------------------------------------------------------
# B6 / B7 / B8 / B9
# ---------------------------------------------------------------------------

def stream_positions(bits: DataFrame, key: str = "key", seq: str = "seq", bit: str = "bit") -> DataFrame:
    """``(key, seq, bit, pos, ones_running)``: 1-based position in the stream
    and ones since its start, written once."""
    base = bits.select(F.col(key).cast("long").alias("key"), F.col(seq).cast("long").alias("seq"),
                       F.when(F.col(bit) == 1, 1).otherwise(0).cast("long").alias("bit"),
                       F.lit(1).cast("long").alias("one"))
    cum = keyed_prefix_sum(base, "key", "seq", ["bit", "one"])
    return cut_lineage(cum.select("key", "seq", "bit", F.col("one_cum").alias("pos"),
                                  F.col("bit_cum").alias("ones_running")), name="positions")


def with_window_counts(cum: DataFrame, windows: dict[str, int], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``cum`` with the ones among the last ``w`` bits for each ``name -> w``:
    sums over the rows of a block of positions and its halo, the rows before
    it that its windows reach into."""
    if not windows:
        return cum
    halo = max(windows.values()) - 1
    block = F.floor((F.col("pos") - 1) / block_rows).cast("long")
    until = F.floor((F.col("pos") - 1 + halo) / block_rows).cast("long")
    rows = cum.withColumn("_own", block).withColumn("_block", F.explode(F.sequence(block, until)))
    place = Window.partitionBy("key", "_block").orderBy("pos")
    for name, w in windows.items():
        rows = rows.withColumn(name, F.sum("bit").over(place.rowsBetween(1 - w, 0)))
    return rows.where("_block = _own").drop("_own", "_block")


def ones_counts(bits: DataFrame, key: str = "key", seq: str = "seq", bit: str = "bit",
                windows: dict[str, int] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per bit: ``pos`` (1-based position in its stream), ``ones_running``
    (ones since the start) and, for each ``name -> w`` in ``windows``, the
    ones among the last ``w`` bits."""
    windows = windows if windows is not None else {"ones_last_n": WINDOW_N}
    return with_window_counts(stream_positions(bits, key, seq, bit), windows, block_rows)


def relative_error(truth, estimate):
    """``(truth - estimate) / truth``, 0 when the truth is 0 (signed)."""
    return F.when(truth > 0, (truth - estimate) / truth).otherwise(F.lit(0.0))


# ---------------------------------------------------------------------------
# DGIM
# ---------------------------------------------------------------------------

_BLOCK = ["_null", "key", "_block"]


def _whole_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``_BLOCK`` in tables of whole blocks, with the rows at
    which blocks start."""
    def starts(table: pa.Table) -> np.ndarray:
        change = np.ones(table.num_rows, bool)
        columns = [table.column(c).to_numpy() for c in _BLOCK]
        change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        return np.flatnonzero(change)

    held, rows = [], 0
    for batch in batches:
        held, rows = [*held, batch], rows + batch.num_rows
        if rows >= FOLD_TOGETHER:
            table = pa.Table.from_batches(held).combine_chunks()
            first = starts(table)
            if len(first) > 1:
                yield table.slice(0, int(first[-1])), first[:-1]
                held = table.slice(int(first[-1])).to_batches()
                rows = sum(b.num_rows for b in held)
    if rows:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, starts(table)


class _Blocks:
    """The bits of some blocks, each after the last bits of the block before."""

    def __init__(self, table: pa.Table, first: np.ndarray):
        self.size = np.diff(np.append(first, table.num_rows))
        self.own = (table.column("_block").to_numpy() == table.column("_own").to_numpy())
        self.bit = table.column("bit").to_numpy().astype(np.uint8)
        self.end = first + self.size
        self.begin = self.end - np.add.reduceat(self.own, first)
        ones = np.append(0, np.cumsum(self.bit, dtype=np.int64))
        self.recent = ones[self.begin] - ones[first]


def _block_results(n: int):
    """``(_BLOCK, recent, ends)`` of each block: the ones in the ``n`` bits
    before it, and the totals it ends with for each total it may start with."""
    def run(batches):
        for table, first in _whole_blocks(batches):
            blocks = _Blocks(table, first)
            real = blocks.begin < blocks.end  # behind a stream's end there may be bits before a block, but no block
            first, blocks.begin, blocks.end, blocks.recent = (
                a[real] for a in (first, blocks.begin, blocks.end, blocks.recent))
            if not len(first):
                continue
            starts = [possible_totals(c) for c in blocks.recent.tolist()]
            widest = max(map(len, starts))
            padded = np.array([s + s[:1] * (widest - len(s)) for s in starts], np.int64)
            ends = follow_totals(blocks.bit, blocks.begin, blocks.end, padded, n)
            rows = table.take(pa.array(first)).select(_BLOCK).combine_chunks()
            found = [e[:len(s)].tolist() for e, s in zip(ends, starts)]
            yield pa.RecordBatch.from_arrays(
                [*(c.combine_chunks() for c in rows.columns), pa.array(blocks.recent), pa.array(found, pa.list_(pa.int64()))],
                names=[*_BLOCK, "recent", "ends"])
    return run


_RESULT = "_null boolean, key long, _block long, recent long, ends array<long>"


def _walk(pdf: pd.DataFrame, total: int) -> list[int]:
    """Totals before each block of a stream (in order), and after the last."""
    out = [total]
    for recent, ends in zip(pdf["recent"].tolist(), pdf["ends"]):
        out.append(int(ends[possible_totals(recent).index(out[-1])]))
    return out


def block_starts(results: DataFrame) -> DataFrame:
    """``(_BLOCK, start)``: the total each block starts with.  A stream of more
    than ``CHAINED_BLOCKS`` blocks is chained in groups, then over the groups."""
    fan = CHAINED_BLOCKS

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        first = int(pdf["start"].iloc[0])
        return pdf[_BLOCK].assign(start=_walk(pdf, first)[:-1])

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        recent = int(pdf["recent"].iloc[0])
        ends = [_walk(pdf, total)[-1] for total in possible_totals(recent)]
        return pdf[["_null", "key"]].head(1).assign(_block=int(pdf["_block"].iloc[0]) // fan, recent=recent, ends=[ends])

    group = F.floor(F.col("_block") / fan).cast("long")
    schema = "_null boolean, key long, _block long, start long"
    last = results.agg(F.max("_block")).first()[0] or 0
    if last < fan:
        return results.withColumn("start", F.lit(0)).groupBy("_null", "key").applyInPandas(starts, schema)
    groups = cut_lineage(results.withColumn("_group", group).groupBy("_null", "key", "_group")
                         .applyInPandas(joined, _RESULT), name="dgim-groups")
    before = block_starts(groups).withColumnRenamed("_block", "_group")
    return (results.withColumn("_group", group).join(before, ["_null", "key", "_group"])
            .groupBy("_null", "key", "_group").applyInPandas(starts, schema))


def _block_totals(n: int, columns: list[str], queries: dict[str, int]):
    """Rows with their totals; a block's first row may be its ``start``."""
    def run(batches):
        for table, first in _whole_blocks(batches):
            start = table.column("start").to_numpy(zero_copy_only=False)[first]
            real = np.isnan(table.column("start").to_numpy(zero_copy_only=False).astype(np.float64))
            start = np.nan_to_num(start.astype(np.float64)).astype(np.int64)
            place = np.append(0, np.cumsum(real))
            table = table.filter(pa.array(real))
            blocks = _Blocks(table, place[first])
            total = np.zeros(table.num_rows, np.int64)
            follow_totals(blocks.bit, blocks.begin, blocks.end, start[:, None], n, total)
            at = np.flatnonzero(blocks.own)
            total, out = total[at], table.take(pa.array(at)).combine_chunks()
            found = {"n_buckets": buckets_of(total), "bucket_sum": total, "estimate": total - oldest_size(total) // 2}
            for name, k in queries.items():
                inside, oldest = suffix_totals(blocks.bit, at, total, k)
                found[name] = inside - oldest // 2
            yield pa.RecordBatch.from_arrays([*(out.column(c).combine_chunks() for c in columns), *map(pa.array, found.values())],
                                             names=[*columns, *found])
    return run


def published(cum: DataFrame, n: int = WINDOW_N, queries: dict[str, int] | None = None,
              fold_rows: int | None = None) -> DataFrame:
    """Published DGIM after every bit, added to the columns of ``cum`` (with
    ``key, seq, bit, pos``): ``n_buckets, bucket_sum, estimate`` (ones among the
    last ``n`` bits) and, for each ``name -> k`` in ``queries`` (``k <= n``), the
    sketch's answer for the last ``k`` bits: the buckets that end among them,
    less half of the oldest of these.

    The state is one number (see ``functions.dgim``), so a stream is cut into
    blocks whatever its bits are: each is folded for every state that the ``n`` bits
    before it allow, the results are chained per stream, and each block is folded
    once more from the state found.  No state is guessed."""
    queries = queries or {}
    if any(k > n for k in queries.values()):
        raise ValueError("a query reaches back at most n bits")
    size = fold_rows or max(FOLD_ROWS, 8 * n)
    columns = [c for c in cum.columns if c != "key"]
    rows = cum.select(F.col("key").isNull().alias("_null"), F.coalesce("key", F.lit(0).cast("long")).alias("key"), *columns)
    own = F.floor((F.col("pos") - 1) / size).cast("long")
    until = F.floor((F.col("pos") - 1 + n) / size).cast("long")
    cut = rows.withColumn("_own", own).withColumn("_block", F.explode(F.sequence(own, until)))
    single = (cum.agg(F.max("pos")).first()[0] or 0) <= size
    cut = cut.where(F.col("_block") == F.col("_own")) if single else cut
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    starts = None
    if not single:
        results = (cut.select(*_BLOCK, "_own", "pos", "bit").repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "pos")
                   .mapInArrow(_block_results(n), _RESULT))
        starts = cut_lineage(block_starts(cut_lineage(results, name="dgim-blocks")), name="dgim-starts")
    cut = cut.withColumn("start", F.lit(None).cast("long"))
    if starts is not None:
        cut = cut.unionByName(starts.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
    schema = ", ".join(f"`{c}` {types[c]}" for c in ["_null", "key", *columns])
    out = (cut.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "pos")
           .mapInArrow(_block_totals(n, ["_null", "key", *columns], queries),
                       f"{schema}, n_buckets long, bucket_sum long, estimate long"
                       + "".join(f", `{c}` long" for c in queries)))
    return out.withColumn("key", F.when(~F.col("_null"), F.col("key"))).drop("_null")


def dgim(bits: DataFrame, mode: str = "published", n: int = WINDOW_N, key: str = "key",
         seq: str = "seq", bit: str = "bit") -> DataFrame:
    """DGIM state after every bit of every stream.

    ``as_written``: ``(key, seq, real_count, n_buckets, bucket_sum,
    discarded, estimate DOUBLE)`` - ``estimate = bucket_sum + 2^discarded - 1``,
    infinite past the DOUBLE range (``discarded`` is exact).
    ``published``: ``(key, seq, n_buckets, bucket_sum, estimate)``.
    """
    if mode not in ("as_written", "published"):
        raise ValueError("mode must be 'as_written' or 'published'")
    cum = stream_positions(bits, key, seq, bit)
    if mode == "as_written":
        return as_written(cum, n).select("key", "seq", "real_count", "n_buckets", "bucket_sum", "discarded", "estimate")
    return published(cum, n).select("key", "seq", "n_buckets", "bucket_sum", "estimate")


def as_written_head_length(n: int) -> int:
    """Bits after which the as-written state is closed-form.

    From bit N on, every bit drops the oldest bucket.  With ``rest`` the sum
    of all but the newest bucket (its binary digits are the buckets), one
    step maps ``rest`` to at most ``rest / 2``: at most one is added, then the
    highest set bit is removed.  So ``rest`` is 0 from bit
    ``N + bit_length(N) + 1`` on and stays 0; the state is then only
    ``newest`` and ``discarded``.
    """
    return n + int(n).bit_length() + 1


def _head_step(n: int):
    """One bit of the as-written rule on ``(t, rest, newest, discarded)``."""
    def step(state, bit):
        one = bit == 1
        t = state["t"] + 1
        rest = state["rest"] + F.when(one & (state["newest"] == 1), 1).otherwise(0)
        newest = F.when(one, 1).otherwise(state["newest"])
        full = (t >= n) & ((rest > 0) | (newest == 1))
        top = F.when(rest > 0, F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(rest, F.lit(1)).cast("double") + 0.5))))
        return F.struct(
            t.cast("long").alias("t"),
            (rest - F.when(full & (rest > 0), top).otherwise(0).cast("long")).cast("long").alias("rest"),
            F.when(full & (rest == 0), 0).otherwise(newest).cast("long").alias("newest"),
            (state["discarded"] + F.when(full, 1).otherwise(0)).cast("long").alias("discarded"))
    return step


def as_written(cum: DataFrame, n: int = WINDOW_N) -> DataFrame:
    """As-written DGIM after every bit, added to the columns of ``cum``
    (``key, seq, bit, pos, ones_running``), with bounded sequential work.

    * head: the first ``T0 = as_written_head_length(n)`` bits of a stream are
      one array per key, folded by array functions;
    * tail: afterwards ``rest = 0`` and, from the state at T0,
      ``discarded = d0 + ones_after + [newest0 = 1 and a 0 was seen]`` and
      ``newest = [newest0 = 1 and no 0 was seen]`` - no fold at all, so a stream
      holding a third of all bits is split like the exact counts.
    """
    t0 = as_written_head_length(n)
    first = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("t", "rest", "newest", "discarded")])
    heads = (cum.where(F.col("pos") <= t0).groupBy("key")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "bit", "ones_running"))).alias("h")))
    states = F.transform(F.sequence(F.lit(1), F.size("h")), lambda i: F.aggregate(
        F.transform(F.slice("h", 1, i), lambda x: x["bit"]), first, _head_step(n)))
    heads = cut_lineage(heads.select(F.col("key").alias("_key"), states.alias("states"),
                                     F.element_at("h", -1)["ones_running"].alias("ones0")), name="dgim-heads")
    rows = cum.join(heads, F.col("key").eqNullSafe(F.col("_key")))
    last = F.element_at("states", -1)
    ones_after = F.col("ones_running") - F.col("ones0")
    zeros_after = F.col("pos") - t0 - ones_after
    in_head = F.col("pos") <= t0
    here = F.get("states", (F.col("pos") - 1).cast("int"))
    rest = F.when(in_head, here["rest"]).when(
        last["rest"] != 0, F.raise_error(F.lit("as-written DGIM: rest not drained")).cast("long")).otherwise(0)
    newest = F.when(in_head, here["newest"]).when((last["newest"] == 1) & (zeros_after == 0), 1).otherwise(0)
    discarded = F.when(in_head, here["discarded"]).otherwise(
        last["discarded"] + ones_after + F.when((last["newest"] == 1) & (zeros_after > 0), 1).otherwise(0))
    rows = rows.select(*cum.columns, rest.cast("long").alias("_rest"), newest.cast("long").alias("_newest"),
                       discarded.cast("long").alias("discarded"))
    total = F.col("_rest") + F.col("_newest")
    return (rows.withColumn("real_count", F.col("ones_running"))
            .withColumn("n_buckets", (F.bit_count("_rest") + F.col("_newest")).cast("long"))
            .withColumn("bucket_sum", total)
            .withColumn("estimate", total.cast("double") + (F.pow(F.lit(2.0), F.col("discarded").cast("double")) - 1.0))
            .drop("_rest", "_newest"))


__all__ = ["parse_bits", "random_bits", "ones_counts", "relative_error", "dgim",
           "stream_positions", "as_written", "published", "WINDOW_N", "QUERY_K", "P_ONE"]
