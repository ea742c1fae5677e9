"""Distributed row positions (D1) and keyed prefix sums.

``row_number()`` over an unpartitioned window sends every row to one task,
and a window partitioned by a hot key sends that key to one task.  Both
helpers here range-partition on ``(group, order)`` instead, so a hot group is
split over many partitions; per-partition counts (at most partitions + groups
rows) give each partition its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netstream.session import cut_lineage, shuffle_partitions

_LOCAL_BITS = 33  # monotonically_increasing_id: partition id << 33 | row in partition


def _cols(x) -> list[str]:
    if x is None:
        return []
    if isinstance(x, str):
        return [x]
    return list(x)


def _join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` treating NULL = NULL (a NULL group is a group,
    not a dropped row); right-hand key columns are dropped."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for c in keys:
        term = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = term if cond is None else cond & term
    return left.join(r, cond).drop(*[f"_r_{c}" for c in keys])


def _ranged(df: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    """Range-partition and sort by ``keys`` and stamp each row with its
    partition and position in it, then materialise.

    The stamp must be computed once: the range bounds are sampled with a
    seed that depends on the RDD, so two evaluations (the counts branch and
    the row branch, or a recomputation after a lost executor) could cut the
    data differently.  Written to the shared checkpoint folder, both
    branches - and any retry - read the same stamps.
    """
    n = partitions or shuffle_partitions(df.sparkSession)
    mid = F.monotonically_increasing_id()
    stamped = (df.repartitionByRange(n, *keys)
                 .sortWithinPartitions(*keys)
                 .withColumn("_mid", mid)
                 .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
                 .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
                 .drop("_mid"))
    return cut_lineage(stamped, name="ranged")


def row_index(df: DataFrame, order: str | Sequence[str], group: str | Sequence[str] | None = None,
              index_col: str = "idx", partitions: int | None = None) -> DataFrame:
    """0-based position of each row by ``order`` (within ``group`` if given).

    Ties in ``order`` get distinct but arbitrary positions; add a unique
    column to ``order`` for a deterministic result.
    """
    order, group = _cols(order), _cols(group)
    staged = _ranged(df, group + order, partitions)
    counts = (staged.groupBy("_pid", *group)
                    .agg(F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first")))
    w = (Window.partitionBy(*group) if group else Window.partitionBy()).orderBy("_pid")
    counts = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    counts = counts.select("_pid", *group, "_off", "_first")
    if not group:
        # one row per range partition: the size bound is the partition count
        counts = F.broadcast(counts)
    out = _join_on(staged, counts, ["_pid", *group])
    return (out.withColumn(index_col, (F.col("_off") + F.col("_local") - F.col("_first")).cast("long"))
               .drop("_pid", "_local", "_off", "_first"))


def following(df: DataFrame, order: str | Sequence[str], group: str, value: str,
              partitions: int | None = None) -> DataFrame:
    """``(value, next)``: ``value`` of each row and of the next row by ``order`` within
    its group, no row for the last of a group.  Nulls in ``group`` are left out.

    The next row stands in the same range partition, where a window over (range
    partition, group) finds it, or it is the first row of the next one (a row per
    range partition).
    """
    order = _cols(order)
    staged = _ranged(df.where(F.col(group).isNotNull()), [group, *order], partitions)
    w = Window.partitionBy("_pid", group).orderBy("_local")
    # a row stands in a struct, so that a null value is told from no row
    inside = staged.select(F.col(value).alias("value"), F.lead(F.struct(F.col(value).alias("v"))).over(w).alias("n"))
    row = F.struct("_local", F.col(group).alias("g"), F.col(value).alias("v"))
    ends = (staged.groupBy("_pid").agg(F.min(row).alias("first"), F.max(row).alias("last"))
            .withColumn("n", F.lead("first").over(Window.orderBy("_pid"))))
    across = ends.where("last.g = n.g").select(F.col("last.v").alias("value"), F.col("n.v").alias("next"))
    return inside.where("n IS NOT NULL").select("value", F.col("n.v").alias("next")).union(across)


def keyed_prefix_sum(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                     values: Sequence[str], suffix: str = "_cum",
                     partitions: int | None = None) -> DataFrame:
    """Running sums of ``values`` per ``key`` in ``order`` (current row included).

    Two levels: a window over (range partition, key) - never larger than one
    range partition - plus the totals of earlier partitions of the same key.
    """
    key, order = _cols(key), _cols(order)
    staged = _ranged(df, key + order, partitions)
    local_w = (Window.partitionBy("_pid", *key).orderBy(*order)
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for v in values:
        staged = staged.withColumn(f"_loc_{v}", F.sum(v).over(local_w))
    totals = staged.groupBy("_pid", *key).agg(*[F.sum(v).alias(f"_tot_{v}") for v in values])
    carry_w = Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "_pid", *key,
        *[F.coalesce(F.sum(f"_tot_{v}").over(carry_w), F.lit(0)).alias(f"_carry_{v}") for v in values])
    out = _join_on(staged, totals, ["_pid", *key])
    for v in values:
        out = out.withColumn(f"{v}{suffix}", F.col(f"_carry_{v}") + F.col(f"_loc_{v}"))
    return out.drop("_pid", "_local", *[f"_loc_{v}" for v in values],
                    *[f"_carry_{v}" for v in values])
