"""Exponentially decaying window over a mention stream.

Two semantics (``mode``):

* ``as_written`` - each micro-batch stands alone (the carried state is
  never read), the first element of a batch decays once more than the rule
  says, and weights are rounded half-to-even to integers;
* ``published`` - every arrival multiplies all weights by ``(1 - c)`` and adds
  1 to the arriving element, carried across batches.

Both are closed forms over positions, so no sequential fold is needed:
within a batch of ``n`` rows the element at 0-based position ``i`` contributes
``(1-c)^(n-1-i+[i=0])`` (as written) and across batches the carried weight is
a decayed prefix sum, evaluated per epoch of bounded exponent (see
``carried_weights``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netstream.operators.indexing import keyed_prefix_sum, row_index
from netstream.session import cut_lineage

DECAY_C = 1e-6   # fixed value: the reference's decay constant
TOP_K = 5        # fixed value: rows shown per batch


# ---------------------------------------------------------------------------
# parsing
# ---------------------------------------------------------------------------

def parse_mention_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``<date> <time>,<mention>[,...]`` -> ``mention`` (second space token,
    second comma field; NULL for short or header lines), ``time_text`` (first
    comma field of the second whitespace token) and ``ts`` (TIMESTAMP_NTZ of
    date and time, NULL if it does not parse)."""
    v = F.col(value)
    mention = F.get(F.split(F.get(F.split(v, " "), 1), ","), 1)
    ws = F.split(F.trim(v), r"\s+")
    time_text = F.get(F.split(F.get(ws, 1), ","), 0)
    date_text = F.get(ws, 0)
    ts = F.try_to_timestamp(F.concat_ws(" ", date_text, time_text),
                            F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return lines.withColumn("mention", mention).withColumn("time_text", time_text) \
                .withColumn("ts_parsed", ts)


def mention_lines(events: DataFrame) -> DataFrame:
    """Text lines in the replayed CSV shape built from ``events``."""
    return events.select(
        "event_id",
        F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"),
                 F.lit(","), F.col("event_type")).alias("value"))


# ---------------------------------------------------------------------------
# positions
# ---------------------------------------------------------------------------

def with_batch_positions(mentions: DataFrame, batch: str = "batch_id",
                         order: tuple[str, ...] = ("ts", "seq")) -> DataFrame:
    """Adds ``i`` (0-based position inside the batch) and ``n`` (batch
    size).  Positions come from range partitions over (batch, order), so an
    oversized batch is still split across tasks."""
    ranked = row_index(mentions, order=list(order), group=batch, index_col="i")
    sizes = mentions.groupBy(batch).agg(F.count(F.lit(1)).alias("n"))
    return ranked.join(sizes, batch)


# ---------------------------------------------------------------------------
# One batch
# ---------------------------------------------------------------------------

def batch_weights(mentions: DataFrame, c: float = DECAY_C, mode: str = "as_written",
                  batch: str = "batch_id") -> DataFrame:
    """Per ``(batch_id, mention)``: the decayed weight of the batch alone.

    Output ``(batch_id, mention, weight DOUBLE, weight_int BIGINT)`` where
    ``weight_int`` is the half-to-even rounding the reference stores.
    """
    if mode not in ("as_written", "published"):
        raise ValueError("mode must be 'as_written' or 'published'")
    pos = with_batch_positions(mentions.where(F.col("mention").isNotNull()), batch=batch)
    expo = F.col("n") - 1 - F.col("i")
    if mode == "as_written":
        expo = expo + F.when(F.col("i") == 0, 1).otherwise(0)
    contrib = F.pow(F.lit(1.0 - c), expo.cast("double"))
    agg = pos.groupBy(batch, "mention").agg(F.sum(contrib).alias("weight"))
    return agg.select(F.col(batch).alias("batch_id"), "mention", "weight",
                      F.bround("weight", 0).cast("long").alias("weight_int"))


# ---------------------------------------------------------------------------
# ranking
# ---------------------------------------------------------------------------

def top_k_per_batch(weights: DataFrame, k: int = TOP_K, weight: str = "weight") -> DataFrame:
    """First ``k`` rows of each batch by weight descending (mention as the
    tie-break).  ``row_number() <= k`` is planned with a window group limit,
    so each partition keeps only k rows per batch before the shuffle."""
    w = Window.partitionBy("batch_id").orderBy(F.col(weight).desc(), F.col("mention"))
    return (weights.withColumn("rank", F.row_number().over(w))
                   .where(F.col("rank") <= k))


# ---------------------------------------------------------------------------
# Carried (published) decaying window
# ---------------------------------------------------------------------------

def carried_weights(mentions: DataFrame, c: float = DECAY_C, batch: str = "batch_id",
                    order: tuple[str, ...] = ("ts", "seq"),
                    max_exponent: float = 500.0) -> DataFrame:
    """Weight of every mention at the end of each batch it appears in:
    ``W_b(e) = sum over arrivals j of e up to the end of batch b of
    (1-c)^(G_b - g_j)``, ``g`` the global position, ``G_b`` the last position
    of batch b.

    Evaluated as a decayed prefix sum without a sequential fold: positions
    are cut into epochs of ``E = max_exponent / -ln(1-c)`` positions; inside
    an epoch the sum is rescaled by ``exp(lambda (g - epoch start))`` (at most
    ``e^max_exponent``, no overflow); the previous epoch's last value is
    carried explicitly; anything older is decayed by more than
    ``e^-max_exponent`` and below double precision.
    """
    if max_exponent < 40.0 or max_exponent > 700.0:
        raise ValueError("max_exponent must lie in [40, 700]: below 40 the dropped terms "
                         "are not negligible, above 700 exp() overflows")
    lam = -math.log1p(-c)
    epoch_len = max(1, int(max_exponent / lam))
    m = mentions.where(F.col("mention").isNotNull())
    pos = row_index(m, order=list(order), index_col="gpos")
    ends = pos.groupBy(batch).agg(F.max("gpos").alias("gend"))
    dist = (F.col("gend") - F.col("gpos")).cast("double")
    per = (pos.join(ends, batch)
              .groupBy(batch, "mention", "gend")
              .agg(F.sum(F.exp(-lam * dist)).alias("local")))
    per = per.withColumn("q", F.floor(F.col("gend") / epoch_len).cast("long"))
    since_ref = (F.col("gend") - F.col("q") * epoch_len).cast("double")
    # by range partitions: a mention of every batch is no hot task
    per = keyed_prefix_sum(per.withColumn("scaled", F.col("local") * F.exp(lam * since_ref)), ["mention", "q"], "gend", ["scaled"])
    per = per.withColumn("in_epoch", F.col("scaled_cum") * F.exp(-lam * since_ref)).drop("scaled", "scaled_cum", "local")
    # read twice (rows, and each epoch's last value): write once
    per = cut_lineage(per, name="decay-epochs")
    last = (per.groupBy("mention", "q")
               .agg(F.max(F.struct("gend", "in_epoch")).alias("last"))
               .select("mention", (F.col("q") + 1).alias("q"),
                       F.col("last.gend").alias("gend_prev"),
                       F.col("last.in_epoch").alias("w_prev")))
    out = per.join(last, ["mention", "q"], "left")
    carry = F.coalesce(
        F.col("w_prev") * F.exp(-lam * (F.col("gend") - F.col("gend_prev")).cast("double")),
        F.lit(0.0))
    return out.select(F.col(batch).alias("batch_id"), "mention",
                      (F.col("in_epoch") + carry).alias("weight"))


# ---------------------------------------------------------------------------
# Replay batches
# ---------------------------------------------------------------------------

def replay_batches(lines: DataFrame, order: str = "event_id", rows_per_second: float = 1.0,
                   trigger_seconds: float = 5.0, stop_after_seconds: float | None = None) -> DataFrame:
    """Replay schedule of a file: row ``idx`` is sent at ``idx / rate``
    seconds and lands in micro-batch ``floor(send_s / trigger)``.  With
    ``stop_after_seconds`` the replay stops like the reference's server
    (a feature of the source, off by default: the whole file is replayed)."""
    idx = row_index(lines, order=order, index_col="replay_idx")
    send = F.col("replay_idx") / F.lit(float(rows_per_second))
    out = idx.withColumn("send_s", send).withColumn(
        "batch_id", F.floor(F.col("send_s") / F.lit(float(trigger_seconds))).cast("long"))
    if stop_after_seconds is not None:
        out = out.where(F.col("send_s") < F.lit(float(stop_after_seconds)))
    return out
