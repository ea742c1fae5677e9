"""Streaming jobs.

Each ``start_*`` takes a streaming DataFrame, a sink folder, a checkpoint
folder and a trigger (``{"processingTime": "5 seconds"}`` by default,
``{"availableNow": True}``, ...) and returns the running ``StreamingQuery``.
Results are written per micro-batch into ``<sink>/batch_id=<id>`` with
overwrite, so a batch that is run again replaces its own output.

``replayed`` runs such a job over a table, replayed through the file source
until it is used up, and returns what the sink then holds.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from netstream.functions.dgim import WINDOW_N
from netstream.operators import decay as D
from netstream.operators.bits import parse_bits, relative_error
from netstream.session import remove_scratch, scratch_dir
from netstream.streaming.sources import FILES_PER_TRIGGER, ROWS_PER_FILE, epochs_per_file, in_epochs, replay_stream, stage_replay
from netstream.streaming.stateful import decay_stream, dgim_stream, states_by_key, window_counts_stream

TRIGGER = {"processingTime": "5 seconds"}  # fixed value: the reference's batch length


def _start(writer, checkpoint: str, trigger: dict | None, spark: SparkSession) -> StreamingQuery:
    """Start the query.  The number of state-store partitions is fixed when a
    query first starts; it is set to the cluster's default parallelism (not the
    batch-oriented shuffle setting), then the session setting is restored."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or TRIGGER)).start()
    finally:
        spark.conf.set(key, old)


def _per_batch(sink: str, fn: Callable):
    """foreachBatch body writing ``fn(df, batch_id)`` to ``sink/batch_id=<id>``.
    The batch is kept for the several uses ``fn`` may make of it, so a state
    operator above it runs once."""
    def body(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            fn(df, batch_id).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        finally:
            df.unpersist()
    return body


EPOCH = ", epoch LONG"  # of the sinks of jobs that report per epoch


def _epoch(df: DataFrame) -> list[str]:
    """The column of the epochs, if the stream has one."""
    return [c for c in ("epoch",) if c in df.columns]


def read_sink(spark: SparkSession, sink: str, schema: str) -> DataFrame:
    """All batches of a sink (with ``batch_id``); an unreadable sink is an
    error, a sink without a batch is empty."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sink)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder) or not len(fs.listStatus(folder)):
        return spark.createDataFrame([], f"{schema}, batch_id LONG")
    return spark.read.schema(f"{schema}, batch_id LONG").parquet(sink)


def replayed(spark: SparkSession, table: DataFrame, order: str, start: Callable, schema: str,
             rows_per_file: int = ROWS_PER_FILE, files_per_trigger: int = FILES_PER_TRIGGER,
             before_end: Callable = lambda checkpoint: None, epoch_rows: int | None = None) -> DataFrame:
    """``start(stream, sink, checkpoint, trigger)`` over ``table`` replayed in
    ``order`` until it is used up; what the sink holds.  ``before_end`` sees the
    checkpoint before it is deleted.

    With ``epoch_rows`` the stream has a column ``epoch`` (``in_epochs``) and a file
    holds whole epochs, the more the longer the table: a micro-batch costs about a
    second however few rows it has, so their number must not grow with the table.
    Jobs that report per batch then report per epoch."""
    source, sink, checkpoint = (scratch_dir(spark, f"replay-{c}") for c in ("source", "sink", "checkpoint"))
    if epoch_rows:
        table, epochs = in_epochs(table, order, epoch_rows)
        stage_replay(table, "epoch", source, epochs_per_file(epochs))
    else:
        stage_replay(table, order, source, rows_per_file)
    query = start(replay_stream(spark, source, table.schema, files_per_trigger), sink, checkpoint, {"availableNow": True})
    if query is not None:  # else ``start`` has waited for it
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    before_end(checkpoint)
    for folder in (source, checkpoint):
        remove_scratch(spark, folder)
    return read_sink(spark, sink, schema)


# ---------------------------------------------------------------------------
# T4 / K1 / K2: DGIM on a stream
# ---------------------------------------------------------------------------

DGIM_SCHEMA = {
    "published": "key LONG, seq LONG, n_buckets LONG, bucket_sum LONG, estimate LONG",
    "as_written": "key LONG, seq LONG, real_count LONG, n_buckets LONG, bucket_sum LONG, discarded LONG, estimate DOUBLE"}
REPORT_SCHEMA = "key LONG, real_count LONG, estimate DOUBLE, rel_error DOUBLE"


def start_dgim(bits: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None,
               mode: str = "published") -> StreamingQuery:
    """DGIM state after every bit of a stream ``(key, seq, bit)``, folded in the
    state store (equal to the batch ``dgim``)."""
    writer = dgim_stream(bits, mode=mode).writeStream.foreachBatch(_per_batch(sink, lambda df, _: df))
    return _start(writer, checkpoint, trigger, bits.sparkSession)


def batch_report(state: DataFrame) -> DataFrame:
    """The reference's report for one micro-batch (or each of its epochs): per
    stream the real count, the as-written estimate and its signed relative error
    after the last bit."""
    epoch = _epoch(state)
    last = state.groupBy("key", *epoch).agg(F.max(F.struct("seq", "real_count", "estimate")).alias("s"))
    return last.select("key", F.col("s.real_count").alias("real_count"), F.col("s.estimate").alias("estimate"),
                       F.round(relative_error(F.col("s.real_count"), F.col("s.estimate")), 6).alias("rel_error"), *epoch)


def start_bit_report(bits: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """K2: ``batch_report`` after every micro-batch."""
    writer = dgim_stream(bits, mode="as_written").writeStream.foreachBatch(
        _per_batch(sink, lambda df, _: batch_report(df)))
    return _start(writer, checkpoint, trigger, bits.sparkSession)


def start_bits(bits: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The bits of a source as they come."""
    return _start(bits.writeStream.foreachBatch(_per_batch(sink, lambda df, _: df)), checkpoint, trigger, bits.sparkSession)


COUNTS_SCHEMA = "key LONG, seq LONG, pos LONG, ones_running LONG"


def start_window_bits(bits: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None,
                      windows: dict[str, int] | None = None) -> StreamingQuery:
    """Exact counts of the last bits after every bit, from a ring of bits in
    the state store."""
    counted = window_counts_stream(bits, windows or {"ones_last_n": WINDOW_N})
    return _start(counted.writeStream.foreachBatch(_per_batch(sink, lambda df, _: df)), checkpoint, trigger, bits.sparkSession)


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None) -> DataFrame:
    """K6: the state of a query as a table ``(key, value, partition_id)``, read
    from its checkpoint (``variable``: a named state of ``transformWithState``).  States
    that are held by slots of keys are told per key."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
    state = (reader.option("stateVarName", variable) if variable else reader).load()
    if "user_map_key" in state.columns:  # a map per slot
        return state.select(F.col("user_map_key").alias("key"), F.col("user_map_value").alias("value"), "partition_id")
    return states_by_key(state) if "slot" in state.select("key.*").columns else state


# ---------------------------------------------------------------------------
# T5: decaying window on a stream
# ---------------------------------------------------------------------------

DECAY_SCHEMA = "mention STRING, weight DOUBLE"
TOPK_SCHEMA = "rank INT, mention STRING, weight_int LONG"


def start_decay(mentions: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None,
                c: float = D.DECAY_C, drop_below: float = 0.0) -> StreamingQuery:
    """Published decaying window over a stream ``(seq, mention)``, ``seq`` the
    global arrival position: per micro-batch the weight of each of its mentions
    at the batch's last arrival.

    A batch is summed per mention by Spark before it meets the weights carried
    so far, which are a table beside the checkpoint, one version per batch
    (the version before is read, older ones go); a batch that is run again
    starts from the same version.  Mentions whose weight falls below
    ``drop_below`` (the published rule: 1/2) leave the table, so it does not
    grow with every mention ever seen; 0 keeps them all.

    A stream with a column ``epoch`` gives the weights of each epoch's mentions at
    the epoch's last arrival, and drops at each epoch's end: a micro-batch is summed
    per epoch and mention, and a mention's few sums are folded in order."""
    spark, lam = mentions.sparkSession, -math.log1p(-c)
    schema = "mention STRING, weight DOUBLE, end_seq LONG"
    epoch = _epoch(mentions)

    def carried(version: int) -> str:
        return f"{checkpoint}-weights/version={version}"

    def update(df: DataFrame, batch_id: int) -> DataFrame:
        df = df if epoch else df.withColumn("epoch", F.lit(batch_id).cast("long"))
        ends = df.where(F.col("seq").isNotNull()).groupBy("epoch").agg(F.max("seq").alias("end"))
        ends = sorted(tuple(r) for r in ends.collect())  # a row per epoch of the micro-batch
        before = spark.read.schema(schema).parquet(carried(batch_id - 1)) if batch_id else spark.createDataFrame([], schema)
        if not ends:  # an empty batch changes nothing
            before.write.mode("overwrite").parquet(carried(batch_id))
            return spark.createDataFrame([], DECAY_SCHEMA + (EPOCH if epoch else ""))
        known = spark.createDataFrame([(e, end, ends[i - 1][1] if i else None) for i, (e, end) in enumerate(ends)],
                                      "epoch LONG, end LONG, end_before LONG")
        here = df.where(F.col("mention").isNotNull()).join(F.broadcast(known), "epoch").groupBy("mention", "epoch").agg(
            F.sum(F.exp(-lam * (F.col("end") - F.col("seq")).cast("double"))).alias("new"), F.max("end").alias("end"),
            F.max("end_before").alias("end_before"))
        steps = here.groupBy("mention").agg(F.sort_array(F.collect_list(F.struct("epoch", "end", "end_before", "new"))).alias("steps"))
        start = F.struct(F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("end_seq", F.lit(0).cast("long")).alias("end"),
                         F.expr("cast(array() as array<struct<epoch: bigint, weight: double, new: double>>)").alias("out"))
        both = steps.join(before, "mention", "full").select("mention", F.aggregate(
            F.coalesce("steps", F.expr("cast(array() as array<struct<epoch: bigint, end: bigint, end_before: bigint, new: double>>)")),
            start, _decay_step(lam, drop_below)).alias("now"))
        last = ends[-1][1]
        weight = F.col("now.weight") * F.exp(-lam * (F.lit(last) - F.col("now.end")).cast("double"))
        (both.select("mention", weight.alias("weight"), F.lit(last).cast("long").alias("end_seq"))
         .where(F.col("weight") >= drop_below).write.mode("overwrite").parquet(carried(batch_id)))
        if batch_id > 1:
            remove_scratch(spark, carried(batch_id - 2))
        return (both.select("mention", F.explode("now.out").alias("o")).where("o.new IS NOT NULL")
                .select("mention", F.col("o.weight").alias("weight"), *[F.col("o.epoch").alias(e) for e in epoch]))

    writer = mentions.select("seq", "mention", *epoch).writeStream.foreachBatch(_per_batch(sink, update))
    return _start(writer, checkpoint, trigger, spark)


def _decay_step(lam: float, drop_below: float):
    """A mention's weight from one of its epochs to the next: dropped if it was below
    the threshold at the end of the epoch before (a weight only falls until then)."""
    def step(state, x):
        def faded(until):
            return state["weight"] * F.exp(-lam * (until - state["end"]).cast("double"))
        held = F.when(faded(F.coalesce(x["end_before"], state["end"])) >= drop_below, faded(x["end"])).otherwise(0.0)
        weight = held + F.coalesce(x["new"], F.lit(0.0))
        return F.struct(weight.alias("weight"), x["end"].alias("end"), F.concat(state["out"], F.array(F.struct(
            x["epoch"].alias("epoch"), weight.alias("weight"), x["new"].alias("new")))).alias("out"))
    return step


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_decay_state(mentions: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None,
                      epoch_rows: int = FILES_PER_TRIGGER * ROWS_PER_FILE, c: float = D.DECAY_C,
                      drop_below: float = 0.0) -> StreamingQuery:
    """``start_decay`` with a state per mention (``decay_stream``): per epoch of
    ``epoch_rows`` arrivals the weights of its mentions at the epoch's last arrival.
    A micro-batch should hold whole epochs."""
    spark, lam = mentions.sparkSession, -math.log1p(-c)

    def at_ends(df: DataFrame, batch_id: int) -> DataFrame:
        ends = df.groupBy("epoch").agg(F.max("seq").alias("end"))  # one row per epoch of the batch
        return (df.where(F.col("mention").isNotNull()).join(F.broadcast(ends), "epoch")
                .select("epoch", "mention", (F.col("weight") * F.exp(-lam * (F.col("end") - F.col("seq")).cast("double")))
                        .alias("weight")))

    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)  # a query keeps the store it starts with
    try:
        states = decay_stream(mentions, epoch_rows, c, drop_below)
        return _start(states.writeStream.outputMode("append").foreachBatch(_per_batch(sink, at_ends)), checkpoint, trigger, spark)
    finally:
        spark.conf.set(key, old)


STATE_SCHEMA = "epoch LONG, mention STRING, weight DOUBLE"


def start_topk(mentions: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None,
               c: float = D.DECAY_C, k: int = D.TOP_K) -> StreamingQuery:
    """As written: every micro-batch of ``(seq, ts, mention)`` - or every epoch of
    it - stands alone; weights rounded half to even; the first ``k`` mentions of each
    (K3)."""
    epoch = _epoch(mentions)

    def top(df: DataFrame, batch_id: int) -> DataFrame:
        number = F.col("epoch") if epoch else F.lit(batch_id).cast("long")
        w = D.batch_weights(df.withColumn("batch_id", number), c=c, mode="as_written")
        return D.top_k_per_batch(w, k=k, weight="weight_int").select(
            "rank", "mention", "weight_int", *[F.col("batch_id").alias(e) for e in epoch])

    writer = mentions.writeStream.foreachBatch(_per_batch(sink, top))
    return _start(writer, checkpoint, trigger, mentions.sparkSession)


# ---------------------------------------------------------------------------
# Event-time tumbling windows
# ---------------------------------------------------------------------------

WINDOW_SCHEMA = "window_start TIMESTAMP_NTZ, mention STRING, n LONG"


def start_window_counts(mentions: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None,
                        window: str = "1 hour", watermark: str = "1 hour") -> StreamingQuery:
    """Mentions per event-time tumbling window (update mode with a watermark,
    so old windows leave the state store)."""
    counts = (mentions.where(F.col("mention").isNotNull()).withWatermark("ts", watermark)
              .groupBy(F.window("ts", window).alias("w"), "mention").agg(F.count(F.lit(1)).alias("n")))

    def keep(df: DataFrame, batch_id: int) -> DataFrame:
        return df.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "mention", "n")

    writer = counts.writeStream.outputMode("update").foreachBatch(_per_batch(sink, keep))
    return _start(writer, checkpoint, trigger, mentions.sparkSession)


SESSION_SCHEMA = "key LONG, session_start TIMESTAMP_NTZ, session_end TIMESTAMP_NTZ, n LONG"


def start_sessions(events: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None,
                   gap: str = "30 minutes", watermark: str = "1 hour") -> StreamingQuery:
    """Sessions of a stream ``(key, ts, seq)`` - events of a key with less
    than ``gap`` between neighbours - written when the watermark has passed their
    end.  An event that arrives twice (same ``seq`` within the watermark) counts
    once; late events are dropped and counted (``StreamMetrics``)."""
    sessions = (events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["seq"])
                .groupBy("key", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")))

    def keep(df: DataFrame, batch_id: int) -> DataFrame:
        return df.select("key", F.col("w.start").cast("timestamp_ntz").alias("session_start"),
                         F.col("w.end").cast("timestamp_ntz").alias("session_end"), "n")

    writer = sessions.writeStream.outputMode("append").foreachBatch(_per_batch(sink, keep))
    return _start(writer, checkpoint, trigger, events.sparkSession)


# ---------------------------------------------------------------------------
# Raw lines, rejects counted
# ---------------------------------------------------------------------------

LINES = "lines"  # name of the observed metrics


class StreamMetrics(StreamingQueryListener):
    """Metrics of the micro-batches of one query, as its progress reports them:
    ``batches[id]`` holds the observed metrics, rows in, and rows that came too late
    (one entry per batch; ``keep`` bounds how many are held)."""

    def __init__(self, keep: int = 10_000):
        self.query, self.keep, self.batches, self.ended = None, keep, {}, False

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.query is not None and str(progress.id) == self.query:
            found = {name: row.asDict() for name, row in progress.observedMetrics.items()}
            late = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
            if progress.numInputRows or late:
                self.batches[progress.batchId] = {"rows": progress.numInputRows, "late": late, **found}
            while len(self.batches) > self.keep:
                del self.batches[min(self.batches)]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended = self.ended or str(event.id) == self.query


def watched(spark: SparkSession, start: Callable, timeout: float = 60.0) -> dict[int, dict]:
    """Run the query that ``start()`` returns until it ends; its metrics by
    micro-batch."""
    metrics = StreamMetrics()
    spark.streams.addListener(metrics)
    try:
        query = start(metrics)
        metrics.query = str(query.id)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        until = time.monotonic() + timeout
        while not metrics.ended and time.monotonic() < until:  # events arrive after the query
            time.sleep(0.05)
        return metrics.batches
    finally:
        spark.streams.removeListener(metrics)


MENTION_SCHEMA = "mention STRING, time_text STRING, ts_parsed TIMESTAMP_NTZ"


def start_mention_lines(lines: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """W1 on a stream of text lines ``value``: mentions go to the sink, a line
    without a mention or time is rejected; both are counted per micro-batch as the
    observed metrics ``LINES``."""
    parsed = D.parse_mention_lines(lines)
    bad = F.col("mention").isNull() | F.col("ts_parsed").isNull()
    seen = parsed.withColumn("_bad", bad).observe(
        LINES, F.count(F.lit(1)).alias("n_lines"), F.coalesce(F.sum(F.col("_bad").cast("long")), F.lit(0)).alias("n_rejected"))
    return _start_lines(seen, ["mention", "time_text", "ts_parsed"], sink, checkpoint, trigger)


def _start_lines(seen: DataFrame, columns: list[str], sink: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """The ``columns`` of lines that are not ``_bad`` go to the sink; of a stream with
    a column ``epoch``, the lines and the bad ones of each epoch to ``lines_of(sink)``."""
    epoch = _epoch(seen)

    def keep(df: DataFrame, batch_id: int) -> DataFrame:
        if epoch:
            (df.groupBy("epoch").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("_bad").cast("long")).alias("n_rejected"))
             .write.mode("overwrite").parquet(f"{lines_of(sink)}/batch_id={batch_id}"))
        return df.where(~F.col("_bad")).select(columns)

    return _start(seen.select(*columns, "_bad", *epoch).writeStream.foreachBatch(_per_batch(sink, keep)), checkpoint, trigger,
                  seen.sparkSession)


def lines_of(sink: str) -> str:
    """The folder of the line counts beside a sink."""
    return f"{sink}-lines"


def start_bit_lines(lines: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """B1 on a stream of text lines ``value``: whole numbers go to the sink as
    bits, anything else is rejected and counted as ``LINES``."""
    seen = parse_bits(lines).withColumn("_bad", ~F.col("valid")).observe(
        LINES, F.count(F.lit(1)).alias("n_lines"), F.coalesce(F.sum(F.col("_bad").cast("long")), F.lit(0)).alias("n_rejected"))
    return _start_lines(seen, ["bit"], sink, checkpoint, trigger)


def line_counts(spark: SparkSession, lines: DataFrame, order: str, start: Callable, schema: str,
                epoch_rows: int = FILES_PER_TRIGGER * ROWS_PER_FILE) -> DataFrame:
    """``(batch_id, n_lines, n_rejected)`` of a replay of ``lines(order, value)``
    through ``start``, a row per epoch of ``epoch_rows`` lines."""
    sinks = []

    def begin(stream, sink, checkpoint, trigger):
        sinks.append(sink)
        watched(spark, lambda _: start(stream, sink, checkpoint, trigger))

    replayed(spark, lines, order, begin, schema, epoch_rows=epoch_rows)
    counts = read_sink(spark, lines_of(sinks[0]), "n_lines LONG, n_rejected LONG" + EPOCH)
    # an epoch that a restart cut in two has a row in each micro-batch
    return counts.groupBy(F.col("epoch").alias("batch_id")).agg(F.sum("n_lines").alias("n_lines"), F.sum("n_rejected").alias("n_rejected"))


def top_per_window(updates: DataFrame, k: int = D.TOP_K) -> DataFrame:
    """The first ``k`` mentions of each window from the final counts."""
    final = updates.groupBy("window_start", "mention").agg(F.max("n").alias("n"))
    rank = Window.partitionBy("window_start").orderBy(F.col("n").desc(), F.col("mention"))
    return (final.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("window_start", "rank", "mention", "n"))
