import os

from pyspark.sql import functions as F

from conftest import SF001
from netstream.operators import bits as B
from netstream.operators import decay as D
from netstream.session import scratch_dir
from netstream.sources.tables import bit_events, mention_events, read_table
from netstream.streaming import queries as SQ
from netstream.streaming.sources import replay_stream, stage_replay


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stage_replay_is_one_file_per_range_in_order(spark):
    bits = bit_events(read_table(spark, SF001, "events"))
    path = scratch_dir(spark, "staged")
    stage_replay(bits, "seq", path, rows_per_file=300)
    files = sorted((f for d, _, fs in os.walk(path) for f in (os.path.join(d, x) for x in fs) if f.endswith(".parquet")),
                   key=os.path.getmtime)
    ranges = [spark.read.parquet(f).agg(F.min("seq"), F.max("seq")).first() for f in files]
    assert [tuple(r) for r in ranges] == [(0, 299), (300, 599), (600, 899), (900, 999)]


def test_stream_dgim_equals_batch(spark):
    bits = bit_events(read_table(spark, SF001, "events"))
    bits = bits.withColumn("key", F.when(F.col("key") % 5 != 0, F.col("key")))  # a NULL stream
    for mode, cols in [("published", ["seq", "n_buckets", "estimate"]),
                       ("as_written", ["seq", "real_count", "discarded", "estimate"])]:
        s = SQ.replayed(spark, bits, "seq", lambda *a, m=mode: SQ.start_dgim(*a, mode=m), SQ.DGIM_SCHEMA[mode],
                        rows_per_file=100, files_per_trigger=3)
        b = B.dgim(bits, mode=mode)
        assert _rows(s, cols) == _rows(b, cols)
        assert s.where("key IS NULL").count() == b.where("key IS NULL").count() > 0


def test_stream_decay_equals_batch(spark):
    men = mention_events(read_table(spark, SF001, "events"), batch_rows=250)
    s = SQ.replayed(spark, men, "seq", lambda *a: SQ.start_decay(*a, c=0.01), SQ.DECAY_SCHEMA, 125, 2)
    b = D.carried_weights(men, c=0.01)
    got = {(r.batch_id, r.mention): r.weight for r in s.collect()}
    exp = {(r.batch_id, r.mention): r.weight for r in b.collect()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-9 for k in exp)


def test_dropped_weights_leave_the_state(spark):
    """A mention that decayed below the threshold starts anew."""
    rows = [(i, "once" if i in (0, 250) else f"m{i % 3}") for i in range(300)]
    men = spark.createDataFrame(rows, "seq LONG, mention STRING")
    got = {drop: {(r.batch_id, r.mention): r.weight for r in SQ.replayed(
        spark, men, "seq", lambda *a, d=drop: SQ.start_decay(*a, c=0.01, drop_below=d), SQ.DECAY_SCHEMA, 50, 2).collect()}
        for drop in (0.0, 0.5)}
    # its weight at the first batch's end is 0.99^99 < 1/2
    assert abs(got[0.0][(2, "once")] - (0.99 ** 49 + 0.99 ** 299)) < 1e-9
    assert abs(got[0.5][(2, "once")] - 0.99 ** 49) < 1e-9


def test_live_jobs_return_the_query_and_take_empty_batches(spark):
    """Each job on a stream whose only file has no rows: it runs, stops, and
    its sink is readable."""
    men = mention_events(read_table(spark, SF001, "events")).select("seq", "ts", "mention").limit(0)
    bits = bit_events(read_table(spark, SF001, "events")).limit(0)
    jobs = [(bits, SQ.start_dgim, SQ.DGIM_SCHEMA["published"]), (bits, SQ.start_bit_report, SQ.REPORT_SCHEMA),
            (men, SQ.start_decay, SQ.DECAY_SCHEMA), (men, SQ.start_topk, SQ.TOPK_SCHEMA),
            (men, SQ.start_window_counts, SQ.WINDOW_SCHEMA)]
    for table, start, schema in jobs:
        source, sink, checkpoint = (scratch_dir(spark, c) for c in ("empty", "sink", "checkpoint"))
        table.coalesce(1).write.parquet(source)
        q = start(replay_stream(spark, source, table.schema), sink, checkpoint, {"processingTime": "1 second"})
        assert q.isActive
        q.processAllAvailable()
        q.stop()
        assert q.exception() is None
        assert SQ.read_sink(spark, sink, schema).count() == 0


def test_stream_restart_from_checkpoint(spark):
    """Stop after some micro-batches, add the rest of the data, restart from
    the same checkpoint: the final answer equals the batch form."""
    bits = bit_events(read_table(spark, SF001, "events"))
    source, sink, checkpoint = (scratch_dir(spark, c) for c in ("restart-src", "restart-sink", "restart-ckpt"))

    def run():
        SQ.start_dgim(replay_stream(spark, source, bits.schema, 2), sink, checkpoint, {"availableNow": True}).awaitTermination()

    stage_replay(bits.where(F.col("seq") < 500), "seq", source, 100)
    run()
    first = SQ.read_sink(spark, sink, SQ.DGIM_SCHEMA["published"]).count()
    stage_replay(bits.where(F.col("seq") >= 500), "seq", source, 100)
    run()
    out = SQ.read_sink(spark, sink, SQ.DGIM_SCHEMA["published"])
    assert first < out.count()
    cols = ["key", "seq", "n_buckets", "estimate"]
    assert _rows(out, cols) == _rows(B.dgim(bits, mode="published"), cols)


def test_exact_windows_on_a_stream_and_after_a_restart(spark):
    """The ring of bits: equal to the batch counts, with a NULL stream, windows
    longer than some streams and a restart in between."""
    bits = bit_events(read_table(spark, SF001, "events"))
    bits = bits.withColumn("key", F.when(F.col("key") % 5 != 0, F.col("key")))
    windows = {"w3": 3, "w24": 24, "w500": 500}
    schema = SQ.COUNTS_SCHEMA + "".join(f", {w} LONG" for w in windows)
    source, sink, checkpoint = (scratch_dir(spark, c) for c in ("ring-src", "ring-sink", "ring-ckpt"))
    for part in (bits.where("seq < 430"), bits.where("seq >= 430")):
        stage_replay(part, "seq", source, 100)
        SQ.start_window_bits(replay_stream(spark, source, bits.schema, 2), sink, checkpoint, {"availableNow": True},
                             windows).awaitTermination()
    cols = ["seq", "pos", "ones_running", *windows]
    out = SQ.read_sink(spark, sink, schema)
    assert _rows(out, cols) == _rows(B.ones_counts(bits, windows=windows), cols)
    state = SQ.read_state(spark, checkpoint).select("value.groupState.*")
    assert state.agg(F.sum("t"), F.max("held")).first()[0] == bits.count()
    assert state.where("length(ring) > 63").count() == 0


def test_state_reader_shows_the_buckets(spark):
    """The state of ``stream_dgim`` in the store is the last row of each stream."""
    bits = bit_events(read_table(spark, SF001, "events"))
    held = {}

    def keep(checkpoint):
        for r in SQ.read_state(spark, checkpoint).select("key.key", "value.groupState.*").collect():
            held[r.key] = (r.t, r.total, len(r.recent))

    SQ.replayed(spark, bits, "seq", SQ.start_dgim, SQ.DGIM_SCHEMA["published"], 100, 3, before_end=keep)
    last = {}
    for r in B.dgim(bits).orderBy("seq").collect():
        last[r.key] = (last.get(r.key, (0,))[0] + 1, r.bucket_sum)
    assert {k: v[:2] for k, v in held.items()} == last
    assert all(length == min(t, 24) for t, _, length in held.values())


def test_decay_state_expires_and_follows_the_batch(spark):
    """A state per mention: the weights of the table form, arrivals without a
    mention, expiry by timers, and a micro-batch that writes its own mentions only."""
    rows = [(i, None if i % 50 == 7 else "once" if i in (0, 250) else f"m{i // 100}x{i % 3}") for i in range(400)]
    men = spark.createDataFrame(rows, "seq LONG, mention STRING")
    for drop in (0.0, 0.5):
        want = {(r.batch_id, r.mention): r.weight for r in SQ.replayed(
            spark, men, "seq", lambda *a, d=drop: SQ.start_decay(*a, c=0.05, drop_below=d), SQ.DECAY_SCHEMA, 50, 2).collect()}
        source, sink, checkpoint = (scratch_dir(spark, c) for c in ("decay-src", "decay-sink", "decay-ckpt"))
        stage_replay(men, "seq", source, 50)
        query = SQ.start_decay_state(replay_stream(spark, source, men.schema, 2), sink, checkpoint, {"availableNow": True},
                                     epoch_rows=100, c=0.05, drop_below=drop)
        query.awaitTermination()
        got = {(r.epoch, r.mention): r.weight for r in SQ.read_sink(spark, sink, SQ.STATE_SCHEMA).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        held = {r.key.mention for r in SQ.read_state(spark, checkpoint, variable="weight").collect()}
        if drop:
            assert len(held) < 7  # the first epochs' mentions left the store
        else:
            assert len(held) == 13
            batches = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
            assert [b["numRowsUpdated"] for b in batches] == [4, 3, 4, 3]  # a batch's mentions, not all that were seen


def test_rejected_lines_are_counted_per_batch(spark):
    """Header, short and undated lines of the mention stream, and text among
    bits, are counted and kept out of the sink."""
    texts = ["2024-01-01 00:00:01,view", "date time,mention", "2024-01-01 00:00:02", "", "2024-13-01 00:00:02,view", "x y,z",
             "2024-01-01 00:00:03,click,more"]
    lines = spark.createDataFrame([(i, texts[i % len(texts)]) for i in range(70)], "seq LONG, value STRING")
    counts = SQ.line_counts(spark, lines, "seq", SQ.start_mention_lines, SQ.MENTION_SCHEMA).collect()
    want = {b: sum(texts[i % len(texts)] not in (texts[0], texts[-1]) for i in range(70) if i // 4000 == b) for b in (0,)}
    assert {(r.batch_id, r.n_lines): r.n_rejected for r in counts} == {(0, 70): want[0]}
    kept = SQ.replayed(spark, lines, "seq", SQ.start_mention_lines, SQ.MENTION_SCHEMA)
    assert {r.mention for r in kept.collect()} == {"view", "click"} and kept.count() == 70 - want[0]
    bits = spark.createDataFrame([(i, v) for i, v in enumerate(["1", "0", " 1 ", "x", "", None, "7"])], "seq LONG, value STRING")
    batches = SQ.line_counts(spark, bits, "seq", SQ.start_bit_lines, "bit INT").collect()
    assert [tuple(r) for r in batches] == [(0, 7, 3)]
    assert sorted(r.bit for r in SQ.replayed(spark, bits, "seq", SQ.start_bit_lines, "bit INT").collect()) == [0, 0, 1, 1]


def test_sessions_count_repeated_events_once_and_late_ones(spark):
    """Events twice within the watermark count once; an event far behind the
    watermark is dropped and counted; open sessions are not written."""
    minute = [0, 10, 25, 60, 61, 300, 10, 305, 600]  # the seventh row comes far too late
    rows = [(i, 1, m) for i, m in enumerate(minute)] + [(3, 1, 60), (40, 2, 90)]
    table = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "ord LONG, seq LONG, key LONG, m LONG").select(
        "ord", "seq", "key", F.timestamp_seconds(F.col("m") * 60 + 86_400).alias("ts"))
    source, sink, checkpoint = (scratch_dir(spark, c) for c in ("session-src", "session-sink", "session-ckpt"))
    late = {}
    for batch in ("ord in (0, 1, 2, 3, 9)", "ord in (4, 10)", "ord = 5", "ord = 6", "ord in (7, 8)"):
        stage_replay(table.where(batch), "ord", source, 100)
        found = SQ.watched(spark, lambda _: SQ.start_sessions(
            replay_stream(spark, source, table.schema), sink, checkpoint, {"availableNow": True}, "30 minutes", "1 hour"))
        late.update({b: m["late"] for b, m in found.items() if m["late"]})
    out = SQ.read_sink(spark, sink, SQ.SESSION_SCHEMA).collect()
    got = sorted((r.key, r.session_start.hour * 60 + r.session_start.minute, r.n) for r in out)
    assert got == [(1, 0, 3), (1, 60, 2), (1, 300, 2), (2, 90, 1)]
    assert sum(late.values()) == 1


def test_metrics_are_bounded(spark):
    metrics = SQ.StreamMetrics(keep=2)
    metrics.query = "q"

    class Event:
        def __init__(self, batch):
            self.progress = type("P", (), {"id": "q", "observedMetrics": {}, "stateOperators": [], "numInputRows": 1,
                                           "batchId": batch})
    for batch in range(5):
        metrics.onQueryProgress(Event(batch))
    assert sorted(metrics.batches) == [3, 4]


def test_random_bit_source_is_replayable(spark):
    """The source's bits are the batch operator's, its offers follow the clock,
    and a restarted query repeats and loses none."""
    import time

    from netstream.streaming import replay_source as RS
    rows = spark.range(500).withColumnRenamed("id", "seq")
    want = {(r.seq, r.bit) for r in B.random_bits(rows, "seq", p=0.3, seed=5).collect()}
    sink, checkpoint = (scratch_dir(spark, c) for c in ("bits-sink", "bits-ckpt"))
    for count in (180, 500):
        bits = RS.random_bit_stream(spark, rate=0, count=count, seed=5, partitions=3)
        SQ.start_bits(bits, sink, checkpoint, {"availableNow": True}).awaitTermination()
    out = SQ.read_sink(spark, sink, "seq LONG, bit INT").collect()
    assert len(out) == 500 and {(r.seq, r.bit) for r in out} == want
    reader = RS._BitReader({"rate": "10", "count": "1000", "start_ms": str(int(time.time() * 1000) - 2_000)})
    assert 20 <= reader.latestOffset()["bits"] <= 25
    assert [(r.begin, r.end) for r in reader.partitions({"bits": 3}, {"bits": 3})] == []


def test_line_source_replays_a_file_from_its_offset(spark, tmp_path):
    """At most the limit per micro-batch, in order; a restart goes on at the
    byte it stopped at; a line without an end waits."""
    from netstream.streaming import replay_source as RS
    lines = [f"2024-01-01 00:00:{i % 60:02d},m{i % 7}é" for i in range(95)]
    path = tmp_path / "lines.csv"
    path.write_text("\n".join(lines[:60]) + "\nunfinis", encoding="utf-8")
    sink, checkpoint = (scratch_dir(spark, c) for c in ("lines-sink", "lines-ckpt"))

    def run():
        stream = RS.replayed_lines(spark, str(path), 25)
        query = SQ.start_bits(stream, sink, checkpoint, {"processingTime": "0 seconds"})
        query.processAllAvailable()
        query.stop()
        assert query.exception() is None

    run()
    first = SQ.read_sink(spark, sink, "seq LONG, value STRING").collect()
    assert {r.seq: r.value for r in first} == dict(enumerate(lines[:60])) and len(first) == 60
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    run()
    out = SQ.read_sink(spark, sink, "seq LONG, value STRING").collect()
    assert {r.seq: r.value for r in out} == dict(enumerate(lines)) and len(out) == 95
    sizes = {}
    for r in out:
        sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
    assert max(sizes.values()) <= 25


def test_micro_batches_hold_many_epochs(spark):
    """A replay in epochs: reports per epoch equal those of a micro-batch per epoch,
    from fewer micro-batches, with weights dropped in between."""
    rows = [(i, 1, i % 3 % 2, None if i % 11 == 7 else "once" if i in (0, 45) else f"m{i // 20}x{i % 3}") for i in range(60)]
    table = spark.createDataFrame(rows, "seq LONG, key LONG, bit INT, mention STRING").withColumn(
        "ts", F.timestamp_seconds(F.col("seq")))
    bits, men = table.select("key", "seq", "bit"), table.select("seq", "ts", "mention")
    jobs = [(men, lambda *a: SQ.start_decay(*a, c=0.1, drop_below=0.5), SQ.DECAY_SCHEMA, ["mention"]),
            (men, lambda *a: SQ.start_topk(*a, c=0.1), SQ.TOPK_SCHEMA, ["rank", "mention", "weight_int"]),
            (bits, SQ.start_bit_report, SQ.REPORT_SCHEMA, ["key", "real_count", "estimate"])]
    for data, start, schema, cols in jobs:
        alone = SQ.replayed(spark, data, "seq", start, schema, 10, 1).withColumn("epoch", F.col("batch_id"))
        together = SQ.replayed(spark, data, "seq", start, schema + SQ.EPOCH, epoch_rows=10)
        assert together.agg(F.max("batch_id")).first()[0] == 1 and alone.agg(F.max("batch_id")).first()[0] == 5
        assert _rows(together, ["epoch", *cols]) == _rows(alone, ["epoch", *cols])
        if "weight" in alone.columns:
            want = {(r.epoch, r.mention): r.weight for r in alone.collect()}
            assert all(abs(r.weight - want[r.epoch, r.mention]) < 1e-9 for r in together.collect())


def test_micro_batches_do_not_grow_with_the_table(spark):
    from netstream.streaming import sources as S
    for epochs in (25, 1_500, 9_000):
        assert -(-epochs // (S.epochs_per_file(epochs) * S.FILES_PER_TRIGGER)) <= S.REPLAY_BATCHES
    assert S.epochs_per_file(10 ** 6) == S.EPOCHS_PER_FILE  # a micro-batch stays bounded
    lines = spark.createDataFrame([(i, "1" if i % 2 else "x") for i in range(130)] + [(None, "0")], "seq LONG, value STRING")
    counts = SQ.line_counts(spark, lines, "seq", SQ.start_bit_lines, "bit INT", epoch_rows=10)
    want = [(e, 10, 5) for e in range(13)] + [(100, 1, 0)]  # a line without a position comes last
    assert sorted(map(tuple, counts.collect())) == want


def test_many_streams_take_few_rows_of_the_store(spark):
    """Streams share calls and rows of the store by slot, and keep states of their own."""
    from netstream.streaming import stateful as S
    streams = 4 * S.SLOTS
    bits = spark.range(2 * streams).select((F.col("id") % streams).alias("key"), F.col("id").alias("seq"),
                                           (F.col("id") % 3 == 0).cast("int").alias("bit"))
    for mode in ("published", "as_written"):
        source, sink, checkpoint = (scratch_dir(spark, c) for c in ("slot-src", "slot-sink", "slot-ckpt"))
        stage_replay(bits, "seq", source, 1024)
        query = SQ.start_dgim(replay_stream(spark, source, bits.schema, 2), sink, checkpoint, {"availableNow": True}, mode=mode)
        query.awaitTermination()
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["numInputRows"]) <= S.SLOTS
        cols = ["key", "seq", "n_buckets", "bucket_sum", "estimate"]
        assert _rows(SQ.read_sink(spark, sink, SQ.DGIM_SCHEMA[mode]), cols) == _rows(B.dgim(bits, mode=mode), cols)
        state = SQ.read_state(spark, checkpoint).select("key.key", "value.groupState.t")
        assert state.agg(F.countDistinct("key"), F.min("t"), F.max("t")).first() == (streams, 2, 2)


def test_many_mentions_share_calls_and_expire(spark):
    """Far more mentions than slots, a heavy one among them: weights as in the table form,
    and only what has not expired stays in the store."""
    from netstream.streaming import stateful as S
    rows = spark.range(4_000).select(F.col("id").alias("seq"), F.when(F.col("id") % 4 == 0, "often").otherwise(
        F.concat(F.lit("m"), (F.col("id") % 1_500).cast("string"))).alias("mention"))
    want = {(r.batch_id, r.mention): r.weight for r in SQ.replayed(
        spark, rows, "seq", lambda *a: SQ.start_decay(*a, c=0.01, drop_below=0.5), SQ.DECAY_SCHEMA, 500, 2).collect()}
    source, sink, checkpoint = (scratch_dir(spark, c) for c in ("many-src", "many-sink", "many-ckpt"))
    stage_replay(rows, "seq", source, 500)
    query = SQ.start_decay_state(replay_stream(spark, source, rows.schema, 2), sink, checkpoint, {"availableNow": True},
                                 epoch_rows=1_000, c=0.01, drop_below=0.5)
    query.awaitTermination()
    got = {(r.epoch, r.mention): r.weight for r in SQ.read_sink(spark, sink, SQ.STATE_SCHEMA).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    held = {r.key.mention for r in SQ.read_state(spark, checkpoint, variable="weight").collect()}
    assert "often" in held and len(held) < len({m for _, m in want}) / 2
    assert S.SLOTS < len({m for _, m in want})
