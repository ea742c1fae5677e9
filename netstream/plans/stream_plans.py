"""Registered streaming queries: ``events`` replayed through the file source
with an ``availableNow`` trigger; results are read back from the sinks.
``BATCH_ROWS`` consecutive event ids are an epoch, for which results that are told per
batch are told; a micro-batch takes whole epochs, the more the longer the table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from netstream.functions.dgim import QUERY_K, WINDOW_N
from netstream.operators import decay as D
from netstream.plans.bit_plans import _B, _POW, _WIN, _as_written_cte, _published_cte
from netstream.plans.bit_plans import SQL as BIT_SQL
from netstream.session import cut_lineage, scratch_dir
from netstream.sources.tables import bit_events, mention_events, read_table
from netstream.streaming import queries as SQ
from netstream.streaming.replay_source import random_bit_stream
from netstream.streaming.sources import FILES_PER_TRIGGER, ROWS_PER_FILE

BATCH_ROWS = FILES_PER_TRIGGER * ROWS_PER_FILE
DROP_BELOW = 0.5  # fixed value: the published decaying window's threshold


def _bits(spark, sf_dir):
    return bit_events(read_table(spark, sf_dir, "events"))


def _mentions(spark, sf_dir):
    return mention_events(read_table(spark, sf_dir, "events")).select("seq", "ts", "mention")


def _replayed(*args, **options):
    return SQ.replayed(*args, epoch_rows=BATCH_ROWS, **options)


def q_stream_dgim(spark, sf_dir):
    out = _replayed(spark, _bits(spark, sf_dir), "seq", SQ.start_dgim, SQ.DGIM_SCHEMA["published"])
    return out.select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), "n_buckets", "bucket_sum", "estimate")


def q_stream_ones(spark, sf_dir):
    """Exact last N and last K of each stream after every bit."""
    windows = {"ones_last_n": WINDOW_N, "ones_last_k": QUERY_K}
    out = _replayed(spark, _bits(spark, sf_dir), "seq", partial(SQ.start_window_bits, windows=windows),
                      SQ.COUNTS_SCHEMA + "".join(f", {name} LONG" for name in windows))
    return out.select(F.col("key").alias("user_id"), F.col("seq").alias("event_id"), "pos", "ones_running", *windows)


def q_dgim_state(spark, sf_dir):
    """The buckets in the state store of ``stream_dgim`` when the stream ends."""
    kept = []

    def keep(checkpoint):
        state = SQ.read_state(spark, checkpoint).select("key.key", "value.groupState.t", "value.groupState.total")
        kept.append(cut_lineage(state, name="dgim-state"))

    _replayed(spark, _bits(spark, sf_dir), "seq", SQ.start_dgim, SQ.DGIM_SCHEMA["published"], before_end=keep)
    return kept[0].select(F.col("key").alias("user_id"), F.col("t").alias("bits"), F.col("total").alias("bucket_sum"))


def q_stream_bit_report(spark, sf_dir):
    out = _replayed(spark, _bits(spark, sf_dir), "seq", SQ.start_bit_report, SQ.REPORT_SCHEMA + SQ.EPOCH)
    return out.select(F.col("key").alias("user_id"), F.col("epoch").alias("micro_batch"), "real_count", "estimate",
                      "rel_error")


def _rounded(out):
    return out.select(F.col("epoch").alias("batch_id"), "mention", F.round("weight", 6).alias("weight"))


def q_stream_decay_carry(spark, sf_dir):
    return _rounded(_replayed(spark, _mentions(spark, sf_dir), "seq", SQ.start_decay, SQ.DECAY_SCHEMA + SQ.EPOCH))


def q_stream_decay_dropping(spark, sf_dir):
    """Users as mentions, a fast decay, and weights below 1/2 dropped."""
    events = read_table(spark, sf_dir, "events")
    users = events.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("mention"))
    start = partial(SQ.start_decay, c=1e-3, drop_below=DROP_BELOW)
    return _rounded(_replayed(spark, users, "seq", start, SQ.DECAY_SCHEMA + SQ.EPOCH))


def q_stream_decay_state(spark, sf_dir):
    """``stream_decay_dropping`` with a state per mention and timers."""
    events = read_table(spark, sf_dir, "events")
    users = events.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("mention"))
    start = partial(SQ.start_decay_state, epoch_rows=BATCH_ROWS, c=1e-3, drop_below=DROP_BELOW)
    out = _replayed(spark, users, "seq", start, SQ.STATE_SCHEMA)
    return out.select(F.col("epoch").alias("batch_id"), "mention", F.round("weight", 6).alias("weight"))


def q_stream_decay_topk(spark, sf_dir):
    out = _replayed(spark, _mentions(spark, sf_dir), "seq", SQ.start_topk, SQ.TOPK_SCHEMA + SQ.EPOCH)
    return out.select(F.col("epoch").alias("batch_id"), "rank", "mention", "weight_int")


def q_stream_random_bits(spark, sf_dir):
    """S6 on a stream: a bit per event, from the source that computes them."""
    n = read_table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    sink, checkpoint = (scratch_dir(spark, f"random-{c}") for c in ("sink", "checkpoint"))
    bits = random_bit_stream(spark, rate=0, count=0 if n is None else n + 1, seed=42)
    SQ.start_bits(bits, sink, checkpoint, {"availableNow": True}).awaitTermination()
    return SQ.read_sink(spark, sink, "seq LONG, bit INT").select(F.col("seq").alias("event_id"), "bit")


def q_mention_rejects(spark, sf_dir):
    """Text lines of the mention stream per micro-batch: how many came, how many
    were rejected.  Users whose id ends in 7 send lines that are cut short."""
    events = read_table(spark, sf_dir, "events")
    good = D.mention_lines(events.select("event_id", "ts", "event_type", "user_id"))
    text = F.when(F.col("user_id") % 10 == 7, F.substring("value", 1, 19)).otherwise(F.col("value"))
    lines = good.join(events.select("event_id", "user_id"), "event_id").select("event_id", text.alias("value"))
    return SQ.line_counts(spark, lines, "event_id", SQ.start_mention_lines, SQ.MENTION_SCHEMA, BATCH_ROWS)


def q_bit_rejects(spark, sf_dir):
    """The same for bit lines: the value of an event as text is a bit only where
    it is a whole number."""
    events = read_table(spark, sf_dir, "events")
    whole = F.col("value") == F.floor("value")
    text = F.when(F.col("event_type") == "error", "1").when(F.col("event_type") == "view", "0").when(
        whole, F.col("value").cast("long").cast("string")).otherwise(F.concat(F.lit("v="), F.col("event_type")))
    return SQ.line_counts(spark, events.select("event_id", text.alias("value")), "event_id", SQ.start_bit_lines, "bit INT",
                          BATCH_ROWS)


SESSION_GAP, SESSION_DELAY = "3 hours", "6 hours"


def q_stream_sessions(spark, sf_dir):
    """Sessions of each user that ended before the watermark of the whole stream."""
    events = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    out = _replayed(spark, events, "seq", partial(SQ.start_sessions, gap=SESSION_GAP, watermark=SESSION_DELAY),
                      SQ.SESSION_SCHEMA)
    return out.select(F.col("key").alias("user_id"), "session_start", "session_end", "n")


def q_stream_tumbling_topk(spark, sf_dir):
    return SQ.top_per_window(
        _replayed(spark, _mentions(spark, sf_dir), "seq", SQ.start_window_counts, SQ.WINDOW_SCHEMA))


_PARAMS = f"params AS (SELECT CAST(0 AS BIGINT) AS lo, CAST({BATCH_ROWS} AS BIGINT) AS width)"

_C = "(1 - 1e-6)"

SQL = {
    "stream_dgim": BIT_SQL["dgim_published"],
    "stream_bit_report": f"""WITH RECURSIVE {_B}, {_as_written_cte(WINDOW_N)}, {_PARAMS},
x AS (SELECT aw.*, (aw.seq - params.lo) // params.width AS micro_batch FROM aw, params WHERE aw.t > 0),
l AS (SELECT key, micro_batch, arg_max(ones, seq) AS real_count,
             arg_max(rest + newest + ({_POW} - 1), seq) AS estimate
      FROM x GROUP BY key, micro_batch)
SELECT key AS user_id, micro_batch, real_count, estimate,
       round(CASE WHEN real_count > 0 THEN (real_count - estimate) / real_count ELSE 0.0 END, 6)
         AS rel_error
FROM l""",
    "stream_decay_carry": f"""WITH {_PARAMS},
m AS (SELECT event_id AS g, event_type AS mention, (event_id - params.lo) // params.width AS batch_id
      FROM events, params WHERE event_type IS NOT NULL),
ends AS (SELECT batch_id, max(g) AS gend FROM m GROUP BY batch_id),
pairs AS (SELECT DISTINCT batch_id, mention FROM m)
SELECT pr.batch_id, pr.mention, round(sum(pow({_C}, e.gend - a.g)), 6) AS weight
FROM pairs pr JOIN ends e ON e.batch_id = pr.batch_id
              JOIN m a ON a.mention = pr.mention AND a.g <= e.gend
GROUP BY pr.batch_id, pr.mention""",
    "stream_decay_dropping": f"""WITH RECURSIVE {_PARAMS},
m AS (SELECT event_id AS g, CAST(user_id AS VARCHAR) AS mention, event_id // {BATCH_ROWS} AS batch_id
      FROM events WHERE user_id IS NOT NULL),
ends AS (SELECT event_id // {BATCH_ROWS} AS batch_id, max(event_id) AS gend FROM events GROUP BY 1),
here AS (SELECT m.batch_id, mention, sum(pow(1 - 1e-3, gend - g)) AS w FROM m JOIN ends USING (batch_id) GROUP BY 1, 2),
users AS (SELECT DISTINCT mention FROM m),
steps AS (
  SELECT CAST(-1 AS BIGINT) AS batch_id, mention, CAST(0 AS DOUBLE) AS weight, CAST(0 AS DOUBLE) AS kept, false AS seen
  FROM users
  UNION ALL
  SELECT s.batch_id + 1, s.mention,
         s.kept * pow(1 - 1e-3, e.gend - coalesce(p.gend, e.gend)) + coalesce(h.w, 0),
         CASE WHEN s.kept * pow(1 - 1e-3, e.gend - coalesce(p.gend, e.gend)) + coalesce(h.w, 0) >= 0.5
              THEN s.kept * pow(1 - 1e-3, e.gend - coalesce(p.gend, e.gend)) + coalesce(h.w, 0) ELSE 0 END,
         h.w IS NOT NULL
  FROM steps s JOIN ends e ON e.batch_id = s.batch_id + 1 LEFT JOIN ends p ON p.batch_id = s.batch_id
       LEFT JOIN here h ON h.batch_id = s.batch_id + 1 AND h.mention = s.mention)
SELECT batch_id, mention, round(weight, 6) AS weight FROM steps WHERE seen""",
    "stream_decay_topk": f"""WITH {_PARAMS},
m AS (SELECT event_id AS seq, ts, event_type AS mention,
             (event_id - params.lo) // params.width AS batch_id
      FROM events, params WHERE event_type IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY ts, seq) - 1 AS i,
             count(*) OVER (PARTITION BY batch_id) AS n FROM m),
w AS (SELECT batch_id, mention,
             CAST(round_even(sum(pow({_C}, n - 1 - i + CASE WHEN i = 0 THEN 1 ELSE 0 END)), 0)
                  AS BIGINT) AS weight_int
      FROM p GROUP BY batch_id, mention),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY batch_id
                                        ORDER BY weight_int DESC, mention) AS INTEGER) AS rank
      FROM w)
SELECT batch_id, rank, mention, weight_int FROM r WHERE rank <= 5""",
    "stream_tumbling_topk": """WITH c AS (
  SELECT date_trunc('hour', ts) AS window_start, event_type AS mention, count(*) AS n
  FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY window_start
                                        ORDER BY n DESC, mention) AS INTEGER) AS rank FROM c)
SELECT window_start, rank, mention, n FROM r WHERE rank <= 5""",
}

SQL["stream_ones"] = f"SELECT user_id, event_id, pos, ones_running, ones_last_n, ones_last_k FROM ({_WIN})"
SQL["stream_decay_state"] = SQL["stream_decay_dropping"]
SQL["dgim_state"] = f"""WITH RECURSIVE {_B}, {_published_cte(WINDOW_N)},
p AS (SELECT key, t, bk FROM pb WHERE t > 0 AND lvl = 0)
SELECT key AS user_id, max(t) AS bits,
       CAST(coalesce(list_sum(list_transform(arg_max(bk, t), lambda x: x.s)), 0) AS BIGINT) AS bucket_sum
FROM p GROUP BY key"""

SQL["stream_random_bits"] = BIT_SQL["random_bits"]
SQL["mention_rejects"] = f"""SELECT event_id // {BATCH_ROWS} AS batch_id, count(*) AS n_lines,
       CAST(sum(CASE WHEN user_id % 10 = 7 THEN 1 ELSE 0 END) AS BIGINT) AS n_rejected FROM events GROUP BY 1"""
SQL["bit_rejects"] = f"""SELECT event_id // {BATCH_ROWS} AS batch_id, count(*) AS n_lines,
       CAST(sum(CASE WHEN event_type IN ('error', 'view') OR value = floor(value) THEN 0 ELSE 1 END) AS BIGINT) AS n_rejected
FROM events GROUP BY 1"""
SQL["stream_sessions"] = f"""WITH e AS (
  SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
s AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts >= before + INTERVAL '{SESSION_GAP}' THEN 1 ELSE 0 END)
                          OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nr FROM e),
g AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '{SESSION_GAP}' AS session_end, count(*) AS n
      FROM s GROUP BY user_id, nr)
SELECT user_id, session_start, session_end, n FROM g
WHERE session_end <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL '{SESSION_DELAY}'"""

QUERIES = {
    "stream_random_bits": q_stream_random_bits,
    "mention_rejects": q_mention_rejects,
    "bit_rejects": q_bit_rejects,
    "stream_sessions": q_stream_sessions,
    "stream_dgim": q_stream_dgim,
    "stream_ones": q_stream_ones,
    "dgim_state": q_dgim_state,
    "stream_decay_state": q_stream_decay_state,
    "stream_bit_report": q_stream_bit_report,
    "stream_decay_carry": q_stream_decay_carry,
    "stream_decay_dropping": q_stream_decay_dropping,
    "stream_decay_topk": q_stream_decay_topk,
    "stream_tumbling_topk": q_stream_tumbling_topk,
}
