"""Registered decaying-window queries (MEN = ``events.event_type`` as the
mention, micro-batches of 1,000 consecutive event ids) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from netstream.operators import decay as D
from netstream.sources.tables import mention_events, read_table

BATCH_ROWS = 1000


def _men(spark, sf_dir):
    return mention_events(read_table(spark, sf_dir, "events"), batch_rows=BATCH_ROWS)


def q_mention_parse(spark, sf_dir):
    lines = D.mention_lines(read_table(spark, sf_dir, "events"))
    return D.parse_mention_lines(lines).select("event_id", "mention", "time_text", "ts_parsed")


def q_decay_batch(spark, sf_dir):
    w = D.batch_weights(_men(spark, sf_dir), c=D.DECAY_C, mode="as_written")
    return w.select("batch_id", "mention", F.round("weight", 6).alias("weight"), "weight_int")


def q_decay_batch_published(spark, sf_dir):
    w = D.batch_weights(_men(spark, sf_dir), c=D.DECAY_C, mode="published")
    return w.select("batch_id", "mention", F.round("weight", 6).alias("weight"))


def q_decay_topk(spark, sf_dir):
    w = D.batch_weights(_men(spark, sf_dir), c=D.DECAY_C, mode="as_written")
    top = D.top_k_per_batch(w, k=D.TOP_K, weight="weight_int")
    return top.select("batch_id", "rank", "mention", "weight_int")


def q_decay_carry(spark, sf_dir):
    w = D.carried_weights(_men(spark, sf_dir), c=D.DECAY_C)
    return w.select("batch_id", "mention", F.round("weight", 6).alias("weight"))


def q_decay_carry_topk(spark, sf_dir):
    w = D.carried_weights(_men(spark, sf_dir), c=D.DECAY_C)
    top = D.top_k_per_batch(w, k=D.TOP_K, weight="weight")
    return top.select("batch_id", "rank", "mention", F.round("weight", 6).alias("weight"))


def q_replay_batches(spark, sf_dir):
    lines = D.mention_lines(read_table(spark, sf_dir, "events"))
    out = D.replay_batches(lines, order="event_id", rows_per_second=1.0, trigger_seconds=5.0)
    return out.select("event_id", "replay_idx", "send_s", "batch_id")


_MEN = f"""
m AS (SELECT event_id AS seq, ts, event_type AS mention, event_id // {BATCH_ROWS} AS batch_id
      FROM events WHERE event_type IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY ts, seq) - 1 AS i,
             count(*) OVER (PARTITION BY batch_id) AS n FROM m)"""

_C = "(1 - 1e-6)"

_CARRY = f"""WITH {_MEN.strip()},
g AS (SELECT *, row_number() OVER (ORDER BY ts, seq) - 1 AS g FROM m),
ends AS (SELECT batch_id, max(g) AS "G" FROM g GROUP BY batch_id),
pairs AS (SELECT DISTINCT batch_id, mention FROM g),
w AS (SELECT pr.batch_id, pr.mention, sum(pow({_C}, e."G" - a.g)) AS weight
      FROM pairs pr JOIN ends e ON e.batch_id = pr.batch_id
                    JOIN g a ON a.mention = pr.mention AND a.g <= e."G"
      GROUP BY pr.batch_id, pr.mention)"""

SQL = {
    "mention_parse": """
WITH l AS (SELECT event_id,
                  strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') || ',' || event_type AS value
           FROM events),
t AS (SELECT event_id, value, regexp_split_to_array(trim(value), '\\s+') AS ws FROM l)
SELECT event_id,
       string_split(string_split(value, ' ')[2], ',')[2] AS mention,
       string_split(ws[2], ',')[1] AS time_text,
       try_strptime(ws[1] || ' ' || string_split(ws[2], ',')[1], '%Y-%m-%d %H:%M:%S') AS ts_parsed
FROM t""",
    "decay_batch": f"""WITH {_MEN.strip()},
w AS (SELECT batch_id, mention,
             sum(pow({_C}, n - 1 - i + CASE WHEN i = 0 THEN 1 ELSE 0 END)) AS weight
      FROM p GROUP BY batch_id, mention)
SELECT batch_id, mention, round(weight, 6) AS weight,
       CAST(round_even(weight, 0) AS BIGINT) AS weight_int FROM w""",
    "decay_batch_published": f"""WITH {_MEN.strip()}
SELECT batch_id, mention, round(sum(pow({_C}, n - 1 - i)), 6) AS weight
FROM p GROUP BY batch_id, mention""",
    "decay_topk": f"""WITH {_MEN.strip()},
w AS (SELECT batch_id, mention,
             CAST(round_even(sum(pow({_C}, n - 1 - i + CASE WHEN i = 0 THEN 1 ELSE 0 END)), 0)
                  AS BIGINT) AS weight_int
      FROM p GROUP BY batch_id, mention),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY batch_id
                                        ORDER BY weight_int DESC, mention) AS INTEGER) AS rank
      FROM w)
SELECT batch_id, rank, mention, weight_int FROM r WHERE rank <= 5""",
    "decay_carry": f"""{_CARRY}
SELECT batch_id, mention, round(weight, 6) AS weight FROM w""",
    "decay_carry_topk": f"""{_CARRY},
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY batch_id
                                        ORDER BY weight DESC, mention) AS INTEGER) AS rank
      FROM w)
SELECT batch_id, rank, mention, round(weight, 6) AS weight FROM r WHERE rank <= 5""",
    "replay_batches": """
SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS replay_idx,
       CAST(row_number() OVER (ORDER BY event_id) - 1 AS DOUBLE) AS send_s,
       CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 5.0) AS BIGINT) AS batch_id
FROM events""",
}

QUERIES = {
    "mention_parse": q_mention_parse,
    "decay_batch": q_decay_batch,
    "decay_batch_published": q_decay_batch_published,
    "decay_topk": q_decay_topk,
    "decay_carry": q_decay_carry,
    "decay_carry_topk": q_decay_carry_topk,
    "replay_batches": q_replay_batches,
}
