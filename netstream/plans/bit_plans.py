"""Registered bit-stream queries (BIT = one stream per ``events.user_id``,
ordered by ``event_id``, ``bit = event_type = 'error'``) and their oracles.

The DGIM oracles are recursive CTEs written independently of the Spark
fold: the as-written one steps ``(rest, newest, discarded)``, the published
one keeps the bucket list and merges one size level per recursion step.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from netstream.functions.dgim import QUERY_K, WINDOW_N
from netstream.operators import bits as B
from netstream.sources.tables import bit_events, read_table


def _bits(spark, sf_dir):
    return bit_events(read_table(spark, sf_dir, "events"))


def _named(df):
    return df.withColumnRenamed("key", "user_id").withColumnRenamed("seq", "event_id")


def q_random_bits(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id")
    return B.random_bits(ev, "event_id", p=B.P_ONE, seed=42)


def q_bit_parse(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    lines = ev.select("user_id", "event_id",
                      (F.col("event_type") == "error").cast("int").cast("string").alias("value"))
    return B.parse_bits(lines).select("user_id", "event_id", "bit", "valid")


def q_ones_running(spark, sf_dir):
    counts = B.ones_counts(_bits(spark, sf_dir), windows={})
    return _named(counts).select("user_id", "event_id", "pos", "ones_running")


def q_ones_last_n(spark, sf_dir):
    c = B.ones_counts(_bits(spark, sf_dir), windows={"ones_last_n": WINDOW_N})
    return _named(c).select("user_id", "event_id", "ones_last_n")


def q_ones_last_k(spark, sf_dir):
    c = B.ones_counts(_bits(spark, sf_dir), windows={"ones_last_k": QUERY_K})
    return _named(c).select("user_id", "event_id", "ones_last_k")


def q_dgim_as_written(spark, sf_dir):
    return _named(B.dgim(_bits(spark, sf_dir), mode="as_written"))


def q_dgim_published(spark, sf_dir):
    return _named(B.dgim(_bits(spark, sf_dir), mode="published"))


def q_dgim_last_k(spark, sf_dir):
    """The published sketch of the last N bits asked for the last K, beside the
    exact count."""
    cum = B.with_window_counts(B.stream_positions(_bits(spark, sf_dir)), {"ones_last_k": QUERY_K})
    asked = B.published(cum, queries={"estimate_k": QUERY_K})
    return _named(asked).select("user_id", "event_id", "ones_last_k", "estimate_k", F.round(
        B.relative_error(F.col("ones_last_k"), F.col("estimate_k")), 6).alias("rel_error_k"))


def q_dgim_error(spark, sf_dir):
    """Both estimates and their errors: the published fold carries the columns
    of the as-written rule and the exact counts along, nothing is joined back."""
    cum = B.with_window_counts(B.stream_positions(_bits(spark, sf_dir)), {"ones_last_n": WINDOW_N})
    written = B.as_written(cum).select(
        "key", "seq", "bit", "pos", "real_count", "ones_last_n", F.col("estimate").alias("est_as_written"))
    both = B.published(written).withColumnRenamed("estimate", "est_published")
    return _named(both).select(
        "user_id", "event_id", "real_count", "est_as_written",
        F.round(B.relative_error(F.col("real_count"), F.col("est_as_written")), 6)
         .alias("rel_error_as_written"),
        "ones_last_n", "est_published",
        F.round(B.relative_error(F.col("ones_last_n"), F.col("est_published")), 6)
         .alias("rel_error_published"))


# ---------------------------------------------------------------------------
# oracles
# ---------------------------------------------------------------------------

_B = """b AS (SELECT user_id AS key, event_id AS seq, CAST(event_type = 'error' AS INTEGER) AS bit,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS t FROM events)"""


def _as_written_cte(n: int) -> str:
    grow = "f.rest + CASE WHEN b.bit = 1 AND f.newest = 1 THEN 1 ELSE 0 END"
    new1 = "CASE WHEN b.bit = 1 THEN 1 ELSE f.newest END"
    return f"""aw AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT) AS t, CAST(NULL AS BIGINT) AS seq, CAST(0 AS BIGINT) AS ones,
         CAST(0 AS BIGINT) AS rest, 0 AS newest, CAST(0 AS BIGINT) AS discarded FROM b
  UNION ALL
  SELECT key, t, seq, ones,
         CASE WHEN expire AND r1 > 0 THEN r1 - CAST(pow(2, floor(log2(r1))) AS BIGINT) ELSE r1 END,
         CASE WHEN expire AND r1 = 0 THEN 0 ELSE n1 END,
         discarded + CASE WHEN expire THEN 1 ELSE 0 END
  FROM (SELECT b.key, b.t, b.seq, f.ones + b.bit AS ones, {grow} AS r1, {new1} AS n1, f.discarded,
               b.t >= {n} AND (({grow}) > 0 OR ({new1}) = 1) AS expire
        FROM aw f JOIN b ON b.key = f.key AND b.t = f.t + 1) s)"""


def _published_cte(n: int) -> str:
    return f"""pb AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT) AS t, CAST(NULL AS BIGINT) AS seq,
         CAST([] AS STRUCT(s BIGINT, e BIGINT)[]) AS bk, CAST(0 AS BIGINT) AS lvl FROM b
  UNION ALL
  SELECT key, t, seq,
    CASE WHEN adv THEN (CASE WHEN bit = 1 THEN list_append(eb, {{'s': CAST(1 AS BIGINT), 'e': t}})
                             ELSE eb END)
         WHEN cnt = 3 THEN list_concat(list_concat(bk[1:p - 1], [{{'s': 2 * lvl, 'e': bk[p + 1].e}}]),
                                       bk[p + 2:])
         ELSE bk END AS bk,
    CAST(CASE WHEN adv THEN (CASE WHEN bit = 1 THEN 1 ELSE 0 END)
              WHEN cnt = 3 THEN 2 * lvl ELSE 0 END AS BIGINT) AS lvl
  FROM (
    SELECT f.key, f.lvl = 0 AS adv,
           CASE WHEN f.lvl = 0 THEN b.t ELSE f.t END AS t,
           CASE WHEN f.lvl = 0 THEN b.seq ELSE f.seq END AS seq,
           b.bit, f.bk, f.lvl,
           CASE WHEN len(f.bk) > 0 AND f.bk[1].e <= b.t - {n} THEN f.bk[2:] ELSE f.bk END AS eb,
           len(list_filter(f.bk, lambda x: x.s = f.lvl)) AS cnt,
           list_position(list_transform(f.bk, lambda x: x.s), f.lvl) AS p
    FROM pb f LEFT JOIN b ON f.lvl = 0 AND b.key = f.key AND b.t = f.t + 1
    WHERE f.lvl > 0 OR b.t IS NOT NULL) s)"""


_POW = "CASE WHEN discarded > 1023 THEN CAST('Infinity' AS DOUBLE) ELSE pow(2, discarded) END"

_AW_OUT = f"""SELECT key AS user_id, seq AS event_id, ones AS real_count,
       CAST(bit_count(rest) + newest AS BIGINT) AS n_buckets, rest + newest AS bucket_sum,
       discarded, rest + newest + ({_POW} - 1) AS estimate
FROM aw WHERE t > 0"""

_PB_OUT = """SELECT key AS user_id, seq AS event_id, len(bk) AS n_buckets,
       CAST(coalesce(list_sum(list_transform(bk, lambda x: x.s)), 0) AS BIGINT) AS bucket_sum,
       CAST(coalesce(list_sum(list_transform(bk, lambda x: x.s)), 0)
            - coalesce(bk[1].s // 2, 0) AS BIGINT) AS estimate
FROM pb WHERE t > 0 AND lvl = 0"""

_WIN = """SELECT user_id, event_id,
       CAST(row_number() OVER w AS BIGINT) AS pos,
       CAST(sum(bit) OVER w AS BIGINT) AS ones_running,
       CAST(sum(bit) OVER (PARTITION BY user_id ORDER BY event_id
                           ROWS BETWEEN {n1} PRECEDING AND CURRENT ROW) AS BIGINT) AS ones_last_n,
       CAST(sum(bit) OVER (PARTITION BY user_id ORDER BY event_id
                           ROWS BETWEEN {k1} PRECEDING AND CURRENT ROW) AS BIGINT) AS ones_last_k
FROM (SELECT user_id, event_id, CAST(event_type = 'error' AS INTEGER) AS bit FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""".format(n1=WINDOW_N - 1,
                                                                     k1=QUERY_K - 1)

SQL = {
    "random_bits": f"""
SELECT event_id, CAST((CAST(('0x' || substr(md5('42:' || event_id), 1, 8)) AS BIGINT) / 4294967296.0) < {B.P_ONE}
            AS INTEGER) AS bit FROM events""",
    "bit_parse": """
SELECT user_id, event_id,
       CASE WHEN TRY_CAST(trim(v) AS INTEGER) = 1 THEN 1 ELSE 0 END AS bit,
       TRY_CAST(trim(v) AS INTEGER) IS NOT NULL AS valid
FROM (SELECT user_id, event_id, CAST(CAST(event_type = 'error' AS INTEGER) AS VARCHAR) AS v
      FROM events)""",
    "ones_running": f"SELECT user_id, event_id, pos, ones_running FROM ({_WIN})",
    "ones_last_n": f"SELECT user_id, event_id, ones_last_n FROM ({_WIN})",
    "ones_last_k": f"SELECT user_id, event_id, ones_last_k FROM ({_WIN})",
    "dgim_as_written": f"WITH RECURSIVE {_B}, {_as_written_cte(WINDOW_N)}\n{_AW_OUT}",
    "dgim_published": f"WITH RECURSIVE {_B}, {_published_cte(WINDOW_N)}\n{_PB_OUT}",
    "dgim_last_k": f"""WITH RECURSIVE {_B}, {_published_cte(WINDOW_N)}, w AS ({_WIN}),
p AS (SELECT key, seq, list_filter(bk, lambda x: x.e > t - {QUERY_K}) AS bk FROM pb WHERE t > 0 AND lvl = 0),
e AS (SELECT key, seq, CAST(coalesce(list_sum(list_transform(bk, lambda x: x.s)), 0)
                            - coalesce(bk[1].s // 2, 0) AS BIGINT) AS estimate_k FROM p)
SELECT w.user_id, w.event_id, w.ones_last_k, e.estimate_k,
       round(CASE WHEN w.ones_last_k > 0 THEN CAST(w.ones_last_k - e.estimate_k AS DOUBLE) / w.ones_last_k
                  ELSE 0.0 END, 6) AS rel_error_k
FROM w JOIN e ON e.key = w.user_id AND e.seq = w.event_id""",
    "dgim_error": f"""WITH RECURSIVE {_B}, {_as_written_cte(WINDOW_N)}, {_published_cte(WINDOW_N)},
a AS ({_AW_OUT}), p AS ({_PB_OUT}), w AS ({_WIN})
SELECT a.user_id, a.event_id, a.real_count, a.estimate AS est_as_written,
       round(CASE WHEN a.real_count > 0 THEN (a.real_count - a.estimate) / a.real_count
                  ELSE 0.0 END, 6) AS rel_error_as_written,
       w.ones_last_n, p.estimate AS est_published,
       round(CASE WHEN w.ones_last_n > 0
                  THEN CAST(w.ones_last_n - p.estimate AS DOUBLE) / w.ones_last_n
                  ELSE 0.0 END, 6) AS rel_error_published
FROM a JOIN p ON p.user_id = a.user_id AND p.event_id = a.event_id
       JOIN w ON w.user_id = a.user_id AND w.event_id = a.event_id""",
}

QUERIES = {
    "random_bits": q_random_bits,
    "bit_parse": q_bit_parse,
    "ones_running": q_ones_running,
    "ones_last_n": q_ones_last_n,
    "ones_last_k": q_ones_last_k,
    "dgim_as_written": q_dgim_as_written,
    "dgim_published": q_dgim_published,
    "dgim_last_k": q_dgim_last_k,
    "dgim_error": q_dgim_error,
}
