import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from netstream.operators import decay as D
from netstream.sources.tables import mention_events, read_table


def _batch(spark, seq):
    rows = [(i, i, m, 0) for i, m in enumerate(seq)]
    return spark.createDataFrame(rows, "seq LONG, ts LONG, mention STRING, batch_id LONG")


def test_batch_weights_fixture(spark):
    df = _batch(spark, list("abacabba"))
    aw = {r.mention: r for r in D.batch_weights(df, c=0.1, mode="as_written").collect()}
    pb = {r.mention: r for r in D.batch_weights(df, c=0.1, mode="published").collect()}
    assert abs(aw["a"].weight - 2.749957) < 1e-6 and aw["a"].weight_int == 3
    assert abs(aw["b"].weight - 2.241441) < 1e-6 and aw["b"].weight_int == 2
    assert abs(aw["c"].weight - 0.656100) < 1e-6 and aw["c"].weight_int == 1
    assert abs(pb["a"].weight - 2.797787) < 1e-6
    assert abs(pb["b"].weight - 2.241441) < 1e-6
    assert abs(pb["c"].weight - 0.656100) < 1e-6


def test_bround_half_even(spark):
    got = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "w DOUBLE") \
               .select(F.bround("w", 0).cast("long").alias("r")).collect()
    assert [r.r for r in got] == [0, 2, 2]


def test_parse_lines(spark):
    lines = spark.createDataFrame([("2019-06-01 10:00:00,alice,x",), ("2019-06-01 10:00:01,bob bob",),
                                   ("timestamp,mention",), ("bad",)], "value STRING")
    got = [r.mention for r in D.parse_mention_lines(lines).collect()]
    assert got == ["alice", "bob", None, None]
    ts = [r.ts_parsed for r in D.parse_mention_lines(lines).collect()]
    assert str(ts[0]) == "2019-06-01 10:00:00" and ts[2] is None


def test_men_batch0_top3(spark):
    men = mention_events(read_table(spark, SF01, "events"))
    w = D.batch_weights(men, mode="as_written")
    top = D.top_k_per_batch(w, k=3, weight="weight_int").where("batch_id = 0").orderBy("rank").collect()
    assert [(r.mention, r.weight_int) for r in top] == [("click", 212), ("purchase", 212), ("view", 196)]


def brute_carry(seqs, mentions, batches, c):
    """Sequential fold: every arrival decays all weights and adds 1."""
    w, out, last_batch = {}, {}, None
    order = np.argsort(seqs, kind="stable")
    for idx in order:
        b, m = batches[idx], mentions[idx]
        for k in w:
            w[k] *= (1 - c)
        w[m] = w.get(m, 0.0) + 1.0
        out.setdefault(b, {})
        out[b] = {kk: vv for kk, vv in w.items()}
    return out


@pytest.mark.parametrize("c,max_exp", [(0.01, 500.0), (0.05, 40.0), (0.2, 40.0)])
def test_carried_weights_against_fold(spark, c, max_exp):
    men = mention_events(read_table(spark, SF001, "events"), batch_rows=100)
    pdf = men.toPandas()
    ref = brute_carry(pdf.seq.to_numpy(), pdf.mention.to_numpy(), pdf.batch_id.to_numpy(), c)
    got = D.carried_weights(men, c=c, max_exponent=max_exp).collect()
    assert len(got) == pdf.groupby(["batch_id", "mention"]).ngroups
    for r in got:
        assert math.isclose(r.weight, ref[r.batch_id][r.mention], rel_tol=1e-9, abs_tol=1e-12)


def test_replay_schedule(spark):
    lines = D.mention_lines(read_table(spark, SF001, "events"))
    r = D.replay_batches(lines, rows_per_second=1, trigger_seconds=5, stop_after_seconds=60)
    assert r.count() == 60
    assert r.agg(F.max("batch_id")).first()[0] == 11
