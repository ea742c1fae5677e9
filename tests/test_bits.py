import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from netstream.functions import dgim
from netstream.functions.dgim import AsWritten, Published, Totals
from netstream.operators import bits as B
from netstream.sources.tables import bit_events, read_table

BITS = [1, 0, 1, 1, 1, 1, 0, 1, 1, 0, 0, 1]
# t: (ones, as-written buckets, discarded, as-written estimate, exact last 8, published buckets, estimate)
TABLE = [
    (1, [1], 0, 1, 1, [1], 1),
    (1, [1], 0, 1, 1, [1], 1),
    (2, [1, 1], 0, 2, 2, [1, 1], 2),
    (3, [2, 1], 0, 3, 3, [2, 1], 2),
    (4, [2, 1, 1], 0, 4, 4, [2, 1, 1], 3),
    (5, [4, 1], 0, 5, 5, [2, 2, 1], 4),
    (5, [4, 1], 0, 5, 5, [2, 2, 1], 4),
    (6, [1, 1], 1, 3, 6, [2, 2, 1, 1], 5),
    (7, [1], 2, 4, 6, [4, 2, 1], 5),
    (7, [], 3, 7, 6, [4, 2, 1], 5),
    (7, [], 3, 7, 5, [4, 2, 1], 5),
    (8, [], 4, 15, 5, [4, 2, 1, 1], 6),
]


def test_fold_helpers_match_fixture():
    aw, pb = AsWritten(8), Published(8)
    for bit, (ones, awb, disc, awe, _, pbb, pbe) in zip(BITS, TABLE):
        aw.step(bit)
        pb.step(bit)
        assert (aw.ones, aw.buckets(), aw.discarded, aw.estimate()) == (ones, awb, disc, awe)
        assert (pb.sizes, pb.estimate()) == (pbb, pbe)


def test_spark_dgim_and_counts_match_fixture(spark):
    rows = [(7, t + 1, b) for t, b in enumerate(BITS)]
    df = spark.createDataFrame(rows, "key LONG, seq LONG, bit INT")
    aw = {r.seq: r for r in B.dgim(df, mode="as_written", n=8).collect()}
    pb = {r.seq: r for r in B.dgim(df, mode="published", n=8).collect()}
    cnt = {r.seq: r for r in B.ones_counts(df, windows={"last8": 8}).collect()}
    for t, (ones, awb, disc, awe, exact, pbb, pbe) in enumerate(TABLE, start=1):
        assert aw[t].real_count == ones and aw[t].discarded == disc and aw[t].estimate == awe
        assert aw[t].bucket_sum == sum(awb) and aw[t].n_buckets == len(awb)
        assert pb[t].estimate == pbe and pb[t].n_buckets == len(pbb)
        assert cnt[t].ones_running == ones and cnt[t].last8 == exact and cnt[t].pos == t


def test_published_error_bound_and_bucket_invariants(spark):
    ev = read_table(spark, SF001, "events").toPandas().sort_values("event_id")
    worst = 0.0
    for _, g in ev.groupby("user_id"):
        pb = Published(24)
        window = []
        for b in (g.event_type == "error").astype(int).tolist():
            pb.step(b)
            window = (window + [b])[-24:]
            exact = sum(window)
            sizes = pb.sizes
            assert all(s & (s - 1) == 0 for s in sizes)
            assert all(a >= b for a, b in zip(sizes, sizes[1:]))
            assert max((sizes.count(s) for s in set(sizes)), default=0) <= 2
            if exact:
                worst = max(worst, abs(exact - pb.estimate()) / exact)
    assert worst <= 0.5


def test_parse_bits(spark):
    df = spark.createDataFrame([("1",), ("0",), (" 1 ",), ("2",), ("x",), ("1.5",)], "value STRING")
    got = [(r.bit, r.valid) for r in B.parse_bits(df).collect()]
    assert got == [(1, True), (0, True), (1, True), (0, True), (0, False), (0, False)]


def test_random_bits_rate(spark):
    ev = read_table(spark, SF001, "events").select("event_id")
    rb = B.random_bits(ev, "event_id", p=0.3)
    ones = rb.agg(F.sum("bit")).first()[0]
    assert 200 <= ones <= 400
    assert rb.collect() == B.random_bits(ev.repartition(3), "event_id", p=0.3).orderBy("event_id").collect() \
        or sorted(rb.collect()) == sorted(B.random_bits(ev.repartition(3), "event_id", p=0.3).collect())


def test_counts_on_events_match_pandas(spark):
    bits = bit_events(read_table(spark, SF001, "events"))
    got = B.ones_counts(bits, windows={"n24": 24, "k20": 20}).toPandas().sort_values(["key", "seq"])
    pdf = bits.toPandas().sort_values(["key", "seq"])
    g = pdf.groupby("key")["bit"]
    exp_run = g.cumsum().to_numpy()
    exp_24 = g.transform(lambda s: s.rolling(24, min_periods=1).sum()).to_numpy()
    np.testing.assert_array_equal(got["ones_running"].to_numpy(), exp_run)
    np.testing.assert_array_equal(got["n24"].to_numpy(), exp_24.astype(int))


def _streams():
    import random
    rng = random.Random(5)
    rows = []
    for key, (length, p) in enumerate([(5, 0.5), (40, 0.3), (400, 0.9), (300, 0.02), (1300, 1.0)]):
        for t in range(length):
            rows.append((key or None, 2000 * key + t, int(rng.random() < p)))
    return rows


def test_folds_of_long_hot_and_null_streams(spark):
    """Both rules equal the plain fold on streams far longer than the head, with
    more than 1,100 ones (past the DOUBLE range) and with a NULL key; the
    published rule also where streams are cut at gaps."""
    rows = _streams()
    df = spark.createDataFrame(rows, "key LONG, seq LONG, bit INT")
    for n in (8, 24):
        want = {"as_written": set(), "published": set()}
        for key in {k for k, _, _ in rows}:
            aw, pb = AsWritten(n), Published(n)
            for _, q, b in (r for r in rows if r[0] == key):
                aw.step(b)
                pb.step(b)
                want["as_written"].add((key, q, aw.ones, len(aw.buckets()), sum(aw.buckets()), aw.discarded, aw.estimate()))
                want["published"].add((key, q, len(pb.sizes), sum(pb.sizes), pb.estimate()))
        for mode, rows_ in want.items():
            got = B.dgim(df, mode, n=n).collect()
            assert len(got) == len(rows_) and set(map(tuple, got)) == rows_
    assert any(r[6] == float("inf") for r in want["as_written"])


def test_window_counts_across_blocks(spark):
    """Counts do not depend on the size of the blocks a stream is cut into."""
    rows = _streams()
    df = spark.createDataFrame(rows, "key LONG, seq LONG, bit INT")
    want = {}
    for key in {k for k, _, _ in rows}:
        bits = [(q, b) for k, q, b in rows if k == key]
        for t, (q, _) in enumerate(bits):
            want[(key, q)] = (sum(b for _, b in bits[max(0, t - 23):t + 1]), sum(b for _, b in bits[max(0, t - 4):t + 1]))
    for block in (7, 100, 100_000):
        got = {(r.key, r.seq): (r.a, r.b) for r in B.ones_counts(df, windows={"a": 24, "b": 5}, block_rows=block).collect()}
        assert got == want


def test_as_written_head_drains():
    """rest is 0 from the head length on, for every bit pattern tried."""
    import random
    rng = random.Random(11)
    for n in (1, 2, 3, 8, 24, 100):
        t0 = B.as_written_head_length(n)
        for _ in range(200):
            st = AsWritten(n)
            for t in range(t0 + 50):
                st.step(int(rng.random() < rng.choice([0.5, 0.95, 1.0])))
                if st.t >= t0:
                    assert st.rest == 0


def _reference(bits, n, k):
    """Bucket lists by the published rule: totals, counts, estimates, and the
    answer for the last k bits with the size of the oldest bucket in it."""
    pb, out = Published(n), []
    for b in bits:
        pb.step(int(b))
        late = [s for s, e in zip(pb.sizes, pb.ends) if e > pb.t - k]
        out.append((sum(pb.sizes), len(pb.sizes), pb.estimate(), sum(late), late[0] if late else 0))
    return np.array(out, np.int64).T


@pytest.mark.parametrize("n", [1, 2, 3, 8, 24, 100])
@pytest.mark.parametrize("p", [0.02, 0.3, 0.7, 1.0])
def test_the_total_is_the_whole_state(n, p):
    rng = np.random.default_rng(int(n + 1000 * p))
    bits, k = (rng.random(600) < p).astype(np.uint8), max(1, n - 4)
    total, count, estimate, late, oldest = _reference(bits, n, k)
    fold = Totals(n)
    assert np.concatenate([fold.feed(bits[:250]), fold.feed(bits[250:])]).tolist() == total.tolist()
    assert dgim.buckets_of(total).tolist() == count.tolist()
    assert (total - dgim.oldest_size(total) // 2).tolist() == estimate.tolist()
    found, size = dgim.suffix_totals(bits, np.arange(600), total, k)
    assert found.tolist() == late.tolist() and size.tolist() == oldest.tolist()
    cuts = [c for c in (1, 50, 333) if c >= min(n, 50)]
    blocks = [bits[max(0, c - n):] for c in cuts]
    begin = np.cumsum([0, *(len(b) for b in blocks)])[:-1]
    halo = np.array([min(n, c) for c in cuts])
    starts = [dgim.possible_totals(int(b[:h].sum())) for b, h in zip(blocks, halo)]
    wide = max(map(len, starts))
    ends = dgim.follow_totals(np.concatenate(blocks), begin + halo, begin + [len(b) for b in blocks],
                              np.array([s + s[:1] * (wide - len(s)) for s in starts]), n)
    for cut, start, end in zip(cuts, starts, ends):
        assert end[start.index(total[cut - 1])] == total[-1]


@pytest.mark.parametrize("fold_rows", [7, 100])
def test_blocks_of_streams_equal_the_fold(spark, monkeypatch, fold_rows):
    """Blocks far shorter than the streams and than N, chained over two levels
    of groups; NULL, hot, sparse and dense streams; other columns pass."""
    monkeypatch.setattr(B, "CHAINED_BLOCKS", 5)
    rows = _streams()
    cum = B.stream_positions(spark.createDataFrame(rows, "key LONG, seq LONG, bit INT")).withColumn("note", F.col("seq") * 2)
    want = set()
    for key in {k for k, _, _ in rows}:
        own = [(q, b) for k, q, b in rows if k == key]
        total, count, estimate, late, oldest = _reference([b for _, b in own], 24, 20)
        want |= {(key, q, 2 * q, *map(int, r)) for (q, _), *r in zip(own, count, total, estimate, late - oldest // 2)}
    got = B.published(cum, queries={"last20": 20}, fold_rows=fold_rows).select(
        "key", "seq", "note", "n_buckets", "bucket_sum", "estimate", "last20").collect()
    assert len(got) == len(rows) and set(map(tuple, got)) == want


def test_dense_stream_is_folded_in_parallel(spark):
    """One stream of a million ones: no gap to cut at, many tasks, the fold's
    result."""
    n = 1_000_000
    cum = spark.range(n).select(F.lit(1).cast("long").alias("key"), F.col("id").alias("seq"), F.lit(1).cast("long").alias("bit"),
                                (F.col("id") + 1).alias("pos"))
    out = B.published(cum)
    assert len(out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()) > 1
    got = out.groupBy("bucket_sum").count().collect()
    total, count = np.unique(Totals(24).feed(np.ones(n, np.uint8)), return_counts=True)
    assert {(r["bucket_sum"], r["count"]) for r in got} == set(zip(total.tolist(), count.tolist()))
    tail = [(r.bucket_sum, r.estimate) for r in out.where(f"seq >= {n - 50}").orderBy("seq").collect()]
    fold = Totals(24)
    want = fold.feed(np.ones(n, np.uint8))[-50:]
    assert tail == list(zip(want.tolist(), (want - dgim.oldest_size(want) // 2).tolist()))


def test_query_for_last_k_is_within_half(spark):
    bits = bit_events(read_table(spark, SF001, "events"))
    cum = B.with_window_counts(B.stream_positions(bits), {"k5": 5, "k20": 20, "k24": 24})
    out = B.published(cum, queries={"e5": 5, "e20": 20, "e24": 24})
    worst = out.select(*[F.max(F.abs(B.relative_error(F.col(f"k{k}"), F.col(f"e{k}")))) for k in (5, 20, 24)]).first()
    assert max(worst) <= 0.5
    assert out.where("e24 != estimate").count() == 0
    with pytest.raises(ValueError):
        B.published(cum, queries={"e25": 25})


def test_a_fold_holds_a_bounded_part_of_a_task():
    """Rows are folded in tables of some 65,536, however many a task has."""
    import pyarrow as pa
    n = 10_000
    batches = (pa.RecordBatch.from_arrays([pa.array(np.zeros(n, bool)), pa.array((np.arange(n) + a) // 50),
                                           pa.array(np.zeros(n, np.int64))], names=B._BLOCK) for a in range(0, 300_000, n))
    rows = [t.num_rows for t, _ in B._whole_blocks(batches)]
    assert max(rows) < 90_000 and sum(rows) == 300_000
