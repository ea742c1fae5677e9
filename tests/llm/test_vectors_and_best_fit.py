"""Best-fit packing, whitening and vector codes against plain versions."""

import bisect
import hashlib
import zlib

import numpy as np
import pytest
from corpus_fixtures import SF001, documents  # noqa: F401
from pyspark.sql import functions as F

import public_tokenizers
from netstream.llm import best_fit, vector_codes, whitening

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
NAN, INF = float("nan"), float("inf")


def best_fit_decreasing(lengths, size):
    """Sequences that best fit needs, longest first, one after the other."""
    gaps, n = [], 0
    for length in sorted((x for x in lengths if x), reverse=True):
        at = bisect.bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else size
        n += gap == size
        if gap > length:
            bisect.insort(gaps, gap - length)
    return n


def _plan(counts):
    """Sweeps of all rounds, as ``place_rests`` plays them."""
    plan, threshold, rounds = best_fit.Plan(counts), len(counts) - 1, []
    while plan.left.any():
        threshold = max(1, threshold // 2)
        while plan.left[threshold:].any():
            rounds.append(plan.sweep(threshold))
    return plan, rounds


@pytest.mark.parametrize("name", ["uniform", "short", "thirds", "geometric", "one", "full"])
def test_plan_is_close_to_best_fit_decreasing(name):
    rng = np.random.default_rng(5)
    lengths = {"uniform": rng.integers(1, 512, 4_000), "short": rng.integers(1, 20, 5_000),
               "thirds": rng.integers(150, 190, 3_000), "geometric": np.minimum(rng.geometric(1 / 80, 6_000), 511),
               "one": np.ones(1, np.int64), "full": np.full(7, 511)}[name]
    plan, rounds = _plan(np.bincount(lengths, minlength=513))
    least, own = -(-int(lengths.sum()) // 512), best_fit_decreasing(lengths.tolist(), 512)
    assert least <= plan.sequences <= own * 1.005 + 1
    taken = np.zeros(513, np.int64)
    for sweep in rounds:  # each rest is placed once, in gaps that hold it
        for gap, _, count, length, rest, each, _ in sweep.runs:
            assert rest == taken[length] and each * length <= gap
            taken[length] += count * each
    assert taken.tolist() == np.bincount(lengths, minlength=513).tolist()


@pytest.mark.parametrize("seq_len", [64, 2048])
def test_best_fit_pieces(spark, seq_len):
    """Every id in exactly one piece, the tokenizer's own ids; only long
    documents are cut; sequences are gapless and few."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(TOKENIZER)
    odd = [(10_001, "it's. a.b ...  <|endoftext|>x <|ENDOFTEXT|>"), (10_002, None), (10_003, ""), (10_003, ""),
           (None, "no id at all"), (10_004, "word " * 5_000)]
    docs = (spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
            .union(spark.createDataFrame(odd, "doc_id long, text string"))
            .withColumn("pid", F.lit(1)).withColumn("sequence", F.lit(2)).withColumn("length", F.lit(None).cast("int")))
    ids = {}
    for r in docs.collect():
        ids.setdefault(r.doc_id, []).append(np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4"))
    rows = best_fit.pack(docs, TOKENIZER, seq_len=seq_len).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        found = np.frombuffer(r.ids, "<u4")
        assert len(found) == r.length <= seq_len and r.start == r.piece * seq_len and r.ids_crc32 == zlib.crc32(r.ids)
        assert any((found == d[r.start:r.start + r.length]).all() for d in ids[r.doc_id] if len(d) >= r.start + r.length)
    for ident, texts in ids.items():
        assert sorted(r.length for r in by_doc[ident]) == sorted(min(seq_len, len(d) - s) for d in texts
                                                                 for s in range(0, len(d), seq_len))
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert sum(r.length for r in own) <= seq_len
    lengths = [r.length for r in rows]
    assert len(by_sequence) <= best_fit_decreasing(lengths, seq_len) * 1.01 + 1
    assert len(by_sequence) >= -(-sum(lengths) // seq_len)


def test_best_fit_empty_and_equal(spark, documents):
    assert best_fit.pack(documents([]), TOKENIZER).count() == 0
    rows = best_fit.pack(documents(["a b c"] * 100 + [None] * 50), TOKENIZER, seq_len=8).collect()
    assert sorted(r.length for r in rows) == [1] * 50 + [4] * 100
    assert len({r.sequence_id for r in rows}) == 57


# -- vector codes -------------------------------------------------------------

def plain_codes(rows, parts, entries, rounds, scale):
    """``{(id, place): (code, error)}`` and the codebooks, one point at a time."""
    width = -(-max(len(v) for _, v in rows) // parts)
    x = np.array([[int(np.floor(np.float64(e) * scale)) for e in v] + [0] * (parts * width - len(v)) for _, v in rows])
    x = x.reshape(len(rows), parts, width)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, list(rows[i][1])))
    books = [[x[i, p].tolist() for i in order[:entries]] for p in range(parts)]

    def nearest(point, book):
        far = [sum((a - b) ** 2 for a, b in zip(point, entry)) for entry in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for i in range(len(rows)):
                own[nearest(x[i, p].tolist(), books[p])[0]].append(x[i, p].tolist())
            books[p] = [[sum(c) // len(c) for c in zip(*points)] if points else old for points, old in zip(own, books[p])]
    found = [[nearest(x[i, p].tolist(), books[p]) for p in range(parts)] for i in range(len(rows))]
    return [("".join(f"{c:02x}" for c, _ in f), sum(e for _, e in f)) for f in found], books


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, n % 3 if n % 5 else None, "x", 1) for n, (i, v) in enumerate(rows)],
                                 "vec_id long, embedding array<double>, label int, code string, error int")


def test_vector_codes_against_one_point_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 7)
    monkeypatch.setattr(vector_codes, "CHUNK_ROWS", 50)
    rng = np.random.default_rng(9)
    rows = [(int(i) if i % 11 else None, (rng.normal(size=12) * rng.choice([0.01, 1, 30])).tolist()) for i in range(160)]
    rows += [(500, [0.25] * 12)] * 60 + [(7, [1.0] * 12), (7, [1.0, 2.0]), (9, [])]
    bad = [(1, None), (2, [1.0, None] * 6), (3, [NAN] * 12), (4, [INF] + [0.0] * 11)]
    out = vector_codes.compress(_vectors(spark, rows + bad), parts=4, entries=9, rounds=2, scale=16).collect()
    want, books = plain_codes(rows, 4, 9, 2, 16)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.vec_id, r.code, r.error) for r in out), key=key) == sorted(
        ((i, *w) for (i, _), w in zip(rows, want)), key=key)
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    assert {r.codebooks_sha256 for r in out} == {hashlib.sha256(text.encode()).hexdigest()}
    totals = {}
    for n, (_, e) in enumerate(want):
        label = n % 3 if n % 5 else None
        totals[label] = totals.get(label, 0) + e
    assert sorted(r.label_error for r in out) == sorted(totals[n % 3 if n % 5 else None] for n in range(len(want)))


def test_vector_codes_few_and_empty(spark):
    assert vector_codes.compress(_vectors(spark, [])).count() == 0
    assert vector_codes.compress(_vectors(spark, [(1, None), (2, [NAN])])).count() == 0
    one = vector_codes.compress(_vectors(spark, [(3, [0.5, -0.5] * 16)])).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in one] == [(3, "00" * 16, 0, 0)]
    huge = vector_codes.compress(_vectors(spark, [(1, [1e300] * 16), (2, [-1e300] * 16), (3, [0.0] * 16)])).collect()
    assert {r.vec_id: r.error for r in huge} == {1: 0, 2: 0, 3: 0}


def test_short_lists_lose_no_entry():
    """Whatever the block, the nearest entry of each point is on its list."""
    rng = np.random.default_rng(1)
    for width in (1, 2, 4, 70):
        points = rng.integers(-50, 50, (300, width))
        book = points[:20].copy()
        order = vector_codes.curve_order(points)
        assert sorted(order.tolist()) == list(range(300))
        blocks = vector_codes.Blocks.of(points[order])
        code, error = blocks.assign(book)
        far = ((points[order][:, None] - book) ** 2).sum(-1)
        assert code.tolist() == far.argmin(1).tolist() and error.tolist() == far.min(1).tolist()
        sums = blocks.round_sums(book)
        for k in range(20):
            own = points[order][code == k]
            assert sums[k].tolist() == [len(own), *own.sum(0).tolist()]


def test_hilbert_curve_visits_neighbours():
    """Consecutive places differ by one step in one coordinate."""
    for width, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * width, indexing="ij"), -1).reshape(-1, width)
        keys = vector_codes.hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


# -- whitening ----------------------------------------------------------------

@pytest.mark.parametrize("kind", ["random", "equal", "steep", "singular"])
def test_feast_against_a_dense_solver(kind):
    rng = np.random.default_rng(3)
    n = 48
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    e = {"random": rng.random(n) * 10, "equal": np.repeat([5.0, 3, 2, 1], 12), "steep": np.exp(-np.arange(n) / 2.0),
         "singular": np.append(np.arange(1.0, 21), np.zeros(28))}[kind]
    cov = (q * e) @ q.T
    cov = (cov + cov.T) / 2
    parts = whitening.intervals(cov, 20)
    want = np.sort(e)[::-1]
    found = [whitening.feast(cov, low, high, count, i) for i, (low, high, count) in enumerate(parts)]
    values, vectors = np.concatenate([v for v, _ in found]), np.hstack([u for _, u in found])
    assert len(values) >= 20 and np.abs(values - want[:len(values)]).max() < 1e-12 * want[0] * n
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-9
    assert np.abs(cov @ vectors - vectors * values).max() < 1e-12 * want[0] * n
    diagonal, beside = whitening.tridiagonal(cov)
    shifts = rng.random(50) * 10
    assert whitening.counts_above(diagonal, beside, shifts).tolist() == [(e > s).sum() for s in shifts]


def test_a_missed_eigenvalue_is_an_error():
    with pytest.raises(whitening.EigenvaluesMissed):
        whitening.feast(np.diag([1.0, 2, 3, 4, 5, 6, 7, 8]), 2.5, 4.5, 3, 0)


def test_whitening_against_a_dense_solver(spark):
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(10, 10))
    x = rng.normal(size=(300, 10)) @ mix + 5
    rows = [(int(i) if i % 50 else None, v.tolist()) for i, v in enumerate(x)] + [(7, x[7].tolist()), (8, [1.0, 2.0])]
    bad = [(1, None), (2, [1.0, None] * 5), (3, [NAN] * 10), (4, [INF] * 10)]
    out = whitening.whiten(_vectors(spark, rows + bad), k=6).toPandas()
    c = np.zeros((len(rows), 10))
    for i, (_, v) in enumerate(rows):
        c[i, :len(v)] = v
    ints = np.floor(c * 64).astype(np.int64) + 1_000_000
    n, total = len(ints), ints.sum(0)
    cov = np.cov(ints.T, bias=True)
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1][:6], vector[:, ::-1][:, :6]
    want = (ints - total / n) @ vector / np.sqrt(value)
    deviation = ((n * ints - total) ** 2).sum(1)
    assert len(out) == 6 * n and set(out["n"]) == {n} and out["identity_error"].nunique() == 1
    assert out["identity_error"].iloc[0] < 1e-10
    got = {}
    for d, comp, w, e in out[["deviation", "component", "whitened", "explained"]].itertuples(index=False):
        got.setdefault(comp, []).append((d, w))
        assert abs(e - value[comp - 1] / np.trace(cov)) < 1e-12
    for comp, pairs in got.items():
        own = sorted(zip(deviation.tolist(), want[:, comp - 1]))
        pairs = sorted(pairs)
        assert [d for d, _ in pairs] == [d for d, _ in own]
        a, b = np.array([w for _, w in pairs]), np.array([w for _, w in own])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_whitening_cases(spark):
    assert whitening.whiten(_vectors(spark, [])).count() == 0
    assert whitening.whiten(_vectors(spark, [(1, [2.0, 3.0]), (2, [2.0, 3.0])])).count() == 0  # no direction varies
    line = whitening.whiten(_vectors(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (None, [3.0, 3.0])])).collect()
    assert [r.component for r in line] == [1, 1, 1] and all(abs(r.explained - 1) < 1e-12 for r in line)
    huge = whitening.whiten(_vectors(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 0.5])])).collect()
    assert {r.deviation for r in huge} >= {None} and all(np.isfinite(r.whitened) for r in huge)
