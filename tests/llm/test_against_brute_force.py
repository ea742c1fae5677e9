"""Operators against plain Python on whole small tables, and held-out accuracy."""

import collections
import itertools
import math
import zlib

import numpy as np
import pytest
from corpus_fixtures import SF001, SF01, documents  # noqa: F401
from pyspark.sql import functions as F

import public_tokenizers
from netstream.llm import (components, decontaminate, fingerprint, language_id, language_model, near_dedup, packing,
                           quality, substring_dedup, tokens)
from netstream.llm.common import Chunk, keyed_texts, run_hashes, whole_runs


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def _chunk(texts, lower=False):
    raw = [t.encode() for t in texts]
    return Chunk(np.arange(len(raw)), np.frombuffer(b"".join(raw), np.uint8),
                 np.append(0, np.cumsum([len(r) for r in raw])), lower)


def test_words_and_hashes():
    texts = ["ab  cd\tab", "", "ab", " x\x0by ", "ab" * 400, "é ab\x1cq"]
    chunk = _chunk(texts)
    words = [w for t in texts for w in t.encode().split()]
    assert [chunk.word(i) for i in range(len(chunk.starts))] == words
    assert chunk.counts.tolist() == [len(t.encode().split()) for t in texts]
    ids = {}
    assert [ids.setdefault(w, h) == h for w, h in zip(words, chunk.hashes.tolist())] == [True] * len(words)
    assert len(set(ids.values())) == len(ids)
    assert _chunk(["ÀB ab"], lower=True).hashes[1] == _chunk(["AB"], lower=True).hashes[0]


@pytest.mark.parametrize("k", [1, 2, 5, 8, 20])
def test_run_hashes(k):
    x = np.random.default_rng(k).integers(0, 3, 300).astype(np.uint64)
    h = run_hashes(x, k)
    seen = {}
    for i in range(len(h)):
        assert seen.setdefault(tuple(x[i:i + k]), h[i]) == h[i]
    assert len(set(seen.values())) == len(seen)
    assert whole_runs(np.array([3, 0, 2]), 2).tolist() == [0, 1, 3]


def test_difference_cover():
    steps = [[(a + d) % 13 in substring_dedup.COVER and (b + d) % 13 in substring_dedup.COVER for d in range(13)]
             for a, b in itertools.product(range(13), repeat=2)]
    assert all(map(any, steps)) and substring_dedup.WINDOW == 20


def test_winnowing(spark, documents):
    """Equal to the definition, with the rightmost of equal minima, and any
    shared run of K + WINDOW - 1 words is found."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abc"), n)) for n in (0, 1, 3, 4, 11, 12, 200)]
    texts += ["x y " + texts[-1][20:42] + " z"]
    rows = fingerprint.fingerprints(documents(texts), blocks=2).collect()
    k, w = fingerprint.K, fingerprint.WINDOW
    low = (1 << fingerprint.PLACE_BITS) - 1
    got = {r.doc_id: {(low - (x & low), x >> fingerprint.PLACE_BITS) for x in r.fp} for r in rows}
    for i, t in enumerate(texts):
        words = t.split()
        assert len(got[i]) == (0 if not words else len({p for p, _ in got[i]}))
        if len(words) >= k:
            hash_at = dict(got[i])
            last = len(words) - k
            assert all(p <= last for p in hash_at)
            for s in range(max(1, last - w + 2)):  # each window has a pick, its minimum
                assert any(s <= p < s + w for p in hash_at)
    shared = {h for _, h in got[6]} & {h for _, h in got[7]}
    assert shared
    by = {r.doc_id: r for r in rows}
    for i, t in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        half = len(t) // 2
        assert by[i].edited == t[:len(t) - half] + after[:half]
        assert by[i].next_fp == by[(i + 1) % len(texts)].fp


def test_near_dedup_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    sets = {}
    for i, t in rows.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    both = collections.Counter(p for ids in where.values() for p in itertools.combinations(sorted(ids), 2))
    head = {i: i for i in sets}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            head[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, j) for j in range(8, 40)] + [(39, 100), (500, 501), (5, 5)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 7 for i in [*range(7, 40), *range(100, 161)]}, 500: 500, 501: 500}


def test_suffix_automaton_cross_parsing():
    sample = "abracadabra kadabra"
    parser = language_id.CrossParser({"x": sample})
    flat, counts, letters = parser.symbols(["abrakadabra dabra! zz", "bra", ""])
    own, _, _ = parser.symbols([sample])
    own, starts, want = own.tolist(), np.append(0, np.cumsum(counts)), []
    for a, b in zip(starts, starts[1:]):
        text, n, i = flat[a:b].tolist(), 0, 0
        while i < len(text):
            j = i + 1
            while j <= len(text) and any(own[s:s + j - i] == text[i:j] for s in range(len(own))):
                j += 1
            i, n = max(j - 1, i + 1), n + 1
        want.append(n)
    got = parser.phrases(flat, counts)[:, 0]
    assert got[:2].tolist() == want[:2] and letters.tolist() == [18, 3, 0]


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_id.query(spark, SF01).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = [r for r in quality.query(spark, SF01).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_language_model(spark, small):
    """Counts and base score against plain Python; better than the base on held
    out texts; probabilities of one context sum to one."""
    texts = {r.doc_id: r.text.encode().lower().split() + [None] for r in small.collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = collections.Counter(w for i, ws in texts.items() if not out[i] for w in ws)
    n, v = sum(count.values()), len(count)
    rows = {r.doc_id: r for r in language_model.query(spark, SF001).collect()}
    for i, ws in texts.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(ws), sum(w in count for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
    assert sum(rows[i].score for i in rows if out[i]) > sum(rows[i].base_score for i in rows if out[i])


def test_predictive_probabilities_sum_to_one(spark, small):
    from netstream.llm.common import keyed_texts
    model, rare = language_model.fit(keyed_texts(small), symbols=40, table_words=300, burn_in=2, samples=2)
    assert np.allclose((10.0 ** model.log_symbols()).sum(1), 1, atol=1e-4)
    q = 10.0 ** model.rare_log[model.vocabulary.rank >= model.vocabulary.symbols]
    total = q.sum() + sum(r.q for r in rare.collect()) + model.unseen
    assert total == pytest.approx(1, abs=1e-6)


def test_seating_follows_the_restaurant():
    """Mean tables of many restaurants against seating one by one."""
    rng = np.random.default_rng(5)
    n, a, d = 200, 3.0, language_model.DISCOUNT
    t = language_model.seat(np.full(4000, n), np.full(4000, a), np.arange(4000, dtype=np.uint64) * np.uint64(7919), d)
    plain = []
    for _ in range(1500):
        tables = 1
        for k in range(1, n):
            tables += rng.random() < a / (k - d * tables + a)
        plain.append(tables)
    assert abs(t.mean() - np.mean(plain)) < 0.2 and abs(t.std() - np.std(plain)) < 0.3


def test_leaks_equal_plain_containment(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    items = spark.read.parquet(f"{SF01}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}

    def grams(text):
        w = decontaminate.item_words(text)
        return {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    parts = {r.item_id: grams(r.text) for r in items.collect()}
    want = set()
    for r in docs.collect():
        own = grams(r.text)
        want |= {(r.doc_id, i) for i, g in parts.items() if len(g & own) >= 0.7 * len(g)}
    assert got == want


def test_block_max_search_equals_full_scores():
    rng = np.random.default_rng(9)
    words = [f"t{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words, rng.integers(5, 20)))) for i in range(70)]
    index = decontaminate.ItemIndex(items)
    texts = [rng.choice(words + ["zz"], n).tolist() for n in (0, 3, 40, 200)] + [items[5][1].split() + ["zz"] * 9]
    counts = np.array([len(t) for t in texts])
    terms = np.array([index.vocabulary.get(w.encode(), -1) for t in texts for w in t], np.int64)
    got = {(d, i): s for d, i, s, _, _ in index.search(terms, counts, 0.3, 0.0)}
    best = {}
    for d, t in enumerate(texts):
        codes = [index.vocabulary.get(w.encode(), -1) for w in t]
        for a in range(0, max(1, len(t)), index.cell):
            own = sorted({c for c in codes[a:a + 2 * index.cell] if c >= 0})
            for c in range(len(items)):
                s = sum(index.impact[j] for o in own for j in range(index.begin[o], index.begin[o + 1]) if index.item[j] == c)
                if s >= 0.3:
                    best[(d, c)] = True
    assert set(got) == set(best)


def test_leaks_do_not_depend_on_shards(spark, monkeypatch):
    """The same scores from one index shard and from several."""
    rng = np.random.default_rng(21)
    words = [f"t{i}" for i in range(90)]
    texts = [rng.choice(words, rng.integers(5, 30)).tolist() for _ in range(40)]
    items = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "item_id long, text string")
    edited = [[w if rng.random() < 0.75 else "zz" for w in t] for t in texts]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(edited)], "doc_id long, text string")

    def found():
        rows = decontaminate.leaks(docs, items, min_score=0.2, min_overlap=0.0).collect()
        return {(r.doc_id, r.item_id): round(r.score, 9) for r in rows}

    one = found()
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 9)
    assert len(one) > 30 and found() == one


def test_packing_round_trip(spark, small):
    """Every id in exactly one piece, the tokenizer's own ids, full sequences."""
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = [(10_001, "it's. a.b ...  !!. <|endoftext|>x, I.\u00a0don't\u2003STOP, é. 3.5, x.,"), (10_002, None), (10_003, "")]
    docs = small.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    ids = {r.doc_id: np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
           for r in docs.collect()}
    pieces = packing.pack(docs, path, shard_tokens=60_000).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes())
    for i, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert sum(p.length for p in own) == len(ids[i])
    assert set(by_doc) == set(ids)
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert (n := sum(p.length for p in own)) <= 2048 and n & (n - 1) == 0
    # neighbours: what shares a window is more alike than what does not
    assert len(by_sequence) > 10


def _bm25(docs, seed):
    """Scores of all documents for ``seed``'s terms, by the formula."""
    mean = sum(map(len, docs)) / len(docs)
    df = collections.Counter(t for d in docs for t in set(d.tolist()))
    score = [0.0] * len(docs)
    for t in sorted(set(docs[seed].tolist())):
        if df[t] > 1:
            idf = math.log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5))
            for i, d in enumerate(docs):
                tf = int((d == t).sum())
                score[i] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
    return score


def _figures(docs):
    df = collections.Counter(t for d in docs for t in set(d.tolist()))
    return packing.Figures(len(docs), sum(map(len, docs)), np.array([df[i] for i in range(max(df) + 1)]))


def test_packing_scores_all_terms():
    """Neighbours of documents with many shared terms, common and rare: BM25's
    order, and none that shares a term is missing; used documents are left out."""
    rng = np.random.default_rng(12)
    docs = [np.append(rng.choice(400, rng.integers(60, 200)) if i % 2 else 400 + rng.choice(4000, 150), 1).astype("<u4")
            for i in range(40)]
    shard = packing.Shard(docs, _figures(docs))
    for seed in range(len(docs)):
        score = _bm25(docs, seed)
        free = [i for i in range(len(docs)) if not shard.used[i] and score[i] > 0]
        got = list(shard.neighbours(seed))
        assert sorted(got) == free
        assert np.allclose([score[i] for i in got], sorted((score[i] for i in free), reverse=True))
        shard.take(seed)


def test_packing_is_greedy():
    """A shard against a packer that scores and places one document after the
    other in plain Python."""
    rng = np.random.default_rng(3)
    docs = [np.append(rng.zipf(1.3, rng.integers(1, 90)) % 500 + 2, 1).astype("<u4") for _ in range(120)]
    docs += [docs[5], docs[5], np.array([1], "<u4")]
    free, where, filled, sequence, seed, at = list(range(len(docs))), [], 0, 0, None, 0
    while free:
        score = _bm25(docs, seed) if seed is not None else [0.0] * len(docs)
        best = max(free, key=lambda i: (round(score[i], 4), -i))
        if score[best] <= 0:
            best, seed = free[0], free[0]
        free.remove(best)
        for start in itertools.count():
            if start == len(docs[best]):
                break
            where.append((best, start, sequence, filled))
            filled += 1
            if filled == 128:
                sequence, filled, seed = sequence + 1, 0, best
    got = [(d, s + i, q, o + i) for d, s, n, q, o in packing.fill(docs, _figures(docs), 128) for i in range(n)]
    full = [w for w in where if w[2] < sequence]
    assert [g for g in got if g[2] < sequence] == full and len(got) == len(where)


def test_packing_brings_copies_together(spark, small):
    """Near copies far apart in the table lie in one shard, at any number of
    shards; rows equal in all are spread over several."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [(r.doc_id, r.text) for r in small.select("doc_id", "text").where("length(text) between 600 and 3000").collect()][:60]
    near = [(1000 + i, f"{t} and some more words") for i, t in texts[:20]]
    docs = spark.createDataFrame(texts + near, "doc_id long, text string")
    keyed = keyed_texts(docs)
    ranked = packing.tokenised(keyed, path, 1, packing.router(keyed, path, 1)).orderBy("near", "rare", "pid")
    order = [r._nx_key for r in ranked.collect()]
    place = {k: i for i, k in enumerate(order)}
    assert sum(abs(place[1000 + i] - place[i]) <= 2 for i, _ in texts[:20]) >= 15
    same = spark.range(400).selectExpr("cast(null as long) doc_id", "'some words of a text' text")
    pieces = packing.pack(same, path, seq_len=64, shard_tokens=300).collect()
    assert sum(p.length for p in pieces) == 400 * pieces[0].doc_tokens
    short = {p.sequence_id for p in pieces if p.length + p.offset < 64}
    assert len(short) > 5  # the last sequences of several shards


def test_added_tokens_are_case_sensitive():
    """An added token's text counts only as it is written."""
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = ["a <|ENDOFTEXT|> b", "a <|endoftext|> b", "X<|EndOfText|>Y <|ENDOFTEXT|>, z", "<|STARTOFTEXT|>", "Plain"] * 2
    raw = [t.encode() for t in texts]
    words = tokens.shard_words(np.arange(len(raw)), np.frombuffer(b"".join(raw), np.uint8),
                                np.append(0, np.cumsum([len(r) for r in raw])))
    got = tokens.WordTokenizer(path)(words, 1)
    assert [d.tolist() for d in got] == [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]


def test_near_dedup_large_group(spark, documents, monkeypatch):
    """A large group of near copies, many near the threshold, through tiles of
    a few documents: the components of all pairs."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for i in range(90):
        words = list(base)
        for at in rng.choice(80, rng.integers(0, 7), replace=False):
            words[at] = f"e{i}x{at}"
        texts.append(" ".join(words))
    sets = [{tuple(w[j:j + 5]) for j in range(len(w) - 4)} for w in map(str.split, texts)]
    head = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        n = len(sets[a] & sets[b])
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n) and head[a] != head[b]:
            low, high = sorted((head[a], head[b]))
            head = [low if h == high else h for h in head]
    assert 1 < len(set(head)) < 60
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", 1)
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 3)
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", 10)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(documents(texts)).collect()}
    assert got == dict(enumerate(head))
