"""The pipeline's stages and their SQL-expressible parts."""

import duckdb
import pytest
from corpus_fixtures import SF001, SF01

import corpus_pipeline
from netstream.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF01}/{table}.parquet')")
    df = queries.QUERIES[name](spark, SF01)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in rows.collect()}
        rows = stage(spark, rows, SF001)
        assert rows.columns == docs.columns, name
        kept = {r.doc_id for r in rows.collect()}
        assert kept <= before and len(kept) > 0.8 * len(before), name
    pieces = corpus_pipeline.STAGES[-1][1](spark, rows, SF001)
    assert {r.doc_id for r in pieces.collect()} == kept
    assert pieces.count() == corpus_pipeline.run(spark, SF001).count()


def test_stages_on_an_empty_table(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF001)
    assert rows.count() == 0


def _plain_line_dedup(rows):
    """``{id: text}`` after line dedup, documents emptied by it left out."""
    seen, gone = set(), set()
    lines = {i: t.split("\n") for i, t in rows}
    for i in sorted(lines):
        for at in range(len(lines[i]) - 2):
            window = tuple(lines[i][at:at + 3])
            if not "".join(window).strip(" \t\r\x0b\x0c"):
                continue
            if window in seen:
                gone |= {(i, at), (i, at + 1), (i, at + 2)}
            seen.add(window)
    out = {i: "\n".join(x for at, x in enumerate(own) if (i, at) not in gone) for i, own in lines.items()}
    return {i: t for i, t in out.items() if t.strip(" \n\r\t") or not any((i, at) in gone for at in range(len(lines[i])))}


def _plain_near_dedup(texts):
    """The first document of each component of all pairs."""
    sets = {}
    for i, t in texts.items():
        words = bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode()).split()
        sets[i] = {tuple(words[j:j + 5]) for j in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    head = {i: i for i in sets}
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and head[a] != head[b]:
                low, high = sorted((head[a], head[b]))
                head = {i: low if h == high else h for i, h in head.items()}
    return {i for i in ids if head[i] == i}


def test_pipeline_against_plain_stages(spark):
    """The rows of ``run`` against the stages in plain Python, on whole texts."""
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from netstream.llm import decontaminate, language_id
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    found = language_id.identify(docs, language_id.learn(language_id.training_rows(docs))).collect()
    known = {r.doc_id for r in found if r.lang_pred != "und" and r.phrase_length >= language_id.MIN_PHRASE}
    texts = _plain_line_dedup([(r.doc_id, r.text or "") for r in docs.collect() if r.doc_id in known])
    kept = _plain_near_dedup(texts)
    items = spark.read.parquet(f"{SF001}/benchmark.parquet").collect()
    words = {i: " ".join(w.decode() for w in decontaminate.item_words(texts[i])) for i in kept}
    whole = {i for i in kept if any(" ".join(w.decode() for w in decontaminate.item_words(r.text)) in words[i] for r in items)}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    for r in corpus_pipeline.run(spark, SF001).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert got.keys() <= kept - whole and len(kept - whole - got.keys()) <= 0.03 * len(kept)  # edited items leak as well
    for i, own in got.items():
        ids = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids + [1], "<u4")
        assert sum(n for _, n, _ in own) == len(ids)
        assert all(zlib.crc32(ids[s:s + n].tobytes()) == c for s, n, c in own)
