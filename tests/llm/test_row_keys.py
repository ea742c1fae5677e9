"""Rows that share an id or have none stay apart; reserved names do not clash;
stages judge each row by itself."""

import corpus_pipeline
import pytest
from corpus_fixtures import SF001, documents  # noqa: F401
from pyspark.sql import functions as F

from netstream.llm import decontaminate, language_id, line_dedup, near_dedup, substring_dedup

A = " ".join(f"a{i}" for i in range(60))
B = " ".join(f"b{i}" for i in range(60))
SAMPLES = {"en": "the cat sat on the mat and the dog ran to the old house by the sea " * 20}


def test_near_duplicates_keep_null_and_repeated_ids_apart(documents):
    for ident in (None, 7):
        docs = documents([(ident, A), (ident, B), (5, A), (6, B), (9, "short text")])
        got = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
        low = ident if ident is None else 5
        want_a, want_b = (ident, 5) if ident is None else (5, 5), (ident, 6) if ident is None else (6, 6)
        if ident is None:
            assert got == {(None, None, True), (5, None, False), (6, None, False), (9, 9, True)}
        else:  # 5 and 6 come before 7
            assert got == {(7, 5, False), (7, 6, False), (5, 5, True), (6, 6, True), (9, 9, True)}
        kept = near_dedup.keep_one(docs)
        assert kept.count() == 3 and {r.text for r in kept.collect()} == {A, B, "short text"}
        assert want_a and want_b and (low is None or low == 5)


def test_filters_judge_each_row(documents, spark):
    docs = documents([(None, "the cat ran to the sea"), (None, "123 456"), (None, "the dog sat"), (3, "..."), (3, "the mat")])
    kept = language_id.keep_identified(docs, SAMPLES)
    assert sorted(r.text for r in kept.collect()) == ["the cat ran to the sea", "the dog sat", "the mat"]
    sky = "What is the colour of the sky? It is blue today."
    items = spark.createDataFrame([(1, sky)], "item_id long, text string")
    docs = documents([(None, f"so {sky} yes"), (None, "a clean text"), (4, sky), (4, "another clean text"), (None, None)])
    kept = decontaminate.remove_leaking(docs, items)
    assert sorted(str(r.text) for r in kept.collect()) == ["None", "a clean text", "another clean text"]


def test_lines_and_words_of_rows_that_share_an_id(documents):
    w = "one\ntwo\nthree"
    for ident in (None, 4):
        docs = documents([(ident, f"{w}\nrest"), (ident, f"x\ny\n{w}"), (9, w)])
        out = {r.text for r in line_dedup.dedup_lines(docs).collect()}
        # one of the first two keeps the window (the first by text hash), everything else stays
        assert out in ({f"{w}\nrest", "x\ny", ""}, {"rest", f"x\ny\n{w}", ""})
        run = " ".join(f"r{i}" for i in range(25))
        docs = documents([(ident, f"{run} tail"), (ident, f"head {run}"), (9, run)])
        kept = {r.kept for r in substring_dedup.dedup_substrings(docs).collect()}
        assert kept in ({f"{run} tail", "head", ""}, {"tail", f"head {run}", ""})


def test_reserved_names_pass_through(documents, spark):
    names = ["_nx_covered", "_nx_key", "_nx_doc", "_nx_text", "_nx_lines", "_nx_0", "lines", "_nx_lines_removed", "key", "own",
             "h1", "id"]
    docs = documents([(1, "a\nb\nc"), (2, "a\nb\nc\nd"), (3, "the cat sat")], extra=names)
    outs = [line_dedup.dedup_lines(docs, stats_col=None), near_dedup.keep_one(docs), language_id.keep_identified(docs, SAMPLES),
            decontaminate.remove_leaking(docs, spark.createDataFrame([(1, "q w e? r t")], "item_id long, text string")),
            corpus_pipeline.line_dedup_stage(spark, docs, SF001), corpus_pipeline.near_dedup_stage(spark, docs, SF001)]
    for out in outs:
        assert out.columns == docs.columns
        assert all(r[n] == 7 for r in out.collect() for n in names)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_on_odd_rows(spark, documents, name, stage):
    """Nulls in every column, long texts, ties, repeated rows and clashing names:
    a stage returns the table's columns and keeps the clean rows."""
    long = "the cat sat on the mat and the dog ran " * 5_000
    docs = documents([(1, "the cat sat on the mat\nthe dog\nran"), (None, None), (2, ""), (3, long), (4, "the dog ran home"),
                      (4, "the dog ran home"), (None, "the old house by the sea")], langs=["en", None, None, "en", "en", "en", "en"],
                     extra=["n", "start", "lines", "_nx_covered"])
    docs = docs.withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.when(F.col("doc_id") != 1, F.col("n_chars")))
    out = stage(spark, docs, SF001)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    texts = {r.text for r in out.collect()}
    assert {"the dog ran home", "the old house by the sea", long} <= texts or name == "line_dedup"
    assert "the dog ran home" in texts
    assert stage(spark, docs.limit(0), SF001).count() == 0


def test_an_item_leaves_the_passages_of_others_alone(documents, spark):
    """An item strewn over 600 words is no leak, whatever else is in the
    benchmark; a long item that stands whole in a document is found."""
    rare = [f"q{i}" for i in range(12)]
    strewn = " ".join(w for i in range(0, 12, 3) for w in [*rare[i:i + 3], *(f"f{i}x{j}" for j in range(150))])
    longest = " ".join(f"z{i}" for i in range(2_000)) + ". The end of it"
    docs = documents([(1, strewn), (2, "before " + longest + " after")])
    short = [(1, " ".join(rare[:9]) + "? " + " ".join(rare[9:]))]
    for items in (short, [*short, (2, longest)]):
        found = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
        assert {(r.doc_id, r.item_id) for r in found} == ({(2, 2)} if len(items) > 1 else set())


def test_every_label_is_learned(documents):
    """Seventy labels with letters of their own, and a language with long texts
    only."""
    def word(label, i):
        return "".join(chr(0x4E00 + 40 * label + (7 * i + j * j) % 40) for j in range(3))
    texts = [(100 * n + i, " ".join(word(n, i + k) for k in range(30))) for n in range(70) for i in range(3)]
    long = [(9_000 + i, " ".join(f"lo{chr(97 + (i + k) % 26)}ng{chr(97 + k % 7)}" for k in range(4_000))) for i in range(3)]
    docs = documents(texts + long, langs=[f"l{i // 100}" for i, _ in texts] + ["long"] * 3)
    samples = language_id.learn(docs)
    assert len(samples) == 71 and len(samples["long"]) > 8_000
    got = language_id.identify(docs, samples).collect()
    assert sum(r.lang_pred == ("long" if r.doc_id >= 9_000 else f"l{r.doc_id // 100}") for r in got) == len(got)


def test_url_model_on_urls_it_has_not_seen(spark):
    """The model alone, with a labelled table of its own (no rule fits): held-out
    urls get the verdict that marks in host and path predict."""
    import random

    from netstream.llm import url_filter
    rng = random.Random(6)

    def url(bad):
        host = rng.choice(["casino", "pills", "winbig"] if bad else ["library", "museum", "gardens"])
        return (f"http://{host}{rng.randrange(1000)}.{rng.choice(['net', 'info'])}/"
                f"{rng.choice(['play', 'spin', 'buy'] if bad else ['read', 'visit', 'learn'])}/{rng.randrange(10_000)}")

    made = [(url(i % 2 == 0), "block" if i % 2 == 0 else "allow") for i in range(600)]
    train = spark.createDataFrame(made[:300], "url string, verdict string")
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(made[300:])], "page_id long, url string")
    out = {r.page_id: r for r in url_filter.judge(pages, train).collect()}
    right = sum(out[i].verdict == v for i, (_, v) in enumerate(made[300:]))
    assert right >= 0.98 * 300 and all(r.rule is None for r in out.values())


def test_url_and_leak_odd_cases(spark, documents):
    """Very long urls and texts, repeated pages and items, clashing names."""
    from netstream.llm import url_filter
    far = "http://example.org/es/" + "a" * 100_000
    pages = spark.createDataFrame([(1, far, 5), (1, far, 5), (2, "HTTP://X.COM/DE/", 5), (None, None, 5), (3, "://", 5)],
                                  "page_id long, url string, _nx_id int")
    labelled = spark.createDataFrame([("http://a.net/1", "allow"), ("http://b.net/2", "block")], "url string, verdict string")
    got = sorted((str(r.page_id), r.rule, r.host, r.verdict) for r in url_filter.judge(pages, labelled).collect())
    assert [g[:3] for g in got] == [("1", "example.org/es/", "example.org"), ("1", "example.org/es/", "example.org"),
                                    ("2", None, "x.com"), ("3", None, ""), ("None", None, "")]
    sky = "What is the colour of the sky? It is blue today."
    items = spark.createDataFrame([(1, sky, 1), (1, sky, 2), (5, sky, 3), (6, "", 4)], "item_id long, text string, score int")
    docs = documents([(1, "filler " * 200_000 + sky), (1, sky), (2, "x" * 500_000), (None, sky)], extra=["score", "_nx_item"])
    found = sorted((str(r.doc_id), r.item_id) for r in decontaminate.leaks(docs, items).collect())
    assert found == [("1", 1), ("1", 5), ("None", 1), ("None", 5)]
