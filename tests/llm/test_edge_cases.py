"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
column names, for every operator."""

import pytest
from corpus_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

import public_tokenizers
from netstream.llm import (decontaminate, fingerprint, language_id, language_model, line_dedup, near_dedup, packing,
                           quality, substring_dedup, url_filter)
from netstream.llm.common import keyed_texts

LONG = " ".join(f"w{i}" for i in range(20_000))
TEXTS = [None, "", " \n\t ", "one", "a b c d e f", "a b c d e f", LONG, "x" * 50_000, "Ünï çödé\x0bwörds", "...", None]
NAMES = ["n", "h", "bucket", "component", "id", "score", "start", "starts", "word", "row", "n_words", "n_removed",
         "n_lines", "host", "block", "extra", "next_text", "fp", "key", "places", "line_dedup", "b", "label"]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

SAMPLES = {"en": "the cat sat on the mat and the dog ran", "de": "der hund lief und die katze saß auf der matte"}


def _items(docs):
    return docs.sparkSession.createDataFrame([(1, "What is the colour of the sky? It is blue today."), (2, None)],
                                             "item_id long, text string")


def _fingerprints(docs):
    return fingerprint.fingerprints(docs, blocks=3)


def _model(docs):
    model, rare = language_model.fit(keyed_texts(docs), symbols=5, table_words=8, burn_in=1, samples=2)
    return language_model.score(docs, model, rare)


def _quality(docs):
    labels = docs.select("doc_id", F.lit(1).alias("quality")).union(
        docs.sparkSession.createDataFrame([(3, 0), (None, 1), (99, 0)], "doc_id long, quality int"))
    return quality.score(docs, quality.train(docs, labels, features=1 << 10, updates=10))


OPERATORS = {
    "line_dedup": line_dedup.dedup_lines,
    "fingerprint": _fingerprints,
    "near_dedup": near_dedup.near_duplicates,
    "language_id": lambda d: language_id.identify(d, SAMPLES),
    "language_model": _model,
    "substring_dedup": substring_dedup.dedup_substrings,
    "quality": _quality,
    "packing": lambda d: packing.pack(d, TOKENIZER, shard_tokens=1 << 18),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_texts(documents, name):
    """Each row has its result; a null id and repeated rows are documents too."""
    rows = [*enumerate(TEXTS), (None, "no id"), (4, "a b c d e f"), (4, "a b c d e f")]
    docs = documents(rows, extra=NAMES)
    out = OPERATORS[name](docs).collect()
    if name == "packing":
        assert sum(r.length for r in out if r.start == 0 and r.doc_id == 4) == 3 * 7
        assert {r.doc_id for r in out} == {i for i, _ in rows}
    else:
        assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in rows)
    if name not in ("packing", "fingerprint"):  # equal rows have equal results (edited texts depend on the next row)
        assert len({repr(r) for r in out if r.doc_id == 4}) == 1


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(documents, name):
    assert OPERATORS[name](documents([])).count() == 0


def test_line_dedup_cases(documents):
    w = "a\nb\nc"
    docs = documents([(2, f"x\n{w}\ny"), (1, w), (3, f"{w}\nz\n{w}"), (4, "\n\n\n\n\n\n"), (5, "a\nb"), (6, None),
                      (1, w)], extra=NAMES)
    out = line_dedup.dedup_lines(docs)
    got = {r.doc_id: (r.text, r.line_dedup.n_lines, r.line_dedup.n_removed) for r in out.collect()}
    assert got == {1: (w, 3, 0), 2: ("x\ny", 5, 3), 3: ("z", 7, 6), 4: ("\n" * 6, 7, 0), 5: ("a\nb", 2, 0), 6: (None, 0, 0)}
    assert set(NAMES) - {"line_dedup"} <= set(out.columns)


def test_near_dedup_cases(documents):
    base = [f"v{i}" for i in range(40)]
    near = base[:38] + ["p", "q"]
    docs = documents([(5, " ".join(base)), (3, " ".join(base).upper()), (9, " ".join(near)), (1, "x y"), (2, " X  y "),
                      (4, None), (6, ""), (7, " ".join(base[:20]))])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    # V and v are one letter lower-cased; 34 of 38 shingles are shared with the edited text
    assert got == {5: (36, 3, False), 3: (36, 3, True), 9: (36, 3, False), 1: (1, 1, True), 2: (1, 1, False),
                   4: (0, 4, True), 6: (0, 6, True), 7: (16, 7, True)}


def test_substring_dedup_cases(documents):
    run = [f"r{i}" for i in range(25)]
    docs = documents([(2, " ".join(["a", *run, "b"])), (1, " ".join(run)), (3, " ".join(run[:19])),
                      (4, " ".join(run[3:23]) + "  tail\n" + " ".join(run[3:23]))])
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.dedup_substrings(docs).collect()}
    assert got == {1: (25, 0, " ".join(run)), 2: (27, 25, "a b"), 3: (19, 0, " ".join(run[:19])), 4: (41, 40, "tail")}


def test_url_rules(spark):
    urls = {"http://Sub.Example.ORG/es/1": ("sub.example.org", "/es/1", "example.org/es/", "block"),
            "https://example.org/en/12?x#y": ("example.org", "/en/12", "example.org/en/1", "block"),
            "https://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
            "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
            "http://a.com/fr/#top": ("a.com", "/fr/", "com/fr/", "allow"),
            "http://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
            "http://acom/fr/": ("acom", "/fr/", None, None),
            "http://x.org": ("x.org", "", None, None),
            "http://x.org?a=/": ("x.org", "", None, None),
            "no scheme": ("", "", None, None), None: ("", "", None, None), "": ("", "", None, None),
            "a://b://c/d": ("b:", "//c/d", None, None)}
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, host int")
    labelled = spark.createDataFrame([(f"http://h{i}.net/{'de' if i % 2 else 'fr'}/{i}", "block" if i % 2 else "allow")
                                      for i in range(40)], "url string, verdict string")
    for table in (labelled, labelled.limit(0), labelled.where("verdict = 'block'")):
        out = {urls_key: r for urls_key, r in zip(urls, url_filter.judge(pages, table).orderBy("page_id").collect())}
        for u, (host, path, rule, verdict) in urls.items():
            assert (out[u].host, out[u].path, out[u].rule) == (host, path, rule)
            assert out[u].verdict in ("allow", "block") and (verdict is None or out[u].verdict == verdict)
    assert url_filter.judge(pages.limit(0), labelled).count() == 0


def test_decontaminate_cases(documents, spark):
    sky = "What is the colour of the sky? It is blue today."
    docs = documents([(1, "filler " * 300 + sky + " more words here"), (2, sky.upper().replace("?", " ")), (3, None),
                      (4, ""), (5, "what is the colour of grass it is green"), (1, "other"), (None, sky)], extra=NAMES)
    items = _items(docs).withColumn("score", F.lit(1))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (None, 1)}
    kept = decontaminate.remove_leaking(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    assert kept.columns == docs.columns
    assert decontaminate.leaks(docs.limit(0), items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
