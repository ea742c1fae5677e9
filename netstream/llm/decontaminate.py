"""Benchmark decontamination: BM25 with block-max bounds.

The test items are the indexed side.  Their inverted index holds, per term, the
items with their BM25 impacts, and per block of ``BLOCK_ITEMS`` items the
largest impact.  Impacts are divided by the item's score against itself, so one
threshold (``MIN_SCORE``) serves all items.  Every passage of every document is
a query and gets all items at or above the threshold:

1. the sum of each distinct term's largest impact bounds the passage; passages
   below the threshold are skipped;
2. the sum of block maxima bounds each block of items for the passages left;
   blocks below the threshold are skipped;
3. the items of the blocks left are scored in full.

All passages of some hundred documents take each step together (numpy).

Bounds never underestimate, so nothing above the threshold is lost.  Items are
indexed by length class (up to 16 words, 64, 256, ...), a passage is two neighbouring
cells of the class's length, passages overlap by one cell: an item that stands in a
document stands whole in some passage, and no item changes the passages that another
of another length is held against.

A retrieved item counts as leaked if the passage holds at least ``MIN_OVERLAP``
of the word 3-grams of its question and of its answer.  An item is one text: its
answer is its last sentence, or its last quarter if it is a single sentence.

The index goes to the tasks in shards of at most ``SHARD_ITEMS`` items (and
about ``SHARD_CHARS`` characters), one pass over the documents per shard, so no
broadcast grows with the items.  Documents are not shuffled; ``remove_leaking`` is
a map that judges each row by its text, whatever its id.

Defined cases: words are runs of letters and digits, lower-cased; a null or
empty text leaks nothing, an item without words is never leaked; what rows of one id
leak is reported under the id (null ids together), repeated items are reported once;
empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.llm.common import KEY, TEXT, Chunk, filtered, id_of, keyed_texts, text_chunks
from netstream.session import cut_lineage

K1, BM25_B = 1.2, 0.75
MIN_SCORE = 0.5
MIN_OVERLAP = 0.7
GRAM = 3
BLOCK_ITEMS = 16
CLASS_WORDS, CLASS_STEP = 16, 4
SHARD_ITEMS, SHARD_CHARS = 20_000, 16_000_000
CELLS = 400_000
SCHEMA = f"{KEY} long, _nx_item long, score double, question_overlap double, answer_overlap double"

#: ASCII bytes that are no letter or digit part words; other scripts pass.
PARTING = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_CUT = bytes(32 if parts else b for b, parts in enumerate(PARTING))


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def item_words(text: str) -> list[bytes]:
    return lowered(pa.array([text]))[0].as_py().encode("utf-8", "replace").translate(_CUT).split()


def text_words(batches: Iterable[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        small = pa.RecordBatch.from_arrays([batch.column(KEY), lowered(batch.column(TEXT))], names=[KEY, TEXT])
        for keys, raw, bounds in text_chunks([small]):
            yield Chunk(keys, raw, bounds, False, parting=PARTING)


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer of an item."""
    sentences = [s for s in map(item_words, re.split(r"[.?!\n]+", text)) if s]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def grams(ids: Iterable[int]) -> set:
    ids = list(ids)
    return {tuple(ids[i:i + GRAM]) for i in range(max(1, len(ids) - GRAM + 1))} if ids else set()


def class_length(words: int) -> int:
    """Words of the longest items that share a class with an item of ``words``."""
    length = CLASS_WORDS
    while length < words:
        length *= CLASS_STEP
    return length


def figures(items: list[tuple[int, str]]) -> tuple[int, float, dict[bytes, int]]:
    """``(items, mean length, {word: items with it})``."""
    words = [w for w in (item_words(t or "") for _, t in items) if w]
    return len(words), sum(map(len, words)) / max(1, len(words)), Counter(w for ws in words for w in set(ws))


def class_indexes(items: list[tuple[int, str]], whole: tuple | None = None) -> list[ItemIndex]:
    """An index for each length class of the items; ``whole``: the figures of
    all items if these are only a shard."""
    whole, classes = whole or figures(items), {}
    for i, t in items:
        if words := item_words(t or ""):
            classes.setdefault(class_length(len(words)), []).append((i, t))
    return [ItemIndex(own, whole, cell) for cell, own in sorted(classes.items())]


class ItemIndex:
    """Inverted index of some items with impacts and block maxima.  ``whole``
    has the ``figures`` of all items if these are only a part; passages are twice
    ``cell`` words long (without it, the longest item's)."""

    def __init__(self, items: list[tuple[int, str]], whole: tuple | None = None, cell: int | None = None):
        items = [(i, t) for i, t in items if item_words(t or "")]
        words = [item_words(t) for _, t in items]
        self.ids = np.array([i for i, _ in items], np.int64)
        self.vocabulary = {w: n for n, w in enumerate(sorted({w for ws in words for w in ws}))}
        raw = np.frombuffer(b" ".join(self.vocabulary), np.uint8)
        hashes = Chunk(np.zeros(1, np.int64), raw, np.array([0, len(raw)]), False, parting=PARTING).hashes
        self.code = np.argsort(hashes)
        self.hashes = hashes[self.code]
        self.cell = cell or max(map(len, words), default=1)
        n_terms, n = len(self.vocabulary), len(items)
        found = [np.unique([self.vocabulary[w] for w in ws], return_counts=True) for ws in words]
        item = np.repeat(np.arange(n), [len(t) for t, _ in found])
        term = np.concatenate([t for t, _ in found] or [np.zeros(0, np.int64)])
        tf = np.concatenate([c for _, c in found] or [np.zeros(0)]).astype(np.float64)
        df = np.bincount(term, minlength=n_terms)
        length = np.array([len(w) for w in words], np.float64)
        total, mean = n, length.mean() if n else 1.0
        if whole:
            total, mean, counted = whole
            df = np.array([counted[w] for w in self.vocabulary], np.int64)
        norm = K1 * (1 - BM25_B + BM25_B * length / max(1.0, mean))
        impact = np.log1p((total - df + 0.5) / (df + 0.5))[term] * tf * (K1 + 1) / (tf + norm[item])
        impact /= np.bincount(item, impact, n)[item] if n else 1.0
        self.largest = np.zeros(n_terms)
        np.maximum.at(self.largest, term, impact)
        order = np.lexsort((item, term))
        term, self.item, self.impact = term[order], item[order], impact[order]
        self.begin = np.searchsorted(term, np.arange(n_terms + 1))
        self.blocks = max(1, -(-n // BLOCK_ITEMS))
        pair, at, size = np.unique(term * self.blocks + self.item // BLOCK_ITEMS, return_inverse=True, return_counts=True)
        self.block_top = np.zeros(len(pair))
        np.maximum.at(self.block_top, at, self.impact)
        self.block = pair % self.blocks
        self.block_begin = np.searchsorted(pair // self.blocks, np.arange(n_terms + 1))
        self.entry_begin = np.append(0, np.cumsum(size))  # the items of each (term, block)
        coded = [tuple([self.vocabulary[w] for w in part] for part in question_answer(t)) for _, t in items]
        self.question = [grams(q) for q, _ in coded]
        self.answer = [grams(a) for _, a in coded]

    def terms(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words by hash; -1: not in the vocabulary."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.code[at], -1)

    def _expand(self, terms, begin, *values):
        """For each term its list: the term's place, and the listed values."""
        counts = begin[terms + 1] - begin[terms]
        at = np.repeat(begin[terms] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return np.repeat(np.arange(len(terms)), counts), *(v[at] for v in values)

    def search(self, terms: np.ndarray, counts: np.ndarray, min_score: float,
               min_overlap: float) -> Iterator[tuple]:
        """``(document, item, score, question, answer)`` of each leak in
        documents of ``counts`` words (-1: not in the vocabulary)."""
        cells = -(-counts // self.cell)
        first = np.cumsum(cells) - cells
        begins = np.cumsum(counts) - counts
        doc = np.repeat(np.arange(len(counts)), cells)
        follows = np.append(doc[1:] == doc[:-1], False)[:len(doc)]  # the next cell is of the same document
        is_passage = follows | (cells[doc] == 1)
        within = np.arange(len(terms)) - np.repeat(begins, counts)
        cell = np.repeat(first, counts) + within // self.cell
        known = np.flatnonzero(terms >= 0)
        cell, term = cell[known], terms[known]
        own = is_passage[cell]
        before = (cell > 0) & follows[cell - 1] if len(cell) else own
        n_terms = max(1, len(self.vocabulary))
        pairs = np.sort(np.append(cell[own] * n_terms + term[own], (cell[before] - 1) * n_terms + term[before]))
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)]]
        passage, term = pairs // n_terms, pairs % n_terms
        slack = min_score - 1e-9
        live = np.bincount(passage, self.largest[term], len(doc)) >= slack
        keep = live[passage]
        passage, term = passage[keep], term[keep]
        step = max(1, CELLS // max(1, len(self.ids)))
        for at in self._slices(passage, step):
            for p, i, score in self._scores(passage[at], term[at], slack):
                d = doc[p]
                a = begins[d] + (p - first[d]) * self.cell
                b = min(begins[d] + counts[d], a + 2 * self.cell)
                seen = terms[a:b].tolist()
                shares = [self._share(part, grams(seen), set(seen)) for part in (self.question[i], self.answer[i])]
                if min(shares) >= min_overlap:
                    yield int(d), int(self.ids[i]), float(score), *shares

    @staticmethod
    def _slices(passage: np.ndarray, step: int) -> Iterator[slice]:
        """Parts of the pairs with at most ``step`` passages each."""
        starts = np.flatnonzero(np.append(True, passage[1:] != passage[:-1])[:len(passage)])
        for i in range(0, len(starts), step):
            yield slice(int(starts[i]), int(starts[i + step]) if i + step < len(starts) else len(passage))

    def _scores(self, passage: np.ndarray, term: np.ndarray, slack: float) -> Iterator[tuple]:
        """``(passage, item, score)`` at or above the threshold."""
        own, row = np.unique(passage, return_inverse=True)
        at, entry = self._expand(term, self.block_begin, np.arange(len(self.block)))
        place = row[at] * self.blocks + self.block[entry]
        bound = np.bincount(place, self.block_top[entry], len(own) * self.blocks)
        keep = bound[place] >= slack
        rows = row[at[keep]]
        at, item, impact = self._expand(entry[keep], self.entry_begin, self.item, self.impact)
        score = np.bincount(rows[at] * len(self.ids) + item, impact, len(own) * len(self.ids))
        for hit in np.flatnonzero(score >= slack):
            yield own[hit // len(self.ids)], hit % len(self.ids), score[hit]

    @staticmethod
    def _share(part: set, seen: set, words: set) -> float:
        """Share of a part's grams in the passage; a part of fewer than
        ``GRAM`` words is one gram, present if its words are."""
        if not part:
            return 1.0
        return sum(g in seen if len(g) == GRAM else words.issuperset(g) for g in part) / len(part)


def _found(texts: DataFrame, indexes: list[ItemIndex], min_score: float, min_overlap: float) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(indexes)

    def search(batches):
        for chunk in text_words(batches):
            rows = [(int(chunk.keys[d]), *r) for own in shared.value
                    for d, *r in own.search(own.terms(chunk.hashes), chunk.counts, min_score, min_overlap)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                                 names=[c.split()[0] for c in SCHEMA.split(", ")])

    return texts.mapInArrow(search, SCHEMA)


def _whole(items: DataFrame):
    """The ``figures`` of all ``items(KEY, TEXT, _nx_shard)`` for a shard, document
    frequencies for the shard's words only."""
    def words(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for shard, text in zip(batch.column("_nx_shard").to_pylist(), batch.column(TEXT).to_pylist()):
                if found := item_words(text):
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([len(found)], pa.int64()),
                                                      pa.array([sorted(set(found))], pa.list_(pa.binary()))],
                                                     names=["shard", "size", "words"])

    each = cut_lineage(items.select(F.col("_nx_shard").cast("long").alias("_nx_shard"), TEXT)
                       .mapInArrow(words, "shard long, size long, words array<binary>"), name="item-words")
    n, mean = each.agg(F.count(F.lit(1)), F.avg("size")).first()
    listed = each.select("shard", F.explode("words").alias("word")).groupBy("word", "shard").agg(F.count(F.lit(1)).alias("n"))
    counted = cut_lineage(listed.groupBy("word").agg(F.sum("n").alias("df"), F.collect_set("shard").alias("shards")),
                          name="item-df")

    def of(shard: int) -> tuple:
        rows = counted.where(F.array_contains("shards", F.lit(shard).cast("long"))).select("word", "df").collect()
        return n, mean or 1.0, {bytes(r["word"]): r["df"] for r in rows}
    return of


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE,
          min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``id_col, item_id_col, score, question_overlap, answer_overlap``: each
    document with each item it leaks (the best passage's figures)."""
    texts, found = keyed_texts(docs, id_col, text_col), None
    for indexes in item_shards(items, item_id_col, item_text_col):
        part = _found(texts, indexes, min_score, min_overlap)
        found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], SCHEMA)
    best = found.groupBy(KEY, "_nx_item").agg(
        F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("b"))
    return best.select(id_of().alias(id_col), id_of("_nx_item").alias(item_id_col), "b.*")


def item_shards(items: DataFrame, item_id_col: str, item_text_col: str) -> Iterator[list[ItemIndex]]:
    """The indexes of each shard of the items."""
    tests = keyed_texts(items, item_id_col, item_text_col)
    n, chars = tests.agg(F.count(F.lit(1)), F.sum(F.length(TEXT))).first()
    shards = max(-(-n // SHARD_ITEMS), -(-(chars or 0) // SHARD_CHARS))
    own = F.pmod(F.xxhash64(KEY, TEXT), F.lit(max(1, shards)))
    whole = _whole(tests.withColumn("_nx_shard", own).distinct()) if shards > 1 else None
    for shard in range(shards):
        rows = tests.where(own == shard).distinct().collect()
        yield class_indexes(sorted((r[KEY], r[TEXT]) for r in rows), whole and whole(shard))


def remove_leaking(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                   item_text_col: str = "text", min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """``docs`` without the documents that leak an item."""
    for indexes in item_shards(items, item_id_col, item_text_col):
        docs = _without(docs, indexes, text_col, min_score, min_overlap)
    return docs


def _without(docs: DataFrame, indexes: list[ItemIndex], text_col: str, min_score: float, min_overlap: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(indexes)

    def keep(texts: pa.Array) -> np.ndarray:
        out = np.ones(len(texts), bool)
        batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), texts], names=[KEY, TEXT])
        for chunk in text_words([batch]):
            for own in shared.value:
                for d, *_ in own.search(own.terms(chunk.hashes), chunk.counts, min_score, min_overlap):
                    out[chunk.keys[d]] = False
        return out

    return filtered(docs, text_col, keep)


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` against all ``benchmark`` items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return leaks(docs, items)
