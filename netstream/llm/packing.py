"""Packing by lexical retrieval.

Documents become token ids followed by an end id and fill sequences of
``seq_len`` ids.  BM25 decides what stands together: a seed document opens a
window, and its unused neighbours, best score by all its terms first, fill it.
The document that crosses the end of a window is cut there, and its rest opens the
next window and asks for its own neighbours.  When no unused document shares a
term, the next unused document is the seed.

The inverted index is sharded.  Document frequencies, mean length and number of
documents are the corpus's.  Documents go to shards by content: first by the
nearest of ``CENTROIDS`` centroids (fitted on about ``SAMPLE`` documents, laid out so that
like ones are near each other), then by their ``RAREST`` rarest ids (as the sample
has them), so that copies and near copies lie side by side; a range sort by this
key and the document's own number spreads any hot key over many tasks.  A task
cuts its sorted documents into shards of ``shard_tokens`` ids, indexes one shard at a
time, asks it for every seed and writes its pieces.  So the work grows with the
corpus, and the driver holds a number per id of the tokenizer and the centroids,
nothing per document.

A seed asks the shard it lies in.  The README has the share of a seed's 16 best
documents of the whole corpus that lie there.

All sequences are full except a shard's last, which is cut into sequences of the
powers of two in its length; these need no padding.

Defined cases: a null or empty text is the end id alone; a null id is a document
like any other; repeated rows are packed as often as they stand in the table;
equal scores go by the order in the shard; a document longer than a shard is a
shard of its own; an empty table gives no pieces.  Only the id and the text are
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.llm.common import KEY, forget, id_of, keyed_texts
from netstream.llm.tokens import token_ids, vocabulary
from netstream.llm.vectors import slot_sums
from netstream.session import cut_lineage

SEQ_LEN = 2048
END_ID = 1
SHARD_TOKENS = 2_000_000
TASK_TOKENS = 4_000_000
K1, BM25_B = 1.2, 0.75
CENTROIDS, SAMPLE, DIMENSIONS = 64, 4_000, 64
RAREST, RARE_BITS = 3, 21
FIRST_NEIGHBOURS = 64
DENSE = 16
SORTED_IDS = 16_384
TASK_BITS = 40
STORED = f"pid long, {KEY} long, wide boolean, ids binary"
PIECES = f"{KEY} long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _documents(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Ids of each document, two bytes each where they fit."""
    return [np.frombuffer(b.as_buffer(), "<u4" if w else "<u2")
            for w, b in zip(batch.column("wide").to_pylist(), batch.column("ids"))]


class _Distinct:
    """Distinct ids of one document after the other, ascending.  A document is
    sorted; only a long one is marked in a mask of all ids, which costs the same for
    every document."""

    def __init__(self, ids: int):
        self.ids, self.seen = ids, None

    def __call__(self, doc: np.ndarray) -> np.ndarray:
        if len(doc) <= SORTED_IDS:
            found = np.sort(doc.astype("<u4", copy=False))
            new = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=new[1:])
            return found[new].astype(np.int64)
        if self.seen is None:
            self.seen = np.zeros(self.ids, bool)
        self.seen[doc] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


def _counted(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, ascending, and how often each occurs."""
    ids = np.sort(doc)
    ends = np.flatnonzero(np.append(ids[1:] != ids[:-1], True))
    return ids[ends].astype(np.int64), np.diff(ends, prepend=-1)


# -- figures of the corpus ----------------------------------------------------

class Figures:
    """Documents, documents with each id, and mean length of the whole corpus."""

    def __init__(self, n: int, tokens: int, df: np.ndarray):
        self.df, self.tokens, self.mean = df, tokens, tokens / max(n, 1)
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5)) * (df > 1)  # an id of one document links nothing

    @classmethod
    def of(cls, stored: DataFrame, ids: int) -> Figures:
        def count(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
            total, distinct = np.zeros(ids + 2, np.int64), _Distinct(ids)
            for batch in batches:
                docs = _documents(batch)
                total[:2] += len(docs), sum(map(len, docs))
                for doc in docs:
                    total[2 + distinct(doc)] += 1
            return total

        n, tokens, *df = slot_sums(stored.select("wide", "ids"), count, ids + 2, "long").tolist()
        return cls(n, tokens, np.array(df))

    def weights(self, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The document's distinct ids and their BM25 weights in it."""
        terms, tf = _counted(doc)
        norm = K1 * (1 - BM25_B + BM25_B * len(doc) / self.mean)
        return terms, tf * (K1 + 1) / (tf + norm) * self.idf[terms]


# -- routing by content -------------------------------------------------------

def directions(ids: int) -> np.ndarray:
    """A random direction per id."""
    return np.random.default_rng(7).standard_normal((ids, DIMENSIONS), np.float32)


class Router:
    """Where a document goes: ``near``, the place of its centroid, and
    ``rare``, its rarest ids as one number."""

    def __init__(self, figures: Figures, middle: np.ndarray | None = None):
        self.df, self.middle = figures.df, middle
        self.along = directions(len(figures.df)) * figures.idf[:, None].astype(np.float32)

    def sketches(self, terms: list[np.ndarray]) -> np.ndarray:
        """The distinct ids of documents along a few random directions, by
        their idf."""
        out = np.stack([self.along[t].sum(0) for t in terms])
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def terms(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        distinct = _Distinct(len(self.df))
        return [distinct(d) for d in docs]

    def places(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``near`` and ``rare`` of each document (none is empty)."""
        terms = self.terms(docs)
        size = np.array([len(t) for t in terms])
        first, flat = np.cumsum(size) - size, np.concatenate(terms)
        rank, key = self.df[flat] << RARE_BITS | flat, np.zeros(len(docs), np.int64)
        for _ in range(RAREST):
            least = np.minimum.reduceat(rank, first)
            key = key << RARE_BITS | least & (1 << RARE_BITS) - 1
            rank[rank == np.repeat(least, size)] = np.iinfo(np.int64).max
        return (self.sketches(terms) @ self.middle.T).argmax(1), key


def centroids(sketches: np.ndarray, rounds: int = 10) -> np.ndarray:
    """Spherical k-means of the sample; the centroids in an order in which each
    follows the one most like it."""
    if not len(sketches):
        return np.zeros((1, DIMENSIONS), np.float32)
    found = np.unique(sketches, axis=0)
    found = found[np.random.default_rng(8).permutation(len(found))[:CENTROIDS]]
    for _ in range(rounds):
        sums = np.zeros_like(found)
        np.add.at(sums, (sketches @ found.T).argmax(1), sketches)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(size > 1e-6, sums / np.maximum(size, 1e-6), found)
    order, left = [0], list(range(1, len(found)))
    while left:
        left.sort(key=lambda i: float(found[i] @ found[order[-1]]))
        order.append(left.pop())
    return found[order]


def router(texts: DataFrame, tokenizer_path: str, end_id: int) -> Router:
    """Fitted on about ``SAMPLE`` documents of ``texts``, chosen by a hash of
    their place in the table, so that copies are no likelier to be chosen."""
    ids = vocabulary(tokenizer_path, end_id)
    share = min(1.0, SAMPLE / max(texts.count(), 1))
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 40))
    some = cut_lineage(texts.withColumn("place", place).where(F.col("place") < int(share * (1 << 40))).drop("place"), name="sample")
    stored = cut_lineage(tokenised(some.repartition(SAMPLE // 500), tokenizer_path, end_id), name="sample-ids")
    first = Router(Figures.of(stored, ids))

    def sketches(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                found = [r.tobytes() for r in first.sketches(first.terms(_documents(batch))).astype(np.float32)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["sketch"])

    found = stored.select("wide", "ids").mapInArrow(sketches, "sketch binary").toArrow()["sketch"]  # about SAMPLE rows
    sample = np.frombuffer(b"".join(sorted(found.to_pylist())), np.float32)
    first.middle = centroids(sample.reshape(-1, DIMENSIONS))
    forget(some, stored)
    return first


# -- one shard ----------------------------------------------------------------

class Shard:
    """The inverted index of one shard's documents, with the corpus's figures.
    An id that many documents of the shard have is kept as a row of weights, the
    others as postings; used documents leave both now and then."""

    def __init__(self, docs: list[np.ndarray], figures: Figures):
        own = [figures.weights(d) for d in docs]
        self.n, self.of = len(docs), [t[w > 0] for t, w in own]
        doc = np.repeat(np.arange(self.n), [len(t) for t, _ in own])
        term, weight = (np.concatenate(c) for c in zip(*own))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.terms, begin = np.unique(term[order], return_index=True)
        many = np.diff(np.append(begin, len(term))) * DENSE > self.n
        self.row = np.where(many, np.cumsum(many) - 1, -1)
        place = np.repeat(self.row, np.diff(np.append(begin, len(term))))
        self.rows = np.zeros((int(many.sum()), self.n), np.float32)
        self.rows[place[place >= 0], self.doc[place >= 0]] = self.weight[place >= 0]
        self.begin = np.append(0, np.cumsum(place < 0))[np.append(begin, len(term))]
        self.doc, self.weight = self.doc[place < 0], self.weight[place < 0]
        self.alive, self.used, self.gone = np.arange(self.n), np.zeros(self.n, bool), 0

    def take(self, doc: int) -> None:
        """Use a document up."""
        self.used[doc] = True
        self.gone += 1
        if self.gone * 4 > len(self.alive):
            stay, keep = ~self.used[self.alive], ~self.used[self.doc]
            self.rows, self.alive, self.gone = self.rows[:, stay], self.alive[stay], 0
            self.begin = np.append(0, np.cumsum(keep))[self.begin]
            self.doc, self.weight = self.doc[keep], self.weight[keep]

    def scores(self, seed: int) -> np.ndarray:
        """Score of each document for all terms of the seed."""
        at = np.searchsorted(self.terms, self.of[seed])
        row = self.row[at]
        parts = [slice(a, b) for a, b in zip(self.begin[at].tolist(), self.begin[at + 1].tolist()) if a < b]
        score = np.bincount(np.concatenate([self.doc[p] for p in parts]), np.concatenate([self.weight[p] for p in parts]),
                            self.n) if parts else np.zeros(self.n)
        score[self.alive] += self.rows[row[row >= 0]].sum(0)
        return score

    def neighbours(self, seed: int) -> Iterator[int]:
        """Documents unused at the time that share a term with the seed, best
        first."""
        score = self.scores(seed)
        found = np.flatnonzero((score > 0) & ~self.used)
        least = np.partition(score[found], -FIRST_NEIGHBOURS)[-FIRST_NEIGHBOURS] if len(found) > FIRST_NEIGHBOURS else 0
        for some in (found[score[found] >= least], found[score[found] < least]):
            yield from some[np.lexsort((some, -score[some]))].tolist()


def fill(docs: list[np.ndarray], figures: Figures, seq_len: int) -> list[tuple]:
    """Pieces ``(doc, start, length, sequence, offset)`` of one shard."""
    shard = Shard(docs, figures)
    pieces, sequence, filled = [], 0, 0
    candidates, following = iter(()), 0
    for _ in range(len(docs)):
        doc = next((d for d in candidates if not shard.used[d]), None)
        asks = doc is None
        if asks:
            while shard.used[following]:
                following += 1
            doc = following
        shard.take(doc)
        start = 0
        while start < len(docs[doc]):
            length = min(len(docs[doc]) - start, seq_len - filled)
            pieces.append((doc, start, length, sequence, filled))
            start, filled = start + length, filled + length
            if filled == seq_len:
                sequence, filled, asks = sequence + 1, 0, True
        if asks:
            candidates = shard.neighbours(doc)
    return split_last(pieces, sequence, filled)


def split_last(pieces: list[tuple], sequence: int, filled: int) -> list[tuple]:
    """The last, unfilled sequence as sequences of powers of two."""
    ends = np.cumsum([1 << b for b in reversed(range(filled.bit_length())) if filled >> b & 1])
    out = []
    for doc, start, length, seq, offset in pieces:
        while seq == sequence and length:
            at = int(np.searchsorted(ends, offset, side="right"))
            part = min(length, int(ends[at]) - offset)
            out.append((doc, start, part, seq + at, offset - (int(ends[at - 1]) if at else 0)))
            start, length, offset = start + part, length - part, offset + part
        if length:
            out.append((doc, start, length, seq, offset))
    return out


# -- the operator -------------------------------------------------------------

def tokenised(texts: DataFrame, tokenizer_path: str, end_id: int, route: Router | None = None) -> DataFrame:
    """``STORED``: the ids of each document, with a number ``pid`` of its own;
    with ``route`` also where it goes."""
    def encode(batches: Iterable[pa.RecordBatch]):
        pid = TaskContext.get().partitionId() << TASK_BITS
        for keys, texts in token_ids(batches, tokenizer_path, end_id):
            wide = [int(t.max()) >> 16 > 0 for t in texts]
            columns = [np.arange(pid, pid + len(keys)), keys, np.array(wide),
                       [t.astype("<u4" if w else "<u2").tobytes() for t, w in zip(texts, wide)]]
            if route:
                columns += route.places(texts)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
            pid += len(keys)

    schema = STORED + (", near long, rare long" if route else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return texts.mapInArrow(encode, schema)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         seq_len: int = SEQ_LEN, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.  ``tokenizer_path`` must be readable on each
    executor."""
    texts = keyed_texts(docs, id_col, text_col)
    route = router(texts, tokenizer_path, end_id)
    stored = cut_lineage(tokenised(texts, tokenizer_path, end_id, route), name="ids")
    figures = Figures.of(stored, len(route.df))
    tasks = max(1, -(-int(figures.tokens) // TASK_TOKENS))
    sort = ["near", "rare", "pid"]

    def pieces_of(held: list, first: int) -> pa.RecordBatch:
        keys, texts = zip(*held)
        rows = np.array(fill(list(texts), figures, seq_len), np.int64).T
        doc, start, length, sequence, offset = rows
        crc = [zlib.crc32(texts[d][s:s + n].astype("<u4").tobytes())
               for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
        total = np.array([len(t) for t in texts])[doc]
        return pa.RecordBatch.from_arrays([
            pa.array(np.array(keys, np.int64)[doc]), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
            pa.array(total), pa.array(sequence + first), pa.array(offset)],
            names=[c.split()[0] for c in PIECES.split(", ")])

    def fill_shards(batches: Iterable[pa.RecordBatch]):
        first, held, size = TaskContext.get().partitionId() << TASK_BITS, [], 0
        for batch in batches:
            for key, doc in zip(batch.column(KEY).to_pylist(), _documents(batch)):
                if held and size + len(doc) > shard_tokens:
                    out = pieces_of(held, first)
                    yield out
                    first, held, size = int(max(out.column("sequence_id").to_numpy())) + 1, [], 0
                held.append((key, doc))
                size += len(doc)
        if held:
            yield pieces_of(held, first)

    pieces = cut_lineage(stored.repartitionByRange(tasks, *sort).sortWithinPartitions(*sort)
                         .select(KEY, "wide", "ids").mapInArrow(fill_shards, PIECES), name="packed")
    forget(stored)
    return pieces.select(id_of().alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` packed with the word tokenizer."""
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
