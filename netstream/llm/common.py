"""Helpers shared by the operators of this folder.

Words are ``[^\\x20\\x09-\\x0D]+`` everywhere: ``bytes.split()`` without an
argument cuts UTF-8 text at exactly these six characters, and
``bytes.lower()`` lower-cases A-Z only.

``doc_id`` is carried as ``KEY``: a null id becomes the smallest long, so that
orderings treat it as an ordinary (first) document, and is turned back into null in
results.  Operators that relate rows to each other by key first give each row a key
of its own (``own_rows``), so that rows that share an id, or have none, stay apart.

Operators keep the columns of a table they return in one struct while they work, so
that no name of a column can clash with theirs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netstream.operators.indexing import row_index
from netstream.session import cut_lineage, remove_scratch

KEY = "_nx_key"
DOC = "_nx_doc"
TEXT = "_nx_text"
NULL_KEY = -(1 << 63)
CHUNK_BYTES = 2_000_000


def key_of(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("long"), F.lit(NULL_KEY).cast("long"))


def id_of(key: Column | str = KEY) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.when(key != F.lit(NULL_KEY).cast("long"), key)


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(KEY, TEXT)`` of each row; a null text is the empty text."""
    return docs.select(key_of(id_col).alias(KEY),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias(TEXT))


class Rows:
    """``docs`` with keys: ``table(KEY, DOC)``, ``DOC`` a struct of all columns.

    Where every row has an id of its own, the id is the key.  Otherwise (null or
    repeated ids) the key is the number of the pair (id, text) in an order by id
    (null first) and text hash: rows that only share an id, or have none, are
    documents of their own; rows equal in id and text are one document and have equal
    results; orders by key are orders by id as well; ``with_ids`` turns keys back
    into ids."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        self.text_col, self.ids = text_col, None
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(DOC)
        ident, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
        odd = docs.groupBy(ident.alias("id")).count().where("id IS NULL OR count > 1").limit(1).count()
        if not odd:
            self.table = docs.select(ident.alias(KEY), whole)
            return
        rows = docs.select(whole, ident.alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
        pairs = row_index(rows.select("id", "h1", "h2").distinct(), ["id", "h1", "h2"], index_col=KEY)
        pairs = cut_lineage(pairs.select(KEY, F.col("id").alias("own"), F.col("h1").alias("g1"), F.col("h2").alias("g2")),
                            name="own-keys")
        self.ids = pairs.select(KEY, "own")
        same = F.col("id").eqNullSafe(F.col("own")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
        self.table = rows.join(pairs, same).select(KEY, DOC)

    def texts(self) -> DataFrame:
        """``(KEY, TEXT)``; a null text is the empty text."""
        return self.table.select(KEY, F.coalesce(self.column(self.text_col).cast("string"), F.lit("")).alias(TEXT))

    @staticmethod
    def column(name: str) -> Column:
        return F.col(DOC).getField(name)

    def with_ids(self, found: DataFrame, *columns: str) -> DataFrame:
        """``found`` with the keys in ``columns`` turned into ids."""
        for i, c in enumerate(columns if self.ids is not None else ()):
            own = self.ids.select(F.col(KEY).alias(f"_nx_k{i}"), F.col("own").alias(f"_nx_i{i}"))
            found = (found.join(own, F.col(c) == F.col(f"_nx_k{i}")).withColumn(c, F.col(f"_nx_i{i}"))
                     .drop(f"_nx_k{i}", f"_nx_i{i}"))
        return found


def text_slices(batch: pa.RecordBatch, column: str | int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text in the column (a longer
    text alone)."""
    size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    until, a = np.append(0, np.cumsum(size)), 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(until, until[a] + limit, side="right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def filtered(docs: DataFrame, text_col: str, keep) -> DataFrame:
    """``docs`` without the rows that ``keep(texts)`` - an Arrow array of texts
    without nulls, a mask back - rejects: a map, whatever the ids are."""
    place, names = docs.columns.index(text_col), [f"_nx_{i}" for i in range(len(docs.columns))]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, place):
                texts = part.column(place).cast(pa.large_string()).fill_null("")
                yield part.filter(pa.array(keep(texts), pa.bool_()))

    renamed = docs.toDF(*names)
    return renamed.mapInArrow(rows, renamed.schema).toDF(*docs.columns)


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``cut_lineage`` wrote and nobody reads any more."""
    for table in tables:
        files = table.inputFiles()
        if files:
            remove_scratch(table.sparkSession, files[0].rpartition("/")[0])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.  Catalyst may
    inline a projected column into a lambda, where it would be computed for
    each element; a lambda variable cannot be inlined."""
    return F.transform(F.array(value), body).getItem(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of ``hashes[i:i+k]`` for each ``i``, order-sensitive: a polynomial
    of the (random-looking) hashes, put together from runs of powers of two."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = int(mix(np.array([seed + 1], np.uint64))[0]) | 1
    out, done, run, size = None, 0, hashes, 1
    while True:
        if k & size:
            part = run[done:done + n]
            out = part.copy() if out is None else out + part * np.uint64(pow(base, done, 1 << 64))
            done += size
        if done == k:
            return mix(out)
        run = run[:-size] + run[size:] * np.uint64(pow(base, size, 1 << 64))
        size *= 2


def whole_runs(counts: np.ndarray, k: int) -> np.ndarray:
    """For documents of ``counts`` words laid end to end: the words at which a
    run of ``k`` words of one document starts."""
    ends = np.repeat(np.cumsum(counts), counts)
    return np.flatnonzero(np.arange(len(ends)) + k <= ends)


#: Byte classes: white space that parts words, and A-Z to a-z.
SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_random = np.random.default_rng(20260101)
_CODE = _random.integers(1, 1 << 64, 256, np.uint64, endpoint=False) | np.uint64(1)
_BASE = int(_random.integers(1 << 62, 1 << 63)) * 2 + 1
_CODE_OF = {True: _CODE[LOWER], False: _CODE}


def byte_codes(raw: np.ndarray) -> np.ndarray:
    """The 64-bit code of each byte."""
    return _CODE[raw]


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(n, _BASE, np.uint64)), dtype=np.uint64)


_POWERS = _powers(255)


def hash_runs(codes: np.ndarray, rank: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Polynomial 64-bit hash of each run of ``codes`` (a run ends where the
    next starts; code 0 is skipped); ``rank`` is the place in its run."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    longest = int(rank.max(initial=0))
    powers = _POWERS if longest < len(_POWERS) else _powers(longest)
    codes *= powers[rank]
    return mix(np.add.reduceat(codes, starts))


class Chunk:
    """Some whole documents and their words.

    ``raw`` holds the texts' bytes end to end and ``bounds`` where each starts
    and the last ends; ``starts``, ``ends`` and ``hashes`` are the words' places
    and 64-bit hashes in order, ``counts`` the words per document.
    """

    def __init__(self, keys: np.ndarray, raw: np.ndarray, bounds: np.ndarray, lower: bool,
                 cut: np.ndarray | None = None, parting: np.ndarray = SPACE):
        """``cut``: places at which a word starts whatever stands before;
        ``parting``: whether a byte parts words."""
        self.keys, self.raw, self.bounds = keys, raw, bounds
        word = ~parting[raw]
        begin, last = word.copy(), word.copy()
        begin[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        at = bounds[:-1][bounds[:-1] < bounds[1:]]
        for places in (at, *([cut] if cut is not None else [])):
            begin[places] = word[places]
            last[places[places > 0] - 1] |= word[places[places > 0] - 1]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
        if len(self.starts):
            at = slice(int(self.starts[0]), None)  # a word's run goes on to the next word's start
            size = np.diff(np.append(self.starts, len(raw)))
            rank = np.arange(len(raw) - at.start, dtype=np.int32)
            rank -= np.repeat((self.starts - at.start).astype(np.int32), size)
            rank *= word[at]
            self.hashes = hash_runs(_CODE_OF[lower][raw[at]] * word[at], rank, self.starts - at.start)
        else:
            self.hashes = np.zeros(0, np.uint64)
        self.counts = np.diff(np.searchsorted(self.starts, bounds))

    @property
    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.keys)), self.counts)

    @property
    def first(self) -> np.ndarray:
        """The first word of each document."""
        return np.cumsum(self.counts) - self.counts

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i]:self.ends[i]].tobytes()


def text_chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(keys, raw, bounds)`` of Arrow batches ``(KEY, TEXT)`` without nulls,
    whole documents of about ``limit`` bytes together (a longer one alone)."""
    for batch in batches:
        keys = batch.column(KEY).to_numpy(zero_copy_only=False).astype(np.int64)
        texts = batch.column(TEXT).cast(pa.large_binary())
        if not len(texts):
            continue
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        a = 0
        while a < len(keys):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
            yield keys[a:b], data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            a = b


def word_chunks(batches: Iterable[pa.RecordBatch], lower: bool, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    for keys, raw, bounds in text_chunks(batches, limit):
        yield Chunk(keys, raw, bounds, lower)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
