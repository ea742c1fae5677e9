"""Hierarchical Pitman-Yor language model.

Words are lower-cased (A-Z) and every text ends with an end token.  The
``SYMBOLS`` most frequent training tokens are symbols of their own, all others
share the symbol "rare"; a token's symbol context is the symbol before it (the
start of a text is a context of its own).  Four kinds of Chinese restaurants:

* one per symbol context; a customer is a token after that context, a dish its symbol;
* one parent, shared by all symbol contexts; each of their tables sends it a
  customer; its base is uniform over the symbols;
* one for the rare words; a customer is an occurrence of a rare token, a dish
  the word; its base is uniform over the rare training words and one unseen;
* one per context word, for the pairs that the symbols do not tell apart.  After a
  rare word, a dish is any next word and the base ``p(symbol | rare) * p(word | rare)``.
  After a symbol, a dish is a rare word; these are dealt into ``CLASSES`` classes by
  hash with a restaurant each, the base being ``p(word | rare)`` within the class, so
  that what follows a frequent word is not one task's.

So every pair of neighbouring words of the training text is counted, either as a
pair of symbols or in the restaurant of its first word, and

* ``p(word | symbol) = p(symbol of word | symbol)``, for a rare word times
  ``p(class | symbol) * p(word | symbol, class)``;
* ``p(word | rare word)`` is the prediction of that word's restaurant.

The first three kinds have every token as a customer, as if each had opened a table
in the restaurants of the fourth.  Counts are over the whole training text: the rare
restaurant has every other word of the corpus as a dish and the restaurants of the
words every other pair, so the model grows with the input; only the tables sent to
the tasks (symbols by contexts, listed words) have a fixed bound.  The pairs are not a
table of their own: tokens are dealt out by context, in packed arrays (``BLOB``), and
the task that has a context counts its training pairs, seats them and scores its tokens.

Seating is sampled by Gibbs sweeps.  In a sweep every (context, symbol) reseats
its customers given the parent's probabilities and the context's number of
tables after the sweep before (the sampler for partitioned data: pairs of one
context do not wait for each other): customer k+1 of n opens a table with
probability ``a / (k - d t + a)``, ``a = (strength + d T) p``.  The first
``ONE_BY_ONE`` customers are drawn one by one; of the following ones the number
of tables is drawn as a whole (Poisson, whose error is below
``a / ONE_BY_ONE``).  Then the parent reseats its customers.  After ``BURN_IN``
sweeps, predictive probabilities of ``SAMPLES`` sweeps are averaged; scores and
perplexity use the averages.

Draws are seeded by context, symbol and sweep, so a task that is run again
after an executor was lost draws the same.

Defined cases: a null text is empty (its end token alone); an empty training
table gives the uniform model over one unseen word; repeated rows are counted
as often as they stand there and get equal scores; only the id and the text are
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.llm.common import KEY, TEXT, Chunk, id_of, key_of, keyed_texts, mix, signed, word_chunks
from netstream.session import cut_lineage

SYMBOLS = 1_023
TABLE_WORDS = 262_144
DISCOUNT, STRENGTH = 0.6, 5.0
BURN_IN, SAMPLES = 4, 4
ONE_BY_ONE = 32
END = np.uint64(0x5EED0F7E0FE4D001)
CLASSES = 64  # classes by hash of the rare words after a symbol (a power of two)
AFTER_RARE = np.uint64(1 << 63)  # in the keys of contexts that are rare words
LEARN, SCORE = "_nx_learn", "_nx_score"
PART_BYTES = 8_000_000  # of text whose tokens meet in one task, about 1.3 million
FLUSH_TOKENS = 1_500_000  # tokens that a task packs at a time
_GROUPS = 64


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def tokens(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words and ends) and their documents."""
    at = np.cumsum(chunk.counts)
    return (np.insert(chunk.hashes, at, END),
            np.repeat(np.arange(len(chunk.keys)), chunk.counts + 1))


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.split())


def word_counts(train: DataFrame) -> DataFrame:
    """``(word, n)`` of every training token (by hash)."""
    def counts(batches: Iterable[pa.RecordBatch]):
        for chunk in word_chunks(batches, lower=True):
            word, n = np.unique(tokens(chunk)[0], return_counts=True)
            yield _batch("word n", signed(word), n)
    return train.mapInArrow(counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The most frequent words: hash, count; the first ``symbols`` of them are
    symbols ``0..``, the rest (and words not listed) the symbol "rare"."""

    def __init__(self, rows: list[tuple[int, int]], symbols: int):
        words = np.array([w for w, _ in rows], np.int64).view(np.uint64)
        self.symbols = min(symbols, len(rows))
        order = np.argsort(words)
        self.words, self.rank = words[order], order
        self.count = np.array([n for _, n in rows], np.int64)[order]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the words (meaningless where not listed), and whether listed."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return at, self.words[at] == hashes

    def symbol(self, at: np.ndarray, listed: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(at), np.int64)
        return np.where(listed, np.minimum(self.rank[at], self.symbols), self.symbols)


def contexts(symbol: np.ndarray, doc: np.ndarray, start: int) -> np.ndarray:
    """The symbol before each token; ``start`` for the first of a text."""
    before = np.append(start, symbol[:-1]) if len(symbol) else symbol
    before[1:][doc[1:] != doc[:-1]] = start
    return before


def pair_counts(train: DataFrame, vocabulary) -> DataFrame:
    """``(context, symbol, n)``."""
    def counts(batches: Iterable[pa.RecordBatch]):
        v = vocabulary.value
        width = v.symbols + 2
        total = np.zeros(width * width, np.int64)
        for chunk in word_chunks(batches, lower=True):
            word, doc = tokens(chunk)
            symbol = v.symbol(*v.find(word))
            total += np.bincount(contexts(symbol, doc, v.symbols + 1) * width + symbol, minlength=len(total))
        pair = np.flatnonzero(total)
        yield _batch("context symbol n", (pair // width).astype(np.int32), (pair % width).astype(np.int32), total[pair])
    return (train.mapInArrow(counts, "context int, symbol int, n long").groupBy("context", "symbol")
            .agg(F.sum("n").alias("n")))


def _uniform(seed: np.ndarray, step: int) -> np.ndarray:
    return ((mix(seed + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)).astype(np.float64)
            + 0.5) / (1 << 53)


def seat(n: np.ndarray, a: np.ndarray, seed: np.ndarray, discount: float = DISCOUNT) -> np.ndarray:
    """Tables that ``n`` customers of each dish take when a new one has weight
    ``a``; ``seed`` makes the draws."""
    t = np.minimum(n, 1).astype(np.float64)
    for k in range(1, ONE_BY_ONE):
        live = np.flatnonzero(n > k)
        if not len(live):
            return t
        t[live] += _uniform(seed[live], k) < a[live] / (k - discount * t[live] + a[live])
    many = np.flatnonzero(n > ONE_BY_ONE)
    if len(many):
        rate, old = a[many], ONE_BY_ONE - discount * t[many]
        mean = rate * np.log((n[many] - discount * t[many] + rate) / (old + rate))
        more = _poisson(mean, seed[many])
        t[many] = np.minimum(t[many] + more, n[many])
    return t


def _poisson(mean: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Poisson draws: by inversion up to a mean of 30, above it by the rounded
    normal (Box-Muller) of the same mean and variance."""
    u, v = _uniform(seed, 101), _uniform(seed, 102)
    out = np.maximum(0, np.rint(mean + np.sqrt(mean) * np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)))
    small = np.flatnonzero(mean <= 30)
    p = np.exp(-mean[small])
    total, k = p.copy(), np.zeros(len(small))
    for step in range(1, 120):
        go = u[small] > total
        if not go.any():
            break
        k[go] += 1
        p = p * mean[small] / step
        total += p
    out[small] = k
    return out


def _seeds(a: np.ndarray, b: np.ndarray, sweep: int) -> np.ndarray:
    return mix(mix(a.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + b.astype(np.uint64)) + np.uint64(sweep + 1))


class Parent:
    """The shared parent restaurant: probabilities of the symbols."""

    def __init__(self, size: int):
        self.size, self.p = size, np.full(size, 1.0 / size)
        self.tables = 0.0

    def reseat(self, customers: np.ndarray, sweep: int) -> None:
        a = (STRENGTH + DISCOUNT * self.tables) / self.size
        t = seat(customers, np.full(self.size, a), _seeds(np.full(self.size, 1 << 40), np.arange(self.size), sweep))
        n = customers.sum()
        self.tables = t.sum()
        self.p = (np.maximum(customers - DISCOUNT * t, 0) + (STRENGTH + DISCOUNT * self.tables) / self.size) / (STRENGTH + n)


def gibbs(pairs: DataFrame, size: int, burn_in: int = BURN_IN, samples: int = SAMPLES) -> tuple:
    """Averaged predictive probabilities as ``(seen, backoff, parents)``:
    ``seen[c, s]`` what the customers of the pair add, ``backoff[k, c]`` the
    weight of the parent's ``parents[k, s]`` in sample k.

    ``pairs`` has at most ``size * (size + 1)`` rows; each sweep is a map over
    them by context and two small sums."""
    spark = pairs.sparkSession
    rows = cut_lineage(pairs.repartition(_groups(spark), F.pmod("context", F.lit(_GROUPS))), name="pairs")
    total = np.zeros(size + 1)
    for r in rows.groupBy("context").agg(F.sum("n").alias("n")).collect():  # <= size + 1 rows
        total[r["context"]] = r["n"]
    parent, tables = Parent(size), np.zeros(size + 1)
    backoff, parents, drawn = [], [], []
    for sweep in range(burn_in + samples):
        p, old = spark.sparkContext.broadcast(parent.p), spark.sparkContext.broadcast(tables)

        def reseat(batches: Iterable[pa.RecordBatch], sweep=sweep, p=p, old=old):
            for b in batches:
                c, s, n = (b.column(i).to_numpy() for i in ("context", "symbol", "n"))
                t = seat(n, (STRENGTH + DISCOUNT * old.value[c]) * p.value[s], _seeds(c, s, sweep))
                yield _batch("context symbol n t", c, s, n, t.astype(np.int64))

        seated = cut_lineage(rows.select("context", "symbol", "n").mapInArrow(
            reseat, "context int, symbol int, n long, t long"), name="seating")
        tables, customers = np.zeros(size + 1), np.zeros(size)
        for r in seated.groupBy("context").agg(F.sum("t").alias("t")).collect():  # <= size + 1 rows
            tables[r["context"]] = r["t"]
        for r in seated.groupBy("symbol").agg(F.sum("t").alias("t")).collect():  # <= size rows
            customers[r["symbol"]] = r["t"]
        parent.reseat(customers, sweep)
        if sweep >= burn_in:
            drawn.append(seated)
            backoff.append((STRENGTH + DISCOUNT * tables) / (STRENGTH + total))
            parents.append(parent.p)
    both = drawn[0]
    for other in drawn[1:]:
        both = both.union(other)
    seen = (both.groupBy("context", "symbol").agg(F.max("n").alias("n"), F.sum("t").alias("t"))
            .select("context", "symbol", (F.col("n") - F.lit(DISCOUNT) * F.col("t") / samples).cast("float").alias("w")))
    table = np.zeros((size + 1, size), np.float32)
    found = seen.toArrow()  # at most size * (size + 1) rows
    c, s = found["context"].to_numpy(), found["symbol"].to_numpy()
    table[c, s] = np.maximum(found["w"].to_numpy(), 0) / (STRENGTH + total[c])
    return table, np.array(backoff), np.array(parents)


def _groups(spark) -> int:
    return max(1, min(_GROUPS, spark.sparkContext.defaultParallelism))


def rare_restaurant(rare: DataFrame, burn_in: int = BURN_IN, samples: int = SAMPLES) -> tuple[DataFrame, float]:
    """``(word, n, q)`` with the averaged probability of each rare word, and
    that of an unseen one.  A sweep is a map over the words and one sum."""
    v, n = rare.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights, a = [], STRENGTH / (v + 1)

    def draw(word, count, a, sweep):
        return seat(count, np.full(len(word), a), _seeds(word.view(np.uint64), np.full(len(word), 1 << 41), sweep))

    for sweep in range(burn_in + samples):
        def tables(batches: Iterable[pa.RecordBatch], sweep=sweep, a=a):
            for b in batches:
                t = draw(b.column("word").to_numpy(), b.column("n").to_numpy(), a, sweep)
                yield _batch("t", np.array([t.sum()], np.int64))
        if sweep >= burn_in:
            weights.append((sweep, a))
        a = (STRENGTH + DISCOUNT * (rare.mapInArrow(tables, "t long").agg(F.sum("t")).first()[0] or 0)) / (v + 1)
        if sweep >= burn_in:
            weights[-1] += (a,)
    unseen = sum(w[2] for w in weights) / samples / (STRENGTH + n)

    def mean(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            word, count = b.column("word").to_numpy(), b.column("n").to_numpy()
            t = sum(draw(word, count, a, sweep) for sweep, a, _ in weights) / samples  # the same draws again
            yield _batch("word n q", word, count, np.maximum(count - DISCOUNT * t, 0) / (STRENGTH + n) + unseen)

    return rare.mapInArrow(mean, "word long, n long, q double"), unseen


class Model:
    """What the tasks need: listed words with count and rare probability,
    log10 of ``p(symbol | context)``, rare tokens after each symbol context, the rare
    probability of each class, and the corpus's figures.  ``train`` (the training
    texts, whose pairs are counted where they are needed) stays on the driver."""

    def __init__(self, vocabulary: Vocabulary, table, backoff, parents, unseen: float, train_tokens: int, types: int,
                 burn_in: int = BURN_IN, samples: int = SAMPLES):
        self.vocabulary, self.unseen, self.train_tokens, self.types = vocabulary, unseen, train_tokens, types
        self.table, self.backoff, self.parents = table, backoff, parents
        self.burn_in, self.samples, self.train = burn_in, samples, None
        self.rare_log = np.zeros(len(vocabulary.words))
        self.rare_after, self.class_mass = np.zeros(vocabulary.symbols + 2), np.full(CLASSES, unseen)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "train": None}

    def log_symbols(self, context: int | slice = slice(None)) -> np.ndarray:
        return np.log10(self.table[context] + (self.backoff[:, context].T @ self.parents) / len(self.backoff)).astype(np.float32)


def _class(word):
    """The class of a word: the highest bits of its hash (of a column or an array)."""
    bits = 64 - CLASSES.bit_length() + 1
    return word >> np.uint64(bits) if isinstance(word, np.ndarray) else F.shiftrightunsigned(word, bits).cast("int")


def listed_words(words: DataFrame, limit: int) -> list[tuple[int, int]]:
    """``(word, n)`` of the most frequent words, at most ``limit``: those above
    the least count at which they are few enough."""
    sizes = sorted(((r["n"], r["count"]) for r in words.groupBy("n").count().collect()), reverse=True)
    least, some = None, 0
    for n, count in sizes:
        some += count
        if some > limit:
            break
        least = n
    if least is None:
        return []
    found = words.where(F.col("n") >= least).toArrow()
    return sorted(zip(found["word"].to_pylist(), found["n"].to_pylist()), key=lambda r: (-r[1], r[0]))


def fit(train: DataFrame, symbols: int = SYMBOLS, table_words: int = TABLE_WORDS, burn_in: int = BURN_IN,
        samples: int = SAMPLES) -> tuple[Model, DataFrame]:
    """The model for ``train`` (KEY, TEXT), and ``(word, n, q)`` of the words
    that are not in its list."""
    spark = train.sparkSession
    words = cut_lineage(word_counts(train), name="words")
    types, n = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    vocabulary = Vocabulary(listed_words(words, table_words), symbols)
    pairs = cut_lineage(pair_counts(train, spark.sparkContext.broadcast(vocabulary)), name="pair-counts")
    table, backoff, parents = gibbs(pairs, vocabulary.symbols + 1, burn_in, samples)
    top = vocabulary.words[vocabulary.rank < vocabulary.symbols].view(np.int64).tolist()
    known = spark.createDataFrame([(w,) for w in top], "word long")  # at most ``symbols`` rows
    rare, unseen = rare_restaurant(cut_lineage(words.join(F.broadcast(known), "word", "left_anti"), name="rare"),
                                   burn_in, samples)
    rare = cut_lineage(rare, name="rare-words")
    listed = vocabulary.words[vocabulary.rank >= vocabulary.symbols]
    model = Model(vocabulary, table, backoff, parents, unseen, n, types, burn_in, samples)
    model.train = train
    for r in pairs.where(F.col("symbol") == vocabulary.symbols).collect():  # a row per symbol context
        model.rare_after[r["context"]] = r["n"]
    for r in rare.groupBy(_class(F.col("word")).alias("c")).agg(F.sum("q").alias("q")).collect():  # a row per class
        model.class_mass[r["c"]] += r["q"]  # beside one unseen word in each
    if len(listed):
        least = int(vocabulary.count.min())
        found = rare.where(F.col("n") >= least).toArrow()  # at most ``table_words`` rows
        at, ok = vocabulary.find(found["word"].to_numpy().view(np.uint64))
        model.rare_log[at[ok]] = np.log10(found["q"].to_numpy()[ok])
        rare = rare.where(F.col("n") < least)
    return model, rare


#: Packed tokens and documents on their way to partition ``part``.  ``docs`` are the
#: rows' hashes, ``flags`` say whether a row is learned from (1) and scored (2), ``begin``
#: has a bit per token, set where the next document begins; ``x``, ``y``, ``z`` by kind:
BLOB = "part int, kind int, docs binary, flags binary, begin binary, x binary, y binary, z binary"
LISTED, LATER, MET = 0, 1, 2  # tokens: short context, place of the word | context, place | context, word, its rare probability
UNLISTED, RARE = 3, 4  # tokens: context, word | words of the rare table: word, n, probability
DOCUMENT, FIGURES, VALUE = 5, 6, 7  # key, figures | figures to be added: known and base | score


def _rows(columns: list[tuple]) -> pa.RecordBatch:
    part, kind, *blobs = zip(*columns) if columns else [[]] * 8
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()),
                                       *[pa.array(b, pa.binary()) for b in blobs]],
                                      names=[c.split()[0] for c in BLOB.split(", ")])


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    return (mix(key) % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.int32)


def _deal(part: np.ndarray) -> Iterable[tuple[int, np.ndarray]]:
    """Each part and its places, in order."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    begin = np.flatnonzero(np.append(True, part[1:] != part[:-1])[:len(part)])
    for a, b in zip(begin, np.append(begin[1:], len(part))):
        yield int(part[a]), order[a:b]


def _packed_tokens(kind: int, part: np.ndarray, docs, flags, doc, *columns) -> list[tuple]:
    """Tokens of the documents ``doc`` (ascending places among ``docs``), dealt by ``part``."""
    out = []
    for p, own in _deal(part):
        at = doc[own]
        begin = np.append(True, at[1:] != at[:-1])
        held = at[begin]
        out.append((p, kind, docs[held].tobytes(), flags[held].tobytes(), np.packbits(begin).tobytes(),
                    *[c[own].tobytes() for c in columns], *[b""] * (3 - len(columns))))
    return out


def _packed_figures(kind: int, parts: int, docs: np.ndarray, figures: np.ndarray, keys: np.ndarray | None = None) -> list[tuple]:
    """``figures[i]`` of each document, dealt by the documents' hashes."""
    return [(p, kind, docs[own].tobytes(), b"", b"", b"" if keys is None else keys[own].tobytes(), b"", figures[:, own].tobytes())
            for p, own in _deal(_part(docs, parts))]


class _Blobs:
    """The blobs of one kind that a task has received."""

    def __init__(self):
        self.held = []

    def array(self, column: str, dtype) -> np.ndarray:
        i = "docs flags begin x y z".split().index(column)
        return np.concatenate([np.frombuffer(h[i], dtype) for h in self.held] or [np.zeros(0, dtype)])

    def doc(self, word_bytes: int) -> np.ndarray:
        """The place of each token's document among all ``docs``; ``y`` has ``word_bytes`` a token."""
        bits = [np.unpackbits(np.frombuffer(h[2], np.uint8), count=h[4].size // word_bytes) for h in self.held]
        return np.cumsum(np.concatenate(bits or [np.zeros(0, np.uint8)]), dtype=np.int32) - np.int32(1)

    def figures(self, rows: int) -> np.ndarray:
        return np.concatenate([np.frombuffer(h[5], np.float64).reshape(rows, -1) for h in self.held] or [np.zeros((rows, 0))], axis=1)


def _by_kind(batches: Iterable[pa.RecordBatch], found: dict[int, _Blobs]) -> Iterable[pa.RecordBatch]:
    """Gathers the kinds in ``found``; what is left of each batch."""
    for b in batches:
        kind = b.column("kind").to_numpy()
        for i in np.flatnonzero(np.isin(kind, list(found))):
            found[kind[i]].held.append([b.column(c)[i].as_buffer() for c in range(2, 8)])
        left = ~np.isin(kind, list(found))
        if left.any():
            yield b.filter(pa.array(left))


def _summed(docs: np.ndarray, figures: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rows, at = np.unique(docs, return_inverse=True)
    return rows, np.array([np.bincount(at, f, len(rows)) for f in figures])


class _Tokens:
    """The tokens of a chunk: word, document, place in the list and whether listed, symbol
    and context symbol; the context's key, which is below 2 ^ 63 for a symbol and a class,
    and its short form (-1 after an unlisted word); the row hash of each document."""

    def __init__(self, chunk: Chunk, v: Vocabulary):
        self.word, self.doc = tokens(chunk)
        self.at, self.listed = v.find(self.word)
        self.symbol = v.symbol(self.at, self.listed)
        self.before = contexts(self.symbol, self.doc, v.symbols + 1)
        later, some = self.before == v.symbols, len(self.word) > 0
        self.context = self.before.astype(np.uint64) * np.uint64(CLASSES) + _class(self.word)
        self.short = self.context.astype(np.int32)
        after = np.flatnonzero(later) if some else np.zeros(0, np.int64)
        self.context[after] = self.word[after - 1] | AFTER_RARE
        self.short[after] = np.where(self.listed[after - 1], self.at[after - 1] + _shorts(v), -1)
        first = np.append(0, np.cumsum(chunk.counts + 1)[:-1])
        in_text = np.arange(len(self.word)).astype(np.uint64) - np.repeat(first, chunk.counts + 1).astype(np.uint64)
        self.row = mix(chunk.keys.view(np.uint64) + np.uint64(0x632BE59BD9B4E019) * mix(
            np.bincount(self.doc, minlength=len(chunk.keys)).astype(np.uint64) + np.add.reduceat(mix(self.word + in_text), first)))


def _shorts(v: Vocabulary) -> int:
    """Short contexts of symbols; those of listed words follow."""
    return (v.symbols + 2) * CLASSES


def _flagged_tokens(batches: Iterable[pa.RecordBatch], v: Vocabulary) -> Iterable[tuple]:
    """Each chunk, its tokens and the flags of its documents."""
    for batch in batches:
        flags = sum(batch.column(c).to_numpy(zero_copy_only=False).astype(np.uint8) * np.uint8(f) for c, f in ((LEARN, 1), (SCORE, 2)))
        a = 0
        for chunk in word_chunks([batch], lower=True):
            yield chunk, _Tokens(chunk, v), flags[a:a + len(chunk.keys)]
            a += len(chunk.keys)


class _Buffer:
    """What is known of the tokens of some chunks, until there is enough to be packed."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.docs, self.flags, self.n_docs, self.n_tokens = [], [], 0, 0
        self.columns = {}

    def add(self, t: _Tokens, flags: np.ndarray, kind: int, which: np.ndarray, *columns: np.ndarray) -> None:
        self.columns.setdefault(kind, []).append(((t.doc[which] + self.n_docs).astype(np.int32), *[c[which] for c in columns]))
        self.n_tokens += len(which)

    def next(self, t: _Tokens, flags: np.ndarray) -> bool:
        """After a chunk's tokens: whether it is time to pack."""
        self.docs.append(t.row)
        self.flags.append(flags)
        self.n_docs += len(flags)
        return self.n_tokens >= FLUSH_TOKENS

    def packed(self, parts: int, key: Callable) -> list[tuple]:
        """``key(kind, columns)``: what a token is dealt by."""
        out = []
        if self.docs:
            docs, flags = np.concatenate(self.docs), np.concatenate(self.flags)
            for kind, held in self.columns.items():
                doc, *columns = (np.concatenate(c) for c in zip(*held))
                out += _packed_tokens(kind, _part(key(kind, columns), parts), docs, flags, doc, *columns)
        self.clear()
        return out


def seated(context: np.ndarray, word: np.ndarray, base: np.ndarray, learned: np.ndarray, burn_in: int, samples: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The restaurants of whole contexts: averaged prediction of each token given the
    ``learned`` ones; then the contexts, each token's place among them and their
    customers.  A pair that occurs once has one table; the others are reseated in
    each sweep given the tables of their context after the sweep before."""
    pair = mix(mix(context) + word)
    order = np.argsort(pair)
    pair = pair[order]
    new = np.append(True, pair[1:] != pair[:-1])[:len(pair)]
    of = np.empty(len(pair), np.int64)
    of[order] = np.cumsum(new) - 1
    first = order[new]
    n = np.bincount(of, learned, len(first))
    place, at = np.unique(context[first], return_inverse=True)
    total = np.bincount(at, n, len(place))
    t, many = np.minimum(n, 1.0), np.flatnonzero(n > 1)
    tables = np.bincount(at, t, len(place))
    mean_t, mean_tables = np.zeros(len(first)), np.zeros(len(place))
    for sweep in range(burn_in + samples):
        a = (STRENGTH + DISCOUNT * tables[at[many]]) * base[first[many]]
        t[many] = seat(n[many], a, _seeds(context[first[many]], word[first[many]], sweep))
        tables = np.bincount(at, t, len(place))
        if sweep >= burn_in:
            mean_t += t / samples
            mean_tables += tables / samples
    p = (np.maximum(n - DISCOUNT * mean_t, 0) + (STRENGTH + DISCOUNT * mean_tables[at]) * base[first]) / (STRENGTH + total[at])
    return p[of], place, at[of], total


def class_probability(place: np.ndarray, total: np.ndarray, model: Model) -> np.ndarray:
    """For the contexts of a symbol and a class ``p(class | symbol, rare)``, else 1."""
    out = np.ones(len(place))
    own = np.flatnonzero(place < AFTER_RARE)
    symbol, c = np.divmod(place[own].astype(np.int64), CLASSES)
    out[own] = (total[own] + STRENGTH * model.class_mass[c] / model.class_mass.sum()) / (model.rare_after[symbol] + STRENGTH)
    return out


def score(docs: DataFrame, model: Model, rare: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, n_known, base_score, score, perplexity`` of each row
    (log10), by the pairs of ``model.train``."""
    texts = keyed_texts(docs, id_col, text_col).select(KEY, TEXT, F.lit(False).alias(LEARN), F.lit(True).alias(SCORE))
    train = model.train.select(KEY, TEXT, F.lit(True).alias(LEARN), F.lit(False).alias(SCORE))
    return score_texts(texts.union(train), model, rare, id_col)


def score_texts(texts: DataFrame, model: Model, rare: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``score`` of the rows of ``texts(KEY, TEXT, LEARN, SCORE)`` that are marked
    ``SCORE``; those marked ``LEARN`` are all texts that the model was fitted to.

    Tokens of symbol pairs are scored in a map.  All others go to the task that has
    their context; those of a word that is not in the model's list meet the table of
    rare words on the way, by word.  Figures then meet by document."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(model)
    size = texts.agg(F.coalesce(F.sum(F.octet_length(TEXT)), F.lit(0))).first()[0]
    parts = max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    base = float(model.train_tokens + model.types + 1)

    def unlisted(batches: Iterable[pa.RecordBatch]):
        buffer = _Buffer()
        for _, t, flags in _flagged_tokens(batches, shared.value.vocabulary):
            buffer.add(t, flags, UNLISTED, np.flatnonzero(~t.listed), t.context, t.word)
            if buffer.next(t, flags):
                yield _rows(buffer.packed(parts, lambda _, columns: columns[1]))
        yield _rows(buffer.packed(parts, lambda _, columns: columns[1]))

    def rare_words(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            word, n, q = (b.column(c).to_numpy(zero_copy_only=False) for c in ("word", "n", "q"))
            yield _rows([(p, RARE, b"", b"", b"", word[own].tobytes(), n[own].astype(np.int64).tobytes(), q[own].tobytes())
                         for p, own in _deal(_part(word.view(np.uint64), parts))])

    def meet(batches: Iterable[pa.RecordBatch]):
        """Unlisted words and the rare table: figures for the base score, and the tokens
        with their probability on the way to their context."""
        table, held = _Blobs(), _Blobs()
        yield from _by_kind(batches, {RARE: table, UNLISTED: held})
        words = table.array("x", np.uint64)
        order = np.argsort(words)
        words = np.append(words[order], np.uint64(0))
        count = np.append(table.array("y", np.int64)[order], 0)
        q = np.append(table.array("z", np.float64)[order], shared.value.unseen)
        docs, flags, doc = held.array("docs", np.uint64), held.array("flags", np.uint8), held.doc(8)
        context, word = held.array("x", np.uint64), held.array("y", np.uint64)
        place = np.searchsorted(words[:-1], word)
        place[words[place] != word] = len(words) - 1  # unseen
        told = flags > 1
        figures = [np.bincount(doc, f, len(docs))[told] for f in (place < len(words) - 1, np.log10(count[place] + 1.0))]
        yield _rows(_packed_figures(FIGURES, parts, *_summed(docs[told], figures))
                    + _packed_tokens(MET, _part(context, parts), docs, flags, doc, context, word, q[place]))

    def listed(batches: Iterable[pa.RecordBatch]):
        model = shared.value
        v, logs, buffer, told = model.vocabulary, model.log_symbols(), _Buffer(), []
        shorts = np.append(np.arange(_shorts(v), dtype=np.uint64), v.words | AFTER_RARE)
        log_count = np.log10(v.count + 1.0)

        def packed():
            out = buffer.packed(parts, lambda kind, columns: shorts[columns[0]] if kind == LISTED else columns[0])
            if told:
                out += _packed_figures(DOCUMENT, parts, np.concatenate([x[0] for x in told]),
                                       np.concatenate([x[1] for x in told], axis=1), np.concatenate([x[2] for x in told]))
                told.clear()
            return _rows(out)

        for chunk, t, flags in _flagged_tokens(batches, v):
            n_docs, own = len(chunk.keys), np.flatnonzero(t.listed)
            later, place = t.before == v.symbols, t.at.astype(np.int32)
            value = np.where(later, 0.0, logs[t.before, t.symbol].astype(np.float64))
            figures = np.array([np.bincount(t.doc, minlength=n_docs), np.bincount(t.doc[own], minlength=n_docs),
                                np.bincount(t.doc[own], log_count[t.at[own]], n_docs), np.bincount(t.doc, value, n_docs)], np.float64)
            told.append((t.row[flags > 1], figures[:, flags > 1], chunk.keys[flags > 1]))
            own = own[later[own] | (t.symbol[own] == v.symbols)]
            short = t.short[own] >= 0
            buffer.add(t, flags, LISTED, own[short], t.short, place)
            buffer.add(t, flags, LATER, own[~short], t.context, place)
            if buffer.next(t, flags):
                yield packed()
        yield packed()

    def by_context(batches: Iterable[pa.RecordBatch]):
        """The restaurants of the contexts of this task; documents and figures pass through."""
        model, kinds = shared.value, (LISTED, LATER, MET)
        v, found = model.vocabulary, {k: _Blobs() for k in kinds}
        yield from _by_kind(batches, found)
        docs, flags = (np.concatenate([found[k].array(c, d) for k in kinds]) for c, d in (("docs", np.uint64), ("flags", np.uint8)))
        before = np.cumsum([0, *[found[k].array("docs", np.uint64).size for k in kinds]])
        doc = np.concatenate([found[k].doc(8 if k == MET else 4) + n for k, n in zip(kinds, before)])
        shorts = np.append(np.arange(_shorts(v), dtype=np.uint64), v.words | AFTER_RARE)
        context = np.concatenate([shorts[found[LISTED].array("x", np.int32)], found[LATER].array("x", np.uint64),
                                  found[MET].array("x", np.uint64)])
        place = np.concatenate([found[k].array("y", np.int32) for k in (LISTED, LATER)])
        word = np.append(v.words[place], found[MET].array("y", np.uint64))
        rank = np.minimum(v.rank, v.symbols)
        symbol = np.append(rank[place], np.full(len(word) - len(place), v.symbols))
        q = np.append(np.where(rank < v.symbols, 1.0, 10.0 ** model.rare_log)[place], found[MET].array("z", np.float64))
        found.clear()
        after_rare = 10.0 ** model.log_symbols(v.symbols).astype(np.float64)
        base = q * np.where(context < AFTER_RARE, 1 / model.class_mass[_class(word).astype(np.int64)], after_rare[symbol])
        p, place, at, total = seated(context, word, base, flags[doc] & 1, model.burn_in, model.samples)
        value = np.log10(p * class_probability(place, total, model)[at])
        value = np.bincount(doc, value, len(docs))
        yield _rows(_packed_figures(VALUE, parts, *_summed(docs[flags > 1], [value[flags > 1]])))

    def by_document(batches: Iterable[pa.RecordBatch]):
        """Rows equal in id and text share their figures, and each has its result."""
        found = {k: _Blobs() for k in (DOCUMENT, FIGURES, VALUE)}
        yield from _by_kind(batches, found)
        keys = found[DOCUMENT].array("x", np.int64)
        rows, first, at = np.unique(found[DOCUMENT].array("docs", np.uint64), return_index=True, return_inverse=True)
        n_tokens, n_known, base_score, value = found[DOCUMENT].figures(4)[:, first]
        copies = np.bincount(at, minlength=len(rows))
        known, more_base, more_value = (np.bincount(np.searchsorted(rows, found[k].array("docs", np.uint64)), f, len(rows)) / copies
                                        for k, n in ((FIGURES, 2), (VALUE, 1)) for f in found[k].figures(n))
        value = value + more_value
        yield _batch(f"{KEY} n_tokens n_known base_score score perplexity", keys, *[c[at] for c in (
            n_tokens.astype(np.int64), (n_known + np.rint(known)).astype(np.int64),
            base_score + more_base - n_tokens * np.log10(base), value, 10.0 ** (-value / n_tokens))])

    met = (texts.mapInArrow(unlisted, BLOB).union(rare.mapInArrow(rare_words, BLOB)).repartitionById(parts, F.col("part"))
           .mapInArrow(meet, BLOB))
    scored = (texts.mapInArrow(listed, BLOB).union(met).repartitionById(parts, F.col("part")).mapInArrow(by_context, BLOB)
              .repartitionById(parts, F.col("part"))
              .mapInArrow(by_document, f"{KEY} long, n_tokens long, n_known long, base_score double, score double, perplexity double"))
    return scored.select(id_of().alias(id_col), "n_tokens", "n_known", "base_score", "score", "perplexity")


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` scored; learned from those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model, rare = fit(keyed_texts(docs.where(~held_out())))
    texts = docs.select(key_of("doc_id").alias(KEY), F.coalesce(F.col("text").cast("string"), F.lit("")).alias(TEXT),
                        (~held_out()).alias(LEARN), F.lit(True).alias(SCORE))
    scored = score_texts(texts, model, rare)
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
