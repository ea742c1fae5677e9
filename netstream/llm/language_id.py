"""Language identification by cross-parsing.

A text is parsed against each language's sample: from the left, the longest
phrase that occurs somewhere in the sample is taken, again and again.  The
language that needs the fewest phrases per letter has the lowest cross entropy
and wins.  A suffix automaton of the sample answers "does the phrase go on?" in
one table look-up per letter, and a batch of texts is parsed in lockstep with
numpy, one look-up per language and letter.

Texts are lower-cased; each letter of the samples is a symbol (letters of no
sample share one), everything else is one space.  They are
parsed in blocks of ``BLOCK`` symbols, a phrase ends with its block; this adds
the same to each language and lets very long texts run as many short ones.

Learning reads a bounded sample of each label: ``SAMPLE_CHARS`` characters of up to
``SAMPLE_DOCS`` documents in the order of a hash (of a text longer than
``SAMPLE_PIECE`` a piece of that length), so all samples are equally long where the
table allows, and every label is learned, however rare, whatever its alphabet and
the length of its texts.  Only these samples travel to the tasks, which build the
automata.  Prediction is a map over all rows without a shuffle, and so is the filter
``keep_identified``: it judges each row by its text, whatever its id.

Defined cases: a null text, a text without letters, or no labelled row at all
gives ``und`` with score 0; of languages with equally many phrases the first by
name wins; score is 1 where one language was learned; repeated rows get equal
rows; only id, text and (for learning) label are read.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netstream.llm.common import KEY, TEXT, filtered, id_of, keyed_texts, text_slices

SAMPLE_CHARS = 20_000
SAMPLE_DOCS = 200
SAMPLE_PIECE = 8_000
SALTS = 64
BLOCK = 256
EVIDENCE_LETTERS = 20
DENSE_CELLS = 4_000_000
MIN_PHRASE = 1.75
UNDETERMINED = "und"
SCHEMA = f"{KEY} long, lang_pred string, score double, phrase_length double"

_models: dict = {}


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring of
    ``symbols``; state 0 is the dead end, 1 the start."""
    longest, link, moves = [0, 0], [0, 0], [None, {}]
    last = 1
    for s in symbols:
        new = len(longest)
        longest.append(longest[last] + 1)
        link.append(1)
        moves.append({})
        at = last
        while at and s not in moves[at]:
            moves[at][s] = new
            at = link[at]
        if at:
            to = moves[at][s]
            if longest[to] == longest[at] + 1:
                link[new] = to
            else:
                clone = len(longest)
                longest.append(longest[at] + 1)
                link.append(link[to])
                moves.append(dict(moves[to]))
                while at and moves[at].get(s) == to:
                    moves[at][s] = clone
                    at = link[at]
                link[to] = link[new] = clone
        last = new
    return [{}, *moves[1:]]


class Moves:
    """The transitions of an automaton.  Symbols that occur in none of them share
    a column, so the table has a column per symbol of its own sample; where that is
    too large (many letters), the transitions are a sorted list."""

    def __init__(self, moves: list[dict[int, int]], alphabet: int):
        used = sorted({s for out in moves for s in out})
        self.column = np.zeros(alphabet, np.int32)  # column 0: leads nowhere
        self.column[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        state = np.repeat(np.arange(len(moves)), [len(out) for out in moves])
        place = state * self.width + self.column[[s for out in moves for s in out]] if len(state) else np.zeros(0, np.int64)
        to = np.array([t for out in moves for t in out.values()], np.int32)
        self.table, self.places = None, None
        if len(moves) * self.width <= DENSE_CELLS:
            self.table = np.zeros(len(moves) * self.width, np.int32)
            self.table[place] = to
        else:
            order = np.argsort(place)
            self.places, self.to = np.append(place[order], -1), np.append(to[order], 0)

    def __call__(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        place = state * self.width + self.column[symbol]
        if self.table is not None:
            return self.table[place]
        at = np.searchsorted(self.places[:-1], place)
        return np.where(self.places[at] == place, self.to[at], 0)


class CrossParser:
    """Automata of the samples ``{language: text}``."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        own = sorted({c for t in samples.values() for c in t.lower() if c.isalpha()})
        self.alphabet = len(own) + 2  # 0: no letter; the last: a letter of no sample
        letters = np.array([chr(c).isalpha() for c in range(0x110000)])
        self.symbol = np.where(letters, self.alphabet - 1, 0).astype(np.uint8 if self.alphabet <= 256 else np.int32)
        for n, c in enumerate(own, 1):
            self.symbol[ord(c)] = n
        self.moves, self.bits = [], []
        for language in self.languages:
            flat, _, _ = self.symbols([samples[language]])
            self.moves.append(Moves(suffix_automaton(flat.tolist()), self.alphabet))
            self.bits.append(np.log2(max(2, len(flat))))

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts end to end, symbols and letters per text."""
        lowered = [t.lower() for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
        raw = self.symbol[points]
        doc = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
        keep = raw > 0
        keep[1:] |= (raw[:-1] > 0) & (doc[1:] == doc[:-1])
        flat, doc = raw[keep].astype(np.int32), doc[keep]
        n = len(texts)
        return flat, np.bincount(doc, minlength=n), np.bincount(doc[flat > 0], minlength=n)

    def phrases(self, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Phrases per text and language."""
        blocks = -(-counts // BLOCK)
        doc = np.repeat(np.arange(len(counts)), blocks)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = np.repeat(np.cumsum(counts) - counts, blocks) + within * BLOCK
        size = np.minimum(BLOCK, counts[doc] - within * BLOCK)
        order = np.argsort(-size, kind="stable")
        start, size, doc = start[order], size[order], doc[order]
        state = [np.ones(len(doc), np.int64) for _ in self.moves]
        total = [np.zeros(len(doc), np.int32) for _ in self.moves]
        for step in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -step, side="left"))
            symbol = flat[start[:n] + step]
            for moves, at, count in zip(self.moves, state, total):
                now = moves(at[:n], symbol)
                stop = np.flatnonzero(now == 0)
                again = moves(np.ones(len(stop), np.int64), symbol[stop])
                # the open phrase (none at the start) ends; a symbol that the sample lacks is a phrase
                count[stop] += (at[stop] != 1).astype(np.int32) + (again == 0)
                now[stop] = np.maximum(again, 1)
                at[:n] = now
        return np.stack([np.bincount(doc, c + (at != 1), len(counts)) for c, at in zip(total, state)], 1)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and mean phrase length of each text."""
        flat, counts, letters = self.symbols(texts)
        phrases = self.phrases(flat, counts)
        entropy = phrases * np.array(self.bits) / np.maximum(letters, 1)[:, None]
        best = entropy.argmin(1)
        gap = entropy - entropy.min(1, keepdims=True)
        score = 1 / (2.0 ** (-EVIDENCE_LETTERS * gap)).sum(1)
        some = letters > 0
        length = letters / np.maximum(phrases[np.arange(len(texts)), best], 1)
        return ([self.languages[b] if s else UNDETERMINED for b, s in zip(best, some)],
                np.where(some, score, 0.0), np.where(some, length, 0.0))


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """``{language: sample}`` from labelled rows (bounded, see the module)."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = labelled.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), text.alias("text")).where("lang IS NOT NULL")
    # a piece of a long text, from a place that its hash chooses
    spare = F.greatest(F.length("text") - SAMPLE_PIECE, F.lit(0))
    hashed = (rows.withColumn("h", F.xxhash64("text"))
              .withColumn("text", F.substr("text", (F.pmod("h", spare + 1) + 1).cast("int"), F.lit(SAMPLE_PIECE))))
    salted = Window.partitionBy("lang", F.pmod("h", F.lit(SALTS))).orderBy("h")
    order = Window.partitionBy("lang").orderBy("h")
    picked = (hashed.groupBy("lang", "h").agg(F.max(F.length("text")).alias("size"))  # copies count once
              .withColumn("n", F.row_number().over(salted)).where(F.col("n") <= SAMPLE_DOCS)
              .withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_DOCS)  # of SALTS times as many
              .withColumn("before", F.sum("size").over(order) - F.col("size"))
              .where(F.col("before") < SAMPLE_CHARS).select("lang", "h", "n"))
    texts = (hashed.join(F.broadcast(picked), ["lang", "h"])  # at most SAMPLE_DOCS rows a language
             .groupBy("lang", "n").agg(F.max("text").alias("text")))
    samples: dict[str, str] = {}
    for r in sorted(texts.collect(), key=lambda r: (r["lang"], r["n"])):
        samples[r["lang"]] = (samples.get(r["lang"], "") + "\n" + r["text"])[:SAMPLE_CHARS]
    return {k: v for k, v in samples.items() if any(c.isalpha() for c in v)}


def _parser(samples: dict[str, str]) -> CrossParser:
    """Built once per worker process."""
    key = tuple(sorted(samples.items()))
    if key not in _models:
        _models.clear()
        _models[key] = CrossParser(samples)
    return _models[key]


def _predictions(samples: dict[str, str], texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    if samples:
        return _parser(samples).predict(texts)
    return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))


def _predicted(samples: dict[str, str], batches: Iterable[pa.RecordBatch]):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for batch in batches:
        for part in text_slices(batch, TEXT):
            lang, score, length = _predictions(samples, part.column(TEXT).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(KEY), pa.array(lang, pa.string()), pa.array(score), pa.array(length)],
                                             names=names)


def identify(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score, phrase_length`` of each row."""
    rows = keyed_texts(docs, id_col, text_col).mapInArrow(lambda batches: _predicted(samples, batches), SCHEMA)
    return rows.select(id_of().alias(id_col), "lang_pred", "score", "phrase_length")


def keep_identified(docs: DataFrame, samples: dict[str, str], text_col: str = "text",
                    min_phrase: float = MIN_PHRASE) -> DataFrame:
    """``docs`` without the rejected: undetermined, or explained by no learned
    language (phrases of fewer than ``min_phrase`` letters on average)."""
    def keep(texts: pa.Array) -> np.ndarray:
        lang, _, length = _predictions(samples, texts.to_pylist())
        return (np.array(lang) != UNDETERMINED) & (length >= min_phrase)

    return filtered(docs, text_col, keep)


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows whose crc32 of the id as text leaves no 1 modulo 3."""
    return docs.where(~held_out())


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    """The language of each of the ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs, learn(training_rows(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "phrase_length")
