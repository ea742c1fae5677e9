"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader (proximal) updates, scored as sparse dot products.

Features of a text: its words, its pairs of neighbouring words, the shapes of
words and of pairs (letters become ``A``/``a``, digits ``0``, runs collapsed,
with a mark where a word repeats the one before), each hashed to one of
``FEATURES`` places.  A feature's value is its share of the text's features of
its kind, its square root taken, so length does not decide.

Training reads a bounded sample of ``TRAIN_DOCS`` labelled rows (the first by
hash; the bound is a parameter).  Shards of about ``SHARD_DOCS`` of them are
trained side by side, in as many passes as make ``UPDATES`` updates, and their
weights are averaged per feature (parameter mixing); weights are at most
``FEATURES`` numbers.  Scoring is a map over all
rows without a shuffle.

Defined cases: a null or empty text has the intercept's score; with one label
only, the score leans to it; without labelled rows every score is 0.5; rows
whose label is neither 0 nor 1 are not learned from; repeated rows get equal
scores.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.llm.common import KEY, SPACE, TEXT, Chunk, byte_codes, hash_runs, id_of, key_of, keyed_texts, mix, word_chunks

FEATURES = 1 << 18
TRAIN_DOCS = 8_000
SHARD_DOCS = 1_000
UPDATES = 6_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
THRESHOLD = 0.3
KINDS = 4
SCHEMA = f"{KEY} long, score double"

#: Byte classes of shapes: ``A``, ``a`` (other scripts too), ``0``; the rest as they are.
_CLASS = np.array([65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b > 127 else 48 if 48 <= b <= 57 else b
                   for b in range(256)], np.uint8)
_RUN = np.isin(np.arange(256), [65, 97, 48])


def shape_hashes(chunk: Chunk) -> np.ndarray:
    """Hash of each word's shape: ``Hello!!`` -> ``Aa!!``."""
    if not len(chunk.starts):
        return np.zeros(0, np.uint64)
    at = int(chunk.starts[0])
    raw = _CLASS[chunk.raw[at:]]
    starts = chunk.starts - at
    keep = ~SPACE[raw]
    again = _RUN[raw[1:]] & (raw[1:] == raw[:-1])
    again[starts[1:] - 1] = False
    keep[1:] &= ~again
    place = np.cumsum(keep, dtype=np.int32)
    rank = place - np.repeat(place[starts], np.diff(np.append(starts, len(raw))))
    rank *= keep
    return hash_runs(np.where(keep, byte_codes(raw), np.uint64(0)), rank, starts)


class Featurizer:
    """Hashed features of whole documents."""

    def __init__(self, features: int = FEATURES):
        self.features = features

    def __call__(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(document, place, value)``, ordered by document."""
        word, shape, doc = chunk.hashes, shape_hashes(chunk), chunk.doc
        pairs = doc[1:] == doc[:-1]
        again = np.append(False, (word[1:] == word[:-1]) & pairs) if len(word) else np.zeros(0, bool)
        shape = mix(shape + again.astype(np.uint64))
        base = np.uint64(0x9E3779B97F4A7C15)
        kinds = [word, mix(word[:-1] * base + word[1:])[pairs], shape, mix(shape[:-1] * base + shape[1:])[pairs]]
        places, docs = [], []
        for kind, hashes in enumerate(kinds):
            places.append((mix(hashes + np.uint64(kind)) % np.uint64(self.features)).astype(np.int64))
            docs.append(doc if len(hashes) == len(doc) and kind % 2 == 0 else doc[1:][pairs])
        kind = np.repeat(np.arange(KINDS), [len(p) for p in places])
        doc, place = np.concatenate(docs), np.concatenate(places)
        code, n = np.unique((doc * KINDS + kind) * self.features + place, return_counts=True)
        group, place = code // self.features, code % self.features
        total = np.bincount(group, n, len(chunk.keys) * KINDS)
        return group // KINDS, place, np.sqrt(n / total[group])


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, features: int, epochs: int) -> np.ndarray:
    """Weights (the last is the intercept) by FTRL-proximal updates, in the
    order of the rows; each row is ``(places, values)``."""
    z, n = np.zeros(features + 1), np.zeros(features + 1)

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    for _ in range(epochs):
        for (places, values), label in zip(rows, labels):
            at, x = np.append(places, features), np.append(values, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(np.arange(features + 1))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", features: int = FEATURES, limit: int = TRAIN_DOCS, shard_docs: int = SHARD_DOCS,
          updates: int = UPDATES) -> np.ndarray:
    """Averaged weights from the documents of at most ``limit`` rows of
    ``labels``."""
    kept = (labels.select(key_of(id_col).alias(KEY), F.col(f"`{label_col}`").cast("int").alias("label"))
            .where(F.col("label").isin(0, 1)).distinct().orderBy(F.xxhash64(KEY), KEY, "label").limit(limit))
    sample = (keyed_texts(docs, id_col, text_col).join(F.broadcast(kept), KEY)  # at most ``limit`` rows
              .select(F.xxhash64(TEXT).alias(KEY), "label", TEXT)
              .groupBy(KEY, "label").agg(F.max(TEXT).alias(TEXT)))  # copies count once

    shards = max(1, sample.count() // shard_docs)

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([KEY, "label"], kind="stable")
        featurize, found, labels = Featurizer(features), [], []
        batch = pa.RecordBatch.from_arrays([pa.array(pdf["label"], pa.int64()), pa.array(pdf[TEXT], pa.string())],
                                           names=[KEY, TEXT])
        for chunk in word_chunks([batch], lower=True):
            doc, place, value = featurize(chunk)
            ends = np.searchsorted(doc, np.arange(len(chunk.keys) + 1))
            found += [(place[a:b], value[a:b]) for a, b in zip(ends, ends[1:])]
            labels += chunk.keys.tolist()
        w = ftrl(found, np.array(labels, np.float64), features, max(1, -(-updates // len(labels))))
        at = np.flatnonzero(w)
        return pd.DataFrame({"place": at, "weight": w[at]})

    parts = (sample.withColumn("_nx_shard", F.pmod(F.col(KEY), F.lit(shards)))
             .groupBy("_nx_shard").applyInPandas(shard, "place long, weight double"))
    used = max(1, sample.select(F.pmod(F.col(KEY), F.lit(shards))).distinct().count())
    out = np.zeros(features + 1)
    for r in parts.groupBy("place").agg(F.sort_array(F.collect_list("weight")).alias("w")).collect():  # <= FEATURES + 1
        out[r["place"]] = sum(r["w"]) / used
    return out


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` (probability of label 1) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterable[pa.RecordBatch]):
        w = shared.value
        featurize = Featurizer(len(w) - 1)
        for chunk in word_chunks(batches, lower=True):
            doc, place, value = featurize(chunk)
            dot = np.bincount(doc, w[place] * value, len(chunk.keys)) + w[-1]
            yield pa.RecordBatch.from_arrays([pa.array(chunk.keys), pa.array(1 / (1 + np.exp(-np.clip(dot, -35, 35))))],
                                             names=[KEY, "score"])

    return (keyed_texts(docs, id_col, text_col).mapInArrow(scored, SCHEMA)
            .select(id_of().alias(id_col), "score"))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    """The quality of each of the ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    weights = train(docs, labels.where(~held_out()))
    return score(docs, weights).select("doc_id", held_out().alias("held_out"), "score",
                                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
