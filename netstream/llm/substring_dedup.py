"""Substring dedup with difference-cover anchors.

A window is ``WINDOW`` consecutive words of one document; every word is removed
that a window covers whose word sequence also starts earlier (smaller id, or
earlier in the same document).  Windows are judged on the input.

Hashing every window of the corpus would shuffle one row per word.  Instead,
anchors of ``ANCHOR`` words are hashed at the places whose remainder modulo
``PERIOD`` lies in the difference cover ``COVER``: for any two places there is a
step below ``PERIOD`` after which both lie in the cover, so two equal windows
share an anchor at the same step inside (``ANCHOR + PERIOD - 1 = WINDOW``).
Only windows around anchors that occur twice are then extended to their full
``WINDOW`` words and compared, by 128 bits.  The result equals that of
comparing all windows.

A document whose text is that of one with a smaller id is a copy: each of its
windows starts earlier there, so all its words go if it has a window, and only
the first of equal texts takes part in what follows.

Counting anchors and finding the first place of a window are partial
aggregates; marking the other places is a hash join whose large side adaptive
execution splits, so a passage in a third of all documents is no hot task.

Defined cases: words are taken as they are; a null text has none; fewer than
``WINDOW`` words make no window; rows that repeat an id are one document (equal
texts do not repeat each other, what is removed from the id is removed from
each row); a null id comes first.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.llm.common import (KEY, TEXT, Chunk, Rows, forget, mix, run_hashes, signed, whole_runs,
                                  word_chunks)
from netstream.session import cut_lineage

PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = 8
WINDOW = ANCHOR + PERIOD - 1


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.split())


def _positions(chunk: Chunk) -> np.ndarray:
    """Place of each word in its document."""
    return np.arange(len(chunk.hashes)) - np.repeat(chunk.first, chunk.counts)


def chunk_anchors(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, place, hash)`` of the anchors of documents long enough for
    a window."""
    at = whole_runs(chunk.counts, ANCHOR)
    place, doc = _positions(chunk)[at], chunk.doc[at]
    at = at[keep := np.isin(place % PERIOD, COVER) & (chunk.counts[doc] >= WINDOW)]
    return doc[keep], place[keep], run_hashes(chunk.hashes, ANCHOR)[at]


def copied_texts(texts: DataFrame) -> DataFrame:
    """``(KEY)`` of the texts that also stand under a smaller id."""
    same = texts.select(KEY, F.xxhash64(TEXT).alias("d1"), F.xxhash64(F.lit(1), TEXT).alias("d2"))
    first = same.groupBy("d1", "d2").agg(F.min(KEY).alias("first"), F.max(KEY).alias("last")).where("first < last")
    return (same.join(first, ["d1", "d2"]).where(F.col(KEY) > F.col("first")).select(KEY).distinct())


def repeated_anchors(texts: DataFrame) -> DataFrame:
    """``(KEY, places)``: where the anchors stand that occur more than once."""
    def counts(batches: Iterable[pa.RecordBatch]):
        for chunk in word_chunks(batches, lower=False):
            h, n = np.unique(chunk_anchors(chunk)[2], return_counts=True)
            yield _batch("h n", signed(h), np.minimum(n, 2).astype(np.int8))

    def rows(batches: Iterable[pa.RecordBatch]):
        for chunk in word_chunks(batches, lower=False):
            doc, place, h = chunk_anchors(chunk)
            _, at, n = np.unique(h, return_inverse=True, return_counts=True)
            sure = n[at] > 1  # twice in this chunk: known, and spread instead of meeting at its hash
            h = np.where(sure, mix(h + np.arange(len(h), dtype=np.uint64)), h)
            yield _batch(f"h {KEY} place sure", signed(h), chunk.keys[doc], place.astype(np.int32), sure)

    twice = (texts.mapInArrow(counts, "h long, n byte").groupBy("h").agg(F.sum("n").alias("n"))
             .where("n > 1").select("h", F.lit(True).alias("twice")))
    found = (texts.mapInArrow(rows, f"h long, {KEY} long, place int, sure boolean")
             .join(twice.hint("shuffle_hash"), "h", "left").where("sure OR twice"))
    return found.groupBy(KEY).agg(F.collect_list("place").alias("places"))


def extended_windows(texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """``(KEY, start, h1, h2, sure)`` of each window around a repeated anchor;
    ``sure``: its words start earlier in the same chunk of documents, so only
    the first window of a chunk has to meet those of others."""
    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            places = batch.column("places")
            done = 0
            for chunk in word_chunks([batch.select([KEY, TEXT])], lower=False):
                own = places.slice(done, len(chunk.keys))
                done += len(chunk.keys)
                doc = np.repeat(np.arange(len(own)), own.value_lengths().to_numpy())
                place = own.flatten().to_numpy()
                inside = place < chunk.counts[doc]
                first = chunk.first[doc[inside]] + place[inside]
                steps = np.zeros(len(chunk.hashes) + 1, np.int64)  # windows start up to PERIOD - 1 words before
                np.add.at(steps, np.maximum(first - PERIOD + 1, chunk.first[doc[inside]]), 1)
                np.add.at(steps, first + 1, -1)
                near = np.cumsum(steps[:-1]) > 0
                at = whole_runs(chunk.counts, WINDOW)
                at = at[near[at]]
                key, start = chunk.keys[chunk.doc[at]], _positions(chunk)[at].astype(np.int32)
                h1, h2 = run_hashes(chunk.hashes, WINDOW)[at], run_hashes(chunk.hashes, WINDOW, 1)[at]
                order = np.lexsort((start, key, h2, h1))
                first = np.append(True, (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0))[:len(order)]
                head = order[first][np.cumsum(first) - 1]  # the chunk's first window of these words
                sure = np.zeros(len(at), bool)
                sure[order] = (key[head] != key[order]) | (start[head] != start[order])
                yield _batch(f"{KEY} start h1 h2 sure", key, start, signed(h1), signed(h2), sure)

    return (texts.join(anchors, KEY).select(KEY, TEXT, "places")
            .mapInArrow(rows, f"{KEY} long, start int, h1 long, h2 long, sure boolean"))


def later_windows(windows: DataFrame) -> DataFrame:
    """``(KEY, starts)`` of the windows whose words also start earlier."""
    open_ = windows.where("NOT sure")
    first = (open_.groupBy("h1", "h2").agg(F.min(F.struct(KEY, "start")).alias("first"),
                                             F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("h1", "h2", "first"))
    later = (open_.join(first.hint("shuffle_hash"), ["h1", "h2"]).where(F.struct(KEY, "start") > F.col("first"))
             .select(KEY, "start").union(windows.where("sure").select(KEY, "start")))
    return later.groupBy(KEY).agg(F.collect_set("start").alias("starts"))


def remove_covered(texts: DataFrame, later: DataFrame, copies: DataFrame) -> DataFrame:
    """``(KEY, n_words, n_removed, kept)``: the texts without the words below
    the windows (copies: below any window), the rest joined by one space."""
    def rows(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            starts, copied = batch.column("starts"), batch.column("copied").to_numpy(zero_copy_only=False)
            done = 0
            for chunk in word_chunks([batch.select([KEY, TEXT])], lower=False):
                own = starts.slice(done, len(chunk.keys))
                gone = copied[done:done + len(chunk.keys)] & (chunk.counts >= WINDOW)
                done += len(chunk.keys)
                doc = np.repeat(np.arange(len(own)), own.value_lengths().fill_null(0).to_numpy())
                start = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                inside = start + WINDOW <= chunk.counts[doc]
                first = chunk.first[doc[inside]] + start[inside]
                steps = np.zeros(len(chunk.hashes) + 1, np.int64)
                np.add.at(steps, first, 1)
                np.add.at(steps, first + WINDOW, -1)
                keep = (np.cumsum(steps[:-1]) == 0) & ~gone[chunk.doc]
                kept = np.bincount(chunk.doc[keep], minlength=len(chunk.keys))
                yield _batch(f"{KEY} n_words n_removed kept", chunk.keys, chunk.counts, chunk.counts - kept,
                             joined_words(chunk, keep, kept))

    marked = later.join(copies, KEY, "left_anti").withColumn("copied", F.lit(False)).unionByName(
        copies.select(KEY, F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("copied")))
    return (texts.join(marked, KEY, "left").select(KEY, TEXT, "starts", F.coalesce("copied", F.lit(False)).alias("copied"))
            .mapInArrow(rows, f"{KEY} long, n_words long, n_removed long, kept string"))


def joined_words(chunk: Chunk, keep: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    starts, size = chunk.starts[keep], (chunk.ends - chunk.starts)[keep] + 1
    until = np.append(0, np.cumsum(size))
    at = np.repeat(starts - until[:-1], size) + np.arange(until[-1])
    raw = np.append(chunk.raw, np.uint8(32))[at]
    raw[until[1:] - 1] = 32
    bounds = until[np.append(0, np.cumsum(counts))]
    spaces = np.append(0, np.cumsum(counts > 0))  # the last space of each text goes
    mask = np.ones(len(raw), bool)
    mask[bounds[1:][counts > 0] - 1] = False
    offsets = (bounds - spaces).astype(np.int32)
    return pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets.tobytes()),
                                       pa.py_buffer(raw[mask].tobytes()))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_removed, kept`` of each row."""
    rows = Rows(docs, id_col, text_col)
    texts = rows.texts()
    copies = cut_lineage(copied_texts(texts), name="copies")
    firsts = cut_lineage(texts.join(copies, KEY, "left_anti"), name="firsts")
    anchors = cut_lineage(repeated_anchors(firsts), name="anchors")
    windows = cut_lineage(extended_windows(firsts, anchors), name="windows")
    forget(firsts, anchors)
    later = cut_lineage(later_windows(windows), name="later")
    forget(windows)
    found = rows.with_ids(remove_covered(texts, later, copies), KEY)
    return found.select(F.col(KEY).alias(id_col), "n_words", "n_removed", "kept")


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, with the digest of what is kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM t)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS rn FROM v),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE rn > 1),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM t),
kept AS (SELECT x.doc_id, count(g.p) AS n_removed,
                coalesce(string_agg(x.word, ' ' ORDER BY x.p) FILTER (WHERE g.p IS NULL), '') AS txt
         FROM x LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.p = g.p GROUP BY x.doc_id)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.txt, '')) AS kept_sha256
FROM t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
