"""Vector code compression.

Vectors become integers ``floor(scale * x)`` and are cut into ``parts`` equal
parts; each part position has a codebook of ``entries`` entries, fitted by exact
Lloyd rounds, and a vector's code names the nearest entry of each part.

The vectors are written once as chunks of ``CHUNK_ROWS`` rows.  In a chunk the
points of each part position are sorted along a Hilbert curve and laid out as
flat blocks of ``BLOCK`` points, each with its bounding box (least and greatest
components) and its sums.  In a round the least and greatest distances between a
box and the entries leave a short list of entries per block: an entry whose least
distance is above the smallest greatest distance is nearest to none of the block's
points.  A block with one entry left gives its sums at once; for the others a
small integer kernel measures the points against the short list.  A round is a map
over the chunks and a sum of ``parts * entries`` counts and sums; nothing is
shuffled but these.  The driver holds the codebooks, whose size is the vectors'
width times ``entries``.

Defined cases: a null vector and one with a null, NaN or infinite component are
left out; shorter vectors count as followed by zeros up to the longest, whose
length is rounded up to a multiple of ``parts``; integers beyond ``LARGEST`` count
as ``LARGEST`` (sums of squares then fit a long); with fewer than ``entries``
vectors there are as many entries as vectors; the first entries are the vectors of
the least ids, a null id first, equal ids ordered by their vectors; each of
repeated rows has its own result; a sum of errors that does not fit a long is null;
an empty table gives no rows.  Only the id, vector and label columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from netstream.llm.common import forget
from netstream.llm.vectors import VECTOR, is_finite, matrix, row_chunks, slot_sums
from netstream.session import cut_lineage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 26
CHUNK_ROWS = 16_384
BLOCK = 64
CURVE_BITS = 8
LABEL_SALTS = 16


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point (last axis: whole coordinates below ``2**bits``)
    along the Hilbert curve, by Skilling's transposition of the coordinates."""
    axes = [points[..., i].astype(np.uint32) for i in range(points.shape[-1])]
    top = bits - 1
    for level in range(top, 0, -1):  # undo the turns of the coarser cells
        low = np.uint32((1 << level) - 1)
        for axis in axes:
            turned = (axis >> np.uint32(level)) & np.uint32(1) == 1
            swap = np.where(turned, np.uint32(0), (axes[0] ^ axis) & low)
            axis ^= swap
            axes[0] ^= np.where(turned, low, swap)
    for before, axis in zip(axes, axes[1:]):  # Gray code
        axis ^= before
    flip = np.zeros_like(axes[0])
    for level in range(top, 0, -1):
        flip ^= np.where((axes[-1] >> np.uint32(level)) & np.uint32(1) == 1, np.uint32((1 << level) - 1), np.uint32(0))
    key = np.zeros(axes[0].shape, np.uint64)
    for level in range(top, -1, -1):
        for axis in axes:
            key = (key << np.uint64(1)) | (((axis ^ flip) >> np.uint32(level)) & np.uint32(1)).astype(np.uint64)
    return key


def curve_order(points: np.ndarray) -> np.ndarray:
    """Order of the points of one part position along the curve."""
    points = points[:, :63]  # a key has 63 bits; more dimensions only order less well
    bits = max(1, min(CURVE_BITS, 63 // max(points.shape[1], 1)))
    least = points.min(0, initial=LARGEST)
    width = np.maximum(points.max(0, initial=-LARGEST) - least, 0) + 1
    return np.argsort(hilbert_keys(((points - least) << bits) // width, bits), kind="stable")


class Blocks:
    """The blocks of one part position of a chunk: ``points`` in curve order
    (the last block filled up with its last point), boxes and sums."""

    def __init__(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.n, width = points.shape
        short = -self.n % BLOCK
        filled = np.concatenate([points, np.repeat(points[-1:], short, axis=0)]) if short else points
        self.points = filled.reshape(-1, BLOCK, width)
        self.low, self.high, self.sums = low, high, sums
        self.size = np.minimum(BLOCK, self.n - BLOCK * np.arange(len(self.points)))

    @classmethod
    def of(cls, points: np.ndarray) -> Blocks:
        starts = np.arange(0, len(points), BLOCK)
        return cls(points, *(f.reduceat(points, starts, axis=0) for f in (np.minimum, np.maximum, np.add)))

    def short_lists(self, book: np.ndarray) -> np.ndarray:
        """Whether an entry can be nearest to a point of a block."""
        below, above = self.low[:, None] - book, book - self.high[:, None]
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(-1)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(-1)
        return least <= most.min(1, keepdims=True)

    def nearest(self, book: np.ndarray, listed: np.ndarray):
        """``(blocks, codes, errors)`` of blocks with equally long lists; codes
        and errors per point.  Ties go to the lower entry."""
        length = listed.sum(1)
        for size in np.unique(length):
            blocks = np.flatnonzero(length == size)
            for some in np.array_split(blocks, -(-len(blocks) * size // 2048)):
                entries = np.nonzero(listed[some])[1].reshape(len(some), size)
                far = self.points[some][:, None] - book[entries][:, :, None]
                distance = np.einsum("...i,...i", far, far)
                pick = distance.argmin(1)
                yield some, np.take_along_axis(entries, pick, 1), np.take_along_axis(distance, pick[:, None], 1)[:, 0]

    def round_sums(self, book: np.ndarray) -> np.ndarray:
        """Per entry the number and the component sums of its points."""
        k, width = book.shape
        out = np.zeros((k, 1 + width), np.int64)
        listed = self.short_lists(book)
        single = listed.sum(1) == 1
        owner = listed[single].argmax(1)
        np.add.at(out[:, 0], owner, self.size[single])
        np.add.at(out[:, 1:], owner, self.sums[single])
        others = np.flatnonzero(~single)
        if len(others):
            rest = Blocks.__new__(Blocks)
            rest.points, size = self.points[others], self.size[others]
            for some, codes, _ in rest.nearest(book, listed[others]):
                real = np.arange(BLOCK) < size[some][:, None]
                code, points = codes[real], rest.points[some][real]
                out[:, 0] += np.bincount(code, minlength=k)
                for i in range(width):  # sums of a chunk are below 2**53
                    out[:, 1 + i] += np.bincount(code, points[:, i], k).astype(np.int64)
        return out

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code and squared distance of each point, in curve order."""
        codes, errors = (np.zeros(self.points.shape[:2], np.int64) for _ in range(2))
        for some, code, error in self.nearest(book, self.short_lists(book)):
            codes[some], errors[some] = code, error
        return codes.reshape(-1)[:self.n], errors.reshape(-1)[:self.n]


def _stored(batch: pa.RecordBatch, row: int, name: str, shape: tuple) -> np.ndarray:
    data = np.frombuffer(batch.column(name)[row].as_buffer(), "<i8" if name == "sums" else "<i4")
    return data.reshape(shape).astype(np.int64)


def _part_blocks(batch: pa.RecordBatch, row: int, parts: int, width: int):
    """The ``Blocks`` of each part position of a stored chunk."""
    n = batch.column("n")[row].as_py()
    blocks = -(-n // BLOCK)
    points = _stored(batch, row, "points", (parts, n, width))
    low, high, sums = (_stored(batch, row, c, (parts, blocks, width)) for c in ("low", "high", "sums"))
    return [Blocks(*part) for part in zip(points, low, high, sums)]


def _integers(column: pa.ListArray, width: int, scale: int) -> np.ndarray:
    return np.clip(np.floor(matrix(column, width) * scale), -LARGEST, LARGEST).astype(np.int64)


def block_table(vectors: DataFrame, width: int, parts: int, scale: int) -> DataFrame:
    """One row per chunk of ``vectors(id, label, VECTOR)``: ids and labels in
    the given order, and the sorted blocks of all part positions."""
    label = vectors.schema["label"].dataType
    schema = (f"n int, ids array<long>, labels array<{label.simpleString()}>, place binary, points binary, "
              "low binary, high binary, sums binary")
    label_type = to_arrow_type(label)

    def lay_out(batches: Iterable[pa.RecordBatch]):
        for batch in row_chunks(batches, CHUNK_ROWS):
            x = _integers(batch.column(VECTOR), width, scale)
            split = [np.ascontiguousarray(p) for p in x.reshape(len(x), parts, -1).swapaxes(0, 1)]
            order = [curve_order(p) for p in split]
            blocks = [Blocks.of(p[o]) for p, o in zip(split, order)]
            stored = [np.concatenate(order).astype("<i4"), np.concatenate([p[o] for p, o in zip(split, order)]).astype("<i4"),
                      *(np.concatenate([getattr(b, c) for b in blocks]).astype(t)
                        for c, t in (("low", "<i4"), ("high", "<i4"), ("sums", "<i8")))]
            yield pa.RecordBatch.from_arrays([
                pa.array([len(x)], pa.int32()),
                pa.ListArray.from_arrays([0, len(x)], batch.column("id")),
                pa.ListArray.from_arrays([0, len(x)], batch.column("label").cast(label_type)),
                *(pa.array([a.tobytes()], pa.binary()) for a in stored)],
                names=["n", "ids", "labels", "place", "points", "low", "high", "sums"])

    return cut_lineage(vectors.mapInArrow(lay_out, schema), name="vector-blocks")


def refine(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks ``(parts, entries, width)`` after one round."""
    parts, k, width = books.shape

    def sums(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((parts, k, 1 + width), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p, part in enumerate(_part_blocks(batch, row, parts, width)):
                    total[p] += part.round_sums(books[p])
        return total.reshape(-1)

    table = blocks.select("n", "points", "low", "high", "sums")
    total = slot_sums(table, sums, parts * k * (1 + width), "long").reshape(parts, k, 1 + width)
    count = total[..., :1]
    return np.where(count > 0, total[..., 1:] // np.maximum(count, 1), books)


def encode(blocks: DataFrame, books: np.ndarray, label_type: str) -> DataFrame:
    """``(id, label, code, error)`` of each vector."""
    parts, _, width = books.shape
    hexes = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), "S2")

    def codes(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for row in range(batch.num_rows):
                n = batch.column("n")[row].as_py()
                place = _stored(batch, row, "place", (parts, n))
                code, error = np.zeros((n, parts), "S2"), np.zeros(n, np.int64)
                for p, part in enumerate(_part_blocks(batch, row, parts, width)):
                    found, far = part.assign(books[p])
                    code[place[p], p] = hexes[found]
                    error[place[p]] += far
                text = code.reshape(-1).tobytes().decode()
                yield pa.RecordBatch.from_arrays([
                    batch.column("ids")[row].values, batch.column("labels")[row].values,
                    pa.array([text[2 * parts * i:2 * parts * (i + 1)] for i in range(n)], pa.string()), pa.array(error)],
                    names=["id", "label", "code", "error"])

    return blocks.mapInArrow(codes, f"id long, label {label_type}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per vector: ``id_col, code, error, label_error,
    codebooks_sha256``.  ``entries`` is at most 256."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    spark = table.sparkSession
    vectors = table.where(is_finite(vector_col)).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"),
        F.col(f"`{vector_col}`").alias(VECTOR))
    longest = vectors.agg(F.max(F.size(VECTOR))).first()[0] or 0
    width = -(-longest // parts)  # components of a part
    label_type = vectors.schema["label"].dataType.simpleString()
    first = vectors.select("id", VECTOR).orderBy(F.asc_nulls_first("id"), VECTOR).limit(entries).toArrow()
    if not first.num_rows:
        return spark.createDataFrame([], f"`{id_col}` long, code string, error long, label_error long, codebooks_sha256 string")
    start = _integers(first[VECTOR].combine_chunks(), parts * width, scale)
    books = start.reshape(len(start), parts, width).swapaxes(0, 1)
    blocks = block_table(vectors, parts * width, parts, scale)
    for _ in range(rounds):
        books = refine(blocks, books)
    coded = cut_lineage(encode(blocks, books, label_type), name="vector-codes")
    forget(blocks)
    salt = F.pmod(F.xxhash64("code", "id"), F.lit(LABEL_SALTS))
    totals = cut_lineage(coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
                         .withColumnRenamed("label", "of"), name="label-errors")
    spread = totals.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    return (coded.withColumn("salt", salt)
            .join(spread, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("copy")))
            .select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))


def query(spark, sf_dir: str) -> DataFrame:
    """Codes of all ``embeddings``."""
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql_round(n: int) -> str:
    """Assignment to the entries ``c{n}`` and the entries after it."""
    return f"""
d{n} AS (SELECT x.vec_id, x.p, c.e, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d
         FROM x JOIN c{n} c ON c.p = x.p AND c.j = x.j GROUP BY ALL),
a{n} AS (SELECT vec_id, p, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d FROM d{n} GROUP BY ALL),
m{n} AS (SELECT x.p, a.e, x.j, floor(sum(x.v) / count(*))::BIGINT AS v FROM x JOIN a{n} a USING (vec_id, p) GROUP BY ALL),
c{n + 1} AS (SELECT c.p, c.e, c.j, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (p, e, j))"""


SQL = f"""WITH kept AS (
  SELECT vec_id, label, embedding, len(embedding) // 16 AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS (SELECT vec_id, i // w AS p, i % w AS j, floor(256 * CAST(embedding[i + 1] AS DOUBLE))::BIGINT AS v
      FROM (SELECT vec_id, w, embedding, unnest(range(len(embedding))) AS i FROM kept)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
c0 AS (SELECT x.p, f.e, x.j, x.v FROM x JOIN first f USING (vec_id)),
{",".join(_sql_round(n) for n in range(3))},
book AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM c2),
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id),
total AS (SELECT label, sum(error)::BIGINT AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label)
SELECT c.vec_id, c.code, c.error, t.label_error, b.codebooks_sha256
FROM coded c JOIN kept k USING (vec_id) JOIN total t ON t.label IS NOT DISTINCT FROM k.label CROSS JOIN book b"""
