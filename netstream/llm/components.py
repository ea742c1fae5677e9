"""Connected components of a link table (alternating small and large stars).

Before each star the links are put together where they stand, up to ``JOINED`` of a
task at once and without a shuffle.  A star is one aggregation and one join over
the links; no component is ever gathered in one task.  Links are written to the
shared folder after each star; the rounds end as soon as every node has one link,
to the head of its component.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.llm.common import forget
from netstream.session import cut_lineage

LINKS = "a long, b long"
JOINED = 1_000_000

def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(id, least)``: each node of the links and the least node it reaches
    over them; the least nodes themselves are left out."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, least = place[:len(a)], place[len(a):], np.arange(len(ids))
    while True:
        at, to = least[x], least[y]
        low = np.minimum(at, to)
        now = least.copy()
        for ends in (x, y, at, to):
            np.minimum.at(now, ends, low)
        now = now[now]
        if (now == least).all():
            break
        least = now
    other = least != np.arange(len(ids))
    return ids[other], ids[least[other]]


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    def put_together() -> pa.RecordBatch:
        found = least_reachable(*(np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("a", "b")))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= JOINED:
            yield put_together()
            held, rows = [], 0
    if held:
        yield put_together()


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (above it, or below it with itself) are linked to
    the least of its neighbours and itself."""
    links = links.mapInArrow(_joined, LINKS)
    both = links if not large else links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    near = both.join(least, "a")
    if large:
        out = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # the row of the least neighbour stands for the node itself
        out = near.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return out.where("a <> b")


def _settled(links: DataFrame) -> bool:
    """Whether each node has one link at most, to a node below it that has none."""
    ends = links.select(F.col("a").alias("id"), "b").union(
        links.select(F.col("b").alias("id"), F.lit(None).cast("long").alias("b")))
    nodes = ends.groupBy("id").agg(F.count("b").alias("links"), F.count(F.lit(1)).alias("n"))
    return nodes.where("links > 1 OR (links = 1 AND n > 1)").count() == 0


def heads(links: DataFrame) -> DataFrame:
    """``(id, component)`` of the nodes of ``links(a, b)`` (longs) that reach a lesser
    one: the least id reachable."""
    now = cut_lineage(links.where("a <> b").select("a", "b").mapInArrow(_joined, LINKS), name="links")
    while not _settled(now):
        half = cut_lineage(_star(now, large=False), name="half")
        old, now = now, cut_lineage(_star(half, large=True).distinct(), name="links")
        forget(old, half)
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every node of ``links(a, b)`` (longs): the least
    id reachable.  Nodes without a link to another are left out."""
    found = heads(links)
    return found.union(found.select(F.col("component").alias("id"), "component").distinct())
