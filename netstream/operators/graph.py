"""Graph construction: canonical edges (G1), nodes (G2), node index (G3),
symmetric adjacency (G5), degree (G6) and the normalised Laplacian (G7).

Matrices are sparse COO DataFrames ``(i, j, v)``; nothing is densified.
Joins against per-node tables (degree) are left to Catalyst + AQE: AQE turns
them into broadcasts when the runtime size is under the threshold and splits
hub partitions with its skew-join rule otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netstream.operators.indexing import row_index
from netstream.session import cut_lineage


def canonical_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Undirected simple graph: reversed pairs and duplicates collapse to one
    edge ``src <= dst``; self-loops are kept."""
    s, d = F.col(src), F.col(dst)
    return (edges.where(s.isNotNull() & d.isNotNull())
                 .select(F.least(s, d).alias("src"), F.greatest(s, d).alias("dst"))
                 .distinct())


def drop_self_loops(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("src") != F.col("dst"))


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Every endpoint once: ``(id)``."""
    return (edges.select(F.col("src").alias("id"))
                 .union(edges.select(F.col("dst").alias("id")))
                 .distinct())


def node_index(edges: DataFrame, partitions: int | None = None) -> DataFrame:
    """Dense 0-based matrix row of each node, in id order: ``(id, idx)``."""
    return row_index(graph_nodes(edges), order="id", index_col="idx", partitions=partitions)


def index_named_edges(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """String-named edges -> BIGINT ids through a dense name index.

    Returns ``(edges(src, dst BIGINT), nodes(id, name))``.
    """
    names = (edges.select(F.col("src").cast("string").alias("name"))
                  .union(edges.select(F.col("dst").cast("string").alias("name")))
                  .distinct())
    nodes = row_index(names, order="name", index_col="id")
    a = nodes.select(F.col("name").alias("src"), F.col("id").alias("src_id"))
    b = nodes.select(F.col("name").alias("dst"), F.col("id").alias("dst_id"))
    out = (edges.select(F.col("src").cast("string").alias("src"),
                        F.col("dst").cast("string").alias("dst"))
                .join(a, "src").join(b, "dst")
                .select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst")))
    return out, nodes.select("id", "name")


def weighted_edges(edges: DataFrame, weight: float = 1.0) -> DataFrame:
    """``(src, dst, weight)`` with a constant weight."""
    return edges.select("src", "dst", F.lit(float(weight)).alias("weight"))


def symmetric_adjacency(edges: DataFrame) -> DataFrame:
    """0/1 symmetric adjacency as COO ``(i, j, v)`` from canonical edges: each
    edge both ways, a self-loop once."""
    fwd = edges.select(F.col("src").alias("i"), F.col("dst").alias("j"))
    rev = edges.where(F.col("src") != F.col("dst")).select(
        F.col("dst").alias("i"), F.col("src").alias("j"))
    return fwd.union(rev).withColumn("v", F.lit(1.0))


def degrees(edges: DataFrame) -> DataFrame:
    """Row sums of the adjacency: ``(id, degree)``; a self-loop counts once.

    Computed from canonical edges without materialising the symmetric
    matrix: each endpoint of a non-loop edge gets 1, a loop gives 1.
    """
    ends = edges.select(
        F.explode(F.when(F.col("src") == F.col("dst"), F.array("src"))
                   .otherwise(F.array("src", "dst"))).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).cast("double").alias("degree"))


def normalized_laplacian(edges: DataFrame) -> DataFrame:
    """``L = I - D^-1/2 A D^-1/2`` as COO ``(i, j, v)``.

    Off-diagonal entries ``-1/sqrt(d_i d_j)`` are computed once per canonical
    edge (two joins against the degree table over m rows, not 2m) and then
    emitted in both directions; the diagonal is ``1 - A_ii/d_i`` per node.
    """
    edges = cut_lineage(edges.select("src", "dst"), name="edges")   # used five times below
    deg = degrees(edges)
    r = deg.select(F.col("id"), (F.lit(1.0) / F.sqrt("degree")).alias("r"), "degree")
    rs = r.select(F.col("id").alias("src"), F.col("r").alias("r_src"))
    rd = r.select(F.col("id").alias("dst"), F.col("r").alias("r_dst"))
    off = (edges.where(F.col("src") != F.col("dst"))
                .join(rs, "src").join(rd, "dst")
                .select("src", "dst", (-F.col("r_src") * F.col("r_dst")).alias("v")))
    off = off.select(
        F.explode(F.array(
            F.struct(F.col("src").alias("i"), F.col("dst").alias("j"), F.col("v")),
            F.struct(F.col("dst").alias("i"), F.col("src").alias("j"), F.col("v")))).alias("e")
    ).select("e.i", "e.j", "e.v")
    loops = edges.where(F.col("src") == F.col("dst")).select(F.col("src").alias("id"),
                                                             F.lit(1.0).alias("a_ii"))
    diag = (deg.join(loops, "id", "left")
               .select(F.col("id").alias("i"), F.col("id").alias("j"),
                       (F.lit(1.0) - F.coalesce(F.col("a_ii"), F.lit(0.0)) / F.col("degree")).alias("v")))
    return off.unionByName(diag)


def normalized_adjacency(edges: DataFrame) -> DataFrame:
    """``N = D^-1/2 A D^-1/2`` as COO ``(i, j, w)`` including self-loop
    diagonals ``1/d_i``; ``L = I - N`` on nodes with an edge."""
    edges = cut_lineage(edges.select("src", "dst"), name="edges")   # used three times below
    deg = degrees(edges)
    r = deg.select(F.col("id"), (F.lit(1.0) / F.sqrt("degree")).alias("r"))
    rs = r.select(F.col("id").alias("src"), F.col("r").alias("r_src"))
    rd = r.select(F.col("id").alias("dst"), F.col("r").alias("r_dst"))
    w = (edges.join(rs, "src").join(rd, "dst")
              .select("src", "dst", (F.col("r_src") * F.col("r_dst")).alias("w")))
    both = F.when(F.col("src") == F.col("dst"),
                  F.array(F.struct(F.col("src").alias("i"), F.col("dst").alias("j"), F.col("w"))))
    both = both.otherwise(F.array(
        F.struct(F.col("src").alias("i"), F.col("dst").alias("j"), F.col("w")),
        F.struct(F.col("dst").alias("i"), F.col("src").alias("j"), F.col("w"))))
    return w.select(F.explode(both).alias("e")).select("e.i", "e.j", "e.w")
