"""Readers for the parquet tables and the stand-in inputs derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netstream.operators.indexing import following

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def purchase_edges(lineitem: DataFrame) -> DataFrame:
    """Bipartite order-part purchase graph, one edge per line item.

    Order and part keys share one id space by interleaving: an order is the
    even node ``2*l_orderkey`` and a part the odd node ``2*l_partkey+1``.
    The edge count is linear in ``lineitem`` (no pairs are formed inside an
    order), so a hot order only raises one node's degree.
    """
    return lineitem.select(
        (F.col("l_orderkey") * 2).alias("src"),
        (F.col("l_partkey") * 2 + 1).alias("dst"))


def nation_star_edges(customer: DataFrame) -> DataFrame:
    """Customer -> nation, one star per nation: customer ``c`` is node
    ``c_custkey * 2``, nation ``n`` node ``c_nationkey * 2 + 1``.  Its
    normalised Laplacian has the eigenvalues 0 and 2 once per nation with
    customers and 1 otherwise, and each nation is a hub."""
    return customer.select((F.col("c_custkey") * 2).alias("src"), (F.col("c_nationkey") * 2 + 1).alias("dst"))


def part_chain_edges(lineitem: DataFrame) -> DataFrame:
    """Parts on neighbouring rows of an order (by line number, then part): one
    edge per pair of neighbours, linear in ``lineitem`` and not bipartite.  The
    neighbour is found within range partitions, so a hot order is no hot task."""
    rows = lineitem.where(F.col("l_orderkey").isNotNull() & F.col("l_partkey").isNotNull()).select(
        "l_orderkey", "l_linenumber", "l_partkey")
    chain = following(rows, order=["l_linenumber", "l_partkey"], group="l_orderkey", value="l_partkey")
    return chain.toDF("src", "dst")


def purchase_node_names(nodes: DataFrame, id_col: str = "id") -> DataFrame:
    """Readable name of an interleaved node id: ``o<orderkey>`` / ``p<partkey>``."""
    ident = F.col(id_col)
    return nodes.withColumn(
        "name",
        F.when(ident % 2 == 0, F.concat(F.lit("o"), (ident / 2).cast("long").cast("string")))
         .otherwise(F.concat(F.lit("p"), ((ident - 1) / 2).cast("long").cast("string"))))


def bit_events(events: DataFrame) -> DataFrame:
    """BIT stand-in: one bit stream per user, ``bit = event_type = 'error'``."""
    return events.select(
        F.col("user_id").alias("key"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_type") == "error").cast("int").alias("bit"))


def mention_events(events: DataFrame, batch_rows: int = 1000) -> DataFrame:
    """MEN stand-in: ``event_type`` as the mention, micro-batches of
    ``batch_rows`` consecutive event ids."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("mention"),
        F.floor(F.col("event_id") / F.lit(batch_rows)).cast("long").alias("batch_id"))
