"""Session settings and the shared scratch folder.

Lineage is cut with reliable ``checkpoint()`` into the folder the cluster
names in ``spark.checkpoint.dir``.  Only when that is unset and Spark runs in
local mode (tests, the bench) do we create one ourselves.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "netstream",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they
    import it by name and do not see the driver's ``sys.path``."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="netstream-ship-"), "netstream")
    sc.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
    _shipped.add(sc.applicationId)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def checkpoint_base(spark: SparkSession) -> str:
    """Base of the shared checkpoint folder (``spark.checkpoint.dir``)."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            base = None
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is unset: name a shared folder (HDFS/S3/...) "
                "that every executor can reach")
        base = tempfile.mkdtemp(prefix="netstream-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", base)
        except Exception:  # noqa: BLE001 - core conf may be read-only at runtime
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint base (never machine-local
    on a cluster)."""
    base = checkpoint_base(spark)
    path = os.path.join(base, "netstream", f"{name}-{uuid.uuid4().hex[:12]}")
    return path


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def partitions_for(spark: SparkSession, rows: int, target_rows: int = 2_000_000) -> int:
    """Partition count for a table of ``rows`` rows that an iterative job
    re-joins every pass: about ``target_rows`` per partition, never fewer
    than the cluster's default parallelism."""
    return max(int(spark.sparkContext.defaultParallelism), -(-int(rows) // target_rows))


def cut_lineage(df, spark: SparkSession | None = None, name: str = "stage", path: str | None = None):
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    (at ``path``, if the caller deletes it later) and read it back: lineage is cut, a lost executor re-reads the table
    instead of recomputing the chain, and the data is computed once (a
    reliable ``checkpoint()`` of an uncached plan computes it twice).
    Never ``localCheckpoint``."""
    spark = spark or df.sparkSession
    path = path or scratch_dir(spark, name)
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Drop the shuffle files of each query in the block when it ends: what it
    wrote is in the shared folder, so nobody reads them again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def materialize_bucketed(df, keys, partitions: int, name: str = "bucketed", dealt: bool = False):
    """``df`` as a table in the shared folder, bucketed by ``keys``: its scan
    reports the partitioning, so an iterative job that joins it on ``keys``
    every pass shuffles only the other side.  Returns ``(table, drop)``;
    ``drop()`` takes it off the catalog and deletes its files.  ``dealt``: ``df`` was
    grouped by ``keys`` just now and is not shuffled again."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    table = f"netstream_{name}_{uuid.uuid4().hex[:12]}"
    with shuffles_dropped(spark):
        rows = df if dealt else df.repartition(partitions, *keys)
        (rows.write.bucketBy(partitions, *keys).sortBy(*keys)
           .option("path", path).format("parquet").saveAsTable(table))

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove_scratch(spark, path)

    return spark.table(table), drop


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_dir`` named, once nobody reads it."""
    if "/netstream/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def shuffle_partitions_set(spark: SparkSession, n: int):
    """Run an iterative job with ``n`` shuffle partitions (sized to its
    data), restoring the session setting afterwards."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(n)))
    try:
        yield
    finally:
        spark.conf.set(key, old)
