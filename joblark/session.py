"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings that matter for large runs; none of them fixes a partition count.
SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "joblark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the scale settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _own_folder() -> tempfile.TemporaryDirectory:
    """For local sessions without a shared folder: one that goes with the process."""
    return tempfile.TemporaryDirectory(prefix="joblark-", ignore_cleanup_errors=True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session without ``spark.checkpoint.dir`` may fall back to a
    temporary folder: on a cluster such a folder is not shared by executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _own_folder().name
    return f"{base.rstrip('/')}/joblark/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a shared table and read it back.

    Cuts lineage in a way that survives lost executors, and lets several
    consumers use a result without parsing the pages again.
    """
    return write_table(df, shared_dir(df.sparkSession, name))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``materialize`` and the number of rows, which the write itself counts."""
    seen = Observation()
    written = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return written, seen.get["n"]


def write_table(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fill_cores(scan: DataFrame, key: str) -> DataFrame:
    """Spread a table that has fewer splits than the session has cores.

    Meant for a small file ahead of CPU-heavy rules. A table with enough splits
    is left as it is: moving its pages would cost more than it brings. ``scan``
    has to be a plain scan, whose split count is known without running it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)
