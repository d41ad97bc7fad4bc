"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on at scale. Joins against one-row-per-key sides are left
# to AQE: it splits a hot partition of the large side, also where that costs one more exchange.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A JSON record that repeats a key is read, with its last value, instead of refused.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime settings above on a session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", name: str = "adjudica", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder every executor can reach")
        base = os.path.join(tempfile.gettempdir(), "adjudica-scratch")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so later steps do not recompute it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """A file scan with at least one partition per core.

    For work that costs much per row on input cut into few splits. A scan that already has enough
    splits, as any large one does, is returned as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
