"""Session defaults and the reliable-checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# On a cluster shuffles start wide; adaptive execution coalesces them to the advisory size and splits
# skewed join partitions.
CLUSTER_SHUFFLE_PARTITIONS = 8000

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "pricewright", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the defaults above; anything given here or on submission comes first."""
    builder = SparkSession.builder.appName(app)
    defaults: dict[str, object] = dict(DEFAULTS)
    if master:
        builder = builder.master(master)
    if not (master or "").startswith("local"):
        defaults["spark.sql.shuffle.partitions"] = CLUSTER_SHUFFLE_PARTITIONS
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # started by spark-submit, whose settings are readable
        submitted = SparkConf()
        defaults = {k: v for k, v in defaults.items() if not submitted.contains(k)}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`; a scratch folder only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pricewright-checkpoints-"))
    return context.getCheckpointDir()


def importable_in_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies beside the driver's script and is not installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
