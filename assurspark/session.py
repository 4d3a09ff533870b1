"""SparkSession construction with the settings the reports are tuned for."""

from __future__ import annotations

import logging
import os

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Settings that matter at scale: AQE re-plans joins from runtime sizes
# (broadcast conversion, partition coalescing, skew splitting), and the
# auto-broadcast threshold is the size check behind every implicit broadcast.
# The driver collects and hashes what is broadcast, a production report a dozen
# tables at once, so the threshold bounds its memory whatever the tables' size.
# Before a table is read its size is that of its compressed files; as hashed
# rows, narrow columns take 10 to 20 times that, hence the factor.
REPORT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(4 * 1024 * 1024),
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


# Sizing for the large-scale runs (about 100 TB of input on a ~1000-executor
# cluster): start with many shuffle partitions and let AQE coalesce them to
# ~256 MB each; read files in 512 MB splits; treat a shuffle partition above
# 1 GB and 5x the median as skewed.  Applied by ``configure(spark, cluster=True)``.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.broadcastTimeout": "900",
    # window-filtered sides (this period's payouts, transactions, splits) build
    # runtime bloom filters that prune scans of full-history tables -- e.g. the
    # due-date lookup over all transactions -- before they are shuffled
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(256 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(1024 * 1024 * 1024),
}


def configure(spark: SparkSession, cluster: bool = False) -> SparkSession:
    """Apply report settings to an existing session; ``cluster=True`` adds the
    large-scale partition sizing.  A setting that the cluster has fixed is
    logged and left as it is."""
    conf = dict(REPORT_CONF, **(CLUSTER_CONF if cluster else {}))
    for k, v in conf.items():
        try:
            spark.conf.set(k, v)
        except AnalysisException as e:
            if "CANNOT_MODIFY" not in str(e.getCondition() or e):
                raise
            log.warning("%s is fixed on this cluster: %s", k, e)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "assurspark", memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the benchmark (UI off, no extra ports)."""
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # one machine: list partition directories on the driver instead of
        # launching a listing job for every read of a month-partitioned table
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "4096")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
