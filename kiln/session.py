"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the pipeline relies on. AQE re-plans joins from runtime sizes (a broadcast
# is chosen only when the measured side is under the threshold) and splits skewed
# shuffle partitions; UTC keeps date arithmetic independent of the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # keys of streaming aggregates live on disk, not in the executors' heaps
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "kiln",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the pipeline's settings.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster leave them
    unset so the submit-time configuration wins.
    """
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
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is respected as is;
    the scratch fallback exists for local tests only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="kiln-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def staging_root(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint area for lineage-cutting staged tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "kiln-stage", name)


def parquet_stage(df: DataFrame) -> DataFrame:
    """Materialise a frame as a parquet table under the shared checkpoint folder and continue
    from the written table (columnar, compressed, survives executor loss)."""
    path = staging_root(df.sparkSession, f"staged-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
