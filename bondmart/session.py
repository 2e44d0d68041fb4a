"""Spark session and checkpoint-location helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. AQE re-plans joins from measured sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "bondmart") -> SparkSession:
    """Session for local runs and tests; on a cluster the submitted conf
    (master, partitions, checkpoint dir) is kept."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("BONDMART_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def snapshot(df: DataFrame, name: str = "table") -> DataFrame:
    """Materialize a small derived table once and cut its lineage.

    Written as parquet under the shared folder named by
    ``spark.checkpoint.dir`` (survives executor loss; never a local
    checkpoint) and read back: one job, and the result is a file scan whose
    measured size drives the broadcast decision of later joins. The
    ``rebalance`` hint lets AQE pick the file count from the data size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/snapshots/{uuid.uuid4().hex}-{name}"
    df.hint("rebalance").write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._bm_path = path  # for the run that removes it
    return out


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    A local session (one machine) without that setting gets a scratch folder;
    on a cluster a machine's own folder would lose data, so it must be set.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="bondmart-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d
