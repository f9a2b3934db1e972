"""SparkSession builder and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a shuffle join into a broadcast only after measuring the side at runtime.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call-site capture costs ~5 extra Py4J round trips per column function;
    # the ~800 expressions of the gold chain took ~6 s to declare with it, ~3.5 s without.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "harvestframe",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``), registered for checkpoints.

    Only a local session without the setting gets a folder of its own; on a cluster a
    missing setting is an error, since a folder of the driver's machine is not shared.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            d = tempfile.mkdtemp(prefix="harvestframe-ckpt-")
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder (its scheme kept; writers create it)."""
    return f"{shared_dir(spark)}/harvestframe/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, read back: cuts the lineage, computes it once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
