"""Session helpers: session settings, the shared checkpoint folder, and stage tables in it."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale as much as locally: AQE re-plans joins and partition
# counts from runtime sizes, skew-join splits hot partitions, and NTZ is the default
# timestamp type so local wall-clock hours are never shifted by the session zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "daycast", conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. Without ``master``, a job started by spark-submit keeps
    the master and the memory it was given; only a plain Python process runs locally.
    Shuffle partitions are the cluster's unless ``conf`` sets them."""
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ
    builder = SparkSession.builder.appName(app)
    settings = dict(DEFAULT_CONF)
    if not submitted:
        settings["spark.driver.memory"] = "8g"
        master = master or os.environ.get("MASTER", "local[*]")
    if master:
        builder = builder.master(master)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder: ``spark.checkpoint.dir`` names shared storage
    and is used as is. Only a local master, where all tasks share this machine's disk, may
    go without and gets a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="daycast-ckpt-")
    sc.setCheckpointDir(path)
    return path


def write_stage(df: DataFrame, kind: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: later
    steps start from files, which survive the executors that wrote them."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), f"{kind}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
