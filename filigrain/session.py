"""Session defaults for tests, benches and spark-submit entry points."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g", name: str = "filigrain") -> SparkSession:
    """A local session; on a cluster the caller's own session is used instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    builder = builder.config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table below spark.checkpoint.dir, the folder that driver and executors share, and read again. Only
    a local master has a temporary folder of its own where the setting is missing."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = f"{(root or tempfile.mkdtemp(prefix='filigrain-')).rstrip('/')}/filigrain/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
