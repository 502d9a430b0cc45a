"""Session settings for local work; a cluster brings its own."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("flowgrid")
             .config("spark.sql.shuffle.partitions", str(partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.driver.memory", memory)
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint directory that the cluster names. Only a session on this machine alone may
    use a temporary folder of its own; elsewhere other machines could not read it."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="flowgrid-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/flowgrid/{name}-{uuid.uuid4().hex}"
