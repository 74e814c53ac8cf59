"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and the bench. On a cluster, pass your own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("veritide")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Looking up the caller of every column expression costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # HotSpot does not compile methods above this size; Spark then goes operator by operator.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name in the cluster's shared checkpoint folder.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/veritide-{uuid.uuid4().hex}"
