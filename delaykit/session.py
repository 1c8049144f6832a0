"""Session settings for local runs and tests.

On a cluster the session comes from the submit command; nothing here is needed
there and no operator sets configuration of its own.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, for tables, streams and their state.

    Without the setting a session on one machine uses a folder of its own; on a cluster
    other machines would not see it, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        folder = tempfile.mkdtemp(prefix="delaykit-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def local_session(cores: int | str = "*", app: str = "delaykit", memory: str = "8g") -> SparkSession:
    partitions = "8" if cores == "*" else str(max(int(cores), 2))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="delaykit-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
