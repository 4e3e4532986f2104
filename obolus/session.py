"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: str = "*", app: str = "obolus", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    conf = {
        **CONF,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("OBOLUS_DRIVER_MEMORY", "8g"),
        "obolus.spread": cores if cores.isdigit() else "8",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, so that a lost
    executor costs a re-read and not a recomputation. The folder is the cluster's
    ``spark.checkpoint.dir``; where the session names none the caller must set one."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        spark.sparkContext.setCheckpointDir(folder)
    elif spark.sparkContext.getCheckpointDir() is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; on one machine a local one where the session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="obolus-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, *folders: str) -> DataFrame:
    """``df`` as a table in the shared folder: what several readers need is computed once, a lost executor
    costs a re-read, and each reader takes the columns that it needs, and of the values of
    ``folders`` those that it asks for. Whoever clears the checkpoint folder clears it."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    (df.write.partitionBy(*folders) if folders else df.write).parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
