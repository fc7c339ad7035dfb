"""Session set-up and the one place where lineage is cut."""
from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str = "*", name: str = "accessgrid", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers of this machine find the package, whatever folder the session began in."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    root = str(Path(__file__).resolve().parents[1])
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="accessgrid-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def removed_at_exit(spark: SparkSession, path: str) -> None:
    """Marks a path that exists to go when the application ends."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)


def removed(spark: SparkSession, path: str) -> None:
    """Removes a folder of the library's own that nothing reads any more."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and go on from the written table.

    Used where a table feeds several jobs, or where a later step must see exactly the
    rows an earlier one saw.  The table outlives lost executors, and its size is known
    to the optimizer when it picks join strategies.  It goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/accessgrid/{uuid.uuid4().hex}"
    df.write.parquet(path)
    removed_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
