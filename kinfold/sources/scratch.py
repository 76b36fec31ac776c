"""Shared scratch space: cut a lineage by writing a table where every executor can read it."""
from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether shuffle files go at the end of the query that wrote them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where the session names none, a folder of this machine if the master is local (tests),
    which is removed at the end; any other master raises, as its executors would each write to a disk of their own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share; the master is {sc.master}")
        own = tempfile.mkdtemp(prefix="kinfold-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
        named = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: computed once, prunable by column, safe from lost executors.

    Shuffle files of the write go as soon as it ends; they would stay until the driver collects its garbage. The tables of a session lie in one folder, `kinfold-<application id>`, which `clear` removes."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/kinfold-{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Removes the tables that `materialize` wrote in this session. Results that still read them must have been written or collected."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def default_parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
