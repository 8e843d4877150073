"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# UTC keeps the two timestamp rules (drop the offset / shift to UTC) apart;
# the rest are the defaults a large cluster run wants as well.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # no call-site capture per column expression: wide plans are built several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "finledger", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def in_one_process(spark: SparkSession) -> bool:
    """Whether driver and executors are one (``local``, ``local[n]``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the folder shared by driver and executors.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is unset and everything runs in
    one process, as in tests, a folder is made and set for the rest of the session; on a
    cluster that is an error, as executors would each write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not in_one_process(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="finledger-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows from a written copy in the shared scratch folder: the lineage ends there, so a lost
    executor costs a read, and nothing is computed twice."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system that Spark resolves the path against, and the path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, where = filesystem(spark, path)
    return fs.exists(where)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, where = filesystem(spark, path)
    fs.delete(where, True)
