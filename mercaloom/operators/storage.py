"""Intermediate tables on shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# One task writes one file, so that files have the order of the partitions.
ONE_FILE = {"maxRecordsPerFile": 0}

# Scratch folders of local applications without the setting, by application id.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a local master may run without the setting; it gets a scratch folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="mercaloom-")
    return _local_folders[application]


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/mercaloom/{spark.sparkContext.applicationId}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete what this application has materialized, once its results are saved elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    What follows sees one fixed result however often it is read and whichever executors are lost,
    and reads only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**ONE_FILE).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
