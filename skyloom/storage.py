"""Where intermediate tables are written."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session on one machine without that setting gets a folder of its own, removed when the
    process ends; on a cluster the executors could not share one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="skyloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that is not used yet."""
    return f"{shared_folder(spark)}/skyloom/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, **write_options) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there, columns stay prunable."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**write_options).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``written`` gave; nothing may read them any more."""
    for table in tables:
        removed(table.sparkSession, table.written_to)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this package has written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
