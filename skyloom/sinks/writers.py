"""Sinks. Every write replaces the table it names; a table cannot be its own source."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.sky import zone_column

FORMATS = {"parquet": "parquet", "csv": "csv", "jsonl": "json"}


def sky_layout(
    df: DataFrame, zone_height: float, ra: str = "ra", dec: str = "dec"
) -> DataFrame:
    """Neighbours on the sky next to each other: declination zones, right ascension within.

    Adds the zone number in a column named after the zones' height. Rows at one position are spread over tasks by their
    input partition.
    """
    name = zone_column(zone_height)
    zone = F.floor((F.col(dec) + 90.0) / F.lit(float(zone_height))).cast("int")
    return (
        df.withColumn(name, zone)
        .repartitionByRange(name, ra, dec, F.spark_partition_id())
        .sortWithinPartitions(name, ra)
    )


def store_of(spark: SparkSession, path: str):
    """The store of a path, and the path with its scheme and without ``.`` or a trailing slash."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store, store.makeQualified(hadoop)


def _refuse_own_source(df: DataFrame, path: str) -> None:
    """Replacing files that the same rows come from would leave the DataFrame without a source.

    Compared are the root folders of the scanned relations, not every file in them.
    """
    target = store_of(df.sparkSession, path)[1].toString()
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if not leaf.getClass().getSimpleName().startswith("LogicalRelation"):
            continue
        relation = leaf.relation()
        if not relation.getClass().getSimpleName().startswith("HadoopFsRelation"):
            continue
        roots = relation.location().rootPaths()
        for j in range(roots.size()):
            source = roots.apply(j).toString()
            if f"{source}/".startswith(f"{target}/") or f"{target}/".startswith(f"{source}/"):
                raise ValueError(f"cannot overwrite a path that is also read: {path}")


def _replaced(df: DataFrame, path: str, save) -> None:
    """Saves to a folder beside ``path`` and puts it in place when all rows are there.

    Until then the old files stay; a failed write removes what it has written.
    """
    store, target = store_of(df.sparkSession, path)
    mark = uuid.uuid4().hex[:12]
    new, old = (target.suffix(f".{kind}-{mark}") for kind in ("new", "old"))
    try:
        save(new.toString())
    except BaseException:
        for _ in range(20):  # other tasks of the failed job may still be writing there
            store.delete(new, True)
            time.sleep(0.1)
            if not store.exists(new):
                break
        raise
    moved = store.exists(target) and store.rename(target, old)
    if not store.rename(new, target):
        if moved:
            store.rename(old, target)
        raise OSError(f"cannot put the new files in place: {path}")
    if moved:
        store.delete(old, True)


def write_files(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    compression: str | None = None,
    batch_size: int | None = None,
    sky_zone: float | None = None,
) -> None:
    """Writes a directory of Parquet, CSV (with header) or JSON-lines files.

    ``batch_size`` caps the rows per file. ``sky_zone`` is the height in degrees of declination
    zones by which the table is partitioned; within them the files cover small patches, so that
    searches by position skip most folders, files and row groups. The name of the partition
    column holds the height. NULLs are written to JSON lines too.

    The old files are replaced when the new ones are complete; a failed write leaves them.
    """
    _refuse_own_source(df, path)
    _replaced(
        df, path, lambda new: save_files(df, new, file_format, compression, batch_size, sky_zone)
    )


def save_files(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    compression: str | None = None,
    batch_size: int | None = None,
    sky_zone: float | None = None,
) -> None:
    """As ``write_files``, to a folder that is not there yet."""
    if file_format not in FORMATS:
        raise ValueError(f"unsupported file format: {file_format}")
    writer = (sky_layout(df, sky_zone) if sky_zone else df).write
    if sky_zone:
        writer = writer.partitionBy(zone_column(sky_zone))
    writer = writer.format(FORMATS[file_format])
    if file_format == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    if file_format == "jsonl":
        writer = writer.option("ignoreNullFields", False)
    if compression:
        writer = writer.option("compression", compression)
    elif file_format == "parquet":
        writer = writer.option("compression", "snappy")
    if batch_size:
        writer = writer.option("maxRecordsPerFile", batch_size)
    writer.save(path)


def read_files(
    spark: SparkSession,
    path: str,
    schema,
    file_format: str = "parquet",
    line_breaks: bool = True,
) -> DataFrame:
    """Reads back what ``write_files`` wrote.

    Without ``line_breaks`` in its cells, a CSV file can be read by many tasks.
    """
    reader = spark.read.schema(schema).format(FORMATS[file_format])
    if file_format == "csv":
        reader = (
            reader.option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", line_breaks)
        )
    return reader.load(path)


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replaces a table of the Spark catalog; with ``path`` its files lie there.

    The new rows are complete before the old table goes.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        places = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
        for row in places.select("data_type").collect():
            _refuse_own_source(df, row[0])
    if path:
        _refuse_own_source(df, path)
        _replaced(df, path, df.write.format("parquet").save)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path, "parquet")
        return
    staged = f"{name}_new_{uuid.uuid4().hex[:12]}"
    try:
        df.write.format("parquet").saveAsTable(staged)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 1000,
    connections: int = 8,
) -> None:
    """Replaces a table of a database, emptied in place where the database can do it.

    At most ``connections`` tasks write at a time, to protect the server. The rows are shuffled to
    them, so that what comes before keeps its tasks.
    """
    (
        df.repartition(connections)
        .write.mode("overwrite")
        .option("truncate", True)
        .option("batchsize", batch_size)
        .jdbc(url, table, properties=dict(properties or {}))
    )


@dataclass(frozen=True)
class FileTarget:
    """Tables as directories ``<base>/<dataset>/<table>``."""

    base: str
    file_format: str = "parquet"
    dataset: str = "catalogue"
    compression: str | None = None
    batch_size: int | None = None
    sky_zone: float | None = None
    observes: ClassVar[bool] = True

    def location(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{self.dataset}/{table}"

    def write(self, df: DataFrame, table: str) -> None:
        write_files(
            df,
            self.location(table),
            self.file_format,
            self.compression,
            self.batch_size,
            self.sky_zone,
        )


@dataclass(frozen=True)
class TableTarget:
    """Tables of the Spark catalog in the database ``dataset``, made if it is missing."""

    dataset: str = "catalogue"
    base: str | None = None
    observes: ClassVar[bool] = True

    def location(self, table: str) -> str:
        return f"{self.dataset}.{table}"

    def write(self, df: DataFrame, table: str) -> None:
        folder = f"{self.base.rstrip('/')}/{self.dataset}" if self.base else None
        place = f" LOCATION '{folder}'" if folder else ""
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {self.dataset}{place}")
        write_table(df, self.location(table), f"{folder}/{table}" if folder else None)


@dataclass(frozen=True)
class JdbcTarget:
    """Tables of a database server, in its schema ``dataset``."""

    url: str
    dataset: str = "catalogue"
    properties: Mapping[str, str] = field(default_factory=dict)
    batch_size: int = 1000
    observes: ClassVar[bool] = False  # the rows are counted by a pass of their own

    def location(self, table: str) -> str:
        return f"{self.dataset}.{table}"

    def write(self, df: DataFrame, table: str) -> None:
        write_jdbc(df, self.url, self.location(table), self.properties, self.batch_size)


# Rows as text


def rows_to_json(df: DataFrame) -> DataFrame:
    """Every row as the text of a JSON object, NULLs included, in a column ``json``."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def rows_to_csv(df: DataFrame, sep: str = ",") -> DataFrame:
    """Every row as a line of delimited text in a column ``csv``; the header is
    ``sep.join(df.columns)``."""
    options = {"sep": sep, "quote": '"', "escape": '"'}
    return df.select(F.to_csv(F.struct("*"), options).alias("csv"))
