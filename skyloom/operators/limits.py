"""Limits of many rows that no single task has to gather."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Up to so many rows Spark's own limit, which gathers them in one task, is the quicker way.
GATHERED = 100_000
#: What may stand between a table and a limit that is counted.
NARROW = {"Project", "Filter", "SubqueryAlias"}
#: Where a row is stored, as columns that are carried along.
FILE, ROW = "_skyloom_file", "_skyloom_row"


def counted_limit(df: DataFrame, count: int, gathered: int = GATHERED) -> DataFrame:
    """At most ``count`` rows, whichever, taken where they are stored.

    For rows of one Parquet table, filtered or not, the rows of each file are counted first (from the
    footers alone if there is no filter). Whole files are taken in the order of their names until the
    limit is reached, and the file in which it is reached gives its first rows. Files beyond it are
    not opened, the rows are not shuffled, and the same rows come back when a task is run
    again or the cluster changes. Other sources, shuffled rows, SQL text over views and limits up to
    ``gathered`` rows are left to ``DataFrame.limit``. Files that change between count and read can
    shift the number.
    """
    if count <= gathered or not rows_of_one_table(df):
        return df.limit(count)
    try:
        placed = with_places(df)
    except AnalysisException:  # a view keeps the places of its rows to itself
        return df.limit(count)
    return taken(placed, count)


def with_places(df: DataFrame) -> DataFrame:
    """The rows of a Parquet table with the file and number of each, for ``taken``."""
    places = {FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")}
    return df.select("*", *(place.alias(name) for name, place in places.items()))


def taken(df: DataFrame, count: int) -> DataFrame:
    """At most ``count`` rows of a table ``with_places``, without the places."""
    file, row = F.col(FILE), F.col(ROW)
    files = df.select(file.alias("file")).groupBy("file").agg(F.count("*").alias("rows"))
    total, last = 0, None
    for entry in files.orderBy("file").toLocalIterator():
        last, before, total = entry["file"], total, total + entry["rows"]
        if total > count:
            break
    if total <= count:
        return df.drop(FILE, ROW)
    cut = df.where(file == last)
    order = Window.partitionBy("part").orderBy("row")
    # Rows of one file, numbered within fixed stretches so that no task holds the whole file.
    stretch = 1 << 20
    rows = cut.select(row.alias("row")).withColumn("part", F.floor(F.col("row") / stretch))
    left, edge = count - before, -1
    for entry in rows.groupBy("part").agg(F.count("*").alias("rows")).orderBy("part").collect():
        if entry["rows"] >= left:
            if left:
                numbered = rows.where(F.col("part") == entry["part"]).withColumn(
                    "place", F.row_number().over(order)
                )
                edge = numbered.where(F.col("place") == left).first()["row"]
            break
        left -= entry["rows"]
    return df.where(file < last).unionByName(cut.where(row <= edge)).drop(FILE, ROW)


def rows_of_one_table(df: DataFrame) -> bool:
    """Whether the rows come from one Parquet table by conditions and expressions alone."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in NARROW and plan.children().size() == 1:
        if not plan.deterministic():
            return False
        plan = plan.children().apply(0)
    if plan.nodeName() != "LogicalRelation" and not plan.nodeName().startswith("Relation"):
        return False
    relation = plan.relation()
    if not relation.getClass().getSimpleName().startswith("HadoopFsRelation"):
        return False
    return "Parquet" in relation.fileFormat().getClass().getSimpleName()
