"""Names of catalogue tables and where their rows come from."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import sky
from skyloom.operators.profile import column_list, table_profile
from skyloom.operators.query import CatalogQuery
from skyloom.sinks.versions import current_tables, read_version
from skyloom.vocab import TABLE_NAMES


class Catalog:
    """Looks a table name up among the given tables, else as a Parquet directory under
    ``base_path``, or without one as a table or view of the Spark session.

    If ``base_path`` is a dataset with versions (``skyloom.sinks.versions``), its tables are those of
    the version that is there when they are looked up.

    A given table is a DataFrame or a function that opens one when it is first needed.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None,
        base_path: str | None = None,
    ):
        self.spark = spark
        self.tables = dict(tables or {})
        self.base_path = base_path

    def register(self, name: str, table: DataFrame | Callable[[], DataFrame]) -> None:
        self.tables[name] = table

    def table(self, name: str) -> DataFrame:
        if name in self.tables:
            table = self.tables[name]
            if not isinstance(table, DataFrame):
                table = self.tables[name] = table()
            return table
        if self.base_path:
            if current_tables(self.spark, self.base_path) is not None:
                return read_version(self.spark, self.base_path, name)
            return self.spark.read.parquet(f"{self.base_path}/{name}")
        return self.spark.table(name)

    def names(self) -> list[str]:
        """The given tables and the Parquet directories under ``base_path``; with neither, the known
        catalogue tables that the session has. Only names are looked up, no table is opened."""
        names = list(self.tables)
        if self.base_path:
            names += [name for name in self._stored() if name not in self.tables]
        elif not names:
            names = [name for name in TABLE_NAMES if self.spark.catalog.tableExists(name)]
        return names

    def _stored(self) -> list[str]:
        versions = current_tables(self.spark, self.base_path)
        if versions is not None:
            return sorted(versions)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.base_path)
        store = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not store.exists(folder):
            return []
        found = [entry for entry in store.listStatus(folder) if entry.isDirectory()]
        names = (entry.getPath().getName() for entry in found)
        return sorted(name for name in names if not name.startswith(("_", ".")))

    def query(self) -> CatalogQuery:
        return CatalogQuery(self)

    def sql(self, text: str) -> DataFrame:
        """Runs Spark SQL in which the catalogue's tables are known by their names.

        ``sky_separation``, ``sky_circle``, ``sky_box`` and ``sky_polygon`` can be called in it, and regions of
        ``skyloom.functions.sky`` are SQL text that can stand in its conditions. Views of the session
        that have the tables' names are as before afterwards.
        """
        sky.register_functions(self.spark)
        words = set(re.findall(r"\w+", text))
        tables = {name: self.table(name) for name in self.names() if set(name.split()) <= words}
        views = self.spark._jsparkSession.sessionState().catalog()
        before = {name: self.spark.table(name) for name in tables if views.getTempView(name).isDefined()}
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        try:
            return self.spark.sql(text)
        finally:
            for name in tables:
                if name in before:
                    before[name].createOrReplaceTempView(name)
                else:
                    self.spark.catalog.dropTempView(name)

    def count_records(self, table: str, where: str | None = None) -> int:
        df = self.table(table)
        return (df.where(where) if where else df).count()

    def list_tables(self) -> DataFrame:
        """Name, number of columns and number of rows of every table."""
        return table_profile(self.spark, {name: self.table(name) for name in self.names()})

    def table_schema(self, name_pattern: str) -> DataFrame:
        """Columns of the tables whose name is LIKE the pattern."""
        columns = column_list(self.spark, {name: self.table(name) for name in self.names()})
        return columns.where(F.col("table_name").like(name_pattern))
