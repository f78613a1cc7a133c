"""Load jobs: a named dataset or any query, cleaned and written to a target."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextlib import nullcontext
from dataclasses import dataclass
from typing import Any, NamedTuple, Protocol

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.operators.clean import clean_known_planets, clean_name
from skyloom.operators.limits import counted_limit
from skyloom.operators.query import CatalogQuery
from skyloom.plans import datasets
from skyloom.sources.catalog import Catalog
from skyloom.storage import removed, scratch_path
from skyloom.vocab import COLUMN_TYPES


class Target(Protocol):
    def location(self, table: str) -> str: ...

    def write(self, df: DataFrame, table: str) -> None: ...

    #: Whether Spark reports what it observes in the rows while they are written there.
    observes: bool


class Loaded(NamedTuple):
    """One table written by a load."""

    dataset: str
    table: str
    rows: int
    location: str


@dataclass(frozen=True)
class Loader:
    """Runs load jobs from a catalog into a target; every load replaces its table.

    Limits and conditions see the raw rows; cleaning comes after them. Types of the named datasets'
    columns are declared, so a load is one pass; only text columns of other names are read once more
    to find theirs. ``max_records`` caps the
    named datasets when no limit is given.
    """

    catalog: Catalog
    target: Target
    max_records: int | None = None
    clean: Callable[[DataFrame], DataFrame] | None = clean_known_planets

    def load_exoplanets(
        self,
        confirmed_only: bool = True,
        include_candidates: bool = False,
        limit: int | None = None,
        filters: Mapping[str, Any] | None = None,
    ) -> list[Loaded]:
        """Confirmed planets, candidates or both, one table each."""
        size = limit or self.max_records
        builds = []
        if confirmed_only or not include_candidates:
            builds.append(datasets.confirmed_planets)
        if include_candidates:
            builds.append(datasets.candidate_planets)
        return [
            self._load("exoplanets", build.__name__, build(self.catalog, size, filters), size)
            for build in builds
        ]

    def load_planetary_systems(self, limit: int | None = None) -> list[Loaded]:
        size = limit or self.max_records
        df = datasets.systems_overview(self.catalog, size)
        return [self._load("planetary_systems", "systems_overview", df, settle=True)]

    def load_tess_data(
        self, disposition: str | None = None, limit: int | None = None
    ) -> list[Loaded]:
        size = limit or self.max_records
        df = datasets.tess_candidates(self.catalog, disposition, size)
        return [self._load("tess", "tess_candidates", df, size)]

    def load_kepler_data(
        self, disposition: str | None = None, limit: int | None = None
    ) -> list[Loaded]:
        size = limit or self.max_records
        df = datasets.kepler_objects(self.catalog, disposition, size)
        return [self._load("kepler", "kepler_objects", df, size)]

    def load_microlensing_data(self, limit: int | None = None) -> list[Loaded]:
        size = limit or self.max_records
        df = datasets.microlensing_events(self.catalog, size)
        return [self._load("microlensing", "microlensing_events", df, size)]

    def load_custom_query(
        self,
        query: DataFrame | CatalogQuery | str,
        table: str = "custom_data",
        limit: int | None = None,
    ) -> list[Loaded]:
        """Any DataFrame, catalogue query or SQL text; ``max_records`` does not apply."""
        settle = True
        if isinstance(query, str):
            query = self.catalog.sql(query)
        elif isinstance(query, CatalogQuery):
            settle = bool(limit or query.top or query.unique or query.keys)
            query = query.to_df()
        df = counted_limit(query, limit) if limit else query
        return [self._load("custom", table, df, settle)]

    def load_all_datasets(
        self, include_candidates: bool = False, limit_per_dataset: int | None = None
    ) -> DataFrame:
        """All named datasets; returns dataset, table, rows and location of what was written.

        A target that can replace its tables together does so when all of them are written.
        """
        with getattr(self.target, "together", nullcontext)():
            done = (
                self.load_exoplanets(
                    include_candidates=include_candidates, limit=limit_per_dataset
                )
                + self.load_planetary_systems(limit_per_dataset)
                + self.load_tess_data(limit=limit_per_dataset)
                + self.load_kepler_data(limit=limit_per_dataset)
                + self.load_microlensing_data(limit_per_dataset)
            )
        return self.catalog.spark.createDataFrame(
            done, "dataset string, table string, rows bigint, location string"
        )

    def _load(
        self, dataset: str, table: str, df: DataFrame, settle: int | bool | None = None
    ) -> Loaded:
        staged = None
        if settle and self.clean and _has_open_types(df):
            # Finding types and writing both read the rows. Those of a limit or a random expression
            # could differ from one time to the next, and those of a shuffle would be computed
            # twice. The files are split again when they are read, whatever wrote them.
            staged = scratch_path(df.sparkSession, "staged")
            df.write.parquet(staged)
            df = df.sparkSession.read.schema(df.schema).parquet(staged)
        elif settle:
            # What a small limit has gathered in one task is dealt out again.
            df = df.hint("rebalance")
        try:
            if self.clean:
                df = self.clean(df)
            return Loaded(dataset, table, self._written(df, table), self.target.location(table))
        finally:
            if staged:
                removed(self.catalog.spark, staged)

    def _written(self, df: DataFrame, table: str) -> int:
        """Writes the rows and returns their number, counted on the way where that is reported."""
        if not self.target.observes:
            self.target.write(df, table)
            return df.count()
        observed = Observation()
        self.target.write(df.observe(observed, F.count("*").alias("rows")), table)
        return observed.get.get("rows", 0)


def _has_open_types(df: DataFrame) -> bool:
    """Whether a text column has no declared type."""
    return any(
        isinstance(f.dataType, T.StringType) and clean_name(f.name) not in COLUMN_TYPES
        for f in df.schema.fields
    )
