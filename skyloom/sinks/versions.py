"""Tables that are replaced by one small file, so that readers have the old rows or the new ones.

Every write goes to a folder of its own. Which folders make up a dataset stands in numbered files in
``_versions``; the highest number counts. Putting the next one there replaces any number of tables at
once, without renaming or copying what was written, on object stores too.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession

from skyloom.sinks.writers import save_files, store_of

VERSIONS = "_versions"


def _numbered(spark: SparkSession, dataset: str) -> list[int]:
    store, folder = store_of(spark, f"{dataset}/{VERSIONS}")
    if not store.exists(folder):
        return []
    names = (entry.getPath().getName() for entry in store.listStatus(folder))
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _pointer(dataset: str, number: int) -> str:
    return f"{dataset}/{VERSIONS}/{number:012d}.json"


def _read(spark: SparkSession, path: str) -> dict[str, str]:
    store, file = store_of(spark, path)
    stream = store.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def current_tables(spark: SparkSession, dataset: str) -> dict[str, str] | None:
    """The folder of every table as of now; None for a dataset without versions."""
    numbers = _numbered(spark, dataset)
    return _read(spark, _pointer(dataset, numbers[-1])) if numbers else None


def read_version(spark: SparkSession, dataset: str, table: str, file_format: str = "parquet") -> DataFrame:
    """A table as it is now; what is written later does not change what this DataFrame reads."""
    tables = current_tables(spark, dataset) or {}
    if table not in tables:
        raise ValueError(f"{dataset} has no table {table}")
    return spark.read.format(file_format).load(f"{dataset}/{tables[table]}")


@dataclass
class VersionedTarget:
    """Tables of one dataset ``<base>/<dataset>``, replaced together or one by one.

    ``keep`` is the number of versions whose files stay, for readers that still use them; older
    ones go with the next write. One job writes to a dataset at a time: a version that another one
    has put there meanwhile is an error, and nothing is replaced then.
    """

    spark: SparkSession
    base: str
    dataset: str = "catalogue"
    compression: str | None = None
    batch_size: int | None = None
    sky_zone: float | None = None
    keep: int = 2
    observes: ClassVar[bool] = True
    _pending: dict[str, str] | None = field(default=None, repr=False)

    @property
    def folder(self) -> str:
        return f"{self.base.rstrip('/')}/{self.dataset}"

    def location(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def read(self, table: str) -> DataFrame:
        return read_version(self.spark, self.folder, table)

    def write(self, df: DataFrame, table: str) -> None:
        """Writes the rows and puts them in the table's place, or keeps them for the end of
        ``together``. The rows may come from the table itself."""
        place = f"{table}/v-{uuid.uuid4().hex}"
        try:
            save_files(
                df, f"{self.folder}/{place}", "parquet", self.compression, self.batch_size, self.sky_zone
            )
        except BaseException:
            self._delete(place)
            raise
        if self._pending is None:
            self._commit({table: place}, _numbered(self.spark, self.folder))
        else:
            if table in self._pending:
                self._delete(self._pending[table])
            self._pending[table] = place

    @contextmanager
    def together(self) -> Iterator[None]:
        """All tables written in the block are replaced at its end, or none if it fails."""
        if self._pending is not None:
            yield
            return
        seen, self._pending = _numbered(self.spark, self.folder), {}
        try:
            yield
            if self._pending:
                self._commit(self._pending, seen)
        except BaseException:
            for place in (self._pending or {}).values():
                self._delete(place)
            raise
        finally:
            self._pending = None

    def drop(self, table: str) -> None:
        """Takes a table out of the dataset."""
        self._commit({table: None}, _numbered(self.spark, self.folder))

    def _commit(self, changes: Mapping[str, str | None], seen: list[int]) -> None:
        before = _read(self.spark, _pointer(self.folder, seen[-1])) if seen else {}
        tables = {name: place for name, place in {**before, **changes}.items() if place}
        number = (seen[-1] if seen else 0) + 1
        store, file = store_of(self.spark, _pointer(self.folder, number))
        draft = file.suffix(f".draft-{uuid.uuid4().hex[:12]}")
        stream = store.create(draft, False)
        try:
            stream.write(json.dumps(tables, sort_keys=True).encode())
        finally:
            stream.close()
        if _numbered(self.spark, self.folder) != seen or not store.rename(draft, file):
            store.delete(draft, False)
            for place in changes.values():
                if place and self._pending is None:
                    self._delete(place)
            raise RuntimeError(f"{self.folder} was changed by another job")
        self._tidy([*seen, number])

    def _tidy(self, numbers: list[int]) -> None:
        """Deletes versions beyond ``keep`` with the folders that only they name."""
        old, kept = numbers[: -max(self.keep, 1)], numbers[-max(self.keep, 1) :]
        used = {p for n in kept for p in _read(self.spark, _pointer(self.folder, n)).values()}
        for number in old:
            path = _pointer(self.folder, number)
            for place in set(_read(self.spark, path).values()) - used:
                self._delete(place)
            store, file = store_of(self.spark, path)
            store.delete(file, False)

    def _delete(self, place: str) -> None:
        store, folder = store_of(self.spark, f"{self.folder}/{place}")
        store.delete(folder, True)
