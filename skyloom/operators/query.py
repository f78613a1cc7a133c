"""One-table queries over a catalogue: the clauses are collected, Spark SQL runs them."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import TYPE_CHECKING, Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skyloom.functions import sky
from skyloom.operators import limits

if TYPE_CHECKING:
    from skyloom.sources.catalog import Catalog

_UNORDERED_TYPES = (T.MapType, T.ArrayType, T.StructType, T.VariantType)


def all_of(*conditions: str | None) -> str:
    """The conditions that are not blank, joined by AND; ``""`` if there are none."""
    kept = (condition.strip() for condition in conditions if condition)
    return " AND ".join(condition for condition in kept if condition)


def open_range(column: str, lo: Any = None, hi: Any = None) -> str:
    """``lo <= column <= hi``, where either end may be left out; the ends become SQL literals."""
    return all_of(
        None if lo is None else f"{column} >= {literal(lo)}",
        None if hi is None else f"{column} <= {literal(hi)}",
    )


def literal(value: Any) -> str:
    """A number, text, date, time or truth value as a SQL literal."""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    if isinstance(value, dt.datetime):
        kind = "TIMESTAMP" if value.tzinfo else "TIMESTAMP_NTZ"
        return f"{kind} '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float) and math.isfinite(value):
        return repr(value) if "e" not in repr(value) else f"{value!r}D"
    raise ValueError(f"no SQL literal for {value!r}")


@dataclass(frozen=True)
class CatalogQuery:
    """A query in progress. Every method returns a new query, so a base can be shared.

    Conditions are SQL text, and values given as arguments are bound, not pasted. ``where``
    starts the condition list anew; ``and_where``, ``or_where`` and the named filters extend
    it. The list is read as one SQL condition, in which AND binds tighter than OR:
    ``where(a).or_where(b).and_where(c)`` means ``a OR (b AND c)``.
    """

    catalog: Catalog
    items: tuple[str, ...] = ()
    unique: bool = False
    table: str | None = None
    condition: str = ""
    bound: tuple[Any, ...] = ()
    keys: tuple[str, ...] = ()
    group_condition: str = ""
    order: tuple[tuple[str, bool], ...] = ()
    top: int | None = None

    # Projection

    def select(self, columns: str | Sequence[str]) -> CatalogQuery:
        """Columns or SQL expressions; replaces what was selected before."""
        return replace(self, items=_as_tuple(columns), unique=False)

    def distinct(self, columns: str | Sequence[str]) -> CatalogQuery:
        """Distinct combinations of all the columns."""
        return replace(self, items=_as_tuple(columns), unique=True)

    def count(self, column: str = "*") -> CatalogQuery:
        """Number of rows, or of rows with a value in ``column``, as ``count``."""
        return self.select(f"count({column}) AS count")

    def from_table(self, table: str) -> CatalogQuery:
        return replace(self, table=table)

    # Conditions

    def where(self, condition: str) -> CatalogQuery:
        """Sets the condition; earlier ones are dropped."""
        return replace(self, condition=condition, bound=())

    def and_where(self, condition: str) -> CatalogQuery:
        return self._extend("AND", condition)

    def or_where(self, condition: str) -> CatalogQuery:
        return self._extend("OR", condition)

    def _extend(self, connector: str, condition: str, *values: Any) -> CatalogQuery:
        if self.condition:
            condition = f"{self.condition} {connector} {condition}"
        return replace(self, condition=condition, bound=self.bound + values)

    def _marks(self, count: int) -> list[str]:
        """Parameter markers for the next bound values."""
        return [f":v{len(self.bound) + i}" for i in range(count)]

    def where_between(self, column: str, lo: Any, hi: Any) -> CatalogQuery:
        """Both ends belong to the range."""
        return self._extend("AND", "{} BETWEEN {} AND {}".format(column, *self._marks(2)), lo, hi)

    def where_in(self, column: str, values: Iterable[Any]) -> CatalogQuery:
        """Rows with one of the values; an empty list keeps no row."""
        values = tuple(values)
        if not values:
            return self._extend("AND", "false")
        marks = ", ".join(self._marks(len(values)))
        return self._extend("AND", f"{column} IN ({marks})", *values)

    def where_equal(self, column: str, value: Any) -> CatalogQuery:
        return self._extend("AND", f"{column} = {self._marks(1)[0]}", value)

    def where_at_least(self, column: str, value: Any) -> CatalogQuery:
        return self._extend("AND", f"{column} >= {self._marks(1)[0]}", value)

    def where_at_most(self, column: str, value: Any) -> CatalogQuery:
        return self._extend("AND", f"{column} <= {self._marks(1)[0]}", value)

    def where_below(self, column: str, value: Any) -> CatalogQuery:
        return self._extend("AND", f"{column} < {self._marks(1)[0]}", value)

    def where_like(
        self, column: str, pattern: str, case_insensitive: bool = True
    ) -> CatalogQuery:
        mark = self._marks(1)[0]
        if case_insensitive:
            return self._extend("AND", f"upper({column}) LIKE upper({mark})", pattern)
        return self._extend("AND", f"{column} LIKE {mark}", pattern)

    def where_confirmed(self) -> CatalogQuery:
        return self.where_like("soltype", "%CONF%")

    def where_candidates(self) -> CatalogQuery:
        return self.where_like("soltype", "%CAND%")

    def where_discovery_method(self, method: str) -> CatalogQuery:
        return self.where_equal("discoverymethod", method)

    def where_default_flag(self) -> CatalogQuery:
        return self._extend("AND", "default_flag = 1")

    def where_has_mass(self) -> CatalogQuery:
        return self._extend("AND", "pl_masse > 0")

    def where_has_radius(self) -> CatalogQuery:
        return self._extend("AND", "pl_rade > 0")

    def where_earth_sized(self, max_radius: float = 1.8) -> CatalogQuery:
        return self._extend("AND", f"pl_rade <= {self._marks(1)[0]}", max_radius)

    def where_spatial_circle(
        self, ra: float, dec: float, radius: float, zone_height: float | None = None
    ) -> CatalogQuery:
        """Rows in a circle; ``zone_height`` as in ``skyloom.functions.sky``, by default that of the
        table if it is named already."""
        zone_height = zone_height or self._zone_height()
        return self._extend("AND", sky.circle(ra, dec, radius, zone_height=zone_height))

    def where_spatial_box(
        self,
        ra: float,
        dec: float,
        width: float,
        height: float,
        zone_height: float | None = None,
    ) -> CatalogQuery:
        """Rows in a box around a position; ``zone_height`` as for a circle."""
        zone_height = zone_height or self._zone_height()
        return self._extend("AND", sky.box(ra, dec, width, height, zone_height=zone_height))

    def _zone_height(self) -> float | None:
        return sky.zone_height(self.catalog.table(self.table).columns) if self.table else None

    def where_filters(self, filters: Mapping[str, Any] | None) -> CatalogQuery:
        """ANDs ``column: value`` as equality and ``column: [values]`` as membership."""
        query = self
        for column, value in (filters or {}).items():
            if isinstance(value, (list, tuple)):
                query = query.where_in(column, value)
            else:
                query = query.where_equal(column, value)
        return query

    # Groups, order, size

    def group_by(self, columns: str | Sequence[str]) -> CatalogQuery:
        return replace(self, keys=_as_tuple(columns))

    def having(self, condition: str) -> CatalogQuery:
        """Sets the condition on groups; without keys the whole table is one group."""
        return replace(self, group_condition=condition)

    def order_by(self, column: str | Sequence[str], ascending: bool = True) -> CatalogQuery:
        """Sets the order, NULLs last. In one text with several keys, the direction and the
        NULL rule apply to the last key only; a list applies them to each."""
        return replace(self, order=tuple((key, ascending) for key in _as_tuple(column)))

    def limit(self, count: int | None) -> CatalogQuery:
        """At most ``count`` rows; 0 or None means all."""
        if count and count < 0:
            raise ValueError("the limit must not be negative")
        return replace(self, top=count or None)

    # Result

    def to_df(self) -> DataFrame:
        if not self.items:
            raise ValueError("nothing is selected")
        if not self.table:
            raise ValueError("no table is named")
        source = self.catalog.table(self.table)
        clauses = []
        if self.condition:
            clauses.append(f"WHERE {self.condition}")
        if self.keys:
            clauses.append(f"GROUP BY {', '.join(self.keys)}")
        if self.group_condition:
            clauses.append(f"HAVING {self.group_condition}")
        result = self._run(source, clauses)
        if self.order:
            clauses.append(f"ORDER BY {', '.join(self._sort_keys(result))}")
            result = self._run(source, clauses)
        if not self.top:
            return result
        if self.order or self.top <= limits.GATHERED or not limits.rows_of_one_table(result):
            return result.limit(self.top)
        # The rows bring their places along, so that the limit can be taken where they are stored.
        every = any(item.strip() == "*" or item.strip().endswith(".*") for item in self.items)
        places = () if every else (limits.FILE, limits.ROW)
        placed = replace(self, items=(*self.items, *places))._run(limits.with_places(source), clauses)
        return limits.taken(placed, self.top)

    def _run(self, source: DataFrame, clauses: list[str]) -> DataFrame:
        head = f"SELECT {'DISTINCT ' if self.unique else ''}{', '.join(self.items)}"
        # The table is put in by formatting, so braces in the user's text are doubled.
        head, tail = (text.replace("{", "{{").replace("}", "}}") for text in (head, " ".join(clauses)))
        values = {f"v{i}": value for i, value in enumerate(self.bound)}
        name = self.table.replace("`", "``").replace("{", "{{").replace("}", "}}")
        text = f"{head} FROM {{src}} AS `{name}` {tail}"
        return source.sparkSession.sql(text, args=values, src=source)

    def _sort_keys(self, result: DataFrame) -> list[str]:
        """The order asked for, then what settles ties.

        SQL leaves the order of ties open. A top-k is made repeatable by the other result columns.
        A full sort settles ties by a hash of them, so that its range sampling and comparisons do
        not carry whole rows, and equal rows are spread by the partition they come from: range
        partitioning can then spread rows that share a frequent key.
        """
        keys = [f"{key} {'ASC' if up else 'DESC'} NULLS LAST" for key, up in self.order]
        asked = {key.strip("`").lower() for key, _ in self.order}
        names = [name.lower() for name in result.columns]
        others = [
            f"`{field.name.replace('`', '``')}`"
            for field in result.schema.fields
            if names.count(field.name.lower()) == 1
            and field.name.lower() not in asked
            and not isinstance(field.dataType, _UNORDERED_TYPES)
        ]
        if self.top:
            return keys + [f"{name} NULLS LAST" for name in others]
        if others:
            keys.append(f"xxhash64({', '.join(others)})")
        if not (self.unique or self.keys or self.group_condition):
            keys.append("spark_partition_id()")
        return keys


def _as_tuple(columns: str | Sequence[str]) -> tuple[str, ...]:
    return (columns,) if isinstance(columns, str) else tuple(columns)


def run_spec(catalog: Catalog, spec: Mapping[str, Any]) -> DataFrame:
    """A query from a dict: ``table_name`` and optionally ``columns``, ``filters``, ``limit``
    and ``order_by``."""
    query = (
        CatalogQuery(catalog)
        .select(spec.get("columns") or "*")
        .from_table(spec["table_name"])
        .where_filters(spec.get("filters"))
        .limit(spec.get("limit"))
    )
    if spec.get("order_by"):
        query = query.order_by(spec["order_by"])
    return query.to_df()
