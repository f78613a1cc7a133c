"""Cleaning rules for whole tables.

The rules work on DataFrames with one type per column. Where a cell does not fit the type of
its column, its text is kept in ``<column>_unparsed``, so nothing is lost.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyloom.functions import cells
from skyloom.vocab import COLUMN_TYPES, COORDINATE_COLUMNS, METHOD_SPELLINGS, PLANET_UNITS

# A mapping with more entries than this becomes a join instead of a literal.
LITERAL_ENTRIES = 500
# A joined mapping whose keys and values take up to this many bytes is broadcast.
BROADCAST_BYTES = 16 * 1024 * 1024
# What an entry takes in a hash table besides its text.
ENTRY_BYTES = 64


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _col(name: str) -> Column:
    return F.col(_quoted(name))


def _string_columns(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    wanted = None if columns is None else set(columns)
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.StringType) and (wanted is None or field.name in wanted)
    ]


def _replace(
    df: DataFrame, changed: Mapping[str, Column], metadata: Mapping[str, dict] | None = None
) -> DataFrame:
    """The table with some columns computed anew, in their places and with their metadata."""
    if not changed:
        return df
    notes = {name: df.schema[name].metadata for name in changed if name in df.columns}
    df = df.withColumns(dict(changed))
    for name, note in {**notes, **(metadata or {})}.items():
        if note:
            df = df.withMetadata(name, note)
    return df


# Names


def clean_name(name: str) -> str:
    """Lower case, every run of other characters than letters and digits as one ``_``."""
    return re.sub(r"[\W_]+", "_", name.lower()).strip("_")


def normalize_names(df: DataFrame) -> DataFrame:
    """Cleans the column names. Two columns with the same clean name are an error."""
    names = [clean_name(name) for name in df.columns]
    clashes = sorted(name for name, count in Counter(names).items() if count > 1)
    if clashes:
        raise ValueError(f"columns with the same normalised name: {', '.join(clashes)}")
    return df.toDF(*names)


# Null markers and numbers


def standardize_nulls(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NULL instead of null markers in text columns."""
    names = _string_columns(df, columns)
    return _replace(df, {name: cells.nulls_to_null(_col(name)) for name in names})


def numeric_types(df: DataFrame, columns: Iterable[str] | None = None) -> dict[str, str]:
    """The type that holds every cell of each text column exactly: bigint, double, a decimal or string.

    One aggregate over the columns, combined before its shuffle, whose result is a single row.
    Columns of numbers that neither bigint nor double holds to the last digit are read once more
    for the digits they need (``cells.exact_type``). A column without any value stays text.
    """
    names = _string_columns(df, columns)
    if not names:
        return {}
    # A step of its own, so that no expression is worked out twice in a row.
    texts = df.select(*(cells.strip(_col(name)).alias(f"text_{i}") for i, name in enumerate(names)))
    kinds = [F.bit_or(cells.number_kind(F.col(name))).alias(name) for name in texts.columns]
    bits = texts.agg(*kinds).first()
    types = dict(zip(names, map(cells.exact_type, bits)))
    long = [
        i for i, found in enumerate(bits)
        if found and found & cells.SUSPECT and types[names[i]] in ("double", DIGITS_UNKNOWN)
    ]
    if long:
        for i, found in zip(long, _digits_needed(texts.select(*(f"text_{i}" for i in long)))):
            types[names[i]] = cells.exact_type(bits[i] | found[0], *found[1:])
    return types


#: What ``exact_type`` says of a column of long numbers before their digits are known.
DIGITS_UNKNOWN = cells.exact_type(cells.LONG)


def _digits_needed(texts: DataFrame) -> list[tuple[int, int, int]]:
    """For each column of numbers ``INEXACT`` or 0, and the most digits before and after the point."""
    names = texts.columns
    sides = texts.select(
        *names, *(F.col(name).try_cast("double").cast("string").alias(f"held_{name}") for name in names)
    )
    both = sides.columns
    for step, inputs in ((cells.number_parts, 1), (cells.number_digits, 3)):
        columns = []
        for name in both:
            read = [F.col(name)] if inputs == 1 else [F.col(f"{name}_{k}") for k in range(inputs)]
            columns += [part.alias(f"{name}_{k}") for k, part in enumerate(step(*read))]
        sides = sides.select(*columns)
    found = []
    for name in names:
        digits, last = F.col(f"{name}_0"), F.col(f"{name}_1")
        held = (digits == F.col(f"held_{name}_0")) & (last == F.col(f"held_{name}_1"))
        found += [
            F.max(F.when(~held, cells.INEXACT).otherwise(0)),
            F.max(F.greatest(F.length(digits) + last, F.lit(0))),
            F.max(F.greatest(-last, F.lit(0))),
        ]
    row = sides.agg(*(most.alias(f"most_{i}") for i, most in enumerate(found))).first()
    return [tuple(row[i : i + 3]) for i in range(0, len(row), 3)]


def _converter(kind: str, proven: bool = False) -> Callable[[Column], Column] | None:
    """How text becomes a type; None for types that text is left for.

    ``proven`` types are known to hold every cell of their column.
    """
    if kind.startswith("decimal"):
        if proven:
            return lambda cell: cells.strip(cell).try_cast(kind)
        return lambda cell: cells.to_decimal(cell, kind)
    return {"bigint": cells.to_bigint, "double": cells.to_double}.get(kind)


def convert_numeric(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Text columns that hold numbers only become BIGINT, DOUBLE or DECIMAL, whichever keeps every
    digit of every cell; columns that none of them holds stay text.

    ``types`` names the result type of columns that are known beforehand, which saves reading
    them for it; their cells that do not fit are kept in ``<column>_unparsed``.
    """
    names = _string_columns(df, columns)
    known = {name: kind for name, kind in (types or {}).items() if name in names}
    found = numeric_types(df, [name for name in names if name not in known])
    changed = {
        name: _whole(name, convert(_col(name)))
        for name, kind in found.items()
        if (convert := _converter(kind, proven=True))
    }
    df = _replace(df, changed)
    for name, kind in known.items():
        if convert := _converter(kind):
            df = _split(df, name, convert(_col(name)))
    return df


def _whole(name: str, value: Column) -> Column:
    """A converted column; fails if the rows have changed since their types were found."""
    message = F.concat(F.lit(f"column {name} has a new kind of value: "), _col(name))
    return F.when(value.isNull() & _col(name).isNotNull(), F.raise_error(message)).otherwise(value)


def _split(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Replaces a text column by a converted one; the text that did not fit is added."""
    unparsed = F.when(value.isNull(), _col(name))
    return _replace(df, {name: value, f"{name}_unparsed": unparsed})


def _as_double(df: DataFrame, name: str, convert: Callable[[Column], Column]) -> DataFrame:
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return _split(df, name, convert(_col(name)))
    if isinstance(kind, T.NumericType):
        return _replace(df, {name: _col(name).cast("double")})
    return df


# Units, dates, categories, coordinates


def convert_units(
    df: DataFrame, column: str, from_unit: str, to_unit: str, factor: float
) -> DataFrame:
    """Multiplies a numeric column; the new unit is noted in the column's metadata.

    A text column is read as numbers first. Other types and missing columns are left alone.
    """
    if column not in df.columns:
        return df
    metadata = {**df.schema[column].metadata, "unit": to_unit, "unit_before": from_unit}
    if isinstance(df.schema[column].dataType, T.StringType):
        df = _as_double(df, column, cells.to_double)
    if not isinstance(df.schema[column].dataType, T.NumericType):
        return df
    return _replace(df, {column: _col(column) * float(factor)}, {column: metadata})


def parse_dates(df: DataFrame, column: str, fmt: str | None = None) -> DataFrame:
    """Turns a text column into TIMESTAMP_NTZ, by a given layout or the first that fits.

    The layout may be a Spark pattern or have ``%`` directives. Columns of other types, such as
    whole years, are left alone.
    """
    if column not in _string_columns(df):
        return df
    text = F.when(_col(column) != "", _col(column))
    df = _replace(df, {column: text})
    return _split(df, column, cells.parse_date(_col(column), fmt))


def map_categories(df: DataFrame, column: str, mapping: Mapping[Any, Any]) -> DataFrame:
    """Replaces values by a mapping; text is looked up without regard to case, the first of
    several matching keys wins, and other values are kept. A value mapped to None becomes NULL.

    The column stays text if it is text. A long mapping is joined, not written into the plan.
    """
    if column not in df.columns or not mapping:
        return df
    if isinstance(df.schema[column].dataType, T.StringType):
        texts = {k: None if v is None else str(v) for k, v in mapping.items() if isinstance(k, str)}
        if len(texts) <= LITERAL_ENTRIES:
            return _replace(df, {column: cells.map_text(_col(column), texts)})
        return _map_by_join(df, column, texts)
    kind = df.schema[column].dataType
    numbers = {k: v for k, v in mapping.items() if not isinstance(k, str)}
    if not numbers:
        return df
    result = "string" if any(isinstance(v, str) for v in numbers.values()) else kind.simpleString()
    value = F.lit(None)
    for key, mapped in numbers.items():
        value = F.when(_col(column) == F.lit(key), F.lit(mapped).cast(result)).otherwise(value)
    known = _col(column).isin(*numbers)
    return _replace(df, {column: F.when(known, value).otherwise(_col(column).cast(result))})


def _map_by_join(df: DataFrame, column: str, texts: Mapping[str, str | None]) -> DataFrame:
    first: dict[str, str | None] = {}
    for key, value in texts.items():
        first.setdefault(key.lower(), value)
    entries = df.sparkSession.createDataFrame(
        pa.table({"_key": pa.array(first, pa.string()), "_value": pa.array(first.values(), pa.string())})
    )
    size = sum(ENTRY_BYTES + len(f"{key}{value or ''}".encode()) for key, value in first.items())
    if size <= BROADCAST_BYTES:
        entries = F.broadcast(entries)
    joined = df.withColumn("_key", F.lower(_col(column))).join(
        entries.withColumn("_known", F.lit(True)), "_key", "left"
    )
    value = F.when(F.col("_known"), F.col("_value")).otherwise(_col(column))
    return joined.withColumn(column, value).select([*map(_quoted, df.columns)])


def numeric_coordinates(
    df: DataFrame, columns: Iterable[str] = COORDINATE_COLUMNS
) -> DataFrame:
    """Coordinate columns as DOUBLE."""
    for name in columns:
        if name in df.columns:
            df = _as_double(df, name, cells.coordinate_to_double)
    return df


# Rules


@dataclass(frozen=True)
class Rule:
    """A change of one column, or of every column with ``*``.

    ``apply`` and ``condition`` map a Column to a Column; cells for which the condition does
    not hold are kept. A ``*`` rule can be limited to column types by their simple names.
    """

    column: str
    apply: Callable[[Column], Column]
    condition: Callable[[Column], Column] | None = None
    description: str = ""
    types: tuple[str, ...] = ()
    returns: str | None = None  # set for rules that run a Python function


def python_rule(
    column: str,
    function: Callable[[Any], Any],
    returns: str,
    condition: Callable[[Any], bool] | None = None,
    description: str = "",
) -> Rule:
    """A rule that runs a Python function on cells, in Arrow batches of
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows.

    Where the function fails, the cell is kept and the message goes to ``_rule_errors``; where
    the condition does not hold, it is kept too. What ``returns`` cannot hold of the kept cells
    stays as text in ``<column>_unparsed``. An error in the condition fails the job.
    """
    value_type = T.DataType.fromDDL(returns)
    schema = T.StructType().add("value", value_type).add("error", "string").add("kept", "boolean")
    arrow_schema = to_arrow_schema(schema)

    def run(batch: pa.Array) -> pa.Array:
        values, errors, kept = [], [], []
        for cell in batch.to_pylist():
            keep, value, error = True, None, None
            if condition is None or condition(cell):
                try:
                    value, keep = function(cell), False
                except Exception as failure:  # noqa: BLE001 - any failure keeps the cell
                    error = f"{type(failure).__name__}: {failure}"
            values.append(value)
            errors.append(error)
            kept.append(keep)
        columns = [values, errors, kept]
        arrays = [pa.array(column, field.type) for column, field in zip(columns, arrow_schema)]
        return pa.StructArray.from_arrays(arrays, fields=list(arrow_schema))

    return Rule(column, F.arrow_udf(run, schema), description=description, returns=returns)


def batch_rule(
    column: str,
    function: Callable[[pa.Array], Any],
    returns: str,
    condition: Callable[[pa.Array], Any] | None = None,
    description: str = "",
) -> Rule:
    """A rule whose Python function gets an Arrow array of cells and returns as many values, as an
    array, a pandas Series, a numpy array or a list.

    As with ``python_rule`` no cell is lost: a batch on which the function fails, or whose result does
    not fit ``returns``, is halved until the bad cells stand alone; these are kept, with the message in
    ``_rule_errors``, and all others get their values. So a cell's value must not depend on the
    other cells of its batch. ``condition`` gives true for the cells that the function gets; an
    error in it fails the job.
    """
    value_type = T.DataType.fromDDL(returns)
    schema = T.StructType().add("value", value_type).add("error", "string").add("kept", "boolean")
    arrow_schema = to_arrow_schema(schema)
    kind = arrow_schema.field("value").type

    def attempt(cells_of: pa.Array) -> list[tuple[pa.Array, str | None]]:
        """Values of consecutive cells, with the message for one cell that has none."""
        if not len(cells_of):
            return []
        try:
            values = function(cells_of)
            if isinstance(values, pa.ChunkedArray):
                values = values.combine_chunks()
            values = values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)
            if len(values) != len(cells_of):
                raise ValueError(f"{len(values)} values for {len(cells_of)} cells")
            return [(values, None)]
        except Exception as failure:  # noqa: BLE001 - any failure keeps the cell
            if len(cells_of) == 1:
                return [(pa.nulls(1, kind), f"{type(failure).__name__}: {failure}")]
        half = len(cells_of) // 2
        return attempt(cells_of[:half]) + attempt(cells_of[half:])

    def run(batch: pa.Array) -> pa.Array:
        chosen = np.ones(len(batch), bool)
        if condition is not None:
            chosen = np.array([bool(c) for c in pa.array(condition(batch)).to_pylist()], bool)
        done = attempt(batch.filter(pa.array(chosen)))
        errors = [message for values, message in done for _ in range(len(values))]
        values = pa.concat_arrays([values for values, _ in done]) if done else pa.nulls(0, kind)
        place = np.cumsum(chosen) - 1
        place = pa.array(place, mask=~chosen)
        errors = pa.array(errors, pa.string()).take(place)
        kept = pa.compute.or_(pa.array(~chosen), errors.is_valid())
        return pa.StructArray.from_arrays([values.take(place), errors, kept], fields=list(arrow_schema))

    return Rule(column, F.arrow_udf(run, schema), description=description, returns=returns)


ERRORS = "_rule_errors"


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Applies rules in the given order, each in a step of its own, so that the plan grows with
    the number of rules. Spark merges the steps as far as no expression is worked out twice.

    With Python rules the result has a ``_rule_errors`` column: an array of messages, empty if
    all went well. Messages of an earlier pass stay in front, and ``*`` rules pass them over.
    """
    types = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    columns = [name for name in df.columns if name != ERRORS]
    if any(rule.returns for rule in rules) and ERRORS not in df.columns:
        df = df.withColumn(ERRORS, F.array().cast("array<string>"))
    for rule in rules:
        touched = [
            name
            for name in columns
            if rule.column in ("*", name) and (not rule.types or types[name] in rule.types)
        ]
        if rule.returns:
            for name in touched:
                df = _apply_python(df, name, rule)
        else:
            df = _replace(df, {name: _ruled(name, rule) for name in touched})
    return df


def _ruled(name: str, rule: Rule) -> Column:
    after = rule.apply(_col(name))
    if rule.condition is None:
        return after
    return F.when(rule.condition(_col(name)), after).otherwise(_col(name))


def _apply_python(df: DataFrame, name: str, rule: Rule) -> DataFrame:
    label = f"{name}: " if not rule.description else f"{name} ({rule.description}): "
    before, done = _col(name), F.col("_ruled")
    held = before.try_cast(rule.returns)
    lost = done["kept"] & before.isNotNull() & held.isNull()
    message = F.concat(F.lit(label), done["error"])
    changed = {
        name: F.when(done["kept"], held).otherwise(done["value"]),
        ERRORS: F.when(
            done["error"].isNotNull(), F.array_append(F.col(ERRORS), message)
        ).otherwise(F.col(ERRORS)),
    }
    if df.schema[name].dataType != T.DataType.fromDDL(rule.returns):
        unparsed = f"{name}_unparsed"
        text = F.when(lost, before.cast("string"))
        if unparsed in df.columns:
            text = F.coalesce(text, _col(unparsed))
        changed[unparsed] = text
    return _replace(df.withColumn("_ruled", rule.apply(before)), changed).drop("_ruled")


def clean_table(
    df: DataFrame,
    rules: Sequence[Rule] = (),
    names: bool = True,
    nulls: bool = True,
    numbers: bool = True,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """The default cleaning: names, null markers and numbers, then further rules.

    ``types`` gives the type (bigint, double, decimal(p,s), string) of text columns that are known,
    which saves the pass that finds it out.
    """
    if names:
        df = normalize_names(df)
    if nulls:
        df = standardize_nulls(df)
    if numbers:
        df = convert_numeric(df, types=types)
    return apply_rules(df, rules)


def clean_planets(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """The default cleaning, then the rules for planet tables: masses and radii in units of
    Jupiter, standard method names, numeric coordinates. Missing columns are passed over.

    ``types`` gives the types of text columns that are known; ``clean_known_planets`` has them for
    the columns of the named datasets.

    ``disc_year`` is a whole year and none of the date layouts, so it stays a number.
    """
    df = clean_table(df, types=types)
    for unit in PLANET_UNITS:
        df = convert_units(df, *unit)
    df = map_categories(df, "discoverymethod", METHOD_SPELLINGS)
    df = parse_dates(df, "disc_year")
    return numeric_coordinates(df)


def clean_known_planets(df: DataFrame) -> DataFrame:
    """``clean_planets`` with the declared types of the named datasets' columns: their cells need
    not be read to find a type, and the schema does not depend on them."""
    return clean_planets(df, types=COLUMN_TYPES)
