"""VOTable files as typed tables: what the FIELD elements say decides the columns.

The rows may be text (TABLEDATA) or a stream of bytes in base64 (BINARY, BINARY2).
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyloom.sources.landing import Paths, read_votable_rows

#: The standard's datatypes, with the type of a column, the code by which Python's
#: struct module reads a value, and its bytes.
DATATYPES = {
    "boolean": ("boolean", "c", 1),
    "unsignedByte": ("smallint", "B", 1),
    "short": ("smallint", "h", 2),
    "int": ("int", "i", 4),
    "long": ("bigint", "q", 8),
    "float": ("float", "f", 4),
    "double": ("double", "d", 8),
    "char": ("string", "s", 1),
    "unicodeChar": ("string", "s", 2),
    "floatComplex": ("array<float>", "ff", 8),
    "doubleComplex": ("array<double>", "dd", 16),
}
TEXTS = ("char", "unicodeChar")
#: Rows of a batch that a stream is cut into.
STREAM_ROWS = 4096


@dataclass(frozen=True)
class Field:
    """A FIELD element. ``size`` is the number of values in a cell: None for any number, 1 without
    an ``arraysize``."""

    name: str
    datatype: str
    size: int | None = 1
    array: bool = False
    null: str | None = None
    unit: str = ""
    description: str = ""
    ucd: str = ""

    @property
    def type(self) -> str:
        kind = DATATYPES[self.datatype][0]
        single = self.datatype in TEXTS or not self.array or kind.startswith("array")
        return kind if single else f"array<{kind}>"

    def metadata(self) -> dict[str, str]:
        facts = {"unit": self.unit, "description": self.description, "ucd": self.ucd}
        return {name: text for name, text in facts.items() if text}


def votable_schema(spark: SparkSession, path: Paths) -> list[Field]:
    """The columns of VOTable files, in their order; files with different columns are an error.

    A file's fields are put together in one row; the driver sees two of these rows at most.
    """
    facts = (
        spark.read.format("xml")
        .option("rowTag", "FIELD")
        .option("ignoreNamespace", True)
        .schema(
            "_name string, _ID string, _datatype string, _arraysize string, _unit string, _ucd string,"
            " DESCRIPTION string, VALUES struct<_null: string>"
        )
        .load(path)
        .select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    )
    columns = [
        F.coalesce("_name", "_ID"), F.trim("_datatype"), F.trim("_arraysize"), F.col("VALUES._null"),
        *(F.coalesce(F.trim(F.col(name)), F.lit("")) for name in ("_unit", "DESCRIPTION", "_ucd")),
    ]
    fact = F.struct("at", F.array(*columns).alias("facts"))
    tables = facts.groupBy("file").agg(F.sort_array(F.collect_list(fact)).alias("fields"))
    found = tables.select(F.col("fields.facts").alias("fields")).distinct().take(2)
    if len(found) != 1:
        raise ValueError("the files have different fields" if found else "no fields are declared")
    return [_field(*facts) for facts in found[0]["fields"]]


def _field(name, datatype, arraysize, null, unit, description, ucd) -> Field:
    if datatype not in DATATYPES:
        raise ValueError(f"field {name} has the datatype {datatype}, which is not read")
    size: int | None = 1
    for part in (arraysize or "1").split("x"):
        size = None if size is None or not part.isdigit() else size * int(part)
    return Field(name, datatype, size, bool(arraysize) and size != 1, null, unit, description, ucd)


def read_votable(spark: SparkSession, path: Paths, serialization: str = "tabledata") -> DataFrame:
    """Rows of VOTable files with the types of their FIELD elements; units, descriptions and content
    descriptors stand in the columns' metadata.

    ``serialization`` is ``tabledata``, ``binary`` or ``binary2``. Numbers with an ``arraysize`` are
    arrays, characters are text without what follows a NUL. Empty cells, the ``null`` value that a
    field declares, ``?`` for a boolean and the null flags of ``binary2`` are NULL. A cell that does not
    fit its type fails the job. Text rows are read by the tasks of the XML reader; a stream is decoded
    by one task, so large results should be landed as many files.
    """
    fields = votable_schema(spark, path)
    if serialization == "tabledata":
        names = [f"_{i}" for i in range(len(fields))]
        texts = read_votable_rows(spark, path, names)
        values = [_typed(F.col(name), field) for name, field in zip(names, fields)]
        rows = texts.select(*(v.alias(f.name) for v, f in zip(values, fields)))
    elif serialization in ("binary", "binary2"):
        rows = _streamed(spark, path, fields, serialization)
    else:
        raise ValueError(f"unknown serialization: {serialization}")
    for field in fields:
        if field.metadata():
            rows = rows.withMetadata(field.name, field.metadata())
    return rows


def _typed(text: Column, field: Field) -> Column:
    """A cell's text in the field's type."""
    if field.datatype in TEXTS:
        return text if field.null is None else F.when(text != field.null, text)
    cell = F.trim(F.translate(text, "\t\n\r", "   "))
    cell = F.when((cell != "") & (cell != F.lit(field.null) if field.null is not None else F.lit(True)), cell)
    kind = DATATYPES[field.datatype][0]
    if field.type.startswith("array"):
        parts = F.split(cell, " +")
        values = F.transform(parts, lambda part: _single(part, kind.removeprefix("array<").rstrip(">")))
        wrong = F.exists(F.arrays_zip(parts.alias("p"), values.alias("v")), lambda both: both["v"].isNull() & (both["p"] != "?"))
    else:
        values = _single(cell, kind)
        wrong = values.isNull() & cell.isNotNull() & (cell != "?")
    message = F.concat(F.lit(f"field {field.name} holds no {field.datatype}: "), cell)
    return F.when(wrong, F.raise_error(message)).otherwise(values)


def _single(text: Column, kind: str) -> Column:
    if kind == "boolean":
        return F.when(F.lower(text).isin("t", "true", "1"), True).when(
            F.lower(text).isin("f", "false", "0"), False
        )
    if kind in ("float", "double"):
        text = F.regexp_replace(text, r"^([+-]?)Inf$", "$1Infinity")
    if kind in ("smallint", "int", "bigint"):
        whole = F.conv(F.substring(text, 3, 16), 16, 10)
        text = F.when(text.rlike("^0x[0-9A-Fa-f]+$"), whole).otherwise(text)
    return text.try_cast(kind)


def _streamed(spark: SparkSession, path: Paths, fields: list[Field], serialization: str) -> DataFrame:
    streams = (
        spark.read.format("xml")
        .option("rowTag", serialization.upper())
        .option("ignoreNamespace", True)
        .schema("STREAM struct<_VALUE: string, _encoding: string, _href: string>")
        .load(path)
        .select("STREAM.*")
    )
    schema = T.StructType()
    for field in fields:
        schema = schema.add(field.name, T.DataType.fromDDL(field.type))
    arrow_schema = to_arrow_schema(schema)
    read_row = row_reader(fields, flags=serialization == "binary2")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stream in batch.to_pylist():
                if stream["_href"] or (stream["_encoding"] or "base64") != "base64":
                    raise ValueError("only streams in base64 within the file are read")
                data, at = base64.b64decode(stream["_VALUE"] or ""), 0
                while at < len(data):
                    rows = []
                    while at < len(data) and len(rows) < STREAM_ROWS:
                        row, at = read_row(data, at)
                        rows.append(row)
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow_schema)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

    return streams.mapInArrow(decode, schema)


def row_reader(fields: list[Field], flags: bool) -> Callable[[bytes, int], tuple[list, int]]:
    """Reads the row that begins at a place of a stream; gives its cells and where it ends.

    Values are in network order; a cell of any number of values begins with that number. With
    ``flags`` a bit for each field, from the highest on, says that it is NULL.
    """
    flag_bytes = (len(fields) + 7) // 8 if flags else 0

    def read(data: bytes, at: int) -> tuple[list, int]:
        nulls, at = data[at : at + flag_bytes], at + flag_bytes
        cells = []
        for i, field in enumerate(fields):
            size, (_, code, width) = field.size, DATATYPES[field.datatype]
            if size is None:
                (size,) = struct.unpack_from(">i", data, at)
                at += 4
            end = at + size * width
            if end > len(data):
                raise ValueError(f"the stream ends within the field {field.name}")
            missing = bool(nulls) and nulls[i // 8] >> (7 - i % 8) & 1
            cells.append(None if missing else _cell(data[at:end], field, code, size))
            at = end
        return cells, at

    return read


def _cell(data: bytes, field: Field, code: str, size: int):
    if field.datatype == "char":
        text = data.split(b"\0", 1)[0].decode("utf-8", "replace")
        return text if text and text != field.null else None
    if field.datatype == "unicodeChar":
        text = data.decode("utf-16-be", "replace").split("\0", 1)[0]
        return text if text and text != field.null else None
    values = list(struct.unpack(f">{size * len(code)}{code[0]}", data))
    if field.datatype == "boolean":
        values = [{b"T": True, b"t": True, b"1": True, b"F": False, b"f": False, b"0": False}.get(v) for v in values]
    elif field.null is not None and not field.array and str(values[0]) == field.null:
        return None
    return values if field.type.startswith("array") else values[0]
