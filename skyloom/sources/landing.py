"""Readers for landed service responses: JSON, CSV, TSV and VOTable files.

Every reader takes a file, a directory or a list of them and runs as a distributed scan. Files
whose records may span lines (``whole_file``, ``multi_line``, XML) cannot be cut within a
record, so large results should be landed as many files or as one response per line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
REASON = "_reject_reason"
REJECTED = "_rejected_text"

#: The elements of a body with all their keys.
KEYS = "array<map<string,variant>>"

Paths = str | list[str]


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


# JSON


def read_json(
    spark: SparkSession,
    path: Paths,
    schema: str | T.StructType,
    whole_file: bool = False,
    rest: str | None = None,
) -> DataFrame:
    """Rows of JSON responses; a response that cannot be read fails the job.

    A line holds an array of objects or one object. With ``whole_file`` a file holds one array
    that may be spread over lines. See ``read_bodies`` for input that may contain errors.

    Keys that the schema does not name are left out, or gathered in a VARIANT column named ``rest``
    as ``parse_bodies`` does, which also reads numbers in quotes as numbers.
    """
    if rest is None:
        reader = spark.read.schema(_schema(schema)).option("mode", "FAILFAST")
        return reader.option("multiLine", whole_file).json(path)
    text = F.trim("body")
    listed = F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    bodies = read_bodies(spark, path, whole_file).where(text != "").select(listed.alias("body"))
    parsed = parse_bodies(bodies, schema, rest=rest)
    message = F.concat_ws(": ", F.lit("cannot be read"), REASON, F.substring(REJECTED, 1, 200))
    good = F.when(F.col(REASON).isNotNull(), F.raise_error(message)).otherwise(True)
    return parsed.where(good).drop(REASON, REJECTED)


def read_bodies(spark: SparkSession, path: Paths, whole_file: bool = False) -> DataFrame:
    """Response bodies as text, one per line or one per file, in a column ``body``."""
    return spark.read.text(path, wholetext=whole_file).withColumnRenamed("value", "body")


def parse_bodies(
    df: DataFrame, schema: str | T.StructType, body: str = "body", rest: str | None = None
) -> DataFrame:
    """Rows of JSON array bodies, with everything that could not be used marked and kept.

    Good rows have the columns of the schema and no ``_reject_reason``. A body that is not a
    JSON array of objects gives one row with its text and the reason ``service_error``,
    ``not_json`` or ``not_a_list``; an element that is null or has a cell that does not fit its
    type gives one row with the element and the reason ``bad_value``. An empty array gives no
    row. Other columns of the input are carried along.

    With ``rest`` every key that the schema does not name is kept with its value, nested or not,
    in one VARIANT column of that name, NULL where there is none; of a key that is there twice the
    last value counts. ``variant_get(rest, '$.key', 'type')`` reads one of them. The body is parsed
    twice then. The text of a rejected element has those keys too.
    """
    fields = _schema(schema).fields
    # Cells are read as text first: a typed reader would turn a bad cell into a silent NULL.
    texts = T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in fields]))
    text = F.trim(F.col(body))
    element = F.from_json(F.col(body), texts)
    other = [name for name in df.columns if name != body]
    elements = df.select(
        *other,
        F.coalesce(F.col(body), F.lit("")).alias("_body"),
        F.when(text.startswith("["), element).alias("_elements"),
        *([F.from_json(F.col(body), KEYS).alias("_keys")] if rest else []),
    )
    # Not an array: one row without an element. An empty array: no row.
    opened = F.coalesce(F.col("_elements"), F.array(F.lit(None).cast(texts.elementType)))
    if rest:
        keys = F.coalesce(F.col("_keys"), F.array().cast(KEYS))
        opened = F.arrays_zip(opened.alias("_element"), keys.alias("_keys"))
    bodies = F.when(F.col("_elements").isNull(), F.col("_body")).alias("_body")
    if rest:
        opened = elements.select(*other, F.explode(opened).alias("_both"), bodies)
        opened = opened.select(*other, "_both._element", "_both._keys", "_body")
    else:
        opened = elements.select(*other, F.explode(opened).alias("_element"), bodies)
    bad_body = F.col("_body").isNotNull()
    bad_value = F.col("_element").isNull()
    values: list[Column] = []
    for field in fields:
        cell = F.col("_element").getField(field.name)
        value = cell.try_cast(field.dataType)
        bad_value = bad_value | (cell.isNotNull() & value.isNull())
        values.append(value.alias(field.name))
    valid_json = F.get_json_object(F.col("_body"), "$").isNotNull()
    reason = (
        F.when(bad_body & valid_json, "not_a_list")
        .when(bad_body & F.col("_body").rlike("ERROR|VOTABLE"), "service_error")
        .when(bad_body, "not_json")
        .when(bad_value, "bad_value")
    )
    element_text = F.coalesce(F.to_json("_element"), F.lit("null"))
    if rest:
        keys = _last_of_each(F.col("_keys"))
        element_text = F.coalesce(F.to_json(F.to_variant_object(keys)), element_text)
        unnamed = F.map_filter(keys, lambda key, _: ~key.isin([field.name for field in fields]))
        kept = ~bad_body & ~bad_value & (F.size(unnamed) > 0)
        values.append(F.when(kept, F.to_variant_object(unnamed)).alias(rest))
    rejected = F.when(bad_body, F.col("_body")).when(bad_value, element_text)
    return opened.select(*other, *values, reason.alias(REASON), rejected.alias(REJECTED))


def _last_of_each(keys: Column) -> Column:
    """A map in which every key is there once, with its last value."""
    once = F.array_distinct(F.map_keys(keys))

    def last(key: Column) -> Column:
        entries = F.filter(F.map_entries(keys), lambda entry: entry["key"] == key)
        return F.element_at(entries, -1)["value"]

    single = F.size(once) == F.size(keys)
    return F.when(single, keys).otherwise(F.map_from_arrays(once, F.transform(once, last)))


def accepted(parsed: DataFrame) -> DataFrame:
    """The good rows of ``parse_bodies``."""
    return parsed.where(F.col(REASON).isNull()).drop(REASON, REJECTED)


def rejected(parsed: DataFrame) -> DataFrame:
    """The reasons and texts of what ``parse_bodies`` could not use."""
    return parsed.where(F.col(REASON).isNotNull())


def require_accepted(parsed: DataFrame) -> DataFrame:
    """The good rows; an error if there are rejected ones only, so that a failed download does
    not replace a table by nothing."""
    good = accepted(parsed)
    # One row is looked for: usually the first task has it and nothing else is read.
    if good.isEmpty() and (bad := rejected(parsed).count()):
        raise ValueError(f"no usable response: {bad} rejected")
    return good


# Delimited text


def read_csv(
    spark: SparkSession,
    path: Paths,
    columns: Sequence[str] | None = None,
    sep: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text with a header, every column as text; empty cells are NULL.

    The names are taken from the header of a file unless they are given; every file must have
    them in the same order. Missing cells at the end of a line are NULL too. Lines with too few
    or too many cells are kept in ``_corrupt_record``, so no surplus cell is lost.
    ``multi_line`` is needed only where quoted cells contain line breaks; it stops large files
    from being split.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", False)
    )
    names = reader.csv(path).columns if columns is None else columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return reader.schema(schema.add(CORRUPT, T.StringType())).csv(path)


def read_tsv(
    spark: SparkSession,
    path: Paths,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """As ``read_csv``, with tabs between the cells."""
    return read_csv(spark, path, columns, sep="\t", multi_line=multi_line)


# VOTable


def read_votable_rows(spark: SparkSession, path: Paths, columns: Sequence[str]) -> DataFrame:
    """Table rows of VOTable files as text columns, by position; empty cells are NULL."""
    cells = (
        spark.read.format("xml")
        .option("rowTag", "TR")
        .option("ignoreNamespace", True)
        .option("mode", "FAILFAST")
        .schema("TD array<string>")
        .load(path)
    )
    td = F.col("TD")
    values = [F.nullif(F.get(td, F.lit(i)), F.lit("")) for i in range(len(columns))]
    return cells.select(*(value.alias(name) for value, name in zip(values, columns)))


def votable_fields(spark: SparkSession, path: Paths) -> DataFrame:
    """Name, datatype, unit and description of every FIELD; absent facts are empty text."""
    facts = (
        spark.read.format("xml")
        .option("rowTag", "FIELD")
        .option("ignoreNamespace", True)
        .schema("_name string, _datatype string, _unit string, DESCRIPTION string")
        .load(path)
    )
    source = {
        "name": "_name",
        "datatype": "_datatype",
        "unit": "_unit",
        "description": "DESCRIPTION",
    }
    return facts.select(
        *(F.coalesce(F.trim(F.col(old)), F.lit("")).alias(new) for new, old in source.items())
    )
