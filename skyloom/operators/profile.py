"""Facts about tables, computed by aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_profile(df: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """One row per column: its type, the rows, the NULLs and, if wanted, the approximate
    number of distinct values. All columns are counted in one pass with map-side aggregates."""
    counts = [F.count("*").alias("rows")]
    for i, name in enumerate(df.columns):
        column = F.col(_quoted(name))
        counts.append(F.count_if(column.isNull()).alias(f"nulls_{i}"))
        if approx_distinct:
            counts.append(F.approx_count_distinct(column).alias(f"distinct_{i}"))
    entries = []
    for i, field in enumerate(df.schema.fields):
        entry = [
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col("rows"),
            F.col(f"nulls_{i}").alias("nulls"),
        ]
        if approx_distinct:
            entry.append(F.col(f"distinct_{i}").alias("approx_distinct"))
        entries.append(F.struct(*entry))
    return df.agg(*counts).select(F.inline(F.array(*entries)))


def column_sketches(df: DataFrame) -> DataFrame:
    """One row per column that can be stored and merged: its type, rows and NULLs, a sketch of its
    distinct values and, for numbers, one of its quantiles.

    A table that grows by loads needs one such small table a load; ``merged_profile`` gives the profile
    of any of them together without reading the rows again. One pass, with map-side aggregates.
    """
    counts, entries = [F.count("*").alias("rows")], []
    for i, field in enumerate(df.schema.fields):
        column, kind = F.col(_quoted(field.name)), field.dataType
        counts.append(F.count_if(column.isNull()).alias(f"nulls_{i}"))
        counts.append(F.hll_sketch_agg(_sketched(column, kind)).alias(f"distinct_{i}"))
        quantiles = F.lit(None).cast("binary")
        if isinstance(kind, T.NumericType):
            number = column.cast("double")
            counts.append(F.kll_sketch_agg_double(F.when(~F.isnan(number), number)).alias(f"numbers_{i}"))
            quantiles = F.col(f"numbers_{i}")
        entries.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(kind.simpleString()).alias("data_type"),
                F.col("rows"),
                F.col(f"nulls_{i}").alias("nulls"),
                F.col(f"distinct_{i}").alias("distinct_sketch"),
                quantiles.alias("quantile_sketch"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*entries)))


def _sketched(column: Column, kind: T.DataType) -> Column:
    """A column as the distinct sketch takes it; values that are equal stay equal."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("bigint")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return column
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (column.cast("double") + 0.0).cast("string")  # one zero
    return F.to_json(F.struct(column)) if _nested(kind) else column.cast("string")


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def merged_profile(
    sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """The profile of all tables whose ``column_sketches`` these are, one row per column name and type.

    Rows and NULLs are exact; a table without a column adds nothing to it. ``approx_distinct`` has a
    relative standard error of 1.6 %, the ranks of ``quantiles`` (an array, NULL for columns without
    numbers) one of about 1.3 %.
    """
    ranks = F.array(*(F.lit(float(q)) for q in quantiles))
    numbers = F.col("numbers")
    return (
        sketches.groupBy("column_name", "data_type")
        .agg(
            F.min("position").alias("position"),
            F.sum("rows").alias("rows"),
            F.sum("nulls").alias("nulls"),
            F.hll_union_agg("distinct_sketch").alias("distinct"),
            F.kll_merge_agg_double("quantile_sketch").alias("numbers"),
            F.count("quantile_sketch").alias("parts"),
        )
        .select(
            "position", "column_name", "data_type", "rows", "nulls",
            F.hll_sketch_estimate("distinct").alias("approx_distinct"),
            F.when(
                (F.col("parts") > 0) & (F.kll_sketch_get_n_double(numbers) > 0),
                F.kll_sketch_get_quantile_double(numbers, ranks),
            ).alias("quantiles"),
        )
    )


def table_profile(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name, number of columns and number of rows."""
    profiles = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("columns"), "rows"
        )
        for name, df in tables.items()
    ]
    if not profiles:
        return spark.createDataFrame([], "table_name string, columns int, rows bigint")
    return reduce(DataFrame.unionByName, profiles)


def column_list(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column, from the schemas alone."""
    rows = [
        (name, i, field.name, field.dataType.simpleString(), field.metadata.get("unit"))
        for name, df in tables.items()
        for i, field in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, unit string"
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
