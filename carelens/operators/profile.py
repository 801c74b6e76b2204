"""Profiling: counts, schemas and distinct values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for several tables in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def describe_schema(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, position, column_name, data_type, nullable)``; reads metadata only."""
    rows = [
        (name, position, field.name, field.dataType.simpleString(), field.nullable)
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, nullable boolean"
    )


def column_profile(df: DataFrame, distinct: list[str] | None = None) -> DataFrame:
    """Rows, NULLs, smallest and largest value (as text) of every column, in one pass of plain aggregates.

    Columns in ``distinct`` (default: none) also get their exact number of distinct values, else that is NULL. Those are turned
    into (column, value) pairs that are combined before the shuffle, in one scan for all of them.
    """
    text = {c: F.col(c).cast("string") for c in df.columns}
    sums = [
        F.struct(F.count(F.lit(1)).alias("row_count"), F.count_if(v.isNull()).alias("null_count"), F.min(v).alias("min_value"), F.max(v).alias("max_value")).alias(c)
        for c, v in text.items()
    ]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c)["row_count"].alias("row_count"), F.col(c)["null_count"].alias("null_count"),
                     F.col(c)["min_value"].alias("min_value"), F.col(c)["max_value"].alias("max_value")) for c in text]
    base = df.agg(*sums).select(F.inline(F.array(*rows)))
    if not distinct:
        return base.withColumn("distinct_count", F.lit(None).cast("long"))
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), text[c].alias("value")) for c in distinct])))
    counts = pairs.distinct().groupBy("column_name").agg(F.count("value").alias("distinct_count"))
    return base.join(counts, "column_name", "left")


def describe_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """:func:`describe_schema` with the :func:`column_profile` of each table: its rows, NULLs, smallest and largest values."""
    profiles = [column_profile(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return describe_schema(spark, tables).join(reduce(DataFrame.unionByName, profiles), ["table_name", "column_name"], "left")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def file_profile(df: DataFrame) -> DataFrame:
    """Rows and column count per source file of a frame read from files."""
    return df.groupBy(F.col("_metadata.file_name").alias("source_file")).agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).alias("column_count")
    )


def sample_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """A few rows to look at; ``n = 0`` gives the empty table with the same schema."""
    return df.limit(n)
