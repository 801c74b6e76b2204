"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.session import materialise

_POSITION_BITS = 33  # documented layout of monotonically_increasing_id: partition above, position below


def slot(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Rows dealt to ranges of the sort order, with ``_slot``: (range, position in it).

    The table is written once, so that a retry cannot move the boundaries.
    """
    sorted_ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(sorted_ranges.withColumn("_slot", F.monotonically_increasing_id()), label)


def slot_part() -> Column:
    return F.shiftright("_slot", _POSITION_BITS)


def dense_key(df: DataFrame, name: str, order: list[Column | str]) -> DataFrame:
    """Add ``name`` = 1, 2, 3, ... in the sort order given, without a single-task window over the rows.

    The key is a row's position in its range plus the row count of all earlier ranges. The counts stay a table, of one row
    per range; they are summed and joined there, so neither the driver nor the plan grows with their number.
    """
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    placed = slot(df, order, name).withColumn("_part", slot_part())
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
    starts = sizes.select("_part", earlier.alias("_start"))
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return placed.join(starts, "_part").select((F.col("_start") + position + 1).alias(name), *df.columns)


def stored_keys(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The key table at ``path``; empty if nothing was numbered yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def extend_keys(ids: DataFrame, name: str, columns: list[str], path: str) -> DataFrame:
    """The key table at ``path``, extended by the ids it lacks: ``name`` and ``columns``.

    A number once given stays. Unseen ids (found by an anti join) are numbered in their sort order after the highest number, so
    numbers stay dense. New rows are appended in one job; repeating it after a failure finds what is stored and adds the rest. Ids
    may be null. One writer at a time.
    """
    wanted = ids.select(*columns).distinct()
    schema = T.StructType([T.StructField(name, T.LongType()), *wanted.schema.fields])
    known = stored_keys(ids.sparkSession, path, schema)
    unseen = dense_key(wanted.join(known, _same(wanted, known, columns), "left_anti"), name, columns)
    highest = known.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    materialise(unseen.withColumn(name, F.col(name) + highest), f"new-{name}").write.mode("append").parquet(path)
    return stored_keys(ids.sparkSession, path, schema)


def kept_key(folder: str) -> Callable[[DataFrame, str, list[str]], DataFrame]:
    """An alternative to :func:`dense_key` whose numbers stay from run to run: key tables lie under ``folder``, one per key name.

    Rows that agree in the ordering columns share a number.
    """

    def keyed(df: DataFrame, name: str, order: list[str]) -> DataFrame:
        table = extend_keys(df, name, order, f"{folder}/{name}")
        return df.join(table, _same(df, table, order), "left").select(table[name], *[df[c] for c in df.columns])

    return keyed


def hash_key(*columns: str) -> Column:
    """A key that depends on the row's content only: equal on every run, on every cluster.

    128 bits as text; unlike a 64-bit number it stays collision-free for hundreds of billions of rows.
    NULL and the empty string give different keys.
    """
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("\u0001", *parts))


def row_id() -> Column:
    """A unique number per row, in no order. Use it where the result is written before it is read again."""
    return F.monotonically_increasing_id()
