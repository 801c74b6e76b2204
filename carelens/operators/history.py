"""Slowly changing dimension (type 2) and change detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.functions.dates import OPEN_END
from carelens.operators.latest import KeyedState
from carelens.operators.neighbours import with_neighbour
from carelens.operators.skew import HOT_ROWS


def scd2(
    df: DataFrame,
    keys: list[str],
    value: str,
    at: str,
    ties: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Turn change events into validity intervals.

    Each row is valid from ``at`` until the day before the next change of the same key. The last row of a key
    is open-ended and current. A following row without a date does not close the interval.
    """
    following = with_neighbour(df, keys, at, [at], "_next", "next", ties or [value], hot_rows)
    next_start = F.col("_next").getField(at)
    return following.select(
        *keys,
        F.col(value),
        F.col(at).alias("effective_start_date"),
        F.coalesce(F.date_sub(next_start, 1), F.lit(OPEN_END)).alias("effective_end_date"),
        next_start.isNull().alias("current_flag"),
    )


class HistoryState(KeyedState):
    """Validity intervals kept per key, into which later and late changes are spliced.

    A change that arrives cuts the interval it falls into, or opens a new last one; intervals of other buckets are not read. Equal changes count
    once, so a delivery may come twice. The result is that of :func:`scd2` over the distinct changes of all deliveries.
    """

    def __init__(self, spark: SparkSession, path: str, keys: str, value: str, at: str, buckets: int = 64, hot_rows: int = HOT_ROWS):
        """``keys`` and ``value`` are columns with types, such as ``"resident_id string"``; ``at`` names the day of a change."""
        self.names = [part.split()[0] for part in keys.split(",")]
        self.value, self.at, self.hot_rows = value.split()[0], at, hot_rows
        super().__init__(spark, path, f"{keys}, {value}, effective_start_date date, effective_end_date date, current_flag boolean", self.names, buckets)

    def prepare(self, batch: DataFrame) -> DataFrame:
        return batch.select(*self.names, self.value, self.at).distinct()

    def combine(self, kept: DataFrame, arrived: DataFrame) -> DataFrame:
        before = kept.select(*self.names, self.value, F.col("effective_start_date").alias(self.at))
        return scd2(before.union(arrived).distinct(), self.names, self.value, self.at, hot_rows=self.hot_rows)


def changes_within(
    history: DataFrame,
    keys: list[str],
    value: str,
    at: str,
    days: int,
    ties: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows whose value differs from the previous one of the key and follows it within ``days`` days."""
    ties = ties or [value]
    before = with_neighbour(history, keys, at, [value, at], "_previous", "previous", ties, hot_rows)
    return (
        before.withColumn("previous_value", F.col("_previous").getField(value))
        .withColumn("previous_change_date", F.col("_previous").getField(at))
        .withColumn("days_between_changes", F.date_diff(F.col(at), F.col("previous_change_date")))
        .drop("_previous")
        .filter((F.col("previous_value") != F.col(value)) & (F.col("days_between_changes") <= days))
    )
