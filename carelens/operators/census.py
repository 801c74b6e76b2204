"""Daily census from stay intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def census_intervals(stays: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Head count per group as intervals ``[from_day, to_day]`` in which it does not change.

    A stay adds one on its first day and removes one on the day after its last day (never, if it is open).
    These changes are summed per (group, day) before anything is ordered, so the running total sees at most
    one row per day and group, however many stays there are. Stays are not expanded to days.
    """
    known = stays.filter(F.col(start).isNotNull())
    arrivals = known.select(*by, F.col(start).alias("from_day"), F.lit(1).alias("_step"))
    departures = known.filter(F.col(end).isNotNull()).select(
        *by, F.date_add(end, 1).alias("from_day"), F.lit(-1).alias("_step")
    )
    steps = arrivals.union(departures).groupBy(*by, "from_day").agg(F.sum("_step").alias("_step"))
    order = W.partitionBy(*by).orderBy("from_day")
    running = order.rowsBetween(W.unboundedPreceding, 0)
    return steps.select(
        *by,
        "from_day",
        F.date_sub(F.lead("from_day").over(order), 1).alias("to_day"),
        F.sum("_step").over(running).alias("census"),
    )


def daily_census(intervals: DataFrame, by: list[str], first_day, last_day) -> DataFrame:
    """One row per group and day of the range; the size is groups x days, not stays x days.

    ``first_day`` and ``last_day`` are columns or date literals and bound the expansion.
    """
    begin = F.greatest(F.col("from_day"), first_day)
    stop = F.least(F.coalesce(F.col("to_day"), last_day), last_day)
    return intervals.filter(begin <= stop).select(
        *by, F.explode(F.sequence(begin, stop)).alias("day"), "census"
    )


def resident_days(intervals: DataFrame, by: list[str], first_day, last_day) -> DataFrame:
    """Resident-days and average census of the range per group, straight from the intervals."""
    begin = F.greatest(F.col("from_day"), first_day)
    stop = F.least(F.coalesce(F.col("to_day"), last_day), last_day)
    span = F.date_diff(last_day, first_day) + 1
    return (
        intervals.filter(begin <= stop)
        .groupBy(*by)
        .agg(F.sum(F.col("census") * (F.date_diff(stop, begin) + 1)).alias("resident_days"))
        .withColumn("avg_daily_census", F.col("resident_days") / span)
    )
