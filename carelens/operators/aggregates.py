"""Grouped ratios, shares, trailing windows and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens.functions.numbers import percent


def distinct_union(frames: list[DataFrame], column: str) -> DataFrame:
    """Distinct values of one column over several frames (set semantics)."""
    return reduce(DataFrame.union, frames).distinct().toDF(column)


def share_by(df: DataFrame, by: list[str], total: str, flagged: str, rate: str) -> DataFrame:
    """Sum partial counts per group and add the percentage of ``flagged`` in ``total``."""
    return (
        df.groupBy(*by)
        .agg(F.sum(total).alias(total), F.sum(flagged).alias(flagged))
        .withColumn(rate, percent(flagged, total))
    )


def since_latest(df: DataFrame, at: str, months: int) -> DataFrame:
    """Rows in the ``months`` months up to the latest ``at`` of the whole frame, both ends included.

    The latest date is an uncorrelated scalar subquery: one extra aggregate, no join.
    """
    latest = df.agg(F.max(at)).scalar()
    return df.filter(F.col(at).isNotNull() & (F.col(at) >= F.add_months(latest, -months)))


def topk_share(
    df: DataFrame,
    by: list[str],
    item: str,
    k: int,
    count: str = "item_count",
    total: str = "total_count",
    share: str = "pct_of_total",
    rank: str = "item_rank",
    weight: str | None = None,
) -> DataFrame:
    """The ``k`` most frequent items per group with their share of the group's total; ties by item.

    Rows are counted first, so ranking sees one row per (group, item), and Spark applies the rank limit
    before the shuffle as well. The group totals are summed from the same counts. ``weight`` names a column of
    counts if ``df`` is already partly aggregated.
    """
    amount = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(*by, item).agg(amount.alias(count))
    totals = counts.groupBy(*by).agg(F.sum(count).alias(total))
    order = W.partitionBy(*by).orderBy(F.col(count).desc(), F.col(item).asc_nulls_last())
    top = counts.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)
    return top.join(totals, by).withColumn(share, percent(count, total)).select(
        *by, item, count, total, share, rank
    )


def rolling_sum(daily: DataFrame, by: list[str], day: str, value: str, days: int, into: str) -> DataFrame:
    """Sum of ``value`` over the ``days`` calendar days that end at each row's day, gaps included.

    ``daily`` must be aggregated to one row per (group, day), which also bounds the window group.
    """
    window = W.partitionBy(*by).orderBy(F.unix_date(F.col(day))).rangeBetween(-(days - 1), 0)
    return daily.withColumn(into, F.sum(value).over(window))


def year_over_year(monthly: DataFrame, month: str, value: str, by: list[str] | None = None) -> DataFrame:
    """Add last year's value of the same month and the growth; months without a predecessor give NULL.

    A join on the month, not ``lag(12)``: a missing month must not shift the comparison.
    """
    by = by or []
    earlier = monthly.select(
        *by, F.add_months(month, 12).alias(month), F.col(value).alias(f"{value}_ly")
    )
    growth = (F.col(value) - F.col(f"{value}_ly")) / F.nullif(F.col(f"{value}_ly"), F.lit(0.0))
    return monthly.join(earlier, [*by, month], "left").withColumn("yoy_growth", growth)


def bucket(c: Column, bounds: list[int], unit: str = "") -> Column:
    """Label a number by inclusive upper bounds: ``0-30``, ``31-90``, ..., ``366+``; NULL stays NULL."""
    low, expr = 0, None
    for high in bounds:
        expr = (F if expr is None else expr).when(c <= high, F.lit(f"{low}-{high}{unit}"))
        low = high + 1
    return F.when(c.isNotNull(), expr.otherwise(F.lit(f"{low}+{unit}")))


def distinct_bitmaps(df: DataFrame, by: list[str], key: str) -> DataFrame:
    """The distinct values of an integer key per group as bitmaps that merge: ``by``, ``key_range`` and ``bitmap``.

    One row per group and range of 32,768 neighbouring keys, 4 KB each: as many bytes per group as its keys' range has eighths, so keys should
    be dense (:func:`~carelens.operators.keys.dense_key`). NULL keys are not counted. Built once, it answers any coarser grouping
    exactly (:func:`distinct_from`), where ``count(DISTINCT)`` would shuffle (group, key) pairs again for each.
    """
    known = df.filter(F.col(key).isNotNull())
    at = F.bitmap_bucket_number(key).alias("key_range")
    return known.groupBy(*by, at).agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bitmap"))


def distinct_from(bitmaps: DataFrame, by: list[str], name: str) -> DataFrame:
    """Number of distinct keys per group of ``by``, columns that the bitmaps were built with (none: over all)."""
    merged = bitmaps.groupBy(*by, "key_range").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name))
