"""Report measures and page aggregates. All take ``by``/filters from the caller and stay lazy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions.numbers import ratio, round2
from carelens.functions.text import same_text
from carelens.operators.aggregates import bucket, rolling_sum, year_over_year
from carelens.plans.views import by_community_month

# Our choice of upper bounds for lease duration buckets, in days.
DURATION_BOUNDS = [30, 90, 180, 365]


def current_occupancy(fact_occupancy: DataFrame, by: list[str] | None = None, unit: str = "unit_id") -> DataFrame:
    """Snapshot rows, distinct units and their ratio. Meaningful within one snapshot only."""
    return (
        fact_occupancy.groupBy(*(by or []))
        .agg(F.count(F.lit(1)).alias("occupied_units"), F.count_distinct(unit).alias("total_units"))
        .withColumn("current_occupancy", ratio("occupied_units", "total_units"))
    )


def revenue_by_month(facts: DataFrame, day: str, amount: str, by: list[str] | None = None) -> DataFrame:
    """Total revenue per month; rows without a date belong to no month."""
    return (
        facts.filter(F.col(day).isNotNull())
        .groupBy(*(by or []), F.trunc(day, "month").alias("month_start"))
        .agg(F.sum(amount).alias("total_revenue"))
    )


def revenue_growth(facts: DataFrame, day: str, amount: str, by: list[str] | None = None) -> DataFrame:
    """Total revenue per month, the same month of last year, and the growth."""
    return year_over_year(revenue_by_month(facts, day, amount, by), "month_start", "total_revenue", by)


def average_daily_census_as_written(facts: DataFrame, day: str, resident: str, by=None) -> DataFrame:
    """The measure as defined: the average, over the dates, of a distinct count that does not depend on the
    date, hence that distinct count."""
    return facts.filter(F.col(day).isNotNull()).groupBy(*(by or [])).agg(
        F.count_distinct(resident).cast("double").alias("avg_daily_census")
    )


def move_out_rate(residents: DataFrame, key: str, discharge: str, latest: Column, days: int = 90) -> DataFrame:
    """Residents discharged in the ``days`` days up to ``latest``, all residents, and the ratio; one scan."""
    recent = F.col(discharge).isNotNull() & (F.col(discharge) > F.date_sub(latest, days))
    recent = recent & (F.col(discharge) <= latest)
    return residents.agg(
        F.count_if(recent).alias("move_outs"), F.count_distinct(key).alias("resident_count")
    ).withColumn("move_out_rate", ratio("move_outs", "resident_count"))


def incident_rate(
    incidents: DataFrame, revenue: DataFrame, dates: DataFrame, resident: str = "resident_key", day: str = "date_key"
) -> DataFrame:
    """Incidents per 100 resident-days, where resident-days = distinct residents x distinct dates."""
    parts = [
        incidents.agg(F.count(F.lit(1)).alias("n")).select(F.lit("incident_count").alias("part"), "n"),
        revenue.agg(F.count_distinct(resident).alias("n")).select(F.lit("residents").alias("part"), "n"),
        dates.agg(F.count_distinct(day).alias("n")).select(F.lit("days").alias("part"), "n"),
    ]
    wide = parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(
        *[F.max(F.when(F.col("part") == p, F.col("n"))).alias(p) for p in ("incident_count", "residents", "days")]
    )
    resident_days = F.col("residents") * F.col("days")
    return wide.select(
        "incident_count",
        resident_days.alias("resident_days"),
        ratio(F.col("incident_count") * 100, resident_days).alias("incident_rate_per_100"),
    )


def rolling_revenue(facts: DataFrame, day: str, amount: str, by: list[str], days: int = 90) -> DataFrame:
    """Revenue of the ``days`` days up to each day that has revenue, per group; days are aggregated first."""
    daily = facts.filter(F.col(day).isNotNull()).groupBy(*by, F.col(day).alias("day")).agg(
        F.sum(amount).alias("revenue")
    )
    return rolling_sum(daily, by, "day", "revenue", days, f"rolling_{days}d_revenue")


def revenue_by_group(facts: DataFrame, group: str, amount: str) -> DataFrame:
    """Revenue per group and in total; ``is_total`` marks the total row."""
    return facts.rollup(group).agg(
        F.sum(amount).alias("revenue"), F.grouping(group).cast("int").alias("is_total")
    )


def average_rating(reviews: DataFrame, rating: str = "rating", by: list[str] | None = None) -> DataFrame:
    return reviews.groupBy(*(by or [])).agg(F.avg(rating).alias("avg_rating"))


# Page aggregates


def slice_rows(df: DataFrame, community_id=None, region=None, year=None, month=None) -> DataFrame:
    """Filter by the slicers that are set."""
    for column, value in (("community_id", community_id), ("region", region)):
        if value is not None:
            df = df.filter(same_text(column, value))
    for column, value in (("year", year), ("month", month)):
        if value is not None:
            df = df.filter(F.col(column) == int(value))
    return df


def with_region(facts: DataFrame, communities: DataFrame, regions: DataFrame) -> DataFrame:
    """Add ``community_id`` and ``region`` to facts; both dimensions are joined small side first."""
    named = communities.select("community_key", "community_id").join(
        regions.select("community_id", "region"), "community_id", "left"
    )
    return facts.join(named, "community_key", "left")


def revenue_by_region(fact_revenue: DataFrame, communities: DataFrame, regions: DataFrame) -> DataFrame:
    """Revenue and distinct residents per region. Communities without a region form the NULL group.

    The fact is reduced to one row per (community, resident) before it is joined.
    """
    per_resident = fact_revenue.groupBy("community_key", "resident_key").agg(F.sum("monthly_rate").alias("revenue"))
    rows = with_region(per_resident, communities, regions)
    return rows.groupBy("region").agg(F.sum("revenue").alias("revenue"), F.count_distinct("resident_key").alias("resident_count"))


def pair_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows per pair of values, for example lead source by lead status."""
    return df.groupBy(first, second).agg(F.count(F.lit(1)).alias("row_count"))


def labor_cost_by_role(fact_labor: DataFrame, employees: DataFrame) -> DataFrame:
    """Labor cost per role; cost is summed per employee row before the join."""
    per_employee = fact_labor.groupBy("employee_key").agg(F.sum("labor_cost").alias("labor_cost"))
    return (
        per_employee.join(employees.select("employee_key", "role"), "employee_key")
        .groupBy("role")
        .agg(F.sum("labor_cost").alias("labor_cost"))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def lease_metrics(
    fact_revenue: DataFrame, dates: DataFrame, communities: DataFrame, regions: DataFrame
) -> DataFrame:
    """Average rent, revenue and lease count per region and month, reduced per (community, day) first.

    Rates are summed as decimals, so that the sum does not depend on the order of rows, and only results are rounded.
    """
    daily = fact_revenue.groupBy("community_key", "date_key").agg(
        F.sum(F.col("monthly_rate").cast("decimal(18,4)")).cast("decimal(28,4)").alias("revenue"), F.count("monthly_rate").alias("rates"),
        F.count(F.lit(1)).alias("leases"),
    )
    rows = with_region(daily.join(dates.select("date_key", "year", "month"), "date_key"), communities, regions)
    revenue = F.sum("revenue").cast("double")
    return rows.groupBy("region", "year", "month").agg(
        round2(ratio(revenue, F.sum("rates"))).alias("avg_monthly_rent"),
        round2(revenue).alias("revenue"),
        F.sum("leases").alias("leases"),
    )


def monthly_trends(
    fact_occupancy: DataFrame,
    fact_revenue: DataFrame,
    fact_incidents: DataFrame,
    dates: DataFrame,
    communities: DataFrame,
) -> DataFrame:
    """Occupancy, revenue, census and incidents per community and month; a month with only one of them is kept.

    Census and incident rate are the report's measures in that month: distinct residents with revenue, and incidents per 100
    resident-days, where the days are those of the date dimension. Each fact is reduced to community months before they meet.
    """
    parts = [
        (fact_occupancy, {"total_units": F.count(F.lit(1)), "occupied_units": F.sum("occupied_flag")}),
        (fact_revenue, {"revenue": F.sum("monthly_rate")}),
        (fact_incidents, {"incidents": F.count(F.lit(1))}),
    ]
    months = [by_community_month(fact, dates, communities, sums) for fact, sums in parts]
    present = fact_revenue.select("community_key", "date_key", "resident_key").distinct()
    residents = present.join(dates.select("date_key", "year", "month"), "date_key").groupBy("community_key", "year", "month").agg(
        F.count_distinct("resident_key").alias("avg_daily_census")
    )
    months.append(
        residents.join(communities.select("community_key", "community_id"), "community_key").groupBy("community_id", "year", "month").agg(
            F.sum("avg_daily_census").alias("avg_daily_census")
        )
    )
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), months)
    names = [*[name for _, sums in parts for name in sums], "avg_daily_census"]
    merged = rows.groupBy("community_id", "year", "month").agg(*[F.max(name).alias(name) for name in names])
    days = dates.groupBy("year", "month").agg(F.count(F.lit(1)).alias("_days"))
    rate = ratio(F.col("incidents") * 100.0, F.col("avg_daily_census") * F.col("_days"))
    return merged.join(days, ["year", "month"], "left").withColumn("incident_rate_per_100", rate).drop("_days")


def duration_buckets(df: DataFrame, days: str, bounds: list[int] | None = None) -> DataFrame:
    """Rows per duration bucket."""
    label = bucket(F.col(days), bounds or DURATION_BOUNDS).alias("duration_bucket")
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
