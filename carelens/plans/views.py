"""The KPI views. Each is a function of gold (and, for leases, silver) tables that returns a lazy DataFrame.

Facts are aggregated by their own keys first; only the small result meets the dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions.dates import period_text
from carelens.functions.numbers import percent, ratio, round2
from carelens.functions.text import clean
from carelens.operators.aggregates import since_latest, topk_share
from carelens.operators.census import census_intervals, daily_census
from carelens.operators.history import changes_within
from carelens.operators.skew import HOT_ROWS

TRAILING_MONTHS = 12
CHANGE_DAYS = 90
TOP_REASONS = 3
MONTH = ("community_id", "year", "month")


def by_community_month(
    fact: DataFrame, dates: DataFrame, communities: DataFrame, measures: dict[str, Column], extra=()
) -> DataFrame:
    """Sum ``measures`` per community and month.

    The fact is reduced to one row per (community key, day) before the joins, so these handle days, not facts.
    Rows without a date or community drop out.
    """
    daily = fact.groupBy("community_key", "date_key").agg(*[m.alias(name) for name, m in measures.items()])
    return (
        daily.join(dates.select("date_key", "year", "month", *extra), "date_key")
        .join(communities.select("community_key", "community_id"), "community_key")
        .groupBy("community_id", "year", "month", *extra)
        .agg(*[F.sum(name).alias(name) for name in measures])
    )


def monthly_occupancy_rate(fact_occupancy: DataFrame, dates: DataFrame, communities: DataFrame) -> DataFrame:
    """Units, occupied units and their percentage per community and month."""
    measures = {"total_units": F.count(F.lit(1)), "occupied_units": F.sum("occupied_flag")}
    monthly = by_community_month(fact_occupancy, dates, communities, measures, ("month_name",))
    return monthly.select(
        "year",
        "month",
        "month_name",
        "community_id",
        "total_units",
        "occupied_units",
        percent("occupied_units", "total_units").alias("occupancy_rate_pct"),
    )


def avg_length_of_stay(leases: DataFrame, residents: DataFrame) -> DataFrame:
    """Leases that ended in the trailing 12 months and their average length, per care level.

    Lease ends are summed per resident before the join with the resident dimension.
    """
    ended = since_latest(leases, "move_out_date", TRAILING_MONTHS)
    days = F.date_diff("move_out_date", "move_in_date")
    per_resident = ended.groupBy("resident_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(days).alias("n_days"), F.sum(days).alias("days")
    )
    return (
        per_resident.join(residents.select("resident_id", "care_level"), "resident_id")
        .groupBy("care_level")
        .agg(
            F.sum("n").alias("discharged_residents"),
            round2(ratio(F.sum("days"), F.sum("n_days"))).alias("avg_length_of_stay_days"),
        )
    )


def top_moveout_reasons(leases: DataFrame, communities: DataFrame, k: int = TOP_REASONS) -> DataFrame:
    """The most frequent move-out reasons per community and month of the trailing 12 months."""
    ended = since_latest(leases, "move_out_date", TRAILING_MONTHS).select(
        "community_id",
        period_text("move_out_date").alias("period"),
        F.coalesce(clean("move_out_reason"), F.lit("Unknown")).alias("move_out_reason"),
    )
    top = topk_share(
        ended,
        ["community_id", "period"],
        "move_out_reason",
        k,
        "move_out_count",
        "total_move_outs",
        "pct_of_total_moveouts",
        "reason_rank",
    )
    return top.join(communities.select("community_id"), "community_id", "left_semi")


def _resident_days(fact_occupancy: DataFrame, dates: DataFrame, communities: DataFrame) -> DataFrame:
    return by_community_month(
        fact_occupancy, dates, communities, {"resident_days": F.sum("occupied_flag")}
    )


def labor_cost_per_resident_day(
    fact_labor: DataFrame, fact_occupancy: DataFrame, dates: DataFrame, communities: DataFrame
) -> DataFrame:
    """Labor cost per occupied unit, per community and month."""
    labor = by_community_month(fact_labor, dates, communities, {"total_labor_cost": F.sum("labor_cost")})
    return (
        labor.join(_resident_days(fact_occupancy, dates, communities), list(MONTH))
        .withColumn("labor_cost_per_resident_day", round2(ratio("total_labor_cost", "resident_days")))
    )


def incident_rate_per_100_resident_days(
    fact_incidents: DataFrame, fact_occupancy: DataFrame, dates: DataFrame, communities: DataFrame
) -> DataFrame:
    """Incidents per 100 occupied units, per community and month; months without incidents are absent."""
    incidents = by_community_month(fact_incidents, dates, communities, {"total_incidents": F.count(F.lit(1))})
    return (
        incidents.join(_resident_days(fact_occupancy, dates, communities), list(MONTH))
        .withColumn("incident_rate_per_100_resident_days", percent("total_incidents", "resident_days"))
    )


def care_level_changes(
    scd: DataFrame, residents: DataFrame, communities: DataFrame, days: int = CHANGE_DAYS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Care level changes that follow the previous one within 90 days, with the resident's community."""
    changes = changes_within(
        scd,
        ["resident_id"],
        "care_level",
        "effective_start_date",
        days,
        ["care_level", "effective_end_date"],
        hot_rows,
    )
    homes = residents.select("resident_id", "community_key").join(
        communities.select("community_key", "community_id"), "community_key", "left"
    )
    return changes.join(homes, "resident_id", "left").select(
        "community_id",
        "resident_id",
        F.col("previous_value").alias("previous_care_level"),
        F.col("care_level").alias("current_care_level"),
        "previous_change_date",
        F.col("effective_start_date").alias("current_change_date"),
        "days_between_changes",
        "current_flag",
    )


def census_occupancy(
    residents: DataFrame, units: DataFrame, first_day: Column, last_day: Column
) -> DataFrame:
    """Daily occupancy from stays: head count per community and day over its number of units.

    The alternative to the rent-based flag, which marks every priced unit as occupied.
    """
    intervals = census_intervals(residents, ["community_id"], "admit_date", "discharge_date")
    capacity = units.groupBy("community_id").agg(F.count_distinct("unit_id").alias("units"))
    return (
        daily_census(intervals, ["community_id"], first_day, last_day)
        .join(capacity, "community_id")
        .withColumn("occupancy_rate_pct", percent("census", "units"))
    )


#: View names.
VIEW_NAMES = (
    "vw_monthly_occupancy_rate",
    "vw_avg_length_of_stay",
    "vw_top3_moveout_reasons",
    "vw_labor_cost_per_resident_day",
    "vw_incident_rate_per_100_resident_days",
    "vw_resident_care_level_changes_90_days",
)


def build_views(silver: dict[str, DataFrame], gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All views by name, over written tables."""
    dates, communities = gold["dim_date"], gold["dim_community"]
    residents, occupancy = gold["dim_resident"], gold["fact_occupancy"]
    frames = (
        monthly_occupancy_rate(occupancy, dates, communities),
        avg_length_of_stay(silver["yardi_leases"], residents),
        top_moveout_reasons(silver["yardi_leases"], communities),
        labor_cost_per_resident_day(gold["fact_labor"], occupancy, dates, communities),
        incident_rate_per_100_resident_days(gold["fact_incidents"], occupancy, dates, communities),
        care_level_changes(gold["dim_resident_scd"], residents, communities),
    )
    return dict(zip(VIEW_NAMES, frames, strict=True))
