"""Parameterised queries over the KPI views, with row security. Omitted parameters do not filter.

Parameters are checked before a plan is built and enter it as literals, never as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.dates import parse_day, parse_period
from carelens.functions.text import same_text
from carelens.operators.security import Principal, apply_row_security


def _equal(df: DataFrame, column: str, value: str | None) -> DataFrame:
    return df.filter(same_text(column, value)) if value else df


def _in_month(df: DataFrame, period: str | None) -> DataFrame:
    if not period:
        return df
    year, month = parse_period(period)
    return df.filter((F.col("year") == year) & (F.col("month") == month))


def _between_months(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    index = F.col("year") * 12 + F.col("month")
    if start:
        year, month = parse_period(start, "start")
        df = df.filter(index >= year * 12 + month)
    if end:
        year, month = parse_period(end, "end")
        df = df.filter(index <= year * 12 + month)
    return df


def occupancy(
    view: DataFrame, regions: DataFrame, principal: Principal, community_id=None, start=None, end=None
) -> DataFrame:
    """Monthly occupancy between two months, both included."""
    rows = _between_months(_equal(view, "community_id", community_id), start, end)
    return apply_row_security(rows, principal, regions).orderBy("year", "month", "community_id").select(
        "year", "month", "month_name", "community_id", "total_units", "occupied_units", "occupancy_rate_pct"
    )


def labor_cost(
    view: DataFrame, regions: DataFrame, principal: Principal, community_id=None, period=None
) -> DataFrame:
    rows = _in_month(_equal(view, "community_id", community_id), period)
    return apply_row_security(rows, principal, regions).orderBy("community_id", "year", "month")


def incident_summary(
    view: DataFrame, regions: DataFrame, principal: Principal, community_id=None, period=None
) -> DataFrame:
    rows = _in_month(_equal(view, "community_id", community_id), period)
    return apply_row_security(rows, principal, regions).orderBy("community_id", "year", "month")


def reviews(
    fact_reviews: DataFrame,
    communities: DataFrame,
    regions: DataFrame,
    principal: Principal,
    community_id=None,
    start=None,
    end=None,
) -> DataFrame:
    """Reviews between two days, both included, with the community id from the dimension."""
    rows = fact_reviews
    if start:
        rows = rows.filter(F.col("date_key") >= F.lit(parse_day(start, "start")))
    if end:
        rows = rows.filter(F.col("date_key") <= F.lit(parse_day(end, "end")))
    rows = rows.join(communities.select("community_key", "community_id"), "community_key")
    rows = _equal(rows, "community_id", community_id)
    return apply_row_security(rows, principal, regions)


def resident_care_level_changes(
    view: DataFrame, regions: DataFrame, principal: Principal, resident_id=None, current_flag=None
) -> DataFrame:
    rows = _equal(view, "resident_id", resident_id)
    if current_flag is not None:
        rows = rows.filter(F.col("current_flag") == bool(current_flag))
    return apply_row_security(rows, principal, regions).orderBy("resident_id", "current_change_date").select(
        "resident_id",
        "previous_care_level",
        "current_care_level",
        "previous_change_date",
        "current_change_date",
        "days_between_changes",
        "current_flag",
    )


def move_out_reasons(
    view: DataFrame, regions: DataFrame, principal: Principal, community_id=None, period=None
) -> DataFrame:
    rows = _equal(view, "community_id", community_id)
    if period:
        parse_period(period)
        rows = rows.filter(F.col("period") == period)
    return apply_row_security(rows, principal, regions).orderBy("community_id", "period", "reason_rank")
