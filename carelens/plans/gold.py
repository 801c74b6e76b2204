"""The star schema. Every builder is a pure function of its inputs.

Dimension keys are dense numbers by default (``dense_key`` writes the dimension once). Pass
``keyed=content_key`` for keys computed from the business key alone: nothing is written, and they are equal on
every run. ``keyed=kept_key(folder)`` gives dense numbers that stay: ids that arrive later are numbered after the others.

Facts look dimensions up with plain left joins. No broadcast is forced: Spark broadcasts a dimension whose
stored size is below its threshold and otherwise uses a sort-merge join, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.dates import calendar_parts, day_literal
from carelens.functions.numbers import positive_flag
from carelens.functions.text import has_text, present_flag, same_text
from carelens.operators.aggregates import distinct_union
from carelens.operators.history import scd2
from carelens.operators.keys import dense_key, hash_key, row_id
from carelens.operators.skew import HOT_ROWS


def content_key(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Alternative to ``dense_key``: a key computed from the ordering columns."""
    return df.select(hash_key(*order).alias(name), *df.columns)


# The tables (by feed) that name a community, and the date column of each feed that dates facts.
COMMUNITY_FEEDS = (
    "adp_shifts", "gbp_reviews", "hubspot_leads", "pcc_residents", "pcc_incidents", "yardi_units", "yardi_leases",
)
DATE_COLUMNS = {
    "adp_shifts": "shift_date",
    "gbp_reviews": "review_date",
    "hubspot_leads": "created_date",
    "pcc_incidents": "incident_date",
    "yardi_units": "snapshot_date",
    "yardi_leases": "move_in_date",
}


def dim_community(silver: dict[str, DataFrame], keyed=dense_key) -> DataFrame:
    """Every community id that occurs in a cleaned table."""
    ids = distinct_union([silver[f].select("community_id") for f in COMMUNITY_FEEDS], "community_id")
    return keyed(ids, "community_key", ["community_id"])


def dim_resident(residents: DataFrame, communities: DataFrame, keyed=dense_key) -> DataFrame:
    """Residents (latest record) with their community's key."""
    rows = residents.join(communities.select("community_id", "community_key"), "community_id", "left").select(
        "resident_id", "community_key", "first_name", "last_name", "gender", "dob", "admit_date",
        "discharge_date", "care_level", "acuity_score", "mobility_status",
    )
    return keyed(rows, "resident_key", ["resident_id"])


def dim_resident_scd(care_history: DataFrame, keyed=dense_key, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Care level history as validity intervals."""
    intervals = scd2(
        care_history.select("resident_id", "change_date", F.col("new_level").alias("care_level")),
        ["resident_id"],
        "care_level",
        "change_date",
        hot_rows=hot_rows,
    )
    order = ["resident_id", "effective_start_date", "care_level", "effective_end_date"]
    return keyed(intervals, "resident_history_key", order)


def dim_date(silver: dict[str, DataFrame], corrected_weekend: bool = False) -> DataFrame:
    """The dates that occur in the data, with calendar parts."""
    days = distinct_union([silver[f].select(c) for f, c in DATE_COLUMNS.items()], "date_key")
    return days.filter("date_key IS NOT NULL").select("date_key", *calendar_parts("date_key", corrected_weekend))


def dense_calendar(dates: DataFrame, corrected_weekend: bool = True) -> DataFrame:
    """Every day from the first to the last date of a date dimension; its size depends on the range only."""
    span = dates.agg(F.min("date_key").alias("lo"), F.max("date_key").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date_key"))
    return days.select("date_key", *calendar_parts("date_key", corrected_weekend))


def dim_employee(shifts: DataFrame, keyed=dense_key) -> DataFrame:
    """Every (employee, role) pair: an employee with two roles has two rows."""
    return keyed(shifts.select("employee_id", "role").distinct(), "employee_key", ["employee_id", "role"])


def _lookup(facts: DataFrame, dim: DataFrame, on: str | list[str], key: str) -> DataFrame:
    on = [on] if isinstance(on, str) else on
    return facts.join(dim.select(*on, key), on, "left")


def _dated(facts: DataFrame, dates: DataFrame, column: str) -> DataFrame:
    days = dates.select(F.col("date_key").alias(column), "date_key")
    return facts.join(days, column, "left")


def fact_labor(
    shifts: DataFrame, communities: DataFrame, employees: DataFrame, dates: DataFrame, match_role: bool = False
) -> DataFrame:
    """One row per shift and matching employee row.

    Employees are matched by id alone, so a shift of an employee with two roles appears twice. With
    ``match_role`` the role must match too and each shift appears once.
    """
    rows = _lookup(shifts, communities, "community_id", "community_key")
    rows = _lookup(rows, employees, ["employee_id", "role"] if match_role else "employee_id", "employee_key")
    return _dated(rows, dates, "shift_date").select(
        row_id().alias("labor_key"),
        "date_key",
        "community_key",
        "employee_key",
        "hours_worked",
        "hourly_rate",
        (F.col("hours_worked") * F.col("hourly_rate")).alias("labor_cost"),
    )


def fact_reviews(reviews: DataFrame, communities: DataFrame, dates: DataFrame) -> DataFrame:
    """Reviews; responded means that there is response text."""
    rows = _lookup(reviews, communities, "community_id", "community_key")
    return _dated(rows, dates, "review_date").select(
        row_id().alias("review_key"),
        "date_key",
        "community_key",
        "review_id",
        "rating",
        has_text("response_text").alias("responded_flag"),
    )


def fact_leads(leads: DataFrame, communities: DataFrame, dates: DataFrame) -> DataFrame:
    """Leads; converted means that there is a move-in date."""
    rows = _lookup(leads, communities, "community_id", "community_key")
    return _dated(rows, dates, "created_date").select(
        row_id().alias("lead_key"),
        "date_key",
        "community_key",
        "lead_id",
        "lead_source",
        "status",
        present_flag("move_in_date").alias("converted_flag"),
        F.when(same_text("status", "lost"), 1).otherwise(0).alias("lost_flag"),
    )


def fact_revenue(
    leases: DataFrame, residents: DataFrame, communities: DataFrame, dates: DataFrame, as_of=None
) -> DataFrame:
    """Lease rows dated at move-in; open leases last until ``as_of`` (today by default)."""
    rows = _lookup(leases, residents, "resident_id", "resident_key")
    rows = _lookup(rows, communities, "community_id", "community_key")
    until = F.coalesce("move_out_date", day_literal(as_of))
    rows = rows.withColumn("lease_duration_days", F.date_diff(until, F.col("move_in_date")))
    return _dated(rows, dates, "move_in_date").select(
        row_id().alias("revenue_key"),
        "date_key",
        "community_key",
        "resident_key",
        "lease_id",
        "monthly_rate",
        "lease_duration_days",
    )


def fact_occupancy(units: DataFrame, communities: DataFrame, dates: DataFrame) -> DataFrame:
    """Unit snapshots; a unit with a positive rent counts as occupied."""
    rows = _lookup(units, communities, "community_id", "community_key")
    return _dated(rows, dates, "snapshot_date").select(
        row_id().alias("occupancy_key"),
        "date_key",
        "community_key",
        "unit_id",
        "unit_type",
        "monthly_rent",
        positive_flag("monthly_rent").alias("occupied_flag"),
    )


def fact_incidents(
    incidents: DataFrame, residents: DataFrame, communities: DataFrame, dates: DataFrame
) -> DataFrame:
    rows = _lookup(incidents, residents, "resident_id", "resident_key")
    rows = _lookup(rows, communities, "community_id", "community_key")
    return _dated(rows, dates, "incident_date").select(
        row_id().alias("incident_key"),
        "date_key",
        "community_key",
        "resident_key",
        "incident_id",
        "incident_type",
        "severity",
    )
