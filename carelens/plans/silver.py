"""Raw feeds to typed, cleaned tables. One pure function per feed.

``dedupe`` selects how repeats are treated:

``"rows"``      drop rows that are equal in every column, lineage included (default);
``"business"``  drop rows that are equal in every business column, so the same row from two files counts once;
``None``        keep repeats; for consumers with set semantics, which makes the extra shuffle pointless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.dates import file_month, safe_date
from carelens.functions.numbers import decimal_number, is_unreadable, rate_for, rate_is_unreadable, whole_number
from carelens.functions.text import care_level, clean, clean_upper, present_flag, role_name
from carelens.operators.latest import dedupe_business_rows, latest_per_key
from carelens.operators.quality import Rule
from carelens.sources.feeds import FEEDS, LINEAGE


def _dedupe(df: DataFrame, mode: str | None) -> DataFrame:
    if mode is None:
        return df
    if mode == "rows":
        return df.distinct()
    if mode == "business":
        return dedupe_business_rows(df, list(LINEAGE))
    raise ValueError(f"dedupe must be 'rows', 'business' or None, got {mode!r}")


def _keyed(bronze: DataFrame, feed: str) -> DataFrame:
    """Rows that have the feed's business key."""
    return bronze.filter(F.col(FEEDS[feed][0]).isNotNull())


def clean_shifts(bronze: DataFrame, dedupe: str | None = "rows") -> DataFrame:
    """Shifts with the pay rate of the row's own role, looked up in the row's rate dictionary."""
    typed = _keyed(bronze, "adp_shifts").select(
        clean("shift_id").alias("shift_id"),
        clean("community_id").alias("community_id"),
        clean("employee_id").alias("employee_id"),
        clean_upper("role").alias("role"),
        safe_date("shift_date").alias("shift_date"),
        decimal_number("hours_worked").alias("hours_worked"),
        rate_for("hourly_rate", role_name("role")).alias("hourly_rate"),
        *LINEAGE,
    )
    return _dedupe(typed, dedupe)


def clean_reviews(bronze: DataFrame, dedupe: str | None = "rows") -> DataFrame:
    typed = _keyed(bronze, "gbp_reviews").select(
        clean("review_id").alias("review_id"),
        clean("community_id").alias("community_id"),
        safe_date("review_date").alias("review_date"),
        whole_number("rating").alias("rating"),
        clean("review_text").alias("review_text"),
        clean("response_text").alias("response_text"),
        safe_date("responded_at").alias("responded_at"),
        present_flag("responded_at").alias("responded_flag"),
        *LINEAGE,
    )
    return _dedupe(typed, dedupe)


def clean_leads(bronze: DataFrame, dedupe: str | None = "rows") -> DataFrame:
    typed = _keyed(bronze, "hubspot_leads").select(
        clean("lead_id").alias("lead_id"),
        clean("community_id").alias("community_id"),
        clean_upper("lead_source").alias("lead_source"),
        *[safe_date(c).alias(c) for c in ("created_date", "tour_date", "deposit_date", "move_in_date")],
        clean_upper("status").alias("status"),
        clean("lost_reason").alias("lost_reason"),
        *LINEAGE,
    )
    return _dedupe(typed, dedupe)


def clean_care_history(
    bronze: DataFrame, dedupe: str | None = "rows", canonical_levels: bool = False
) -> DataFrame:
    """Care level changes. Levels stay the codes of the feed unless ``canonical_levels`` is set."""
    level = care_level if canonical_levels else clean
    typed = _keyed(bronze, "pcc_care_history").select(
        clean("resident_id").alias("resident_id"),
        safe_date("change_date").alias("change_date"),
        level("previous_level").alias("previous_level"),
        level("new_level").alias("new_level"),
        clean("reason").alias("reason"),
        *LINEAGE,
    )
    return _dedupe(typed, dedupe)


def clean_incidents(bronze: DataFrame, dedupe: str | None = "rows") -> DataFrame:
    typed = _keyed(bronze, "pcc_incidents").select(
        clean("incident_id").alias("incident_id"),
        clean("resident_id").alias("resident_id"),
        clean("community_id").alias("community_id"),
        safe_date("incident_date").alias("incident_date"),
        clean("incident_type").alias("incident_type"),
        whole_number("severity").alias("severity"),
        clean("reported_by").alias("reported_by"),
        *LINEAGE,
    )
    return _dedupe(typed, dedupe)


def clean_residents(bronze: DataFrame, by_snapshot_month: bool = False) -> DataFrame:
    """The latest record of each resident, with the canonical care level.

    "Latest" is the latest load; files of one load are ordered by name, hence by month. With
    ``by_snapshot_month`` the month in the file name decides first, so that an old file that arrives late does
    not replace newer data.
    """
    typed = _keyed(bronze, "pcc_residents").select(
        clean("resident_id").alias("resident_id"),
        *[clean(c).alias(c) for c in ("community_id", "first_name", "last_name")],
        safe_date("dob").alias("dob"),
        clean_upper("gender").alias("gender"),
        safe_date("admit_date").alias("admit_date"),
        safe_date("discharge_date").alias("discharge_date"),
        care_level("care_level").alias("care_level"),
        whole_number("acuity_score").alias("acuity_score"),
        "mobility_status",
        *LINEAGE,
    )
    newest = [F.col("ingestion_timestamp").desc_nulls_last(), F.col("source_file").desc_nulls_last()]
    if by_snapshot_month:
        newest.insert(0, file_month("source_file").desc_nulls_last())
    settle = [F.col(c).desc_nulls_last() for c in typed.columns if c not in ("resident_id", *LINEAGE)]
    return latest_per_key(typed, ["resident_id"], [*newest, *settle])


def clean_leases(bronze: DataFrame, dedupe: str | None = "rows") -> DataFrame:
    typed = _keyed(bronze, "yardi_leases").select(
        *[clean(c).alias(c) for c in ("lease_id", "resident_id", "unit_id", "community_id")],
        safe_date("move_in_date").alias("move_in_date"),
        safe_date("move_out_date").alias("move_out_date"),
        clean("move_out_reason").alias("move_out_reason"),
        decimal_number("monthly_rate").alias("monthly_rate"),
        *LINEAGE,
    )
    return _dedupe(typed, dedupe)


def clean_units(bronze: DataFrame, dedupe: str | None = "rows") -> DataFrame:
    typed = _keyed(bronze, "yardi_units").select(
        *[clean(c).alias(c) for c in ("unit_id", "community_id", "unit_type")],
        decimal_number("monthly_rent").alias("monthly_rent"),
        safe_date("snapshot_date").alias("snapshot_date"),
        *LINEAGE,
    )
    return _dedupe(typed, dedupe)


#: Feed -> its cleaning function.
CLEANERS = {
    "adp_shifts": clean_shifts,
    "gbp_reviews": clean_reviews,
    "hubspot_leads": clean_leads,
    "pcc_care_history": clean_care_history,
    "pcc_incidents": clean_incidents,
    "pcc_residents": clean_residents,
    "yardi_leases": clean_leases,
    "yardi_units": clean_units,
}


# Columns that are cast to numbers, by feed.
_NUMBERS = {
    "adp_shifts": {"hours_worked": "double"},
    "gbp_reviews": {"rating": "int"},
    "pcc_incidents": {"severity": "int"},
    "pcc_residents": {"acuity_score": "int"},
    "yardi_leases": {"monthly_rate": "double"},
    "yardi_units": {"monthly_rent": "double"},
}


def unreadable_rules(feed: str) -> list[Rule]:
    """Raw rows that cleaning would drop or fail on; split them off with ``quality.quarantine`` before cleaning."""
    key = FEEDS[feed][0]
    rules = {f"Missing {key}": F.col(key).isNull()}
    rules |= {f"Unreadable {c}": is_unreadable(c, kind) for c, kind in _NUMBERS.get(feed, {}).items()}
    if feed == "adp_shifts":
        rules["Unreadable hourly_rate"] = rate_is_unreadable("hourly_rate", role_name("role"))
    return [Rule(name, broken, "High", "Quarantine Records") for name, broken in rules.items()]


def repeated_rows(bronze: DataFrame, feed: str, dedupe: str = "rows") -> DataFrame:
    """How often each cleaned row occurs in accepted raw rows (``copies``, above 1 only): what ``dedupe`` takes out."""
    cleaned = CLEANERS[feed](bronze, dedupe=None)
    columns = [c for c in cleaned.columns if dedupe == "rows" or c not in LINEAGE]
    return cleaned.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("copies")
