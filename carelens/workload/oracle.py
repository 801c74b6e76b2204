"""SQL for the derived feeds and the tables built from them, as named query blocks.

Each block is written from the table's definition, for DuckDB, and refers to other blocks by name.
:func:`sql` puts the blocks that a final query needs in front of it.
"""

from __future__ import annotations

import re

from carelens.sources.reference_data import REGIONS
from carelens.workload.feeds import AS_OF, DERIVED, bronze_sql

BLOCKS: dict[str, str] = {f"b_{feed}": bronze_sql(feed) for feed in DERIVED}


def _trimmed(*columns: str) -> str:
    return ", ".join(f"trim({c}) AS {c}" for c in columns)


def _dates(*columns: str) -> str:
    return ", ".join(f"TRY_CAST({c} AS DATE) AS {c}" for c in columns)


_LINEAGE = "source_file, ingestion_timestamp"

# cleaned tables

BLOCKS["s_adp_shifts"] = rf"""
SELECT DISTINCT {_trimmed("shift_id", "community_id", "employee_id")}, upper(trim(role)) AS role,
  {_dates("shift_date")}, CAST(hours_worked AS DOUBLE) AS hours_worked,
  TRY_CAST(CASE upper(trim(role)) WHEN 'RN' THEN regexp_extract(hourly_rate, 'RN.: ([0-9.]+)', 1)
    WHEN 'CAREGIVER' THEN regexp_extract(hourly_rate, 'Caregiver.: ([0-9.]+)', 1)
    WHEN 'MED TECH' THEN regexp_extract(hourly_rate, 'Med Tech.: ([0-9.]+)', 1) END AS DOUBLE) AS hourly_rate, {_LINEAGE}
FROM b_adp_shifts WHERE shift_id IS NOT NULL"""

BLOCKS["s_gbp_reviews"] = f"""
SELECT DISTINCT {_trimmed("review_id", "community_id")}, {_dates("review_date")},
  CAST(rating AS INTEGER) AS rating, {_trimmed("review_text", "response_text")}, {_dates("responded_at")},
  CAST(responded_at IS NOT NULL AS INTEGER) AS responded_flag, {_LINEAGE}
FROM b_gbp_reviews WHERE review_id IS NOT NULL"""

BLOCKS["s_hubspot_leads"] = f"""
SELECT DISTINCT {_trimmed("lead_id", "community_id")}, upper(trim(lead_source)) AS lead_source,
  {_dates("created_date", "tour_date", "deposit_date", "move_in_date")}, upper(trim(status)) AS status,
  {_trimmed("lost_reason")}, {_LINEAGE}
FROM b_hubspot_leads WHERE lead_id IS NOT NULL"""

BLOCKS["s_pcc_care_history"] = f"""
SELECT DISTINCT {_trimmed("resident_id")}, {_dates("change_date")},
  {_trimmed("previous_level", "new_level", "reason")}, {_LINEAGE}
FROM b_pcc_care_history WHERE resident_id IS NOT NULL"""

BLOCKS["s_pcc_incidents"] = f"""
SELECT DISTINCT {_trimmed("incident_id", "resident_id", "community_id")}, {_dates("incident_date")},
  {_trimmed("incident_type")}, CAST(severity AS INTEGER) AS severity, {_trimmed("reported_by")}, {_LINEAGE}
FROM b_pcc_incidents WHERE incident_id IS NOT NULL"""

_RESIDENT_ROWS = f"""
SELECT {_trimmed("resident_id", "community_id", "first_name", "last_name")}, {_dates("dob")},
  upper(trim(gender)) AS gender, {_dates("admit_date", "discharge_date")},
  CASE upper(trim(care_level)) WHEN 'IL' THEN 'Independent Living' WHEN 'INDEPENDENT LIVING' THEN 'Independent Living'
    WHEN 'ASSISTED' THEN 'Assisted Living' WHEN 'MEMORY CARE' THEN 'Memory Care' ELSE trim(care_level)
  END AS care_level, CAST(acuity_score AS INTEGER) AS acuity_score, mobility_status, {_LINEAGE}
FROM b_pcc_residents WHERE resident_id IS NOT NULL"""

BLOCKS["s_pcc_residents"] = f"""
SELECT * FROM ({_RESIDENT_ROWS}) QUALIFY 1 = row_number() OVER (
  PARTITION BY resident_id ORDER BY ingestion_timestamp DESC, source_file DESC, last_name DESC)"""

BLOCKS["s_pcc_residents_by_month"] = f"""
SELECT * FROM ({_RESIDENT_ROWS}) QUALIFY 1 = row_number() OVER (
  PARTITION BY resident_id ORDER BY regexp_extract(source_file, '[0-9]+_[0-9]+') DESC,
  ingestion_timestamp DESC, source_file DESC, last_name DESC)"""

BLOCKS["s_yardi_leases"] = f"""
SELECT DISTINCT {_trimmed("lease_id", "resident_id", "unit_id", "community_id")},
  {_dates("move_in_date", "move_out_date")}, {_trimmed("move_out_reason")},
  CAST(monthly_rate AS DOUBLE) AS monthly_rate, {_LINEAGE}
FROM b_yardi_leases WHERE lease_id IS NOT NULL"""

BLOCKS["s_yardi_units"] = f"""
SELECT DISTINCT {_trimmed("unit_id", "community_id", "unit_type")}, CAST(monthly_rent AS DOUBLE) AS monthly_rent,
  {_dates("snapshot_date")}, {_LINEAGE}
FROM b_yardi_units WHERE unit_id IS NOT NULL"""

# dimensions

_ID_TABLES = ("adp_shifts", "gbp_reviews", "hubspot_leads", "pcc_residents", "pcc_incidents", "yardi_units", "yardi_leases")
_DATE_OF = {
    "adp_shifts": "shift_date", "gbp_reviews": "review_date", "hubspot_leads": "created_date",
    "pcc_incidents": "incident_date", "yardi_units": "snapshot_date", "yardi_leases": "move_in_date",
}

BLOCKS["dim_community"] = (
    "SELECT row_number() OVER (ORDER BY community_id NULLS LAST) AS community_key, community_id FROM ("
    + " UNION ".join(f"SELECT community_id FROM s_{t}" for t in _ID_TABLES)
    + ")"
)

BLOCKS["dim_resident"] = """
SELECT row_number() OVER (ORDER BY resident_id) AS resident_key, resident_id, community_key, first_name, last_name,
  gender, dob, admit_date, discharge_date, care_level, acuity_score, mobility_status
FROM s_pcc_residents LEFT JOIN dim_community USING (community_id)"""

BLOCKS["scd_rows"] = """
SELECT resident_id, new_level AS care_level, change_date AS effective_start_date,
  coalesce(following - 1, DATE '9999-12-31') AS effective_end_date, following IS NULL AS current_flag
FROM (SELECT *, lead(change_date) OVER (PARTITION BY resident_id ORDER BY change_date NULLS LAST, new_level)
  AS following FROM s_pcc_care_history)"""

BLOCKS["dim_resident_scd"] = """
SELECT row_number() OVER (ORDER BY resident_id, effective_start_date NULLS LAST, care_level, effective_end_date)
  AS resident_history_key, * FROM scd_rows"""


def _calendar(day: str, weekend: str) -> str:
    return f"""CAST(year({day}) AS INTEGER) AS year, CAST(quarter({day}) AS INTEGER) AS quarter,
  CAST(month({day}) AS INTEGER) AS month, monthname({day}) AS month_name, CAST(day({day}) AS INTEGER) AS day,
  dayname({day}) AS weekday, CAST(weekofyear({day}) AS INTEGER) AS week_number, {weekend} AS is_weekend"""


_ALL_DATES = " UNION ".join(f"SELECT {c} AS date_key FROM s_{t} WHERE {c} IS NOT NULL" for t, c in _DATE_OF.items())
BLOCKS["dim_date"] = f"SELECT date_key, {_calendar('date_key', 'dayofweek(date_key) = 1')} FROM ({_ALL_DATES})"
BLOCKS["dim_date_corrected"] = (
    f"SELECT date_key, {_calendar('date_key', 'isodow(date_key) >= 6')} FROM ({_ALL_DATES})"
)
BLOCKS["dim_calendar"] = f"""
SELECT date_key, {_calendar("date_key", "isodow(date_key) >= 6")} FROM (
  SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS date_key FROM (
    SELECT min(date_key) AS lo, max(date_key) AS hi FROM dim_date))"""

BLOCKS["dim_employee"] = """
SELECT row_number() OVER (ORDER BY employee_id, role NULLS LAST) AS employee_key, employee_id, role
FROM (SELECT employee_id, role FROM s_adp_shifts GROUP BY ALL)"""

BLOCKS["dim_community_region"] = "SELECT * FROM (VALUES {}) AS r(community_id, state, region)".format(
    ", ".join(f"('{c}', '{state}', '{region}')" for region, (state, ids) in REGIONS.items() for c in ids)
)

# facts (without their arbitrary row number)

BLOCKS["fact_labor"] = """
SELECT shift_date AS date_key, community_key, employee_key, hours_worked, hourly_rate,
  hours_worked * hourly_rate AS labor_cost
FROM s_adp_shifts s LEFT JOIN dim_community USING (community_id)
LEFT JOIN dim_employee e ON e.employee_id = s.employee_id"""
BLOCKS["fact_labor_matched"] = BLOCKS["fact_labor"] + " AND e.role = s.role"

BLOCKS["fact_reviews"] = """
SELECT review_date AS date_key, community_key, review_id, rating,
  coalesce(length(trim(response_text)), 0) > 0 AS responded_flag
FROM s_gbp_reviews LEFT JOIN dim_community USING (community_id)"""

BLOCKS["fact_leads"] = """
SELECT created_date AS date_key, community_key, lead_id, lead_source, status,
  CAST(move_in_date IS NOT NULL AS INTEGER) AS converted_flag,
  CAST(coalesce(status = 'LOST', FALSE) AS INTEGER) AS lost_flag
FROM s_hubspot_leads LEFT JOIN dim_community USING (community_id)"""

BLOCKS["fact_revenue"] = f"""
SELECT move_in_date AS date_key, c.community_key, r.resident_key, lease_id, monthly_rate,
  CAST(coalesce(move_out_date, DATE '{AS_OF}') - move_in_date AS INTEGER) AS lease_duration_days
FROM s_yardi_leases l LEFT JOIN dim_community c USING (community_id)
LEFT JOIN dim_resident r ON r.resident_id = l.resident_id"""

BLOCKS["fact_occupancy"] = """
SELECT snapshot_date AS date_key, community_key, unit_id, unit_type, monthly_rent,
  CAST(coalesce(monthly_rent > 0, FALSE) AS INTEGER) AS occupied_flag
FROM s_yardi_units LEFT JOIN dim_community USING (community_id)"""

BLOCKS["fact_incidents"] = """
SELECT incident_date AS date_key, c.community_key, r.resident_key, incident_id, incident_type, severity
FROM s_pcc_incidents i LEFT JOIN dim_community c USING (community_id)
LEFT JOIN dim_resident r ON r.resident_id = i.resident_id"""

# views

_YM = "CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month"

BLOCKS["v_occupancy"] = f"""
SELECT {_YM}, monthname(date_key) AS month_name, community_id, count(*) AS total_units,
  CAST(sum(occupied_flag) AS BIGINT) AS occupied_units,
  round(100.0::DOUBLE * sum(occupied_flag) / count(*), 2) AS occupancy_rate_pct
FROM fact_occupancy JOIN dim_community USING (community_key) WHERE date_key IS NOT NULL GROUP BY ALL"""
BLOCKS["ended_leases"] = """
SELECT * FROM s_yardi_leases
WHERE move_out_date >= (SELECT max(move_out_date) FROM s_yardi_leases) - INTERVAL 12 MONTH"""

BLOCKS["v_stay"] = """
SELECT care_level, count(*) AS discharged_residents,
  round(avg(move_out_date - move_in_date), 2) AS avg_length_of_stay_days
FROM ended_leases JOIN dim_resident USING (resident_id) GROUP BY care_level"""

BLOCKS["v_reasons"] = """
SELECT community_id, period, move_out_reason, n AS move_out_count, CAST(sum(n) OVER g AS BIGINT) AS total_move_outs,
  round(100.0::DOUBLE * n / sum(n) OVER g, 2) AS pct_of_total_moveouts,
  CAST(row_number() OVER (g ORDER BY n DESC, move_out_reason) AS INTEGER) AS reason_rank
FROM (SELECT community_id, strftime(move_out_date, '%Y-%m') AS period,
    coalesce(move_out_reason, 'Unknown') AS move_out_reason, count(*) AS n FROM ended_leases GROUP BY ALL)
WINDOW g AS (PARTITION BY community_id, period) QUALIFY reason_rank <= 3"""

BLOCKS["occupied_months"] = f"""
SELECT community_id, {_YM}, CAST(sum(occupied_flag) AS BIGINT) AS resident_days
FROM fact_occupancy JOIN dim_community USING (community_key) WHERE date_key IS NOT NULL GROUP BY ALL"""

BLOCKS["v_labor"] = f"""
SELECT community_id, year, month, total_labor_cost, resident_days,
  CASE WHEN resident_days > 0 THEN round(total_labor_cost / resident_days, 2) END AS labor_cost_per_resident_day
FROM (SELECT community_id, {_YM}, sum(labor_cost) AS total_labor_cost
  FROM fact_labor JOIN dim_community USING (community_key) WHERE date_key IS NOT NULL GROUP BY ALL)
JOIN occupied_months USING (community_id, year, month)"""

BLOCKS["v_incidents"] = f"""
SELECT community_id, year, month, total_incidents, resident_days,
  CASE WHEN resident_days > 0 THEN round(100.0::DOUBLE * total_incidents / resident_days, 2) END
    AS incident_rate_per_100_resident_days
FROM (SELECT community_id, {_YM}, count(*) AS total_incidents
  FROM fact_incidents JOIN dim_community USING (community_key) WHERE date_key IS NOT NULL GROUP BY ALL)
JOIN occupied_months USING (community_id, year, month)"""

BLOCKS["v_changes"] = """
SELECT community_id, resident_id, before AS previous_care_level, h.care_level AS current_care_level,
  since AS previous_change_date, effective_start_date AS current_change_date,
  CAST(effective_start_date - since AS INTEGER) AS days_between_changes, current_flag
FROM (SELECT *, lag(care_level) OVER w AS before, lag(effective_start_date) OVER w AS since FROM dim_resident_scd
  WINDOW w AS (PARTITION BY resident_id ORDER BY effective_start_date NULLS LAST, care_level, effective_end_date)) h
LEFT JOIN dim_resident USING (resident_id) LEFT JOIN dim_community USING (community_key)
WHERE before <> h.care_level AND effective_start_date - since <= 90"""


def blocks_for(text: str) -> list[str]:
    """Names of the blocks a statement needs, each after those it needs itself."""
    ordered: list[str] = []

    def visit(statement: str) -> None:
        for name in BLOCKS:
            if name not in ordered and re.search(rf"\b{name}\b", statement):
                visit(BLOCKS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(text)
    return ordered


def sql(final: str) -> str:
    """A complete statement: the needed blocks as common table expressions, then ``final``."""
    blocks = blocks_for(final)
    if not blocks:
        return final
    return "WITH " + ",\n".join(f"{name} AS ({BLOCKS[name].strip()})" for name in blocks) + "\n" + final
