import json
from datetime import date
from pathlib import Path

import pytest
from feeddata import FEBRUARY, JANUARY, write
from pyspark.sql import functions as F

from carelens.workload.principals import ACCESS_KEYS
from carelens.plans import measures, reports
from carelens.plans.pipeline import open_latest, run_pipeline
from carelens.plans.validation import validate
from carelens.plans.views import census_occupancy

AS_OF = "2025-06-30"
D = date


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    write(root / "raw", "2025_01", JANUARY)
    write(root / "raw", "2025_02", FEBRUARY)
    tables = run_pipeline(spark, str(root / "raw"), str(root / "lake"), AS_OF, export_to=str(root / "exports"))
    return root, tables


@pytest.fixture(scope="module")
def corrected(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corrected")
    write(root / "raw", "2025_01", JANUARY)
    write(root / "raw", "2025_02", FEBRUARY)
    return run_pipeline(spark, str(root / "raw"), str(root / "lake"), AS_OF, corrected=True)


def as_dicts(df, *columns):
    return [r.asDict() for r in df.select(*columns).collect()]


def test_shifts_take_the_rate_of_their_role(run):
    got = {r["shift_id"]: (r["role"], r["hours_worked"], r["hourly_rate"]) for r in run[1].silver["adp_shifts"].collect()}
    assert got == {"S1": ("CAREGIVER", 8.0, 16.0), "S2": ("RN", 4.0, 46.0), "S3": ("MED TECH", -2.0, None)}


def test_repeated_lease_survives_by_default_and_not_when_corrected(run, corrected):
    assert run[1].silver["yardi_leases"].count() == 6
    assert corrected.silver["yardi_leases"].count() == 5


def test_dimensions(run):
    gold = run[1].gold
    communities = [(r["community_key"], r["community_id"]) for r in gold["dim_community"].orderBy("community_key").collect()]
    assert communities == [(1, "C001"), (2, "C002"), (3, "C905")]
    residents = {r["resident_id"]: (r["resident_key"], r["community_key"], r["care_level"]) for r in gold["dim_resident"].collect()}
    assert residents == {"R1": (1, 2, "Assisted Living"), "R2": (2, 2, "Memory Care")}
    employees = [(r["employee_key"], r["employee_id"], r["role"]) for r in gold["dim_employee"].orderBy("employee_key").collect()]
    assert employees == [(1, "E1", "CAREGIVER"), (2, "E1", "RN"), (3, "E2", "MED TECH")]
    dates = {r["date_key"] for r in gold["dim_date"].collect()}
    assert D(2025, 1, 6) in dates and D(2099, 1, 4) in dates
    assert D(2025, 2, 10) not in dates  # move-out dates are not part of the date dimension
    history = [tuple(r)[1:] for r in gold["dim_resident_scd"].orderBy("resident_history_key").collect()]
    assert history == [
        ("R1", "AL", D(2025, 1, 8), D(9999, 12, 31), True),
        ("R2", "IL", D(2025, 1, 2), D(2025, 2, 28), False),
        ("R2", "AL", D(2025, 3, 1), D(9999, 12, 31), True),
    ]


def test_labor_fans_out_over_roles_unless_roles_are_matched(run, corrected):
    fact = run[1].gold["fact_labor"]
    assert fact.count() == 5  # two shifts of E1 x two roles, one of E2
    assert sorted((r["hours_worked"], r["labor_cost"]) for r in fact.filter("labor_cost IS NOT NULL").collect()) == [
        (4.0, 184.0), (4.0, 184.0), (8.0, 128.0), (8.0, 128.0),
    ]
    assert corrected.gold["fact_labor"].count() == 3


def test_other_facts(run):
    gold = run[1].gold
    assert {r["review_id"]: r["responded_flag"] for r in gold["fact_reviews"].collect()} == {"G1": True, "G2": False, "G3": False}
    assert {r["lead_id"]: (r["date_key"], r["lead_source"], r["converted_flag"], r["lost_flag"]) for r in gold["fact_leads"].collect()} == {
        "H1": (D(2025, 1, 6), "PRINT", 1, 0),
        "H2": (None, "WEB", 0, 1),
    }
    revenue = {r["lease_id"]: (r["resident_key"], r["lease_duration_days"]) for r in gold["fact_revenue"].collect()}
    assert revenue["L1"] == (1, (D(2025, 6, 30) - D(2024, 12, 1)).days)
    assert revenue["L4"][0] is None
    assert {r["unit_id"]: r["occupied_flag"] for r in gold["fact_occupancy"].collect()} == {"U1": 1, "U2": 0, "U3": 1}
    assert gold["fact_incidents"].filter("resident_key IS NULL").count() == 1


def test_views(run):
    views = run[1].views
    occupancy = {r["community_id"]: (r["total_units"], r["occupied_units"], r["occupancy_rate_pct"]) for r in views["vw_monthly_occupancy_rate"].collect()}
    assert occupancy == {"C001": (1, 1, 100.0), "C002": (1, 0, 0.0), "C905": (1, 1, 100.0)}
    # L2 counts twice, L3 ends one day after the window opens on 2024-02-11? no: 02-10 is outside, L4 has no resident
    stay = [tuple(r) for r in views["vw_avg_length_of_stay"].collect()]
    assert stay == [("Memory Care", 2, 40.0)]
    reasons = sorted(tuple(r) for r in views["vw_top3_moveout_reasons"].collect())
    assert reasons == [
        ("C002", "2025-02", "Financial", 2, 3, 66.67, 1),
        ("C002", "2025-02", "Unknown", 1, 3, 33.33, 2),
    ]
    labor = {r["community_id"]: (r["total_labor_cost"], r["resident_days"], r["labor_cost_per_resident_day"]) for r in views["vw_labor_cost_per_resident_day"].collect()}
    assert labor == {"C001": (624.0, 1, 624.0), "C002": (None, 0, None)}
    incidents = [tuple(r) for r in views["vw_incident_rate_per_100_resident_days"].collect()]
    assert incidents == [("C001", 2025, 1, 1, 1, 100.0)]
    changes = [tuple(r) for r in views["vw_resident_care_level_changes_90_days"].collect()]
    assert changes == [("C002", "R2", "IL", "AL", D(2025, 1, 2), D(2025, 3, 1), 58, True)]


def test_views_are_registered(run, spark):
    assert spark.table("vw_monthly_occupancy_rate").count() == 3


def test_checks(run):
    got = [tuple(r) for r in run[1].checks.collect()]
    assert [(c[0], c[1]) for c in got] == [
        ("Row Count - fact_labor", "FAIL"),
        ("Row Count - fact_reviews", "PASS"),
        ("Row Count - fact_leads", "PASS"),
        ("Row Count - fact_incidents", "PASS"),
        ("Row Count - fact_occupancy", "PASS"),
        ("Row Count - fact_revenue", "PASS"),
        ("Row Count - dim_resident", "FAIL"),
        ("Revenue Reconciliation", "PASS"),
        ("Shift Hours", "FAIL"),
        ("Discharge Before Admit", "FAIL"),
        ("Future Dated Incidents", "FAIL"),
        ("Acuity Range", "FAIL"),
        ("Negative Hours", "FAIL"),
        ("Invalid Rating", "FAIL"),
    ]
    details = {c[0]: c[2:] for c in got}
    assert details["Row Count - fact_labor"] == ("High", "Investigate ETL", "Bronze=4, Silver=3, Gold=5")
    assert details["Discharge Before Admit"] == ("High", "Raise to Client", "1 residents")
    assert details["Future Dated Incidents"] == ("Medium", "Raise to Client", "1 future records")
    assert details["Shift Hours"] == ("Medium", "Check Pipeline", "")


def test_expected_dedupe_and_acuity_bounds(run):
    t = run[1]
    got = {r["Check"]: r for r in validate(t.bronze, t.silver, t.gold, AS_OF, (1, 10), ("pcc_residents",)).collect()}
    assert got["Row Count - dim_resident"]["Status"] == "PASS"
    assert got["Row Count - dim_resident"]["Details"] == "Silver=2, Gold=2"
    assert got["Acuity Range"]["Status"] == "PASS"


def test_outputs(run, spark):
    root, _ = run
    exported = {p.name for p in (root / "exports").glob("*/*")}
    assert exported == {
        "dim_community.parquet", "dim_community_region.parquet", "dim_date.parquet", "dim_employee.parquet",
        "dim_resident.parquet", "dim_resident_scd.parquet", "fact_incidents.parquet", "fact_labor.parquet",
        "fact_leads.parquet", "fact_occupancy.parquet", "fact_reviews.parquet", "fact_revenue.parquet",
    }
    reports_dir = next((root / "lake" / "runs").glob("*/reports"))
    summary = spark.read.json(str(reports_dir / "validation_summary_json")).first().asDict()
    assert summary == {"Total Checks": 14, "Passed": 6, "Failed": 8}
    assert spark.read.option("header", True).csv(str(reports_dir / "validation_summary_csv")).count() == 14
    assert spark.read.json(str(reports_dir / "validation_report_json")).count() == 14


def _log(root: Path, spark):
    return [r.asDict(recursive=True) for r in spark.read.json(f"{root}/logs/pipeline_run").orderBy("run_timestamp", "files_skipped").collect()]


def test_run_log_and_second_run(run, spark):
    root, _ = run
    first = _log(root / "lake", spark)[0]
    assert (first["status"], first["files_processed"], first["files_skipped"]) == ("SUCCESS", 10, 0)
    assert first["rows_loaded"]["yardi_leases"] == 6
    tables = run_pipeline(spark, str(root / "raw"), str(root / "lake"), AS_OF)
    assert tables.silver["yardi_leases"].count() == 6
    second = _log(root / "lake", spark)[-1]
    assert (second["files_processed"], second["files_skipped"]) == (0, 10)
    assert run[1].gold["fact_labor"].count() == 5  # the first run's tables are still readable


def test_readers_open_the_last_successful_run(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    write(raw, "2025_01", {"yardi_units": ["U1,C001,AL,7,2025-01-01"]})
    run_pipeline(spark, str(raw), lake, AS_OF)
    write(raw, "2025_02", {"yardi_units": ["U1,C001,AL,lots,2025-02-01"]})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_pipeline(spark, str(raw), lake, AS_OF)
    opened = open_latest(spark, lake)
    assert opened.gold["fact_occupancy"].count() == 1
    assert opened.views["vw_monthly_occupancy_rate"].first()["total_units"] == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        open_latest(spark, str(tmp_path / "nowhere"))


def test_failure_is_logged_and_raised(spark, tmp_path):
    write(tmp_path / "raw", "2025_01", {"yardi_units": ["U1,C001,AL,lots,2025-01-01"]})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), AS_OF)
    log = _log(tmp_path / "lake", spark)[0]
    assert log["status"] == "FAILED" and "CAST_INVALID_INPUT" in log["error"]


BAD_NUMBERS = {
    "adp_shifts": [
        "S1,C001,E1,RN,2025-01-01,8,{'RN': 46}", "S2,C001,E1,RN,2025-01-01,abc,{'RN': 46}", "S3,C001,E1,RN,2025-01-01,NaN,{'RN': 46}",
        "S4,C001,E1,RN,2025-01-01,8,{'RN': 4 6}", "S5,C001,E1,RN,2025-01-01,8,\"{'RN': 46, junk}\"", ",C001,E1,RN,2025-01-01,8,{'RN': 46}",
        "S1,C001,E1,RN,2025-01-01,8,{'RN': 46}", "S6,C001,E1,RN,2025-01-01,8,{'LPN': 'x'}",
    ],
    "gbp_reviews": ["G1,C001,2025-01-01,5,fine,,", "G2,C001,2025-01-01,99999999999,big,,", "G3,C001,2025-01-01,NaN,odd,,", "G4,C001,2025-01-01,five,odd,,"],
    "pcc_incidents": ["I1,R1,C001,2025-01-01,Fall,3,E1", "I2,R1,C001,2025-01-01,Fall,high,E1"],
    "pcc_residents": ["R1,C001,A,B,1940-01-01,F,2025-01-01,,AL,3,walks", "R2,C001,A,B,1940-01-01,F,2025-01-01,,AL,-,walks"],
    "yardi_leases": ["L1,R1,U1,C001,2025-01-01,,,4000", "L2,R1,U1,C001,2025-01-01,,,Infinity"],
    "yardi_units": ["U1,C001,AL,lots,2025-01-01", "U2,C001,AL,7,2025-01-01"],
}


def test_rows_that_do_not_fit_their_header_are_counted(spark, tmp_path):
    write(tmp_path / "raw", "2025_01", {"yardi_units": ["U1,C001,AL,7,2025-01-01", "U2,C001,AL,7,2025-01-01,more", "U3"], "pcc_incidents": ["I1,R1"]})
    tables = run_pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), AS_OF)
    log = _log(tmp_path / "lake", spark)[0]
    assert (log["status"], log["rows_rejected"]) == ("SUCCESS", {"yardi_units": 2, "pcc_incidents": 1})
    assert log["rows_loaded"]["yardi_units"] == 1 and [r["unit_id"] for r in tables.silver["yardi_units"].collect()] == ["U1"]


@pytest.mark.parametrize("corrected", [False, True])
def test_quarantine_keeps_the_run_going(spark, tmp_path, corrected):
    write(tmp_path / "raw", "2025_01", BAD_NUMBERS)
    tables = run_pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "lake"), AS_OF, quarantine_rows=True, corrected=corrected)
    kept = {f: sorted(r[0] for r in tables.silver[f].collect()) for f in BAD_NUMBERS}
    assert kept == {
        "adp_shifts": ["S1", "S6"], "gbp_reviews": ["G1"], "pcc_incidents": ["I1"], "pcc_residents": ["R1"], "yardi_leases": ["L1"], "yardi_units": ["U2"],
    }
    rejected = json.loads(json.dumps(_log(tmp_path / "lake", spark)[0]))["rows_rejected"]
    assert rejected == {
        "adp_shifts": 5, "gbp_reviews": 3, "pcc_incidents": 1, "pcc_residents": 1, "yardi_leases": 1, "yardi_units": 1, "hubspot_leads": 0,
        "pcc_care_history": 0,
    }
    refused = spark.read.parquet(f"{tmp_path}/lake/runs/*/quarantine/yardi_units")
    assert [(r["unit_id"], r["broken_rules"]) for r in refused.collect()] == [("U1", ["Unreadable monthly_rent"])]
    checks = {r["Check"]: (r["Status"], r["Details"]) for r in tables.checks.collect()}
    assert checks["Row Count - fact_labor"] == ("PASS", "Bronze=8, Silver=2, Gold=2, Rejected=5, Repeated=1")
    assert {name: status for name, (status, _) in checks.items() if status != "PASS"} == {}


# parameterised queries

CORPORATE, REGIONAL, EXECUTIVE = (ACCESS_KEYS[k] for k in ("demo-everything", "demo-one-region", "demo-one-community"))


def test_reports(run):
    tables = run[1]
    regions, views = tables.gold["dim_community_region"], tables.views
    occupancy = views["vw_monthly_occupancy_rate"]
    assert reports.occupancy(occupancy, regions, CORPORATE).count() == 3
    assert reports.occupancy(occupancy, regions, REGIONAL).count() == 2  # the unmapped community is out of scope
    assert reports.occupancy(occupancy, regions, EXECUTIVE, community_id="C002").count() == 0
    assert reports.occupancy(occupancy, regions, CORPORATE, community_id="c905", start="2025-01", end="2025-01").count() == 1
    assert reports.occupancy(occupancy, regions, CORPORATE, start="2025-02").count() == 0
    assert reports.occupancy(occupancy, regions, CORPORATE, end="2024-12").count() == 0
    labor = reports.labor_cost(views["vw_labor_cost_per_resident_day"], regions, CORPORATE, period="2025-01")
    assert [r["community_id"] for r in labor.collect()] == ["C001", "C002"]
    assert reports.incident_summary(views["vw_incident_rate_per_100_resident_days"], regions, CORPORATE, period="2025-02").count() == 0
    changes = views["vw_resident_care_level_changes_90_days"]
    assert reports.resident_care_level_changes(changes, regions, CORPORATE, resident_id="r2", current_flag=True).count() == 1
    assert reports.resident_care_level_changes(changes, regions, CORPORATE, current_flag=False).count() == 0
    assert reports.resident_care_level_changes(changes, regions, EXECUTIVE).count() == 0
    assert reports.move_out_reasons(views["vw_top3_moveout_reasons"], regions, REGIONAL, "c002", "2025-02").count() == 2
    found = reports.reviews(
        tables.gold["fact_reviews"], tables.gold["dim_community"], regions, REGIONAL, "c001", "2025-01-11", "2025-01-11"
    )
    assert [(r["review_id"], r["community_id"]) for r in found.collect()] == [("G2", "C001")]


@pytest.mark.parametrize("call", [reports.labor_cost, reports.incident_summary, reports.move_out_reasons])
def test_bad_period_is_refused_before_any_plan(call):
    class Untouched:
        def filter(self, *_):
            raise AssertionError("a plan was built")

    with pytest.raises(ValueError, match="YYYY-MM"):
        call(Untouched(), None, CORPORATE, period="2025-99")


# measures


def test_measures(run):
    gold = run[1].gold
    regions, communities = gold["dim_community_region"], gold["dim_community"]
    assert measures.current_occupancy(gold["fact_occupancy"]).first()["current_occupancy"] == 1.0
    by_region = {r["region"]: (r["revenue"], r["resident_count"]) for r in measures.revenue_by_region(gold["fact_revenue"], communities, regions).collect()}
    assert by_region == {"Pacific Northwest": (20101.0, 2)}
    totals = {r["community_key"]: r["revenue"] for r in measures.revenue_by_group(gold["fact_revenue"], "community_key", "monthly_rate").filter("is_total = 1").collect()}
    assert totals == {None: 20101.0}
    assert measures.average_rating(gold["fact_reviews"]).first()[0] == 5.0
    latest = F.lit(D(2025, 1, 30))
    rate = measures.move_out_rate(gold["dim_resident"], "resident_id", "discharge_date", latest).first()
    assert (rate["move_outs"], rate["resident_count"], rate["move_out_rate"]) == (1, 2, 0.5)
    by_role = {r["role"]: r["labor_cost"] for r in measures.labor_cost_by_role(gold["fact_labor"], gold["dim_employee"]).collect()}
    assert by_role == {"CAREGIVER": 312.0, "RN": 312.0, "MED TECH": None}
    buckets = {r["duration_bucket"]: r["row_count"] for r in measures.duration_buckets(gold["fact_revenue"], "lease_duration_days").collect()}
    assert buckets == {"31-90": 3, "181-365": 1, "366+": 2}


def test_census_occupancy_uses_stays_and_units(spark):
    stays = spark.createDataFrame(
        [("C1", D(2025, 1, 1), None), ("C1", D(2025, 1, 2), D(2025, 1, 2))], "community_id string, admit_date date, discharge_date date"
    )
    units = spark.createDataFrame([("C1", "U1"), ("C1", "U2"), ("C1", "U2")], "community_id string, unit_id string")
    got = census_occupancy(stays, units, F.lit(D(2025, 1, 1)), F.lit(D(2025, 1, 3)))
    assert [(r["census"], r["occupancy_rate_pct"]) for r in got.orderBy("day").collect()] == [(1, 50.0), (2, 100.0), (1, 50.0)]
