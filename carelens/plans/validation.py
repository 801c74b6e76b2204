"""The validation suite: layer reconciliation and business rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.functions.dates import parse_day
from carelens.operators.quality import (
    RESULT_COLUMNS,
    Rule,
    check_results,
    count_check,
    row_count,
    rule_check,
    sum_check,
    table_metrics,
    total,
    violations,
)

# Feed -> the gold table that must hold as many rows.
GOLD_OF_FEED = {
    "adp_shifts": "fact_labor",
    "gbp_reviews": "fact_reviews",
    "hubspot_leads": "fact_leads",
    "pcc_incidents": "fact_incidents",
    "yardi_units": "fact_occupancy",
    "yardi_leases": "fact_revenue",
    "pcc_residents": "dim_resident",
}

# Rule names, severities, recommendations and bounds.
RULES_ON_RESIDENTS = {
    "discharge": Rule(
        "Discharge Before Admit", "discharge_date < admit_date", "High", "Raise to Client", "residents"
    ),
    "acuity": Rule("Acuity Range", "acuity_score NOT BETWEEN {low} AND {high}", "Medium", "Quarantine Records"),
}
HOURS_RULE = Rule("Negative Hours", "hours_worked < 0", "Medium", "Fix Pipeline")
RATING_RULE = Rule("Invalid Rating", "rating < 1 OR rating > 5", "Medium", "Raise to Client")
FUTURE_RULE = Rule(
    "Future Dated Incidents", "incident_date > {as_of}", "Medium", "Raise to Client", "future records"
)
REVENUE_TOLERANCE = 0.01
HOURS_TOLERANCE = 0.1
ACUITY_BOUNDS = (1, 5)


def _fill(rule: Rule, **values) -> Rule:
    return Rule(rule.name, rule.broken.format(**values), rule.severity, rule.recommendation, rule.details)


def resident_rules(acuity_bounds: tuple[int, int] = ACUITY_BOUNDS) -> list[Rule]:
    low, high = acuity_bounds
    return [RULES_ON_RESIDENTS["discharge"], _fill(RULES_ON_RESIDENTS["acuity"], low=low, high=high)]


def future_rule(as_of=None) -> Rule:
    today = "current_date()" if as_of is None else f"DATE '{parse_day(as_of).isoformat()}'"
    return _fill(FUTURE_RULE, as_of=today)


def layer_metrics(as_of=None, acuity_bounds: tuple[int, int] = ACUITY_BOUNDS, adjusted: bool = False) -> dict[tuple[str, str], dict[str, Column]]:
    """What the checks need of each table, by (layer, feed): aggregates by name. ``adjusted`` as rows are left out on purpose."""
    discharge, acuity = resident_rules(acuity_bounds)
    extra = {
        ("Silver" if adjusted else "Bronze", "adp_shifts"): {"raw_hours": total(F.col("hours_worked").cast("double"))},
        ("Gold", "adp_shifts"): {"fact_hours": total("hours_worked"), "negative_hours": violations(HOURS_RULE)},
        ("Silver", "yardi_leases"): {"silver_revenue": total("monthly_rate")},
        ("Gold", "yardi_leases"): {"fact_revenue": total("monthly_rate")},
        ("Silver", "pcc_incidents"): {"future": violations(future_rule(as_of))},
        ("Gold", "gbp_reviews"): {"rating": violations(RATING_RULE)},
        ("Gold", "pcc_residents"): {"discharge": violations(discharge), "acuity": violations(acuity)},
    }
    places = [(layer, feed) for feed in GOLD_OF_FEED for layer in ("Bronze", "Silver", "Gold")]
    return {(layer, feed): {f"{layer}_{feed}": row_count(), **extra.get((layer, feed), {})} for layer, feed in places}


def validate(
    bronze: dict[str, DataFrame],
    silver: dict[str, DataFrame],
    gold: dict[str, DataFrame],
    as_of=None,
    acuity_bounds: tuple[int, int] = ACUITY_BOUNDS,
    expected_dedupe: tuple[str, ...] = (),
    rejected: dict[str, DataFrame] | None = None,
    repeats: dict[str, DataFrame] | None = None,
    measured: dict[str, float] | None = None,
) -> DataFrame:
    """All checks as one DataFrame in report order; every table is scanned once for all its checks, and not at all for what
    ``measured`` already has (values of :func:`layer_metrics` taken while the tables were written).

    Feeds in ``expected_dedupe`` shrink from raw to cleaned by design (monthly snapshots of the same resident):
    only their cleaned and gold counts are compared. By default all three layers must agree.

    A run that quarantines or removes repeats on purpose says so: ``rejected`` has the quarantined rows of each feed and
    ``repeats`` the ``copies`` of its repeated rows (:func:`~carelens.plans.silver.repeated_rows`). Then raw rows must equal cleaned,
    rejected and repeated ones together, and the hours of cleaned shifts are held against the facts.
    """
    adjusted = rejected is not None or repeats is not None
    rejected, repeats = rejected or {}, repeats or {}
    measured = measured or {}
    discharge, acuity = resident_rules(acuity_bounds)
    future = future_rule(as_of)
    of_table = layer_metrics(as_of, acuity_bounds, adjusted)
    tables = []
    for feed, table in GOLD_OF_FEED.items():
        for layer, df in (("Bronze", bronze[feed]), ("Silver", silver[feed]), ("Gold", gold[table])):
            tables.append((df, of_table[layer, feed]))

        if feed in rejected:
            tables.append((rejected[feed], {f"Rejected_{feed}": row_count()}))
        if feed in repeats:
            tables.append((repeats[feed], {f"Repeated_{feed}": F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))}))

    def left_out(feed: str) -> dict[str, str]:
        if feed in expected_dedupe:
            return {}
        return {n: f"{n}_{feed}" for n, some in (("Rejected", rejected), ("Repeated", repeats)) if feed in some}

    def layers(feed: str) -> tuple[str, ...]:
        return ("Silver", "Gold") if feed in expected_dedupe else ("Bronze", "Silver", "Gold")

    checks = [
        *[count_check(table, {x: f"{x}_{feed}" for x in layers(feed)}, left_out=left_out(feed)) for feed, table in GOLD_OF_FEED.items()],
        sum_check(
            "Revenue Reconciliation", "silver_revenue", "fact_revenue", REVENUE_TOLERANCE, "High",
            "Check Revenue Transformation", with_details=True,
        ),
        sum_check("Shift Hours", "raw_hours", "fact_hours", HOURS_TOLERANCE, "Medium", "Check Pipeline"),
        rule_check(discharge, "discharge"),
        rule_check(future, "future"),
        rule_check(acuity, "acuity"),
        rule_check(HOURS_RULE, "negative_hours"),
        rule_check(RATING_RULE, "rating"),
    ]
    left = [(df, rest) for df, metrics in tables if (rest := {n: m for n, m in metrics.items() if n not in measured})]
    spark = next(iter(silver.values())).sparkSession
    row = (table_metrics(left) if left else spark.range(1)).withColumns({name: F.lit(value) for name, value in measured.items()})
    return check_results(row, checks).select(*RESULT_COLUMNS)
