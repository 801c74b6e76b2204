"""Queries for every table, view, report, check and measure, over the feeds of :mod:`carelens.workload.feeds`.

Each entry is ``name: (spark query, oracle SQL)``. Row numbers that have no defined order (the facts' own keys)
are left out of the results and checked for uniqueness by ``fact_row_ids``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.functions.numbers import round2
from carelens.operators import profile, quality
from carelens.operators.census import census_intervals, daily_census, resident_days
from carelens.operators.keys import dense_key
from carelens.operators.latest import conflicting_keys
from carelens.operators.security import apply_row_security, entitlements, resolve_principal, rows_by_principal, rows_for
from carelens.plans import gold as g
from carelens.plans import measures as m
from carelens.plans import reports as r
from carelens.plans import validation as val
from carelens.plans import views as v
from carelens.plans.silver import CLEANERS
from carelens.session import freed_shuffles, materialise, scratch_path
from carelens.sources.feeds import FEEDS, LINEAGE
from carelens.sources.reference_data import dim_community_region
from carelens.workload.feeds import AS_OF, DERIVED, derive, load
from carelens.workload.oracle import sql
from carelens.workload.principals import ACCESS_KEYS

Query = Callable[[SparkSession, str], DataFrame]


class Layers:
    """Silver and gold over one folder of benchmark tables.

    Dimensions are written once per instance. With :meth:`write_silver` the cleaned feeds are written first, for
    queries that read them several times.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._sources: dict[str, DataFrame] = {}
        self._written: dict[str, DataFrame] = {}

    def write_silver(self) -> dict[str, DataFrame]:
        """Write every cleaned feed, two at a time: more would hold the shuffle files of all feeds at once."""
        cleaned = {feed: self.silver(feed) for feed in FEEDS}
        with freed_shuffles(self.spark), ThreadPoolExecutor(2) as pool:
            self._written = dict(zip(FEEDS, pool.map(lambda f: materialise(cleaned[f], f, "zstd"), FEEDS), strict=True))
        return self._written

    def bronze(self, feed: str) -> DataFrame:
        table = DERIVED[feed][0]
        if table not in self._sources:
            self._sources[table] = load(self.spark, self.sf_dir, table)
        return derive(self._sources[table], feed)

    def silver(self, feed: str, **options) -> DataFrame:
        if feed in self._written and not options:
            return self._written[feed]
        return CLEANERS[feed](self.bronze(feed), **options)

    @cached_property
    def value_sets(self) -> dict[str, DataFrame]:
        """Cleaned feeds for consumers that only take distinct values; repeats need not be removed first."""
        if self._written:
            return self._written
        return {f: self.silver(f) if f == "pcc_residents" else self.silver(f, dedupe=None) for f in FEEDS}

    def prepare(self, *names: str) -> None:
        """Write several dimensions side by side."""
        self.value_sets  # noqa: B018  (shared by the builders below)
        missing = [n for n in names if n not in self.__dict__]
        with ThreadPoolExecutor(max(1, len(missing))) as pool:
            list(pool.map(lambda name: getattr(self, name), missing))

    @cached_property
    def communities(self) -> DataFrame:
        return g.dim_community(self.value_sets)

    @cached_property
    def dates(self) -> DataFrame:
        return materialise(g.dim_date(self.value_sets), "dim_date")

    @cached_property
    def employees(self) -> DataFrame:
        return g.dim_employee(self.value_sets["adp_shifts"])

    @cached_property
    def residents(self) -> DataFrame:
        return g.dim_resident(self.value_sets["pcc_residents"], self.communities)

    @cached_property
    def care_history(self) -> DataFrame:
        """Written first: the history builder reads it more than once."""
        return materialise(self.silver("pcc_care_history"), "care_history")

    @cached_property
    def history(self) -> DataFrame:
        return g.dim_resident_scd(self.care_history, keyed=g.content_key)

    @cached_property
    def regions(self) -> DataFrame:
        return dim_community_region(self.spark)

    @cached_property
    def labor(self) -> DataFrame:
        self.prepare("communities", "dates", "employees")
        return g.fact_labor(self.silver("adp_shifts"), self.communities, self.employees, self.dates)

    @cached_property
    def reviews(self) -> DataFrame:
        self.prepare("communities", "dates")
        return g.fact_reviews(self.silver("gbp_reviews"), self.communities, self.dates)

    @cached_property
    def leads(self) -> DataFrame:
        self.prepare("communities", "dates")
        return g.fact_leads(self.silver("hubspot_leads"), self.communities, self.dates)

    @cached_property
    def revenue(self) -> DataFrame:
        self.prepare("communities", "dates")
        return g.fact_revenue(self.silver("yardi_leases"), self.residents, self.communities, self.dates, AS_OF)

    @cached_property
    def occupancy(self) -> DataFrame:
        self.prepare("communities", "dates")
        return g.fact_occupancy(self.silver("yardi_units"), self.communities, self.dates)

    @cached_property
    def incidents(self) -> DataFrame:
        self.prepare("communities", "dates")
        return g.fact_incidents(self.silver("pcc_incidents"), self.residents, self.communities, self.dates)

    # views

    def occupancy_view(self) -> DataFrame:
        return v.monthly_occupancy_rate(self.occupancy, self.dates, self.communities)

    def stay_view(self) -> DataFrame:
        return v.avg_length_of_stay(self.silver("yardi_leases"), self.residents)

    def reasons_view(self) -> DataFrame:
        return v.top_moveout_reasons(self.silver("yardi_leases"), self.communities)

    def labor_view(self) -> DataFrame:
        return v.labor_cost_per_resident_day(self.labor, self.occupancy, self.dates, self.communities)

    def incident_view(self) -> DataFrame:
        return v.incident_rate_per_100_resident_days(self.incidents, self.occupancy, self.dates, self.communities)

    def changes_view(self) -> DataFrame:
        return v.care_level_changes(self.history, self.residents, self.communities)


QUERIES: dict[str, tuple[Query, str | None]] = {}


def register(name: str, oracle: str | None):
    def add(build: Callable[[Layers], DataFrame]):
        QUERIES[name] = (lambda spark, sf_dir: build(Layers(spark, sf_dir)), sql(oracle) if oracle else None)
        return build

    return add


CORPORATE = resolve_principal("demo-everything", ACCESS_KEYS)
REGIONAL = resolve_principal("demo-one-region", ACCESS_KEYS)
EXECUTIVE = resolve_principal("demo-one-community", ACCESS_KEYS)

# cleaned tables


def _business(df: DataFrame) -> DataFrame:
    """Without the load timestamp, whose type differs between engines."""
    return df.drop("ingestion_timestamp")


for _feed in FEEDS:
    register(f"silver_{_feed}", f"SELECT * EXCLUDE (ingestion_timestamp) FROM s_{_feed}")(
        lambda t, feed=_feed: _business(t.silver(feed))
    )

register("silver_residents_by_month", "SELECT * EXCLUDE (ingestion_timestamp) FROM s_pcc_residents_by_month")(
    lambda t: _business(t.silver("pcc_residents", by_snapshot_month=True))
)
register(
    "silver_units_business",
    "SELECT unit_id, community_id, unit_type, monthly_rent, snapshot_date, min(source_file) AS source_file "
    "FROM s_yardi_units GROUP BY ALL",
)(lambda t: _business(t.silver("yardi_units", dedupe="business")))
register(
    "silver_history_canonical",
    "SELECT resident_id, change_date, new_level AS raw_level, CASE new_level WHEN 'IL' THEN 'Independent Living' "
    "WHEN 'AL' THEN 'Assisted Living' ELSE 'Memory Care' END AS level, count(*) AS row_count "
    "FROM s_pcc_care_history GROUP BY ALL",
)(
    lambda t: t.silver("pcc_care_history", canonical_levels=True)
    .groupBy(
        "resident_id",
        "change_date",
        F.when(F.col("new_level") == "Independent Living", "IL")
        .when(F.col("new_level") == "Assisted Living", "AL")
        .otherwise("MC")
        .alias("raw_level"),
        F.col("new_level").alias("level"),
    )
    .agg(F.count(F.lit(1)).alias("row_count"))
)
register(
    "conflicting_shift_ids",
    "SELECT shift_id, count(DISTINCT (community_id, employee_id, role, shift_date, hours_worked, "
    "coalesce(hourly_rate, -1))) AS versions FROM s_adp_shifts GROUP BY shift_id HAVING versions > 1",
)(lambda t: conflicting_keys(t.silver("adp_shifts", dedupe=None), ["shift_id"], list(LINEAGE)))

# dimensions

register("gold_dim_community", "SELECT * FROM dim_community")(lambda t: t.communities)
register("gold_dim_resident", "SELECT * FROM dim_resident")(lambda t: t.residents)
register("gold_dim_resident_scd", "SELECT * FROM dim_resident_scd")(
    lambda t: g.dim_resident_scd(t.care_history)
)
register("gold_dim_date", "SELECT * FROM dim_date")(lambda t: g.dim_date(t.value_sets))
register("gold_dim_date_corrected", "SELECT * FROM dim_date_corrected")(
    lambda t: g.dim_date(t.value_sets, corrected_weekend=True)
)
register("gold_dense_calendar", "SELECT * FROM dim_calendar")(lambda t: g.dense_calendar(g.dim_date(t.value_sets)))
register("gold_dim_employee", "SELECT * FROM dim_employee")(lambda t: g.dim_employee(t.value_sets["adp_shifts"]))
register(
    "gold_community_regions",
    "SELECT community_id, state, region FROM dim_community LEFT JOIN dim_community_region USING (community_id)",
)(lambda t: t.communities.select("community_id").join(t.regions, "community_id", "left"))

# facts

register("gold_fact_labor", "SELECT * FROM fact_labor")(lambda t: t.labor.drop("labor_key"))
register("gold_fact_labor_matched", "SELECT * FROM fact_labor_matched")(
    lambda t: g.fact_labor(
        t.silver("adp_shifts"), t.communities, t.employees, t.dates, match_role=True
    ).drop("labor_key")
)
register("gold_fact_reviews", "SELECT * FROM fact_reviews")(lambda t: t.reviews.drop("review_key"))
register("gold_fact_leads", "SELECT * FROM fact_leads")(lambda t: t.leads.drop("lead_key"))
register("gold_fact_revenue", "SELECT * FROM fact_revenue")(lambda t: t.revenue.drop("revenue_key"))
register("gold_fact_occupancy", "SELECT * FROM fact_occupancy")(lambda t: t.occupancy.drop("occupancy_key"))
register("gold_fact_incidents", "SELECT * FROM fact_incidents")(lambda t: t.incidents.drop("incident_key"))
register(
    "fact_row_ids",
    "SELECT 'fact_reviews' AS fact, count(*) AS row_count, count(*) AS ids FROM fact_reviews "
    "UNION ALL SELECT 'fact_leads', count(*), count(*) FROM fact_leads",
)(
    lambda t: t.reviews.agg(
        F.lit("fact_reviews").alias("fact"), F.count(F.lit(1)).alias("row_count"), F.count_distinct("review_key").alias("ids")
    ).unionByName(
        t.leads.agg(
            F.lit("fact_leads").alias("fact"), F.count(F.lit(1)).alias("row_count"), F.count_distinct("lead_key").alias("ids")
        )
    )
)

# views

register("view_monthly_occupancy_rate", "SELECT * FROM v_occupancy")(lambda t: t.occupancy_view())
register("view_avg_length_of_stay", "SELECT * FROM v_stay")(lambda t: t.stay_view())
register("view_top3_moveout_reasons", "SELECT * FROM v_reasons")(lambda t: t.reasons_view())
register("view_labor_cost_per_resident_day", "SELECT * FROM v_labor")(lambda t: t.labor_view())
register("view_incident_rate_per_100_resident_days", "SELECT * FROM v_incidents")(lambda t: t.incident_view())
register("view_care_level_changes_90_days", "SELECT * FROM v_changes")(lambda t: t.changes_view())

# parameterised queries; the region and community scopes are those of the demo access keys

_PNW = "community_id IN (SELECT community_id FROM dim_community_region WHERE region = 'Pacific Northwest')"

register(
    "report_occupancy",
    f"SELECT * FROM v_occupancy WHERE {_PNW} AND make_date(year, month, 1) BETWEEN DATE '1996-11-01' AND DATE '1998-02-01' "
    "ORDER BY year, month, community_id",
)(lambda t: r.occupancy(t.occupancy_view(), t.regions, REGIONAL, start="1996-11", end="1998-02"))


def _in_written_order(report: DataFrame, label: str) -> DataFrame:
    """A report as it was written, with each row's place: the files of a sorted table hold its ranges in order."""
    path = scratch_path(report.sparkSession, label)
    report.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    return dense_key(report.sparkSession.read.parquet(path), "position", ["_place"]).drop("_place")


register(
    "report_occupancy_order",
    f"SELECT *, row_number() OVER (ORDER BY year, month, community_id) AS position FROM v_occupancy WHERE {_PNW} "
    "AND make_date(year, month, 1) BETWEEN DATE '1996-11-01' AND DATE '1998-02-01'",
)(lambda t: _in_written_order(r.occupancy(t.occupancy_view(), t.regions, REGIONAL, start="1996-11", end="1998-02"), "report"))
register(
    "report_labor_cost",
    "SELECT * FROM v_labor WHERE lower(community_id) = 'c007' AND year = 1997 AND month = 6",
)(lambda t: r.labor_cost(t.labor_view(), t.regions, CORPORATE, community_id="c007", period="1997-06"))
register("report_incident_summary", "SELECT * FROM v_incidents WHERE community_id = 'C001'")(
    lambda t: r.incident_summary(t.incident_view(), t.regions, EXECUTIVE)
)
register(
    "report_reviews",
    "SELECT f.*, community_id FROM fact_reviews f JOIN dim_community USING (community_key) "
    f"WHERE date_key BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND {_PNW}",
)(
    lambda t: r.reviews(
        t.reviews, t.communities, t.regions, REGIONAL, start="2024-01-05", end="2024-01-20"
    ).drop("review_key")
)
register(
    "report_care_level_changes",
    f"SELECT * EXCLUDE (community_id) FROM v_changes WHERE current_flag AND {_PNW}",
)(lambda t: r.resident_care_level_changes(t.changes_view(), t.regions, REGIONAL, current_flag=True))
register(
    "report_move_out_reasons",
    "SELECT * FROM v_reasons WHERE community_id = 'C001' AND period = '2002-01'",
)(lambda t: r.move_out_reasons(t.reasons_view(), t.regions, EXECUTIVE, community_id="C001", period="2002-01"))

# row security over the cleaned leases

_LEASES = "SELECT lease_id, community_id, monthly_rate FROM s_yardi_leases"


def _leases(t: Layers) -> DataFrame:
    return t.silver("yardi_leases").select("lease_id", "community_id", "monthly_rate")


register("row_security_all", _LEASES)(lambda t: apply_row_security(_leases(t), CORPORATE, t.regions))
register("row_security_region", f"{_LEASES} WHERE {_PNW}")(
    lambda t: apply_row_security(_leases(t), REGIONAL, t.regions)
)
register("row_security_one", f"{_LEASES} WHERE community_id = 'C001'")(
    lambda t: apply_row_security(_leases(t), EXECUTIVE, t.regions)
)


def _grants(t: Layers) -> DataFrame:
    people = t.spark.createDataFrame(
        [
            ("chief", "corporate_admin", None, None),
            ("south", "regional_director", "South", None),
            ("house7", "executive_director", None, "C007"),
        ],
        "principal string, role string, region string, community_id string",
    )
    return entitlements(people, t.communities, t.regions)


def _entitled(t: Layers, principal: str) -> DataFrame:
    return rows_for(_leases(t), _grants(t), principal)


register(
    "row_security_all_principals",
    "SELECT principal, community_id, count(*) AS row_count FROM s_yardi_leases JOIN (SELECT 'house7' AS principal, 'C007' AS c "
    "UNION ALL SELECT 'south', community_id FROM dim_community_region WHERE region = 'South' "
    "UNION ALL SELECT DISTINCT 'chief', community_id FROM s_yardi_leases) ON community_id = c GROUP BY ALL",
)(lambda t: rows_by_principal(_leases(t), _grants(t)).groupBy("principal", "community_id").agg(F.count(F.lit(1)).alias("row_count")))


register(
    "row_security_entitlements",
    f"{_LEASES} JOIN dim_community_region USING (community_id) WHERE region = 'South'",
)(lambda t: _entitled(t, "south"))
register("row_security_entitlements_all", _LEASES)(lambda t: _entitled(t, "chief"))

# validation


def _tables(t: Layers) -> tuple[dict, dict, dict]:
    raw = {f: t.bronze(f) for f in FEEDS}
    cleaned = t.write_silver()
    with freed_shuffles(t.spark):
        t.prepare("communities", "dates", "employees")
        labor = materialise(t.labor, "fact_labor", "zstd")
        facts = {
            "fact_labor": labor,
            "fact_reviews": t.reviews,
            "fact_leads": t.leads,
            "fact_incidents": t.incidents,
            "fact_occupancy": t.occupancy,
            "fact_revenue": t.revenue,
            "dim_resident": t.residents,
        }
    return raw, cleaned, facts


def _count_check(table: str, feed: str) -> str:
    return (
        f"SELECT 'Row Count - {table}' AS \"Check\", (SELECT count(*) FROM b_{feed}) AS b, "
        f"(SELECT count(*) FROM s_{feed}) AS s, (SELECT count(*) FROM {table}) AS g"
    )


def _rule_check(name: str, severity: str, advice: str, table: str, broken: str, suffix: str = "") -> str:
    details = f"CASE WHEN n > 0 THEN n || ' {suffix}' ELSE '' END" if suffix else "''"
    return (
        f"SELECT '{name}', CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, CASE WHEN n > 0 THEN '{severity}' ELSE 'Low' END, "
        f"CASE WHEN n > 0 THEN '{advice}' ELSE 'None' END, {details} "
        f"FROM (SELECT count(*) AS n FROM {table} WHERE {broken})"
    )


_VALIDATION = f"""
SELECT "Check", CASE WHEN b = s AND s = g THEN 'PASS' ELSE 'FAIL' END AS "Status",
  CASE WHEN b = s AND s = g THEN 'Low' ELSE 'High' END AS "Severity",
  CASE WHEN b = s AND s = g THEN 'None' ELSE 'Investigate ETL' END AS "Recommendation",
  'Bronze=' || b || ', Silver=' || s || ', Gold=' || g AS "Details"
FROM ({" UNION ALL ".join(_count_check(table, feed) for feed, table in val.GOLD_OF_FEED.items())})
UNION ALL {_rule_check("Revenue Reconciliation", "High", "Check Revenue Transformation",
  "(SELECT (SELECT sum(monthly_rate) FROM s_yardi_leases) - (SELECT sum(monthly_rate) FROM fact_revenue) AS d)",
  "abs(d) >= 0.01")}
UNION ALL {_rule_check("Shift Hours", "Medium", "Check Pipeline",
  "(SELECT (SELECT sum(CAST(hours_worked AS DOUBLE)) FROM b_adp_shifts) - (SELECT sum(hours_worked) FROM fact_labor) AS d)",
  "abs(d) >= 0.1")}
UNION ALL {_rule_check("Discharge Before Admit", "High", "Raise to Client", "dim_resident",
  "discharge_date < admit_date", "residents")}
UNION ALL {_rule_check("Future Dated Incidents", "Medium", "Raise to Client", "s_pcc_incidents",
  f"incident_date > DATE '{AS_OF}'", "future records")}
UNION ALL {_rule_check("Acuity Range", "Medium", "Quarantine Records", "dim_resident", "acuity_score < 1 OR acuity_score > 5")}
UNION ALL {_rule_check("Negative Hours", "Medium", "Fix Pipeline", "fact_labor", "hours_worked < 0")}
UNION ALL {_rule_check("Invalid Rating", "Medium", "Raise to Client", "fact_reviews", "NOT (rating BETWEEN 1 AND 5)")}
"""


@register("validation_checks", _VALIDATION)
def _validation(t: Layers) -> DataFrame:
    return val.validate(*_tables(t), as_of=AS_OF)


register(
    "validation_summary",
    'SELECT count(*) AS "Total Checks", count(*) FILTER ("Status" = \'PASS\') AS "Passed", '
    f'count(*) FILTER ("Status" = \'FAIL\') AS "Failed" FROM ({_VALIDATION})',
)(lambda t: quality.summarise(val.validate(*_tables(t), as_of=AS_OF)))
register(
    "layer_row_counts",
    " UNION ALL ".join(f"SELECT 'silver_{f}' AS table_name, count(*) AS row_count FROM s_{f}" for f in FEEDS),
)(lambda t: profile.layer_counts({f"silver_{f}": t.silver(f) for f in FEEDS}))
register(
    "quarantined_residents",
    "SELECT resident_id, acuity_score, list_filter([CASE WHEN discharge_date < admit_date THEN 'Discharge Before Admit' "
    "END, CASE WHEN acuity_score NOT BETWEEN 1 AND 5 THEN 'Acuity Range' END], lambda x: x IS NOT NULL)::VARCHAR AS rules "
    "FROM dim_resident WHERE discharge_date < admit_date OR acuity_score NOT BETWEEN 1 AND 5",
)(
    lambda t: quality.quarantine(t.residents, val.resident_rules())[1].select(
        "resident_id",
        "acuity_score",
        F.concat(F.lit("["), F.concat_ws(", ", "broken_rules"), F.lit("]")).alias("rules"),
    )
)
register(
    "orphan_communities",
    "SELECT community_id, count(*) AS row_count FROM s_yardi_units WHERE community_id NOT IN "
    "(SELECT community_id FROM dim_community_region) GROUP BY community_id",
)(lambda t: quality.orphan_keys(t.silver("yardi_units"), t.regions, "community_id"))
register(
    "duplicate_unit_snapshots",
    "SELECT unit_id, snapshot_date, count(*) AS copies FROM s_yardi_units GROUP BY ALL HAVING copies > 1",
)(lambda t: quality.duplicate_keys(t.silver("yardi_units"), ["unit_id", "snapshot_date"]))

# measures

register(
    "measure_current_occupancy",
    "SELECT date_key, count(*) AS occupied_units, count(DISTINCT unit_id) AS total_units, "
    "count(*)::DOUBLE / count(DISTINCT unit_id) AS current_occupancy FROM fact_occupancy GROUP BY date_key",
)(lambda t: m.current_occupancy(t.occupancy, ["date_key"]))
register(
    "measure_revenue_growth",
    "SELECT a.month_start, round(a.rev, 2) AS total_revenue, round(b.rev, 2) AS total_revenue_ly, "
    "round((a.rev - b.rev) / b.rev, 6) AS yoy_growth FROM (SELECT date_trunc('month', date_key)::DATE AS month_start, "
    "sum(monthly_rate) AS rev FROM fact_revenue GROUP BY 1) a LEFT JOIN (SELECT "
    "(date_trunc('month', date_key) + INTERVAL 1 YEAR)::DATE AS month_start, sum(monthly_rate) AS rev "
    "FROM fact_revenue GROUP BY 1) b USING (month_start)",
)(
    lambda t: m.revenue_growth(t.revenue, "date_key", "monthly_rate").select(
        "month_start",
        round2("total_revenue").alias("total_revenue"),
        round2("total_revenue_ly").alias("total_revenue_ly"),
        F.round("yoy_growth", 6).alias("yoy_growth"),
    )
)
register(
    "measure_avg_daily_census_as_written",
    "SELECT CAST(count(DISTINCT resident_key) AS DOUBLE) AS avg_daily_census FROM fact_revenue",
)(lambda t: m.average_daily_census_as_written(t.revenue, "date_key", "resident_key"))
register(
    "measure_move_out_rate",
    "SELECT count(*) FILTER (discharge_date > latest - 90 AND discharge_date <= latest) AS move_outs, "
    "count(DISTINCT resident_id) AS resident_count, "
    "count(*) FILTER (discharge_date > latest - 90 AND discharge_date <= latest)::DOUBLE / count(DISTINCT resident_id) "
    "AS move_out_rate FROM dim_resident, (SELECT max(move_in_date) AS latest FROM s_yardi_leases)",
)(
    lambda t: m.move_out_rate(
        t.residents,
        "resident_id",
        "discharge_date",
        t.silver("yardi_leases", dedupe=None).agg(F.max("move_in_date")).scalar(),
    )
)
register(
    "measure_incident_rate",
    "SELECT incident_count, residents * days AS resident_days, incident_count * 100.0::DOUBLE / (residents * days) "
    "AS incident_rate_per_100 FROM (SELECT (SELECT count(*) FROM fact_incidents) AS incident_count, "
    "(SELECT count(DISTINCT resident_key) FROM fact_revenue) AS residents, (SELECT count(*) FROM dim_date) AS days)",
)(lambda t: m.incident_rate(t.incidents, t.revenue, t.dates))
register(
    "measure_rolling_90d_revenue",
    "SELECT community_key, day, round(revenue, 2) AS revenue, round(sum(revenue) OVER (PARTITION BY community_key "
    "ORDER BY day RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW), 2) AS rolling_90d_revenue FROM (SELECT "
    "community_key, date_key AS day, sum(monthly_rate) AS revenue FROM fact_revenue GROUP BY ALL)",
)(
    lambda t: m.rolling_revenue(t.revenue, "date_key", "monthly_rate", ["community_key"]).select(
        "community_key",
        "day",
        round2("revenue").alias("revenue"),
        round2("rolling_90d_revenue").alias("rolling_90d_revenue"),
    )
)
register(
    "measure_community_revenue",
    "SELECT community_key, round(sum(monthly_rate), 2) AS revenue, 0 AS is_total FROM fact_revenue GROUP BY community_key "
    "UNION ALL SELECT NULL, round(sum(monthly_rate), 2), 1 FROM fact_revenue",
)(
    lambda t: m.revenue_by_group(t.revenue, "community_key", "monthly_rate").withColumn("revenue", round2("revenue"))
)
register(
    "measure_avg_rating",
    "SELECT community_key, avg(rating) AS avg_rating FROM fact_reviews GROUP BY community_key",
)(lambda t: m.average_rating(t.reviews, by=["community_key"]))

# census from stays: the corrected forms of occupancy, average census and resident-days

_FIRST = "(SELECT min(admit_date) FROM s_pcc_residents WHERE discharge_date IS NULL OR discharge_date >= admit_date)"
_LAST = (
    "(SELECT max(greatest(admit_date, coalesce(discharge_date, admit_date))) FROM s_pcc_residents "
    "WHERE discharge_date IS NULL OR discharge_date >= admit_date)"
)
_DAILY = f"""
SELECT community_id, day, count(*) AS census
FROM (SELECT unnest(generate_series({_FIRST}, {_LAST}, INTERVAL 1 DAY))::DATE AS day)
JOIN s_pcc_residents ON admit_date <= day AND (discharge_date IS NULL OR discharge_date >= day)
WHERE discharge_date IS NULL OR discharge_date >= admit_date GROUP BY ALL"""


def _valid_stays(t: Layers) -> DataFrame:
    return t.silver("pcc_residents").filter("discharge_date IS NULL OR discharge_date >= admit_date")


def _span(t: Layers):
    """First and last day that the stays have."""
    day = F.greatest("admit_date", F.coalesce("discharge_date", "admit_date"))
    first, last = _valid_stays(t).agg(F.min("admit_date"), F.max(day)).first()
    return F.lit(first).cast("date"), F.lit(last).cast("date")


register("census_daily", _DAILY)(
    lambda t: daily_census(
        census_intervals(_valid_stays(t), ["community_id"], "admit_date", "discharge_date"), ["community_id"], *_span(t)
    ).filter("census > 0")
)
register(
    "census_average",
    f"SELECT community_id, CAST(sum(census) AS BIGINT) AS resident_days, sum(census)::DOUBLE / "
    f"({_LAST} - {_FIRST} + 1) AS avg_daily_census FROM ({_DAILY}) GROUP BY community_id",
)(
    lambda t: resident_days(
        census_intervals(_valid_stays(t), ["community_id"], "admit_date", "discharge_date"), ["community_id"], *_span(t)
    )
)
register(
    "census_occupancy",
    f"SELECT community_id, day, census, units, round(100.0::DOUBLE * census / units, 2) AS occupancy_rate_pct "
    f"FROM ({_DAILY}) JOIN (SELECT community_id, count(DISTINCT unit_id) AS units FROM s_yardi_units "
    "GROUP BY community_id) USING (community_id)",
)(
    lambda t: v.census_occupancy(_valid_stays(t), t.silver("yardi_units", dedupe=None), *_span(t)).filter("census > 0")
)

# report pages

register(
    "page_revenue_by_region",
    "SELECT region, round(sum(monthly_rate), 2) AS revenue, count(DISTINCT resident_key) AS resident_count "
    "FROM fact_revenue JOIN dim_community USING (community_key) LEFT JOIN dim_community_region USING (community_id) "
    "GROUP BY region",
)(lambda t: m.revenue_by_region(t.revenue, t.communities, t.regions).withColumn("revenue", round2("revenue")))
register(
    "page_leads_by_source_and_status",
    "SELECT lead_source, status, count(*) AS row_count FROM fact_leads GROUP BY ALL",
)(lambda t: m.pair_counts(t.leads, "lead_source", "status"))
register(
    "page_labor_cost_by_role",
    "SELECT role, sum(labor_cost) AS labor_cost FROM fact_labor JOIN dim_employee USING (employee_key) GROUP BY role",
)(lambda t: m.labor_cost_by_role(t.labor, t.employees))
register("page_incident_severity", "SELECT severity, count(*) AS row_count FROM fact_incidents GROUP BY severity")(
    lambda t: m.value_counts(t.incidents, "severity")
)
register(
    "page_lease_metrics",
    "SELECT region, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month, "
    "round(sum(monthly_rate::DECIMAL(18,4))::DOUBLE / count(monthly_rate), 2) AS avg_monthly_rent, "
    "round(sum(monthly_rate::DECIMAL(18,4))::DOUBLE, 2) AS revenue, count(*) AS leases "
    "FROM fact_revenue JOIN dim_community USING (community_key) LEFT JOIN dim_community_region USING (community_id) "
    "GROUP BY ALL",
)(
    lambda t: m.lease_metrics(t.revenue, t.dates, t.communities, t.regions)
)
register(
    "page_lease_duration_buckets",
    "SELECT CASE WHEN lease_duration_days <= 30 THEN '0-30' WHEN lease_duration_days <= 90 THEN '31-90' "
    "WHEN lease_duration_days <= 180 THEN '91-180' WHEN lease_duration_days <= 365 THEN '181-365' "
    "WHEN lease_duration_days > 365 THEN '366+' END AS duration_bucket, count(*) AS row_count "
    "FROM fact_revenue GROUP BY ALL",
)(lambda t: m.duration_buckets(t.revenue, "lease_duration_days"))
register(
    "page_trends",
    "SELECT community_id, year, month, total_units, occupied_units, round(revenue, 2) AS revenue, incidents, avg_daily_census, "
    "incidents * 100.0::DOUBLE / (avg_daily_census * days) AS incident_rate_per_100 FROM v_occupancy "
    "FULL JOIN (SELECT community_id, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month, "
    "sum(monthly_rate) AS revenue, count(DISTINCT resident_key) AS avg_daily_census FROM fact_revenue JOIN dim_community "
    "USING (community_key) GROUP BY ALL) "
    "USING (community_id, year, month) FULL JOIN (SELECT community_id, CAST(year(date_key) AS INTEGER) AS year, "
    "CAST(month(date_key) AS INTEGER) AS month, count(*) AS incidents FROM fact_incidents JOIN dim_community "
    "USING (community_key) GROUP BY ALL) USING (community_id, year, month) LEFT JOIN (SELECT CAST(year AS INTEGER) AS year, "
    "CAST(month AS INTEGER) AS month, count(*) AS days FROM dim_date GROUP BY ALL) USING (year, month)",
)(
    lambda t: m.monthly_trends(t.occupancy, t.revenue, t.incidents, t.dates, t.communities).withColumn(
        "revenue", round2("revenue")
    )
)
register(
    "page_trends_of_a_community_and_month",
    "SELECT community_id, year, month, total_units, occupied_units FROM v_occupancy WHERE community_id = 'C003' AND month = 4",
)(
    lambda t: m.slice_rows(
        m.monthly_trends(t.occupancy, t.revenue, t.incidents, t.dates, t.communities), community_id="c003", month=4
    )
    .filter("total_units IS NOT NULL")
    .select("community_id", "year", "month", "total_units", "occupied_units")
)
register(
    "validation_expected_dedupe",
    "SELECT 'Row Count - dim_resident' AS \"Check\", CASE WHEN s = g THEN 'PASS' ELSE 'FAIL' END AS \"Status\", "
    "'Silver=' || s || ', Gold=' || g AS \"Details\" FROM (SELECT (SELECT count(*) FROM s_pcc_residents) AS s, "
    "(SELECT count(*) FROM dim_resident) AS g)",
)(
    lambda t: val.validate(*_tables(t), as_of=AS_OF, expected_dedupe=("pcc_residents",))
    .filter(F.col("Check") == "Row Count - dim_resident")
    .select("Check", "Status", "Details")
)
register(
    "page_monthly_trends",
    f"SELECT year, month, CAST(sum(total_units) AS BIGINT) AS total_units, CAST(sum(occupied_units) AS BIGINT) AS "
    "occupied_units FROM v_occupancy SEMI JOIN dim_community_region USING (community_id) WHERE year = 1997 "
    "GROUP BY year, month",
)(
    lambda t: m.slice_rows(t.occupancy_view().join(t.regions, "community_id"), year=1997)
    .groupBy("year", "month")
    .agg(F.sum("total_units").alias("total_units"), F.sum("occupied_units").alias("occupied_units"))
)
