"""The eight raw feeds, derived row by row from the benchmark tables.

Every source row becomes one raw row, so the feeds grow with the tables. The expressions are plain SQL that
Spark and DuckDB both understand; the oracle reads the same text. Raw values are text and deliberately untidy:
padded ids, mixed-case roles, ``/`` in dates, unreadable dates, blank and missing answers, late loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _id(prefix: str, key: str) -> str:
    return f"'{prefix}' || cast({key} as string)"


def _community(key: str) -> str:
    """19 communities: the 14 mapped ones and 5 that no region lists."""
    return f"'C' || lpad(cast({key} % 19 + 1 as string), 3, '0')"


def _day(column: str) -> str:
    return f"cast(cast({column} as date) as string)"


def _plus(column: str, days: str) -> str:
    return f"cast(cast({column} as date) + cast({days} as int) as string)"


def _lineage(feed: str, column: str, late: str = "0") -> dict[str, str]:
    month = f"replace(substr({_day(column)}, 1, 7), '-', '_')"
    return {
        "source_file": f"'{feed}_' || {month} || '.csv'",
        "ingestion_timestamp": f"cast(cast({column} as date) + cast({late} as int) as timestamp)",
    }


_RATES = (
    "replace('{~Caregiver~: ' || cast(10 + l_linenumber as string) || ', ~RN~: ' || "
    "cast(30 + l_linenumber as string) || '.5, ~Med Tech~: ' || "
    "CASE WHEN l_partkey % 5 = 0 THEN 'None' ELSE cast(20 + l_linenumber as string) END || '}', '~', chr(39))"
)

#: feed -> (table, {column: expression})
DERIVED = {
    "adp_shifts": (
        "lineitem",
        {
            "shift_id": "' S' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || ' '",
            "community_id": _community("l_suppkey"),
            "employee_id": _id("E", "l_suppkey"),
            "role": "CASE l_returnflag WHEN 'A' THEN 'caregiver ' WHEN 'N' THEN 'RN' ELSE ' med tech' END",
            "shift_date": _day("l_shipdate"),
            "hours_worked": "CASE WHEN l_partkey % 200 = 0 THEN '-' ELSE '' END || cast(l_quantity as string)",
            "hourly_rate": _RATES,
            **_lineage("adp_shifts", "l_shipdate"),
        },
    ),
    "gbp_reviews": (
        "events",
        {
            "review_id": _id("G", "event_id"),
            "community_id": _community("user_id"),
            "review_date": _day("ts"),
            "rating": "cast(event_id % 6 as string)",
            "review_text": "' ' || event_type || ' visit '",
            "response_text": "CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '   ' "
            "ELSE 'Thanks for the ' || event_type END",
            "responded_at": f"CASE event_type WHEN 'error' THEN NULL ELSE {_plus('ts', 'event_id % 10')} END",
            **_lineage("gbp_reviews", "ts"),
        },
    ),
    "hubspot_leads": (
        "events",
        {
            "lead_id": _id("H", "event_id"),
            "community_id": _community("event_id"),
            "lead_source": "' ' || event_type",
            "created_date": f"CASE event_id % 10 WHEN 0 THEN 'unknown' WHEN 1 THEN replace({_day('ts')}, '-', '/') "
            f"ELSE {_day('ts')} END",
            "tour_date": f"CASE WHEN event_id % 2 = 0 THEN {_plus('ts', '3')} END",
            "deposit_date": f"CASE WHEN event_id % 5 = 0 THEN {_plus('ts', '9')} END",
            "move_in_date": f"CASE WHEN event_id % 5 = 0 THEN {_plus('ts', '20')} END",
            "status": "CASE event_id % 3 WHEN 0 THEN 'Won ' WHEN 1 THEN 'lost' ELSE 'Open' END",
            "lost_reason": "CASE WHEN event_id % 3 = 1 THEN ' Price ' END",
            **_lineage("hubspot_leads", "ts"),
        },
    ),
    "pcc_care_history": (
        "orders",
        {
            "resident_id": _id("R", "o_custkey"),
            "change_date": _day("o_orderdate"),
            "previous_level": "CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN 'AL' ELSE 'IL' END",
            "new_level": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'MC' "
            "WHEN o_orderpriority = '3-MEDIUM' THEN ' AL' ELSE 'IL' END",
            "reason": "CASE o_orderstatus WHEN 'F' THEN 'Admission' ELSE ' Acuity Increase' END",
            **_lineage("pcc_care_history", "o_orderdate"),
        },
    ),
    "pcc_incidents": (
        "lineitem",
        {
            "incident_id": "'I' || cast(l_orderkey as string) || '-' || cast(l_partkey as string)",
            "resident_id": _id("R", "l_partkey"),
            "community_id": _community("l_suppkey"),
            "incident_date": _day("l_shipdate"),
            "incident_type": "CASE l_returnflag WHEN 'A' THEN 'Fall' WHEN 'N' THEN 'Skin Tear ' ELSE 'Other' END",
            "severity": "cast(l_linenumber as string)",
            "reported_by": _id("E", "l_suppkey"),
            **_lineage("pcc_incidents", "l_shipdate"),
        },
    ),
    "pcc_residents": (
        "orders",
        {
            "resident_id": _id(" R", "o_custkey"),
            "community_id": _community("o_custkey"),
            "first_name": "'First' || cast(o_custkey as string) || ' '",
            "last_name": "'Last' || cast(o_orderkey as string)",
            "dob": _plus("o_orderdate", "-30000 + o_custkey % 1000"),
            "gender": "CASE WHEN o_custkey % 2 = 0 THEN 'f ' ELSE 'M' END",
            "admit_date": _day("o_orderdate"),
            "discharge_date": "CASE WHEN o_orderstatus = 'O' THEN NULL "
            f"ELSE {_plus('o_orderdate', 'o_orderkey % 300 - 2')} END",
            "care_level": "CASE o_orderpriority WHEN '1-URGENT' THEN ' il ' WHEN '2-HIGH' THEN 'Assisted' "
            "WHEN '3-MEDIUM' THEN 'memory care' WHEN '5-LOW' THEN ' Respite ' ELSE 'Independent Living' END",
            "acuity_score": "cast(o_orderkey % 7 as string)",
            "mobility_status": "o_orderstatus",
            **_lineage("pcc_residents", "o_orderdate", "o_orderkey % 90"),
        },
    ),
    "yardi_leases": (
        "orders",
        {
            "lease_id": _id("L", "o_orderkey"),
            "resident_id": _id("R", "o_custkey"),
            "unit_id": _id("U", "o_custkey"),
            "community_id": _community("o_custkey"),
            "move_in_date": _day("o_orderdate"),
            "move_out_date": "CASE WHEN o_orderstatus = 'O' THEN NULL "
            f"ELSE {_plus('o_orderdate', 'o_orderkey % 400')} END",
            "move_out_reason": "CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN ' Financial ' "
            "ELSE o_orderpriority END",
            "monthly_rate": "cast(o_totalprice as string)",
            **_lineage("yardi_leases", "o_orderdate"),
        },
    ),
    "yardi_units": (
        "lineitem",
        {
            "unit_id": _id("U", "l_partkey"),
            "community_id": _community("l_suppkey"),
            "unit_type": "CASE l_partkey % 3 WHEN 0 THEN 'IL ' WHEN 1 THEN 'AL' ELSE 'MC' END",
            "monthly_rent": "CASE WHEN l_returnflag = 'R' THEN '0' ELSE cast(900 + l_partkey % 50 as string) END",
            "snapshot_date": f"substr({_day('l_shipdate')}, 1, 8) || '01'",
            **_lineage("yardi_units", "l_shipdate"),
        },
    ),
}

#: Fixed run date, so that open leases have one length on every day the workload runs.
AS_OF = "2025-06-30"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derive(source: DataFrame, feed: str) -> DataFrame:
    """The raw rows of a feed from its source table."""
    return source.selectExpr(*[f"{expr} AS {name}" for name, expr in DERIVED[feed][1].items()])


def bronze(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return derive(load(spark, sf_dir, DERIVED[feed][0]), feed)


def bronze_sql(feed: str) -> str:
    """The same feed as a SQL query."""
    table, columns = DERIVED[feed]
    return f"SELECT {', '.join(f'{expr} AS {name}' for name, expr in columns.items())} FROM {table}"
