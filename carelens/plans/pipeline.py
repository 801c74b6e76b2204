"""The whole run: ingest, silver, gold, views, validation, export, run log.

Tables are written between layers, so that no later job parses CSV again and every join sees true table sizes.
Tables of one layer that do not depend on each other are written side by side.

Each run writes its silver and gold tables to ``runs/<run id>``. Readers open the last run whose log row says
SUCCESS (:func:`open_latest`), so they never see a half-written run, and a rerun does not delete files under them.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.operators.keys import dense_key, kept_key
from carelens.operators.quality import quarantine, row_count
from carelens.plans import gold as g
from carelens.plans.silver import CLEANERS, repeated_rows, unreadable_rules
from carelens.plans.validation import GOLD_OF_FEED, layer_metrics, validate
from carelens.plans.views import build_views
from carelens.sources.export import RUN_LOG_SCHEMA, WRITERS, append_run_log, export_checks, export_tables, replace_table
from carelens.sources.feeds import FEEDS
from carelens.sources.reference_data import dim_community_region
from carelens.streaming.ingest import MAX_FILES, ingest, processed_files, read_bronze, read_refused


@dataclass
class Tables:
    """The tables of a run, by name; bronze and silver tables go by their feed's name."""

    bronze: dict[str, DataFrame] = field(default_factory=dict)
    silver: dict[str, DataFrame] = field(default_factory=dict)
    gold: dict[str, DataFrame] = field(default_factory=dict)
    views: dict[str, DataFrame] = field(default_factory=dict)
    checks: DataFrame | None = None


def write_all(
    builders: dict[str, Callable[[], DataFrame]], folder: str, metrics: dict[str, dict[str, Column]] | None = None, measured: dict | None = None
) -> dict[str, DataFrame]:
    """Build and write independent tables side by side; returns them read back. ``metrics`` of a table go into ``measured``."""
    metrics = metrics or {}

    def write(name: str) -> DataFrame:
        return replace_table(builders[name](), f"{folder}/{name}", metrics=metrics.get(name), measured=measured)

    with ThreadPoolExecutor(WRITERS) as pool:
        pending = {name: pool.submit(write, name) for name in builders}
        return {name: job.result() for name, job in pending.items()}


def accepted_rows(
    bronze: dict[str, DataFrame], folder: str, measured: dict | None = None
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Raw rows that can be cleaned, and the others, which are written under ``folder`` with the rules they break."""
    split = {feed: quarantine(bronze[feed], unreadable_rules(feed)) for feed in FEEDS}
    counts = {feed: {f"Rejected_{feed}": row_count()} for feed in FEEDS} if measured is not None else None
    refused = write_all({feed: lambda feed=feed: split[feed][1] for feed in FEEDS}, folder, counts, measured)
    return {feed: kept for feed, (kept, _) in split.items()}, refused


def build_silver(
    bronze: dict[str, DataFrame], folder: str, corrected: bool = False, metrics: dict[str, dict[str, Column]] | None = None, measured: dict | None = None
) -> dict[str, DataFrame]:
    """Clean and write every feed; text that is not a number fails the job.

    ``corrected`` counts rows repeated in several files once and orders resident snapshots by their month.
    """

    def build(feed: str) -> DataFrame:
        if feed == "pcc_residents":
            return CLEANERS[feed](bronze[feed], by_snapshot_month=corrected)
        return CLEANERS[feed](bronze[feed], dedupe=_dedupe_of(corrected))

    return write_all({f"silver_{feed}": lambda feed=feed: build(feed) for feed in FEEDS}, folder, metrics, measured)


def _dedupe_of(corrected: bool) -> str:
    return "business" if corrected else "rows"


def build_gold(
    spark: SparkSession, silver: dict[str, DataFrame], folder: str, as_of=None, corrected: bool = False, keys: str | None = None,
    metrics: dict[str, dict[str, Column]] | None = None, measured: dict | None = None,
) -> dict[str, DataFrame]:
    """Write the star schema: independent dimensions first, then residents, then all facts.

    With ``keys``, a folder, the numbers of communities, residents and employees stay from run to run. Rows of the history are numbered anew:
    a later change closes an interval, which is then another row.
    """
    keyed = kept_key(keys) if keys else dense_key
    dims = write_all(
        {
            "dim_community": lambda: g.dim_community(silver, keyed),
            "dim_resident_scd": lambda: g.dim_resident_scd(silver["pcc_care_history"]),
            "dim_date": lambda: g.dim_date(silver, corrected),
            "dim_employee": lambda: g.dim_employee(silver["adp_shifts"], keyed),
            "dim_community_region": lambda: dim_community_region(spark),
        },
        folder, metrics, measured,
    )
    communities, dates = dims["dim_community"], dims["dim_date"]
    dims |= write_all({"dim_resident": lambda: g.dim_resident(silver["pcc_residents"], communities, keyed)}, folder, metrics, measured)
    residents = dims["dim_resident"]
    facts = write_all(
        {
            "fact_labor": lambda: g.fact_labor(
                silver["adp_shifts"], communities, dims["dim_employee"], dates, match_role=corrected
            ),
            "fact_reviews": lambda: g.fact_reviews(silver["gbp_reviews"], communities, dates),
            "fact_leads": lambda: g.fact_leads(silver["hubspot_leads"], communities, dates),
            "fact_revenue": lambda: g.fact_revenue(silver["yardi_leases"], residents, communities, dates, as_of),
            "fact_occupancy": lambda: g.fact_occupancy(silver["yardi_units"], communities, dates),
            "fact_incidents": lambda: g.fact_incidents(silver["pcc_incidents"], residents, communities, dates),
        },
        folder, metrics, measured,
    )
    return dims | facts


GOLD_TABLES = (
    "dim_community", "dim_resident", "dim_resident_scd", "dim_date", "dim_employee", "dim_community_region",
    "fact_labor", "fact_reviews", "fact_leads", "fact_revenue", "fact_occupancy", "fact_incidents",
)


def publish_views(tables: Tables) -> None:
    """Build the KPI views and register them in the session by name."""
    tables.views = build_views(tables.silver, tables.gold)
    for name, view in tables.views.items():
        view.createOrReplaceTempView(name)


def open_latest(spark: SparkSession, root: str) -> Tables:
    """The tables and views of the last successful run."""
    runs = spark.read.schema(RUN_LOG_SCHEMA).json(f"{root}/logs/pipeline_run").filter("status = 'SUCCESS'")
    newest = runs.orderBy(F.col("finished_at").desc()).select("run_id").first()
    if newest is None:
        raise LookupError(f"no successful run under {root}")
    home = f"{root}/runs/{newest['run_id']}"
    tables = Tables(
        bronze={feed: read_bronze(spark, f"{root}/bronze", feed) for feed in FEEDS},
        silver={feed: spark.read.parquet(f"{home}/silver/silver_{feed}") for feed in FEEDS},
        gold={name: spark.read.parquet(f"{home}/gold/{name}") for name in GOLD_TABLES},
        checks=spark.read.parquet(f"{home}/checks"),
    )
    publish_views(tables)
    return tables


def run_pipeline(
    spark: SparkSession,
    raw: str,
    root: str,
    as_of=None,
    corrected: bool = False,
    export_to: str | None = None,
    quarantine_rows: bool = False,
    max_files_per_batch: int = MAX_FILES,
    stable_keys: bool = False,
) -> Tables:
    """Load new files from ``raw`` and rebuild everything under ``root`` (both on shared storage).

    A failure is recorded in the run log and raised. ``rows_rejected`` counts, per feed, the delivered rows whose cells do not fit their
    header, which never reach a raw table, and the quarantined ones. With ``stable_keys`` dimension numbers are kept under
    ``keys``, so that facts of different runs can be joined.
    """
    started, run_id = time.time(), uuid.uuid4().hex
    log = {
        "run_id": run_id,
        "run_timestamp": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
        "status": "SUCCESS",
        "files_processed": 0,
        "files_skipped": 0,
        "rows_loaded": {},
        "rows_rejected": {},
        "tables_loaded": {},
        "duration_seconds": None,
        "finished_at": None,
        "error": None,
    }
    tables, home = Tables(), f"{root}/runs/{run_id}"
    try:
        begun = spark.range(1).select(F.current_timestamp().alias("t")).first()["t"]
        ingest(spark, raw, f"{root}/bronze", f"{root}/checkpoints", max_files_per_batch=max_files_per_batch)
        tables.bronze = {feed: read_bronze(spark, f"{root}/bronze", feed) for feed in FEEDS}
        broken = {feed: read_refused(spark, f"{root}/bronze", feed) for feed in FEEDS}
        ledger = replace_table(processed_files(tables.bronze, broken), f"{home}/processed_files")
        is_new = F.col("processed_at") >= F.lit(begun)
        per_feed = ledger.groupBy("dataset").agg(
            F.count_if(is_new).alias("new"),
            F.count_if(~is_new).alias("seen"),
            F.coalesce(F.sum(F.when(is_new, F.col("rows_loaded"))), F.lit(0)).alias("loaded"),
            F.sum("rows_loaded").alias("held"),
            F.sum("rows_rejected").alias("rejected"),
        )
        for row in per_feed.collect():  # one row per feed
            log["files_processed"] += row["new"]
            log["files_skipped"] += row["seen"]
            log["rows_loaded"][row["dataset"]] = row["loaded"]
            log["tables_loaded"][row["dataset"]] = row["held"]
            if row["rejected"]:
                log["rows_rejected"][row["dataset"]] = row["rejected"]

        # what the checks need of a table is taken while it is written; the ledger has counted the raw rows
        measured = {f"Bronze_{feed}": log["tables_loaded"].get(feed, 0) for feed in FEEDS}
        accepted, refused = tables.bronze, None
        if quarantine_rows:
            accepted, refused = accepted_rows(tables.bronze, f"{home}/quarantine", measured)
            for feed in FEEDS:
                log["rows_rejected"][feed] = log["rows_rejected"].get(feed, 0) + measured[f"Rejected_{feed}"]
        of_table = layer_metrics(as_of, adjusted=bool(refused or corrected))
        silver_metrics = {f"silver_{feed}": of_table["Silver", feed] for feed in GOLD_OF_FEED}
        gold_metrics = {table: of_table["Gold", feed] for feed, table in GOLD_OF_FEED.items()}
        silver = build_silver(accepted, f"{home}/silver", corrected, silver_metrics, measured)
        tables.silver = {name.removeprefix("silver_"): df for name, df in silver.items()}

        tables.gold = build_gold(spark, tables.silver, f"{home}/gold", as_of, corrected, f"{root}/keys" if stable_keys else None, gold_metrics, measured)
        publish_views(tables)
        expected = {}
        if refused or corrected:
            repeats = {f: repeated_rows(accepted[f], f, _dedupe_of(corrected)) for f in FEEDS if f != "pcc_residents"}
            expected = {"expected_dedupe": ("pcc_residents",), "rejected": refused or {}, "repeats": repeats}
        checks = validate(tables.bronze, tables.silver, tables.gold, as_of, measured=measured, **expected)
        tables.checks = replace_table(checks, f"{home}/checks")
        export_checks(tables.checks, f"{home}/reports")
        if export_to:
            export_tables(tables.gold, f"{export_to}/{run_id}")
    except Exception as error:
        log["status"], log["error"] = "FAILED", str(error)
        raise
    finally:
        log["duration_seconds"] = round(time.time() - started, 2)
        log["finished_at"] = datetime.now(timezone.utc).isoformat()
        append_run_log(spark, log, f"{root}/logs/pipeline_run")
    return tables
