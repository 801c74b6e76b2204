"""Writers: tables, exports, reports and the run log."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carelens.operators.quality import summarise

#: Jobs that write tables at the same time; they share the cluster's slots.
WRITERS = 4


def replace_table(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), metrics: dict[str, Column] | None = None, measured: dict | None = None
) -> DataFrame:
    """Write a table, replacing it, and return it read back from Parquet (with true size statistics).

    ``metrics`` are aggregates of its rows, taken while the rows are written and put into ``measured`` by name. They are gathered in the
    tasks that write, of which each counts once, however often it is tried.
    """
    observation = Observation() if metrics else None
    observed = df.observe(observation, *[metric.alias(name) for name, metric in metrics.items()]) if metrics else df
    writer = observed.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if metrics:
        measured.update(observation.get)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_tables(
    tables: dict[str, DataFrame], out: str, prefixes: tuple[str, ...] = ("dim_", "fact_")
) -> list[str]:
    """Export the dimension and fact tables as Parquet folders, side by side; returns their names."""
    chosen = sorted(name for name in tables if name.startswith(prefixes))
    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(lambda n: tables[n].write.mode("overwrite").parquet(f"{out}/{n}.parquet"), chosen))
    return chosen


def export_by_month(df: DataFrame, day: str, path: str) -> DataFrame:
    """Export a fact under ``year=/month=`` folders of its date column and return the exported table.

    Only the months that ``df`` holds are replaced, so a month can be exported again alone; rows without a date have a folder of their
    own. Months are balanced by Spark before they are written: a large one is split over tasks, small ones share a task.
    """
    dated = df.withColumns({"year": F.year(day), "month": F.month(day)})
    writer = dated.hint("rebalance", "year", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year", "month").parquet(path)
    return df.sparkSession.read.schema(dated.schema).parquet(path)


def in_months(exported: DataFrame, dates: DataFrame) -> DataFrame:
    """The rows of an exported fact in the months (columns year and month) of ``dates``. The months found there prune the folders that are
    read, while the query runs."""
    months = dates.select("year", "month").distinct()
    return exported.join(months, ["year", "month"]).select(*exported.columns)


def export_catalog_tables(spark: SparkSession, out: str, prefixes=("dim_", "fact_")) -> list[str]:
    """The same for tables and views of the session's current database."""
    names = [t.name for t in spark.catalog.listTables()]
    return export_tables({n: spark.table(n) for n in names if n.startswith(tuple(prefixes))}, out)


def export_checks(results: DataFrame, out: str) -> None:
    """Check results as CSV and JSON, and their summary as JSON."""
    results.write.mode("overwrite").option("header", True).csv(f"{out}/validation_summary_csv")
    results.write.mode("overwrite").json(f"{out}/validation_report_json")
    summarise(results).write.mode("overwrite").json(f"{out}/validation_summary_json")


RUN_LOG_SCHEMA = (
    "run_id string, run_timestamp string, status string, files_processed long, files_skipped long, "
    "rows_loaded map<string,long>, rows_rejected map<string,long>, tables_loaded map<string,long>, "
    "duration_seconds double, finished_at string, error string"
)


def append_run_log(spark: SparkSession, row: dict, path: str) -> None:
    """Append one run's facts as a JSON row."""
    spark.createDataFrame([row], RUN_LOG_SCHEMA).write.mode("append").json(path)
