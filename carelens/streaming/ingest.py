"""Incremental loading of unseen feed files.

The file source's checkpoint is the ledger of seen files. Each run processes what is new and stops. The stream carries file
names only; a batch reads its files once, by their headers, and is written to its own ``batch_id=N`` folder in overwrite mode,
so repeating a batch after a failure replaces the folder instead of adding rows: files and ledger cannot disagree.

A raw table is a version: rows under ``<feed>/<version>`` and a ledger of the same name. :func:`full_reload` loads everything into
a new version and then switches to it, ledger included, so a following ingest neither repeats nor loses a file.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carelens.sources.feeds import FEEDS, accepted, feed_pattern, landed_schema, refused, write_files

#: Files loaded in one batch; a run with more loads them in several.
MAX_FILES = 10_000
FIRST_VERSION = "first"
_FILES = "path string, modificationTime timestamp, length long, content binary"


def current_version(spark: SparkSession, bronze: str, feed: str) -> str:
    """The version that readers see: the last one switched to."""
    try:
        switched = spark.read.schema("at timestamp, version string").json(f"{bronze}/versions/{feed}")
        return switched.agg(F.max_by("version", "at")).first()[0] or FIRST_VERSION
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return FIRST_VERSION


def start_feed(
    spark: SparkSession,
    folder: str,
    bronze: str,
    checkpoints: str,
    feed: str,
    max_files_per_batch: int = MAX_FILES,
    pattern: str | None = None,
    line_breaks: bool | None = None,
    version: str | None = None,
) -> StreamingQuery:
    """Start loading the unseen files of one feed into a version (default: the current one); the query ends when they are loaded."""
    version = version or current_version(spark, bronze, feed)
    files = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", pattern or feed_pattern(feed))
    names = files.option("maxFilesPerTrigger", max_files_per_batch).load(folder).select("path", "length")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        sizes = {r["path"]: r["length"] for r in batch.collect()}  # at most max_files_per_batch names
        if sizes:
            write_files(batch.sparkSession, sizes, feed, f"{bronze}/{feed}/{version}/batch_id={batch_id}", line_breaks)

    return (
        names.writeStream.queryName(f"ingest_{feed}_{uuid.uuid4().hex}")
        .option("checkpointLocation", f"{checkpoints}/{feed}/{version}")
        .trigger(availableNow=True)
        .foreachBatch(write_batch)
        .start()
    )


def ingest(
    spark: SparkSession,
    folder: str,
    bronze: str,
    checkpoints: str,
    feeds=tuple(FEEDS),
    max_files_per_batch: int = MAX_FILES,
) -> None:
    """Load the unseen files of all feeds; the feeds run side by side."""
    running = [start_feed(spark, folder, bronze, checkpoints, f, max_files_per_batch) for f in feeds]
    for query in running:
        query.awaitTermination()


def full_reload(
    spark: SparkSession, folder: str, bronze: str, checkpoints: str, feeds=tuple(FEEDS), max_files_per_batch: int = MAX_FILES,
    pattern: str | None = None,
) -> None:
    """Replace the raw tables with the current content of the folder.

    Each feed is loaded into a fresh version with a ledger of its own. Only when all are complete do readers and later ingests
    switch; a reload that fails changes nothing.
    """
    version = uuid.uuid4().hex
    running = [start_feed(spark, folder, bronze, checkpoints, f, max_files_per_batch, pattern, version=version) for f in feeds]
    for query in running:
        query.awaitTermination()
    for feed in feeds:
        switched = spark.range(1).select(F.current_timestamp().alias("at"), F.lit(version).alias("version"))
        switched.write.mode("append").json(f"{bronze}/versions/{feed}")


def _landed(spark: SparkSession, bronze: str, feed: str) -> DataFrame:
    schema = landed_schema(feed)
    try:
        return spark.read.schema(schema).parquet(f"{bronze}/{feed}/{current_version(spark, bronze, feed)}").select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_bronze(spark: SparkSession, bronze: str, feed: str) -> DataFrame:
    """The raw table of a feed; empty when none of its files has arrived yet."""
    return accepted(_landed(spark, bronze, feed))


def read_refused(spark: SparkSession, bronze: str, feed: str) -> DataFrame:
    """The rows of a feed's files that could not be placed: source_file, ingestion_timestamp, problem, raw_line."""
    return refused(_landed(spark, bronze, feed))


def processed_files(tables: dict[str, DataFrame], rejected: dict[str, DataFrame] | None = None) -> DataFrame:
    """The ledger as a table: ``(file_name, dataset, processed_at, rows_loaded)``, derived from raw rows.

    With the refused rows of the feeds also ``rows_rejected``; a file of which every row was refused is then listed too.
    """

    def ledger(feed: str) -> DataFrame:
        marks = tables[feed].select("source_file", "ingestion_timestamp", F.lit(False).alias("bad"))
        if rejected is not None:
            marks = marks.unionAll(rejected[feed].select("source_file", "ingestion_timestamp", F.lit(True)))
        counts = [F.count_if(~F.col("bad")).alias("rows_loaded"), F.count_if("bad").alias("rows_rejected")]
        rows = marks.groupBy(F.col("source_file").alias("file_name")).agg(F.min("ingestion_timestamp").alias("processed_at"), *counts)
        return rows.select("file_name", F.lit(feed).alias("dataset"), "processed_at", "rows_loaded", *["rows_rejected"] * (rejected is not None))

    return reduce(DataFrame.unionByName, map(ledger, tables))


def repeated_loads(ledger_rows: DataFrame) -> DataFrame:
    """Files whose rows were loaded at more than one time (a file must be loaded once)."""
    return (
        ledger_rows.groupBy("source_file")
        .agg(F.count_distinct("ingestion_timestamp").alias("loads"))
        .filter("loads > 1")
    )


def file_count_differences(loaded: DataFrame, delivered: DataFrame) -> DataFrame:
    """Files whose loaded row count differs from the delivered one, both counted per ``source_file``.

    ``delivered`` is a fresh batch read of the folder. Repeated loads, lost files and changed files all show.
    """
    rows = F.count(F.lit(1))
    ours = loaded.groupBy("source_file").agg(rows.alias("loaded"))
    theirs = delivered.groupBy("source_file").agg(rows.alias("delivered"))
    merged = ours.join(theirs, "source_file", "full").fillna(0, ["loaded", "delivered"])
    return merged.filter("loaded <> delivered")
