"""The monthly CSV feeds: names, schemas, discovery and batch reading."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Feed name (also the file name prefix) -> columns. The first column is the business key.
FEEDS = {
    "adp_shifts": (
        "shift_id", "community_id", "employee_id", "role", "shift_date", "hours_worked", "hourly_rate",
    ),
    "gbp_reviews": (
        "review_id", "community_id", "review_date", "rating", "review_text", "response_text", "responded_at",
    ),
    "hubspot_leads": (
        "lead_id", "community_id", "lead_source", "created_date", "tour_date", "deposit_date", "move_in_date",
        "status", "lost_reason",
    ),
    "pcc_care_history": ("resident_id", "change_date", "previous_level", "new_level", "reason"),
    "pcc_incidents": (
        "incident_id", "resident_id", "community_id", "incident_date", "incident_type", "severity",
        "reported_by",
    ),
    "pcc_residents": (
        "resident_id", "community_id", "first_name", "last_name", "dob", "gender", "admit_date",
        "discharge_date", "care_level", "acuity_score", "mobility_status",
    ),
    "yardi_leases": (
        "lease_id", "resident_id", "unit_id", "community_id", "move_in_date", "move_out_date",
        "move_out_reason", "monthly_rate",
    ),
    "yardi_units": ("unit_id", "community_id", "unit_type", "monthly_rent", "snapshot_date"),
}

#: Columns added to every raw row.
LINEAGE = ("source_file", "ingestion_timestamp")

#: Columns beside them that say why a row was refused, and the row as it was delivered; NULL in accepted rows.
REFUSAL = ("problem", "raw_line")

#: Feeds whose quoted text may contain line breaks. Their files are read whole, one task per file, unless the delivery is
#: declared to be free of them (``line_breaks=False``).
FREE_TEXT_FEEDS = frozenset({"gbp_reviews"})

#: Bytes from which on a file's header is read by a job of its own, rather than in one scan of all lines of many files.
LARGE_FILE = 16 << 20


def feed_schema(feed: str) -> T.StructType:
    """All feed columns as text: raw data is kept as delivered and typed later."""
    return T.StructType([T.StructField(c, T.StringType()) for c in FEEDS[feed]])


def bronze_schema(feed: str) -> T.StructType:
    return feed_schema(feed).add("source_file", T.StringType()).add("ingestion_timestamp", T.TimestampType())


def landed_schema(feed: str) -> T.StructType:
    """Raw rows and, beside them, those that were refused."""
    schema = bronze_schema(feed)
    for name in REFUSAL:
        schema = schema.add(name, T.StringType())
    return schema


def normalise_header(name: str | Column) -> str | Column:
    """Strip, lower-case, and turn blanks and dashes into underscores; for a name or a column of names."""
    if isinstance(name, Column):
        return F.translate(F.lower(F.trim(name)), " -", "__")
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def standardise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_header(c) for c in df.columns])


def discover_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_name, feed, length, modified)`` of every CSV file; ``feed`` is NULL for files to skip.

    Only the listing is read, not the contents.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    feed = F.coalesce(*[F.when(name.startswith(f), F.lit(f)) for f in FEEDS])
    return files.select(
        name.alias("file_name"), feed.alias("feed"), "length", F.col("modificationTime").alias("modified")
    )


def feed_pattern(feed: str) -> str:
    return f"{feed}_*.csv"


def profile_files(spark: SparkSession, folder: str, sample: int = 3) -> DataFrame:
    """One row per CSV file: file_name, feed, row_count, column_count, column_names, samples (its first lines of data), problem.

    A file of no known feed, and one whose header lacks the feed's key, is reported in ``problem`` and not counted. Rows
    are counted as the feed's reader sees them; samples come from the first block of a file.
    """
    files = discover_files(spark, folder)
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    )
    ranked = lines.filter("block = 0 AND trim(value) <> ''").withColumn("line", F.row_number().over(W.partitionBy("file_name").orderBy("at")))
    first = ranked.filter(F.col("line") <= sample + 1).groupBy("file_name").agg(F.sort_array(F.collect_list(F.struct("line", "value"))).alias("lines"))
    header = F.transform(F.split(F.regexp_replace(F.get("lines", F.lit(0))["value"], "^\ufeff", ""), ","), lambda n: normalise_header(F.replace(n, F.lit('"'))))
    known = files.join(first.select("file_name", header.alias("column_names"), F.transform(F.slice("lines", 2, sample), lambda x: x["value"]).alias("samples")), "file_name", "left")
    key = F.coalesce(*[F.when(F.col("feed") == f, F.lit(columns[0])) for f, columns in FEEDS.items()])
    problem = F.when(F.col("feed").isNull(), F.lit("no known feed")).when(
        ~F.coalesce(F.array_contains("column_names", key), F.lit(False)), F.concat(F.lit("no "), key, F.lit(" header"))
    )
    known = known.withColumn("problem", problem)
    readable = known.filter("problem IS NULL").select("feed").distinct().collect()  # at most one row per feed
    bad = {r["file_name"] for r in known.filter("problem IS NOT NULL AND feed IS NOT NULL").select("file_name").collect()}
    counts = [
        read_files(spark, folder, r["feed"], feed_pattern(r["feed"]), skip=bad).groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count")) for r in readable
    ]
    counted = reduce(DataFrame.union, counts) if counts else spark.createDataFrame([], "source_file string, row_count long")
    return known.join(counted, F.col("file_name") == F.col("source_file"), "left").select(
        "file_name", "feed", F.when(F.col("problem").isNull(), F.coalesce("row_count", F.lit(0))).alias("row_count"),
        F.when(F.col("column_names").isNotNull(), F.size("column_names")).alias("column_count"), "column_names", "samples", "problem",
    )


def csv_options(feed: str, line_breaks: bool | None = None) -> dict[str, str]:
    """Reader options of a feed; ``line_breaks`` says whether quoted text holds any (default: :data:`FREE_TEXT_FEEDS`)."""
    multi_line = feed in FREE_TEXT_FEEDS if line_breaks is None else line_breaks
    return {"header": "true", "enforceSchema": "true", "escape": '"', "multiLine": str(multi_line).lower(), "mode": "PERMISSIVE",
            "columnPruning": "false"}  # else cells are only counted where all columns are asked for



def header_layouts(lines: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Normalised header -> files, from a text read.

    A file's header is its first line that is not blank, whatever it says. Only the first block of a file is looked at, and one
    line per file reaches the driver, which lists the files for the read anyway.
    """
    return _by_header(_first_lines(lines))


def _first_lines(lines: DataFrame) -> list[tuple[str, str]]:
    at = lines.select(
        F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"), "value",
        F.col("_metadata.file_block_start").alias("block"),
    )
    first = at.filter("block = 0 AND trim(value) <> ''").groupBy("path").agg(F.min_by("value", "at").alias("line"))
    return [(unquote(path), line) for path, line in sorted(first.collect())]


def first_lines(spark: SparkSession, sizes: dict[str, int]) -> list[tuple[str, str]]:
    """The header lines of files whose sizes are known, as ``(file, line)``. A large file is read no further than its header, by a
    job of its own; the small ones are one scan."""

    def of_one(path: str) -> list[tuple[str, str]]:
        lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value", F.col("_metadata.file_block_start").alias("block"))
        return [(unquote(r["path"]), r["value"]) for r in lines.filter("block = 0 AND trim(value) <> ''").take(1)]

    large = sorted(path for path, size in sizes.items() if size >= LARGE_FILE)
    small = [path for path in sizes if sizes[path] < LARGE_FILE]
    with ThreadPoolExecutor(4) as pool:
        found = [line for lines in pool.map(of_one, large) for line in lines]
    return sorted(found + (_first_lines(spark.read.text(small)) if small else []))


def _by_header(lines: list[tuple[str, str]]) -> dict[tuple[str, ...], list[str]]:
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, line in lines:
        names = next(csv.reader([line.lstrip("\ufeff")]), [])
        layouts.setdefault(tuple(map(normalise_header, names)), []).append(path)
    return layouts


def read_layout(spark: SparkSession, paths: list[str] | str, names: tuple[str, ...], feed: str, options: dict[str, str]) -> DataFrame:
    """Files of one header, of any width, in one scan: the feed's columns by name (missing ones NULL) and ``source_file``."""
    _check_key(paths, names, feed)
    raw = spark.read.options(**options, columnNameOfCorruptRecord=_LINE).schema(_cells_schema(names)).csv(paths)
    columns = [(F.col(f"_c{names.index(c)}") if c in names else F.lit(None).cast("string")).alias(c) for c in FEEDS[feed]]
    key = F.col(f"_c{names.index(FEEDS[feed][0])}")
    return raw.select(*columns, F.col("_metadata.file_name").alias("source_file"), *_refusal(key, len(names)))


def _check_key(paths: list[str] | str, names: tuple[str, ...], feed: str) -> None:
    key = FEEDS[feed][0]
    if key not in names:
        some = paths if isinstance(paths, str) else ", ".join(p.rsplit("/", 1)[-1] for p in paths[:5])
        raise ValueError(f"no {key} header in {some}")


def _cells_schema(names: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))]).add(_LINE, T.StringType())


def _read_lines(spark: SparkSession, paths: list[str], headers: set[str], names: tuple[str, ...], feed: str, dropped: Observation) -> DataFrame:
    """What :func:`read_layout` gives for files without line breaks in cells, from their lines: one without quotes is cut at its
    commas, others are parsed. Lines of a first block that read like one of ``headers`` are left out and counted in ``dropped``."""
    _check_key(paths, names, feed)
    options = csv_options(feed, line_breaks=False) | {"columnNameOfCorruptRecord": _LINE}
    text, width = F.col("value"), len(names)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("block"))
    marked = lines.select("value", "source_file", ((F.col("block") == 0) & text.isin(sorted(headers))).alias("header")).observe(dropped, F.count_if("header").alias("lines"))
    # blank lines are no rows: for the CSV reader these hold nothing above U+0020
    rows = marked.filter(~F.col("header") & (F.contains(text, F.lit(",")) | F.rlike(text, F.lit(r"[^\x00-\x20]"))))
    quoted = F.contains(text, F.lit('"'))
    parsed = F.when(quoted, F.from_csv(text, _cells_schema(names).toDDL(), options))
    cut = rows.select("value", "source_file", parsed.alias("parsed"), F.when(~quoted, F.split(text, ",")).alias("cells"))

    def cell(i: int) -> Column:
        plain = F.get("cells", F.lit(i))
        return F.when(F.col("cells").isNull(), F.col(f"parsed._c{i}")).when(plain != "", plain)

    unfit = F.when(F.col("cells").isNull(), F.col(f"parsed.{_LINE}")).when(F.size("cells") != width, F.make_valid_utf8(text))
    columns = [(cell(names.index(c)) if c in names else F.lit(None).cast("string")).alias(c) for c in FEEDS[feed]]
    placed = cut.select(*columns, "source_file", unfit.alias(_LINE))
    return placed.select(*FEEDS[feed], "source_file", *_refusal(F.col(FEEDS[feed][0]), width))


#: The reader puts a row here as it was delivered if its cells are not as many as the header's.
_LINE = "_line"


def _refusal(key: Column, width: int) -> list[Column]:
    """:data:`REFUSAL` of a row read with ``width`` columns. Also a quote that opens a cell and never ends is a problem where it
    happens to leave the right number of cells."""
    bare = F.regexp_replace(_LINE, '"[^"]*"', "")
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    # the key is named too, because a scan of nothing but the reader's own column is not allowed
    seen = F.col(_LINE).isNotNull() & (F.coalesce(F.length(key), F.lit(0)) >= 0)
    problem = F.when(F.contains(bare, F.lit('"')), "unclosed quote").when(cells > width, "too many cells").when(cells < width, "too few cells")
    return [F.when(seen, F.coalesce(problem, F.lit("unreadable"))).alias("problem"), F.col(_LINE).alias("raw_line")]


def with_lineage(df: DataFrame, feed: str) -> DataFrame:
    return df.select(*FEEDS[feed], "source_file", F.current_timestamp().alias("ingestion_timestamp"), *REFUSAL)


def accepted(landed: DataFrame) -> DataFrame:
    """The raw rows that were not refused, without :data:`REFUSAL`."""
    return landed.filter("problem IS NULL").drop(*REFUSAL)


def refused(landed: DataFrame) -> DataFrame:
    """source_file, ingestion_timestamp, problem and raw_line of the refused rows."""
    return landed.filter("problem IS NOT NULL").select(*LINEAGE, *REFUSAL)


def read_files(
    spark: SparkSession, paths: list[str] | str, feed: str, pattern: str | None = None, line_breaks: bool | None = None,
    skip: frozenset[str] | set[str] = frozenset(),
) -> DataFrame:
    """The accepted rows of :func:`land_files`."""
    return accepted(land_files(spark, paths, feed, pattern, line_breaks, skip))


def land_files(
    spark: SparkSession, paths: list[str] | str, feed: str, pattern: str | None = None, line_breaks: bool | None = None,
    skip: frozenset[str] | set[str] = frozenset(),
) -> DataFrame:
    """Files (or folders) of one feed, each read by its own header, and the rows that cannot be placed.

    A row with more or fewer cells than its file's header, or with a quote that never ends, is refused: its cells cannot be told
    apart. Such rows are kept with their ``problem`` and ``raw_line``; no cell is cut off and none is made up.

    Headers are matched after :func:`normalise_header`, so order, case, width and extra columns may differ from file to file; of two
    equal names the first counts. Files with the same header are one scan; there are as many scans as different headers. A file
    without the feed's key column fails the read: its rows cannot be placed and must not vanish. File names in ``skip`` are passed
    over.
    """
    glob = {} if pattern is None else {"pathGlobFilter": pattern}
    layouts = header_layouts(spark.read.options(**glob).text(paths))
    if skip:
        wanted = {names: [f for f in files if f.rsplit("/", 1)[-1] not in skip] for names, files in layouts.items()}
        layouts = {names: files for names, files in wanted.items() if files}
    options = csv_options(feed, line_breaks) | glob
    if len(layouts) == 1 and not skip:
        found = [read_layout(spark, paths, *layouts, feed, options)]
    else:
        found = [read_layout(spark, files, names, feed, options) for names, files in layouts.items()]
    if not found:
        return spark.createDataFrame([], landed_schema(feed))
    return with_lineage(reduce(DataFrame.union, found), feed)


def write_files(spark: SparkSession, sizes: dict[str, int], feed: str, path: str, line_breaks: bool | None = None) -> None:
    """Write :func:`land_files` of files whose sizes are known to ``path``, in place of what is there.

    Lines are cut rather than parsed where cells hold no line breaks. A line of data that reads like a header cannot be told
    from it then; the number of lines left out shows whether there was any, and if so the CSV reader writes the files anew.
    """
    options = csv_options(feed, line_breaks)
    lines = first_lines(spark, sizes)
    layouts, header = _by_header(lines), dict(lines)

    def write(found: list[DataFrame]) -> None:
        landed = with_lineage(reduce(DataFrame.union, found), feed) if found else spark.createDataFrame([], landed_schema(feed))
        landed.write.mode("overwrite").parquet(path)

    if options["multiLine"] == "false" and layouts and not any("\ufffd" in line for line in header.values()):
        dropped = [Observation() for _ in layouts]
        write([_read_lines(spark, files, {header[f] for f in files}, names, feed, n) for (names, files), n in zip(layouts.items(), dropped, strict=True)])
        if [n.get["lines"] for n in dropped] == [len(files) for files in layouts.values()]:
            return
    write([read_layout(spark, files, names, feed, options) for names, files in layouts.items()])


def read_feed(
    spark: SparkSession, folder: str, feed: str, by_name: bool = True, pattern: str | None = None, line_breaks: bool | None = None
) -> DataFrame:
    """All files of one feed as raw rows with lineage; ``pattern`` replaces the default file name pattern.

    ``by_name`` reads each file by its own header (:func:`read_files`). Without it headers are not looked up first, and the read
    fails if one differs from the feed's schema.
    """
    pattern = pattern or feed_pattern(feed)
    if by_name:
        return read_files(spark, folder, feed, pattern, line_breaks)
    options = csv_options(feed, line_breaks) | {"enforceSchema": "false", "pathGlobFilter": pattern}
    strict = spark.read.options(**options, columnNameOfCorruptRecord=_LINE).schema(feed_schema(feed).add(_LINE, T.StringType())).csv(folder)
    placed = strict.select(*FEEDS[feed], F.col("_metadata.file_name").alias("source_file"), *_refusal(F.col(FEEDS[feed][0]), len(FEEDS[feed])))
    return accepted(with_lineage(placed, feed))
