"""The physical plans must hold at scale: no single-task windows, no Python rows, pruned and pushed scans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from carelens.operators import aggregates, history, keys, latest
from carelens.operators.neighbours import with_neighbour
from carelens.workload import direct, layers

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def tree(df) -> str:
    return plan(df).split("Initial Plan")[-1]


# queries that write files first; their reads are simple scans
EAGER = {
    "incremental_ingest", "processed_files", "full_reload", "parquet_export", "file_count_differences", "read_by_name_reviews", "file_discovery",
    "feed_profile", "run_log", "report_export", "refused_rows", "ingest_all_feeds", "latest_by_merge", "monthly_export", "kept_keys", "scd2_by_merge",
}
LAZY = sorted({**direct.QUERIES, **layers.QUERIES}.keys() - EAGER)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_no_cross_joins(spark, name):
    text = tree(registry.queries()[name](spark, SF))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("name", LAZY)
def test_no_window_over_a_single_partition(spark, name):
    lines = tree(registry.queries()[name](spark, SF)).splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line) and "_part" not in line:  # by _part: one row per range
            assert not any("SinglePartition" in below for below in lines[i : i + 4])


def test_rank_limits_apply_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    text = tree(latest.latest_per_key(df, ["k"], [F.col("id").desc()]))
    assert text.index("row_number(), 1, Final") < text.index("Exchange") < text.index("row_number(), 1, Partial")
    text = tree(aggregates.topk_share(df.select("k", F.col("id").alias("item")), ["k"], "item", 3))
    assert "row_number(), 3, Partial" in text


def test_trailing_window_is_a_scalar_subquery(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("d"))
    text = plan(aggregates.since_latest(df, "d", 12))
    assert "Subquery" in text and "Join" not in text


def test_scans_read_only_needed_columns(spark):
    text = plan(registry.queries()["monthly_rate"](spark, SF))
    schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert any(set(re.sub(r"#\d+L?", "", s).split(",")) == {"l_suppkey", "l_returnflag", "l_shipdate"} for s in schemas)


def test_filters_reach_the_scan(spark):
    text = plan(registry.queries()["customer_scope_one"](spark, SF))
    assert "EqualTo(c_nationkey,7)" in text


def test_facts_are_reduced_before_they_are_joined(spark):
    lines = tree(registry.queries()["monthly_rate"](spark, SF)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "l_suppkey" in line and "FileScan" in line)
    above = [line for line in lines[:scan] if "HashAggregate" in line]
    assert len(above) >= 4  # partial and final per supplier, then partial and final per nation


def test_cold_keys_need_one_shuffle_and_hot_keys_are_dealt_by_ranges(spark):
    df = spark.createDataFrame([("k", i) for i in range(30)], "k string, n int").select("k", F.date_add(F.lit("2024-01-01").cast("date"), "n").alias("d"))
    text = tree(with_neighbour(df, ["k"], "d", ["d"], "x"))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    text = tree(with_neighbour(df, ["k"], "d", ["d"], "x", hot_rows=5))
    assert "Window [lead" in text and "hashpartitioning(_part" in text
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert all("k#" in line.split("],")[1] or "_part" in line for line in windows)


def test_history_has_no_global_window_and_keys_plan_does_not_grow(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int").select("k", F.current_date().alias("at"), "n")
    assert "SinglePartition" not in tree(history.scd2(df, ["k"], "n", "at"))
    before, sizes = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions in ("2", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            sizes.append(len(re.sub(r"\d+", "", tree(keys.dense_key(spark.range(1000).select("id"), "key", ["id"])))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert abs(sizes[0] - sizes[1]) < 100


@pytest.mark.parametrize("name", ["view_monthly_occupancy_rate", "view_labor_cost_per_resident_day"])
def test_small_written_dimensions_are_broadcast_by_size(spark, name):
    text = tree(layers.QUERIES[name][0](spark, SF))
    assert "BroadcastHashJoin" in text
    assert "CartesianProduct" not in text
