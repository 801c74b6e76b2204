"""Every registered query against its SQL statement on the smallest tables."""

import threading
import time
from datetime import datetime, timedelta
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from carelens import session
from carelens.workload import direct, layers

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    yield con
    con.close()


def canonical(columns, rows):
    order = sorted(columns)
    index = [columns.index(c) for c in order]
    return order, sorted(tuple(repr(r[i]) for i in index) for r in rows)


NAMES = sorted(direct.QUERIES.keys() | layers.QUERIES.keys())


def test_every_query_has_a_statement():
    assert set(NAMES) <= set(registry.oracle_sql()) and set(NAMES) <= set(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, db, name):
    df = registry.queries()[name](spark, SF)
    result = db.execute(registry.oracle_sql()[name])
    expected = canonical([d[0] for d in result.description], result.fetchall())
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["n_name", "year", "month", "total_lines", "kept_lines", "kept_pct"]
    assert df.count() > 0


def test_census_covers_all_days_of_the_events(spark, tmp_path):
    seen = "event_type string, user_id long, ts timestamp_ntz"
    rows = [("a", 1, "2023-12-30"), ("a", 1, "2024-02-02"), ("a", 2, "2024-02-01"), ("b", 3, "2024-02-03")]
    events = spark.createDataFrame([(e, u, datetime.fromisoformat(d)) for e, u, d in rows], seen)
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = registry.queries()["census_intervals"](spark, str(tmp_path)).collect()
    first = datetime(2023, 12, 30).date()
    expected = {("a", first + timedelta(i)): 1 for i in range(35)} | {("a", datetime(2024, 2, 1).date()): 2, ("b", datetime(2024, 2, 3).date()): 1}
    assert {(r.event_type, r.day): r.census for r in got} == expected and len(got) == len(expected)
    average = registry.queries()["avg_daily_census"](spark, str(tmp_path)).collect()
    assert {r.event_type: (r.resident_days, r.avg_daily_census) for r in average} == {"a": (36, 1.0), "b": (1, 1 / 36)}


@pytest.fixture
def small(spark, tmp_path):
    """A folder of the tables that feeds come from: three lines (two of them equal), two orders, two events."""
    day = datetime(1997, 3, 5)
    line = (1, 2, 3, 1, 5.0, 10.0, 0.0, 0.0, "A", "O", day)
    tables = {
        "lineitem": ([line, line, (2, 3, 4, 1, 7.0, 10.0, 0.0, 0.0, "R", "F", None)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
            "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(1, 1, "O", 100.0, day, "5-LOW"), (2, 1, "F", 50.0, day, "1-URGENT")],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "events": ([(1, day, 1, "view", 1.0, "{}"), (2, day, 2, "error", None, None)],
            "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_ingest_of_all_feeds_holds_a_feed_of_each_table_at_most(spark, small, monkeypatch):
    scratch, land, at_once = Path(session.shared_root(spark).removeprefix("file:")) / "carelens", direct._land, []
    before = set(scratch.glob("*"))

    def held():
        new = [p for p in scratch.glob("*") if p not in before]
        return {f.name.split("_delivery")[0] for p in new for f in p.rglob("*_delivery*.csv")}, [p for p in new if p.name.startswith(("raw-", "bronze-"))]

    def landed(*args):
        land(*args)
        at_once.append(len(held()[0]))

    monkeypatch.setattr(direct, "_land", landed)
    got = registry.queries()["ingest_all_feeds"](spark, small)
    assert len(at_once) == 8 and max(at_once) <= 3 and held() == (set(), [])
    source = {"lineitem": 3, "orders": 2, "events": 2}
    expected = sorted((feed, source[table], source[table], 0) for feed, (table, _) in layers.DERIVED.items())
    assert sorted(map(tuple, got.collect())) == expected


def test_only_scratch_folders_are_discarded(spark, tmp_path):
    made = session.scratch_path(spark, "made")
    spark.range(3).write.parquet(made)
    session.discard(spark, made)
    assert not Path(made.removeprefix("file:")).exists()
    spark.range(3).write.parquet(f"{tmp_path}/kept")
    for path in (f"{tmp_path}/kept", f"{made}/../../kept", session.shared_root(spark)):
        with pytest.raises(ValueError):
            session.discard(spark, path)
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 3


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split()
    return {f for f in files if f.rsplit("/", 1)[-1].startswith("shuffle_") and f.endswith(".data")}


def test_validation_holds_the_shuffle_files_of_two_feeds_at_most(spark, small, monkeypatch):
    setting, write, lock = session._FREE_SHUFFLES, layers.materialise, threading.Lock()
    before, default, running, seen = shuffle_files(spark), spark.conf.get(setting, None), [], []

    def written(df, label, *args):
        with lock:
            running.append(label)
            seen.append(len(running))
        try:
            return write(df, label, *args)
        finally:
            with lock:
                running.remove(label)

    monkeypatch.setattr(layers, "materialise", written)
    cleaned = layers.Layers(spark, small).write_silver()
    assert len(seen) == 8 and max(seen) <= 2 and spark.conf.get(setting, None) == default
    assert {f: cleaned[f].count() for f in ("adp_shifts", "yardi_units", "pcc_residents", "yardi_leases")} == {
        "adp_shifts": 2, "yardi_units": 2, "pcc_residents": 1, "yardi_leases": 2,
    }
    before |= shuffle_files(spark)
    _, _, facts = layers._tables(layers.Layers(spark, small))
    deadline = time.time() + 20  # files are removed by another thread
    while shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and spark.conf.get(setting, None) == default
    assert facts["fact_labor"].count() == 2


def test_shuffle_setting_comes_back(spark):
    setting = session._FREE_SHUFFLES
    before = spark.conf.get(setting, None)
    with pytest.raises(KeyError), session.freed_shuffles(spark):
        with session.freed_shuffles(spark):
            assert spark.conf.get(setting) == "true"
        assert spark.conf.get(setting) == "true"
        raise KeyError
    assert spark.conf.get(setting, None) == before
