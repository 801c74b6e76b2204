import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from carelens.operators import aggregates, census, history, keys, latest, profile, quality, security
from carelens.operators.keys import slot, slot_part
from carelens.operators.neighbours import with_neighbour
from carelens.operators.skew import hot_keys
from carelens.workload.principals import ACCESS_KEYS

D = date


# keys


def test_dense_key_numbers_rows_in_order_over_many_partitions(spark):
    values = list(range(0, 5000, 7))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(f"K{v:05d}",) for v in values], "k string").repartition(16)
    got = {r["k"]: r["n"] for r in keys.dense_key(df, "n", ["k"]).collect()}
    assert got == {k: i for i, k in enumerate(sorted(got), 1)}
    assert len(got) == len(values)


def test_dense_key_puts_null_last_and_accepts_empty(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert {r["k"]: r["n"] for r in keys.dense_key(df, "n", ["k"]).collect()} == {"a": 1, "b": 2, None: 3}
    assert keys.dense_key(df.limit(0), "n", ["k"]).count() == 0


def test_dense_key_splits_a_hot_key_by_its_second_column(spark):
    rows = [("hot", i) for i in range(3000)] + [("cold", i) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(8)
    got = sorted((r["n"], r["k"], r["i"]) for r in keys.dense_key(df, "n", ["k", "i"]).collect())
    assert [(k, i) for _, k, i in got] == sorted(rows)
    assert [n for n, _, _ in got] == list(range(1, len(rows) + 1))


def test_hash_key_separates_null_blank_and_boundaries(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("", "a"), (None, "a"), ("a", "")], "x string, y string")
    got = [r[0] for r in df.select(keys.hash_key("x", "y")).collect()]
    assert len(set(got)) == 4
    assert got[1] == got[4]


def test_row_id_is_unique(spark):
    df = spark.range(1000).repartition(7).select(keys.row_id().alias("n"))
    assert df.distinct().count() == 1000


# neighbours and history


def _brute_neighbours(rows, direction):
    """rows: (key, day or None, tie) -> {row: neighbour}"""
    out = {}
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, r[1] or D.min, r[2]))
        for i, row in enumerate(group):
            j = i + 1 if direction == "next" else i - 1
            out[row] = group[j] if 0 <= j < len(group) else None
    return out


@pytest.mark.parametrize("direction", ["next", "previous"])
@pytest.mark.parametrize("hot_rows", [5, 10**6])
def test_neighbours_match_brute_force_with_hot_and_cold_keys(spark, direction, hot_rows):
    rng = random.Random(7)
    rows = [("hot", D(2024, 1, 1) + timedelta(rng.randrange(0, 60)), i) for i in range(400)]
    rows += [("hot", None, 1000 + i) for i in range(3)]
    rows += [(f"c{i % 40}", D(2024, 1, 1) + timedelta(rng.randrange(0, 300)), 2000 + i) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, d date, i int")
    got = with_neighbour(df, ["k"], "d", ["d", "i"], "n", direction, ["i"], hot_rows)
    assert got.columns == ["k", "d", "i", "n"]
    expected = _brute_neighbours(rows, direction)
    for r in got.collect():
        other = expected[(r["k"], r["d"], r["i"])]
        assert (r["n"] and (r["n"]["d"], r["n"]["i"])) == (other and (other[1], other[2]))
    assert got.count() == len(rows)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_neighbours_of_a_hot_key_by_timestamp(spark, kind):
    rng = random.Random(5)
    rows = [("hot", i, f"2024-0{rng.randrange(1, 4)}-{rng.randrange(1, 29):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00") for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int, t string").withColumn("at", F.col("t").cast(kind))
    got = {r["i"]: r["n"] and r["n"]["i"] for r in with_neighbour(df, ["k"], "at", ["i"], "n", "next", ["i"], 10).collect()}
    order = [i for _, i, _ in sorted(rows, key=lambda r: (r[2], r[1]))]
    assert got == dict(zip(order, [*order[1:], None], strict=True))


@pytest.mark.parametrize("kind", ["one day", "no date", "no key"])
@pytest.mark.parametrize("direction", ["next", "previous"])
def test_no_group_is_oversized_whatever_makes_a_key_hot(spark, kind, direction):
    day = None if kind == "no date" else D(2024, 1, 1)
    rows = [(None if kind == "no key" else "hot", day, i) for i in range(2000)] + [("cold", D(2024, 1, i + 1), i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, d date, i int").repartition(4)
    out = with_neighbour(df, ["k"], "d", ["i"], "n", direction, ["i"], 100)
    got = {(r["k"], r["i"]): r["n"] and r["n"]["i"] for r in out.collect()}
    step = 1 if direction == "next" else -1
    last = 1999 if direction == "next" else 0
    key = None if kind == "no key" else "hot"
    assert {i: got[key, i] for i in range(2000)} == {i: None if i == last else i + step for i in range(2000)}
    assert sum(v is None for (k, _), v in got.items() if k == "cold") == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows become one partition
    try:
        ranges = slot(df, [F.col("k"), F.col("d"), F.col("i")], "check").groupBy(slot_part()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in ranges) < 1000


def test_neighbours_reject_unknown_direction(spark):
    with pytest.raises(ValueError, match="direction"):
        with_neighbour(spark.range(1), ["id"], "id", ["id"], "n", "sideways")


def test_hot_keys(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 5, "k string")
    assert [r["k"] for r in hot_keys(df, ["k"], 5).collect()] == ["a"]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_scd2_with_one_two_three_and_undated_changes(spark, rows, hot_rows):
    df = spark.createDataFrame(
        [
            ("one", D(2025, 1, 8), "AL"),
            ("two", D(2025, 1, 2), "IL"),
            ("two", D(2025, 3, 1), "AL"),
            ("three", D(2025, 1, 1), "IL"),
            ("three", D(2025, 2, 1), "AL"),
            ("three", D(2025, 2, 2), "MC"),
            ("undated", D(2025, 4, 4), "AL"),
            ("undated", None, "MC"),
        ],
        "id string, at date, level string",
    )
    end = D(9999, 12, 31)
    assert rows(history.scd2(df, ["id"], "level", "at", hot_rows=hot_rows)) == [
        ("one", "AL", D(2025, 1, 8), end, True),
        ("three", "AL", D(2025, 2, 1), D(2025, 2, 1), False),
        ("three", "IL", D(2025, 1, 1), D(2025, 1, 31), False),
        ("three", "MC", D(2025, 2, 2), end, True),
        ("two", "AL", D(2025, 3, 1), end, True),
        ("two", "IL", D(2025, 1, 2), D(2025, 2, 28), False),
        ("undated", "AL", D(2025, 4, 4), end, True),
        ("undated", "MC", None, end, True),
    ]


def test_scd2_intervals_do_not_overlap_and_one_is_current(spark):
    rng = random.Random(3)
    data = {(f"R{rng.randrange(30)}", D(2024, 1, 1) + timedelta(rng.randrange(500))) for _ in range(300)}
    df = spark.createDataFrame([(k, d, rng.choice("ABC")) for k, d in data], "id string, at date, level string")
    spans = {}
    for r in history.scd2(df, ["id"], "level", "at", hot_rows=12).collect():
        spans.setdefault(r["id"], []).append((r["effective_start_date"], r["effective_end_date"], r["current_flag"]))
    for group in spans.values():
        group.sort()
        assert [c for *_, c in group] == [False] * (len(group) - 1) + [True]
        assert all(a[1] == b[0] - timedelta(1) for a, b in zip(group, group[1:], strict=False))


def test_changes_within_needs_a_different_level_and_a_short_gap(spark, rows):
    df = spark.createDataFrame(
        [
            ("a", D(2025, 1, 1), "IL"), ("a", D(2025, 4, 1), "AL"),  # 90 days: kept
            ("b", D(2025, 1, 1), "IL"), ("b", D(2025, 4, 2), "AL"),  # 91 days: dropped
            ("c", D(2025, 1, 1), "IL"), ("c", D(2025, 1, 5), "IL"),  # same level: dropped
        ],
        "id string, at date, level string",
    )
    got = history.changes_within(df, ["id"], "level", "at", 90)
    assert rows(got, "id", "previous_value", "level", "days_between_changes") == [("a", "IL", "AL", 90)]


# latest and duplicates


def test_latest_per_key_is_total_and_keeps_one(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q")], "k string, t int, v string")
    got = latest.latest_per_key(df, ["k"], [F.col("t").desc_nulls_last(), F.col("v").desc()])
    assert rows(got) == [("a", 2, "z"), ("b", None, "q")]


def test_dedupe_business_rows_ignores_lineage_and_equates_nulls(spark, rows):
    df = spark.createDataFrame(
        [("L1", None, "f2", 2), ("L1", None, "f1", 1), ("L1", 5, "f1", 1), ("L2", 3, "f1", 1)],
        "id string, rate int, file string, at int",
    )
    assert rows(latest.dedupe_business_rows(df, ["file", "at"])) == [
        ("L1", None, "f1", 1), ("L1", 5, "f1", 1), ("L2", 3, "f1", 1),
    ]
    assert rows(latest.conflicting_keys(df, ["id"], ["file", "at"])) == [("L1", 2)]


def test_first_copy_of_text(spark):
    df = spark.createDataFrame([(3, "same"), (1, "same"), (2, "other")], "id long, text string")
    assert sorted((r["id"], r["copies"]) for r in latest.first_copy_of_text(df, "text", "id").collect()) == [(1, 2), (2, 1)]


# aggregates


def test_since_latest_includes_the_boundary_day(spark, rows):
    df = spark.createDataFrame([(D(2025, 6, 29),), (D(2024, 6, 29),), (D(2024, 6, 28),), (None,)], "d date")
    assert rows(aggregates.since_latest(df, "d", 12)) == [(D(2024, 6, 29),), (D(2025, 6, 29),)]


def test_since_latest_clamps_month_ends(spark, rows):
    df = spark.createDataFrame([(D(2024, 2, 29),), (D(2023, 2, 28),), (D(2023, 2, 27),)], "d date")
    assert rows(aggregates.since_latest(df, "d", 12)) == [(D(2023, 2, 28),), (D(2024, 2, 29),)]


def test_topk_share_breaks_ties_by_item_and_uses_the_whole_total(spark, rows):
    items = ["d"] * 1 + ["c"] * 2 + ["b"] * 2 + ["a"] * 1 + ["e"] * 2
    df = spark.createDataFrame([("g", i) for i in items], "g string, item string")
    got = aggregates.topk_share(df, ["g"], "item", 3)
    assert rows(got) == [
        ("g", "b", 2, 8, 25.0, 1), ("g", "c", 2, 8, 25.0, 2), ("g", "e", 2, 8, 25.0, 3),
    ]


def test_rolling_sum_counts_days_not_rows(spark, rows):
    df = spark.createDataFrame(
        [("g", D(2025, 1, 1), 1.0), ("g", D(2025, 3, 31), 2.0), ("g", D(2025, 4, 1), 4.0)], "g string, d date, v double"
    )
    got = aggregates.rolling_sum(df, ["g"], "d", "v", 90, "s")
    assert [r[-1] for r in rows(got)] == [1.0, 3.0, 6.0]  # 2025-01-01 is 89 days before 03-31, 90 before 04-01


def test_year_over_year_uses_the_calendar_not_the_row(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 10.0), (D(2024, 3, 1), 0.0), (D(2025, 1, 1), 15.0), (D(2025, 3, 1), 5.0)], "m date, v double")
    got = {r["m"]: (r["v_ly"], r["yoy_growth"]) for r in aggregates.year_over_year(df, "m", "v").collect()}
    assert got == {D(2024, 1, 1): (None, None), D(2024, 3, 1): (None, None), D(2025, 1, 1): (10.0, 0.5), D(2025, 3, 1): (0.0, None)}


def test_bucket_edges(spark):
    df = spark.createDataFrame([(0,), (30,), (31,), (365,), (366,), (None,)], "n int")
    got = [r[0] for r in df.select(aggregates.bucket(F.col("n"), [30, 90, 180, 365])).collect()]
    assert got == ["0-30", "0-30", "31-90", "181-365", "366+", None]


def test_distinct_union_has_set_semantics(spark, rows):
    a = spark.createDataFrame([("x",), ("x",), (None,)], "v string")
    b = spark.createDataFrame([("y",), ("x",), (None,)], "w string")
    assert rows(aggregates.distinct_union([a, b], "id")) == [(None,), ("x",), ("y",)]


# census


def test_census_equals_a_day_by_day_count(spark):
    rng = random.Random(11)
    stays = []
    for _ in range(200):
        start = D(2025, 1, 1) + timedelta(rng.randrange(-60, 90))
        stays.append((rng.choice("AB"), start, None if rng.random() < 0.3 else start + timedelta(rng.randrange(0, 50))))
    stays.append(("A", None, D(2025, 1, 9)))
    df = spark.createDataFrame(stays, "g string, s date, e date")
    first, last = D(2025, 1, 1), D(2025, 2, 28)
    intervals = census.census_intervals(df, ["g"], "s", "e")
    got = {(r["g"], r["day"]): r["census"] for r in census.daily_census(intervals, ["g"], F.lit(first), F.lit(last)).collect()}
    days = [first + timedelta(i) for i in range((last - first).days + 1)]
    expected = {
        (g, d): sum(1 for k, s, e in stays if k == g and s and s <= d and (e is None or d <= e)) for g in "AB" for d in days
    }
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in expected.items() if v}
    totals = census.resident_days(intervals, ["g"], F.lit(first), F.lit(last))
    for r in totals.collect():
        want = sum(v for (g, _), v in expected.items() if g == r["g"])
        assert r["resident_days"] == want
        assert r["avg_daily_census"] == pytest.approx(want / len(days))


# profile


def test_column_profile_counts_exactly(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "x string, y int")
    names = ("row_count", "null_count", "distinct_count", "min_value", "max_value")
    assert {r["distinct_count"] for r in profile.column_profile(df).collect()} == {None}
    got = {r["column_name"]: tuple(r[n] for n in names) for r in profile.column_profile(df, df.columns).collect()}
    assert got == {"x": (3, 1, 1, "a", "a"), "y": (3, 1, 2, "1", "3")}


def test_schema_and_samples(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    got = profile.describe_schema(spark, {"t": df}).collect()
    assert [(r["column_name"], r["data_type"]) for r in got] == [("x", "string"), ("y", "int")]
    assert profile.sample_rows(df, 0).count() == 0
    assert profile.sample_rows(df, 3).count() == 1


# quality

RULES = [
    quality.Rule("low", "v < 0", "High", "Fix", "rows"),
    quality.Rule("range", "v NOT BETWEEN 1 AND 5", "Medium", "Quarantine Records"),
]


def test_rules_ignore_null_and_report(spark, rows):
    df = spark.createDataFrame([(1,), (None,), (9,)], "v int")
    assert rows(quality.evaluate_rules(df, RULES)) == [
        ("low", "PASS", "Low", "None", ""),
        ("range", "FAIL", "Medium", "Quarantine Records", ""),
    ]
    assert rows(quality.count_violations(df, RULES)) == [("low", 0), ("range", 1)]


def test_quarantine_splits_without_loss(spark, rows):
    df = spark.createDataFrame([(1,), (None,), (9,), (-1,)], "v int")
    kept, refused = quality.quarantine(df, RULES)
    assert rows(kept) == [(None,), (1,)]
    assert [(r["v"], r["broken_rules"]) for r in refused.orderBy("v").collect()] == [(-1, ["low", "range"]), (9, ["range"])]


def test_quarantine_filters_by_plain_conditions(spark, rows):
    df = spark.createDataFrame([(1, None), (None, 2), (9, 3), (-1, None)], "v int, w int")
    kept, refused = quality.quarantine(df, [*RULES, quality.Rule("low", F.col("w").isNull(), "High", "Fix")])
    assert rows(kept) == [(None, 2)]
    assert rows(refused) == [(-1, None, ["low", "range", "low"]), (1, None, ["low"]), (9, 3, ["range"])]
    for part in (kept, refused):
        filters = [line for line in part._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
        assert filters and not any("lambda" in line or "array" in line for line in filters)
    assert [part.count() for part in quality.quarantine(df, [])] == [4, 0]


def test_reconciliation(spark, rows):
    a, b = spark.range(3), spark.range(4)
    got = quality.reconcile_counts({"t": {"Bronze": a, "Silver": a, "Gold": b}, "u": {"Bronze": a, "Silver": a, "Gold": a}})
    assert rows(got) == [
        ("Row Count - t", "FAIL", "High", "Investigate ETL", "Bronze=3, Silver=3, Gold=4"),
        ("Row Count - u", "PASS", "Low", "None", "Bronze=3, Silver=3, Gold=3"),
    ]
    money = a.select(F.col("id").cast("double").alias("m"))
    near = quality.reconcile_sums("R", (money, "m"), (money.limit(0), "m"), 5.0, "High", "Check", True)
    assert rows(near) == [("R", "PASS", "Low", "None", "")]
    far = quality.reconcile_sums("R", (money, "m"), (money.limit(0), "m"), 0.1, "High", "Check", True)
    assert rows(far) == [("R", "FAIL", "High", "Check", "3.0 vs 0.0")]
    assert quality.summarise(got.unionByName(near)).first().asDict() == {"Total Checks": 3, "Passed": 2, "Failed": 1}


def test_duplicates_and_orphans(spark, rows):
    df = spark.createDataFrame([("C1",), ("C1",), ("C9",), (None,)], "c string")
    dim = spark.createDataFrame([("C1",)], "c string")
    assert rows(quality.duplicate_keys(df, ["c"])) == [("C1", 2)]
    assert rows(quality.orphan_keys(df, dim, "c")) == [("C9", 1)]


# security


def _secured(spark):
    data = spark.createDataFrame([("C001", 1), ("C005", 2), ("C905", 3), (None, 4)], "community_id string, v int")
    regions = spark.createDataFrame(
        [("C001", "Pacific Northwest"), ("C001", "Pacific Northwest"), ("C005", "Southwest")], "community_id string, region string"
    )
    return data, regions


@pytest.mark.parametrize(
    ("access_key", "seen"), [("demo-everything", [1, 2, 3, 4]), ("demo-one-region", [1]), ("demo-one-community", [1])]
)
def test_row_security_by_access_key(spark, access_key, seen):
    data, regions = _secured(spark)
    got = security.apply_row_security(data, security.resolve_principal(access_key, ACCESS_KEYS), regions)
    assert sorted(r["v"] for r in got.collect()) == seen


@pytest.mark.parametrize("access_key", [None, "", "guess"])
def test_missing_and_unknown_keys_are_refused(access_key):
    with pytest.raises(PermissionError):
        security.resolve_principal(access_key, ACCESS_KEYS)


def test_unknown_role_sees_nothing(spark):
    data, regions = _secured(spark)
    with pytest.raises(PermissionError):
        security.apply_row_security(data, security.Principal("visitor"), regions)


def test_entitlement_table(spark):
    data, regions = _secured(spark)
    people = spark.createDataFrame(
        [
            ("chief", "corporate_admin", None, None), ("sw", "regional_director", "Southwest", None),
            ("one", "executive_director", None, "C001"), ("odd", "visitor", "Southwest", "C001"),
        ],
        "principal string, role string, region string, community_id string",
    )
    communities = data.select("community_id").distinct()
    granted = security.entitlements(people, communities, regions)
    seen = {p: sorted(r["v"] for r in security.rows_for(data, granted, p).collect()) for p in ("chief", "sw", "one", "odd", "none")}
    assert seen == {"chief": [1, 2, 3, 4], "sw": [2], "one": [1], "odd": [], "none": []}
    every = security.rows_by_principal(data, granted)
    assert sorted((r["principal"], r["v"]) for r in every.collect()) == [("chief", 1), ("chief", 2), ("chief", 3), ("chief", 4), ("one", 1), ("sw", 2)]


def test_kept_keys_stay_and_new_ones_follow(spark, tmp_path):
    rng, known, keyed = random.Random(3), {}, keys.kept_key(str(tmp_path / "keys"))
    for _ in range(4):
        ids = {rng.choice([None, *range(40)]) for _ in range(12)}
        df = spark.createDataFrame([(i, "x") for i in sorted(ids, key=str)], "k int, name string")
        got = {r["k"]: r["n"] for r in keyed(df, "n", ["k"]).collect()}
        new = sorted(ids - known.keys(), key=lambda k: (k is None, k))
        known |= {k: len(known) + i for i, k in enumerate(new, 1)}
        assert got == {k: known[k] for k in ids}
    again = keyed(df, "n", ["k"])
    assert again.columns == ["n", "k", "name"] and {r["k"]: r["n"] for r in again.collect()} == got
    assert keyed(df.limit(0), "n", ["k"]).count() == 0
    table = keys.stored_keys(spark, str(tmp_path / "keys" / "n"), again.select("n", "k").schema)
    assert sorted(r["n"] for r in table.collect()) == list(range(1, len(known) + 1))


def test_latest_by_merge_does_not_depend_on_the_deliveries(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, 1, 2, 3]), i) for i in range(60)]
    schema, order = "k string, at int, i int", [F.col("at").desc_nulls_last(), F.col("i")]
    expected = sorted(map(tuple, latest.latest_per_key(spark.createDataFrame(rows, schema), ["k"], order).collect()), key=str)
    for run in range(2):
        rng.shuffle(rows)
        state = latest.LatestState(spark, str(tmp_path / str(run)), schema, ["k"], order, buckets=5)
        assert state.read().count() == 0 and state.merge(spark.createDataFrame([], schema)) == set()
        for part in (rows[:25], rows[20:], rows[:5]):
            state.merge(spark.createDataFrame(part, schema))
        assert sorted(map(tuple, state.read().collect()), key=str) == expected


def test_a_merge_rewrites_the_buckets_that_it_touches(spark, tmp_path):
    schema, order = "k int, at int", [F.col("at").desc()]
    state = latest.LatestState(spark, str(tmp_path), schema, ["k"], order, buckets=8)
    state.merge(spark.createDataFrame([(k, 1) for k in range(50)], schema))
    before = state.versions()
    touched = state.merge(spark.createDataFrame([(7, 2)], schema))
    after = state.versions()
    assert len(touched) == 1 and {b for b in after if after[b] != before.get(b)} == touched and len(before) == 8
    # a version that the log does not name is not read
    spark.createDataFrame([(7, 9)], schema).withColumn("bucket", F.lit(min(touched))).write.partitionBy("bucket").parquet(f"{tmp_path}/data/version=99")
    assert {r["k"]: r["at"] for r in state.read().collect()} == {k: 2 if k == 7 else 1 for k in range(50)}


def test_spliced_histories_equal_a_full_build(spark, tmp_path):
    rng = random.Random(6)
    changes = list({(rng.choice([None, "a", "b"]), rng.choice("xyz"), rng.choice([None, *(date(2025, 1, d) for d in range(1, 15))])) for _ in range(50)})
    schema = "k string, level string, day date"
    full = history.scd2(spark.createDataFrame(changes, schema), ["k"], "level", "day")
    expected = sorted(map(str, map(tuple, full.collect())))
    for run, hot in enumerate((history.HOT_ROWS, 5)):
        rng.shuffle(changes)
        state = history.HistoryState(spark, str(tmp_path / str(run)), "k string", "level string", "day", buckets=3, hot_rows=hot)
        for part in (changes[:20], changes[15:40], changes[40:], changes[:3]):
            state.merge(spark.createDataFrame(part, schema))
        assert sorted(map(str, map(tuple, state.read().collect()))) == expected


def test_bitmaps_count_distinct_keys_of_any_grouping(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, "a", "b"]), rng.choice("xy"), rng.choice([None, 0, 1, 32767, 32768, 32769, 100_000, 5 * 10**9, *range(50)])) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, h string, k long")
    bitmaps = aggregates.distinct_bitmaps(df, ["g", "h"], "k")
    for by in (["g", "h"], ["g"], ["h"], []):
        expected = {}
        for g, h, k in rows:
            if k is not None:
                expected.setdefault(tuple({"g": g, "h": h}[c] for c in by), set()).add(k)
        got = {tuple(r[c] for c in by): r["n"] for r in aggregates.distinct_from(bitmaps, by, "n").collect()}
        assert got == {key: len(found) for key, found in expected.items()}
    assert aggregates.distinct_from(aggregates.distinct_bitmaps(df.limit(0), [], "k"), [], "n").first()["n"] == 0
