import pytest
from feeddata import FEBRUARY, HEADERS, JANUARY, write
from pyspark.sql import functions as F

from carelens.plans.silver import CLEANERS
from carelens.sources import export, feeds
from carelens.sources.reference_data import dim_community_region
from carelens.streaming import ingest as ing


def test_headers_are_standardised(spark):
    df = spark.createDataFrame([(1, 2)], ["  Lead ID", "Lost-Reason "])
    assert feeds.standardise_columns(df).columns == ["lead_id", "lost_reason"]


def test_discovery_tags_files_and_reports_the_rest(spark, tmp_path, rows):
    write(tmp_path, "2025_01", {"yardi_units": [], "pcc_residents": []})
    (tmp_path / "notes.csv").write_text("x\n")
    (tmp_path / "readme.txt").write_text("x\n")
    assert rows(feeds.discover_files(spark, str(tmp_path)), "file_name", "feed") == [
        ("notes.csv", None),
        ("pcc_residents_2025_01.csv", "pcc_residents"),
        ("yardi_units_2025_01.csv", "yardi_units"),
    ]


def test_read_by_name_accepts_drifted_headers(spark, tmp_path, rows):
    write(tmp_path, "2025_01", {"yardi_units": ["U1,C001,AL,4000,2025-01-01"]})
    (tmp_path / "yardi_units_2025_02.csv").write_text(
        "Snapshot-Date,Unit ID,extra,COMMUNITY_ID\n2025-02-01,U2,x,C002\n2025-02-01,U3,,C003\n"
    )
    got = feeds.read_feed(spark, str(tmp_path), "yardi_units")
    assert rows(got, *HEADERS["yardi_units"].split(","), "source_file") == [
        ("U1", "C001", "AL", "4000", "2025-01-01", "yardi_units_2025_01.csv"),
        ("U2", "C002", None, None, "2025-02-01", "yardi_units_2025_02.csv"),
        ("U3", "C003", None, None, "2025-02-01", "yardi_units_2025_02.csv"),
    ]


def test_a_file_without_the_key_header_fails(spark, tmp_path):
    write(tmp_path, "2025_01", {"yardi_units": ["U1,C001,AL,4000,2025-01-01"]})
    (tmp_path / "yardi_units_2025_02.csv").write_text("unit,community_id\nU2,C002\n")
    with pytest.raises(ValueError, match="no unit_id header in yardi_units_2025_02.csv"):
        feeds.read_feed(spark, str(tmp_path), "yardi_units").collect()


def test_cells_that_look_like_a_header_are_data(spark, tmp_path, rows):
    write(tmp_path, "2025_01", {"gbp_reviews": ["G1,C001,2025-01-01,5,fine,,", "G2,C001,2025-01-01,5,Review ID,,", "review_id,C001,,1,,,"]})
    got = feeds.read_feed(spark, str(tmp_path), "gbp_reviews")
    assert rows(got, "review_id", "review_text") == [("G1", "fine"), ("G2", "Review ID"), ("review_id", None)]


def test_headers_of_any_width_and_spelling(spark, tmp_path, rows):
    extra = [f"Extra column {i} with a long name" for i in range(40)]
    cells = ",".join("x" for _ in extra)
    (tmp_path / "yardi_units_2025_01.csv").write_text(
        "\ufeff\n\nUnit ID," + ",".join(extra) + ',"Monthly-Rent",  SNAPSHOT_DATE  ,unit_id\n' + f'U1,{cells},"4,000",2025-01-01,second\n'
    )
    (tmp_path / "yardi_units_2025_02.csv").write_text("snapshot_date,unit_id\n2025-02-01,U2\n")
    (tmp_path / "yardi_units_2025_03.csv").write_text("")
    (tmp_path / "yardi_units 2025%20_04.csv").write_text("unit_id\nnot of this feed\n")
    (tmp_path / "yardi_units_%41 b.csv").write_text("snapshot_date,unit_id\n2025-03-01,U3\n")
    got = feeds.read_feed(spark, str(tmp_path), "yardi_units")
    assert rows(got, "unit_id", "monthly_rent", "snapshot_date", "community_id") == [
        ("U1", "4,000", "2025-01-01", None), ("U2", None, "2025-02-01", None), ("U3", None, "2025-03-01", None)
    ]


def test_one_scan_without_a_shuffle(spark, tmp_path):
    for month in ("01", "02", "03"):
        write(tmp_path, f"2025_{month}", {"yardi_units": [f"U{month},C001,AL,4000,2025-{month}-01"]})
    plan = feeds.read_feed(spark, str(tmp_path), "yardi_units")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan


def test_line_breaks_can_be_declared_absent(spark, tmp_path):
    write(tmp_path, "2025_01", {"gbp_reviews": ["G1,C001,2025-01-01,5,fine,,"]})
    assert feeds.csv_options("gbp_reviews")["multiLine"] == "true"
    assert feeds.csv_options("gbp_reviews", line_breaks=False)["multiLine"] == "false"
    assert feeds.read_feed(spark, str(tmp_path), "gbp_reviews", line_breaks=False).count() == 1


def test_strict_read_is_equal_on_clean_files_and_fails_on_drift(spark, tmp_path, rows):
    write(tmp_path, "2025_01", {"yardi_units": JANUARY["yardi_units"]})
    columns = [*HEADERS["yardi_units"].split(","), "source_file"]
    strict = feeds.read_feed(spark, str(tmp_path), "yardi_units", by_name=False)
    assert rows(strict, *columns) == rows(feeds.read_feed(spark, str(tmp_path), "yardi_units"), *columns)
    (tmp_path / "yardi_units_2025_02.csv").write_text("community_id,unit_id,unit_type,monthly_rent,snapshot_date\nC1,U2,AL,1,x\n")
    with pytest.raises(Exception, match="yardi_units_2025_02"):
        feeds.read_feed(spark, str(tmp_path), "yardi_units", by_name=False).collect()


def test_quoted_text_with_line_breaks_and_blank_values(spark, tmp_path):
    write(tmp_path, "2025_01", {"gbp_reviews": JANUARY["gbp_reviews"]})
    got = {r["review_id"]: r for r in feeds.read_feed(spark, str(tmp_path), "gbp_reviews").collect()}
    assert got["G1"]["review_text"] == 'Great, really\nkind "people"'
    assert got["G3"]["response_text"] is None
    cleaned = {r["review_id"]: r for r in CLEANERS["gbp_reviews"](feeds.read_feed(spark, str(tmp_path), "gbp_reviews")).collect()}
    assert [cleaned[g]["responded_flag"] for g in ("G1", "G2", "G3")] == [1, 1, 0]


def _load(spark, root, feeds_=("pcc_residents", "yardi_leases")):
    ing.ingest(spark, f"{root}/raw", f"{root}/bronze", f"{root}/ledger", feeds_)
    return {f: ing.read_bronze(spark, f"{root}/bronze", f) for f in feeds_}


BROKEN = {
    "U1,C001,AL,4000,2025-01-01": None,
    "U2,C001,AL,4000,2025-01-01,": "too many cells",
    "U3,C001,AL": "too few cells",
    'U4,C001,"AL,4000,2025-01-01': "unclosed quote",
    'U5,C001,AL,"4,000",2025-01-01': None,
    'U6,"C ""1""",AL,,': None,
    'U7,C001,"A,L",4000': "too few cells",
    ",,,,": None,
    "U8": "too few cells",
}


def test_rows_that_do_not_fit_their_header_are_refused_whole(spark, tmp_path, rows):
    raw = tmp_path / "raw"
    write(raw, "2025_01", {"yardi_units": list(BROKEN)})
    (raw / "yardi_units_2025_02.csv").write_text("snapshot_date,unit_id\n2025-02-01,U9\n2025-02-01,U10,x\n")
    (raw / "yardi_units_2025_03.csv").write_text("unit_id,monthly_rent\nU11\n")
    good = [line.split(",")[0] or None for line, problem in BROKEN.items() if problem is None] + ["U9"]
    assert rows(feeds.read_feed(spark, str(raw), "yardi_units"), "unit_id") == sorted(((u,) for u in good), key=lambda r: (r[0] is not None, str(r[0])))
    assert feeds.read_feed(spark, str(raw), "yardi_units").count() == len(good)

    ing.ingest(spark, str(raw), f"{tmp_path}/bronze", f"{tmp_path}/ledger", ("yardi_units",))
    loaded, refused = ing.read_bronze(spark, f"{tmp_path}/bronze", "yardi_units"), ing.read_refused(spark, f"{tmp_path}/bronze", "yardi_units")
    assert loaded.columns == [*HEADERS["yardi_units"].split(","), *feeds.LINEAGE] and loaded.count() == len(good)
    assert {(r.raw_line, r.problem) for r in refused.collect()} == {
        *((line, problem) for line, problem in BROKEN.items() if problem), ("2025-02-01,U10,x", "too many cells"), ("U11", "too few cells")
    }
    ledger = ing.processed_files({"yardi_units": loaded}, {"yardi_units": refused})
    assert rows(ledger, "file_name", "rows_loaded", "rows_rejected") == [
        ("yardi_units_2025_01.csv", 4, 5), ("yardi_units_2025_02.csv", 1, 1), ("yardi_units_2025_03.csv", 0, 1)
    ]


def test_broken_rows_of_free_text_and_strict_reads(spark, tmp_path, rows):
    write(tmp_path, "2025_01", {"gbp_reviews": ['G1,C001,2025-01-01,5,"two\nlines",,', "G2,C001,2025-01-01", "G3,C001,2025-01-01,4,fine,,", 'G4,C001,2025-01-01,4,"open,,']})
    landed = feeds.land_files(spark, str(tmp_path), "gbp_reviews")
    assert rows(feeds.accepted(landed), "review_id", "review_text") == [("G1", "two\nlines"), ("G3", "fine")]
    assert [(r.problem, r.raw_line[:2]) for r in feeds.refused(landed).orderBy("raw_line").collect()] == [("too few cells", "G2"), ("unclosed quote", "G4")]
    write(tmp_path, "2025_01", {"yardi_units": list(BROKEN)})
    assert feeds.read_feed(spark, str(tmp_path), "yardi_units", by_name=False).count() == 4


_ODD_LINES = [  # as units: five cells
    *BROKEN, "", "   ", "\t", "\x00", " , ,\t,\x01,", "U1,C001,AL,4000,2025-01-01", '"U\u00e9","",AL,"4,0""00", x ', 'U1"2,a"b"c,d,e,f', '"a"b,c,d,e,f', "#1,\\,\\,',\u2028",
    '"a,b,c,d,e', 'a,b,c,d,"', "a,b,c,d,e\x85", ",", ",,,,,", '""', "\x1f", "U\x00,C,\x00,\x00,", '"U\x00,",C,"",,\u3000',
]


@pytest.mark.parametrize("large_file", [feeds.LARGE_FILE, 1])
def test_lines_are_cut_as_the_csv_reader_cuts_them(spark, tmp_path, monkeypatch, large_file):
    head = HEADERS["yardi_units"]
    files = {
        "a": "\ufeff\n  \n" + "\n".join([head, *_ODD_LINES]) + "\n", "b": head + "\r\n" + "\r\n".join(_ODD_LINES),
        "c": "Snapshot-Date,Unit ID,x,unit_id\n1,U2,,\n,,,\n1,U3\n", "d": '"unit_id"\n\nU4\n""\n\t\nU5,\n', "e": "", "f": head, "%41 g": head + "\nU6,,,,\n",
    }
    paths = {n: tmp_path / "raw" / f"yardi_units_{n}.csv" for n in files}
    (tmp_path / "raw").mkdir()
    for n, text in files.items():
        paths[n].write_bytes(text.encode())
    with paths["b"].open("ab") as f:
        f.write(b"\r\nU\xff7,\xc3,\xe2\x82,\xed\xa0\x80,\xf0\x9f\x98\r\nU8\xff,\xe2\x82\xc3")
    feeds.land_files(spark, str(tmp_path / "raw"), "yardi_units").write.parquet(str(tmp_path / "csv"))
    monkeypatch.setattr(feeds, "LARGE_FILE", large_file)
    monkeypatch.setattr(feeds, "read_layout", None)  # nothing here needs the slower reader
    feeds.write_files(spark, {str(p): p.stat().st_size for p in paths.values()}, "yardi_units", str(tmp_path / "lines"))
    key = lambda rows_: sorted(rows_, key=str)
    got, expected = (key(tuple(r) for r in spark.read.parquet(str(tmp_path / n)).drop("ingestion_timestamp").collect()) for n in ("lines", "csv"))
    assert got == expected and len(got) > 50
    landed = spark.read.schema(feeds.landed_schema("yardi_units")).parquet(str(tmp_path / "lines"))
    assert {r["problem"] for r in feeds.refused(landed).collect()} >= {"too many cells", "too few cells", "unclosed quote"}


def test_lines_of_data_that_equal_a_header_are_kept(spark, tmp_path):
    head, other = HEADERS["yardi_units"], "Unit ID,community_id,unit_type,monthly_rent,snapshot_date"
    write(tmp_path, "2025_01", {"yardi_units": ["U1,C001,AL,1,x", head, head]})
    (tmp_path / "yardi_units_2025_02.csv").write_text(f"{other}\n{head}\nU2,C001,AL,1,x\n")
    sizes = {str(p): p.stat().st_size for p in tmp_path.glob("*.csv")}
    feeds.write_files(spark, sizes, "yardi_units", str(tmp_path / "out"))
    ids = sorted(r["unit_id"] for r in feeds.accepted(spark.read.schema(feeds.landed_schema("yardi_units")).parquet(str(tmp_path / "out"))).collect())
    assert ids == ["U1", "U2", "unit_id", "unit_id", "unit_id"]


def test_a_large_file_is_read_no_further_than_its_header(spark, tmp_path, monkeypatch):
    write(tmp_path, "2025_01", {"yardi_units": [f"U{i},C001,AL,1,x" for i in range(200_000)]})
    path = str(next(tmp_path.glob("*.csv")))
    monkeypatch.setattr(feeds, "_first_lines", None)
    monkeypatch.setattr(feeds, "LARGE_FILE", 1 << 20)
    assert feeds.first_lines(spark, {path: 3 << 20}) == [(f"file:{path}", HEADERS["yardi_units"])]


def test_feeds_are_ingested_from_folders_of_their_own(spark, tmp_path):
    write(tmp_path / "raw" / "one", "2025_01", {"yardi_units": JANUARY["yardi_units"]})
    write(tmp_path / "raw" / "two", "2025_02", {"yardi_units": ["U1,C001,AL,1,x"]})
    for _ in range(2):
        ing.ingest(spark, f"{tmp_path}/raw/*", f"{tmp_path}/bronze", f"{tmp_path}/ledger", ("yardi_units",))
        assert ing.read_bronze(spark, f"{tmp_path}/bronze", "yardi_units").count() == len(JANUARY["yardi_units"]) + 1


def test_incremental_ingest(spark, tmp_path, rows):
    raw = tmp_path / "raw"
    write(raw, "2025_01", JANUARY)
    first = {f: df.count() for f, df in _load(spark, tmp_path).items()}
    again = {f: df.count() for f, df in _load(spark, tmp_path).items()}
    assert first == again == {"pcc_residents": 2, "yardi_leases": 5}

    write(raw, "2025_02", FEBRUARY)
    tables = _load(spark, tmp_path)
    assert {f: df.count() for f, df in tables.items()} == {"pcc_residents": 3, "yardi_leases": 6}
    assert rows(ing.processed_files(tables), "file_name", "dataset", "rows_loaded") == [
        ("pcc_residents_2025_01.csv", "pcc_residents", 2),
        ("pcc_residents_2025_02.csv", "pcc_residents", 1),
        ("yardi_leases_2025_01.csv", "yardi_leases", 5),
        ("yardi_leases_2025_02.csv", "yardi_leases", 1),
    ]
    assert ing.repeated_loads(tables["yardi_leases"]).count() == 0
    delivered = feeds.read_feed(spark, str(raw), "yardi_leases")
    assert ing.file_count_differences(tables["yardi_leases"], delivered).count() == 0
    twice = tables["yardi_leases"].unionByName(tables["yardi_leases"].filter("source_file LIKE '%01.csv'"))
    assert rows(ing.file_count_differences(twice, delivered)) == [("yardi_leases_2025_01.csv", 10, 5)]


def test_a_batch_that_is_repeated_replaces_its_own_rows(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "2025_01", JANUARY)
    _load(spark, tmp_path)
    # a lost commit makes the stream run batch 0 again
    for commit in (tmp_path / "ledger" / "yardi_leases" / "first" / "commits").iterdir():
        commit.unlink()
    assert _load(spark, tmp_path)["yardi_leases"].count() == 5


def test_missing_feed_is_an_empty_table(spark, tmp_path):
    empty = ing.read_bronze(spark, str(tmp_path / "nothing"), "adp_shifts")
    assert empty.count() == 0
    assert CLEANERS["adp_shifts"](empty).count() == 0


def test_latest_resident_by_load_or_by_snapshot_month(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "2025_02", {"pcc_residents": FEBRUARY["pcc_residents"]})
    _load(spark, tmp_path, ("pcc_residents",))
    write(raw, "2025_01", {"pcc_residents": JANUARY["pcc_residents"]})  # the older file arrives later
    bronze = _load(spark, tmp_path, ("pcc_residents",))["pcc_residents"]
    clean = CLEANERS["pcc_residents"]
    names = lambda df: {r["resident_id"]: r["last_name"] for r in df.collect()}
    assert names(clean(bronze)) == {"R1": "Old", "R2": "Same"}
    assert names(clean(bronze, by_snapshot_month=True)) == {"R1": "New", "R2": "Same"}


def test_files_of_one_load_are_ordered_by_month(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "2025_01", {"pcc_residents": JANUARY["pcc_residents"]})
    write(raw, "2025_02", FEBRUARY)
    bronze = _load(spark, tmp_path, ("pcc_residents",))["pcc_residents"]
    assert {r["last_name"] for r in CLEANERS["pcc_residents"](bronze).collect()} == {"New", "Same"}


def test_full_reload_replaces_and_ingest_goes_on(spark, tmp_path):
    raw, count = tmp_path / "raw", lambda f: ing.read_bronze(spark, f"{tmp_path}/bronze", f).count()
    feeds_ = ("pcc_residents", "yardi_leases")
    write(raw, "2025_01", JANUARY)
    _load(spark, tmp_path)
    write(raw, "2025_02", FEBRUARY)
    _load(spark, tmp_path)
    assert (count("pcc_residents"), count("yardi_leases")) == (3, 6)
    (raw / "yardi_leases_2025_01.csv").write_text(HEADERS["yardi_leases"] + "\nL9,R1,U1,C001,2025-01-01,,,10\n")  # delivered again
    ing.full_reload(spark, str(raw), f"{tmp_path}/bronze", f"{tmp_path}/ledger", feeds_)
    assert (count("pcc_residents"), count("yardi_leases")) == (3, 2)
    _load(spark, tmp_path)
    assert (count("pcc_residents"), count("yardi_leases")) == (3, 2)
    write(raw, "2025_03", {"yardi_leases": ["L10,R1,U1,C001,2025-03-01,,,10"]})
    _load(spark, tmp_path)
    assert (count("pcc_residents"), count("yardi_leases")) == (3, 3)
    ing.full_reload(spark, str(raw), f"{tmp_path}/bronze", f"{tmp_path}/ledger", feeds_)
    assert count("yardi_leases") == 3


def test_a_failed_reload_changes_nothing(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw, "2025_01", JANUARY)
    before = _load(spark, tmp_path)["yardi_leases"].count()
    (raw / "yardi_leases_2025_02.csv").write_text("unit,community_id\nU2,C002\n")
    with pytest.raises(Exception, match="no lease_id header"):
        ing.full_reload(spark, str(raw), f"{tmp_path}/bronze", f"{tmp_path}/ledger", ("yardi_leases",))
    assert ing.read_bronze(spark, f"{tmp_path}/bronze", "yardi_leases").count() == before


def test_region_table(spark):
    regions = dim_community_region(spark)
    assert regions.count() == 14
    assert {(r["state"], r["region"], r["n"]) for r in regions.groupBy("state", "region").agg(F.count("*").alias("n")).collect()} == {
        ("OR", "Pacific Northwest", 4), ("AZ", "Southwest", 4), ("TX", "South", 6),
    }


def test_export_takes_dimensions_and_facts_only(spark, tmp_path):
    tables = {n: spark.range(3) for n in ("dim_a", "fact_b", "silver_c")}
    assert export.export_tables(tables, str(tmp_path)) == ["dim_a", "fact_b"]
    assert spark.read.parquet(f"{tmp_path}/fact_b.parquet").count() == 3
    assert not (tmp_path / "silver_c.parquet").exists()
    spark.range(2).createOrReplaceTempView("dim_temp_view")
    assert "dim_temp_view" in export.export_catalog_tables(spark, str(tmp_path / "catalog"))


def test_a_month_is_exported_again_alone(spark, tmp_path):
    rows_ = [(i, f"2025-0{1 + i % 3}-0{1 + i % 7}" if i % 10 else None) for i in range(60)]
    df = spark.createDataFrame(rows_, "i int, day string").withColumn("day", F.col("day").cast("date"))
    exported = export.export_by_month(df, "day", str(tmp_path / "fact"))
    assert exported.count() == 60 and exported.filter("year IS NULL").count() == 6
    files = lambda: {p.parent.name + p.parent.parent.name + p.name for p in (tmp_path / "fact").rglob("*.parquet")}
    before = files()
    exported = export.export_by_month(df.filter("month(day) = 2").withColumn("i", F.col("i") + 100), "day", str(tmp_path / "fact"))
    assert {f for f in before ^ files()} == {f for f in before | files() if f.startswith("month=2year=2025")}
    months = spark.createDataFrame([(2025, 2, "a"), (2025, 2, "b")], "year int, month int, note string")
    got = export.in_months(exported, months)
    assert sorted(r["i"] for r in got.collect()) == sorted(i + 100 for i, d in rows_ if d and d.startswith("2025-02"))
    assert got.columns == ["i", "day", "year", "month"]


def test_months_prune_the_folders_while_the_query_runs(spark, tmp_path):
    df = spark.range(3000).select("id", F.expr("date_add(DATE '2024-01-01', cast(id % 700 as int))").alias("day"))
    exported = export.export_by_month(df, "day", str(tmp_path / "fact"))
    spark.range(24).select((2024 + F.col("id") / 12).cast("int").alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"), F.concat(F.lit("Q"), (F.col("id") % 12 / 3).cast("int")).alias("quarter")).write.parquet(str(tmp_path / "months"))
    wanted = spark.read.parquet(str(tmp_path / "months")).filter("quarter = 'Q0'")
    plan = export.in_months(exported, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan
