from datetime import date

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from carelens.functions import dates, numbers, text


def one(spark, column, **values):
    names = {k: v for k, v in values.items()}
    df = spark.createDataFrame([tuple(names.values())], ", ".join(f"{k} string" for k in names))
    return df.select(column.alias("x")).first()["x"]


def test_clean_strips_spaces_only(spark):
    assert one(spark, text.clean("a"), a="  x y ") == "x y"
    assert one(spark, text.clean("a"), a="\tx ") == "\tx"
    assert one(spark, text.clean_upper("a"), a=" rn ") == "RN"
    assert one(spark, text.clean("a"), a=None) is None


@pytest.mark.parametrize(
    ("raw", "level"),
    [
        ("il", "Independent Living"),
        (" Independent ", "Independent Living"),
        ("independent living", "Independent Living"),
        ("AL", "Assisted Living"),
        ("assisted", "Assisted Living"),
        ("MEMORY", "Memory Care"),
        ("mc ", "Memory Care"),
        (" Respite ", "Respite"),
        (None, None),
    ],
)
def test_care_level(spark, raw, level):
    assert one(spark, text.care_level("a"), a=raw) == level


@pytest.mark.parametrize(("raw", "name"), [(" med tech", "Med Tech"), ("rn", "RN"), ("Driver", None), (None, None)])
def test_role_name(spark, raw, name):
    assert one(spark, text.role_name("a"), a=raw) == name


@pytest.mark.parametrize(("raw", "expected"), [("thanks", True), ("   ", False), ("", False), (None, False)])
def test_has_text(spark, raw, expected):
    assert one(spark, text.has_text("a"), a=raw) is expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("2025-01-05", date(2025, 1, 5)),
        ("2025/01/05", date(2025, 1, 5)),
        ("2025-1-5", date(2025, 1, 5)),
        (" 2025-01-05 ", date(2025, 1, 5)),
        ("2025-01-05 10:00:00", date(2025, 1, 5)),
        ("01/05/2025", None),
        ("20250105", None),
        ("2025-02-30", None),
        ("soon", None),
        (None, None),
    ],
)
def test_safe_date(spark, raw, expected):
    assert one(spark, dates.safe_date("a"), a=raw) == expected


def test_weekend_default_marks_mondays_only(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2025-06-01', DATE '2025-06-07')) AS d")  # Sunday .. Saturday
    default = [r[0] for r in days.select(dates.weekend("d")).collect()]
    corrected = [r[0] for r in days.select(dates.weekend("d", corrected=True)).collect()]
    assert default == [False, True, False, False, False, False, False]
    assert corrected == [True, False, False, False, False, False, True]


def test_calendar_parts_use_iso_weeks_and_full_names(spark):
    row = spark.sql("SELECT DATE '2024-12-30' AS d").select(*dates.calendar_parts("d")).first().asDict()
    assert row == {
        "year": 2024, "quarter": 4, "month": 12, "month_name": "December", "day": 30, "weekday": "Monday",
        "week_number": 1, "is_weekend": True,
    }


def test_file_month(spark):
    assert one(spark, dates.file_month("a"), a="pcc_residents_2025_03.csv") == "2025_03"
    assert one(spark, dates.file_month("a"), a="residents.csv") is None


@pytest.mark.parametrize("bad", ["2025", "2025-13", "June", "2025-06-01", ""])
def test_bad_periods_are_refused(bad):
    with pytest.raises(ValueError, match="YYYY-MM"):
        dates.parse_period(bad)


def test_good_period():
    assert dates.parse_period("2025-06") == (2025, 6)


def test_bad_day_is_refused():
    with pytest.raises(ValueError, match="start"):
        dates.parse_day("06/01/2025", "start")


@pytest.mark.parametrize(("raw", "expected"), [("4", 4), ("4.5", 5), ("4.4", 4), ("-4.5", -5), (" 7 ", 7), (None, None)])
def test_whole_number(spark, raw, expected):
    assert one(spark, numbers.whole_number("a"), a=raw) == expected


def test_strict_number_fails_and_lenient_does_not(spark):
    with pytest.raises(NumberFormatException):
        one(spark, numbers.whole_number("a"), a="four")
    assert one(spark, numbers.lenient_whole("a"), a="four") is None
    assert one(spark, numbers.lenient_whole("a"), a="4.5") == 5


@pytest.mark.parametrize(("x", "expected"), [(1.005, 1.0), (2.345, 2.35), (2.5, 2.5), (-1.235, -1.24), (0.125, 0.13)])
def test_round2_rounds_the_binary_value(spark, x, expected):
    # 1.005 * 100 is 100.49999999999999, so it rounds down; -1.235 * 100 is -123.50000000000001
    assert spark.range(1).select(numbers.round2(F.lit(x))).first()[0] == expected


def test_ratio_and_percent_give_null_for_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 8), (None, 4)], "a int, b int")
    assert [r[0] for r in df.select(numbers.ratio("a", "b")).collect()] == [None, 0.125, None]
    assert [r[0] for r in df.select(numbers.percent("a", "b")).collect()] == [None, 12.5, None]


def test_positive_flag_counts_null_as_zero(spark):
    df = spark.createDataFrame([(2.0,), (0.0,), (-1.0,), (None,)], "a double")
    assert [r[0] for r in df.select(numbers.positive_flag("a")).collect()] == [1, 0, 0, 0]


@pytest.mark.parametrize(
    ("raw", "key", "rate"),
    [
        ("{'Caregiver':16, 'RN':46, 'Maintenance':23}", "RN", 46.0),
        ("{'Med Tech': 21.5, 'RN': None}", "Med Tech", 21.5),
        ("{'Med Tech': 21.5, 'RN': None}", "RN", None),
        ("{'RN': '46'}", "RN", 46.0),
        ("{'RN': 46}", "LPN", None),
        ("{'RN': 46}", None, None),
        ("{'RN': 46}", "Driver", None),
        ("{'LPN': 30, 'RN' : 46 }", "RN", 46.0),
        ("{'RN': 46, 'LPN': 30}", "RN", 46.0),
        ("{'Senior RN': 50}", "RN", None),
        ('{"RN": 46}', "RN", 46.0),
        ("{'RN': 46", "RN", None),
        ("16.5", "RN", None),
        ("{'RN': forty}", "RN", None),
        ("16.5 per hour", "RN", None),
        (None, "RN", None),
    ],
)
def test_rate_for(spark, raw, key, rate):
    assert one(spark, numbers.rate_for("a", "k", lenient=True), a=raw, k=key) == rate


@pytest.mark.parametrize("raw", ["{'RN': 4 6}", "{'RN': 46, junk}", "{'RN': 46", "46", "{'RN': 46} {}", "{'RN': 'forty'}"])
def test_a_malformed_rate_is_refused(spark, raw):
    assert one(spark, numbers.rate_for("a", "k", lenient=True), a=raw, k="RN") is None
    assert one(spark, numbers.rate_is_unreadable("a", F.lit("RN")), a=raw) is True
    with pytest.raises(Exception, match="unreadable rate|CAST_INVALID_INPUT"):
        one(spark, numbers.rate_for("a", "k"), a=raw, k="RN")


@pytest.mark.parametrize(
    ("text", "kind", "bad"),
    [("4.5", "int", False), (" 7 ", "double", False), ("abc", "double", True), ("", "int", True), ("NaN", "double", True), ("Infinity", "double", True),
     ("99999999999", "int", True), ("99999999999", "double", False), ("2147483647.4", "int", False), ("2147483647.5", "int", True), (None, "int", False)],
)
def test_unreadable_numbers(spark, text, kind, bad):
    assert one(spark, numbers.is_unreadable("a", kind), a=text) is bad


@pytest.mark.parametrize("text", ["2025", "2025-03", "2025/03", "+2025-01-01", "2025-01-05Tfoo", "2025-01/05", "20250105", "2025-02-30", "x", "2025-01-05Z"])
def test_partial_and_odd_dates_are_null(spark, text):
    assert one(spark, dates.safe_date("a"), a=text) is None


@pytest.mark.parametrize("text", ["2025-01-05", " 2025/1/05 ", "2025 01 5", "2025-01-05 10:00:00", "2025-01-05T10:00:00"])
def test_spellings_of_a_day(spark, text):
    assert str(one(spark, dates.safe_date("a"), a=text)) == "2025-01-05"


def test_unreadable_rates_are_detected(spark):
    assert one(spark, numbers.rate_is_unreadable("a"), a="{'RN' 46") is True
    assert one(spark, numbers.rate_is_unreadable("a"), a="{'RN': 46}") is False
    assert one(spark, numbers.rate_is_unreadable("a"), a=None) is False


@pytest.mark.parametrize(
    ("raw", "bad"),
    [("{'RN': 46, 'Med Tech': None}", False), ("{'RN':46,'LPN':30.25}", False), ("{'RN': 046}", True), ("{'RN': 46.}", True), ("{'RN': -46}", False), ("{'RN': 4 6}", True),
     ("{'RN': 1" + "0" * 400 + "}", True), ("{'RN': Nonesuch}", True), ("{'RN': 'x'}", True), ("{'LPN': 'x', 'RN': 46}", False), ("{}", False), (" {'RN': 46} ", False), (None, False)],
)
def test_usual_rates_need_no_parser_and_others_one(spark, raw, bad):
    assert one(spark, numbers.rate_is_unreadable("a", F.lit("RN")), a=raw) is bad
    text = spark.createDataFrame([(raw,)], "a string").filter(numbers.rate_is_unreadable("a", F.lit("RN")))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1 and text.index("RLIKE") < text.index("from_json")


def test_rates_are_read_by_compiled_expressions(spark):
    rows = [("{'RN': 46, 'Med Tech': None}", "RN", 46.0), ("{'RN': 46, 'Med Tech': None}", "Med Tech", None), ("{'RN':46.5,'LPN':None}", "RN", 46.5),
            ("{'RN': 046}", "RN", 46.0), ("{'RN': 4, 'RN': 5}", "RN", 4.0), ("{'RN': '7'}", "RN", 7.0), ("{'RN': 46}", None, None), (None, "RN", None)]
    df = spark.createDataFrame(rows, "a string, k string, expected double")
    got = df.withColumn("rate", numbers.rate_for("a", "k"))
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert [r["a"] for r in got.collect() if r["rate"] != r["expected"]] == []
