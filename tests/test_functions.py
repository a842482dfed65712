"""Column functions on hand-made edge values."""

import datetime

import pytest
from pyspark.sql import functions as F

from emberwatch.functions import display, labels, numbers, places, times

TEXT = "v string"


def values(spark, rows, schema, *columns):
    frame = spark.createDataFrame([row if isinstance(row, tuple) else (row,) for row in rows], schema)
    picked = [tuple(row) for row in frame.coalesce(1).select(*columns).collect()]
    return [row[0] if len(columns) == 1 else row for row in picked]


def test_status_rules_differ(spark):
    given = ["fire", " FIRE", "Fire-Risk", "CHÁY", "2", "2.0", "an toàn", "", None]
    label, status = labels.normalise_label(F.col("v")), labels.normalise_status(F.col("v"))
    assert values(spark, given, TEXT, label, status) == [
        ("FIRE", "FIRE"),
        ("UNKNOWN", "FIRE"),
        ("UNKNOWN", "RISK"),
        ("UNKNOWN", "FIRE"),
        ("UNKNOWN", "FIRE"),
        ("UNKNOWN", "UNKNOWN"),
        ("UNKNOWN", "NORMAL"),
        ("UNKNOWN", "UNKNOWN"),
        ("UNKNOWN", "UNKNOWN"),
    ]


def test_empty_status_hides_later_fields(spark):
    columns = [F.col(name) for name in ("a", "b", "c", "d", "e")]
    given = [("", "FIRE", None, None, None), (None, "FIRE", None, None, None), (None, None, None, None, "ok")]
    schema = "a string, b string, c string, d string, e string"
    assert values(spark, given, schema, labels.status_alias(*columns)) == ["UNKNOWN", "FIRE", "NORMAL"]


def test_resolve_status_prefers_a_valid_label(spark):
    given = [(" fire ", "0"), ("strange", "1.9"), (None, "2.0"), ("nan", None), (None, "7"), (None, "1e30"), (None, "inf")]
    column = labels.resolve_status(F.col("label"), F.col("code"))
    assert values(spark, given, "label string, code string", column) == [
        "FIRE", "FIRE_RISK", "FIRE", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN",
    ]


def test_missing_texts(spark):
    given = [None, "", "  ", " None", "NULL", "nan", "0", "x", "\t\n"]
    assert values(spark, given, TEXT, labels.is_missing(F.col("v"))) == [True, True, True, True, True, True, False, False, True]


def test_numbers_are_lenient(spark):
    given = ["1.5", " 2 ", "1e3", "1d", "2f", "abc", "", "NaN", "Infinity", "-Infinity", None]
    number, finite = numbers.to_number(F.col("v")), numbers.to_finite(F.col("v"))
    inf = float("inf")
    assert values(spark, given, TEXT, number, finite) == [
        (1.5, 1.5), (2.0, 2.0), (1000.0, 1000.0), (None, None), (None, None), (None, None),
        (None, None), (None, None), (inf, None), (-inf, None), (None, None),
    ]
    assert values(spark, ["x", "4"], TEXT, numbers.safe_float(F.col("v"), 9.0)) == [9.0, 4.0]


def test_percent_clamps_but_keeps_missing(spark):
    given = ["0.5", "50", "-1", "n/a", None]
    assert values(spark, given, TEXT, numbers.percent_clamped(F.col("v"))) == [50.0, 100.0, 0.0, None, None]


def test_renormalised_needs_three_valid_shares(spark):
    given = [(0.5, 0.25, 0.25), (0.0, 0.0, 0.0), (-0.1, 0.5, 0.6), (None, 0.5, 0.5), (1.0, 1.0, 2.0), (float("nan"), 1.0, 1.0)]
    columns = numbers.renormalised(F.col("a"), F.col("b"), F.col("c"))
    none = (None, None, None)
    assert values(spark, given, "a double, b double, c double", *columns) == [
        (50.0, 25.0, 25.0), none, none, none, (25.0, 25.0, 50.0), none,
    ]


def test_times(spark):
    given = ["2024-01-05 10:00:00", "2024-01-05", "2024-01-05T10:00:00+07:00", "12:30", "soon", "", None]
    ten = datetime.datetime(2024, 1, 5, 10)
    assert values(spark, given, TEXT, times.parse_time(F.col("v"))) == [
        ten, datetime.datetime(2024, 1, 5), ten - datetime.timedelta(hours=7), None, None, None, None,
    ]


def test_empty_store_time_differs_by_dashboard(spark):
    given = [("", "2024-01-05 10:00:00"), (None, "2024-01-05 10:00:00"), ("bad", "2024-01-05 10:00:00")]
    ten = datetime.datetime(2024, 1, 5, 10)
    web = times.data_time_web(F.col("stored"), F.col("sensor"))
    plain = times.data_time(times.parse_time(F.col("stored")), times.parse_time(F.col("sensor")))
    assert values(spark, given, "stored string, sensor string", web, plain) == [(None, ten), (ten, ten), (None, ten)]


@pytest.mark.parametrize(
    "age, fresh, state",
    [(-61.0, False, "OFFLINE"), (-60.0, True, "ONLINE"), (0.0, True, "ONLINE"), (120.0, True, "ONLINE"),
     (120.001, False, "OFFLINE"), (121.0, False, "OFFLINE"), (None, False, "UNKNOWN")],
)
def test_freshness_bounds(spark, age, fresh, state):
    row = values(spark, [(age,)], "age double", labels.is_fresh(F.col("age")), labels.connection_state(F.col("age")))
    assert row == [(fresh, state)]


def test_age_keeps_fractions(spark):
    moment = datetime.datetime(2024, 1, 30, 0, 0, 0, 500000)
    assert values(spark, [(moment,)], "t timestamp_ntz", times.age_seconds(F.col("t"), "2024-01-31 00:00:00")) == [86399.5]
    later = datetime.datetime(2024, 1, 31)
    assert values(spark, [(moment,)], "t timestamp_ntz", times.age_seconds(F.col("t"), later)) == [86399.5]


TIES = [0.25, 0.35, 25.81875, 35.12345, 12.5, 13.5, 0.125, 2.675, 1.005, 99999.95, 999999.4, 0.00012345675, 0.0001, 100.0, 20.0]
OTHERS = [0.0, -0.0, -3.5, 1e-5, 123456.7, 7.0, 560.21, 1e6, 1234567.0, 3.00001, 9.999995, -0.04]


def test_decimal_text_equals_correct_rounding(spark):
    given = TIES + OTHERS
    columns = [display.format_general(F.col("v")), *[display.format_fixed(F.col("v"), digits) for digits in range(4)]]
    expected = [(f"{v:g}", f"{v:.0f}", f"{v:.1f}", f"{v:.2f}", f"{v:.3f}") for v in given]
    assert values(spark, given, "v double", *columns) == expected


def test_decimal_text_on_many_values(spark):
    import random

    source = random.Random(7)
    given = [round(source.uniform(-999, 999), source.randint(0, 6)) for _ in range(2000)]
    given += [(source.randint(0, 10**6) + 0.5) / 10 ** source.randint(1, 8) for _ in range(2000)]
    columns = [display.format_general(F.col("v")), display.format_fixed(F.col("v"), 1)]
    assert values(spark, given, "v double", *columns) == [(f"{v:g}", f"{v:.1f}") for v in given]


def test_measures_and_probabilities(spark):
    nan, inf = float("nan"), float("inf")
    given = [48.2, 50.0, None, nan, inf]
    assert values(spark, given, "v double", display.display_measure(F.col("v"), " ppm")) == ["48.2 ppm", "50 ppm", "N/A", "N/A", "inf ppm"]
    assert values(spark, given, "v double", display.fixed_measure(F.col("v"), 1))[:4] == ["48.2", "50.0", "—", "—"]
    texts = ["48.20", "none", "broken", " 7 "]
    assert values(spark, texts, TEXT, display.display_measure_text(F.col("v"), " ppm")) == ["48.2 ppm", "N/A", "broken ppm", "7 ppm"]
    shares = [0.5, 1.0, 0.0, 50.0, -0.5, None, nan, 0.9951]
    assert values(spark, shares, "v double", display.display_probability(F.col("v"))) == [
        "50.0%", "100.0%", "0.0%", "50.0%", "-0.5%", "N/A", "N/A", "99.5%",
    ]
    assert values(spark, ["0.25", "x"], TEXT, display.display_probability_text(F.col("v"))) == ["25.0%", "N/A"]


def test_zone_names(spark):
    given = ["Kho_Hoa_Chat", "Khu_Moi", None]
    assert values(spark, given, TEXT, places.zone_label(F.col("v"))) == ["Kho Hóa Chất", "Khu_Moi", None]
    assert values(spark, given, TEXT, places.zone_label_web(F.col("v"))) == ["Kho Hóa Chất", "Khu Moi", None]
    zone = places.record_zone(F.col("a"), F.col("b"), F.col("c"))
    assert values(spark, [("", "x", "y"), (None, None, "y"), (None, None, None)], "a string, b string, c string", zone) == ["", "y", "Chưa xác định"]


def test_threshold_is_strict(spark):
    given = [(65.0, 0.0), (65.1, 0.0), (50.0, 200.0), (50.1, 0.0), (0.0, 400.1), (None, 400.1), (None, None)]
    columns = labels.threshold_label(F.col("t"), F.col("s")), labels.threshold_code(F.col("t"), F.col("s"))
    assert values(spark, given, "t double, s double", *columns) == [
        ("FIRE_RISK", 1), ("FIRE", 2), ("NORMAL", 0), ("FIRE_RISK", 1), ("FIRE", 2), ("FIRE", 2), ("NORMAL", 0),
    ]


def test_web_numbers(spark):
    cases = {"": None, " ": 0.0, "0x10": 16.0, " 0B101 ": 5.0, "0o17": 15.0, " 2.5\n": 2.5, "-0x1": None, "0x": None, "1d": None, "x": None, "1e400": None}
    rows = spark.createDataFrame([(text,) for text in cases], "v string")
    got = {row.v: row.n for row in rows.select("v", numbers.web_number(F.col("v")).alias("n")).collect()}
    assert got == cases
