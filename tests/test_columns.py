"""Column helpers, one edge case per row."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall import schemas
from landfall.functions import codes, dates, text
from landfall.operators.codebook import label_rows


def one(spark, kind, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_day_number_to_date(spark):
    cases = {
        20545.0: dt.date(2016, 4, 1),
        0.0: None,
        -0.0: None,
        1.9: dt.date(1960, 1, 2),
        0.5: dt.date(1960, 1, 1),
        -0.5: dt.date(1960, 1, 1),
        -1.5: dt.date(1959, 12, 31),
        float("nan"): None,
        float("inf"): None,
        1e12: None,
        float((dt.date.max - dt.date(1960, 1, 1)).days): dt.date.max,
        float((dt.date.max - dt.date(1960, 1, 1)).days + 1): None,
        float((dt.date.min - dt.date(1960, 1, 1)).days): dt.date.min,
        None: None,
    }
    assert one(spark, "double", list(cases), dates.day_number_to_date("x")) == list(cases.values())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dates(), min_size=1, max_size=50))
def test_day_number_round_trip(spark, days):
    days = [d for d in days if d != dates.EPOCH] or [dt.date(2016, 4, 1)]
    numbers = [float((d - dates.EPOCH).days) for d in days]
    assert one(spark, "double", numbers, dates.day_number_to_date("x")) == days


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 1),), (dt.date(2016, 4, 3),), (None,)], "d date")
    rows = df.select(*[c.alias(n) for n, c in dates.calendar_parts("d").items()]).collect()
    assert [tuple(r) for r in rows] == [
        (1, 53, 1, 2016, 6), (3, 13, 4, 2016, 1), (None, None, None, None, None),
    ]


def test_overlapping_partitions(spark):
    day = dt.date
    ranges = spark.createDataFrame([
        (2015, 11, day(2015, 11, 1), day(2015, 11, 30)),
        (2015, 12, day(2015, 12, 1), day(2016, 1, 2)),
        (2016, 1, None, None),
        (2016, 4, day(2016, 3, 31), day(2016, 4, 2)),
        (None, 5, day(2016, 2, 1), day(2016, 2, 1)),
    ], schemas.FACT_RANGES)
    rows = ranges.where(dates.overlapping_partitions(ranges, day(2016, 1, 1), day(2016, 3, 31)))
    kept = rows.select("arrival_year", "arrival_month").collect()
    assert {tuple(r) for r in kept} == {(2015, 12), (2016, 4), (None, 5)}
    none = dates.overlapping_partitions(ranges.limit(0), day(2016, 1, 1), day(2016, 3, 31))
    assert ranges.where(none).count() == 0


def test_names(spark):
    names = ["VELMOR ", "FAR REEF/OUTER", "TWIN-SUNS", "LOCK AND WHARF", None]
    assert one(spark, "string", names, text.display_name("x")) == [
        "Velmor", "Far Reef/outer", "Twin-suns", "Lock And Wharf", None,
    ]
    spellings = ["Twin-Suns", "TWIN SUNS ", " twin--suns", "Zéphyr D'Ys", None]
    assert one(spark, "string", spellings, text.name_key("x")) == [
        "twin suns", "twin suns", "twin suns", "zéphyr d ys", None,
    ]


def test_region_and_coordinates(spark):
    assert one(spark, "string", ["US-CA", "US-U-A", "US", None], text.region_state("x")) == [
        "CA", "U-A", "", None,
    ]
    places = ["40.07, -74.93", "40.07,-74.93", "40.07", "unknown, x", "", None]
    assert one(spark, "string", places, text.coordinate("x", 0)) == [
        40.07, 40.07, 40.07, None, None, None,
    ]
    assert one(spark, "string", places, text.coordinate("x", 1)) == [
        -74.93, -74.93, None, None, None, None,
    ]


def test_codes(spark):
    numbers = [1.0, 2.0, 3.0, 9.0, 5.0, None, float("nan")]
    assert one(spark, "double", numbers, codes.travel_mode("x")) == [
        "Air", "Sea", "Land", *["Not Reported"] * 4,
    ]
    assert one(spark, "double", numbers, codes.visa_category("x")) == [
        "Business", "Pleasure", "Student", *["Unknown"] * 4,
    ]
    assert one(spark, "double", numbers, codes.travel_mode_status("x")) == [
        "reported", "reported", "reported", "not reported", "other code", "missing", "other code",
    ]
    odd = [582.0, 582.5, float("nan"), 1e300, None, -1.0]
    assert one(spark, "double", odd, codes.whole_code("x")) == [582, None, None, None, None, -1]


@pytest.mark.parametrize("line, code, label", [
    ("   11 =  'VELMOR High (with a remark)'", "11", "VELMOR High (with a remark)"),
    ("    0  =  'INVALID: ROGUE' ;", "0", "INVALID: ROGUE"),
    ("   'Q1X'\t=\t'UPPER QUAY, VV             '", "Q1X", "UPPER QUAY, VV             "),
    ("   'Q2X'\t=\t'KEEPER''S DOCK, WW      '", "Q2X", "KEEPER'S DOCK, WW      "),
    ("   'R8 '\t=\t'No PORT Code (R8)'", "R8", "No PORT Code (R8)"),
    ("   'R7'\t\t=\t'No PORT Code (R7)'", "R7", "No PORT Code (R7)"),
    ("   'Q9' \t=\t'here; there'", "Q9", "here; there"),
    ("\t'--'='All Other Codes' ;", "--", "All Other Codes"),
    ("\t1 = 'Kite'", "1", "Kite"),
    ("value planetl", None, None),
    ("/* 1 - a comment */", None, None),
    (";", None, None),
])
def test_label_line(spark, line, code, label):
    df = spark.createDataFrame([(line,)], "x string")
    assert [tuple(r) for r in label_rows(df, "x").collect()] == ([(code, label)] if code else [])


def test_country_class(spark):
    labels = ["VELMOR", "INVALID: ROGUE", "Collapsed Shell (a remark)", "No Country Code (3)", None]
    assert one(spark, "string", labels, codes.country_class("x")) == [
        "valid", "INVALID", "Collapsed", "No Country Code", None,
    ]


def test_port_alias_target(spark):
    labels = ["Collapsed (Q1X) 01/02", "Collapsed into Q2X, WW", "QUAYSIDE, VV", None]
    assert one(spark, "string", labels, codes.port_alias_target("x")) == ["Q1X", "Q2X", None, None]
