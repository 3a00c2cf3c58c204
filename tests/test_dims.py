import datetime as dt

import pytest

from landfall import schemas
from landfall.operators import dims, quality
from landfall.sources import readers
from tests.shapes import write_inputs


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    return write_inputs(spark, tmp_path_factory.mktemp("inputs"))


def typed(df):
    return [(f.name, f.dataType) for f in df.schema]


def test_temperature(spark, inputs):
    dim = dims.build_temperature_dim(readers.read_temperature(spark, inputs.temperature))
    assert typed(dim) == typed(spark.createDataFrame([], schemas.COUNTRY))
    assert sorted(map(tuple, dim.collect())) == [("Northland", 15.0, 0), ("South Isles", -3.5, 1)]


def test_temperature_tie_break(spark, inputs):
    readings = readers.read_temperature(spark, inputs.temperature).selectExpr(
        "*", "-AverageTemperature as later_first"
    )
    rows = dims.country_temperatures(readings, tie_break="later_first").collect()
    assert {r[0]: r[1] for r in rows}["Northland"] == 16.0


def test_missing_and_equal_tie_breaks(spark):
    rows = [("d", "A", "X", 10.0, None), ("d", "A", "X", 20.0, 5), ("d", "B", "X", 7.0, 1), ("d", "B", "X", 4.0, 1)]
    df = spark.createDataFrame(rows, "dt string, City string, Country string, AverageTemperature double, t int")
    assert sorted(r[0] for r in dims.one_reading_each(df, tie_break="t").select("AverageTemperature").collect()) == [4.0, 20.0]


def test_a_place_without_numbers_gives_way(spark):
    from landfall.operators.lookup import state_coordinates

    states = spark.createDataFrame([("A",), ("B",), ("C",)], "state_code string")
    places = spark.createDataFrame(
        [("A", None, None), ("A", 1.0, 2.0), ("B", None, None), ("C", 3.0, None), ("C", 5.0, 6.0)],
        "State string, Latitude double, Longitude double",
    )
    found = {r[0]: tuple(r)[1:] for r in state_coordinates(states, places).collect()}
    assert found == {"A": (1.0, 2.0), "B": (None, None), "C": (5.0, 6.0)}


def test_one_whole_row_of_a_repeated_city(spark):
    names = ["City", "State Code", "Total Population", "Male Population", "Female Population", "Number of Veterans", "Foreign-born"]
    df = spark.createDataFrame([("A", "S", 100, 60, 40, 1, 9), ("A", "S", 90, 30, 60, 8, 2)], names)
    places = spark.createDataFrame([], "State string, Latitude double, Longitude double")
    row = dims.state_populations(df, places, dedupe_on=["City", "State Code"]).first()
    assert tuple(row)[:6] == ("S", 100, 60, 40, 1, 9)


def test_demographics(spark, inputs):
    cities = readers.read_demographics(spark, inputs.demographics)
    places = readers.read_state_coordinates(spark, inputs.state_coordinates)
    dim = dims.build_demographics_dim(cities, places)
    assert typed(dim) == typed(spark.createDataFrame([], schemas.DEMOGRAPHICS))
    assert sorted(map(tuple, dim.collect())) == [
        ("DC", 3, 1, 2, 4, 5, 38.90409, -77.017, 0),
        ("NY", 250, 80, 120, 10, 17, 42.1, -74.9, 1),
        ("PR", 20, None, 9, 0, 0, None, None, 2),
        ("WA", 3, 1, 2, 4, 5, 38.9041, -77.017, 3),
    ]
    once = dims.state_populations(cities, places, dedupe_on=["City", "State Code"])
    assert tuple(once.where("state_code = 'NY'").first())[:6] == ("NY", 150, 40, 60, 5, 10)
    shared = quality.shared_coordinates(dim).collect()
    assert [(r["states"], r["first_state"], r["last_state"]) for r in shared] == [(2, "DC", "WA")]


def test_airports(spark, inputs):
    raw = readers.read_airports(spark, inputs.airports)
    dim = dims.build_airports_dim(raw)
    assert typed(dim) == typed(spark.createDataFrame([], schemas.AIRPORTS))
    assert sorted(map(tuple, dim.collect())) == [
        ("K1", "One, Field", "NYC", "NY", 40.1, -73.5, 0),
        ("K2", "Two", "NYC", "NY", 40.2, -73.6, 1),
        ("K4", "Four", "LAX", None, None, None, 2),
        ("K5", "Five", "SFR", "CA", None, None, 3),
    ]
    swapped = dims.us_airports(raw, order="lon,lat").where("ident = 'K1'").first()
    assert (swapped["latitude"], swapped["longitude"]) == (-73.5, 40.1)


def test_dates(spark):
    day = dt.date(2016, 1, 3)
    fact = spark.createDataFrame([(day,), (None,), (day,), (dt.date(2015, 1, 1),)], "arrival_date date")
    dim = dims.build_date_dim(fact)
    assert typed(dim) == typed(spark.createDataFrame([], schemas.ARRIVAL_TIME))
    assert sorted(map(tuple, dim.collect()), key=lambda r: r[-1]) == [
        (None, None, None, None, None, None, 0),
        (dt.date(2015, 1, 1), 1, 1, 1, 2015, 5, 1),
        (day, 3, 53, 1, 2016, 1, 2),
    ]
