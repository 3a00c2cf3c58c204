"""Hand-written raw inputs, shared by the tests."""

import csv

from landfall import schemas
from landfall.sources.paths import Inputs

ARRIVAL = dict(
    cicid=1.0, i94yr=2016.0, i94mon=4.0, i94cit=582.0, i94res=236.0, i94port="NYC",
    arrdate=20545.0, i94mode=1.0, i94addr="NY", depdate=20550.0, i94bir=36.0, i94visa=1.0,
    count=1.0, biryear=1980.0, gender="F", visatype="B1",
)


def arrivals(spark, *changes):
    """One arrival per change to the plain record."""
    rows = [{**ARRIVAL, "cicid": float(i + 1), **c} for i, c in enumerate(changes)]
    names = schemas.ARRIVALS_RAW.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.ARRIVALS_RAW)


CHANGES = [
    {},
    {"i94mode": 2.0, "i94visa": 2.0},
    {"i94mode": 3.0, "i94visa": 3.0, "i94addr": "CA"},
    {"i94mode": 9.0, "i94visa": 7.0, "i94addr": "XX"},
    {"i94mode": 5.0, "i94cit": 403.0, "i94res": 582.5},
    {"arrdate": 0.0},
    {"arrdate": 20546.7, "depdate": 20540.0},
    {"arrdate": float("nan")},
    {"gender": None},
    {"depdate": None, "gender": None},
    {"cicid": 1.0, "i94port": "SFR"},
    {"i94yr": 2016.0, "i94mon": 5.0, "arrdate": 20575.0, "depdate": 20580.0},
]

COUNTRY_CODES = [
    ("code", "description"), (582, "NORTHLAND"), (236, "SOUTH-ISLES "), (101, "EAST AND WEST"),
]

COORDINATES = [
    ("State", "Latitude", "Longitude", "City"),
    ("NY", 42.1, -74.9, "New York"), ("CA", 37.2, -119.3, "California"),
    ("WA", 38.90410, -77.0170, "Washington"), ("DC", 38.90409, -77.0170, "District"),
]

TEMPERATURE = [
    ("dt", "AverageTemperature", "AverageTemperatureUncertainty", "City", "Country", "Latitude"),
    ("1850-01-01", 10.0, 1.0, "A", "Northland", "1N"),
    ("1850-01-01", 12.0, 1.0, "A", "Northland", "2N"),
    ("1850-02-01", 20.0, 1.0, "A", "Northland", "1N"),
    ("1850-02-01", "", "", "B", "Northland", "1N"),
    ("1850-01-01", -3.5, 1.0, "C", "South Isles", "1S"),
    ("1850-01-01", "", "", "D", "Nowhere", "1S"),
]

DEMOGRAPHICS = [
    ("City", "State", "Median Age", "Male Population", "Female Population", "Total Population",
     "Number of Veterans", "Foreign-born", "State Code", "Race"),
    ("Bigtown", "New York", 30.1, 40, 60, 100, 5, 7, "NY", "One"),
    ("Bigtown", "New York", 30.1, 40, 60, 100, 5, 7, "NY", "Two"),
    ("Smalltown", "New York", 31.5, "", "", 50, "", 3, "NY", "One"),
    ("Island", "Isles", 40.0, "", 9, 20, "", "", "PR", "One"),
    ("Capital", "District", 33.0, 1, 2, 3, 4, 5, "DC", "One"),
    ("Port", "Washington", 33.0, 1, 2, 3, 4, 5, "WA", "One"),
]

AIRPORTS = [
    ("ident", "type", "name", "elevation_ft", "iso_country", "iso_region", "iata_code", "coordinates"),
    ("K1", "large", "One, Field", 10, "US", "US-NY", "NYC", "40.1, -73.5"),
    ("K2", "small", "Two", 10, "US", "US-NY", "NYC", "40.2,-73.6"),
    ("K3", "small", "Three", 10, "US", "US-CA", "", "1, 2"),
    ("K4", "small", "Four", 10, "US", "", "LAX", "bad"),
    ("E1", "large", "Other", 10, "NZ", "NZ-AK", "AKL", "3, 4"),
    ("K5", "small", "Five", 10, "US", "US-CA", "SFR", ""),
]


def _write(path, rows, sep):
    with open(path, "w", newline="") as file:
        csv.writer(file, delimiter=sep).writerows(rows)
    return str(path)


def write_inputs(spark, root, arrival_rows=None, arrivals_format="parquet"):
    root.mkdir(parents=True, exist_ok=True)
    df = arrivals(spark, *CHANGES) if arrival_rows is None else arrival_rows
    path = str(root / "arrivals")
    writer = df.coalesce(1).write.mode("overwrite")
    writer.csv(path, header=True) if arrivals_format == "csv" else writer.parquet(path)
    return Inputs(
        arrivals=path,
        country_codes=_write(root / "codes.csv", COUNTRY_CODES, ";"),
        temperature=_write(root / "temperature.csv", TEMPERATURE, ","),
        demographics=_write(root / "demographics.csv", DEMOGRAPHICS, ";"),
        state_coordinates=_write(root / "coordinates.csv", COORDINATES, ","),
        airports=_write(root / "airports.csv", AIRPORTS, ","),
        arrivals_format=arrivals_format,
    )
