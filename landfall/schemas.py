"""Declared column types of every raw input and output table."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


def _named(columns: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_STR, _DBL, _INT, _LONG, _DATE = (
    T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.DateType(),
)

# The column names of the inputs and of the stored tables.

# Raw arrival records. Numbers arrive as doubles; dates as day numbers.
ARRIVALS_RAW = _named([
    ("cicid", _DBL), ("i94yr", _DBL), ("i94mon", _DBL), ("i94cit", _DBL), ("i94res", _DBL),
    ("i94port", _STR), ("arrdate", _DBL), ("i94mode", _DBL), ("i94addr", _STR),
    ("depdate", _DBL), ("i94bir", _DBL), ("i94visa", _DBL), ("count", _DBL),
    ("dtadfile", _STR), ("visapost", _STR), ("occup", _STR), ("entdepa", _STR),
    ("entdepd", _STR), ("entdepu", _STR), ("matflag", _STR), ("biryear", _DBL),
    ("dtaddto", _STR), ("gender", _STR), ("insnum", _STR), ("airline", _STR),
    ("admnum", _DBL), ("fltno", _STR), ("visatype", _STR),
])

COUNTRY_CODES_RAW = _schema(code=_INT, description=_STR)

STATE_COORDINATES_RAW = _schema(State=_STR, Latitude=_DBL, Longitude=_DBL)

TEMPERATURE_RAW = _schema(dt=_DATE, AverageTemperature=_DBL, City=_STR, Country=_STR)

DEMOGRAPHICS_RAW = _named([
    ("State Code", _STR), ("Total Population", _LONG), ("Male Population", _LONG),
    ("Female Population", _LONG), ("Number of Veterans", _LONG), ("Foreign-born", _LONG),
])

AIRPORTS_RAW = _schema(
    ident=_STR, name=_STR, iso_country=_STR, iso_region=_STR, iata_code=_STR, coordinates=_STR,
)

# Output tables.
FACT = _schema(
    immigration_id=_LONG, arrival_year=_INT, arrival_month=_INT, port_of_entry=_STR,
    travel_mode=_STR, destination_state=_STR, arrival_date=_DATE, departure_date=_DATE,
    country=_STR, country_of_residence=_STR, visatype=_STR, visa_category=_STR,
    birth_year=_INT, gender=_STR,
)

# First and last date in each month folder of the fact.
FACT_RANGES = _schema(
    arrival_year=_INT, arrival_month=_INT, first_date=_DATE, last_date=_DATE,
)

# Arrivals per day, mode and visa category, stored by month beside the fact.
DAILY = _schema(
    arrival_date=_DATE, travel_mode=_STR, visa_category=_STR, arrivals=_LONG,
    arrival_year=_INT, arrival_month=_INT,
)

ARRIVAL_TIME = _schema(
    arrival_date=_DATE, day=_INT, week=_INT, month=_INT, year=_INT, weekday=_INT, id=_LONG,
)

COUNTRY = _schema(country=_STR, average_temperature=_DBL, id=_LONG)

DEMOGRAPHICS = _schema(
    state_code=_STR, total_population=_LONG, male_population=_LONG, female_population=_LONG,
    number_of_veterans=_LONG, foreign_born=_LONG, latitude=_DBL, longitude=_DBL, id=_LONG,
)

AIRPORTS = _schema(
    ident=_STR, name=_STR, iata_code=_STR, state_code=_STR, latitude=_DBL, longitude=_DBL,
    id=_LONG,
)

# Filters of the record ids, stored by month beside the fact.
ID_FILTERS = _schema(part_bits=_INT, part=_INT, bits=T.BinaryType(), arrival_year=_INT, arrival_month=_INT)

STORED = {
    "immigration_fact": FACT,
    "arrival_time": ARRIVAL_TIME,
    "country": COUNTRY,
    "us_population_demographics": DEMOGRAPHICS,
    "us_airports": AIRPORTS,
    "daily_arrivals": DAILY,
    "id_filters": ID_FILTERS,
    "quarantine": _schema(source=_STR, file=_STR, record=_STR, reason=_STR),
    "arrival_time_ids": _schema(arrival_date=_DATE, id=_LONG),
    "country_ids": _schema(country=_STR, id=_LONG),
    "us_population_demographics_ids": _schema(state_code=_STR, id=_LONG),
    "us_airports_ids": _schema(ident=_STR, occurrence=_INT, id=_LONG),
}

LABELS = _schema(format=_STR, code=_STR, label=_STR)
