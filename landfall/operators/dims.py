"""The four dimensions.

Each comes in two steps: its rows, and the stored table, which numbers them.
Reports that need no id start from the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.functions import dates, text
from landfall.operators.keys import dense_id
from landfall.operators.lookup import state_coordinates


def arrival_dates(fact: DataFrame) -> DataFrame:
    """One row per arrival date, a null date included. Dates are deduplicated before
    their parts are derived, so one 4-byte column is all that is shuffled."""
    distinct = fact.select("arrival_date").distinct()
    return distinct.withColumns(dates.calendar_parts("arrival_date"))


def build_date_dim(fact: DataFrame) -> DataFrame:
    return dense_id(arrival_dates(fact), "arrival_date")


def one_reading_each(
    df: DataFrame, key=("dt", "City", "Country"), tie_break: str | None = None
) -> DataFrame:
    """Non-null readings, one per key: the one lowest in ``tie_break``, else the lowest.

    A missing ``tie_break`` comes after all others, and of equal ones the lowest reading counts.
    """
    reading = F.min("AverageTemperature")
    if tie_break:
        first = F.struct(F.col(tie_break).isNull(), F.col(tie_break), F.col("AverageTemperature").alias("reading"))
        reading = F.min(first)["reading"]
    return (
        df.dropna(subset=["AverageTemperature"])
        .groupBy(*key)
        .agg(reading.alias("AverageTemperature"))
    )


def country_temperatures(
    df: DataFrame, key=("dt", "City", "Country"), tie_break: str | None = None
) -> DataFrame:
    """Mean temperature per country over its deduplicated readings."""
    return (
        one_reading_each(df, key, tie_break)
        .groupBy(F.col("Country").alias("country"))
        .agg(F.avg("AverageTemperature").alias("average_temperature"))
    )


def build_temperature_dim(
    df: DataFrame, key=("dt", "City", "Country"), tie_break: str | None = None
) -> DataFrame:
    return dense_id(country_temperatures(df, key, tie_break), "country")


# The source's columns and the stored names of their sums.
_MEASURES = {
    "Total Population": "total_population",
    "Male Population": "male_population",
    "Female Population": "female_population",
    "Number of Veterans": "number_of_veterans",
    "Foreign-born": "foreign_born",
}


def state_populations(
    df: DataFrame, coordinates: DataFrame, dedupe_on: list[str] | None = None
) -> DataFrame:
    """Population sums per state with the state's coordinates.

    States without veterans or foreign-born figures get 0; the population sums
    stay null. Pass ``dedupe_on=["City", "State Code"]`` for input that repeats
    a city's totals on several rows. Of rows that differ, one whole row counts: the
    largest by total population, then by the other measures in turn.
    """
    if dedupe_on:
        largest = F.max(F.struct(*[F.col(f"`{c}`") for c in _MEASURES])).alias("_row")
        df = df.groupBy(*dedupe_on).agg(largest).select(*dedupe_on, "_row.*")
    sums = df.groupBy(F.col("State Code").alias("state_code")).agg(
        *[F.sum(c).alias(name) for c, name in _MEASURES.items()]
    )
    return state_coordinates(sums, coordinates).fillna(
        0, subset=["number_of_veterans", "foreign_born"]
    )


def build_demographics_dim(
    df: DataFrame, coordinates: DataFrame, dedupe_on: list[str] | None = None
) -> DataFrame:
    return dense_id(state_populations(df, coordinates, dedupe_on), "state_code")


def us_airports(df: DataFrame, order: str = "lat,lon") -> DataFrame:
    """US airports with a code. ``order`` names the two numbers of the coordinates column."""
    place = {part: i for i, part in enumerate(order.split(","))}
    listed = df.where("iso_country = 'US'").where(F.col("iata_code").isNotNull())
    return listed.select(
        "ident",
        "name",
        "iata_code",
        text.region_state("iso_region").alias("state_code"),
        text.coordinate("coordinates", place["lat"]).alias("latitude"),
        text.coordinate("coordinates", place["lon"]).alias("longitude"),
    )


def occurrences(airports: DataFrame) -> DataFrame:
    """Number the rows of one ident, of which there is mostly one, by their other columns."""
    others = [c for c in airports.columns if c != "ident"]
    return airports.withColumn("occurrence", F.row_number().over(Window.partitionBy("ident").orderBy(*others)))


def build_airports_dim(df: DataFrame, order: str = "lat,lon") -> DataFrame:
    return dense_id(us_airports(df, order), "ident", unique=False)
