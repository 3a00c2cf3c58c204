"""Row-level joins of the fact to its dimensions.

Each join keeps one row per fact row: the dimension side has, or is first
reduced to, one row per join key. The analyst queries aggregate before they join and need
these only for row-level work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import text
from landfall.operators.lookup import lookup_join


def temperature_by_name_key(country_dim: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """(name_key, average_temperature): spellings of one name share a row.

    ``mapping`` (name_key, known_key) adds names that ``reconcile`` found to mean a
    country of the dimension.
    """
    means = country_dim.groupBy(text.name_key("country").alias("name_key")).agg(
        F.avg("average_temperature").alias("average_temperature")
    )
    if mapping is None:
        return means
    named = means.withColumnRenamed("name_key", "known_key").join(mapping, "known_key")
    return means.unionAll(named.select("name_key", "average_temperature"))


def airports_by_code(airports: DataFrame) -> DataFrame:
    """One row per airport code: the airport lowest in ident, and how many share the code."""
    return airports.groupBy("iata_code").agg(
        F.min_by("name", "ident").alias("airport_name"),
        F.min_by("state_code", "ident").alias("airport_state"),
        F.count("*").alias("airports_with_code"),
    )


def airports_by_state(airports: DataFrame) -> DataFrame:
    return airports.groupBy("state_code").agg(F.count("*").alias("airports"))


def join_country(
    fact: DataFrame,
    country_dim: DataFrame,
    name: str = "country_of_residence",
    mapping: DataFrame | None = None,
) -> DataFrame:
    """Fact rows with average_temperature of the named country."""
    keyed = fact.withColumn("_key", text.name_key(name))
    means = temperature_by_name_key(country_dim, mapping)
    return lookup_join(keyed, means, "_key", "name_key").drop("_key")


def join_demographics(fact: DataFrame, demographics: DataFrame) -> DataFrame:
    """Fact rows with the population of their destination state."""
    states = demographics.select("state_code", "total_population", "foreign_born")
    return lookup_join(fact, states, "destination_state", "state_code")


def join_airports(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """Fact rows with the airport of their port of entry."""
    return lookup_join(fact, airports_by_code(airports), "port_of_entry", "iata_code")


def join_dates(fact: DataFrame, arrival_time: DataFrame) -> DataFrame:
    """Fact rows that have an arrival date, with its calendar parts and date id."""
    dates = arrival_time.withColumnsRenamed({"arrival_date": "_date", "id": "date_id"})
    return lookup_join(fact, dates, "arrival_date", "_date", how="inner")


def join_state_airports(demographics: DataFrame, airports: DataFrame) -> DataFrame:
    """States with their number of airports, 0 for none."""
    counts = airports_by_state(airports)
    return demographics.join(counts, "state_code", "left").fillna(0, subset=["airports"])
