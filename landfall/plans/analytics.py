"""Analyst questions over the star schema.

Every question counts the fact per foreign key first. Partial aggregation
absorbs hot keys, and what is joined to a dimension afterwards is one row per
key, so the fact itself is never shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import dates, text
from landfall.operators import star
from landfall.operators.codebook import decode_states
from landfall.operators.lookup import MAX_BROADCAST_ROWS
from landfall.operators.ranking import counts_by, top_k


def arrivals_in_timeframe(
    rows: DataFrame, start: dt.date, end: dt.date, ranges: DataFrame | None = None
) -> DataFrame:
    """Arrivals per month between two dates, both included.

    Dates are pushed to the parquet scan. With the stored ``ranges`` of dates of
    each month folder, only folders that hold a date of the timeframe are read,
    whatever month their rows are filed under. Instead of the fact, the counts per day
    that are stored with its months will do.
    """
    rows = rows.where(dates.within("arrival_date", start, end))
    if ranges is not None:
        rows = rows.where(dates.overlapping_partitions(ranges, start, end))
    counted = F.sum("arrivals") if "arrivals" in rows.columns else F.count("*")
    return rows.groupBy(
        F.year("arrival_date").alias("year"), F.month("arrival_date").alias("month")
    ).agg(counted.alias("arrivals"))


def top_visa_category(fact: DataFrame, k: int = 1, keep_ties: bool = False) -> DataFrame:
    return top_k(counts_by(fact, "visa_category"), k, "visa_category", keep_ties=keep_ties)


def top_travel_mode(fact: DataFrame, k: int = 1, keep_ties: bool = False) -> DataFrame:
    return top_k(counts_by(fact, "travel_mode"), k, "travel_mode", keep_ties=keep_ties)


def top_destination_state(
    fact: DataFrame, states: DataFrame, k: int = 10, keep_ties: bool = False
) -> DataFrame:
    """Favourite states by listed name; codes outside ``states`` count as one group."""
    per_code = counts_by(fact, "destination_state")
    per_name = (
        decode_states(per_code, states, "destination_state", "state_name")
        .groupBy("state_name")
        .agg(F.sum("arrivals").alias("arrivals"))
    )
    return top_k(per_name, k, "state_name", keep_ties=keep_ties)


def arrivals_and_temperature(fact: DataFrame, country_dim: DataFrame) -> DataFrame:
    """Arrivals and mean temperature of each country of residence that has both."""
    per_country = (
        counts_by(fact, "country_of_residence")
        .groupBy(text.name_key("country_of_residence").alias("name_key"))
        .agg(
            F.min("country_of_residence").alias("country_of_residence"),
            F.sum("arrivals").alias("arrivals"),
        )
    )
    return per_country.join(star.temperature_by_name_key(country_dim), "name_key").drop("name_key")


def weather_correlation(fact: DataFrame, country_dim: DataFrame) -> DataFrame:
    """One row: countries compared, and correlation of their arrivals and temperature."""
    return arrivals_and_temperature(fact, country_dim).agg(
        F.count("*").alias("countries"),
        F.corr(F.col("arrivals").cast("double"), "average_temperature").alias("correlation"),
    )


def air_business_by_state(fact: DataFrame, k: int = 10, keep_ties: bool = False) -> DataFrame:
    """States most visited by air travellers on business."""
    rows = fact.where("travel_mode = 'Air' and visa_category = 'Business'")
    return top_k(
        counts_by(rows, "destination_state"), k, "destination_state", keep_ties=keep_ties
    )


def state_hotspots(fact: DataFrame, demographics: DataFrame, airports: DataFrame) -> DataFrame:
    """Arrivals of each destination state against its population and airports."""
    per_state = counts_by(fact, "destination_state")
    states = star.join_state_airports(demographics, airports).select(
        "state_code", "total_population", "foreign_born", "latitude", "longitude", "airports"
    )
    population = F.nullif("total_population", F.lit(0))
    return per_state.join(
        states, F.col("destination_state") == F.col("state_code"), "left"
    ).select(
        "destination_state",
        "arrivals",
        "total_population",
        (F.col("arrivals") * 100000.0 / population).alias("arrivals_per_100k"),
        (F.col("foreign_born") / population).alias("foreign_born_share"),
        "latitude",
        "longitude",
        "airports",
    )


def business_ports(fact: DataFrame, airports: DataFrame, k: int = 10) -> DataFrame:
    """Ports of entry most used on business, with their airport where one has the code.

    The k port codes filter the airports before those are grouped by code. They are
    broadcast unless k is beyond what may be.
    """
    ports = top_k(
        counts_by(fact.where("visa_category = 'Business'"), "port_of_entry"), k, "port_of_entry"
    )
    named = ports.select(F.col("port_of_entry").alias("iata_code"))
    if k <= MAX_BROADCAST_ROWS:
        named = F.broadcast(named)
    codes = star.airports_by_code(airports.join(named, "iata_code", "left_semi"))
    return (
        ports.join(codes, ports["port_of_entry"] == codes["iata_code"], "left")
        .drop("iata_code")
        .orderBy(F.desc("arrivals"), "port_of_entry")
    )


CUBE_DIMENSIONS = ("travel_mode", "visa_category", "arrival_year")


def _finest(rows: DataFrame) -> DataFrame:
    """Counts per finest cell. Coarser cells are sums of these few rows, so the
    fact is aggregated once and not expanded once per grouping. ``rows`` are the fact's,
    or the counts per day that are stored with each month (``arrivals``)."""
    if "arrivals" in rows.columns:
        return rows.groupBy(*CUBE_DIMENSIONS).agg(F.sum("arrivals").alias("arrivals"))
    return counts_by(rows, *CUBE_DIMENSIONS)


def _cells() -> list[Column]:
    return [F.grouping_id().alias("grouping_id"), F.sum("arrivals").alias("arrivals")]


def arrivals_cube(rows: DataFrame) -> DataFrame:
    return _finest(rows).cube(*CUBE_DIMENSIONS).agg(*_cells())


def arrivals_rollup(rows: DataFrame) -> DataFrame:
    return _finest(rows).rollup(*CUBE_DIMENSIONS).agg(*_cells())


def arrivals_grouping_sets(rows: DataFrame) -> DataFrame:
    """Mode by visa category, each year, and the total."""
    mode, visa, year = CUBE_DIMENSIONS
    return (
        _finest(rows)
        .groupingSets([(mode, visa), (year,), ()], mode, visa, year)
        .agg(*_cells())
    )


def weighted_arrivals(clean: DataFrame) -> DataFrame:
    """Sum of the weight column per year and month of the cleaned arrivals."""
    return clean.groupBy(
        F.col("i94yr").try_cast("int").alias("arrival_year"),
        F.col("i94mon").try_cast("int").alias("arrival_month"),
    ).agg(F.sum("count").alias("weighted_arrivals"), F.count("*").alias("records"))


def stay_lengths(fact: DataFrame) -> DataFrame:
    """Each stay in days with a flag for a departure before the arrival."""
    return fact.select(
        "immigration_id", "arrival_date", "departure_date", dates.stay_days().alias("stay_days")
    ).withColumn("departs_before_arrival", F.col("stay_days") < 0)


def age_consistency(clean: DataFrame, tolerance: int = 1) -> DataFrame:
    """Stated age against arrival year minus birth year.

    A birthday later in the year makes the two differ by one.
    """
    implied = F.col("i94yr").try_cast("int") - F.col("biryear").try_cast("int")
    age = F.col("i94bir").try_cast("int")
    return clean.select(
        F.col("cicid").try_cast("long").alias("immigration_id"),
        age.alias("stated_age"),
        implied.alias("implied_age"),
        (implied - age).between(0, tolerance).alias("consistent"),
    )
