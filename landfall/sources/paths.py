"""Where inputs are read from and tables are written to. Any Hadoop URI works."""

from __future__ import annotations

from dataclasses import dataclass


def join_path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *[p.strip("/") for p in parts]])


@dataclass(frozen=True)
class Inputs:
    arrivals: str
    country_codes: str
    temperature: str
    demographics: str
    state_coordinates: str
    airports: str
    arrivals_format: str = "parquet"
    country_block: str | None = None  # block of country labels, if country_codes is a label file


# Table locations below the output root.
TABLES = {
    "immigration_fact": "immigration/immigration.parquet",
    "arrival_time": "arrivals/arrival_time.parquet",
    "country": "temperature/temperature.parquet",
    "us_population_demographics": "demographics/demographics.parquet",
    "us_airports": "airports/airports.parquet",
    # Not of the star schema: counts and id filters per month, records that could not be
    # used, and the ids given out.
    "quarantine": "quarantine/quarantine.parquet",
    "daily_arrivals": "immigration/daily_arrivals.parquet",
    "id_filters": "immigration/id_filters.parquet",
    "arrival_time_ids": "arrivals/arrival_time_ids.parquet",
    "country_ids": "temperature/temperature_ids.parquet",
    "us_population_demographics_ids": "demographics/demographics_ids.parquet",
    "us_airports_ids": "airports/airports_ids.parquet",
}


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, table: str) -> str:
        return join_path(self.root, TABLES[table])
