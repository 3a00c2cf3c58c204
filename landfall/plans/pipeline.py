"""The whole run: raw inputs to the stored star schema and its quality reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from landfall import schemas
from landfall.functions import text
from landfall.operators import dims, fact as facts, quality
from landfall.operators.clean import Audited, clean_arrivals
from landfall.operators.codebook import valid_countries
from landfall.operators.keys import dense_id, fixed, lasting_ids, scratch_removed
from landfall.operators.quality import Reference
from landfall.operators.reconcile import reconcile
from landfall.sources import readers
from landfall.sources.labels import labels_of, read_labels
from landfall.sources.paths import Inputs, Warehouse
from landfall.sources.versions import Load, Store


STAR = ("immigration_fact", "arrival_time", "country", "us_population_demographics", "us_airports")


@dataclass(frozen=True)
class Run:
    """Tables of the version that the run published, and its reports."""

    tables: dict[str, DataFrame]
    audit: DataFrame
    sources: DataFrame
    nonempty: DataFrame


def read_tables(spark: SparkSession, warehouse: Warehouse, number: int | None = None) -> dict[str, DataFrame]:
    """The star schema of one version, the latest if not named."""
    store = Store(spark, warehouse)
    version = store.version(number)
    return {name: store.table(name, version) for name in STAR}


def read_codebook(spark: SparkSession, inputs: Inputs) -> DataFrame:
    """The country code book, from a CSV file or from a block of a label file."""
    if inputs.country_block:
        labels = labels_of(read_labels(spark, inputs.country_codes), inputs.country_block)
        return valid_countries(labels)
    return readers.read_country_codes(spark, inputs.country_codes)


def csv_sources(spark: SparkSession, inputs: Inputs, load: Load | None = None) -> dict[str, DataFrame]:
    """The CSV sources of the dimensions; with a load, without the records that go to its quarantine."""
    places = {
        "temperature": (inputs.temperature, schemas.TEMPERATURE_RAW, ","),
        "demographics": (inputs.demographics, schemas.DEMOGRAPHICS_RAW, ";"),
        "state_coordinates": (inputs.state_coordinates, schemas.STATE_COORDINATES_RAW, ","),
        "airports": (inputs.airports, schemas.AIRPORTS_RAW, ","),
    }
    if load is None:
        return {name: readers.read_csv(spark, path, schema, sep) for name, (path, schema, sep) in places.items()}
    good, bad = {}, []
    for name, (path, schema, sep) in places.items():
        examined = fixed(readers.examined_csv(spark, path, schema, sep))
        good[name], rejected = readers.sorted_out(examined, schema, name)
        bad.append(rejected)
    load.write_table("quarantine", reduce(DataFrame.unionByName, bad))
    return good


def write_dimension(load: Load, name: str, rows: DataFrame, *keys: str) -> None:
    """Write a dimension, each row under the id that its key has had since it was first seen."""
    known_name = f"{name}_ids"
    if known_name not in load.base.tables:
        numbered = dense_id(rows, *keys)
        load.write_table(known_name, numbered)
        load.write_table(name, numbered)
        return
    rows = fixed(rows)
    known = load.table(known_name)
    if (ids := lasting_ids(rows, known, *keys)) is not None:
        known = load.write_table(known_name, ids)
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(known[c]) for c in keys])
    load.write_table(name, rows.join(known, same).select(*[rows[c] for c in rows.columns], known["id"]))


def write_date_dimension(load: Load) -> None:
    """Dates of all months that the version will have, from the stored counts per day."""
    write_dimension(load, "arrival_time", dims.arrival_dates(load.table("daily_arrivals")), "arrival_date")


def run_pipeline(
    spark: SparkSession,
    inputs: Inputs,
    warehouse: Warehouse,
    replace_all: bool = False,
    rebalance: bool = True,
    strict: bool = False,
    keep: int = 2,
    quarantine: bool = False,
) -> Run:
    """Load the arrivals' months into the fact and rebuild the dimensions, as one version.

    Every month that the arrivals come from is replaced, also one whose records are
    all cleaned away. The arrivals are read once: the job that writes the fact audits them
    too. What follows reads a few columns of the written files.

    Nothing is visible before the last step; a run that fails leaves the tables as they
    were. ``strict`` checks the written load, also for ids that other months hold, and
    raises if a check of ``quality.load_report`` fails or a table would be empty. ``keep`` versions stay
    readable. With ``quarantine``, records of the CSV sources that lack fields or hold
    values of another type take no part and are stored with the version, each with its
    file and the reason; else what cannot be read is null.
    """
    raw = readers.read_arrivals(spark, inputs.arrivals, inputs.arrivals_format)
    store = Store(spark, warehouse)
    with scratch_removed(spark), store.load(replace_all, keep) as load:
        sources = csv_sources(spark, inputs, load if quarantine else None)
        audited = Audited(raw.select(*facts.INPUTS))
        load.write_fact(facts.build_fact(clean_arrivals(audited.rows), read_codebook(spark, inputs)), rebalance)
        audit, months = audited.result(load.rows)
        load.covers(months)
        load.notes["audit"] = audit.first().asDict()
        load.write_id_filters()
        if strict:
            report = quality.load_report(audit, load.own("immigration_fact"), load.repeated_ids())
            quality.require_passed(report)
        write_date_dimension(load)
        write_dimension(load, "country", dims.country_temperatures(sources["temperature"]), "country")
        states = dims.state_populations(sources["demographics"], sources["state_coordinates"])
        write_dimension(load, "us_population_demographics", states, "state_code")
        listed = dims.occurrences(dims.us_airports(sources["airports"]))
        write_dimension(load, "us_airports", listed, "ident", "occurrence")
        if strict:
            quality.require_passed(quality.nonempty_report({name: load.table(name) for name in STAR}))
        version = load.publish()

    tables = {name: store.table(name, version) for name in STAR}
    read = csv_sources(spark, inputs)
    report = quality.source_report(read["temperature"], read["demographics"], read["airports"])
    return Run(tables, audit, report, quality.nonempty_report(tables))


def key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Uniqueness of every documented key, and of the codes that joins go by."""
    return quality.key_report({
        "immigration_fact": (tables["immigration_fact"], ["immigration_id"]),
        "arrival_time": (tables["arrival_time"], ["arrival_date"]),
        "country": (tables["country"], ["country"]),
        "us_population_demographics": (tables["us_population_demographics"], ["state_code"]),
        "us_airports": (tables["us_airports"], ["ident"]),
        "us_airports by iata_code": (tables["us_airports"], ["iata_code"]),
    })


def lookup_checks(codebook: DataFrame, coordinates: DataFrame, states: DataFrame) -> DataFrame:
    """Codes that a lookup lists with different values, of which one is used."""
    return quality.conflict_report({
        "country codes": (codebook, "code", ["description"]),
        "state coordinates": (coordinates, "State", ["Latitude", "Longitude"]),
        "states": (states, "code", ["label"]),
    })


def country_mapping(tables: dict[str, DataFrame], least: float = 0.8) -> DataFrame:
    """Country names of the fact that no dimension row has, and the row each most likely means.

    For ``star.join_country``; the scores are there to be looked at first.
    """
    fact = tables["immigration_fact"]
    used = fact.select("country").distinct().unionAll(fact.select("country_of_residence").distinct())
    return reconcile(used, tables["country"].select("country"), least)


def reference_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphans of every documented foreign key of the fact."""
    countries, airports = tables["country"], tables["us_airports"]
    return quality.orphan_report(tables["immigration_fact"], {
        "country": Reference("country", countries, "country", text.name_key),
        "country_of_residence": Reference(
            "country_of_residence", countries, "country", text.name_key
        ),
        "destination_state": Reference(
            "destination_state", tables["us_population_demographics"], "state_code"
        ),
        "destination_state airports": Reference("destination_state", airports, "state_code"),
        "port_of_entry": Reference("port_of_entry", airports, "iata_code"),
        "arrival_date": Reference("arrival_date", tables["arrival_time"], "arrival_date"),
    })
