"""The fact table: one row per cleaned arrival record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import codes, dates
from landfall.operators.lookup import country_names, decode_country, measured


# The raw columns that the fact and its cleaning use.
INPUTS = (
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr",
    "depdate", "i94visa", "biryear", "gender", "visatype",
)


def add_countries(df: DataFrame, codebook: DataFrame) -> DataFrame:
    """Add country and country_of_residence from the two country codes.

    One copy of the names is joined in both roles.
    """
    names, small = measured(country_names(codebook))
    coded = df.withColumns(
        {"_cit": codes.whole_code("i94cit"), "_res": codes.whole_code("i94res")}
    )
    return (
        coded.transform(decode_country, names, "_cit", "country", small)
        .transform(decode_country, names, "_res", "country_of_residence", small)
        .drop("_cit", "_res")
    )


def build_fact(clean: DataFrame, codebook: DataFrame | None) -> DataFrame:
    """Fact rows from cleaned arrivals. Row-local apart from two broadcast lookups.

    Works on a streaming DataFrame too. Without a code book the two country names
    are left out, for reports that do not use them.
    """
    named = ("country", "country_of_residence") if codebook is not None else ()
    rows = add_countries(clean, codebook) if named else clean
    return rows.select(
        F.col("cicid").try_cast("long").alias("immigration_id"),
        F.col("i94yr").try_cast("int").alias("arrival_year"),
        F.col("i94mon").try_cast("int").alias("arrival_month"),
        F.col("i94port").alias("port_of_entry"),
        codes.travel_mode("i94mode").alias("travel_mode"),
        F.col("i94addr").alias("destination_state"),
        dates.day_number_to_date("arrdate").alias("arrival_date"),
        dates.day_number_to_date("depdate").alias("departure_date"),
        *named,
        "visatype",
        codes.visa_category("i94visa").alias("visa_category"),
        F.col("biryear").try_cast("int").alias("birth_year"),
        "gender",
    )
