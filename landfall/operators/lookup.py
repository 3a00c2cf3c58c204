"""Left joins to lookup tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import text
from landfall.operators.keys import fixed

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def is_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether the table, measured by one aggregate job, is within both bounds."""
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(1)) for c in df.columns
    ]
    size = df.agg(
        F.count("*").alias("n_rows"),
        F.sum(reduce(lambda a, b: a + b, widths).cast("long")).alias("n_bytes"),
    ).first()
    return size["n_rows"] <= max_rows and (size["n_bytes"] or 0) <= max_bytes


def known_small(df: DataFrame) -> bool:
    """Whether Catalyst's own size estimate is far below the bound, which starts no job.

    The estimate comes from the sizes of files, which may hold a few times as much when
    read, so an eighth of the bound counts.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= MAX_BROADCAST_BYTES // 8


def measured(lookup: DataFrame) -> tuple[DataFrame, bool]:
    """A lookup to join, and whether it is small; written and measured only if Catalyst cannot tell."""
    if known_small(lookup):
        return lookup, True
    lookup = fixed(lookup)
    return lookup, is_small(lookup)


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Join ``df`` to a lookup that has one row per key, and drop the lookup's key.

    Unless ``small`` says what is known of its size, a lookup from small files is
    broadcast as it is, and any other is written once and that copy is measured and
    joined. A small one is broadcast. With a larger one both sides are shuffled; as the
    lookup's own aggregation is cut off before that shuffle, adaptive execution can split
    a hot key, or the missing keys, over several tasks.
    """
    if small is None:
        lookup, small = measured(lookup)
    if small:
        lookup = F.broadcast(lookup)
    return df.join(lookup, df[key] == lookup[lookup_key], how).drop(lookup[lookup_key])


def country_names(codebook: DataFrame) -> DataFrame:
    """(code, name), one row per code.

    Names are formatted here, on the few rows of the code book. With the code
    known to be unique, Catalyst drops the join from queries that ask for no name.
    """
    return codebook.groupBy("code").agg(F.min(text.display_name("description")).alias("name"))


def decode_country(
    df: DataFrame, names: DataFrame, code: str, name: str, small: bool | None = None
) -> DataFrame:
    """Add ``name`` for country code column ``code``; null for an unknown code."""
    named = names.select(F.col("code").alias("_code"), F.col("name").alias(name))
    return lookup_join(df, named, code, "_code", small=small)


def state_coordinates(states: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Add latitude and longitude to rows by state; null for a state without them.

    Of several places the lowest counts, and one with a missing number only if there is no
    other.

    Both sides have one row per state by then, so the join needs no hint.
    """
    places = coordinates.groupBy(F.col("State").alias("_state")).agg(
        F.min(
            F.struct(
                F.col("Latitude").isNull() | F.col("Longitude").isNull(), "Latitude", "Longitude"
            )
        ).alias("_place")
    )
    return states.join(places, states["state_code"] == places["_state"], "left").select(
        *states.columns,
        F.col("_place.Latitude").alias("latitude"),
        F.col("_place.Longitude").alias("longitude"),
    )
