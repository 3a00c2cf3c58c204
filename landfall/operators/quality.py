"""Data-quality reports: each is a small DataFrame, and a strict run raises on it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DataQualityError(RuntimeError):
    """A strict quality check failed."""


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def nonempty_report(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, row_count and passed for each table; empty tables fail."""
    return _union([
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            (F.col("row_count") > 0).alias("passed"),
        )
        for name, df in tables.items()
    ])


def source_report(
    temperature: DataFrame, demographics: DataFrame, airports: DataFrame
) -> DataFrame:
    """source, rows read, rows that enter its dimension, and distinct keys they fall under.

    One pass per source. Arrivals have their own audit.
    """
    is_us_airport = (F.col("iso_country") == "US") & F.col("iata_code").isNotNull()
    has_reading = F.col("AverageTemperature").isNotNull() & ~F.isnan("AverageTemperature")
    sources = {
        "temperature": (temperature, has_reading, "Country"),
        "demographics": (demographics, F.lit(True), "State Code"),
        "airports": (airports, is_us_airport, "iata_code"),
    }
    return _union([
        df.groupBy(F.when(kept, F.col(key)).alias("_key"))
        .agg(F.count("*").alias("_read"), F.count_if(kept).alias("_kept"))
        .agg(
            F.coalesce(F.sum("_read"), F.lit(0)).alias("rows_read"),
            F.coalesce(F.sum("_kept"), F.lit(0)).alias("rows_kept"),
            F.count("_key").alias("keys_kept"),
        )
        .select(F.lit(name).alias("source"), "rows_read", "rows_kept", "keys_kept")
        for name, (df, kept, key) in sources.items()
    ])


def key_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """table_name, keys that occur more than once, surplus rows and passed."""
    reports = []
    for name, (df, key) in tables.items():
        repeated = df.groupBy(*key).agg(F.count("*").alias("_rows")).where("_rows > 1")
        reports.append(
            repeated.agg(
                F.count("*").alias("repeated_keys"),
                F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("surplus_rows"),
            ).select(
                F.lit(name).alias("table_name"),
                "repeated_keys",
                "surplus_rows",
                (F.col("repeated_keys") == 0).alias("passed"),
            )
        )
    return _union(reports)


def orphans(
    child: DataFrame,
    child_key: str,
    parent: DataFrame,
    parent_key: str,
    spelling: Callable[[str], Column] | None = None,
) -> DataFrame:
    """Key values of ``child`` without a row in ``parent``, and how many rows use each.

    The child is counted per key first, so a hot key is one row by the time it
    is shuffled to the anti join. Null keys refer to nothing and are left out.
    ``spelling`` maps both keys to a common spelling, after the count.
    """
    used = child.groupBy(F.col(child_key).alias("key")).agg(F.count("*").alias("row_count"))
    known = parent.select(F.col(parent_key).alias("key"))
    if spelling:
        used = used.groupBy(spelling("key").alias("key")).agg(F.sum("row_count").alias("row_count"))
        known = known.select(spelling("key").alias("key"))
    return used.where(F.col("key").isNotNull()).join(known.distinct(), "key", "left_anti")


@dataclass(frozen=True)
class Reference:
    """A column of the fact that must name a row of ``parent``."""

    column: str
    parent: DataFrame
    key: str
    spelling: Callable[[str], Column] | None = None

    def spelled(self, key: str) -> Column:
        return self.spelling(key) if self.spelling else F.col(key)


def orphan_report(child: DataFrame, references: dict[str, Reference]) -> DataFrame:
    """reference, orphan keys, orphan rows and passed, from one pass over ``child``.

    Each row is counted once per referring column and key, on the map side
    first. The counts then meet the known keys of all parents in a single join.
    """
    by_column: dict[str, list[str]] = {}
    for name, r in references.items():
        by_column.setdefault(r.column, []).append(name)
    uses = [
        F.struct(F.lit(column).alias("column"), F.col(column).cast("string").alias("key"))
        for column in by_column
    ]
    names_of_column = F.coalesce(*[
        F.when(F.col("column") == column, F.array(*map(F.lit, names)))
        for column, names in by_column.items()
    ])
    counted = (
        child.select(F.inline(F.array(*uses)))
        .where(F.col("key").isNotNull())
        .groupBy("column", "key")
        .agg(F.count("*").alias("row_count"))
        .select(F.explode(names_of_column).alias("reference"), "key", "row_count")
    )
    spelled = reduce(
        lambda other, item: F.when(F.col("reference") == item[0], item[1].spelled("key"))
        .otherwise(other),
        [(name, r) for name, r in references.items() if r.spelling],
        F.col("key"),
    )
    used = counted.groupBy("reference", spelled.alias("key")).agg(
        F.sum("row_count").alias("row_count")
    )
    serves: dict[tuple, list[str]] = {}
    for name, r in references.items():
        serves.setdefault((id(r.parent), r.key, r.spelling), []).append(name)
    known = _union([
        references[names[0]]
        .parent.select(references[names[0]].spelled(key).cast("string").alias("key"))
        .distinct()
        .select(F.explode(F.array(*map(F.lit, names))).alias("reference"), "key")
        for (_, key, _), names in serves.items()
    ])
    missing = (
        used.join(known, ["reference", "key"], "left_anti")
        .groupBy("reference")
        .agg(F.count("*").alias("_keys"), F.sum("row_count").alias("_rows"))
    )
    names = child.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, references))).alias("reference")
    )
    return names.join(missing, "reference", "left").select(
        "reference",
        F.coalesce("_keys", F.lit(0)).alias("orphan_keys"),
        F.coalesce("_rows", F.lit(0)).alias("orphan_rows"),
        F.col("_keys").isNull().alias("passed"),
    )


def partition_report(fact: DataFrame) -> DataFrame:
    """Dated fact rows, and those whose date lies outside their year and month partition.

    A row without year or month is filed outside its month too.
    """
    placed = F.year("arrival_date").eqNullSafe(F.col("arrival_year")) & F.month(
        "arrival_date"
    ).eqNullSafe(F.col("arrival_month"))
    misplaced = F.col("arrival_date").isNotNull() & ~placed
    return fact.agg(
        F.count("arrival_date").alias("dated_rows"), F.count_if(misplaced).alias("misplaced_rows")
    ).withColumn("passed", F.col("misplaced_rows") == 0)


def unreadable_report(text: DataFrame, schema: T.StructType) -> DataFrame:
    """column_name, filled and unreadable values, and passed, for each declared column of a text source."""
    present = [f for f in schema if f.name.lower() in {c.lower() for c in text.columns}]
    counts = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.count(f"`{f.name}`").alias("filled"),
            F.count_if(
                F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()
            ).alias("unreadable"),
        )
        for f in present
    ]
    rows = text.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))
    return rows.withColumn("passed", F.col("unreadable") == 0)


def conflict_report(lookups: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """lookup, keys listed with several different values, and passed.

    Lookups count once per key. This tells where that choice was between different rows.
    """
    return _union([
        df.groupBy(key).agg(F.countDistinct(F.struct(*[F.col(f"`{v}`") for v in values])).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("conflicting_keys"))
        .select(F.lit(name).alias("lookup"), "conflicting_keys", (F.col("conflicting_keys") == 0).alias("passed"))
        for name, (df, key, values) in lookups.items()
    ])


def load_report(audit: DataFrame, fact: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """check, failures and passed of one load, before it is visible.

    ``audit`` is the audit of the arrival records, ``fact`` the fact rows made of them. The checks are: rows
    read are kept or charged to a column, some row is kept, ids are unique, and no dated
    row is filed under another month. ``repeated`` are ids that other months hold: there
    must be none.
    """
    def failed_unless(check: str, holds: Column) -> Column:
        failures = F.when(holds, 0).otherwise(1).cast("long")
        return F.struct(F.lit(check).alias("check"), failures.alias("failures"))

    audit = audit.select(
        F.inline(F.array(
            failed_unless("audit balanced", F.col("balanced")),
            failed_unless("rows kept", F.col("kept_rows") > 0),
        ))
    )
    ids = key_report({"ids unique": (fact, ["immigration_id"])}).select(
        F.col("table_name").alias("check"), F.col("surplus_rows").alias("failures")
    )
    filed = partition_report(fact).select(
        F.lit("filed under own month").alias("check"), F.col("misplaced_rows").alias("failures")
    )
    checks = [audit, ids, filed]
    if repeated is not None:
        failures = F.countDistinct("immigration_id").alias("failures")
        checks.append(repeated.agg(failures).select(F.lit("ids in no other month").alias("check"), "failures"))
    return _union(checks).withColumn("passed", F.col("failures") == 0)


def shared_coordinates(demographics: DataFrame, places: int = 4) -> DataFrame:
    """Coordinates that several states share, an input defect, with those states."""
    return (
        demographics.where("latitude is not null and longitude is not null")
        .groupBy(
            F.round("latitude", places).alias("latitude"),
            F.round("longitude", places).alias("longitude"),
        )
        .agg(F.count("*").alias("states"), F.min("state_code").alias("first_state"),
             F.max("state_code").alias("last_state"))
        .where("states > 1")
    )


def require_passed(report: DataFrame) -> None:
    """Raise if any row of a report failed. Reports hold one row per checked table."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise DataQualityError("; ".join(str(row.asDict()) for row in failed))
