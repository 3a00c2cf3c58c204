"""Readers. Columns are found by header name and typed by declaration, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import schemas


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give each declared column that is present its declared type.

    Unreadable values become null. Other columns pass through. A column that
    already has its type is left alone, so filters on it still reach the scan.
    """
    present = {name.lower(): kind for name, kind in zip(df.columns, [f.dataType for f in df.schema])}
    return df.withColumns({
        f.name: F.col(f"`{f.name}`").try_cast(f.dataType)
        for f in schema
        if f.name.lower() in present and present[f.name.lower()] != f.dataType
    })


def read_csv_text(
    spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """CSV with a header, every column as text.

    Quotes inside quoted text are doubled. Columns may come in any order, but in
    the same one in all files of a folder: a file with another header fails the
    read rather than shift its columns. ``multi_line`` allows line ends inside
    quotes; it makes a file one task's work, so it is for small sources only.
    """
    return spark.read.csv(
        path, sep=sep, header=True, escape='"', enforceSchema=False, multiLine=multi_line
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """The same with declared types; ``quality.unreadable_report`` counts what does not fit them."""
    return conform(read_csv_text(spark, path, sep, multi_line), schema)


def read_arrivals(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Arrival records from a parquet or CSV extract."""
    if format == "csv":
        return read_csv(spark, path, schemas.ARRIVALS_RAW)
    return conform(spark.read.format(format).load(path), schemas.ARRIVALS_RAW)


def read_country_codes(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.COUNTRY_CODES_RAW, ";", multi_line)


def read_demographics(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.DEMOGRAPHICS_RAW, ";", multi_line)


def read_temperature(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.TEMPERATURE_RAW, multi_line=multi_line)


def read_state_coordinates(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.STATE_COORDINATES_RAW, multi_line=multi_line)


def read_airports(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.AIRPORTS_RAW, multi_line=multi_line)


def examined_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Every record of a CSV source as text, with its file, its record and why it cannot be used.

    ``_reason`` is null for a good record, ``number of fields`` for one that has too few
    or too many, and else names the declared columns whose value does not fit their type.
    All columns must be read together, as Spark counts the fields that it is asked for:
    write the result before counting anything.
    """
    names = read_csv_text(spark, path, sep).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_malformed"]])
    rows = spark.read.schema(text).csv(
        path, sep=sep, header=True, escape='"', enforceSchema=False, mode="PERMISSIVE",
        columnNameOfCorruptRecord="_malformed",
    )
    declared = {f.name.lower(): f for f in schema}
    unfit = [
        F.when(F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(declared[n.lower()].dataType).isNull(), declared[n.lower()].name)
        for n in names
        if n.lower() in declared
    ]
    unreadable = F.concat_ws(", ", *unfit)
    fields = F.struct(*[F.col(f"`{n}`") for n in names])
    return rows.select(
        *[F.col(f"`{n}`") for n in names],
        F.col("_metadata.file_path").alias("_file"),
        F.coalesce("_malformed", F.to_csv(fields, {"sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})).alias("_record"),
        F.when(F.col("_malformed").isNotNull(), "number of fields")
        .when(unreadable != "", F.concat(F.lit("unreadable: "), unreadable))
        .alias("_reason"),
    )


def sorted_out(examined: DataFrame, schema: T.StructType, source: str) -> tuple[DataFrame, DataFrame]:
    """Good records with their declared types, and (source, file, record, reason) of the others."""
    good = examined.where("_reason is null").drop("_file", "_record", "_reason")
    bad = examined.where("_reason is not null").select(
        F.lit(source).alias("source"), F.col("_file").alias("file"),
        F.col("_record").alias("record"), F.col("_reason").alias("reason"),
    )
    return conform(good, schema), bad
