"""The registered queries: name -> function of (spark, table folder)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import schemas
from landfall.functions import codes, dates
from landfall.operators import codebook, dims, fact as facts, quality, star
from landfall.operators.clean import Audited, clean_arrivals, null_audit
from landfall.operators.keys import fixed, scratch_folder
from landfall.operators.ranking import counts_by, top_k
from landfall.operators.reconcile import reconcile
from landfall.plans import analytics, bindings, pipeline
from landfall.sources import readers
from landfall.sources.labels import read_labels
from landfall.sources.paths import Inputs, Warehouse, join_path
from landfall.sources.versions import Store
from landfall.streaming.arrivals import load_new_files

Query = Callable[[SparkSession, str], DataFrame]

TIMEFRAME = (dt.date(1997, 2, 10), dt.date(1998, 11, 20))


# Tables of the star schema over the given tables.


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_arrivals(bindings.arrivals(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.build_fact(clean(spark, sf_dir), bindings.country_codes(spark, sf_dir))


def unnamed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact without country names, for queries that ask for none."""
    return facts.build_fact(clean(spark, sf_dir), None)


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.country_temperatures(bindings.temperature(spark, sf_dir), tie_break="reading_no")


def state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.state_populations(
        bindings.demographics(spark, sf_dir), bindings.state_coordinates(spark, sf_dir)
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.us_airports(bindings.airports(spark, sf_dir))


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = fixed(fact(spark, sf_dir))
    return {
        "immigration_fact": rows,
        "arrival_time": dims.arrival_dates(rows),
        "country": countries(spark, sf_dir),
        "us_population_demographics": state_rows(spark, sf_dir),
        "us_airports": airports(spark, sf_dir),
    }


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Cleaning and decoding.


def arrivals_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_audit(bindings.arrivals(spark, sf_dir))


def sas_date_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bindings.day_numbers(spark, sf_dir).select(
        dates.day_number_to_date("day_number").alias("decoded_date")
    )
    return counts_by(decoded, "decoded_date", name="rows")


def country_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = facts.add_countries(
        bindings.arrivals(spark, sf_dir), bindings.country_codes(spark, sf_dir)
    )
    return named.select("cicid", "country", "country_of_residence")


def mode_visa_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bindings.arrivals(spark, sf_dir).select(
        codes.travel_mode("i94mode").alias("travel_mode"),
        codes.travel_mode_status("i94mode").alias("mode_status"),
        codes.visa_category("i94visa").alias("visa_category"),
    )
    return counts_by(decoded, "travel_mode", "mode_status", "visa_category")


# Code books.


def codebook_country_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = codebook.label_rows(bindings.country_label_lines(spark, sf_dir))
    return codebook.decode_countries(labels)


def codebook_valid_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = codebook.label_rows(bindings.country_label_lines(spark, sf_dir))
    return codebook.valid_countries(labels)


def port_label_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = codebook.label_rows(bindings.port_label_lines(spark, sf_dir))
    return codebook.decode_ports(labels, bindings.port_states(spark, sf_dir))


def port_alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bindings.port_label_lines(spark, sf_dir).unionAll(bindings.port_chain_lines(spark, sf_dir))
    return codebook.resolve_port_aliases(codebook.label_rows(lines))


def state_other_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = codebook.decode_states(
        bindings.arrivals(spark, sf_dir), bindings.states(spark, sf_dir), "i94addr", "state_name"
    )
    return decoded.select("cicid", "i94addr", "state_name")


# Stored dimensions, with measures rounded for comparison.


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.build_date_dim(unnamed_fact(spark, sf_dir))


def temperature_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = dims.build_temperature_dim(bindings.temperature(spark, sf_dir), tie_break="reading_no")
    return _rounded(stored, "average_temperature")


def demographics_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.build_demographics_dim(
        bindings.demographics(spark, sf_dir), bindings.state_coordinates(spark, sf_dir)
    )


def airports_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.build_airports_dim(bindings.airports(spark, sf_dir))


def demographics_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics of an input that holds every city twice."""
    cities = bindings.demographics(spark, sf_dir)
    return dims.build_demographics_dim(
        cities.unionAll(cities),
        bindings.state_coordinates(spark, sf_dir),
        dedupe_on=["City", "State Code"],
    )


# Row-level star joins.


def star_join_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = star.join_country(fact(spark, sf_dir), countries(spark, sf_dir))
    return _rounded(
        joined.select("immigration_id", "country_of_residence", "average_temperature"),
        "average_temperature",
    )


def star_join_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = star.join_demographics(unnamed_fact(spark, sf_dir), state_rows(spark, sf_dir))
    return joined.select("immigration_id", "destination_state", "total_population", "foreign_born")


def star_join_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = star.join_airports(unnamed_fact(spark, sf_dir), airports(spark, sf_dir))
    return joined.select(
        "immigration_id", "port_of_entry", "airport_name", "airport_state", "airports_with_code"
    )


def star_join_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unnamed_fact(spark, sf_dir)
    joined = star.join_dates(rows, dims.build_date_dim(rows))
    return joined.select("immigration_id", "arrival_date", "date_id", "week", "weekday")


def star_join_state_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = star.join_state_airports(
        state_rows(spark, sf_dir), airports(spark, sf_dir)
    )
    return joined.select("state_code", "total_population", "airports")


# Analyst questions.


def q1_arrivals_in_timeframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.arrivals_in_timeframe(unnamed_fact(spark, sf_dir), *TIMEFRAME)


def q2_top_visa_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_visa_category(unnamed_fact(spark, sf_dir))


def q3_weather_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = analytics.weather_correlation(fact(spark, sf_dir), countries(spark, sf_dir))
    return _rounded(report, "correlation")


def q3_arrivals_and_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = analytics.arrivals_and_temperature(fact(spark, sf_dir), countries(spark, sf_dir))
    return _rounded(report, "average_temperature")


def q4_top_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_destination_state(
        unnamed_fact(spark, sf_dir), bindings.states(spark, sf_dir), k=5
    )


def q5_top_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_travel_mode(unnamed_fact(spark, sf_dir))


def q6_air_business_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.air_business_by_state(unnamed_fact(spark, sf_dir))


def q6_air_business_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival days most used by air travellers on business, all tied days kept."""
    rows = unnamed_fact(spark, sf_dir).where("travel_mode = 'Air' and visa_category = 'Business'")
    return top_k(counts_by(rows, "arrival_date"), 10, "arrival_date", keep_ties=True)


def q7_state_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = analytics.state_hotspots(
        unnamed_fact(spark, sf_dir), state_rows(spark, sf_dir), airports(spark, sf_dir)
    )
    return _rounded(report, "arrivals_per_100k", "foreign_born_share")


def q8_business_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.business_ports(unnamed_fact(spark, sf_dir), airports(spark, sf_dir))


def q9_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.arrivals_cube(unnamed_fact(spark, sf_dir))


def q9_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.arrivals_rollup(unnamed_fact(spark, sf_dir))


def q9_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.arrivals_grouping_sets(unnamed_fact(spark, sf_dir))


def weighted_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.weighted_arrivals(clean(spark, sf_dir))


def stay_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.stay_lengths(unnamed_fact(spark, sf_dir))


def age_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.age_consistency(clean(spark, sf_dir))


# Quality.


def quality_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.source_report(
        bindings.temperature(spark, sf_dir),
        bindings.demographics(spark, sf_dir),
        bindings.airports(spark, sf_dir),
    )


def quality_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.nonempty_report(star_tables(spark, sf_dir))


def quality_key_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.key_checks(star_tables(spark, sf_dir))


def quality_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans against dimensions of which the dates lack every seventh day of a month."""
    tables = star_tables(spark, sf_dir)
    dates = tables["arrival_time"].where("day % 7 <> 0")
    return pipeline.reference_checks({**tables, "arrival_time": dates})


def quality_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.load_report(null_audit(bindings.arrivals(spark, sf_dir)), unnamed_fact(spark, sf_dir))


def quality_lookup_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicts of code books to which others were added that partly disagree."""
    customer = bindings.table(spark, sf_dir, "customer")
    more_codes = customer.selectExpr(
        "cast(c_custkey % 60 as int) as code",
        "if(c_custkey % 60 < 30, concat('LAND ', c_custkey % 60), c_mktsegment) as description",
    )
    more_states = bindings.table(spark, sf_dir, "supplier").selectExpr(
        "concat('S', cast(40 + s_nationkey as string)) as code",
        "if(s_suppkey % 5 = 0, 'OTHER', concat(s_nationkey, ' STATE')) as label",
    )
    return pipeline.lookup_checks(
        bindings.country_codes(spark, sf_dir).unionAll(more_codes),
        bindings.state_coordinates(spark, sf_dir),
        bindings.states(spark, sf_dir).unionAll(more_states),
    )


def quality_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphans(
        unnamed_fact(spark, sf_dir), "port_of_entry", airports(spark, sf_dir), "iata_code"
    )


def reconciled_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts mapped to those of a list that spells some of them otherwise and lacks others."""
    part = bindings.table(spark, sf_dir, "part")
    names = part.selectExpr("concat(p_name, ' of ', p_brand) as name")
    other = part.where("p_size % 6 <> 0").selectExpr("""case p_size % 5
        when 0 then concat(replace(p_name, 'i', 'y'), ' of ', p_brand)
        when 1 then concat(upper(p_name), ' Of the ', p_brand)
        when 2 then concat(p_name, ', ', p_brand, 'X')
        when 3 then concat(p_name, ' of ', p_brand)
        else concat(p_type, ' ', p_name, ' ', p_brand) end as listed""")
    return _rounded(reconcile(names, other, 0.85), "score")


def quality_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.partition_report(unnamed_fact(spark, sf_dir))


def quality_shared_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.shared_coordinates(state_rows(spark, sf_dir))


# Sources and sinks: write below the scratch root, read back.


def fact_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timeframe's arrivals from a stored fact some of whose rows are filed under another
    month or under none."""
    filed = """case when immigration_id % 97 = 0 then null
                    when immigration_id % 89 = 0 then arrival_month % 12 + 1
                    else arrival_month end"""
    store = Store(spark, Warehouse(scratch_folder(spark)))
    with store.load() as load:
        load.write_fact(unnamed_fact(spark, sf_dir).withColumn("arrival_month", F.expr(filed)))
        version = load.publish()
    return analytics.arrivals_in_timeframe(
        store.table("immigration_fact", version), *TIMEFRAME, store.ranges(version)
    )


def loaded_months(spark: SparkSession, sf_dir: str) -> Store:
    """A store into which all months were loaded, then odd months once more without their sea
    arrivals, then every December with records of which none can be used."""
    store = Store(spark, Warehouse(scratch_folder(spark)))
    rows = unnamed_fact(spark, sf_dir)
    unusable = bindings.arrivals(spark, sf_dir).where("i94mon = 12").withColumn(
        "gender", F.lit(None).cast("string")
    )
    with store.load() as load:
        load.write_fact(rows)
        load.publish()
    with store.load() as load:
        load.write_fact(rows.where("arrival_month % 2 = 1 and travel_mode <> 'Sea'"))
        load.publish()
    with store.load() as load:
        audited = Audited(unusable)
        load.write_fact(facts.build_fact(clean_arrivals(audited.rows), None))
        load.covers(audited.result(load.rows)[1])
        load.publish()
    return store


def monthly_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals per month, and the sum of their ids, after several loads of the same months."""
    fact_table = loaded_months(spark, sf_dir).table("immigration_fact")
    return fact_table.groupBy("arrival_year", "arrival_month").agg(
        F.count("*").alias("arrivals"), F.sum("immigration_id").alias("id_sum")
    )


def maintained_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube after the same loads, from the counts that each of them stored with its months."""
    return analytics.arrivals_cube(loaded_months(spark, sf_dir).table("daily_arrivals"))


def maintained_timeframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals in the timeframe after the same loads, from the stored counts."""
    return analytics.arrivals_in_timeframe(loaded_months(spark, sf_dir).table("daily_arrivals"), *TIMEFRAME)


def lasting_date_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the date dimension after a load of the first half of every year and one of the second."""
    store = Store(spark, Warehouse(scratch_folder(spark)))
    rows = unnamed_fact(spark, sf_dir)
    for half in (rows.where("arrival_month <= 6"), rows.where("arrival_month > 6")):
        with store.load() as load:
            load.write_fact(half)
            pipeline.write_date_dimension(load)
            load.publish()
    return store.table("arrival_time").select("arrival_date", "id")


def lasting_airport_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the airports after three loads: those in the first states, all, and the others renamed."""
    store = Store(spark, Warehouse(scratch_folder(spark)))
    listed = dims.us_airports(bindings.airports(spark, sf_dir))
    first = F.col("state_code") < "S3"
    for rows in (listed.where(first), listed, listed.where(~first).withColumn("name", F.upper("name"))):
        with store.load() as load:
            pipeline.write_dimension(load, "us_airports", dims.occurrences(rows), "ident", "occurrence")
            load.publish()
    return store.table("us_airports").select("ident", "name", "iata_code", "state_code", "id")


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a reload of every December, some of them taken by a record of another month, and where."""
    store = Store(spark, Warehouse(scratch_folder(spark)))
    rows = unnamed_fact(spark, sf_dir)
    with store.load() as load:
        load.write_fact(rows)
        load.write_id_filters()
        load.publish()
    mistaken = "case when immigration_id % 7 = 0 then immigration_id - 1 else immigration_id end"
    with store.load() as load:
        load.write_fact(rows.where("arrival_month = 12").withColumn("immigration_id", F.expr(mistaken)))
        return fixed(load.repeated_ids())


def _as_text(field: T.StructField) -> Column:
    """A value as text that other engines spell alike; doubles to three places."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DoubleType):
        column = F.round(column * 1000).cast("long")
    return column.cast("string")


def _checksum(text: Column) -> Column:
    """Sum over all rows of the first 32 bits of a text's MD5."""
    return F.coalesce(F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")), F.lit(0))


def csv_source_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled rows and a checksum of every column of each CSV source after writing and reading it."""
    inputs = write_inputs(spark, sf_dir)
    sources = {
        "airports": readers.read_airports(spark, inputs.airports),
        "country_codes": readers.read_country_codes(spark, inputs.country_codes),
        "demographics": readers.read_demographics(spark, inputs.demographics),
        "state_coordinates": readers.read_state_coordinates(spark, inputs.state_coordinates),
        "temperature": readers.read_temperature(spark, inputs.temperature),
    }
    frames = [
        df.agg(F.array(*[
            F.struct(
                F.lit(f.name).alias("column_name"), F.count(f"`{f.name}`").alias("filled"),
                _checksum(_as_text(f)).alias("checksum"),
            )
            for f in df.schema
        ]).alias("columns")).select(F.lit(name).alias("source"), F.inline("columns"))
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionAll, frames)


def write_text_files(entries: DataFrame, opening: str, closing: str, root: str, per_file: int = 5000) -> None:
    """Write text entries as files of about ``per_file`` of them each, in order, each with its own frame."""
    files = max(1, -(-entries.count() // per_file))
    body = F.array_join(F.sort_array(F.collect_list("entry")), "\n")
    text = F.concat(F.lit(opening), body, F.lit(closing))
    dealt = entries.groupBy(F.pmod(F.xxhash64("entry"), F.lit(files)).alias("file")).agg(text.alias("value"))
    # A task may get several groups; each goes to a file of its own.
    dealt.select("value").write.option("maxRecordsPerFile", 1).mode("append").text(root)


def write_label_block(lines: DataFrame, format: str, close: str, root: str, per_file: int = 5000) -> None:
    """Write label lines as files of about ``per_file`` entries each, with a block of their own."""
    opening = f"/* {format}, a value\n 1 = 'no label' */\n  value {format}\n"
    entries = lines.select(F.regexp_replace("line", " ;$", "").alias("entry"))
    write_text_files(entries, opening, f"{close}\n 99 = 'after the end'", root, per_file)


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of temperature files per outcome, kept or why not, with a checksum of their text.

    A line per event; some lack fields or have one too many, some hold values that are no
    date or no number.
    """
    root = scratch_folder(spark)
    line = """concat_ws(',',
        if(event_id % 19 = 0, 'soon', date_format(ts, 'yyyy-MM-dd')),
        case when event_id % 17 = 0 then 'warm' when event_id % 13 = 0 then ''
             else cast(cast(event_id % 400 as int) / 8 - 20 as string) end,
        if(event_id % 23 = 0, null, concat('City ', event_id)),
        if(event_id % 23 = 0, null, concat(event_type, ' land')),
        if(event_id % 29 = 0, 'more', null))"""
    lines = bindings.table(spark, sf_dir, "events").select(F.expr(line).alias("entry"))
    write_text_files(lines, "dt,AverageTemperature,City,Country\n", "\n", root)
    examined = fixed(readers.examined_csv(spark, root, schemas.TEMPERATURE_RAW))
    outcome = F.coalesce("_reason", F.lit("kept")).alias("outcome")
    return examined.groupBy(outcome).agg(
        F.count("*").alias("records"), _checksum(F.col("_record")).alias("checksum"),
        F.count_if(F.col("_file").endswith(".txt")).alias("with_file"),
    )


def label_file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """format, code and label of every row of label files with country, port and state blocks."""
    root = scratch_folder(spark)
    blocks = {
        "countryl": (bindings.country_label_lines(spark, sf_dir), " ;"),
        "$portl": (bindings.port_label_lines(spark, sf_dir), "\n;"),
        "$statel": (bindings.state_label_lines(spark, sf_dir), "\n ;"),
    }
    for format, (lines, close) in blocks.items():
        write_label_block(lines, format, close, root)
    return read_labels(spark, root)


def write_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Raw inputs as files: arrivals as a parquet extract, the others as CSV."""
    root = scratch_folder(spark)
    inputs = Inputs(*[
        join_path(root, name)
        for name in ("arrivals", "country_codes", "temperature", "demographics",
                     "state_coordinates", "airports")
    ])
    bindings.arrivals(spark, sf_dir).write.parquet(inputs.arrivals)
    for df, path, sep in (
        (bindings.country_codes(spark, sf_dir), inputs.country_codes, ";"),
        (bindings.demographics(spark, sf_dir), inputs.demographics, ";"),
        (bindings.temperature(spark, sf_dir), inputs.temperature, ","),
        (bindings.state_coordinates(spark, sf_dir), inputs.state_coordinates, ","),
        (bindings.airports(spark, sf_dir), inputs.airports, ","),
    ):
        # Padding must stay, and quotes inside a text are doubled.
        df.write.csv(
            path, sep=sep, header=True, escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    return inputs


def full_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run from files to the stored star schema: rows and checksum of each stored table."""
    run = pipeline.run_pipeline(
        spark, write_inputs(spark, sf_dir), Warehouse(scratch_folder(spark)), strict=True
    )
    frames = [
        df.agg(
            F.count("*").alias("row_count"),
            _checksum(
                F.concat_ws("|", *[F.coalesce(_as_text(f), F.lit("-")) for f in df.schema])
            ).alias("checksum"),
        ).select(F.lit(name).alias("table_name"), "row_count", "checksum")
        for name, df in run.tables.items()
    ]
    return reduce(DataFrame.unionAll, frames)


def stream_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of arrival files, each merged by a stream that stops when done: one half of
    the months, the other, and some records of both once more, a few of them unusable now."""
    root = scratch_folder(spark)
    arrivals, state = join_path(root, "in"), join_path(root, "state")
    store = Store(spark, Warehouse(join_path(root, "out")))
    raw = bindings.arrivals(spark, sf_dir)
    codebook_rows = bindings.country_codes(spark, sf_dir)
    withdrawn = F.expr("case when cicid % 20 = 0 then null else gender end")
    again = raw.where("cicid % 5 = 0").withColumn("gender", withdrawn)
    for delivery in (raw.where("i94mon <= 6"), raw.where("i94mon > 6"), again):
        delivery.write.mode("append").parquet(arrivals)
        load_new_files(spark, arrivals, codebook_rows, store, state).awaitTermination()
    return store.table("immigration_fact").groupBy("arrival_year", "arrival_month", "country").agg(
        F.count("*").alias("arrivals"), F.sum("immigration_id").alias("id_sum")
    )


QUERIES: dict[str, Query] = {
    "arrivals_null_audit": arrivals_null_audit,
    "arrivals_clean": clean,
    "sas_date_decode": sas_date_decode,
    "country_lookup_join": country_lookup_join,
    "mode_visa_decode": mode_visa_decode,
    "arrivals_fact": fact,
    "date_dim": date_dim,
    "temperature_dim": temperature_dim,
    "demographics_dim": demographics_dim,
    "demographics_by_city": demographics_by_city,
    "airports_dim": airports_dim,
    "codebook_country_class": codebook_country_class,
    "codebook_valid_countries": codebook_valid_countries,
    "port_label_parse": port_label_parse,
    "port_alias_resolve": port_alias_resolve,
    "state_other_decode": state_other_decode,
    "age_consistency": age_consistency,
    "stay_length": stay_length,
    "star_join_country": star_join_country,
    "star_join_demographics": star_join_demographics,
    "star_join_airports": star_join_airports,
    "star_join_dates": star_join_dates,
    "star_join_state_airports": star_join_state_airports,
    "q1_arrivals_in_timeframe": q1_arrivals_in_timeframe,
    "q2_top_visa_category": q2_top_visa_category,
    "q3_weather_corr": q3_weather_corr,
    "q3_arrivals_and_temperature": q3_arrivals_and_temperature,
    "q4_top_state": q4_top_state,
    "q5_top_mode": q5_top_mode,
    "q6_air_business_by_state": q6_air_business_by_state,
    "q6_air_business_ties": q6_air_business_ties,
    "q7_state_hotspots": q7_state_hotspots,
    "q8_business_ports": q8_business_ports,
    "q9_cube": q9_cube,
    "q9_rollup": q9_rollup,
    "q9_grouping_sets": q9_grouping_sets,
    "weighted_count": weighted_count,
    "quality_sources": quality_sources,
    "quality_nonempty": quality_nonempty,
    "quality_key_unique": quality_key_unique,
    "quality_orphans": quality_orphans,
    "quality_orphan_keys": quality_orphan_keys,
    "quality_partitions": quality_partitions,
    "reconciled_names": reconciled_names,
    "quality_shared_coordinates": quality_shared_coordinates,
    "quality_load": quality_load,
    "quality_lookup_conflicts": quality_lookup_conflicts,
    "fact_partitioned_roundtrip": fact_partitioned_roundtrip,
    "monthly_load": monthly_load,
    "maintained_cube": maintained_cube,
    "maintained_timeframe": maintained_timeframe,
    "lasting_date_ids": lasting_date_ids,
    "lasting_airport_ids": lasting_airport_ids,
    "repeated_ids": repeated_ids,
    "csv_source_roundtrip": csv_source_roundtrip,
    "csv_quarantine": csv_quarantine,
    "label_file_roundtrip": label_file_roundtrip,
    "full_pipeline": full_pipeline,
    "stream_new_files": stream_new_files,
}
