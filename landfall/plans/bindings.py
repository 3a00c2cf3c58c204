"""Raw input shapes derived from the given tables.

Each shape is a projection of whole tables with the cases a raw input has:
missing values, unknown codes, odd spellings, repeated keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One arrival record per order."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    day = "datediff(cast(o_orderdate as date), date'1960-01-01')"
    return orders.join(customer, orders.o_custkey == customer.c_custkey).selectExpr(
        "cast(o_orderkey as double) as cicid",
        "cast(year(o_orderdate) as double) as i94yr",
        "cast(month(o_orderdate) as double) as i94mon",
        "cast(c_nationkey as double) as i94cit",
        "cast((c_custkey * 7) % 30 as double) as i94res",
        "concat(if(o_orderkey % 40 < 35, 'P', 'Q'), cast(o_orderkey % 40 as string)) as i94port",
        f"""case when o_orderkey % 211 = 0 then null
                 when o_orderkey % 499 = 1 then 0.0D
                 when o_orderkey % 13 = 0 then {day} + 0.75D
                 else cast({day} as double) end as arrdate""",
        """case o_orderkey % 10 when 0 then null when 7 then 2.0D when 8 then 3.0D
                when 9 then if(o_orderkey % 20 = 9, 9.0D, 5.0D) else 1.0D end as i94mode""",
        "concat('S', cast(c_nationkey % 20 as string)) as i94addr",
        f"""case when o_orderkey % 19 = 0 then null
                 else cast({day} + o_orderkey % 30 - 1 as double) end as depdate""",
        """cast(year(o_orderdate) - 1940 - c_custkey % 70
                - case when o_orderkey % 37 = 0 then 5 else o_orderkey % 2 end as double) as i94bir""",
        """case when o_orderkey % 23 = 0 then null when o_orderkey % 29 = 0 then 7.0D
                when o_orderstatus = 'F' then 1.0D when o_orderstatus = 'O' then 2.0D
                else 3.0D end as i94visa""",
        "cast(1 + o_orderkey % 3 as double) as count",
        "case when c_custkey % 31 = 0 then null else cast(1940 + c_custkey % 70 as double) end as biryear",
        """case when c_custkey % 17 = 0 then null when c_custkey % 2 = 0 then 'M'
                else 'F' end as gender""",
        "o_orderpriority as visatype",
    )


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code book of all nations under shifted codes; the descriptions end in a space."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .selectExpr(
            "n_nationkey + 4 as code", "concat(r_name, ' ', n_name, ' ') as description"
        )
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State list (code, label), which does not hold the first five codes in use."""
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('S', cast(n_nationkey + 5 as string)) as code",
        "concat(n_name, ' STATE') as label",
    )


def temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event, in countries spelled unlike the code book."""
    events = table(spark, sf_dir, "events")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        events.join(nation, events.user_id % 25 == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .selectExpr(
            "cast(ts as date) as dt",
            "case when event_id % 13 = 0 then null else value end as AverageTemperature",
            "event_type as City",
            "concat(initcap(r_name), '-', lower(n_name)) as Country",
            # Repeated and missing, so ties and nulls must be settled too.
            "case when event_id % 5 = 0 then null else event_id div 3 end as reading_no",
        )
    )


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city per customer."""
    state, total = "c_nationkey % 20", "c_custkey % 1000"
    return table(spark, sf_dir, "customer").selectExpr(
        "c_name as City",
        f"concat('S', cast({state} as string)) as `State Code`",
        f"{total} as `Total Population`",
        f"case when {state} = 5 then null else ({total}) div 2 end as `Male Population`",
        f"case when c_custkey % 11 = 0 then null else {total} - ({total}) div 2 end as `Female Population`",
        f"case when {state} = 3 then null else c_custkey % 90 end as `Number of Veterans`",
        f"case when {state} = 4 then null else c_custkey % 80 end as `Foreign-born`",
    )


def state_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates by state, none for S0 and S1; two states share theirs, and some are
    listed a second time without a place."""
    place = "case when n_nationkey = 8 then 7 else n_nationkey end"
    listed = table(spark, sf_dir, "nation").select("n_nationkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    return listed.selectExpr(
        "concat('S', cast(n_nationkey + 2 as string)) as State",
        f"if(copy = 1 and n_nationkey % 3 = 0, null, {place} * 1.5D) as Latitude",
        f"if(copy = 1 and n_nationkey % 3 = 0, null, {place} * -2.25D) as Longitude",
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One airport per part; a code may belong to several."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('A', cast(p_partkey as string)) as ident",
        """concat(p_name, case p_partkey % 4 when 0 then ', "Ace" Field' when 1 then '  '
                         else '' end) as name""",
        "case when p_size % 2 = 1 then 'US' else 'CA' end as iso_country",
        """case when p_partkey % 101 = 0 then null
                else concat('US-S', cast(p_partkey % 20 as string)) end as iso_region""",
        """case when p_partkey % 3 = 0 then null
                else concat('P', cast(p_partkey % 500 as string)) end as iata_code""",
        """case when p_partkey % 89 = 0 then null when p_partkey % 97 = 0 then 'unknown'
                else concat(cast(p_size as string), if(p_partkey % 5 = 0, ',', ', '),
                            cast(p_retailprice as string)) end as coordinates""",
    )


def _lines(df: DataFrame, line: str) -> DataFrame:
    """One text line per row. As with lines split off a file, what reads them
    works on the finished line and does not repeat the expression that makes it."""
    return df.select(F.explode(F.array(F.expr(line))).alias("line"))


def country_label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One country label line per customer."""
    return _lines(
        table(spark, sf_dir, "customer"),
        """concat('   ', cast(c_custkey as string), ' =  ''',
            case c_custkey % 7
                when 0 then concat('INVALID: ', c_mktsegment)
                when 1 then concat('No Country Code (', cast(c_custkey as string), ')')
                when 2 then concat('Collapsed ', c_mktsegment, ' (should not show)')
                when 3 then concat(c_mktsegment, '''''S LAND ')
                else concat(c_mktsegment, ' ', cast(c_nationkey as string)) end,
            '''', case when c_custkey % 5 = 0 then ' ;' else '' end)""",
    )


def port_label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One port label line per part."""
    state = "array('AA', 'BB', 'MX', 'CC')[p_partkey % 4]"
    return _lines(
        table(spark, sf_dir, "part"),
        f"""concat('   ''P', cast(p_partkey as string), if(p_partkey % 4 = 3, ' ', ''), '''\t=\t''',
            case p_partkey % 9
                when 0 then concat(upper(p_name), ', ', {state}, '      ')
                when 1 then concat(upper(p_name), ',', {state})
                when 2 then concat(upper(p_name), ' ', {state}, '  ')
                when 3 then concat(upper(p_name), ', ', {state}, ' (BPS)')
                when 4 then concat(upper(p_name), ', ', {state}, ' #ARPT')
                when 5 then concat('Collapsed (P', cast(p_partkey div 2 as string), ') 06/15')
                when 6 then concat('Collapsed into P', cast(p_partkey div 3 as string), ', ', {state})
                when 7 then concat('No PORT Code (P', cast(p_partkey as string), ')')
                else concat('PORT O''''', upper(p_name), ' ') end,
            '''')""",
    )


def port_chain_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One more port label line per part: chains of up to a thousand collapsed ports."""
    return _lines(
        table(spark, sf_dir, "part"),
        """concat('   ''C', cast(p_partkey as string), '''\t=\t''',
            case when p_partkey % 1000 = 0 then concat(upper(p_name), ', AA')
                else concat('Collapsed (C', cast(p_partkey - 1 as string), ') 06/15') end,
            '''')""",
    )


def state_label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One state label line per nation; some hold a semicolon."""
    return _lines(
        table(spark, sf_dir, "nation"),
        "concat('\\t\\'S', cast(n_nationkey as string), '\\'=\\'', n_name, "
        "if(n_nationkey % 3 = 0, '; STATE', ' STATE '), '\\'')",
    )


def port_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed port states: a doubled letter per nation, so MX is not among them."""
    return table(spark, sf_dir, "nation").selectExpr(
        "repeat(char(65 + n_nationkey), 2) as code", "n_name as label"
    )


def day_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw day number per line item: whole, with fraction, 0, negative or missing."""
    day = "datediff(cast(l_shipdate as date), date'1960-01-01')"
    return table(spark, sf_dir, "lineitem").select(
        F.expr(f"""case when l_orderkey % 11 = 0 then null
                        when l_orderkey % 11 = 1 then 0.0D
                        when l_orderkey % 11 = 2 then {day} + 0.9D
                        when l_orderkey % 11 = 3 then -{day} - 0.5D
                        when l_orderkey % 11 = 4 then double('NaN')
                        when l_orderkey % 11 = 5 then 1e12D
                        else cast({day} as double) end""").alias("day_number")
    )
