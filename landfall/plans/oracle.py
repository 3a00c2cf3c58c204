"""DuckDB statements that compute each registered query from the same tables."""

from __future__ import annotations

_ARRIVALS = """
days AS (
  SELECT o.*, c.c_nationkey, c.c_custkey,
         cast(o_orderdate AS date) - date '1960-01-01' AS d
  FROM orders o JOIN customer c ON o_custkey = c_custkey
),
arrivals AS (
  SELECT cast(o_orderkey AS double) AS cicid,
         cast(year(o_orderdate) AS double) AS i94yr,
         cast(month(o_orderdate) AS double) AS i94mon,
         cast(c_nationkey AS double) AS i94cit,
         cast((c_custkey * 7) % 30 AS double) AS i94res,
         CASE WHEN o_orderkey % 40 < 35 THEN 'P' ELSE 'Q' END || cast(o_orderkey % 40 AS varchar) AS i94port,
         CASE WHEN o_orderkey % 211 = 0 THEN NULL
              WHEN o_orderkey % 499 = 1 THEN cast(0 AS double)
              WHEN o_orderkey % 13 = 0 THEN cast(d AS double) + 0.75
              ELSE cast(d AS double) END AS arrdate,
         CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 7 THEN cast(2 AS double)
              WHEN 8 THEN cast(3 AS double)
              WHEN 9 THEN CASE WHEN o_orderkey % 20 = 9 THEN cast(9 AS double) ELSE cast(5 AS double) END
              ELSE cast(1 AS double) END AS i94mode,
         'S' || cast(c_nationkey % 20 AS varchar) AS i94addr,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL
              ELSE cast(d + o_orderkey % 30 - 1 AS double) END AS depdate,
         cast(year(o_orderdate) - 1940 - c_custkey % 70
              - CASE WHEN o_orderkey % 37 = 0 THEN 5 ELSE o_orderkey % 2 END AS double) AS i94bir,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN cast(7 AS double)
              WHEN o_orderstatus = 'F' THEN cast(1 AS double)
              WHEN o_orderstatus = 'O' THEN cast(2 AS double) ELSE cast(3 AS double) END AS i94visa,
         cast(1 + o_orderkey % 3 AS double) AS count,
         CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE cast(1940 + c_custkey % 70 AS double) END AS biryear,
         CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         o_orderpriority AS visatype
  FROM days
)"""

_CODEBOOK = """
codebook AS (
  SELECT n_nationkey + 4 AS code,
         array_to_string(list_transform(string_split(lower(trim(r_name || ' ' || n_name || ' ')), ' '),
                                        lambda w: upper(w[1]) || w[2:]), ' ') AS name
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_CLEAN = """
clean AS (
  SELECT * FROM arrivals
  WHERE arrdate IS NOT NULL AND depdate IS NOT NULL AND i94mode IS NOT NULL
    AND i94visa IS NOT NULL AND biryear IS NOT NULL AND gender IS NOT NULL
)"""

_MODE = """CASE i94mode WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land'
            ELSE 'Not Reported' END"""
_VISA = """CASE i94visa WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student'
            ELSE 'Unknown' END"""


def _date(number: str) -> str:
    return (
        f"CASE WHEN {number} <> 0 AND {number} BETWEEN -715509 AND 2936549 "
        f"THEN date '1960-01-01' + cast(trunc({number}) AS integer) END"
    )


_FACT = f"""
fact AS (
  SELECT cast(cicid AS bigint) AS immigration_id,
         cast(i94yr AS integer) AS arrival_year,
         cast(i94mon AS integer) AS arrival_month,
         i94port AS port_of_entry,
         {_MODE} AS travel_mode,
         i94addr AS destination_state,
         {_date('arrdate')} AS arrival_date,
         {_date('depdate')} AS departure_date,
         cit.name AS country,
         res.name AS country_of_residence,
         visatype,
         {_VISA} AS visa_category,
         cast(biryear AS integer) AS birth_year,
         gender
  FROM clean
  LEFT JOIN codebook cit ON i94cit = cit.code
  LEFT JOIN codebook res ON i94res = res.code
)"""

_DATES = """
arrival_time AS (
  SELECT arrival_date,
         cast(day(arrival_date) AS integer) AS day,
         cast(weekofyear(arrival_date) AS integer) AS week,
         cast(month(arrival_date) AS integer) AS month,
         cast(year(arrival_date) AS integer) AS year,
         cast(dayofweek(arrival_date) + 1 AS integer) AS weekday,
         row_number() OVER (ORDER BY arrival_date NULLS FIRST) - 1 AS id
  FROM (SELECT DISTINCT arrival_date FROM fact)
)"""

_TEMPERATURE = """
temperature AS (
  SELECT cast(ts AS date) AS dt,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS AverageTemperature,
         event_type AS City,
         CASE WHEN r_name = 'MIDDLE EAST' THEN 'Middle East'
              ELSE upper(r_name[1]) || lower(r_name[2:]) END || '-' || lower(n_name) AS Country,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id // 3 END AS reading_no
  FROM events JOIN nation ON user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
country AS (
  SELECT Country AS country, avg(AverageTemperature) AS average_temperature,
         row_number() OVER (ORDER BY Country) - 1 AS id
  FROM (SELECT *, row_number() OVER (PARTITION BY dt, City, Country
          ORDER BY reading_no NULLS LAST, AverageTemperature) AS rn
        FROM temperature WHERE AverageTemperature IS NOT NULL)
  WHERE rn = 1 GROUP BY Country
)"""

_CITIES = """
cities AS (
  SELECT c_name AS City, 'S' || cast(c_nationkey % 20 AS varchar) AS state_code,
         c_custkey % 1000 AS total,
         CASE WHEN c_nationkey % 20 = 5 THEN NULL ELSE (c_custkey % 1000) // 2 END AS male,
         CASE WHEN c_custkey % 11 = 0 THEN NULL
              ELSE c_custkey % 1000 - (c_custkey % 1000) // 2 END AS female,
         CASE WHEN c_nationkey % 20 = 3 THEN NULL ELSE c_custkey % 90 END AS veterans,
         CASE WHEN c_nationkey % 20 = 4 THEN NULL ELSE c_custkey % 80 END AS foreign_born
  FROM customer
)"""

_COORDINATES = """
coordinates AS (
  SELECT 'S' || cast(n_nationkey + 2 AS varchar) AS State,
         CASE WHEN n_nationkey = 8 THEN 7 ELSE n_nationkey END * cast(1.5 AS double) AS latitude,
         CASE WHEN n_nationkey = 8 THEN 7 ELSE n_nationkey END * cast(-2.25 AS double) AS longitude
  FROM nation
)"""

_DEMOGRAPHICS = f"""{_CITIES},{_COORDINATES},
demographics AS (
  SELECT state_code, total_population, male_population, female_population,
         coalesce(number_of_veterans, 0) AS number_of_veterans,
         coalesce(foreign_born, 0) AS foreign_born, latitude, longitude,
         row_number() OVER (ORDER BY state_code) - 1 AS id
  FROM (SELECT state_code, cast(sum(total) AS bigint) AS total_population,
               cast(sum(male) AS bigint) AS male_population,
               cast(sum(female) AS bigint) AS female_population,
               cast(sum(veterans) AS bigint) AS number_of_veterans,
               cast(sum(foreign_born) AS bigint) AS foreign_born
        FROM cities GROUP BY state_code) s
  LEFT JOIN coordinates ON state_code = State
)"""

_AIRPORTS = """
listed AS (
  SELECT 'A' || cast(p_partkey AS varchar) AS ident,
         p_name || CASE p_partkey % 4 WHEN 0 THEN ', "Ace" Field' WHEN 1 THEN '  ' ELSE '' END AS name,
         CASE WHEN p_size % 2 = 1 THEN 'US' ELSE 'CA' END AS iso_country,
         CASE WHEN p_partkey % 101 = 0 THEN NULL
              ELSE 'US-S' || cast(p_partkey % 20 AS varchar) END AS iso_region,
         CASE WHEN p_partkey % 3 = 0 THEN NULL
              ELSE 'P' || cast(p_partkey % 500 AS varchar) END AS iata_code,
         CASE WHEN p_partkey % 89 = 0 THEN NULL WHEN p_partkey % 97 = 0 THEN 'unknown'
              ELSE cast(p_size AS varchar) || CASE WHEN p_partkey % 5 = 0 THEN ',' ELSE ', ' END
                   || cast(p_retailprice AS varchar) END AS coordinates
  FROM part
),
airports AS (
  SELECT ident, name, iata_code, substr(iso_region, 4) AS state_code,
         try_cast(trim(string_split(coordinates, ',')[1]) AS double) AS latitude,
         try_cast(trim(string_split(coordinates, ',')[2]) AS double) AS longitude,
         row_number() OVER (ORDER BY ident) - 1 AS id
  FROM listed WHERE iso_country = 'US' AND iata_code IS NOT NULL
),
airports_by_code AS (
  SELECT iata_code, arg_min(name, ident) AS airport_name,
         min(struct_pack(i := ident, s := state_code)).s AS airport_state,
         count(*) AS airports_with_code
  FROM airports GROUP BY iata_code
)"""

_KEY = r"trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def _key(column: str) -> str:
    return _KEY.format(column)


_ARRIVALS_FACT = f"{_ARRIVALS},{_CODEBOOK},{_CLEAN},{_FACT}"
_STAR = f"{_ARRIVALS_FACT},{_DATES},{_TEMPERATURE},{_DEMOGRAPHICS},{_AIRPORTS}"


_COUNTRY_LABELS = """
labels AS (
  SELECT cast(c_custkey AS integer) AS code,
         CASE c_custkey % 7
           WHEN 0 THEN 'INVALID: ' || c_mktsegment
           WHEN 1 THEN 'No Country Code (' || cast(c_custkey AS varchar) || ')'
           WHEN 2 THEN 'Collapsed ' || c_mktsegment || ' (should not show)'
           WHEN 3 THEN c_mktsegment || '''S LAND'
           ELSE c_mktsegment || ' ' || cast(c_nationkey AS varchar) END AS label,
         CASE c_custkey % 7 WHEN 0 THEN 'INVALID' WHEN 1 THEN 'No Country Code'
           WHEN 2 THEN 'Collapsed' ELSE 'valid' END AS code_class
  FROM customer
)"""

_PORT_LABELS = """
ports AS (
  SELECT p_partkey AS k, p_partkey % 9 AS form, upper(p_name) AS place,
         (['AA', 'BB', 'MX', 'CC'])[p_partkey % 4 + 1] AS st
  FROM part
),
labels AS (
  SELECT 'P' || cast(k AS varchar) AS code,
         CASE form WHEN 0 THEN place || ', ' || st WHEN 1 THEN place || ',' || st
           WHEN 2 THEN place || ' ' || st WHEN 3 THEN place || ', ' || st || ' (BPS)'
           WHEN 4 THEN place || ', ' || st || ' #ARPT'
           WHEN 5 THEN 'Collapsed (P' || cast(k // 2 AS varchar) || ') 06/15'
           WHEN 6 THEN 'Collapsed into P' || cast(k // 3 AS varchar) || ', ' || st
           WHEN 7 THEN 'No PORT Code (P' || cast(k AS varchar) || ')'
           ELSE 'PORT O''' || place END AS label,
         CASE form WHEN 5 THEN 'P' || cast(k // 2 AS varchar)
           WHEN 6 THEN 'P' || cast(k // 3 AS varchar) END AS target_code,
         CASE WHEN form <= 4 AND st <> 'MX' THEN st END AS state,
         CASE WHEN form <= 4 THEN CASE
                WHEN st <> 'MX' THEN place
                WHEN form = 1 THEN place || ',' || st
                WHEN form = 2 THEN place || ' ' || st
                ELSE place || ', ' || st END
              WHEN form = 8 THEN 'PORT O''' || place END AS city
  FROM ports
)"""

_FACT_COLUMNS = """immigration_id, arrival_year, arrival_month, port_of_entry, travel_mode,
destination_state, arrival_date, departure_date, country, country_of_residence, visatype,
visa_category, birth_year, gender"""

_DEMOGRAPHICS_COLUMNS = """state_code, total_population, male_population, female_population,
number_of_veterans, foreign_born, latitude, longitude, id"""

_TIMEFRAME = """SELECT cast(year(arrival_date) AS integer) AS year,
 cast(month(arrival_date) AS integer) AS month, count(*) AS arrivals
FROM fact WHERE arrival_date BETWEEN date '1997-02-10' AND date '1998-11-20' GROUP BY 1, 2"""

_COUNTRY_MATCH = f""",
per_country AS (
  SELECT {_key('country_of_residence')} AS name_key,
         min(country_of_residence) AS country_of_residence, count(*) AS arrivals
  FROM fact GROUP BY 1
),
per_key AS (
  SELECT {_key('country')} AS name_key, avg(average_temperature) AS average_temperature
  FROM country GROUP BY 1
),
matched AS (
  SELECT country_of_residence, arrivals, average_temperature
  FROM per_country JOIN per_key USING (name_key)
)"""


def _top(column: str, k: int, where: str = "true") -> str:
    return f"""SELECT {column}, count(*) AS arrivals FROM fact WHERE {where}
    GROUP BY {column} ORDER BY arrivals DESC, {column} NULLS FIRST LIMIT {k}"""


def _keys(table: str, key: str, name: str | None = None) -> str:
    return f"""SELECT '{name or table}' AS table_name, count(*) AS repeated_keys,
     cast(coalesce(sum(n - 1), 0) AS bigint) AS surplus_rows, count(*) = 0 AS passed
    FROM (SELECT count(*) AS n FROM {table} GROUP BY {key} HAVING count(*) > 1)"""


def _orphans(name: str, child: str, table: str, parent: str) -> str:
    return f"""SELECT '{name}' AS reference, count(DISTINCT k) AS orphan_keys,
     count(*) AS orphan_rows, count(*) = 0 AS passed
    FROM (SELECT {child} AS k FROM fact) u
    WHERE k IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {table} p WHERE {parent} = u.k)"""


_TABLE_NAMES = {
    "immigration_fact": "fact",
    "arrival_time": "arrival_time",
    "country": "country",
    "us_population_demographics": "demographics",
    "us_airports": "airports",
}

_NONEMPTY = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count, count(*) > 0 AS passed FROM {cte}"
    for name, cte in _TABLE_NAMES.items()
)


def _thousandths(column: str) -> str:
    return f"cast(cast(round({column} * 1000) AS bigint) AS varchar)"


def _text(column: str) -> str:
    return f"cast({column} AS varchar)"


def _dashed(text: str) -> str:
    return f"coalesce({text}, '-')"


def _sum_of_hashes(text: str) -> str:
    return f"cast(coalesce(sum(cast('0x' || substr(md5({text}), 1, 8) AS bigint)), 0) AS bigint)"


def _column(source: str, cte: str, name: str, text: str) -> str:
    return (
        f"SELECT '{source}' AS source, '{name}' AS column_name, count({text}) AS filled, "
        f"{_sum_of_hashes(text)} AS checksum FROM {cte}"
    )


_LISTED_PLACES = f"""(SELECT State, latitude, longitude FROM coordinates UNION ALL
 SELECT State, CASE WHEN n % 3 <> 0 THEN latitude END, CASE WHEN n % 3 <> 0 THEN longitude END
 FROM (SELECT *, cast(substr(State, 2) AS integer) - 2 AS n FROM coordinates))"""

_CSV_COLUMNS = [
    *[("airports", "listed", c, c) for c in ("ident", "name", "iso_country", "iso_region", "iata_code", "coordinates")],
    ("country_codes", "codebook", "code", _text("code")),
    ("country_codes", "(SELECT r_name || ' ' || n_name || ' ' AS d FROM nation JOIN region ON n_regionkey = r_regionkey)", "description", "d"),
    ("demographics", "cities", "City", "City"),
    ("demographics", "cities", "State Code", "state_code"),
    ("demographics", "cities", "Total Population", _text("total")),
    ("demographics", "cities", "Male Population", _text("male")),
    ("demographics", "cities", "Female Population", _text("female")),
    ("demographics", "cities", "Number of Veterans", _text("veterans")),
    ("demographics", "cities", "Foreign-born", _text("foreign_born")),
    ("state_coordinates", _LISTED_PLACES, "State", "State"),
    ("state_coordinates", _LISTED_PLACES, "Latitude", _thousandths("latitude")),
    ("state_coordinates", _LISTED_PLACES, "Longitude", _thousandths("longitude")),
    ("temperature", "temperature", "dt", _text("dt")),
    ("temperature", "temperature", "AverageTemperature", _thousandths("AverageTemperature")),
    ("temperature", "temperature", "City", "City"),
    ("temperature", "temperature", "Country", "Country"),
    ("temperature", "temperature", "reading_no", _text("reading_no")),
]

_STORED_COLUMNS = {
    "immigration_fact": [_text(c) for c in (
        "immigration_id", "arrival_year", "arrival_month", "port_of_entry", "travel_mode", "destination_state",
        "arrival_date", "departure_date", "country", "country_of_residence", "visatype", "visa_category",
        "birth_year", "gender")],
    "arrival_time": [_text(c) for c in ("arrival_date", "day", "week", "month", "year", "weekday", "id")],
    "country": ["country", _thousandths("average_temperature"), _text("id")],
    "us_population_demographics": [
        *[_text(c) for c in ("state_code", "total_population", "male_population", "female_population",
                             "number_of_veterans", "foreign_born")],
        _thousandths("latitude"), _thousandths("longitude"), _text("id")],
    "us_airports": ["ident", "name", "iata_code", "state_code", _thousandths("latitude"), _thousandths("longitude"), _text("id")],
}


# Arrivals that remain after the registered loads of the same months.
_LOADED = "arrival_month <> 12 AND (arrival_month % 2 = 0 OR travel_mode <> 'Sea')"


def statements() -> dict[str, str]:
    removed, earlier = [], []
    for c in ("arrdate", "depdate", "i94mode", "i94visa", "biryear", "gender"):
        condition = " AND ".join([*earlier, f"{c} IS NULL"])
        removed.append(f"count(*) FILTER (WHERE {condition}) AS removed_{c}")
        earlier.append(f"{c} IS NOT NULL")
    kept = " AND ".join(earlier)

    fact = f"WITH {_ARRIVALS_FACT}"
    return {
        "arrivals_null_audit": f"""WITH {_ARRIVALS}
            SELECT count(*) AS total_rows, {', '.join(removed)},
                   count(*) FILTER (WHERE {kept}) AS kept_rows,
                   count(*) FILTER (WHERE {kept} AND arrdate = 0) AS undated_arrdate,
                   count(*) FILTER (WHERE {kept} AND depdate = 0) AS undated_depdate,
                   count(*) = {' + '.join(r.rsplit(' AS ', 1)[0] for r in removed)}
                     + count(*) FILTER (WHERE {kept}) AS balanced
            FROM arrivals""",
        "arrivals_clean": f"WITH {_ARRIVALS},{_CLEAN} SELECT * FROM clean",
        "sas_date_decode": f"""WITH n AS (
              SELECT l_orderkey % 11 AS m, cast(l_shipdate AS date) - date '1960-01-01' AS d
              FROM lineitem),
            numbers AS (
              SELECT CASE WHEN m = 0 THEN NULL WHEN m = 1 THEN cast(0 AS double)
                          WHEN m = 2 THEN cast(d AS double) + 0.9
                          WHEN m = 3 THEN -cast(d AS double) - 0.5
                          WHEN m = 4 THEN NULL WHEN m = 5 THEN cast(1e12 AS double)
                          ELSE cast(d AS double) END AS day_number FROM n),
            decoded AS (SELECT {_date('day_number')} AS decoded_date FROM numbers)
            SELECT decoded_date, count(*) AS rows FROM decoded GROUP BY 1""",
        "country_lookup_join": f"""WITH {_ARRIVALS},{_CODEBOOK}
            SELECT cicid, cit.name AS country, res.name AS country_of_residence
            FROM arrivals LEFT JOIN codebook cit ON i94cit = cit.code
            LEFT JOIN codebook res ON i94res = res.code""",
        "mode_visa_decode": f"""WITH {_ARRIVALS}, decoded AS (
              SELECT {_MODE} AS travel_mode,
                     CASE WHEN i94mode IS NULL THEN 'missing' WHEN i94mode IN (1, 2, 3) THEN 'reported'
                          WHEN i94mode = 9 THEN 'not reported' ELSE 'other code' END AS mode_status,
                     {_VISA} AS visa_category FROM arrivals)
            SELECT travel_mode, mode_status, visa_category, count(*) AS arrivals
            FROM decoded GROUP BY 1, 2, 3""",
        "arrivals_fact": f"{fact} SELECT {_FACT_COLUMNS} FROM fact",
        "date_dim": f"{fact},{_DATES} SELECT * FROM arrival_time",
        "temperature_dim": f"""WITH {_TEMPERATURE}
            SELECT country, round(average_temperature, 6) AS average_temperature, id FROM country""",
        "demographics_dim": f"WITH {_DEMOGRAPHICS} SELECT {_DEMOGRAPHICS_COLUMNS} FROM demographics",
        "demographics_by_city":
            f"WITH {_DEMOGRAPHICS} SELECT {_DEMOGRAPHICS_COLUMNS} FROM demographics",
        "airports_dim": f"""WITH {_AIRPORTS}
            SELECT ident, name, iata_code, state_code, latitude, longitude, id FROM airports""",
        "codebook_country_class":
            f"WITH {_COUNTRY_LABELS} SELECT code, label, code_class FROM labels",
        "codebook_valid_countries": f"""WITH {_COUNTRY_LABELS}
            SELECT code, label AS description FROM labels WHERE code_class = 'valid'""",
        "port_label_parse": f"WITH {_PORT_LABELS} SELECT code, label, city, state FROM labels",
        "port_alias_resolve": f"""WITH {_PORT_LABELS.replace('labels AS', 'own_labels AS')}
            , labels AS (
              SELECT code, label, target_code FROM own_labels UNION ALL
              SELECT 'C' || cast(k AS varchar),
                     CASE WHEN k % 1000 = 0 THEN place || ', AA' ELSE 'Collapsed (C' || cast(k - 1 AS varchar) || ') 06/15' END,
                     CASE WHEN k % 1000 <> 0 THEN 'C' || cast(k - 1 AS varchar) END FROM ports)
            , ends AS (
              WITH RECURSIVE walk AS (
                SELECT code AS start, target_code AS place FROM labels WHERE target_code IS NOT NULL
                UNION SELECT start, target_code FROM walk JOIN labels ON place = code
                WHERE target_code IS NOT NULL)
              SELECT start, code, label FROM walk JOIN labels ON place = code WHERE target_code IS NULL)
            SELECT l.code, l.label, l.target_code,
                   CASE WHEN l.target_code IS NULL THEN l.code ELSE e.code END AS resolved_code,
                   CASE WHEN l.target_code IS NULL THEN l.label ELSE e.label END AS resolved_label
            FROM labels l LEFT JOIN ends e ON l.code = e.start""",
        "state_other_decode": f"""WITH {_ARRIVALS}
            SELECT cicid, i94addr, coalesce(n_name || ' STATE', 'All Other Codes') AS state_name
            FROM arrivals LEFT JOIN nation
              ON i94addr = 'S' || cast(n_nationkey + 5 AS varchar)""",
        "age_consistency": f"""WITH {_ARRIVALS},{_CLEAN}
            SELECT cast(cicid AS bigint) AS immigration_id, cast(i94bir AS integer) AS stated_age,
                   cast(i94yr - biryear AS integer) AS implied_age,
                   i94yr - biryear - i94bir BETWEEN 0 AND 1 AS consistent FROM clean""",
        "stay_length": f"""{fact}
            SELECT immigration_id, arrival_date, departure_date,
                   cast(departure_date - arrival_date AS integer) AS stay_days,
                   departure_date < arrival_date AS departs_before_arrival FROM fact""",
        "star_join_country": f"""{fact},{_TEMPERATURE}
            SELECT immigration_id, country_of_residence,
                   round(average_temperature, 6) AS average_temperature
            FROM fact LEFT JOIN country
              ON {_key('fact.country_of_residence')} = {_key('country.country')}""",
        "star_join_demographics": f"""{fact},{_DEMOGRAPHICS}
            SELECT immigration_id, destination_state, total_population, demographics.foreign_born
            FROM fact LEFT JOIN demographics ON destination_state = state_code""",
        "star_join_airports": f"""{fact},{_AIRPORTS}
            SELECT immigration_id, port_of_entry, airport_name, airport_state, airports_with_code
            FROM fact LEFT JOIN airports_by_code ON port_of_entry = iata_code""",
        "star_join_dates": f"""{fact},{_DATES}
            SELECT immigration_id, fact.arrival_date, id AS date_id, week, weekday
            FROM fact JOIN arrival_time ON fact.arrival_date = arrival_time.arrival_date""",
        "star_join_state_airports": f"""WITH {_DEMOGRAPHICS},{_AIRPORTS}
            SELECT d.state_code, total_population, coalesce(n, 0) AS airports
            FROM demographics d LEFT JOIN
              (SELECT state_code, count(*) AS n FROM airports GROUP BY 1) a
              ON d.state_code = a.state_code""",
        "q1_arrivals_in_timeframe": f"{fact} {_TIMEFRAME}",
        "q2_top_visa_category": f"{fact} {_top('visa_category', 1)}",
        "q3_weather_corr": f"""{fact},{_TEMPERATURE}{_COUNTRY_MATCH}
            SELECT count(*) AS countries,
                   round(corr(cast(arrivals AS double), average_temperature), 6) AS correlation
            FROM matched""",
        "q3_arrivals_and_temperature": f"""{fact},{_TEMPERATURE}{_COUNTRY_MATCH}
            SELECT country_of_residence, arrivals,
                   round(average_temperature, 6) AS average_temperature FROM matched""",
        "q4_top_state": f"""{fact}
            SELECT coalesce(n_name || ' STATE', 'All Other Codes') AS state_name,
                   count(*) AS arrivals
            FROM fact LEFT JOIN nation
              ON destination_state = 'S' || cast(n_nationkey + 5 AS varchar)
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
        "q5_top_mode": f"{fact} {_top('travel_mode', 1)}",
        "q6_air_business_by_state": f"""{fact} {_top(
            'destination_state', 10, "travel_mode = 'Air' AND visa_category = 'Business'")}""",
        "q6_air_business_ties": f"""{fact}, days_used AS (
              SELECT arrival_date, count(*) AS arrivals FROM fact
              WHERE travel_mode = 'Air' AND visa_category = 'Business' GROUP BY 1)
            SELECT arrival_date, arrivals FROM days_used QUALIFY rank() OVER (ORDER BY arrivals DESC) <= 10""",
        "q7_state_hotspots": f"""{fact},{_DEMOGRAPHICS},{_AIRPORTS}
            SELECT f.destination_state, f.arrivals, total_population,
                   round(f.arrivals * cast(100000 AS double) / nullif(total_population, 0), 6)
                     AS arrivals_per_100k,
                   round(cast(foreign_born AS double) / nullif(total_population, 0), 6)
                     AS foreign_born_share,
                   latitude, longitude,
                   CASE WHEN d.state_code IS NOT NULL THEN coalesce(n, 0) END AS airports
            FROM (SELECT destination_state, count(*) AS arrivals FROM fact GROUP BY 1) f
            LEFT JOIN demographics d ON destination_state = d.state_code
            LEFT JOIN (SELECT state_code, count(*) AS n FROM airports GROUP BY 1) a
              ON d.state_code = a.state_code""",
        "q8_business_ports": f"""{fact},{_AIRPORTS}, top AS (
              {_top('port_of_entry', 10, "visa_category = 'Business'")})
            SELECT port_of_entry, arrivals, airport_name, airport_state, airports_with_code
            FROM top LEFT JOIN airports_by_code ON port_of_entry = iata_code""",
        **{
            f"q9_{name}": f"""{fact}
            SELECT travel_mode, visa_category, arrival_year,
                   cast(grouping(travel_mode, visa_category, arrival_year) AS bigint) AS grouping_id,
                   count(*) AS arrivals FROM fact GROUP BY {sets}"""
            for name, sets in {
                "cube": "CUBE (travel_mode, visa_category, arrival_year)",
                "rollup": "ROLLUP (travel_mode, visa_category, arrival_year)",
                "grouping_sets":
                    "GROUPING SETS ((travel_mode, visa_category), (arrival_year), ())",
            }.items()
        },
        "weighted_count": f"""WITH {_ARRIVALS},{_CLEAN}
            SELECT cast(i94yr AS integer) AS arrival_year, cast(i94mon AS integer) AS arrival_month,
                   sum(count) AS weighted_arrivals, count(*) AS records
            FROM clean GROUP BY 1, 2""",
        "quality_sources": f"""WITH {_TEMPERATURE},{_CITIES},{_AIRPORTS}
            SELECT 'temperature' AS source, count(*) AS rows_read,
                   count(AverageTemperature) AS rows_kept,
                   count(DISTINCT CASE WHEN AverageTemperature IS NOT NULL THEN Country END)
                     AS keys_kept FROM temperature
            UNION ALL SELECT 'demographics', count(*), count(*), count(DISTINCT state_code) FROM cities
            UNION ALL SELECT 'airports', count(*),
                   (SELECT count(*) FROM airports), (SELECT count(DISTINCT iata_code) FROM airports)
            FROM listed""",
        "quality_nonempty": f"WITH {_STAR} {_NONEMPTY}",
        "quality_key_unique": f"WITH {_STAR} " + " UNION ALL ".join([
            _keys("fact", "immigration_id", "immigration_fact"),
            _keys("arrival_time", "arrival_date"),
            _keys("country", "country"),
            _keys("demographics", "state_code", "us_population_demographics"),
            _keys("airports", "ident", "us_airports"),
            _keys("airports", "iata_code", "us_airports by iata_code"),
        ]),
        "quality_orphans": f"WITH {_STAR} " + " UNION ALL ".join([
            _orphans("country", _key("country"), "country", _key("p.country")),
            _orphans("country_of_residence", _key("country_of_residence"), "country",
                     _key("p.country")),
            _orphans("destination_state", "destination_state", "demographics", "p.state_code"),
            _orphans("destination_state airports", "destination_state", "airports", "p.state_code"),
            _orphans("port_of_entry", "port_of_entry", "airports", "p.iata_code"),
            _orphans("arrival_date", "arrival_date", "arrival_time",
                     "p.day % 7 <> 0 AND p.arrival_date"),
        ]),
        "quality_orphan_keys": f"""{fact},{_AIRPORTS}
            SELECT port_of_entry AS key, count(*) AS row_count
            FROM fact ANTI JOIN airports ON port_of_entry = iata_code
            WHERE port_of_entry IS NOT NULL GROUP BY 1""",
        "quality_partitions": f"""{fact}
            SELECT count(arrival_date) AS dated_rows, count(*) FILTER (WHERE misplaced) AS misplaced_rows,
                   count(*) FILTER (WHERE misplaced) = 0 AS passed
            FROM (SELECT arrival_date, arrival_date IS NOT NULL
                         AND (year(arrival_date) IS DISTINCT FROM arrival_year
                              OR month(arrival_date) IS DISTINCT FROM arrival_month) AS misplaced
                  FROM fact)""",
        "quality_shared_coordinates": f"""WITH {_DEMOGRAPHICS}
            SELECT round(latitude, 4) AS latitude, round(longitude, 4) AS longitude,
                   count(*) AS states, min(state_code) AS first_state, max(state_code) AS last_state
            FROM demographics WHERE latitude IS NOT NULL AND longitude IS NOT NULL
            GROUP BY 1, 2 HAVING count(*) > 1""",
        "fact_partitioned_roundtrip": f"{fact} {_TIMEFRAME}",
        "monthly_load": f"""{fact}
            SELECT arrival_year, arrival_month, count(*) AS arrivals, cast(sum(immigration_id) AS bigint) AS id_sum
            FROM fact WHERE {_LOADED} GROUP BY 1, 2""",
        "repeated_ids": f"""{fact}, mistaken AS (
              SELECT DISTINCT CASE WHEN immigration_id % 7 = 0 THEN immigration_id - 1 ELSE immigration_id END AS id
              FROM fact WHERE arrival_month = 12)
            SELECT DISTINCT immigration_id, arrival_year, arrival_month
            FROM fact JOIN mistaken ON immigration_id = id WHERE arrival_month <> 12""",
        "maintained_cube": f"""{fact}
            SELECT travel_mode, visa_category, arrival_year,
                   cast(grouping(travel_mode, visa_category, arrival_year) AS bigint) AS grouping_id,
                   count(*) AS arrivals FROM fact WHERE {_LOADED}
            GROUP BY CUBE (travel_mode, visa_category, arrival_year)""",
        "maintained_timeframe": f"""{fact}, stored AS (SELECT * FROM fact WHERE {_LOADED})
            {_TIMEFRAME.replace('FROM fact', 'FROM stored')}""",
        "lasting_date_ids": f"""{fact}, seen AS (
              SELECT arrival_date, min(CASE WHEN arrival_month <= 6 THEN 1 ELSE 2 END) AS load FROM fact GROUP BY 1)
            SELECT arrival_date, row_number() OVER (ORDER BY load, arrival_date NULLS FIRST) - 1 AS id FROM seen""",
        "lasting_airport_ids": f"""WITH {_AIRPORTS}, ids AS (
              SELECT ident, row_number() OVER (ORDER BY CASE WHEN state_code < 'S3' THEN 1 ELSE 2 END, ident) - 1 AS id
              FROM airports)
            SELECT airports.ident, upper(name) AS name, iata_code, state_code, ids.id
            FROM airports JOIN ids ON airports.ident = ids.ident WHERE NOT state_code < 'S3'""",
        "csv_source_roundtrip": f"WITH {_CODEBOOK},{_CITIES},{_COORDINATES},{_TEMPERATURE},{_AIRPORTS} "
        + " UNION ALL ".join(_column(*c) for c in _CSV_COLUMNS),
        "reconciled_names": f"""WITH a AS (SELECT DISTINCT {_key("p_name || ' of ' || p_brand")} AS k FROM part),
            b AS (SELECT DISTINCT {_key("listed")} AS k FROM (
              SELECT CASE p_size % 5 WHEN 0 THEN replace(p_name, 'i', 'y') || ' of ' || p_brand
                     WHEN 1 THEN upper(p_name) || ' Of the ' || p_brand WHEN 2 THEN p_name || ', ' || p_brand || 'X'
                     WHEN 3 THEN p_name || ' of ' || p_brand ELSE p_type || ' ' || p_name || ' ' || p_brand END AS listed
              FROM part WHERE p_size % 6 <> 0)),
            words AS (
              SELECT 'a' AS side, k, unnest(list_distinct(string_split(k, ' '))) AS word FROM a WHERE k NOT IN (SELECT k FROM b)
              UNION ALL SELECT 'b', k, unnest(list_distinct(string_split(k, ' '))) FROM b WHERE k NOT IN (SELECT k FROM a)),
            rare AS (
              SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY word) AS names FROM words)
              QUALIFY row_number() OVER (PARTITION BY side, k ORDER BY names, word) <= 2),
            pairs AS (
              SELECT DISTINCT x.k AS name_key, y.k AS known_key FROM rare x JOIN rare y ON x.word = y.word AND x.side = 'a' AND y.side = 'b'),
            scored AS (
              SELECT *, 1 - cast(levenshtein(name_key, known_key) AS double) / greatest(length(name_key), length(known_key)) AS score
              FROM pairs),
            likely AS (SELECT * FROM scored WHERE score >= 0.85),
            best AS (
              SELECT *, row_number() OVER (PARTITION BY name_key ORDER BY score DESC, known_key) AS x,
                     row_number() OVER (PARTITION BY known_key ORDER BY score DESC, name_key) AS y FROM likely)
            SELECT name_key, known_key, round(score, 6) AS score FROM best WHERE x = 1 AND y = 1""",
        "csv_quarantine": f"""WITH lines AS (
              SELECT CASE WHEN event_id % 23 = 0 OR event_id % 29 = 0 THEN 'number of fields'
                          WHEN event_id % 19 = 0 AND event_id % 17 = 0 THEN 'unreadable: dt, AverageTemperature'
                          WHEN event_id % 19 = 0 THEN 'unreadable: dt'
                          WHEN event_id % 17 = 0 THEN 'unreadable: AverageTemperature' ELSE 'kept' END AS outcome,
                     CASE WHEN event_id % 19 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d') END || ',' ||
                     CASE WHEN event_id % 17 = 0 THEN 'warm' WHEN event_id % 13 = 0 THEN ''
                          ELSE cast(cast(event_id % 400 AS double) / 8 - 20 AS varchar) END ||
                     CASE WHEN event_id % 23 = 0 THEN '' ELSE ',City ' || event_id || ',' || event_type || ' land' END ||
                     CASE WHEN event_id % 29 = 0 THEN ',more' ELSE '' END AS record
              FROM events)
            SELECT outcome, count(*) AS records, {_sum_of_hashes('record')} AS checksum, count(*) AS with_file
            FROM lines GROUP BY 1""",
        "label_file_roundtrip": f"""WITH {_COUNTRY_LABELS}, country_labels AS (
              SELECT 'countryl' AS format, cast(code AS varchar) AS code,
                     label || CASE WHEN code % 7 = 3 THEN ' ' ELSE '' END AS label FROM labels),
            port_labels AS (
              WITH {_PORT_LABELS}
              SELECT '$portl' AS format, code,
                     label || CASE form WHEN 0 THEN '      ' WHEN 2 THEN '  ' WHEN 8 THEN ' ' ELSE '' END AS label
              FROM labels JOIN ports ON code = 'P' || cast(k AS varchar))
            SELECT * FROM country_labels UNION ALL SELECT * FROM port_labels
            UNION ALL SELECT '$statel', 'S' || cast(n_nationkey AS varchar),
                   n_name || CASE WHEN n_nationkey % 3 = 0 THEN '; STATE' ELSE ' STATE ' END FROM nation""",
        "quality_load": f"""{fact}, audit AS (
              SELECT count(*) AS n, count(*) FILTER (WHERE {kept}) AS kept,
                     {' + '.join(r.rsplit(' AS ', 1)[0] for r in removed)} AS removed FROM arrivals),
            checks AS (
              SELECT 'audit balanced' AS "check", CASE WHEN n = kept + removed THEN 0 ELSE 1 END AS failures FROM audit
              UNION ALL SELECT 'rows kept', CASE WHEN kept > 0 THEN 0 ELSE 1 END FROM audit
              UNION ALL SELECT 'ids unique', count(*) - count(DISTINCT immigration_id) FROM fact
              UNION ALL SELECT 'filed under own month', count(*) FILTER (WHERE arrival_date IS NOT NULL
                  AND (year(arrival_date) IS DISTINCT FROM arrival_year
                       OR month(arrival_date) IS DISTINCT FROM arrival_month)) FROM fact)
            SELECT "check", cast(failures AS bigint) AS failures, failures = 0 AS passed FROM checks""",
        "quality_lookup_conflicts": """
            WITH codes AS (
              SELECT n_nationkey + 4 AS code, r_name || ' ' || n_name || ' ' AS value FROM nation JOIN region ON n_regionkey = r_regionkey
              UNION ALL SELECT c_custkey % 60, CASE WHEN c_custkey % 60 < 30 THEN 'LAND ' || (c_custkey % 60) ELSE c_mktsegment END FROM customer),
            states AS (
              SELECT 'S' || (n_nationkey + 5) AS code, n_name || ' STATE' AS value FROM nation
              UNION ALL SELECT 'S' || (40 + s_nationkey), CASE WHEN s_suppkey % 5 = 0 THEN 'OTHER' ELSE s_nationkey || ' STATE' END FROM supplier),
            places AS (
              SELECT 'S' || (n_nationkey + 2) AS code, CASE WHEN copy = 1 AND n_nationkey % 3 = 0 THEN 'none' ELSE cast(n_nationkey AS varchar) END AS value
              FROM nation, (VALUES (0), (1)) c(copy)),
            found AS (
              SELECT 'country codes' AS lookup, cast(code AS varchar) AS code, value FROM codes
              UNION ALL SELECT 'states', code, value FROM states UNION ALL SELECT 'state coordinates', code, value FROM places),
            per_code AS (SELECT lookup, code, count(DISTINCT value) AS n FROM found GROUP BY 1, 2)
            SELECT lookup, count(*) FILTER (WHERE n > 1) AS conflicting_keys, count(*) FILTER (WHERE n > 1) = 0 AS passed
            FROM per_code GROUP BY 1""",
        # The whole run has no tie-break column to go by: the lowest reading counts.
        "full_pipeline": f"WITH {_STAR} ".replace("reading_no NULLS LAST, ", "") + " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, "
            f"{_sum_of_hashes(' || chr(124) || '.join(_dashed(c) for c in columns))} AS checksum FROM {_TABLE_NAMES[name]}"
            for name, columns in _STORED_COLUMNS.items()
        ),
        "stream_new_files": f"""{fact}
            SELECT arrival_year, arrival_month, country, count(*) AS arrivals, cast(sum(immigration_id) AS bigint) AS id_sum
            FROM fact WHERE immigration_id % 20 <> 0 GROUP BY 1, 2, 3""",
    }
