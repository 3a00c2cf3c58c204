import datetime as dt
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from landfall.operators import quality
from landfall.plans import analytics, pipeline
from landfall.sources import readers
from landfall.sources.paths import Warehouse
from landfall.sources.versions import Store
from landfall.streaming.arrivals import load_new_files
from tests.shapes import CHANGES, arrivals, write_inputs


def contents(tables):
    return {
        name: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
        for name, df in tables.items()
    }


@pytest.mark.parametrize("arrivals_format", ["parquet", "csv"])
def test_two_runs_store_the_same(spark, tmp_path, arrivals_format):
    inputs = write_inputs(spark, tmp_path / "in", arrivals_format=arrivals_format)
    warehouse = Warehouse(str(tmp_path / "out"))
    first = pipeline.run_pipeline(spark, inputs, warehouse)
    before = contents(first.tables)
    second = pipeline.run_pipeline(spark, inputs, warehouse, rebalance=False)
    assert contents(second.tables) == before
    assert {n: len(rows) for n, rows in before.items()} == {
        "immigration_fact": 10, "arrival_time": 4, "country": 2,
        "us_population_demographics": 4, "us_airports": 4,
    }
    audit = second.audit.first()
    assert (audit["total_rows"], audit["kept_rows"], audit["balanced"]) == (12, 10, True)
    assert audit["undated_arrdate"] == 2

    assert sorted(map(tuple, second.sources.collect())) == [
        ("airports", 6, 4, 3), ("demographics", 6, 6, 4), ("temperature", 6, 4, 2),
    ]

    keys = {r["table_name"]: r for r in pipeline.key_checks(second.tables).collect()}
    assert keys["immigration_fact"]["surplus_rows"] == 1
    assert keys["us_airports by iata_code"]["repeated_keys"] == 1
    assert keys["arrival_time"]["passed"] and keys["us_airports"]["passed"]
    orphans = {r["reference"]: r for r in pipeline.reference_checks(second.tables).collect()}
    assert len(orphans) == 6
    assert orphans["destination_state"]["orphan_keys"] == 2
    assert orphans["destination_state"]["orphan_rows"] == 2
    assert orphans["destination_state airports"]["orphan_keys"] == 1
    assert orphans["country"]["passed"] and orphans["country_of_residence"]["passed"]
    assert orphans["port_of_entry"]["passed"] and orphans["arrival_date"]["passed"]


def test_later_month_keeps_the_earlier(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path / "out"))
    april = arrivals(spark, {}, {}, {"cicid": 9.0})
    may = arrivals(spark, *[{"cicid": 20.0, "i94mon": 5.0, "arrdate": 20580.0, "depdate": 20590.0}])
    for n, month in enumerate((april, may)):
        run = pipeline.run_pipeline(spark, write_inputs(spark, tmp_path / f"in{n}", month), warehouse)
    fact = run.tables["immigration_fact"]
    assert sorted(r[0] for r in fact.select("immigration_id").collect()) == [1, 2, 9, 20]
    assert run.tables["arrival_time"].count() == 2
    # Reloading May replaces May only.
    again = arrivals(spark, *[{"cicid": 30.0, "i94mon": 5.0, "arrdate": 20580.0}])
    run = pipeline.run_pipeline(spark, write_inputs(spark, tmp_path / "in2", again), warehouse)
    ids = run.tables["immigration_fact"].select("immigration_id").collect()
    assert sorted(r[0] for r in ids) == [1, 2, 9, 30]
    run = pipeline.run_pipeline(
        spark, write_inputs(spark, tmp_path / "in3", may), warehouse, replace_all=True
    )
    assert [r[0] for r in run.tables["immigration_fact"].select("immigration_id").collect()] == [20]


def test_strict_run_raises_on_an_empty_table(spark, tmp_path):
    inputs = write_inputs(spark, tmp_path / "in", arrivals(spark, {"gender": None}))
    run = pipeline.run_pipeline(spark, inputs, Warehouse(str(tmp_path / "a")))
    assert {r["table_name"] for r in run.nonempty.where("not passed").collect()} == {
        "immigration_fact", "arrival_time",
    }
    with pytest.raises(quality.DataQualityError, match="rows kept"):
        pipeline.run_pipeline(spark, inputs, Warehouse(str(tmp_path / "b")), strict=True)
    assert not [p for p in (tmp_path / "b").rglob("*") if p.is_file() and not p.name.startswith(".")]


MAY = {"i94mon": 5.0, "arrdate": 20580.0, "depdate": 20590.0}


@pytest.mark.parametrize("rows, failed", [
    ([{**MAY, "gender": None}], "rows kept"),
    ([MAY, {**MAY, "cicid": 1.0}], "ids unique"),
    ([MAY, {**MAY, "i94mon": None}], "filed under own month"),
])
def test_a_failed_strict_load_leaves_the_warehouse_as_it_was(spark, tmp_path, rows, failed):
    warehouse = Warehouse(str(tmp_path / "out"))
    both = arrivals(spark, {}, MAY)
    run = pipeline.run_pipeline(spark, write_inputs(spark, tmp_path / "in", both), warehouse, strict=True)
    before = contents(run.tables)
    bad = write_inputs(spark, tmp_path / "bad", arrivals(spark, *rows))
    with pytest.raises(quality.DataQualityError, match=failed):
        pipeline.run_pipeline(spark, bad, warehouse, strict=True)
    assert contents(pipeline.read_tables(spark, warehouse)) == before


def test_a_month_without_a_usable_record_is_cleared(spark, tmp_path):
    warehouse = Warehouse(str(tmp_path / "out"))
    both = arrivals(spark, {}, MAY, {"i94mon": None})
    pipeline.run_pipeline(spark, write_inputs(spark, tmp_path / "in", both), warehouse)
    withdrawn = arrivals(spark, {**MAY, "gender": None}, {"i94mon": None, "gender": None})
    run = pipeline.run_pipeline(spark, write_inputs(spark, tmp_path / "in2", withdrawn), warehouse)
    assert [r[0] for r in run.tables["immigration_fact"].select("immigration_id").collect()] == [1]
    ranges = Store(spark, warehouse).ranges().collect()
    assert [(r["arrival_year"], r["arrival_month"]) for r in ranges] == [(2016, 4)]


def stored_fact(spark, root, rows, **how):
    """A store with one load of fact rows."""
    store = Store(spark, Warehouse(str(root)))
    with store.load() as load:
        load.write_fact(rows, **how)
        load.publish()
    return store


def test_misfiled_rows_are_found_in_their_timeframe(spark, tmp_path):
    from landfall.operators.fact import build_fact

    rows = arrivals(spark, {}, {"i94mon": 9.0}, {"i94mon": None}, MAY, {"i94yr": None})
    store = stored_fact(spark, tmp_path / "fact", build_fact(rows, None))
    april = (dt.date(2016, 4, 1), dt.date(2016, 4, 30))
    stored, ranges = store.table("immigration_fact"), store.ranges()
    assert tuple(analytics.arrivals_in_timeframe(stored, *april, ranges).first()) == (2016, 4, 4)
    assert tuple(quality.partition_report(stored).first()) == (5, 3, False)
    assert Store(spark, Warehouse(str(tmp_path / "none"))).ranges().collect() == []


def test_a_run_leaves_no_scratch_behind(spark, tmp_path):
    from landfall.operators.keys import scratch_root

    root = Path(scratch_root(spark).removeprefix("file:"))
    before = set(root.iterdir())
    pipeline.run_pipeline(spark, write_inputs(spark, tmp_path / "in"), Warehouse(str(tmp_path / "out")))
    assert not [p for p in set(root.iterdir()) - before if p.name.startswith("landfall-")]


def test_label_file_as_code_book(spark, tmp_path):
    inputs = write_inputs(spark, tmp_path / "in")
    labels = tmp_path / "labels.txt"
    labels.write_text("  value lands\n 582 = 'NORTHLAND'\n 236 = 'INVALID: NONE'\n 403 = 'TWIN SUNS ' ;\n")
    inputs = replace(inputs, country_codes=str(labels), country_block="lands")
    fact = pipeline.run_pipeline(spark, inputs, Warehouse(str(tmp_path / "out"))).tables["immigration_fact"]
    assert {r[0] for r in fact.select("country").distinct().collect()} == {"Northland", "Twin Suns"}
    assert fact.where("country_of_residence is not null").count() == 0


def test_doubled_quotes_and_line_ends(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('ident,name,iso_country\nK1,"Joe ""Ace"" Field, Main",US\nK2,"two\nlines",US\n')
    rows = readers.read_airports(spark, str(path), multi_line=True).collect()
    assert [(r["name"], r["iso_country"]) for r in rows] == [('Joe "Ace" Field, Main', "US"), ("two\nlines", "US")]


def test_another_column_order_fails_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("dt,AverageTemperature,City,Country\n1850-01-01,1.5,A,B\n")
    (tmp_path / "b.csv").write_text("Country,dt,AverageTemperature,City\nB,1850-01-01,2.5,A\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        readers.read_temperature(spark, str(tmp_path)).collect()


def test_unreadable_values_are_counted(spark, tmp_path):
    from landfall import schemas

    path = tmp_path / "t.csv"
    path.write_text("dt,AverageTemperature,City,Country\n1850-01-01,warm,A,B\nsoon,,A,B\n1850-01-02,2,A,B\n")
    report = quality.unreadable_report(readers.read_csv_text(spark, str(path)), schemas.TEMPERATURE_RAW)
    assert {r["column_name"]: (r["filled"], r["unreadable"], r["passed"]) for r in report.collect()} == {
        "dt": (3, 1, False), "AverageTemperature": (2, 1, False), "City": (3, 0, True), "Country": (3, 0, True),
    }


def test_quarantine_keeps_bad_records_apart(spark, tmp_path):
    inputs = write_inputs(spark, tmp_path / "in")
    (tmp_path / "t.csv").write_text(
        'dt,AverageTemperature,City,Country\n1850-01-01,1.5,A,Oldland\n1850-01-01,warm,B,Oldland\n'
        'soon,x,C,Oldland\n1850-01-02,2.5\n1850-01-03,3.5,"D, d",Oldland\n1850-01-04,4,E,Oldland,more\n,,,\n'
    )
    inputs = replace(inputs, temperature=str(tmp_path / "t.csv"))
    warehouse = Warehouse(str(tmp_path / "out"))
    run = pipeline.run_pipeline(spark, inputs, warehouse, quarantine=True)
    assert {r["country"]: r["average_temperature"] for r in run.tables["country"].where("country is not null").collect()} == {"Oldland": 2.5}
    bad = [r for r in Store(spark, warehouse).table("quarantine").collect() if r["source"] == "temperature"]
    assert all(r["file"].endswith("/t.csv") for r in bad)
    assert sorted((r["record"], r["reason"]) for r in bad) == [
        ("1850-01-01,warm,B,Oldland", "unreadable: AverageTemperature"), ("1850-01-02,2.5", "number of fields"),
        ("1850-01-04,4,E,Oldland,more", "number of fields"), ("soon,x,C,Oldland", "unreadable: dt, AverageTemperature"),
    ]
    # Without it the next version holds the same tables, and the records' readable parts.
    again = pipeline.run_pipeline(spark, inputs, warehouse)
    assert again.tables["country"].where("country = 'Oldland'").first()["average_temperature"] > 2.5


def test_lookup_conflicts(spark):
    codes = spark.createDataFrame([(1, "A"), (1, "B"), (2, "C"), (2, "C")], "code int, description string")
    places = spark.createDataFrame([("X", 1.0, 2.0)], "State string, Latitude double, Longitude double")
    states = spark.createDataFrame([("X", "x"), ("X", None)], "code string, label string")
    report = {r["lookup"]: r["conflicting_keys"] for r in pipeline.lookup_checks(codes, places, states).collect()}
    assert report == {"country codes": 1, "state coordinates": 0, "states": 1}


def test_misplaced_rows_are_reported(spark, tmp_path):
    from tests.test_fact import codebook
    from landfall.operators.fact import build_fact

    fact = build_fact(arrivals(spark, {}, {"i94mon": 5.0}, {"arrdate": 0.0}), codebook(spark))
    assert tuple(quality.partition_report(fact).first()) == (2, 1, False)


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("Foreign-born;State Code;number of veterans;Total Population\n7;NY;x;100\n")
    row = readers.read_demographics(spark, str(path)).first()
    assert row["Foreign-born"] == 7 and row["Total Population"] == 100
    assert row["Number of Veterans"] is None


def test_cube_totals(spark, tmp_path):
    from tests.test_fact import codebook
    from landfall.operators.fact import build_fact

    fact = build_fact(arrivals(spark, *CHANGES), codebook(spark))
    cube = analytics.arrivals_cube(fact)
    totals = cube.groupBy("grouping_id").agg(F.sum("arrivals")).collect()
    assert len(totals) == 8 and {r[1] for r in totals} == {fact.count()}


def test_stream_merges_each_file_once(spark, tmp_path):
    from tests.test_fact import codebook

    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    store = Store(spark, Warehouse(str(tmp_path / "out")))
    deliveries = [
        [{"cicid": 4.0}, {"cicid": 5.0}, {"cicid": None}, {"gender": None}], [{**MAY, "cicid": 5.0}], None,
        # a correction, a withdrawal, a new record and one without an id
        [{"cicid": 4.0, "visatype": "ZZ"}, {"cicid": 5.0, "gender": None}, {"cicid": 6.0}, {"cicid": None}],
    ]
    wanted = [[(4, 4), (4, 5), (4, None)], [(4, 4), (4, 5), (4, None), (5, 5)], None, [(4, 4), (4, 6), (4, None), (4, None), (5, 5)]]
    found = []
    for rows, expected in zip(deliveries, wanted):
        if rows:
            arrivals(spark, *rows).coalesce(1).write.mode("append").parquet(source)
        before = store.version().number
        load_new_files(spark, source, codebook(spark), store, state, max_files=1).awaitTermination()
        if rows is None:
            assert store.version().number == before
        found = expected or found
        stored = store.table("immigration_fact").collect()
        assert sorted(((r["arrival_month"], r["immigration_id"]) for r in stored), key=repr) == sorted(found, key=repr)
    assert {r["visatype"] for r in stored if r["immigration_id"] == 4} == {"ZZ"}
    assert {r["country"] for r in stored} == {"Northland"}
    assert store.table("arrival_time").count() == 2


def test_a_batch_tried_again_counts_once(spark, tmp_path):
    from landfall.streaming.arrivals import merge_batch
    from tests.test_fact import codebook

    store = Store(spark, Warehouse(str(tmp_path / "out")))
    batch = arrivals(spark, {"cicid": None}, {"cicid": 2.0})
    assert merge_batch(store, batch, codebook(spark), "s", 0)
    assert not merge_batch(store, batch, codebook(spark), "s", 0)
    assert store.table("immigration_fact").count() == 2
    # A full load in between keeps what is known of the stream; another stream has its own numbers.
    pipeline.run_pipeline(spark, write_inputs(spark, tmp_path / "in", arrivals(spark, MAY)), store.warehouse)
    assert not merge_batch(store, batch, codebook(spark), "s", 0)
    assert merge_batch(store, batch, codebook(spark), "t", 0) and merge_batch(store, batch, codebook(spark), "s", 1)
    assert store.table("immigration_fact").where("arrival_month = 4").count() == 4


@pytest.mark.parametrize("bound, joined", [(6, "BroadcastHashJoin"), (5, "SortMergeJoin")])
def test_a_large_batch_is_not_broadcast(spark, tmp_path, monkeypatch, bound, joined):
    from landfall.sources.versions import Load
    from landfall.streaming import arrivals as streaming
    from tests.test_fact import codebook

    plans, write_fact = [], Load.write_fact

    def noted(load, fact):
        plans.append(fact._jdf.queryExecution().executedPlan().toString())
        write_fact(load, fact)

    monkeypatch.setattr(Load, "write_fact", noted)
    monkeypatch.setattr(streaming, "MAX_BROADCAST_ROWS", bound, raising=False)
    store = Store(spark, Warehouse(str(tmp_path)))
    stored = arrivals(spark, *[{"cicid": float(i)} for i in range(8)], {"cicid": None}, {"cicid": None}, {**MAY, "cicid": 1.0})
    # Six keys: copies of an id count once, and a missing id is one key a month.
    batch = arrivals(
        spark, *[{"cicid": 0.0, "visatype": "ZZ"}] * 3, {"cicid": 1.0, "gender": None}, {"cicid": 2.0}, {"cicid": None}, {"cicid": None},
        {**MAY, "cicid": 2.0}, {**MAY, "i94mon": None, "cicid": 1.0},
    )
    assert streaming.merge_batch(store, stored, codebook(spark), "s", 0)
    assert streaming.merge_batch(store, batch, codebook(spark), "s", 1)
    assert [joined in line for line in plans[-1].splitlines() if "LeftAnti" in line] == [True]
    found = sorted(((r["arrival_month"], r["immigration_id"], r["visatype"]) for r in store.table("immigration_fact").collect()), key=repr)
    april = [(4, 0, "ZZ")] * 3 + [(4, i, "B1") for i in range(2, 8)] + [(4, None, "B1")] * 4
    assert found == sorted([*april, (5, 1, "B1"), (5, 2, "B1"), (None, 1, "B1")], key=repr)


def test_rebalanced_write_equals_plain_write(spark, tmp_path):
    from tests.test_fact import codebook
    from landfall.operators.fact import build_fact

    fact = build_fact(arrivals(spark, *CHANGES), codebook(spark))
    tables = {}
    for rebalance in (False, True):
        store = stored_fact(spark, tmp_path / str(rebalance), fact, rebalance=rebalance)
        tables[rebalance] = sorted(map(repr, store.table("immigration_fact").collect()))
    assert tables[True] == tables[False]
