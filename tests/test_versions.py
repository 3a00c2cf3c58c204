"""Loads become visible as a whole, are taken back when they fail, and leave open versions readable."""

import json

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from landfall.operators import keys
from landfall.operators.fact import build_fact
from landfall.plans import analytics, pipeline
from landfall.sources import versions
from landfall.sources.files import Files
from landfall.sources.paths import Warehouse
from landfall.sources.versions import LoadRefused, Store
from tests.shapes import arrivals, write_inputs
from tests.test_plans import plan_of

MAY = {"i94mon": 5.0, "arrdate": 20580.0, "depdate": 20590.0}


def facts(spark, *changes):
    return build_fact(arrivals(spark, *changes), None)


def load(store, rows, keep=2, **more):
    with store.load(keep=keep, **more) as making:
        making.write_fact(rows)
        pipeline.write_date_dimension(making)
        making.write_table("country", store.spark.createDataFrame([("A", 1.0, making.base.number)], "country string, average_temperature double, id long"))
        return making.publish()


def seen(store, version=None):
    names = ("immigration_fact", "daily_arrivals", "arrival_time", "country")
    return {n: sorted(map(repr, store.table(n, version).collect())) for n in names}


def data_files(root):
    return {str(p.relative_to(root)) for p in root.rglob("*.parquet") if p.is_file()}


class Stopped(Exception):
    pass


def stop_at(monkeypatch, n):
    """Let the n-th write to files, counted from 0, fail. Returns how many were begun."""
    begun = [0]

    def counted(write):
        def run(*args, **more):
            begun[0] += 1
            if begun[0] == n + 1:
                raise Stopped
            return write(*args, **more)
        return run

    monkeypatch.setattr(DataFrameWriter, "parquet", counted(DataFrameWriter.parquet))
    for name in ("write", "rename"):
        monkeypatch.setattr(Files, name, counted(getattr(Files, name)))
    return begun


@pytest.mark.parametrize("killed", [False, True])
def test_a_load_that_stops_anywhere_leaves_the_old_star(spark, tmp_path, monkeypatch, killed):
    store = Store(spark, Warehouse(str(tmp_path)))
    load(store, facts(spark, {}, {"cicid": 2.0}, MAY))
    before, files = seen(store), data_files(tmp_path)
    new = facts(spark, {**MAY, "cicid": 7.0}, {"i94mon": 6.0, "arrdate": 20610.0})
    n = 0
    while True:
        with monkeypatch.context() as patch:
            stop_at(patch, n)
            if killed:  # nothing is tidied up by the load itself
                patch.setattr(versions.Load, "__exit__", lambda *args: None)
            try:
                load(store, new)
                break
            except Stopped:
                pass
        assert seen(store) == before
        if not killed:
            assert data_files(tmp_path) == files
        n += 1
    # marker, fact, counts, dates and their ids with a scratch table, country, pointer and its rename
    assert n >= 8
    assert store.version().number == 2 and not store.recover()
    ids = store.table("immigration_fact").select("immigration_id").collect()
    assert sorted(r[0] for r in ids) == [1, 2, 2, 7]
    # What the stopped loads left is gone: only folders of the two kept versions remain.
    named = {v.load for v in (store.version(1), store.version(2))}
    assert {p.name.removeprefix("load=") for p in tmp_path.rglob("load=*")} == named
    assert not [p for p in (tmp_path / "_versions").iterdir() if p.name.startswith("begun")]


def test_readers_keep_their_version_until_it_expires(spark, tmp_path):
    store = Store(spark, Warehouse(str(tmp_path)))
    first = load(store, facts(spark, {}, MAY))
    before, opened = seen(store), store.table("immigration_fact")
    load(store, facts(spark, {**MAY, "cicid": 5.0}))
    assert seen(store, first) == before and opened.count() == 2
    assert store.numbers() == [1, 2]
    load(store, facts(spark, {**MAY, "cicid": 6.0}))
    assert store.numbers() == [2, 3]
    # April is still the first load's, though its version is gone; May of the first load is removed.
    assert sorted(r[0] for r in store.table("immigration_fact").select("immigration_id").collect()) == [1, 6]
    months = {p.name for p in tmp_path.rglob(f"load={first.load}/*/*")}
    assert months == {"arrival_month=4"}


def test_the_later_of_two_loads_is_refused(spark, tmp_path):
    store = Store(spark, Warehouse(str(tmp_path)))
    load(store, facts(spark, {}))
    with pytest.raises(LoadRefused):
        with store.load() as slow:
            slow.write_fact(facts(spark, {"cicid": 8.0}))
            store.files.write(store.at(2), store.version().as_text().replace('"number": 1', '"number": 2'))
            slow.publish()
    assert [r[0] for r in store.table("immigration_fact").select("immigration_id").collect()] == [1]
    assert not list(tmp_path.rglob(f"load={slow.id}"))


def test_reports_skip_row_groups_of_a_month(spark, tmp_path):
    """Q8 filters on the visa category, and reports on one state or port find theirs in few row groups."""
    import pyarrow.parquet as pq

    rows = spark.range(0, 60_000, 1, 4).selectExpr(
        "id as immigration_id", "2016 as arrival_year", "4 as arrival_month", "concat('P', id * 7 % 50) as port_of_entry",
        "concat('S', id * 11 % 30) as destination_state", "element_at(array('Business', 'Pleasure', 'Student'), 1 + cast(id % 3 as int)) as visa_category",
        "'Air' as travel_mode", "date'2016-04-01' as arrival_date",
    )
    block = spark.conf.get("parquet.block.size", None)
    spark.conf.set("parquet.block.size", str(16 * 1024))
    try:
        store = Store(spark, Warehouse(str(tmp_path)))
        load(store, rows)
    finally:
        spark.conf.unset("parquet.block.size") if block is None else spark.conf.set("parquet.block.size", block)
    fact = store.table("immigration_fact")

    def groups_with(column, value):
        found = total = 0
        for file in tmp_path.glob("immigration/immigration.parquet/**/*.parquet"):
            meta = pq.ParquetFile(file).metadata
            at = meta.schema.names.index(column)
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                total += 1
                found += stats.min <= value <= stats.max
        return found, total

    business, total = groups_with("visa_category", "Business")
    assert total >= 6 and business <= total // 2 + 1
    state, _ = groups_with("destination_state", "S7")
    assert state < total
    assert fact.where("visa_category = 'Business'").count() == 20_000


def test_only_covered_months_are_replaced(spark, tmp_path):
    store = Store(spark, Warehouse(str(tmp_path)))
    load(store, facts(spark, {}, MAY, {"i94mon": None}, {"i94yr": None, "i94mon": None}))
    with store.load() as making:
        making.write_fact(facts(spark, {**MAY, "cicid": 9.0}))
        making.covers([(None, None), (2016, 12)])
        making.publish()
    assert {(m.month, m.arrivals) for m in store.version().months} == {((2016, 4), 1), ((2016, 5), 1), ((2016, None), 1)}
    load(store, facts(spark, MAY).limit(0), replace_all=True)
    assert store.table("immigration_fact").collect() == [] and store.ranges().collect() == []
    assert analytics.arrivals_cube(store.table("daily_arrivals")).where("grouping_id = 7").collect() == []


def test_stored_counts_answer_without_the_fact(spark, tmp_path):
    store = Store(spark, Warehouse(str(tmp_path)))
    rows = [{}, {"i94mode": 2.0}, {"i94visa": 3.0}, MAY, {"i94mode": None}, {"arrdate": 0.0}]
    load(store, facts(spark, *rows))
    load(store, facts(spark, {**MAY, "i94mode": 3.0}, MAY))
    daily, fact = store.table("daily_arrivals"), store.table("immigration_fact")
    for report in (analytics.arrivals_cube, analytics.arrivals_rollup, analytics.arrivals_grouping_sets):
        kept = report(daily)
        assert sorted(map(repr, kept.collect())) == sorted(map(repr, report(fact).collect()))
        assert "daily_arrivals" in plan_of(kept, "formatted") and "immigration.parquet" not in plan_of(kept, "formatted")


def test_arrivals_are_read_once(spark, tmp_path):
    inputs = write_inputs(spark, tmp_path / "in")
    tracker = spark._jsc.sc().listenerBus()
    status = spark._jsparkSession.sharedState().statusStore()
    before = status.executionsCount()
    pipeline.run_pipeline(spark, inputs, Warehouse(str(tmp_path / "out")))
    tracker.waitUntilEmpty(30_000)
    runs = status.executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(before, runs.size())]
    scans = [p for p in plans if "CollectMetrics" in p and f"{tmp_path}/in/arrivals" in p]
    assert len(scans) == 1
    # Everything else that ran did not touch the arrivals.
    assert sum(f"{tmp_path}/in/arrivals" in p for p in plans) == 1


def test_a_doubtful_audit_is_taken_again(spark, tmp_path):
    from landfall.operators.clean import Audited, clean_arrivals, null_audit

    raw = arrivals(spark, {}, MAY, {"gender": None})
    audited = Audited(raw)
    clean_arrivals(audited.rows).write.parquet(str(tmp_path / "x"))
    audit, months = audited.result(2)
    assert sorted(months) == [(2016, 4), (2016, 5)]
    assert audit.collect() == null_audit(raw).collect()
    # As if a repeated task had been counted twice.
    audited._seen = type("Seen", (), {"get": {"kept_rows": 4, "months": []}})()
    assert audited.result(2)[0].collect() == null_audit(raw).collect()


def test_ids_last(spark, tmp_path):
    frame = lambda *names: spark.createDataFrame([(n, 1.0) for n in names], "country string, average_temperature double")
    store = Store(spark, Warehouse(str(tmp_path)))
    wanted = [
        (("D", "B", None), {None: 0, "B": 1, "D": 2}), (("A", "D"), {"D": 2, "A": 3}),
        (("A", "D", "B"), {"B": 1, "D": 2, "A": 3}), ((None, "C", "Z", "A"), {None: 0, "A": 3, "C": 4, "Z": 5}),
    ]
    for names, ids in wanted:
        with store.load() as making:
            pipeline.write_dimension(making, "country", frame(*names), "country")
            making.publish()
        assert {r["country"]: r["id"] for r in store.table("country").collect()} == ids
    every = sorted(r["id"] for r in store.table("country_ids").collect())
    assert every == list(range(6))
    # A load without a new key writes no new ids.
    before = store.version().tables["country_ids"]
    with store.load() as making:
        pipeline.write_dimension(making, "country", frame("A"), "country")
        assert making.publish().tables["country_ids"] == before
    assert keys.lasting_ids(frame("A"), store.table("country_ids"), "country") is None


def test_repeated_idents_are_told_apart(spark, tmp_path):
    store = Store(spark, Warehouse(str(tmp_path)))
    schema = "ident string, name string, iata_code string, state_code string, latitude double, longitude double"
    from landfall.operators import dims

    rows = [("K", "b", "X", "S", 1.0, 2.0), ("K", "a", "X", "S", 1.0, 2.0), ("J", "j", "Y", None, None, None), ("K", "a", "X", "S", 1.0, 2.0)]
    for n in (3, 4):
        with store.load() as making:
            pipeline.write_dimension(making, "us_airports", dims.occurrences(spark.createDataFrame(rows[:n], schema)), "ident", "occurrence")
            making.publish()
        found = sorted((r["id"], r["ident"], r["name"]) for r in store.table("us_airports").collect())
        assert found == [(0, "J", "j"), (1, "K", "a"), (2, "K", "b")] if n == 3 else [(0, "J", "j"), (1, "K", "a"), (2, "K", "a"), (3, "K", "b")]


def test_versions_are_plain_text(spark, tmp_path):
    store = Store(spark, Warehouse(str(tmp_path)))
    assert store.version().number == 0 and store.numbers() == []
    version = load(store, facts(spark, {}))
    text = json.loads((tmp_path / "_versions" / "000000000001.json").read_text())
    assert text["number"] == 1 and text["months"][0]["arrivals"] == 1
    assert text["months"][0]["first_date"] == str(store.ranges(version).first()["first_date"])
    assert versions.Version.of(version.as_text()) == version
    assert store.table("immigration_fact").agg(F.count("*")).first()[0] == 1


def loaded(store, rows, filters=True):
    with store.load(keep=9) as making:
        making.write_fact(rows)
        if filters:
            making.write_id_filters()
        making.publish()


def test_ids_repeated_in_another_month_are_found_without_reading_the_others(spark, tmp_path):
    store = Store(spark, Warehouse(str(tmp_path)))
    june = {"i94mon": 6.0, "arrdate": 20610.0}
    loaded(store, facts(spark, *[{"cicid": float(i)} for i in range(50)], {"cicid": None}))
    loaded(store, facts(spark, *[{**june, "cicid": float(i)} for i in range(100, 150)], {**june, "cicid": None}))
    with store.load() as making:
        making.write_fact(facts(spark, {**MAY, "cicid": 7.0}, {**MAY, "cicid": 7.0}, {**MAY, "cicid": 500.0}, {**MAY, "cicid": None}))
        found = making.repeated_ids()
        assert [tuple(r) for r in found.collect()] == [(7, 2016, 4)]
        plan = plan_of(found, "formatted")
        read = [line for line in plan.splitlines() if "Location:" in line and "immigration.parquet" in line]
        assert read and all("arrival_month=4" in line and "arrival_month=6" not in line for line in read), read
        making.publish()
    # Months stored without filters are read, and a reloaded month does not count against itself.
    loaded(store, facts(spark, {**june, "cicid": 600.0}), filters=False)
    with store.load() as making:
        making.write_fact(facts(spark, *[{"cicid": i} for i in (1.0, 600.0, 500.0, 3.0)]))
        assert sorted(map(tuple, making.repeated_ids().collect())) == [(500, 2016, 5), (600, 2016, 6)]
    with store.load() as making:
        making.write_fact(facts(spark, {**MAY, "cicid": 500.0}).limit(0))
        assert making.repeated_ids().collect() == []


def test_a_strict_run_refuses_ids_of_another_month(spark, tmp_path):
    from landfall.operators import quality

    warehouse = Warehouse(str(tmp_path / "out"))
    pipeline.run_pipeline(spark, write_inputs(spark, tmp_path / "a", arrivals(spark, {}, {"cicid": 2.0})), warehouse, strict=True)
    again = write_inputs(spark, tmp_path / "b", arrivals(spark, MAY, {**MAY, "cicid": 2.0}, {**MAY, "cicid": 3.0}))
    with pytest.raises(quality.DataQualityError, match="ids in no other month.*2"):
        pipeline.run_pipeline(spark, again, warehouse, strict=True)
    assert Store(spark, warehouse).numbers() == [1]


def test_months_of_unlike_size_have_unlike_parts(spark, tmp_path, monkeypatch):
    from landfall.operators import id_filters

    assert [id_filters.part_bits(n) for n in (0, 1, 1 << 16, (1 << 16) + 1, 1 << 18, 1 << 50)] == [0, 0, 0, 1, 2, 14]
    monkeypatch.setattr(id_filters, "_PART_IDS", 8)
    store = Store(spark, Warehouse(str(tmp_path)))
    loaded(store, facts(spark, *[{"cicid": float(i)} for i in range(100)], {**MAY, "cicid": 200.0}))
    bits = store.table("id_filters").select("part_bits").distinct().collect()
    assert sorted(r[0] for r in bits) == [0, 4]
    with store.load() as making:
        making.write_fact(facts(spark, *[{"i94mon": 6.0, "arrdate": 20610.0, "cicid": float(i)} for i in range(90, 210)]))
        found = {r[0] for r in making.repeated_ids().select("immigration_id").collect()}
    assert found == {*range(90, 100), 200}


def test_filters_hold_their_ids_and_few_others():
    import numpy as np

    from landfall.operators import id_filters

    rng = np.random.default_rng(1)
    inside, outside = rng.integers(0, 2**63, (2, 50_000)).astype(np.uint64) * np.uint64(2)
    bits = id_filters.filter_bits(inside)
    assert len(bits) == 150_000
    assert id_filters.may_hold(bits, inside).all()
    assert id_filters.may_hold(bits, outside).mean() < 0.001
    assert id_filters.may_hold(id_filters.filter_bits(inside[:0]), outside[:3]).tolist() == [False] * 3
