"""Physical plans: what must and must not be in them."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from landfall.operators import lookup
from landfall.plans import analytics, catalog
from landfall.sources.paths import Warehouse
from landfall.sources.versions import Store

SF_DIR = "/root/testdata/sf0.001"
# Queries that are read back from files hold only the last step in their plan.
LAZY = sorted(set(catalog.QUERIES) - {"full_pipeline", "stream_new_files", "repeated_ids", "maintained_timeframe", "lasting_date_ids"})


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairs(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_fact_is_never_shuffled(spark):
    plan = plan_of(catalog.fact(spark, SF_DIR))
    assert plan.count("BroadcastHashJoin") >= 3
    # Small files need no copy and no measuring job.
    assert "landfall-" not in plan_of(catalog.fact(spark, SF_DIR), "formatted")
    # The few names are grouped by code before they are broadcast; nothing else moves.
    exchanges = re.findall(r"Exchange (hashpartitioning\(\w+|SinglePartition|rangepart\w+)", plan)
    assert set(exchanges) <= {"hashpartitioning(code"}


def jobs_of(spark, build):
    """The result of ``build`` and how many Spark jobs it started."""
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{id(build)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        return build(), len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("query", [catalog.q5_top_mode, catalog.q9_cube])
def test_nothing_is_measured_where_no_name_is_asked_for(spark, query):
    df, jobs = jobs_of(spark, lambda: query(spark, SF_DIR))
    # What starts a job here is reading the schema of the two tables.
    assert jobs <= 2
    plan = plan_of(df)
    assert "nation" not in plan and "LeftOuter" not in plan


def test_names_are_broadcast_once_for_both_roles(spark):
    df = catalog.fact(spark, SF_DIR)
    df.collect()
    assert plan_of(df).split("Initial Plan")[0].count("ReusedExchange") >= 1


def test_lookups_of_unknown_size_are_written_and_measured(spark, monkeypatch):
    monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", 1000)
    plan = plan_of(catalog.fact(spark, SF_DIR), "formatted")
    assert len(set(re.findall(r"landfall-\w+", plan))) == 1


def test_readings_are_scanned_once(spark):
    plan = plan_of(catalog.star_join_country(spark, SF_DIR), "formatted")
    assert "events.parquet" not in plan


def test_counts_are_ranked_without_a_sort(spark):
    plan = plan_of(catalog.q5_top_mode(spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("name", ["q9_cube", "q9_rollup", "q9_grouping_sets"])
def test_cube_expands_counts_only(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert re.search(r"Expand .*\n.*HashAggregate\(.*\n.*Exchange hashpartitioning", plan)


def test_numbering_moves_only_counts_to_one_task(spark):
    plan = plan_of(catalog.airports_dim(spark, SF_DIR))
    single = plan.count("SinglePartition")
    assert single == 1
    assert re.search(r"SinglePartition.*\n.*HashAggregate\(keys=\[_range", plan)


def test_months_are_pruned_and_dates_pushed_down(spark, tmp_path):
    store = Store(spark, Warehouse(str(tmp_path)))
    with store.load() as load:
        load.write_fact(catalog.fact(spark, SF_DIR))
        load.publish()
    plan = plan_of(
        analytics.arrivals_in_timeframe(store.table("immigration_fact"), *catalog.TIMEFRAME, store.ranges()), "formatted"
    )
    assert re.search(r"PartitionFilters: \[.*arrival_year.*arrival_month", plan)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(arrival_date", plan)
    assert re.search(r"ReadSchema: struct<arrival_date:date>", plan)


def test_hot_key_of_a_large_lookup_is_split(spark):
    """A third of the rows share a key and another third have none."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 300_000, 1, 12).selectExpr(
            "id", "case id % 3 when 0 then 7 when 1 then id end as k", "uuid() as filler"
        )
        names = (
            spark.range(300_000).selectExpr("id as code").groupBy("code")
            .agg(F.count("*").alias("n"))
        )
        joined = lookup.lookup_join(rows, names, "k", "code", small=False)
        out = joined.select("id", "n", "filler")
        assert out.agg(F.count("n"), F.count("*")).collect()[0][:] == (200_000, 300_000)
        out.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(out)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["destination_state", "arrivals"] and df.count() == 10
