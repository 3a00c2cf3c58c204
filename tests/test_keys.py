import random

import pytest

from landfall.operators.keys import dense_id


def test_ids_follow_key_order(spark):
    keys = [None, *[f"k{n}" for n in range(2000)]]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    expected = sorted(keys, key=lambda k: (k is not None, k or ""))
    numbered = dense_id(df, "k")
    assert numbered.dtypes == [("k", "string"), ("id", "bigint")]
    assert [r["k"] for r in sorted(numbered.collect(), key=lambda r: r["id"])] == expected
    assert sorted(r["id"] for r in numbered.collect()) == list(range(len(keys)))


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_ids_do_not_depend_on_partitioning(spark, partitions):
    df = spark.range(5000).selectExpr("id * 7919 % 5000 as k", "id % 3 as v")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = dense_id(df, "k").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == 5000
    assert all(r["id"] == r["k"] for r in rows)


def test_copies_are_spread_over_ranges(spark):
    df = spark.range(0, 9000, 1, 6).selectExpr("if(id % 3 = 0, -1, id) as k", "'x' as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = dense_id(df, "k", unique=False)
        rows = numbered.collect()
        widest = numbered.selectExpr("spark_partition_id() as p").groupBy("p").count()
        assert widest.agg({"count": "max"}).first()[0] < 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["id"] for r in rows) == list(range(9000))
    assert {r["k"] for r in rows if r["id"] < 3000} == {-1}
    rest = sorted((r["id"], r["k"]) for r in rows if r["id"] >= 3000)
    assert [k for _, k in rest] == [k for k in range(9000) if k % 3]


def test_no_rows(spark):
    assert dense_id(spark.createDataFrame([], "k string"), "k").count() == 0
