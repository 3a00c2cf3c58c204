"""Reproducible surrogate keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# monotonically_increasing_id keeps the row's place in its partition in the low 33 bits.
_PLACE_BITS = 33


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in spark.checkpoint.dir. A new local one is made only in
    local mode, where driver and executors are one process; elsewhere an unset
    folder is an error, as executors do not see each other's disks.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="landfall-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the scratch root."""
    path = f"{scratch_root(spark).rstrip('/')}/landfall-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was written to scratch folders inside.

    Whatever is read later must have been written elsewhere by then.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            remove_folder(spark, path)


def fixed(df: DataFrame) -> DataFrame:
    """Write ``df`` to a scratch folder and read it back.

    Like a checkpoint it is computed once and survives lost executors, and
    unlike one it can be removed when it has served.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_id(df: DataFrame, *keys: str, unique: bool = True, name: str = "id") -> DataFrame:
    """Add ids 0..n-1 in key order, nulls first: the same ids on every run.

    Rows are range-partitioned and sorted by the keys and written to a scratch folder,
    which fixes each row's partition and place even when executors are lost. An id is
    then the row's place plus the number of rows in earlier partitions, so no
    task ever holds more than one range. Pass ``unique=False`` when rows may be
    exact copies of each other: their scan position then splits a large group
    of copies over several ranges. Copies are interchangeable, so the numbered
    rows stay the same. Scan positions repeat on a retry only if ``df`` is a file
    scan with row-local steps, so write anything else first.
    """
    columns = df.columns
    if unique:
        ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    else:
        keys = (*keys, *[c for c in columns if c not in keys], "_scan")
        ordered = (
            df.withColumn("_scan", F.monotonically_increasing_id())
            .repartitionByRange(*keys)
            .sortWithinPartitions(*keys)
            .drop("_scan")
        )
    placed = fixed(ordered.withColumn("_place", F.monotonically_increasing_id())).withColumns({
        "_range": F.shiftright("_place", _PLACE_BITS),
        "_place": F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
    })
    # One row per partition, so both the running sum and the broadcast are bounded by their number.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_range").select(
        *columns, (F.col("_offset") + F.col("_place")).alias(name)
    )


def lasting_ids(keys: DataFrame, known: DataFrame, *columns: str) -> DataFrame | None:
    """``known`` (columns, id) and ids for the keys that it lacks, or None if it lacks none.

    Ids once given stay. New keys are numbered in key order, nulls first, from the largest
    known id on, so the ids of all keys ever seen are 0..n-1. A null key is a key.
    ``keys`` has each key once and is read twice, so write it first.
    """
    same = reduce(lambda a, b: a & b, [keys[c].eqNullSafe(known[c]) for c in columns])
    new = fixed(keys.select(*columns).join(known, same, "left_anti"))
    if new.isEmpty():
        return None
    largest = known.agg(F.max("id")).first()[0]
    start = -1 if largest is None else largest
    numbered = dense_id(new, *columns).withColumn("id", F.col("id") + start + 1)
    return known.select(*columns, "id").unionAll(numbered.select(*columns, "id"))
