"""New arrival files merged into the stored fact as they come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from landfall import schemas
from landfall.operators import fact as facts
from landfall.operators.clean import clean_arrivals
from landfall.operators.keys import fixed, scratch_removed
from landfall.operators.lookup import MAX_BROADCAST_ROWS
from landfall.plans.pipeline import write_date_dimension
from landfall.sources.readers import conform
from landfall.sources.versions import Store

#: What a load notes of the streams that feed the store: the last batch of each.
_BATCHES = "stream_batches"


def merge_batch(store: Store, raw: DataFrame, codebook: DataFrame, stream: str, batch: int, keep: int = 2) -> bool:
    """Publish one batch of raw arrival records; False if it was published before.

    A record replaces the stored ones with its id in its own month, also if it is itself
    cleaned away; a record without an id replaces none. Only months that the batch has
    records of are written anew, each whole. The batch's number becomes visible together
    with its rows, by the same write, so a batch that is tried again after a failure counts
    once. Copies of a record within a batch all stay, as in a batch load.

    A large batch and the stored rows are joined by sorting, which spills. Ids in a row take
    little room in files, so Catalyst, which goes by that, would broadcast many millions.
    """
    noted = store.version().notes.get(_BATCHES, {})
    if noted.get(stream, -1) >= batch:
        return False
    with scratch_removed(store.spark), store.load(keep=keep) as load:
        raw = fixed(raw.select(*facts.INPUTS))
        year, month = (F.col(c).try_cast("int") for c in ("i94yr", "i94mon"))
        keyed = raw.select(F.col("cicid").try_cast("long").alias("_id"), year.alias("_year"), month.alias("_month")).distinct()
        # A few hundred months at most.
        touched = {(r["_year"], r["_month"]): r["count"] for r in keyed.groupBy("_year", "_month").count().collect()}
        if sum(touched.values()) > MAX_BROADCAST_ROWS:
            keyed = keyed.hint("merge")
        stored = store.table("immigration_fact", months=[m for m in load.base.months if m.month in touched])
        same = (
            (stored["immigration_id"] == keyed["_id"])
            & stored["arrival_year"].eqNullSafe(keyed["_year"])
            & stored["arrival_month"].eqNullSafe(keyed["_month"])
        )
        kept = stored.join(keyed, same, "left_anti")
        new = facts.build_fact(clean_arrivals(raw), codebook)
        load.write_fact(kept.unionByName(new))
        load.covers(touched)
        write_date_dimension(load)
        load.notes[_BATCHES] = noted | {stream: batch}
        load.publish()
    return True


def load_new_files(
    spark: SparkSession,
    arrivals: str,
    codebook: DataFrame,
    store: Store,
    checkpoint_path: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Merge every parquet extract file not loaded before into the store, then stop.

    The checkpoint folder names the stream, and the store knows the last batch of it that
    was published. Rows are cleaned and decoded by the same functions as in the batch load.
    """
    # The files' own types, converted as in the batch load.
    reader = spark.readStream.schema(spark.read.parquet(arrivals).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = conform(reader.parquet(arrivals), schemas.ARRIVALS_RAW)

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(store, batch, codebook, checkpoint_path, number)

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
