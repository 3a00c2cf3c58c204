"""Mixing sources to target weights by Sainte-Laguë apportionment.

A target of words is set for every source. Blocks of equally many words are dealt to the
sources by highest quotients, then each source's blocks to its shards in the same way, so
every shard has a whole number of blocks to give. Within a shard the documents stand in
seeded order as one stream of words that is cut into blocks. A shard gives all its blocks
as often as its quota allows and once more those that a seeded permutation puts first.

Only native expressions work on rows. A source of any size is split over shards, and what
comes to the driver is one row per source or shard.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.common import WORD, shielded, stored

_PRIME = 2147483647  # larger than any shard's number of blocks, so multiplying by it permutes them


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (3, 1, 2)  # of the sources in code-point order, repeating, null last
    share_percent: int = 150  # all targets together, in percent of all words
    most_percent: int = 200  # of its own words that a source may give at most
    block_words: int = 16
    shard_documents: int = 8192
    max_shards: int = 512  # of one source, which bounds the rows on the driver
    seed: int = 29


def targets(sizes: list[int], weights: list[int], total: float, most: list[float]) -> list[float]:
    """Share ``total`` by weight; what lies above a source's most is shared anew by weight."""
    fixed: dict[int, float] = {i: 0.0 for i, size in enumerate(sizes) if size == 0}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left, weight = total - sum(fixed.values()), sum(weights[i] for i in free)
        share = {i: left * weights[i] / weight for i in free}
        above = [i for i in free if share[i] > most[i]]
        if not above:
            return [fixed.get(i, share.get(i, 0.0)) for i in range(len(sizes))]
        fixed |= {i: float(most[i]) for i in above}


def apportion(weights: list[float], seats: int, caps: list[int]) -> list[int]:
    """Sainte-Laguë: seats go one by one to the highest weight / (2 * seats held + 1).

    Starting from rounded shares, only the few seats by which the rounding misses the
    total are moved, by the same quotients. Nobody gets more than its cap; ties go to the
    first.
    """
    total = sum(weights)
    if total <= 0:
        return [0] * len(weights)
    seats = min(seats, sum(c for c, w in zip(caps, weights) if w > 0))
    held = [min(c, int(w * seats / total + 0.5)) for w, c in zip(weights, caps)]
    missing = seats - sum(held)
    if missing > 0:
        queue = [(-w / (2 * h + 1), i) for i, (w, h, c) in enumerate(zip(weights, held, caps)) if h < c and w > 0]
    else:
        queue = [(w / (2 * h - 1), -i) for i, (w, h) in enumerate(zip(weights, held)) if h > 0]
    heapq.heapify(queue)
    step = 1 if missing > 0 else -1
    for _ in range(abs(missing)):
        _, at = heapq.heappop(queue)
        i = abs(at)
        held[i] += step
        if step > 0 and held[i] < caps[i]:
            heapq.heappush(queue, (-weights[i] / (2 * held[i] + 1), i))
        elif step < 0 and held[i] > 0:
            heapq.heappush(queue, (weights[i] / (2 * held[i] - 1), -i))
    return held


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few rows of the driver as a native relation."""
    values = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1, numPartitions=1).select(F.inline(values))


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plan(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Per (source, shard): target and size of the source, blocks of the shard and its quota."""
    spark = sizes.sparkSession
    found = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    # Python orders strings by code point.
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    words = [r["size"] for r in found]
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(found))]
    most = [mix.most_percent * s / 100 for s in words]
    aim = targets(words, weights, mix.share_percent * sum(words) / 100, most)
    shards = [min(mix.max_shards, -(-r["n"] // mix.shard_documents)) for r in found]
    schema = "source string, source_size bigint, target double, shards int"
    sources = _table(spark, [
        {"source": r["source"], "source_size": s, "target": t, "shards": k}
        for r, s, t, k in zip(found, words, aim, shards)
    ], schema)
    rows = (
        sharded(sizes, sources, mix).groupBy("source", "shard").agg(F.sum("size").alias("size")).collect()
    )
    own: dict = {r["source"]: [] for r in found}
    for r in sorted(rows, key=lambda r: r["shard"]):
        own[r["source"]].append((r["shard"], r["size"]))
    blocks = {name: [-(-size // mix.block_words) for _, size in parts] for name, parts in own.items()}
    repeats = -(-mix.most_percent // 100)
    names = [r["source"] for r in found]
    quota = apportion(
        aim, round(sum(aim) / mix.block_words), [repeats * sum(blocks[name]) for name in names]
    )
    out = []
    for name, size, t, k, q in zip(names, words, aim, shards, quota):
        dealt = apportion([float(s) for _, s in own[name]], q, [repeats * b for b in blocks[name]])
        out += [
            {"source": name, "source_size": size, "target": t, "shards": k, "shard": shard, "blocks": b, "quota": d}
            for (shard, _), b, d in zip(own[name], blocks[name], dealt)
        ]
    return _table(spark, out, f"{schema}, shard int, blocks bigint, quota bigint")


def sharded(sizes: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    source = sources.withColumnRenamed("source", "_source")
    shard = F.pmod(F.xxhash64(F.lit(mix.seed), "doc_id", "size"), F.col("shards")).cast("int")
    return (
        sizes.join(source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("shard", shard)
    )


def _placed(sizes: DataFrame, planned: DataFrame, mix: Mix) -> DataFrame:
    """Add each row's place in its shard's stream of words and the shard's plan."""
    sources = planned.select("source", "source_size", "target", "shards").distinct()
    quotas = planned.select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "blocks", "quota"
    )
    order = [F.xxhash64(F.lit(mix.seed + 1), "doc_id", "size"), F.col("doc_id"), F.col("size")]
    if "order_key" in sizes.columns:
        order.append(F.col("order_key"))
    stream = Window.partitionBy("source", "shard").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = sharded(sizes, sources, mix).join(
        quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard"))
    )
    return rows.withColumns({
        "start": F.coalesce(F.sum("size").over(stream), F.lit(0)),
        "rounds": F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(0),
        "extra": F.when(F.col("blocks") > 0, F.col("quota") % F.col("blocks")).otherwise(0),
        "turn": F.when(
            F.col("blocks") > 0, F.pmod(F.xxhash64(F.lit(mix.seed + 2), "source", "shard"), F.col("blocks"))
        ).otherwise(0),
    })


def _chosen(block: Column) -> Column:
    """Whether the seeded permutation puts a block among the shard's extra ones."""
    return F.pmod(block * F.lit(_PRIME) + F.col("turn"), F.col("blocks")) < F.col("extra")


def mix_words(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """How many words of each document the mix takes, repeats counted.

    A null text has size 0, and of a document of size 0 nothing is taken. Null sources are
    one source, the last. Repeated rows take part one by one. Empty tables give empty ones;
    other columns take no part. The same rows give the same result on every run.
    """
    sizes = stored(docs.select("doc_id", "source", word_count().alias("size")), "mix-sizes")
    rows = _placed(sizes, plan(sizes, mix), mix)
    b = F.lit(mix.block_words)
    first = F.floor(F.col("start") / b)
    last = F.floor((F.col("start") + F.col("size") - 1) / b)
    end = F.col("start") + F.col("size")

    def overlap(total: Column, block: Column) -> Column:
        words = F.least(end, (block + 1) * b) - F.greatest(F.col("start"), block * b)
        return total + F.when(_chosen(block), words).otherwise(F.lit(0))

    more = F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), overlap)
    taken = F.when(F.col("size") > 0, F.col("rounds") * F.col("size") + more).otherwise(0)
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source")


def mix_documents(docs: DataFrame, mix: Mix = Mix(block_words=1024)) -> DataFrame:
    """The mix as whole documents: each goes with the block in which it starts.

    A document stands as often as its block is taken, possibly never; documents without
    words, so null and empty texts too, leave. Null sources are one source, the last. Null ids
    and repeated rows take part row by row. An empty table gives an empty one; other columns
    are kept, also those named like columns used here.
    """
    rows, restored = shielded(docs, "doc_id", "source", "text")
    rows = rows.withColumns({"size": word_count(), "order_key": F.xxhash64("text")})
    sizes = stored(rows.select("doc_id", "source", "size"), "mix-sizes")
    placed = _placed(rows, plan(sizes, mix), mix).where("size > 0")
    block = F.floor(F.col("start") / mix.block_words)
    copies = F.col("rounds") + F.when(_chosen(block), 1).otherwise(0)
    return (
        placed.withColumn("copies", copies.cast("int")).where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(*restored)
    )
