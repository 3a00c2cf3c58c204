"""Exact top-k search by inner product.

Vectors are rotated so that their first coordinates carry most of their energy (the
singular vectors of all rows, from their summed outer products) and range-partitioned by
descending length into blocks. A query meets the longest vectors first, which gives it a
k-th best score to beat, and then only the blocks whose longest vector could beat it. In a
block, the product over the first rotated coordinates plus the Cauchy-Schwarz bound of the
rest discards nearly all pairs; the others are scored exactly in integers.

Vectors too long for sums of 64 bits are kept apart: they meet all others in floating point
with a bound of its error, and what may be among the best is scored in integers of any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import stored

_LONGEST = 2.0**31  # of two such vectors the product is below 2**62
_FOUND = "query_id long, vec_id long, score long"


@dataclass(frozen=True)
class Search:
    k: int = 5
    scale: int = 256
    block_vectors: int = 8192
    query_vectors: int = 2048  # of a task
    chunk_vectors: int = 1024  # scored at a time in a task
    lead: int = 16  # rotated coordinates of the partial sums
    largest: float = float(1 << 28)  # of a scaled component; larger ones are summed beyond 64 bits


def scaled_vectors(vectors: DataFrame, search: Search) -> DataFrame:
    """(vec_id, v, norm, wide, row): components as floor(scale * x), v their 64-bit integers as bytes.

    Left out are only null ids and vectors and those with a null or non-finite component.
    Rows whose components or length are too large for exact sums in 64 bits are ``wide``;
    their v has floor(scale * x) / scale as doubles. ``row`` is unique.
    """
    usable = F.forall(
        "embedding", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")), F.lit(False))
    )
    rows = vectors.where("vec_id is not null and embedding is not null").where(usable)
    scale = search.scale

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, norms, wide = [], [], []
            for row in batch["x"]:
                x = np.array(row.as_py(), float)
                with np.errstate(over="ignore"):
                    v = np.floor(x * scale)
                    norms.append(float(np.sqrt((v**2).sum())))
                wide.append(not (norms[-1] < _LONGEST and np.abs(v).max(initial=0) < search.largest))
                # Doubles from 2**53 on are integers, which the product with the scale could overflow.
                large = np.abs(x) >= 2.0**53
                packed.append((np.where(large, x, v / scale) if wide[-1] else v.astype("<i8")).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(packed, pa.binary()), pa.array(norms, pa.float64()), pa.array(wide, pa.bool_())],
                names=["vec_id", "v", "norm", "wide"],
            )

    x = F.transform("embedding", lambda e: e.cast("double"))
    packed = rows.select(F.col("vec_id").cast("long"), x.alias("x")).mapInArrow(
        pack, "vec_id long, v binary, norm double, wide boolean"
    )
    return packed.withColumn("row", F.monotonically_increasing_id())


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of ``width`` integers; shorter vectors end in zeros."""
    rows = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        values = np.frombuffer(v.as_py(), "<i8")
        rows[i, : len(values)] = values
    return rows


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Singular vectors of all rows as columns, strongest first, from summed outer products."""
    upper = np.triu_indices(width)

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch["v"], width).astype(float)
            total += m.T @ m
        yield pa.RecordBatch.from_pydict({"at": np.arange(len(upper[0])), "value": total[upper]})

    sums = vectors.select("v").mapInArrow(outer, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    second = np.zeros(len(upper[0]))
    for row in sums.collect():
        second[row["at"]] = row["value"]
    full = np.zeros((width, width))
    full[upper] = second
    full = full + np.triu(full, 1).T
    _, axes = np.linalg.eigh(full)
    return axes[:, ::-1]


def best_pairs(
    q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, c: np.ndarray, c_ids: np.ndarray, axes: np.ndarray, search: Search
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best candidates (query place, candidate id, score), candidates by descending length.

    ``floor`` has the score that each query must reach.
    """
    k, lead = search.k, min(search.lead, q.shape[1])
    qr, cr = q @ axes, c @ axes
    q_rest = np.sqrt((qr[:, lead:] ** 2).sum(axis=1))
    c_rest = np.sqrt((cr[:, lead:] ** 2).sum(axis=1))
    slack = 1e-6 * (1 + np.sqrt((q.astype(float) ** 2).sum(axis=1)) * np.sqrt((c.astype(float) ** 2).sum(axis=1)).max(initial=0))
    # Sums of products below 2**53 are exact in doubles, which multiply much faster.
    largest = max(np.abs(q).max(initial=0), np.abs(c).max(initial=0))
    as_double = float(largest) ** 2 * q.shape[1] < 2**53
    qx, cx = (q.astype(float), c.astype(float)) if as_double else (q, c)
    floor = floor.astype(float).copy()
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for start in range(0, len(c), search.chunk_vectors):
        part = slice(start, start + search.chunk_vectors)
        bound = qr[:, :lead] @ cr[part, :lead].T + np.outer(q_rest, c_rest[part])
        may = (bound + slack[:, None] >= floor[:, None]) & (q_ids[:, None] != c_ids[part][None, :])
        if may.mean() > 0.1:
            # Too many for pair by pair: score all, and raise the floors before listing pairs.
            every = np.where(may, qx @ cx[part].T, -np.inf)
            if every.shape[1] >= k:
                floor = np.maximum(floor, np.partition(every, -k, axis=1)[:, -k])
            at_q, at_c = np.nonzero(may & (every >= floor[:, None]))
            scores = every[at_q, at_c] if as_double else np.einsum("ij,ij->i", qx[at_q], cx[part][at_c])
        else:
            at_q, at_c = np.nonzero(may)
            scores = np.einsum("ij,ij->i", qx[at_q], cx[part][at_c])
        scores = scores.astype(np.int64)
        good = scores >= floor[at_q]
        merged = [
            np.concatenate([best[0], at_q[good]]),
            np.concatenate([best[1], c_ids[part][at_c[good]]]),
            np.concatenate([best[2], scores[good]]),
        ]
        order = np.lexsort((merged[1], -merged[2], merged[0]))
        merged = [x[order] for x in merged]
        begins = np.searchsorted(merged[0], merged[0])
        keep = np.arange(len(order)) - begins < k
        best = tuple(x[keep] for x in merged)
        last = np.flatnonzero(np.arange(len(order)) - begins == k - 1)
        floor[merged[0][last]] = np.maximum(floor[merged[0][last]], merged[2][last])
    return best


def exact_pairs(left: pa.Table, right: pa.Table, width: int, search: Search) -> list[tuple[int, int, int | None]]:
    """Each left row's k best right rows with another id (query id, id, score), of any length.

    A score above 64 bits is an error, as it leads the query's result; one below is None.
    """

    def doubles(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Rows divided by a power of two each, which makes them shorter than 1 to a component, and the powers."""
        rows = np.zeros((len(table), width))
        for i, (v, wide) in enumerate(zip(table["v"], table["wide"].to_pylist())):
            values = np.frombuffer(v.as_py(), "<f8" if wide else "<i8")
            rows[i, : len(values)] = values if wide else values / search.scale
        power = np.frexp(np.abs(rows).max(axis=1, initial=0))[1]
        return np.ldexp(rows, -power[:, None]), power

    def integers(table: pa.Table, i: int) -> list[int]:
        v = table["v"][i].as_py()
        if not table["wide"][i].as_py():
            return np.frombuffer(v, "<i8").tolist()
        return [int(x * search.scale) if abs(x) < 2.0**53 else int(x) * search.scale for x in np.frombuffer(v, "<f8").tolist()]

    (q, _), (c, power) = doubles(left), doubles(right)
    c = np.ldexp(c, (power - power.max(initial=-(1 << 20)))[:, None])
    q_ids, c_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
    q_norm, c_norm = np.sqrt((q**2).sum(axis=1)), np.sqrt((c**2).sum(axis=1))
    known: dict[int, list[int]] = {}
    found = []
    for i in range(len(q)):
        about = c @ q[i]
        error = (width + 4) * 2.0**-52 * q_norm[i] * c_norm + 1e-300
        others = np.flatnonzero(c_ids != q_ids[i])
        if len(others) > search.k:
            least = np.partition((about - error)[others], -search.k)[-search.k]
            others = others[(about + error)[others] >= least]
        own, scores = integers(left, i), []
        for j in others.tolist():
            if j not in known:
                known[j] = integers(right, j)
            scores.append((-sum(a * b for a, b in zip(own, known[j])), int(c_ids[j])))
        for score, j in sorted(scores)[: search.k]:
            if -score >= 2**63:
                raise ValueError(f"the score of vectors {q_ids[i]} and {j} does not fit 64 bits")
            found.append((int(q_ids[i]), j, -score if -score >= -(2**63) else None))
    return found


def _met_wide(queries: DataFrame, candidates: DataFrame, width: int, search: Search) -> DataFrame:
    """The k best of each block for each query by ``exact_pairs``, by task (query part, block)."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = exact_pairs(left, right, width, search) if len(left) and len(right) else []
        columns = zip(*found) if found else ([], [], [])
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["query_id", "vec_id", "score"])

    keys = ("part", "block")
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])
    return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(meet, _FOUND)


def _met(queries: DataFrame, candidates: DataFrame, axes: np.ndarray, search: Search) -> DataFrame:
    """The k best of each block for each query, by task (query part, block)."""
    width = len(axes)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64),) * 3
        q_ids = left["vec_id"].to_numpy()
        if len(left) and len(right):
            right = right.sort_by([("norm", "descending"), ("vec_id", "ascending")])
            found = best_pairs(
                _matrix(left["v"], width), q_ids, left["floor"].to_numpy(),
                _matrix(right["v"], width), right["vec_id"].to_numpy(), axes, search,
            )
        at, ids, scores = found
        return pa.table({"query_id": q_ids[at] if len(at) else at, "vec_id": ids, "score": scores})

    keys = ("part", "block")
    # Both sides come from one table; new names for one of them tell them apart.
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])
    return queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(meet, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_top_k(vectors: DataFrame, is_query: Column, search: Search = Search()) -> DataFrame:
    """The k highest-scoring vectors with another id for each query id, ties to the smaller id.

    ``is_query`` is a condition on vec_id. Queries meet candidates in parts and blocks of
    bounded size. Shorter vectors count as if they ended in zeros. A query with fewer than
    k others gets all of them, an empty table gives an empty one, and other columns take no
    part. Rows that share an id all count, as candidates and, in one list, as queries. A
    score among the k best that does not fit 64 bits is an error. See ``scaled_vectors``
    for the rows that are left out.
    """
    every = stored(scaled_vectors(vectors, search), "scaled-vectors")
    facts = every.agg(
        F.count_if(~F.col("wide")).alias("n"), F.count_if("wide").alias("wide"), F.max(F.octet_length("v")).alias("bytes")
    ).first()
    width = max(1, (facts["bytes"] or 0) // 8)
    rows = every.where(~F.col("wide"))
    axes = rotation(rows, width)
    # Id and row break ties in length, so equal vectors too are split evenly.
    wanted = max(1, -(-facts["n"] // search.block_vectors))
    blocks = stored(
        rows.withColumn("_down", -F.col("norm")).repartitionByRange(wanted, "_down", "vec_id", "row").drop("_down")
        .withColumn("block", F.spark_partition_id()),
        "vector-blocks",
    )
    found = _found(blocks, is_query, axes, search)
    if facts["wide"]:
        found = found.unionAll(_found_wide(blocks, every.where("wide"), facts["wide"], is_query, width, search))
    return _ranked(found, search.k)


def _in_parts(queries: DataFrame, search: Search) -> tuple[DataFrame, Column]:
    """Queries with their part, and the expression that gives a candidate once for every part."""
    parts = max(1, -(-queries.count() // search.query_vectors))
    queries = queries.withColumn("part", F.pmod(F.xxhash64("vec_id", "row"), F.lit(parts)).cast("int"))
    return queries, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")


def _found_wide(narrow: DataFrame, wide: DataFrame, n: int, is_query: Column, width: int, search: Search) -> DataFrame:
    """The best pairs with a wide row: all blocks for wide queries, those of wide rows for the others."""
    first = (narrow.agg(F.max("block")).first()[0] or 0) + 1
    more = -(-n // search.block_vectors)
    dealt = F.pmod(F.xxhash64("row"), F.lit(more)).cast("int") + first
    every = narrow.unionAll(wide.withColumn("block", dealt))
    queries, every_part = _in_parts(every.where(is_query).drop("block"), search)
    lowest = F.when(F.col("wide"), 0).otherwise(first)
    queries = queries.withColumn("block", F.explode(F.sequence(lowest, F.lit(first + more - 1))))
    return _met_wide(queries, every.select("*", every_part), width, search)


def _found(blocks: DataFrame, is_query: Column, axes: np.ndarray, search: Search) -> DataFrame:
    """The best pairs of rows that are not wide."""
    reach = sorted(
        (r["block"], r["norm"]) for r in blocks.groupBy("block").agg(F.max("norm").alias("norm")).collect()
    )
    queries, every_part = _in_parts(blocks.where(is_query).select("vec_id", "v", "norm", "row"), search)
    candidates = blocks.select("*", every_part)
    if not reach:
        return _met(_with_block(queries, []), candidates, axes, search)
    first, later = reach[0][0], reach[1:]
    lowest = F.lit(-float(2**63)).alias("floor")
    start = _met(
        queries.select("*", lowest, F.lit(first).alias("block")),
        candidates.where(F.col("block") == first), axes, search,
    )
    found = stored(start, "first-block")
    if later:
        floors = found.groupBy("query_id").agg(
            F.when(F.count("*") >= search.k, F.min("score")).cast("double").alias("floor")
        )
        known = queries.join(floors, F.col("vec_id") == F.col("query_id"), "left").drop("query_id")
        known = known.withColumn("floor", F.coalesce("floor", F.lit(-float(2**63))))
        rest = _met(_with_block(known, later), candidates.where(F.col("block") != first), axes, search)
        found = found.unionAll(rest)
    return found


def _with_block(queries: DataFrame, blocks: list[tuple[int, float]]) -> DataFrame:
    """Each query once for each block that may hold a vector long enough to reach its floor."""
    if not blocks:
        return queries.select("*", F.lit(0.0).alias("floor"), F.lit(0).alias("block")).limit(0)
    lengths = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(float(n)).alias("n")) for b, n in blocks])
    near = F.filter(lengths, lambda x: x["n"] * F.col("norm") * (1 + 1e-9) + 1 >= F.col("floor"))
    return queries.withColumn("block", F.explode(F.transform(near, lambda x: x["b"])))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    below = F.raise_error(F.lit("a score among the best does not fit 64 bits")).cast("long")
    score = F.coalesce("score", below).alias("score")
    return _best(found, k).select("query_id", "rank", "vec_id", score)
