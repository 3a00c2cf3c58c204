"""Exact k-means on integer vectors with ns-bounds.

Every vector keeps, for each centroid, its exact distance when that was last computed, and
the round of that. All earlier centroids are kept, so the stored distance is loosened by
the norm of the centroid's total displacement since that round, which by the triangle
inequality is at most the sum of the single steps and often far less. A vector whose
loosened upper bound of its own centroid lies below the loosened lower bounds of all
others keeps its centroid without any distance being computed; where that fails, exact
integer distances decide.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.common import scratch
from landfall.operators.keys import remove_folder

_NARROW = 1 << 27  # components below it have squared distances of 64 bits, up to 64 components
_SLACK = 1e-9  # of bounds, far above the error of their floating-point sums
_STATE = "vec_id long, v binary, wide boolean, cluster int, dist binary, seen binary, n_distances int"
_RESULT = "vec_id long, cluster int, distance long, n_distances int"


@dataclass(frozen=True)
class Clustering:
    k: int = 8
    width: int = 64
    rounds: int = 10
    scale: int = 1024
    seed: str = "3:"  # before the id in the hash that picks the first centroids


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _floors(x: np.ndarray, scale: int) -> list[int]:
    # Doubles from 2**53 on are integers, and their product with the scale may be no double.
    return [int(e) * scale if abs(e) >= 2.0**53 else math.floor(e * scale) for e in x.tolist()]


def integer_vectors(vectors: DataFrame, how: Clustering) -> DataFrame:
    """(vec_id, v, wide) of the vectors with ``width`` components, none null or non-finite.

    v holds floor(scale * x): 32-bit integers, or decimal numbers as text where a component
    is too large for distances of 64 bits (``wide``).
    """
    finite = F.forall(
        "embedding", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")), F.lit(False))
    )
    rows = vectors.where((F.size("embedding") == how.width) & finite)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), how.width)
            wide = (np.abs(x) >= _NARROW / how.scale).any(axis=1)
            narrow = np.floor(np.where(wide[:, None], 0, x) * how.scale).astype("<i4")
            packed = [
                ",".join(map(str, _floors(row, how.scale))).encode() if w else n.tobytes()
                for row, n, w in zip(x, narrow, wide.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(packed, pa.binary()), pa.array(wide, pa.bool_())], names=["vec_id", "v", "wide"]
            )

    x = F.transform("embedding", lambda e: e.cast("double"))
    return rows.select(F.col("vec_id").cast("long"), x.alias("x")).mapInArrow(pack, "vec_id long, v binary, wide boolean")


def _integers(v: bytes, wide: bool) -> list[int]:
    return [int(x) for x in v.split(b",")] if wide else np.frombuffer(v, "<i4").tolist()


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors of a batch: 64-bit integers, or Python's if one is wide."""
    wide = batch["wide"].to_numpy(zero_copy_only=False)
    if not wide.any():
        return np.frombuffer(b"".join(batch["v"].to_pylist()), "<i4").reshape(len(batch), width).astype(np.int64)
    rows = [_integers(v, w) for v, w in zip(batch["v"].to_pylist(), wide.tolist())]
    return np.array(rows, object).reshape(len(batch), width)


def _as_array(centroids: list[list[int]]) -> np.ndarray:
    narrow = all(abs(x) < _NARROW for c in centroids for x in c)
    return np.array(centroids, np.int64 if narrow else object)


def _squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` to ``c``."""
    if v.dtype == object or c.dtype == object:
        v, c = v.astype(object), c.astype(object)
    return ((v - c) ** 2).sum(axis=1)


def _root(squared: np.ndarray) -> np.ndarray:
    if squared.dtype != object:
        return np.sqrt(squared.astype(float))
    return np.array([math.sqrt(x) if x < 1 << 1000 else math.inf for x in squared.tolist()])


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """Norms (epoch, centroid) of the way from each centroid's place in that epoch to its last one."""
    return np.array([_root(_squared(np.asarray(then), np.asarray(history[-1]))) for then in history])


def settle(
    v: np.ndarray, cluster: np.ndarray, dist: np.ndarray, seen: np.ndarray, history: list[np.ndarray], moved: np.ndarray
) -> np.ndarray:
    """Assign the rows of ``v`` to the last centroids; ``cluster``, ``dist`` and ``seen`` are changed.

    dist and seen hold each row's distance to each centroid when last computed, and the
    epoch of that; -1 before the first. Ties go to the smaller number. Returns how many
    distances were computed for each row.
    """
    now, centroids = len(history) - 1, history[-1]
    n, k = dist.shape
    rows, column = np.arange(n), np.arange(k)
    computed = np.zeros(n, np.int32)
    fresh = seen[:, 0] < 0

    def exact(at: np.ndarray, c: int) -> np.ndarray:
        squared = _squared(v[at], centroids[c])
        dist[at, c], seen[at, c] = _root(squared), now
        computed[at] += 1
        return squared

    with np.errstate(invalid="ignore"):
        way = moved[np.maximum(seen, 0), column]
        upper = (dist[rows, cluster] + way[rows, cluster]) * (1 + _SLACK)
        lower = (dist - way) - _SLACK * (dist + way)
        # What is not certainly apart fails, also where a bound is no number.
        failed = ~(upper[:, None] < lower)
        failed[rows, cluster] = False
        open_rows = np.flatnonzero(fresh | failed.any(axis=1))
        if not len(open_rows):
            return computed
        # The distance to the own centroid first: it settles most failures.
        best = np.zeros(n, object if v.dtype == object or centroids.dtype == object else np.int64)
        for c in range(k):
            at = open_rows[cluster[open_rows] == c]
            if len(at):
                best[at] = exact(at, c)
        upper[open_rows] = dist[open_rows, cluster[open_rows]] * (1 + _SLACK)
        own, winner = cluster.copy(), cluster.copy()
        for c in range(k):
            at = open_rows[(own[open_rows] != c) & (fresh[open_rows] | ~(upper[open_rows] < lower[open_rows, c]))]
            if not len(at):
                continue
            squared = exact(at, c)
            # Centroids come in the order of their numbers, but the own one came first.
            closer = (squared < best[at]) | ((squared == best[at]) & (c < winner[at]))
            best[at[closer]], winner[at[closer]] = squared[closer], c
    cluster[:] = winner
    return computed


def _assigned(state: DataFrame, history: list[np.ndarray], how: Clustering) -> DataFrame:
    """The state after one round against the last centroids."""
    k = len(history[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved = displacements(history)
        for batch in batches:
            v, n = _matrix(batch, how.width), len(batch)
            cluster = batch["cluster"].to_numpy(zero_copy_only=False).copy()
            dist = np.frombuffer(b"".join(batch["dist"].to_pylist()), "<f8").reshape(n, k).copy()
            seen = np.frombuffer(b"".join(batch["seen"].to_pylist()), "<i2").reshape(n, k).copy()
            computed = settle(v, cluster, dist, seen, history, moved)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"], batch["v"], batch["wide"], pa.array(cluster, pa.int32()),
                    pa.array([row.tobytes() for row in dist], pa.binary()),
                    pa.array([row.tobytes() for row in seen], pa.binary()),
                    pa.array(batch["n_distances"].to_numpy() + computed, pa.int32()),
                ],
                names=[f.split()[0] for f in _STATE.split(", ")],
            )

    return state.mapInArrow(run, _STATE)


def _means(state: DataFrame, centroids: list[list[int]], how: Clustering) -> list[list[int]]:
    """Componentwise floor(sum / count) of every cluster; an empty one stays where it is.

    Tasks sum their rows, Spark adds the sums exactly, and k * (width + 1) numbers come to
    the driver.
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, cluster = _matrix(batch, how.width), batch["cluster"].to_numpy(zero_copy_only=False)
            rows: list[tuple[int, int, Decimal]] = []
            for c in np.unique(cluster).tolist():
                own = v[cluster == c]
                rows += [(c, at, Decimal(int(x))) for at, x in enumerate(own.sum(axis=0))] + [(c, -1, Decimal(len(own)))]
            if not rows:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.decimal128(38, 0)))],
                names=["cluster", "at", "value"],
            )

    partial = state.select("v", "wide", "cluster").mapInArrow(sums, "cluster int, at int, value decimal(38,0)")
    total = {(r["cluster"], r["at"]): int(r["value"]) for r in partial.groupBy("cluster", "at").agg(F.sum("value").alias("value")).collect()}
    return [
        [total[c, at] // total[c, -1] for at in range(how.width)] if (c, -1) in total else centroid
        for c, centroid in enumerate(centroids)
    ]


def _distances(state: DataFrame, centroids: np.ndarray, how: Clustering) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, cluster = _matrix(batch, how.width), batch["cluster"].to_numpy(zero_copy_only=False)
            squared = _squared(v, centroids[cluster])
            if squared.dtype == object and any(x >= 1 << 63 for x in squared.tolist()):
                raise ValueError("a squared distance does not fit 64 bits")
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["cluster"], pa.array(squared.tolist(), pa.int64()), batch["n_distances"]],
                names=[f.split()[0] for f in _RESULT.split(", ")],
            )

    return state.select("vec_id", "v", "wide", "cluster", "n_distances").mapInArrow(run, _RESULT)


def _first_centroids(packed: DataFrame, how: Clustering) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes; k rows at most come to the driver."""
    key = F.sha2(F.concat(F.lit(how.seed), F.col("vec_id").cast("string")), 256)
    rows = packed.where("vec_id is not null").orderBy(key, "wide", "v").limit(how.k).collect()
    return [_integers(bytes(r["v"]), r["wide"]) for r in rows]


def cluster_vectors(vectors: DataFrame, how: Clustering = Clustering()) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, n_distances) of every kept vector.

    ``vectors`` has vec_id and embedding. Left out are null vectors, those of another
    length and those with a null or non-finite component. The first centroids are the
    vectors whose ids have the smallest hashes, fewer than k if there are fewer; rows with
    a null id start none but are clustered. Repeated rows count each, and may start equal
    centroids, of which the first gets all. An empty table, or one without an id, gives an
    empty result; other columns take no part. Sums and distances are exact for any
    component; a squared distance that does not fit 64 bits, or a sum over a cluster
    beyond 38 digits, is an error. ``n_distances`` says how many exact distances were
    computed for the vector; without bounds it would be k * (rounds + 1).

    Each round's vectors and bounds are written to the shared scratch folder, where those
    of the round before are then removed.
    """
    spark = vectors.sparkSession
    packed, path = _written(integer_vectors(vectors, how), "ns-vectors")
    centroids = _first_centroids(packed, how)
    k = len(centroids)
    none = np.full(max(k, 1), -1, "<i2").tobytes()
    state = packed.select(
        "vec_id", "v", "wide", F.lit(0).alias("cluster"),
        F.lit(bytes(8 * k)).alias("dist"), F.lit(none).alias("seen"), F.lit(0).alias("n_distances"),
    )
    if not k:
        return _described(_distances(state.where("false"), np.zeros((1, how.width), np.int64), how), [], spark)
    history = [_as_array(centroids)]
    for _ in range(how.rounds + 1):
        state, now = _written(_assigned(state, list(history), how), "ns-state")
        remove_folder(spark, path)
        path = now
        if len(history) > how.rounds:
            break
        moved = _means(state, centroids, how)
        if moved == centroids:
            break  # all later rounds would repeat this one
        centroids = moved
        history.append(_as_array(centroids))
    result, _ = _written(_distances(state, history[-1], how), "clusters")
    remove_folder(spark, path)
    return _described(result, centroids, spark)


def _described(result: DataFrame, centroids: list[list[int]], spark: SparkSession) -> DataFrame:
    """Add what is the same for a whole cluster: at most k rows, joined by a broadcast."""
    hashes = [(c, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids)]
    digests = spark.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    own = result.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(F.broadcast(digests), "cluster")
    own = own.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy(F.lit(0))))
    return result.join(F.broadcast(own), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_distances"
    )
