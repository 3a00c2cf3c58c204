import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from landfall.llm import centroid_clustering as C
from landfall.llm.registry import ORACLE_SQL
from tests.llm import samples


def lloyd(rows, how=C.Clustering()):
    """Every distance in every round, in Python's integers."""
    ok = [(i, [math.floor(x * how.scale) if abs(x) < 2**53 else int(x) * how.scale for x in v]) for i, v in rows
          if v is not None and len(v) == how.width and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(((hashlib.sha256(f"{how.seed}{i}".encode()).hexdigest(), v) for i, v in ok if i is not None), key=lambda x: x)
    centroids = [v for _, v in first[: how.k]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(how.rounds):
        own = [nearest(v)[1] for _, v in ok]
        for k in range(len(centroids)):
            members = [v for (_, v), c in zip(ok, own) if c == k]
            if members:
                centroids[k] = [sum(x) // len(members) for x in zip(*members)]
    last = [nearest(v) for _, v in ok]
    inertia = [sum(d for d, c in last if c == k) for k in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return samples.plain((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(ok, last))


def cluster(spark, rows, kind="double", how=C.Clustering()):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    df = df.selectExpr("*", "1 as cluster", "'a' as v", "2 as distance", "3 as wide", "4 as dist", "5 as inertia")
    return C.cluster_vectors(df, how)


SMALL = C.Clustering(k=5, width=6, rounds=7)


def vectors(n=400, d=6, seed=1):
    rng = random.Random(seed)
    centres = [[rng.uniform(-3, 3) for _ in range(d)] for _ in range(9)]
    rows = [(i, [c + rng.gauss(0, 0.4) for c in rng.choice(centres)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(200)]  # a third are copies
    rows += [rows[3]] * 4 + [(None, rows[5][1]), (None, [0.0] * d), (7001, None), (7002, []), (7003, [1.0] * (d - 1)),
                             (7004, [None] + [1.0] * (d - 1)), (7005, [float("nan")] * d), (7006, [float("-inf")] * d), (None, None)]
    return rows


def test_matches_lloyd_and_saves_distances(spark):
    out = cluster(spark, vectors(), how=SMALL)
    assert samples.plain(out.drop("n_distances").collect()) == lloyd(vectors(), SMALL)
    per_row = [r[0] for r in out.select("n_distances").collect()]
    assert 5 <= min(per_row) and sum(per_row) / len(per_row) < 0.8 * 5 * 8


def test_full_width_against_lloyd_and_sql(spark):
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in vectors(150, 64)]
    wanted = lloyd(rows)
    assert samples.plain(cluster(spark, rows, "float").drop("n_distances").collect()) == wanted
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", [list(r) for r in rows])
    cursor = con.execute(ORACLE_SQL["op12_centroid_clustering"])
    assert samples.plain(cursor.fetchall()) == wanted


def test_ties_on_a_grid_go_to_the_smaller_number(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(0, 2)) for _ in range(3)]) for i in range(300)]
    how = C.Clustering(k=6, width=3, rounds=9, scale=2)
    assert samples.plain(cluster(spark, rows, how=how).drop("n_distances").collect()) == lloyd(rows, how)


def test_large_components_are_exact(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 3, 5])] * 2 + [0.5]) for i in range(60)]
    rows += [(100, [2e5, -2e5, 1.0]), (101, [1.5e6, 1e6, 0.0]), (102, [-1.5e6, 3.0, 0.0])]
    how = C.Clustering(k=4, width=3, rounds=5)
    assert samples.plain(cluster(spark, rows, how=how).drop("n_distances").collect()) == lloyd(rows, how)
    far = [(0, [0.0]), (1, [1e300])]
    with pytest.raises(Exception):  # noqa: B017
        cluster(spark, far, how=C.Clustering(k=1, width=1, rounds=1)).collect()
    # Far apart, but each its own centroid.
    apart = [(0, [0.0]), (1, [1e15])]
    assert {r["distance"] for r in cluster(spark, apart, how=C.Clustering(k=2, width=1, rounds=2)).collect()} == {0}


def test_few_none_and_empty(spark):
    few = vectors()[:3]
    assert samples.plain(cluster(spark, few, how=SMALL).drop("n_distances").collect()) == lloyd(few, SMALL)
    for rows in ([], [(None, [1.0] * 6)], [(1, [1.0])]):
        out = cluster(spark, rows, how=SMALL)
        assert out.collect() == [] and out.columns[:6] == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_displacement_is_of_the_whole_way():
    there, back = np.array([[0, 0]]), np.array([[30, 40]])
    assert C.displacements([there, back, there]).tolist() == [[0.0], [50.0], [0.0]]


def test_unmoved_centroids_need_no_distance():
    rng = np.random.default_rng(3)
    c = np.array([[0, 0], [1000, 0]])
    v = np.concatenate([rng.integers(-50, 50, (20, 2)), rng.integers(-50, 50, (20, 2)) + [1000, 0]])
    cluster, dist, seen = np.zeros(40, np.int32), np.zeros((40, 2)), np.full((40, 2), -1, np.int16)
    history = [c]
    assert C.settle(v, cluster, dist, seen, history, C.displacements(history)).tolist() == [2] * 40
    for step in (30, -30, 5):
        history = [*history, history[-1] + step]
        before = cluster.copy()
        assert not C.settle(v, cluster, dist, seen, history, C.displacements(history)).any()
        assert (cluster == before).all()
