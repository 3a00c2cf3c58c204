import math
import random

import numpy as np
from pyspark.sql import functions as F

from landfall.llm import exact_search as S
from tests.llm import samples


def rows(n=700, d=12, seed=1):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(0, 1) * (1 + 5 * (i % 40 == 0)) for _ in range(d)]) for i in range(n)]
    out += [(i, out[3][1]) for i in range(n, n + 60)]  # ties
    out += [(5000, None), (5050, [1.0, None] * 6), (5100, [float("nan")] * d), (5150, [float("inf")] * d), (None, [1.0] * d),
            (5200, []), (5250, [1.0, 2.0]), (5300, [0.0] * d), (5350, [-0.001] * d), (5400, [2e7] * d)]
    return out


def expected(rows, k=5):
    """Every pair of a query row and a row with another id, in Python's integers; only nulls and non-finite ones are out."""
    ints = [(i, [math.floor(float(np.float32(x)) * 256) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in {i for i, _ in ints if i % 50 == 0}:
        pairs = [(-sum(a * b for a, b in zip(u, v)), j) for i, u in ints if i == q for j, v in ints if j != q]
        out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(sorted(pairs)[:k])]
    return samples.plain(out)


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.selectExpr("*", "1 as label", "'a' as block", "2 as norm", "3 as v", "4 as score", "5 as part")


def search(spark, rows, **bounds):
    return samples.plain(S.search_top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, S.Search(**bounds)).collect())


def test_matches_brute_force(spark):
    assert search(spark, rows()) == expected(rows())


def test_small_blocks(spark):
    assert search(spark, rows(), block_vectors=60, query_vectors=4, chunk_vectors=16, lead=3) == expected(rows())


def test_repeated_rows_and_few(spark):
    few = rows()[:3]
    assert search(spark, few + few) == expected(few + few)
    assert search(spark, few) == expected(few)
    assert search(spark, []) == []
    assert search(spark, [(1, [1.0])]) == []


def test_discards_and_stays_exact():
    rng = np.random.default_rng(2)
    c = rng.integers(-300, 300, (3000, 24)) * np.r_[np.full(6, 20), np.ones(18, int)]
    c = c[np.argsort(-(c**2).sum(axis=1))]
    q = c[::40]
    axes = np.linalg.eigh((c.T @ c).astype(float))[1][:, ::-1]
    at, ids, scores = S.best_pairs(q, np.arange(0, 3000, 40), np.full(len(q), -2.0**63), c, np.arange(3000), axes, S.Search(chunk_vectors=128))
    for i in range(len(q)):
        all_scores = c @ q[i]
        best = sorted((-s, j) for j, s in enumerate(all_scores) if j != 40 * i)[:5]
        assert [(-s, j) for s, j in zip(scores[at == i], ids[at == i])] == best
