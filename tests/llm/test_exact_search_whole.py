"""Long vectors and repeated ids: every finite row counts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from landfall.llm import exact_search as S
from tests.llm import samples


def search(spark, rows, kind="double", **bounds):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    return samples.plain(S.search_top_k(df, F.col("vec_id") % 50 == 0, S.Search(**bounds)).collect())


def expected(rows, k=5):
    """Every pair of a query row and a row with another id, as in the SQL twin, in Python's integers."""
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(x * 256) if abs(x) < 2**53 else int(x) * 256 for x in v]) for i, v in ok]
    out = []
    for q in {i for i, _ in ints if i % 50 == 0}:
        pairs = [(-sum(a * b for a, b in zip(u, v)), j) for i, u in ints if i == q for j, v in ints if j != q]
        out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(sorted(pairs)[:k])]
    return samples.plain(out)


def rows(n=120, d=6):
    rng = random.Random(4)
    out = [(i, [float(rng.randint(-900, 900)) / 64 for _ in range(d)]) for i in range(n)]
    out += [(j % n, [x + 1 for x in v]) for j, v in out[:60]]  # other vectors with known ids
    out += [out[0], out[0], out[7], out[7]]
    # Long ones, also queries; scores are beyond the precision of doubles.
    out += [(450, [2e6] + [0.0] * 5), (451, [2e6 + 4] + [0.0] * 5), (452, [-3e7] + [1.0] * 5), (453, [6e7, 0.125] + [0.0] * 4)]
    out += [(454, [6e7, 0.25] + [0.0] * 4), (500, [0.0] * 5 + [2.0**20 + 1 / 256]), (501, [0.0] * 5 + [2.0**26 + 1])]
    out += [(None, [2e7] * d), (503, [float("inf")] * d)]
    return out


def test_long_vectors_and_repeated_ids_count(spark):
    for bounds in ({}, {"block_vectors": 60, "query_vectors": 3, "chunk_vectors": 16}):
        found = search(spark, rows(), **bounds)
        assert found == expected(rows())
        assert {451, 453} <= {r[2] for r in found}


def test_largest_floats(spark):
    # Floored on both sides, products of the largest floats with small components fit or do not matter.
    few = [(0, [0.0, 1.0]), (1, [3e38, 2.0]), (2, [-3e38, 3.0]), (50, [-1.0, 0.0]), (3, [0.0, 2e5])]
    assert search(spark, few[:3] + few[4:], "float") == expected(few[:3] + few[4:])
    with pytest.raises(Exception, match="does not fit 64 bits"):
        search(spark, few, "float")
    with pytest.raises(Exception, match="does not fit 64 bits"):
        search(spark, [(0, [1.0]), (1, [-1e300])])
    # What does not fit and is not among the best is no error.
    assert [r[2] for r in search(spark, [(0, [1.0]), (9, [-1e308]), *[(i, [1.0]) for i in range(1, 6)]])] == [1, 2, 3, 4, 5]
    # Terms that do not fit cancel.
    assert search(spark, [(0, [1.0, 1.0, 1.0]), (1, [1e308, -1e308, 1.0])]) == [(0, 1, 1, 65536)]
