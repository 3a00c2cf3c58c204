import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from landfall.llm import suffix_dedup as D
from tests.llm import samples


def expected(rows, length=200):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(t[a : a + length] for _, t in texts for a in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for a in range(len(t) - length + 1):
            if seen[t[a : a + length]] > 1:
                gone[a : a + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def planted(seed, n):
    """Random texts that share passages of about the length, cut at random places."""
    rng = random.Random(seed)
    letters = "abcdefgh é\n"
    text = lambda k: "".join(rng.choices(letters, k=k))
    passages = [text(rng.randint(150, 700)) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, 80)
            parts += [text(rng.randint(0, 300)), p[a : len(p) - rng.randint(0, 80)]]
        rows.append((i, "".join(parts), None, None, 0))
    return rows


def run(spark, rows, **bounds):
    return samples.plain(D.dedup_digests(samples.frame(spark, rows), D.Dedup(**bounds)).collect())


def test_matches_brute_force(spark):
    rows = samples.documents() + [(1000 + i, *r[1:]) for i, r in enumerate(planted(1, 80))]
    assert run(spark, rows) == expected(rows)


@pytest.mark.parametrize("bounds", [{"bucket_spans": 3}, {"batch_spans": 5}, {"segment": 90}, {"cover": 7, "gram": 150}, {"gram": 8, "cover": 183}])
def test_bounds_do_not_change_the_result(spark, bounds):
    rows = planted(2, 60)
    assert run(spark, rows, **bounds) == expected(rows)


def test_edges_of_the_length(spark):
    rng = random.Random(5)
    x = "".join(rng.choices("abcdefghijklmnop", k=201))
    rows = [(1, x[:200], None, None, 0), (2, "q" + x[:200] + "r", None, None, 0), (3, x[1:200], None, None, 0), (4, "z" + x[1:201], None, None, 0),
            (5, "ab" * 101, None, None, 0), (6, "c" * 199, None, None, 0), (7, "d" * 201, None, None, 0), (8, "é" * 100, None, None, 0), (9, "é" * 100, None, None, 0)]
    assert run(spark, rows) == expected(rows)


def test_hot_passage(spark):
    rng = random.Random(6)
    hot = "".join(rng.choices("abcdefghijklmnop ", k=450))
    rows = [(i, f"{i} " + hot + f" {i * i}", None, None, 0) for i in range(600)]
    assert run(spark, rows) == expected(rows)
    assert run(spark, rows, bucket_spans=50) == expected(rows)


def test_covers_and_shifts():
    for period in (7, 13, 31, 64):
        cover = D.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
        for i in range(period):
            j = (3 * i + 1) % period
            s = D.cover_shift(i, j, period)
            assert (i + s) % period in cover and (j + s) % period in cover


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None, None, 0), (None, "", None, None, 0)]) == expected([(1, None), (None, "")])


def test_copies_of_a_row_bring_each_range_once(spark):
    rng = random.Random(8)
    own = "".join(rng.choices("abcdefghijklmnop ", k=3000))
    edge = (2, "x" * 20 + own[700:1100] + "y" * 30, None, None, 0)
    rows = [(1, own, None, None, 0)] * 200 + [(None, own, None, None, 0)] * 50 + [edge]
    assert run(spark, rows) == expected(rows)
    docs = samples.frame(spark, rows).selectExpr("coalesce(doc_id, -1) as doc", "xxhash64(doc_id, text) as row", "text")
    ranges = D.covered_ranges(docs, D.Dedup()).collect()
    assert len(ranges) == 3
    assert max(len(r["starts"]) for r in ranges) < 50
