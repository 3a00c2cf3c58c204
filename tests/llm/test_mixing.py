import random
import re
from collections import Counter

import pytest

from landfall.llm import mixing as M
from tests.llm import samples


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_sizes_and_limits(spark):
    rows = samples.documents()
    out = M.mix_words(samples.frame(spark, rows)).collect()
    assert samples.plain([(r["doc_id"], r["source"], r["size"]) for r in out]) == sorted(
        ((i, s, size(t)) for i, t, _, s, _ in rows), key=repr
    )
    words, taken, target = Counter(), Counter(), {}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        words[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for r in out:
        assert r["source_size"] == words[r["source"]]
    assert sum(target.values()) == pytest.approx(1.5 * sum(words.values()))
    for s in words:
        assert target[s] <= 2 * words[s] + 1e-6
        assert abs(taken[s] - target[s]) <= 32


def test_targets_by_water_filling():
    # Order by code point, null last; the second source is held at twice its size.
    assert M.targets([100, 5, 100], [3, 1, 2], 300, [200, 10, 200]) == pytest.approx([174, 10, 116])
    assert M.targets([0, 0], [3, 1], 0, [0, 0]) == [0, 0]
    assert M.targets([], [], 0, []) == []


def test_apportionment_deals_seat_by_seat():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 7)
        weights = [rng.choice([0, 1, rng.random() * 50]) for _ in range(n)]
        caps, seats = [rng.randint(0, 9) for _ in range(n)], rng.randint(0, 30)
        held = [0] * n
        for _ in range(seats):
            free = [i for i in range(n) if held[i] < caps[i] and weights[i] > 0]
            if not free:
                break
            best = max(free, key=lambda i: (weights[i] / (2 * held[i] + 1), -i))
            held[best] += 1
        assert M.apportion(weights, seats, caps) == held


def test_reruns_and_layout_agree(spark):
    rows = samples.documents()
    a = M.mix_words(samples.frame(spark, rows, parts=2)).collect()
    b = M.mix_words(samples.frame(spark, rows, parts=7)).collect()
    assert samples.plain(a) == samples.plain(b)


def test_many_shards(spark):
    rows = [(i, "w " * (i % 50), None, "hot" if i % 3 else "rest", 0) for i in range(3000)]
    mix = M.Mix(shard_documents=100)
    out = M.mix_words(samples.frame(spark, rows), mix).collect()
    taken, target = Counter(), {}
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)


def test_documents_of_the_mix(spark):
    rows = samples.documents()
    docs = samples.frame(spark, rows)
    out = M.mix_documents(docs, M.Mix(block_words=8))
    assert out.columns == docs.columns
    given, copies = Counter(tuple(r) for r in docs.collect()), Counter(tuple(r) for r in out.collect())
    assert set(copies) <= set(given)
    assert all(copies[r] <= 2 * given[r] for r in copies)
    assert all(size(r[1]) for r in copies)


def test_plan_is_native(spark):
    for df in (M.mix_words(samples.frame(spark, samples.documents())), M.mix_documents(samples.frame(spark, samples.documents()))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_empty(spark):
    assert M.mix_words(samples.empty(spark)).collect() == []
    assert M.mix_documents(samples.empty(spark)).collect() == []
    silent = samples.frame(spark, [(1, None, None, "s", 0), (2, "", None, None, 0)])
    assert {r["taken"] for r in M.mix_words(silent).collect()} == {0}
