import random

import numpy as np
import pytest

from landfall.llm import jaccard_join as J
from landfall.llm.components import connected_components
from tests.llm import samples


def sets(rows, words):
    out = []
    for i, t, *_ in rows:
        w = [x for x in (t or "").translate({c: c + 32 for c in range(65, 91)}).translate(dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")).split(" ") if x]
        k = min(words, len(w))
        out.append((i, {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if w else set()))
    return out


def expected(rows, words=3, percent=90):
    own = sets(rows, words)
    up = list(range(len(own)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, (_, a) in enumerate(own):
        for y in range(x):
            b = own[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(own):
        if i is not None:
            least[root(x)] = min(i, least.get(root(x), i))
    return sorted(((i, len(s), least.get(root(x))) for x, (i, s) in enumerate(own)), key=repr)


def variants(seed, n, words, edits, base_id):
    """Copies of one text with a few words changed in each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    rows = []
    for k in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        rows.append((base_id + k, " ".join(text), None, None, 0))
    return rows


def test_matches_brute_force(spark):
    rows = samples.documents() + variants(1, 40, 120, 5, 1000) + variants(2, 30, 60, 3, 2000) + variants(3, 20, 12, 1, 3000)
    out = J.linked_documents(samples.frame(spark, rows)).collect()
    assert samples.plain(out) == expected(rows)
    assert len({r["component_id"] for r in out if (r["doc_id"] or 0) >= 1000}) > 3


@pytest.mark.parametrize("rare, first_block, block", [(2, 4, 3), (1000, 3, 512)])
def test_small_bounds_lose_no_link(spark, rare, first_block, block):
    """Groups far beyond their bounds go by other ways to the same result."""
    rng = random.Random(9)
    shared = " ".join(f"s{k}" for k in range(50))
    rows = variants(4, 60, 80, 4, 0) + variants(5, 60, 40, 3, 100)
    rows += [(200 + k, shared + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.randint(1, 9))), None, None, 0) for k in range(60)]
    join = J.Join(rare=rare, first_block=first_block, block=block, group_rows=10, broadcast_rows=0)
    assert samples.plain(J.linked_documents(samples.frame(spark, rows), join).collect()) == expected(rows)


def test_five_words(spark):
    rows = samples.documents() + variants(6, 30, 100, 6, 1000)
    join = J.Join(words=5, percent=80)
    assert samples.plain(J.linked_documents(samples.frame(spark, rows), join).collect()) == expected(rows, 5, 80)


def test_one_of_each_group_stays(spark):
    # Without the row whose id is that of another text, so a component's smallest id is its own.
    rows = samples.documents()[:-1] + variants(7, 20, 100, 4, 1000)
    docs = samples.frame(spark, rows)
    out = J.keep_one_each(docs)
    assert out.columns == docs.columns
    kept = sorted((r["doc_id"] for r in out.where("text rlike '[^ \\\\s]'").collect()), key=repr)
    assert kept == sorted({c for _, n, c in expected(rows, 5, 80) if n}, key=repr)
    assert out.where("text is null or not text rlike '[^ \\\\s]'").count() == sum(not n for _, n, _ in expected(rows, 5, 80))


def test_tree_finds_all_components():
    rng = np.random.default_rng(8)
    for percent in (50, 80, 90):
        base = rng.integers(0, 2**63, 40, dtype=np.uint64)
        groups = [
            np.unique(np.r_[rng.choice(base, rng.integers(25, 41), replace=False), rng.integers(0, 2**63, rng.integers(0, 8), dtype=np.uint64)])
            for _ in range(60)
        ]
        up = list(range(60))

        def root(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for i, j in J.tree_links(groups, list(range(60)), percent):
            up[max(root(i), root(j))] = min(root(i), root(j))
        for i in range(60):
            for j in range(i):
                both = len(np.intersect1d(groups[i], groups[j]))
                if 100 * both >= percent * (len(groups[i]) + len(groups[j]) - both):
                    assert root(i) == root(j)


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 600)]
    out = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    up = {}
    for a, b in links:
        up.setdefault(a, a), up.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(up[a], up[b])
            changed |= up[a] != m or up[b] != m
            up[a] = up[b] = m
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in out} == {n: r for n, r in up.items() if n not in loops}
    assert len(out) == len({r["node"] for r in out})


def test_empty(spark):
    assert J.linked_documents(samples.empty(spark)).collect() == []
    assert J.keep_one_each(samples.empty(spark)).collect() == []


def test_many_rows_without_an_id(spark):
    rows = [(None, *r[1:]) for r in variants(10, 60, 60, 3, 0) + variants(11, 60, 60, 40, 0)]
    rows += variants(12, 20, 60, 3, 100) + [(7, "one row of six words here", None, None, 0)] * 40
    rows += [rows[0]] * 30 + [(7, f"clashing id {k} " + rows[0][1], None, None, 0) for k in range(20)]
    docs = samples.frame(spark, rows)
    assert samples.plain(J.linked_documents(docs).collect()) == expected(rows)
    # Each row meets the class of its own text alone.
    sets = J.shingle_sets(docs, J.frequency_classes(docs, J.Join()), J.Join())
    met = J.keyed(docs).join(J.shingle_classes(sets), ["doc", "row"])
    assert met.count() <= len(rows)


def test_of_equal_rows_the_same_one_stays(spark):
    rows = [(None, "Five or six words of it", lang, s, 1) for lang in ("xb", "xa", None) for s in ("s2", None, "s1")]
    rows += [(3, "five OR six words  of the", "xa", s, 1) for s in ("b", "a")]
    kept = {tuple(map(tuple, J.keep_one_each(samples.frame(spark, x, parts=p)).select("doc_id", "text", "lang", "source").orderBy("text").collect()))
            for x in (rows, rows[::-1]) for p in (1, 4)}
    assert len(kept) == 1
