import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from landfall.llm import source_divergence as D
from landfall.llm.registry import ORACLE_SQL
from tests.llm import samples

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def expected(rows, ranks=200):
    """Every pair over every kept term, in Python's integers. rows: (doc_id, text, lang, source, n_chars)."""
    groups, docs, counts = defaultdict(set), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        total = Counter()
        for s in sources:
            total.update({t: counts[lang, s][t] for t in kept})

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(total)
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, r + 1) for r, (v, item) in enumerate(found[:most])]
    return samples.plain(out)


def audit(spark, rows, how=D.Audit()):
    return samples.plain(D.audit_sources(samples.frame(spark, rows), how).collect())


def skewed(n=250, seed=5):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdeféß漢" for b in "xyzŁ"] + ["The", "THE", "the", "É", "é"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "en", "en", "de"]), "hot" if i % 3 == 0 else f"s{rng.randint(0, 12)}", 0))
    rows += [(900 + i, "the the-copy_of A1b2\x7fc\x00d " * 30, "en", "s1", 0) for i in range(150)]
    return rows


def test_edge_cases_against_brute_force(spark):
    rows = samples.documents()
    rows += [(900, "!!! 12", "zz", "lone", 0), (901, None, "zz", "other", 0), (902, "once only", "yy", "a", 0), (903, "", "yy", "b", 0)]
    assert audit(spark, rows) == expected(rows)


def test_skewed_sources_against_brute_force_and_sql(spark):
    rows = skewed()
    wanted = expected(rows)
    assert audit(spark, rows) == wanted
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [(i, t and t.replace("\x00", "\x01"), *x) for i, t, *x in rows])
    assert samples.plain(con.execute(ORACLE_SQL["op13_source_divergence"]).fetchall()) == wanted


def test_small_steps_and_shuffled_groups(spark, monkeypatch):
    rows = skewed(120)
    wanted = expected(rows, 7)
    monkeypatch.setattr(D, "is_small", lambda df: False)
    assert audit(spark, rows, D.Audit(term_ranks=7, held_terms=10, combinations=3)) == wanted


def test_empty(spark):
    assert audit(spark, []) == []
    nothing = [(1, None, None, None, 0), (None, None, None, None, None), (2, "a b", None, "s", 0)]
    assert audit(spark, nothing) == expected(nothing)


def test_shared_paths_are_counted_once():
    """Three rows share their first two items; the pair of these is one combination."""
    tree = D._Tree(10**6)
    a, b, c, d = ("s1", 900, 10), ("s2", 800, 20), ("s3", 700, 30), ("s3", 650, 30)
    tree.lang = "en"
    for items, terms in (([a, b], 5), ([a, b, c], 1), ([a, b, d], 7)):
        tree.insert(items, terms)
    assert len(tree.rows) == 4 and tree.n_combinations == 1 + 2 + 2
    assert tree.rows == [13, 13, 1, 7]

    def gap(x, y):
        return (x - y) ** 2 // y

    def both(one, other):
        return gap(one[1], other[1]) - gap(one[1], other[2]) - gap(one[2], other[1]) + gap(one[2], other[2])

    found = {(r["source"], r["item"]): int(r["value"]) for r in tree.corrections().to_pylist()}
    assert found["s1", "s2"] == 13 * both(a, b) and found["s2", "s1"] == 13 * both(b, a)
    assert found["s1", "s3"] == both(a, c) + 7 * both(a, d) and found["s3", "s2"] == both(c, b) + 7 * both(d, b)
    assert tree.rows == [] and tree.corrections() is None


def test_sums_of_large_gaps_are_exact():
    rng = np.random.default_rng(1)
    tree, wanted = D._Tree(10**9), Counter()
    tree.lang = "x"
    rows = sorted([("a", int(p), 1), ("b", int(q), 2)] for p, q in rng.integers(1, 10**9, (300, 2)))
    for items in rows:
        tree.insert(items, 10**6)
        (_, p, bp), (_, q, bq) = items
        wanted["a", "b"] += 10**6 * ((p - q) ** 2 // q - (p - bq) ** 2 // bq - (bp - q) ** 2 // q + (bp - bq) ** 2 // bq)
    assert {(r["source"], r["item"]): int(r["value"]) for r in tree.corrections().to_pylist()}["a", "b"] == wanted["a", "b"]
