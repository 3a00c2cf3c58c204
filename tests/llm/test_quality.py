import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm import quality_classifier as Q
from landfall.llm import quality_rules as R
from tests.llm import samples

WHITE = " \t\n\x0b\x0c\r"


def junk(rng, n):
    return " ".join(rng.choice(samples.WORDS["xa"]) + rng.choice(["###", "$$$", "%%%", "&&&"]) for _ in range(n))


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        rows.append((1000 + i, junk(rng, 120) if bad else samples.prose(rng, rng.choice(["xa", "xb"]), 120), None, "s", 0))
        labels.append((1000 + i, 0 if bad else 1, 0))
    return rows + samples.documents(), labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels + [(None, 1, 0), (5, None, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")


def counts(text):
    text = text or ""
    words = [w for w in "".join(" " if c in WHITE else c for c in text).split(" ") if w]
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    inside = {p + k for at in grams.values() if len(at) > 1 for p in at for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def test_counts_and_fixed_rules(spark, labelled):
    rows, labels = labelled
    extra = [(5001, "a b c a b c a b c", None, None, 0), (5002, "x y z w x y z", None, None, 0),
             (5003, "  lead\x0btrail é漢😀 \r\n", None, None, 0), (5004, "l l\n l l\nl l\nl l", None, None, 0)]
    out = R.judge(samples.frame(spark, rows + extra), label_frame(spark, labels)).collect()
    expected = sorted(((i, *counts(t)) for i, t, *_ in rows + extra), key=repr)
    assert samples.plain([tuple(r[c] for c in ("doc_id", *R.BASE)) for r in out]) == expected
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_rules_part_good_from_bad(spark, labelled):
    rows, labels = labelled
    quality = dict((i, q) for i, q, _ in labels)
    out = R.judge(samples.frame(spark, rows), label_frame(spark, labels)).collect()
    judged = [r for r in out if r["doc_id"] in quality and not r["base_failed"]]
    assert sum(r["kept"] == (quality[r["doc_id"]] == 1) for r in judged) >= 0.97 * len(judged)


def test_rules_without_labels_and_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert R.judge(samples.empty(spark), none).collect() == []
    out = R.judge(samples.frame(spark, samples.documents()), none).collect()
    assert all(r["kept"] != r["base_failed"] for r in out)


def test_rules_plan_is_native(spark, labelled):
    rows, labels = labelled
    df = R.judge(samples.frame(spark, rows), label_frame(spark, labels))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_rules_are_tried_in_order(spark):
    rules = [(R.Condition("symbol_share", True, 0.5),), (R.Condition("word_length", False, 3.0), R.Condition("bar_share", False, 0.5))]
    df = spark.createDataFrame([(1, 10, 8, 0, 3), (2, 10, 1, 0, 5), (3, 50, 0, 0, 10)], "id int, word_chars long, n_symbols long, n_bars long, n_words long")
    assert [r[0] for r in df.select(R.verdict(rules)).collect()] == [0, 1, None]


def test_classifier_scores(spark, labelled):
    rows, labels = labelled
    quality = dict((i, q) for i, q, _ in labels)
    out = Q.classify_quality(samples.frame(spark, rows), label_frame(spark, labels)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    judged = [r for r in out if r["held_out"] and r["doc_id"] in quality]
    assert sum(r["predicted"] == quality[r["doc_id"]] for r in judged) >= 0.97 * len(judged)


def test_classifier_ignores_held_out_labels(spark, labelled):
    rows, labels = labelled
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    turned = [(i, 1 - q if held(i) else q, t) for i, q, t in labels]
    a, b = (Q.classify_quality(samples.frame(spark, rows), label_frame(spark, x)).collect() for x in (labels, turned))
    rounded = lambda out: samples.plain([(r["doc_id"], round(r["score"], 6)) for r in out])
    assert rounded(a) == rounded(b)


def test_classifier_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.classify_quality(samples.empty(spark), none).collect() == []
    out = Q.classify_quality(samples.frame(spark, samples.documents()), none).collect()
    assert {r["score"] for r in out} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    out = Q.classify_quality(samples.frame(spark, samples.documents()), one).collect()
    assert all(np.isfinite(r["score"]) for r in out)


def test_log_odds_match_densities():
    rng = np.random.default_rng(0)
    d = len(Q.FEATURES)
    mean, cov = rng.normal(size=(2, d)), np.array([np.cov(rng.normal(size=(d, 50))) + np.eye(d) for _ in range(2)])
    model = Q.Classifier(mean, np.linalg.cholesky(cov), np.linalg.slogdet(cov)[1], np.log([0.3, 0.7]), 1, 0)
    x = rng.normal(size=(5, d))
    density = [
        -0.5 * (np.einsum("ij,jk,ik->i", x - mean[c], np.linalg.inv(cov[c]), x - mean[c]) + np.linalg.slogdet(cov[c])[1])
        for c in (0, 1)
    ]
    assert np.allclose(Q.log_odds(model, x), density[1] - density[0] + np.log(0.7 / 0.3))
