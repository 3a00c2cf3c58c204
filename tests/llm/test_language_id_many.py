"""Many languages, in files grouped by language: each is learned."""

import random

import pytest

from landfall.llm import language_id as L
from tests.llm import samples

TRAINING = L.Training(max_sample=200, buckets=1 << 10, epochs=1)


def rows(languages, texts):
    rng = random.Random(9)
    return [(None if i % 2 else i, samples.prose(rng, "xa", 12) + f" l{lang}", f"l{lang:03}", "s", 0)
            for lang in range(languages) for i in range(texts)]


def test_every_language_is_in_a_bounded_sample(spark):
    df = spark.createDataFrame(rows(40, 30), samples.SCHEMA).coalesce(1)
    found = L.sample_features(df, TRAINING)
    assert {r["lang"] for r in found} == {f"l{k:03}" for k in range(40)}
    assert len(found) <= 2 * (200 * 5 // 4 + 100)
    assert set(L.train(found, TRAINING).languages) == {r["lang"] for r in found}


def test_more_than_500_languages(spark):
    df = spark.createDataFrame(rows(600, 2), samples.SCHEMA)
    found = L.sample_features(df, L.Training(buckets=1 << 10))
    assert len({r["lang"] for r in found}) == 600


def test_beyond_the_bound_is_an_error(spark):
    df = spark.createDataFrame(rows(201, 1), samples.SCHEMA)
    with pytest.raises(ValueError, match="languages"):
        L.sample_features(df, TRAINING)


def test_copies_do_not_fill_the_sample(spark):
    df = spark.createDataFrame([(1, "bado kimu", "a", "s", 0)] * 3000 + rows(3, 5), samples.SCHEMA)
    assert {r["lang"] for r in L.sample_features(df, TRAINING)} == {"a", "l000", "l001", "l002"}
