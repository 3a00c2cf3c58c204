"""What operators learn from the given documents and labels."""

import pytest
from pyspark.sql import functions as F

from landfall.llm import language_id as L
from landfall.llm import quality_rules as R
from landfall.llm.common import held_out

TABLES = ["/root/testdata/sf0.01", "/root/testdata/sf0.1"]

#: Texts in languages that the documents do not hold, and keyboard noise.
FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах.",
    "asdfkjh qwpoeiru zxmcnvb qpwoeiruty lkjhgfdsa mznxbcv alskdjfhg qpalzm",
]


@pytest.fixture(params=TABLES)
def tables(spark, request):
    return tuple(spark.read.parquet(f"{request.param}/{t}.parquet") for t in ("documents", "labels"))


def test_unlearned_languages_are_rejected(spark, tables):
    docs, _ = tables
    model = L.fit(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    foreign = spark.createDataFrame([(i, t) for i, t in enumerate(FOREIGN)], "doc_id long, text string")
    assert [r["rejected"] for r in L.identify(foreign, model).orderBy("doc_id").collect()] == [True] * len(FOREIGN)
    unseen = docs.where(held_out(F.col("doc_id"), 4, 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    judged = L.identify(unseen, model, ("doc_id", "lang")).collect()
    assert len(judged) > 100
    assert sum(r["rejected"] for r in judged) <= 0.01 * len(judged)
    assert sum(r["lang_pred"] == r["lang"] for r in judged) >= 0.99 * len(judged)


def test_learned_rules_beat_the_fixed_ones_on_labels_kept_aside(spark, tables):
    docs, labels = tables
    aside = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    rules = R.learn(R.labelled_sample(docs, labels.where(~aside), R.Learning()), R.Learning())
    assert rules
    judged = docs.join(labels.where(aside).select("doc_id", "quality"), "doc_id")
    rows = R.apply_rules(judged, rules, ("doc_id", "quality")).collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rows)
    assert right > sum((not r["base_failed"]) == (r["quality"] == 1) for r in rows)
    assert sum(r["rule"] is not None and r["quality"] == 1 for r in rows) <= 0.01 * len(rows)
