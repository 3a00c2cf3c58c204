from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from landfall.llm import language_id
from tests.llm import samples, test_jaccard_join, test_line_dedup, test_packing

#: Ids are unique here, and letters tell what the language stage may drop.
ROWS = [r for r in samples.documents()[:-4] if r[0] is not None] + test_jaccard_join.variants(12, 15, 90, 4, 5000)


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = samples.frame(spark, ROWS, clashes=False), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "unused").cache()
        out[name] = docs
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages_and_columns(spark, stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)
    assert list(stages) == ["language_id", "line_dedup", "jaccard_join", "mixing", "best_fit_packing"]
    for name in list(stages)[:-1]:
        assert stages[name].schema.simpleString() == samples.SCHEMA.simpleString()


def test_language_stage_drops_what_is_rejected(spark, stages):
    judged = language_id.identify(
        samples.frame(spark, ROWS), language_id.fit(samples.frame(spark, ROWS).where("crc32(cast(doc_id as string)) % 4 <> 2"))
    ).collect()
    rejected = {r["doc_id"] for r in judged if r["rejected"]}
    assert {i for i, t, *_ in ROWS if not any(c.isalpha() for c in t or "")} <= rejected
    assert {r[0] for r in rows(stages["language_id"])} == {i for i, *_ in ROWS} - rejected
    assert all(r[2] in ("xa", "xb") for r in rows(stages["language_id"]))
    assert len(rejected) < 0.15 * len(ROWS)


def test_line_stage(stages):
    before = rows(stages["language_id"])
    wanted = sorted((i, t) for i, _, _, t in test_line_dedup.expected(before))
    after = rows(stages["line_dedup"])
    assert sorted((r[0], r[1]) for r in after) == wanted
    assert all(r[4] == len(r[1]) for r in after)


def test_near_duplicate_stage(stages):
    before, after = rows(stages["line_dedup"]), rows(stages["jaccard_join"])
    groups = test_jaccard_join.expected(before, 5, 80)
    kept = {c for _, n, c in groups if n} | {i for i, n, _ in groups if not n}
    assert sorted(r[0] for r in after) == sorted(kept)
    assert set(after) <= set(before)


def test_mixing_stage(stages):
    before, after = Counter(rows(stages["jaccard_join"])), Counter(rows(stages["mixing"]))
    assert set(after) <= set(before)
    assert all(after[r] <= 2 * before[r] for r in after)


def test_packing_stage(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    test_packing.check(stages["best_fit_packing"].collect(), rows(stages["mixing"]), tokenizer)


def test_run_writes_and_rereads(spark, tmp_path):
    samples.frame(spark, ROWS).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


def test_no_documents(spark, tmp_path):
    samples.frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
