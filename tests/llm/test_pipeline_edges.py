"""The stages on null ids, repeated rows, null and empty texts, and columns of clashing names."""

from collections import Counter

import pytest

import corpus_pipeline
from landfall.llm import language_id
from tests.llm import samples, test_jaccard_join, test_line_dedup

ROWS = samples.documents() + [(None, t, "xb", None, 1) for t in ("one more text", "one more text", "", None)]
NAMES = [f.name for f in samples.SCHEMA] + list(samples.CLASHES)


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = samples.frame(spark, ROWS).cache(), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "unused").cache()
        out[name] = docs
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_columns_of_clashing_names_are_kept(stages):
    for name in list(stages)[:-1]:
        assert stages[name].columns == NAMES
        assert all(r[5:] == tuple(f"{c}!" for c in samples.CLASHES) for r in rows(stages[name]))


def test_language_stage_keeps_repeated_rows(spark, stages):
    docs = stages["documents"]
    model = language_id.fit(docs.where("doc_id is null or crc32(cast(doc_id as string)) % 4 <> 2"))
    judged = language_id.identify(docs, model, ("doc_id", "text"))
    wanted = Counter((r["doc_id"], r["text"]) for r in judged.collect() if not r["rejected"])
    assert Counter(r[:2] for r in rows(stages["language_id"])) == wanted
    assert None in {i for i, _ in wanted} and max(wanted.values()) > 1


def test_line_stage_keeps_all_rows(stages):
    before, after = rows(stages["language_id"]), rows(stages["line_dedup"])
    wanted = Counter((i, t) for i, _, _, t in test_line_dedup.expected([r[:5] for r in before]))
    assert Counter((r[0], r[1] or "") for r in after) == wanted


def test_one_row_of_each_group_stays(stages):
    before, after = rows(stages["line_dedup"]), rows(stages["jaccard_join"])
    assert not Counter(after) - Counter(before)
    # With ids of their own, all rows of a component show the place of its first row.
    numbered = [(k, *r[1:5]) for k, r in enumerate(before)]
    place = {k: c for k, n, c in test_jaccard_join.expected(numbered, 5, 80) if n}
    ids: dict[int, list] = {}
    for k, c in place.items():
        ids.setdefault(c, []).append(before[k][0])
    least = [min((i for i in group if i is not None), default=None) for group in ids.values()]
    wordless = [r[0] for k, r in enumerate(before) if k not in place]
    assert Counter(r[0] for r in after) == Counter(least + wordless)


def test_mix_takes_rows_at_most_twice(stages):
    before, after = Counter(rows(stages["jaccard_join"])), Counter(rows(stages["mixing"]))
    assert all(n <= 2 * before[r] for r, n in after.items())
    assert all((r[1] or "").split() for r in after)


def test_every_row_is_packed(stages):
    pieces, docs = stages["best_fit_packing"].collect(), rows(stages["mixing"])
    assert Counter(p["doc_id"] for p in pieces if p["piece"] == 0) == Counter(r[0] for r in docs)
    sequences: dict[int, list] = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 1024
