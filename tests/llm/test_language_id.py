import random
import zlib

import numpy as np
import pytest

from landfall.llm import language_id as L
from tests.llm import samples


@pytest.fixture(scope="module")
def predicted(spark):
    return L.predict_languages(samples.frame(spark, samples.documents())).collect()


def test_every_row_is_predicted(predicted):
    rows = samples.documents()
    assert len(predicted) == len(rows)
    languages = {"xa", "xb", "und"}
    for r in predicted:
        assert r["lang_pred"] in languages and 0 <= r["score"] <= 1
        expected = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == expected


def test_undetermined_only_without_letters(predicted):
    texts = {}
    for i, t, *_ in samples.documents():
        texts.setdefault(i, []).append(t)
    for r in predicted:
        letters = [any(c.isalpha() for c in t or "") for t in texts[r["doc_id"]]]
        if all(letters):
            assert r["lang_pred"] != "und"
        if not any(letters):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)


def test_held_out_accuracy(predicted):
    known = {i: lang for i, t, lang, *_ in samples.documents()[:60] if len(t) > 20 and i != 7}
    scored = [r for r in predicted if r["held_out"] and r["doc_id"] in known and r["lang_pred"] != "und"]
    assert len(scored) > 5
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in scored) >= 0.9 * len(scored)


def test_same_model_on_reruns(spark, predicted):
    again = L.predict_languages(samples.frame(spark, samples.documents(), parts=5)).collect()
    assert samples.plain(again) == samples.plain(predicted)


def test_nothing_to_learn(spark):
    assert L.predict_languages(samples.empty(spark)).collect() == []
    rows = [(1, "abc def", None, "s", 7), (2, None, "xa", "s", 0)]
    out = L.predict_languages(samples.frame(spark, rows)).collect()
    assert {(r["lang_pred"], r["rejected"]) for r in out} == {("und", True)}


def test_letters_of_any_script():
    for text, has in (("漢", True), ("é", True), ("12 ,.", False), ("", False), ("– 1", False)):
        assert L.has_letter(np.frombuffer(text.encode(), np.uint8)) is has


def test_pieces_of_a_long_text_count_once():
    data = np.frombuffer(samples.prose(random.Random(1), "xa", 90_000).encode(), np.uint8)
    assert len(data) > 2 * L._PIECE
    at, n = L.subword_counts(data, 1 << 12)
    whole = np.bincount(L.subwords(data, 1 << 12), minlength=1 << 12)
    # Only the few n-grams over the edges of pieces differ.
    counted = np.zeros(1 << 12, int)
    counted[at] = n
    assert abs(counted - whole).sum() <= 20 * (len(data) // L._PIECE + 1)
