import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from landfall.llm import packing as P
from tests.llm import samples


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TANGLED = ["", " ", "  two  spaces ", "tab\tand \n newline\n\n end ", "a b c d", "it's don't we'll", "<|endoftext|> x",
           "漢字 и русский 12,345.67 x\x1cy z", "word\r\n word", "…  ", "a   b", "x  <|endoftext|>"]


def test_ids_are_the_tokenizers(tokenizer):
    encode = P.encoder(P.Packing().vocabulary, P.Packing().tokenizer, 50)
    rng = random.Random(2)
    letters = ["a", "B", "é", "漢", "1", ".", "'s", " ", "  ", "\n", "\t", " ", "-", "#"]
    texts = TANGLED + [samples.prose(rng, "xb", 200)] + ["".join(rng.choices(letters, k=40)) for _ in range(500)]
    for text in texts:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        assert encode(text) == ids.tobytes(), text


def test_very_long_runs_of_white_space(tokenizer):
    encode = P.encoder(P.Packing().vocabulary, P.Packing().tokenizer, 50)
    for text in (" " * 2_000_000, "\n" * 2_000_000, "a" + "\t " * 600_000 + "b c<|endoftext|>" + " " * 300_000 + "d", "x " * 300_000):
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def check(out, rows, tokenizer, capacity=1024):
    pieces, places = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    wanted = defaultdict(list)
    for i, t, *_ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        edges = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        wanted[i] += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert {i: sorted(p) for i, p in pieces.items()} == {i: sorted(p) for i, p in wanted.items()}
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(r["length"] for r in out)


def test_documents(spark, tokenizer):
    rows = samples.documents() + [(800 + i, t, None, None, 0) for i, t in enumerate(TANGLED)]
    sequences, tokens = check(P.pack_documents(samples.frame(spark, rows)).collect(), rows, tokenizer)
    assert sequences <= 1.05 * tokens / 1024 + 1


def test_groups_with_gaps_exchange(spark, tokenizer):
    rng = random.Random(8)
    rows = [(i, "a" + " a" * rng.randint(20, 120), None, None, 0) for i in range(600)]
    small = P.Packing(capacity=256, group_pieces=40)
    plain = P.Packing(capacity=256, group_pieces=40, exchanges=0)
    a, _ = check(P.pack_documents(samples.frame(spark, rows), small).collect(), rows, tokenizer, 256)
    b, _ = check(P.pack_documents(samples.frame(spark, rows), plain).collect(), rows, tokenizer, 256)
    assert a < b


def test_copies_of_a_row_are_dealt_to_several_groups(spark):
    rows = [(None, "a a a a a", None, None, 0)] * 600
    pieces = P.tokenised_pieces(samples.frame(spark, rows), P.Packing())
    assert P._dealt(pieces, 8, 0).select("grp").distinct().count() == 8


def test_best_fit_and_bound():
    rng = np.random.default_rng(4)
    for _ in range(50):
        capacity = int(rng.integers(5, 60))
        lengths = rng.integers(1, capacity + 1, rng.integers(0, 80))
        bins, offsets, n = P.best_fit_decreasing(lengths, capacity)
        assert P.lower_bound(lengths, capacity) <= n <= len(lengths)
        fill = np.bincount(bins, lengths, minlength=n) if len(lengths) else np.zeros(0)
        assert (fill <= capacity).all() and (offsets + lengths <= capacity).all()
    # Three halves and a bit cannot share, which the size alone does not show.
    assert P.lower_bound(np.array([6, 6, 6]), 10) == 3


def test_dual_feasible_functions_hold():
    table = P.dual_feasible(12, 8)
    rng = np.random.default_rng(6)
    for _ in range(500):
        left, sizes = 12, []
        while left and rng.random() < 0.9:
            sizes.append(int(rng.integers(1, left + 1)))
            left -= sizes[-1]
        assert (table[:, sizes].sum(axis=1) <= 1 + 1e-9).all()


def test_empty(spark):
    assert P.pack_documents(samples.empty(spark)).collect() == []
