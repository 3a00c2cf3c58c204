"""Ids are those of the tokenizer file with default settings, also of texts that hold its added token."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from landfall.llm import packing as P
from tests.llm import samples

END = "<|endoftext|>"
TEXTS = [END, END * 3, f" {END} ", f"a{END}b", f"a {END} b", f"two  {END}\n\n{END}\tend ", f"<|{END}|>", "<|endoftext|", f"x {END[:-1]}{END}",
         f"it{END}'s", f"漢{END}é  ", "<|ENDOFTEXT|>", f"w {END} " * 900]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(tokenizer, text):
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


def test_added_token_has_its_id(tokenizer):
    packing, rng = P.Packing(), random.Random(5)
    encode = P.encoder(packing.vocabulary, packing.tokenizer, 50)
    parts = [END, "a", "é", "漢", "1", ".", "'s", " ", "  ", "\n", "<|", "|>", "endoftext"]
    for text in TEXTS + [samples.prose(rng, "xb", 200)] + ["".join(rng.choices(parts, k=30)) for _ in range(500)]:
        assert encode(text) == ids(tokenizer, text).tobytes(), text
    assert encode(END) == np.array([50256], "<u4").tobytes()


def test_pieces_of_documents(spark, tokenizer):
    rows = [(i, text, None, None, 0) for i, text in enumerate(TEXTS)]
    wanted = []
    for i, text, *_ in rows:
        t = np.array([*ids(tokenizer, text), 2], "<u4")
        edges = [0, *range((len(t) - 1) % 1024 + 1, len(t) + 1, 1024)]
        wanted += [(i, k, a, b - a, zlib.crc32(t[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    out = P.pack_documents(samples.frame(spark, rows)).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert samples.plain(out.collect()) == samples.plain(wanted)


def test_tokens_that_match_by_other_rules_are_refused(tmp_path):
    (tmp_path / "t.json").write_text('{"added_tokens": [{"id": 1, "content": "x", "single_word": false, "lstrip": true, "rstrip": false, "normalized": false}]}')
    with pytest.raises(ValueError, match="other rules"):
        P.added_tokens(str(tmp_path / "t.json"))
