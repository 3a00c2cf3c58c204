"""Best-fit packing of tokenised documents into sequences of equal capacity.

Documents are tokenised and cut into pieces of at most the capacity. The pieces are dealt
to groups of bounded size, and best-fit decreasing packs each group. Dual-feasible
functions bound from below how many sequences a group needs; a group that meets its bound
is certified and done. Groups with a gap exchange their pieces: these are dealt anew to
fewer, larger groups and packed again, and the new packing stands if it needs fewer
sequences in all.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landfall.llm.common import stored

#: White space beside a space, or a space at either end: such texts are not split at spaces.
_TANGLED = re.compile(r"\s | \s|\A | \Z")
_BLANK = re.compile(r"\s+")
#: The rank encoder's pattern backtracks over a run of white space and breaks on runs of around a million.
_LONG_BLANK = 100_000


@dataclass(frozen=True)
class Packing:
    capacity: int = 1024
    end_id: int = 2
    # The ranks of the vocabulary in byte_bpe_50k.json, which give the same ids.
    vocabulary: str = public_tokenizers.path("byte_bpe_50k.tiktoken")
    # Its added tokens, which are matched inside texts.
    tokenizer: str = public_tokenizers.path("byte_bpe_50k.json")
    group_pieces: int = 32768  # of a group at first; doubles with each exchange
    exchanges: int = 2
    cached_words: int = 150_000  # ids of so many words are kept by a worker


class _Words(dict):
    """Ids, as little-endian unsigned 32-bit bytes, of words with a prefix."""

    def __init__(self, encode: Callable[[str], list[int]], prefix: str, bound: int):
        super().__init__()
        self.encode, self.prefix, self.bound = encode, prefix, bound

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.bound:
            self.clear()
        ids = self[word] = array("I", self.encode(self.prefix + word)).tobytes()
        return ids


class Encoder:
    """Byte-level BPE of text without added tokens.

    A single space between two other characters always begins a token, so a text can be
    encoded word by word, and the words' ids can be kept. Texts with a very long run of
    white space go through the JSON file's own tokenizer.
    """

    def __init__(self, vocabulary: str, tokenizer: str, cached_words: int):
        self.tokenizer = tokenizer
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.encode = encoding.encode_ordinary
        self.first = _Words(self.encode, "", cached_words // 10)
        self.later = _Words(self.encode, " ", cached_words)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if len(text) >= _LONG_BLANK and any(m.end() - m.start() >= _LONG_BLANK for m in _BLANK.finditer(text)):
            return array("I", json_tokenizer(self.tokenizer).encode(text, add_special_tokens=False).ids).tobytes()
        if _TANGLED.search(text):
            return array("I", self.encode(text)).tobytes()
        first, *later = text.split(" ")
        return self.first[first] + b"".join(map(self.later.__getitem__, later))


@lru_cache(maxsize=1)
def json_tokenizer(tokenizer: str) -> Tokenizer:
    return Tokenizer.from_file(tokenizer)


def added_tokens(tokenizer: str) -> dict[str, int]:
    """Ids of the added tokens that a JSON file lists; only such as match any occurrence as it stands."""
    with open(tokenizer, encoding="utf-8") as file:
        listed = json.load(file)["added_tokens"]
    for token in listed:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"added token {token['content']!r} matches by other rules")
    return {token["content"]: token["id"] for token in listed}


class AddedTokens:
    """Encoder of the texts between added tokens, which have ids of their own."""

    def __init__(self, encode: Callable[[str], bytes], tokens: dict[str, int]):
        self.encode = encode
        self.ids = {token: array("I", [i]).tobytes() for token, i in tokens.items()}
        # At one place the longest token matches.
        longest_first = sorted(tokens, key=len, reverse=True)
        self.pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if tokens else None

    def __call__(self, text: str) -> bytes:
        if not self.pattern or not self.pattern.search(text):
            return self.encode(text)
        # Odd places of the split are the tokens.
        parts = self.pattern.split(text)
        return b"".join(self.ids[part] if i % 2 else self.encode(part) for i, part in enumerate(parts))


@lru_cache(maxsize=1)
def encoder(vocabulary: str, tokenizer: str, cached_words: int) -> AddedTokens:
    return AddedTokens(Encoder(vocabulary, tokenizer, cached_words), added_tokens(tokenizer))


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenised_pieces(docs: DataFrame, packing: Packing) -> DataFrame:
    """One row per piece: its place in the document's ids, its length and a checksum of its ids.

    The ids are those of the JSON tokenizer without special tokens at the ends; an added
    token's string inside a text is that token.
    """
    size = packing.capacity
    end = array("I", [packing.end_id]).tobytes()
    names = [f.split()[0] for f in _PIECES.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(packing.vocabulary, packing.tokenizer, packing.cached_words)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                first = (total - 1) % size + 1
                edges = [0, *range(first, total + 1, size)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    for column, value in zip(rows, (doc_id, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, _PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, and the number of bins. Ties go by position."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0  # rooms: a bit for each free room that some bin has
    order = np.argsort(-lengths, kind="stable")
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at, n = capacity, n, n + 1
        bins[i], offsets[i] = at, capacity - room
        if room > length:
            by_room[room - length].append(at)
            rooms |= 1 << (room - length)
    return bins, offsets, n


@lru_cache(maxsize=4)
def dual_feasible(capacity: int, steps: int = 40) -> np.ndarray:
    """Values of dual-feasible functions (rows) at the sizes 0..capacity.

    Any packing needs at least the sum of such a function's values. The first row is the
    size itself; then rounding functions that cut sizes into k + 1 parts; then threshold
    functions that count large sizes whole and drop small ones.
    """
    size = np.arange(capacity + 1)
    rows = [size / capacity]
    for k in range(1, steps + 1):
        parts, rest = np.divmod((k + 1) * size, capacity)
        rows.append(np.where(rest == 0, size / capacity, parts / k))
    for small in range(1, capacity // 2 + 1):
        rows.append(np.where(size > capacity - small, 1.0, np.where(size < small, 0.0, size / capacity)))
    return np.array(rows)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that the lengths need at least, by the best dual-feasible function."""
    tally = np.bincount(lengths, minlength=capacity + 1)
    return int(np.ceil(dual_feasible(capacity) @ tally - 1e-6).max()) if len(lengths) else 0


def _packed(pieces: DataFrame, level: int, packing: Packing) -> DataFrame:
    """Pack each group; every row also gets its group's sequences and gap to the bound."""
    capacity = packing.capacity

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = table["length"].to_numpy()
        bins, offsets, n = best_fit_decreasing(lengths, capacity)
        gap = n - lower_bound(lengths, capacity)
        group = table["grp"][0].as_py() if len(table) else 0
        ids = (level << 58) + (group << 24) + bins
        keep = [table[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "grp")]
        more = [ids, offsets, np.full(len(ids), n), np.full(len(ids), gap)]
        return pa.Table.from_arrays(
            [*keep, *[pa.array(x, pa.int64()) for x in more]],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "grp", "sequence_id", "offset", "bins", "gap"],
        )

    schema = f"{_PIECES}, grp long, sequence_id long, offset long, bins long, gap long"
    return stored(pieces.groupBy("grp").applyInArrow(pack, schema), "packed")


def _dealt(pieces: DataFrame, groups: int, level: int) -> DataFrame:
    # The place in the stored file parts copies of a row, which are many or have no id.
    key = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id(), F.lit(level))
    return pieces.withColumn("grp", F.pmod(key, F.lit(groups)).cast("long"))


def _summary(packed: DataFrame) -> tuple[int, int, int, int]:
    """Sequences, gap, groups with a gap and their pieces."""
    groups = packed.groupBy("grp").agg(
        F.max("bins").alias("bins"), F.max("gap").alias("gap"), F.count("*").alias("n")
    )
    row = groups.agg(
        F.sum("bins"), F.sum("gap"), F.count_if(F.col("gap") > 0), F.sum(F.when(F.col("gap") > 0, F.col("n")))
    ).first()
    return tuple(int(x or 0) for x in row)


def pack_documents(docs: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """Pack every row of ``docs``; one row per piece with its sequence and its offset there.

    A null or empty text is the end token alone. Repeated rows are packed each on its own,
    a null id stays null, an empty table gives an empty one and other columns take no part.
    """
    pieces = stored(tokenised_pieces(docs, packing), "pieces")
    full = pieces.where(F.col("length") == packing.capacity)
    loose = pieces.where(F.col("length") < packing.capacity)
    n = loose.count()
    current = _packed(_dealt(loose, max(1, -(-n // packing.group_pieces)), 0), 0, packing)
    done: list[DataFrame] = []
    for level in range(1, packing.exchanges + 1):
        _, gap, groups, n_open = _summary(current)
        fewer = max(1, -(-n_open // (packing.group_pieces << level)))
        if gap == 0 or groups <= fewer:
            break
        # Certified groups are done; the others exchange their pieces and are packed again.
        done.append(current.where("gap = 0"))
        with_gap = current.where("gap > 0")
        before = _summary(with_gap)[0]
        pool = with_gap.drop("grp", "sequence_id", "offset", "bins", "gap")
        again = _packed(_dealt(pool, fewer, level), level, packing)
        if _summary(again)[0] >= before:
            current = with_gap
            break
        current = again
    result = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    out = current.select(result)
    for part in done:
        out = out.unionAll(part.select(result))
    # A full piece is a sequence of its own, numbered below zero.
    alone = full.withColumns({
        "sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")
    })
    return out.unionAll(alone.select(result))
