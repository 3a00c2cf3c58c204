"""N-gram Jaccard join: documents linked by the similarity of their word shingles.

Exact copies of a shingle set are one class. Where two classes could be linked, they meet in
a group of bounded size, which a signature tree joins: its nodes hold the OR of their sets'
token bitmaps and the range of their sizes, and a dual traversal goes down only into pairs
of nodes whose largest possible overlap reaches the threshold, and which are not in one
component already. What is left is compared set by set.

Two classes can only be linked if they share tokens early in a common order (prefix
filter). The order puts tokens last that a count sketch over all documents shows to be
frequent. Classes that share their first token meet first, which links nearly all copies;
later tokens matter only where they join different components. Tokens held by few classes
give pairs, which must share several early tokens; tokens held by many give groups of classes
of like size, in blocks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import mixed, shielded, stored, utf8_texts
from landfall.llm.components import connected_components

_NONE = np.iinfo(np.int64).max  # stands for a null id, which counts as the largest
_CELLS = 1 << 18  # of the count sketch


@dataclass(frozen=True)
class Join:
    words: int = 3  # of a shingle
    percent: int = 90  # linked at 100 * intersection >= percent * union
    shared: int = 8  # early tokens that a pair from rare tokens must share
    rare: int = 512  # classes that a token may have to give pairs
    block: int = 512  # classes of a block of a frequent token
    first_block: int = 4096  # classes that meet at a shared first token
    first_tokens: int = 2_000_000  # and tokens of theirs, about
    group_rows: int = 1000  # rows gathered in one task's group, about
    broadcast_rows: int = 200_000  # rows of five numbers and a hash that may be broadcast, about 15 MB


# Shingle sets.


def shingles(data: np.ndarray | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of a text's word shingles."""
    if data is None or len(data) == 0:
        return np.zeros(0, np.uint64)
    parts = data.tobytes().lower().split()  # bytes: A-Z and the six white-space bytes alone
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out)


def needed_overlap(m: int, n: int, percent: int) -> int:
    """Smallest intersection of linked sets of m and n tokens."""
    return -(-percent * (m + n) // (100 + percent))


def set_id(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def ordered(tokens: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Tokens in the common order: by frequency class, then by fingerprint."""
    with np.errstate(over="ignore"):
        kind = rarity[(tokens & np.uint64(_CELLS - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort((kind << np.uint64(56)) | (tokens >> np.uint64(8)))


def frequency_classes(docs: DataFrame, join: Join) -> np.ndarray:
    """A class per cell of a count sketch over all documents: 0 for tokens not known to be frequent."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CELLS, np.int64)
        for batch in batches:
            for data in utf8_texts(batch["text"]):
                cells = (shingles(data, join.words) & np.uint64(_CELLS - 1)).astype(np.int64)
                np.add.at(total, cells, 1)
        yield pa.RecordBatch.from_pydict({"cells": [zlib.compress(total.tobytes(), 1)]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CELLS, np.int64)
        for batch in batches:
            for cells in batch["cells"]:
                total += np.frombuffer(zlib.decompress(cells.as_py()), np.int64)
        yield pa.RecordBatch.from_pydict({"cells": [zlib.compress(total.tobytes(), 1)]})

    # One sketch per task; eight tasks add them up, so the driver gets eight.
    rows = docs.select("text").mapInArrow(sketch, "cells binary").repartition(8).mapInArrow(add, "cells binary")
    total = np.zeros(_CELLS, np.int64)
    for row in rows.collect():
        total += np.frombuffer(zlib.decompress(row["cells"]), np.int64)
    mean = total.mean()
    above = total - mean
    frequent = above > 8 * np.sqrt(mean) + 32
    kind = np.zeros(_CELLS, np.uint8)
    kind[frequent] = 1 + np.log2(above[frequent]).astype(np.uint8)
    return kind


# Classes.


def shingle_sets(docs: DataFrame, rarity: np.ndarray, join: Join) -> DataFrame:
    """Per row: doc (id), row (hash of the text), n, set_id and the early tokens as bytes; nulls for an empty set."""
    names = ["doc", "row", "n", "set_id", "early"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, early = [], [], []
            for data in utf8_texts(batch["text"]):
                tokens = shingles(data, join.words)
                n.append(len(tokens))
                if len(tokens) == 0:
                    ids.append(None)
                    early.append(None)
                    continue
                # Linked sets share as many of these as ``shared``, or all they must share.
                length = len(tokens) + join.shared - -(-join.percent * len(tokens) // 100)
                ids.append(set_id(tokens))
                early.append(ordered(tokens, rarity)[:length].tobytes())
            columns = [batch["doc"], batch["row"], pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(early, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(zip(names, types))))

    return keyed(docs).mapInArrow(compute, "doc long, row long, n long, set_id binary, early binary")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, row, text): a row is found by its id and a hash of its text, as many rows may lack an id."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_NONE)))
    return docs.select(doc.alias("doc"), F.xxhash64("text").alias("row"), "text")


def shingle_classes(sets: DataFrame) -> DataFrame:
    """One row per distinct set: cid, set_id, n, its first token, and doc and row of the smallest id."""
    one = sets.where("set_id is not null").groupBy("set_id").agg(
        F.min(F.struct("doc", "row")).alias("least"), F.min("n").alias("n"), F.min(F.substring("early", 1, 8)).alias("first")
    ).select("set_id", "least.doc", "least.row", "n", "first")
    # Written at once, which fixes the numbers.
    return stored(one.withColumn("cid", F.monotonically_increasing_id()), "shingle-classes")


# The signature tree.


class _Forest:
    """Components of the sets of a group."""

    def __init__(self, labels: list[int]):
        first: dict[int, int] = {}
        self.up = [first.setdefault(label, i) for i, label in enumerate(labels)]
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.links.append((i, j))
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)


@dataclass
class _Node:
    places: list[int]
    bits: np.ndarray  # OR of the sets' bitmaps
    least: int
    most: int
    excess: int  # most tokens of a set that share a bit with another token of it
    parts: tuple["_Node", ...] = ()


_LEAF = 4


def _bitmap(tokens: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width, bool)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


def _build(places: list[int], sets: list[np.ndarray], maps: list[np.ndarray], excess: list[int]) -> _Node:
    if len(places) <= _LEAF:
        sizes = [len(sets[i]) for i in places]
        bits = np.bitwise_or.reduce([maps[i] for i in places])
        return _Node(places, bits, min(sizes), max(sizes), max(excess[i] for i in places))
    half = len(places) // 2
    a, b = _build(places[:half], sets, maps, excess), _build(places[half:], sets, maps, excess)
    return _Node(places, a.bits | b.bits, min(a.least, b.least), max(a.most, b.most), max(a.excess, b.excess), (a, b))


def tree_links(sets: list[np.ndarray], labels: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that join the sets of a group into their components, given those known (labels).

    Not every link is listed, but any two linked sets are joined by listed links and labels.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    forest = _Forest(labels)
    typical = len(sets[order[len(order) // 2]])
    width = 1 << int(np.clip(2 * typical, 256, 1 << 15) - 1).bit_length()
    maps = [_bitmap(s, width) for s in sets]
    excess = [len(s) - int(np.bitwise_count(m).sum()) for s, m in zip(sets, maps)]

    def one_component(a: _Node, b: _Node) -> bool:
        root = forest.root(a.places[0])
        return all(forest.root(i) == root for i in a.places) and all(forest.root(i) == root for i in b.places)

    def compare(i: int, j: int) -> None:
        m, n = len(sets[i]), len(sets[j])
        if percent * max(m, n) > 100 * min(m, n) or forest.root(i) == forest.root(j):
            return
        needed = needed_overlap(m, n, percent)
        if int(np.bitwise_count(maps[i] & maps[j]).sum()) + min(excess[i], excess[j]) < needed:
            return
        if len(np.intersect1d(sets[i], sets[j], assume_unique=True)) >= needed:
            forest.join(i, j)

    def meet(a: _Node, b: _Node) -> None:
        if a is b:
            if a.parts:
                meet(a.parts[0], a.parts[0])
                meet(a.parts[1], a.parts[1])
                meet(*a.parts)
            else:
                for x, i in enumerate(a.places):
                    for j in a.places[x + 1 :]:
                        compare(i, j)
            return
        if percent * a.least > 100 * b.most or percent * b.least > 100 * a.most:
            return
        if one_component(a, b):
            return
        shared = int(np.bitwise_count(a.bits & b.bits).sum()) + min(a.excess, b.excess)
        if shared < needed_overlap(a.least, b.least, percent):
            return
        if not a.parts and not b.parts:
            for i in a.places:
                for j in b.places:
                    compare(i, j)
            return
        left, right = a.parts or (a,), b.parts or (b,)
        for x in left:
            for y in right:
                meet(x, y)

    if len(order) > 1:
        root = _build(order, sets, maps, excess)
        meet(root, root)
    return forest.links


# Groups.


def group_links(members: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """Links (a, b) of class numbers found in groups.

    ``members`` has (gid, cid, doc, row, set_id, root): the classes that meet in each group. Their
    texts come from ``docs`` (doc, row, text), so that only groups' sets are ever moved.
    """
    members = stored(members, "group-members")
    n = members.count()
    buckets = max(1, -(-n // join.group_rows))
    rows = members.withColumn("bucket", F.pmod(F.xxhash64("gid"), F.lit(buckets)))
    # A checked size decides how the texts are found: by broadcast members or by a shuffle.
    texts = docs.join(F.broadcast(rows) if n <= join.broadcast_rows else rows, ["doc", "row"]).select(
        "bucket", "gid", "cid", "set_id", "root", "text"
    )

    def link(table: pa.Table) -> pa.Table:
        groups: dict[int, dict[int, tuple[np.ndarray, int]]] = {}
        columns = [table[c].to_pylist() for c in ("gid", "cid", "set_id", "root")]
        for gid, cid, own, root, data in zip(*columns, utf8_texts(table["text"])):
            if cid in groups.setdefault(gid, {}):
                continue
            tokens = shingles(data, join.words)
            if set_id(tokens) == own:  # another text may have the same id
                groups[gid][cid] = (tokens, root)
        a, b = [], []
        for gid in sorted(groups):
            cids = sorted(groups[gid])
            sets, roots = zip(*(groups[gid][c] for c in cids)) if cids else ((), ())
            for i, j in tree_links(list(sets), list(roots), join.percent) if len(cids) > 1 else ():
                a.append(cids[i])
                b.append(cids[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return stored(texts.groupBy("bucket").applyInArrow(link, "a long, b long"), "group-links")


def _first_token_groups(classes: DataFrame, join: Join) -> DataFrame:
    """Classes with the same first token; many are dealt to groups of bounded size."""
    first = classes.select(
        "cid", "doc", "row", "set_id", "n", F.xxhash64("first").alias("token"), F.col("cid").alias("root")
    )
    counts = first.groupBy("token").agg(F.count("*").alias("m"), F.sum("n").alias("tokens")).where("m > 1")
    parts = F.greatest(F.ceil(F.col("m") / join.first_block), F.ceil(F.col("tokens") / join.first_tokens))
    part = F.pmod(F.xxhash64("set_id"), parts)
    return first.join(counts, "token").select(
        F.xxhash64("token", part).alias("gid"), "cid", "doc", "row", "set_id", "root"
    )


def _early_rows(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(token, n, cid, root): one row per early token of a class; root is null where it is cid."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cid, root = batch["n"].to_numpy(), batch["cid"].to_numpy(), batch["other_root"]
            tokens = [np.frombuffer(x.as_py(), np.int64) for x in batch["early"]]
            lengths = np.array([len(t) for t in tokens], np.int64)
            at = np.repeat(np.arange(len(tokens)), lengths)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            for start in range(0, len(flat), 100_000):
                part = slice(start, start + 100_000)
                yield pa.RecordBatch.from_pydict({
                    "token": flat[part], "n": n[at[part]].astype(np.int32), "cid": cid[at[part]],
                    "root": root.take(pa.array(at[part])),
                })

    key = ["set_id", "doc", "row"]
    own = classes.select(*key, "n", "cid", F.nullif("root", F.col("cid")).alias("other_root"))
    # A row that is repeated gives its class's tokens once.
    rows = sets.where("set_id is not null").select(*key, "early").dropDuplicates(key).join(own, key)
    return rows.select("n", "cid", "other_root", "early").mapInArrow(
        explode, "token long, n int, cid long, root long"
    )


def _rare() -> Column:
    """Whether a token is of frequency class 0."""
    return F.col("token").between(0, (1 << 56) - 1)


def _candidates(early: DataFrame, join: Join) -> DataFrame:
    """Stream each token's rows in order of size: pairs of classes in different components from
    rare tokens, and the rows of tokens that turn out to be held by many.

    Tokens that the sketch shows to be frequent do not come here, so no token has more
    rows than the sketch lets pass, and what a task holds is one rare token's rows.
    """
    percent = join.percent
    names = ["pair", "a", "b", "m", "n"]
    types = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = []

        def give(pair: bool, *columns: np.ndarray) -> None:
            if len(columns[0]):
                out.append([np.full(len(columns[0]), pair), *columns])

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=names)

        def rare(n: np.ndarray, cid: np.ndarray, root: np.ndarray) -> None:
            i, j = np.triu_indices(len(n), 1)
            ok = (root[i] != root[j]) & (percent * n[j] <= 100 * n[i])
            i, j = i[ok], j[ok]
            swap = cid[i] > cid[j]
            a, b = np.where(swap, j, i), np.where(swap, i, j)
            give(True, cid[a], cid[b], n[a], n[b])

        held = [np.zeros(0, np.int64)] * 4  # the token that the last batch broke off in, while it is rare
        running: int | None = None  # the token of more rows that goes on
        for batch in batches:
            columns = [batch[c].to_numpy() for c in ("token", "n", "cid")]
            columns.append(batch["root"].fill_null(0).to_numpy())
            columns[3] = np.where(batch["root"].is_null().to_numpy(zero_copy_only=False), columns[2], columns[3])
            token, n, cid, root = (np.concatenate([h, c]) for h, c in zip(held, columns))
            if len(token) == 0:
                continue
            edges = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
            sizes = np.diff(edges)
            last = len(edges) - 2
            for g in np.flatnonzero(sizes > (1 if running is None else 0)):
                s, e = edges[g], edges[g + 1]
                if token[s] == running or e - s > join.rare:
                    running = int(token[s])
                    give(False, token[s:e], cid[s:e], n[s:e], root[s:e])
                elif g < last and e - s > 1:
                    rare(n[s:e], cid[s:e], root[s:e])
            s = edges[last]
            if running is not None and token[s] != running:
                running = None
            held = [x[s:] if running is None else x[:0] for x in (token, n, cid, root)]
            if out:
                yield flush()
        if len(held[0]) > 1:
            rare(*held[1:])
        yield flush()

    rows = early.where(_rare()).repartition("token").sortWithinPartitions("token", "n", "cid")
    return rows.mapInArrow(stream, "pair boolean, a long, b long, m long, n long")


def _later_groups(sets: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """Groups of classes of different components that later tokens bring together."""
    early = _early_rows(sets, classes)
    found = stored(_candidates(early, join), "candidates")
    p = join.percent
    # Of the early tokens of the class whose last one comes first, linked classes share all but
    # those that its own size allows to be missing from the overlap.
    overlap = F.ceil(p * (F.col("m") + F.col("n")) / F.lit(100 + p))
    beyond = join.shared - F.ceil(p * F.greatest("m", "n") / F.lit(100))
    needed = overlap + F.least(F.lit(0), beyond)
    pairs = (
        found.where("pair").groupBy("a", "b")
        .agg(F.count("*").alias("shared"), F.first("m").alias("m"), F.first("n").alias("n"))
        .where(F.col("shared") >= needed)
    )
    # A pair's group is a star around its smaller class, split where that has many partners.
    partners = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(64)).alias("parts"))
    star = F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("parts")))
    spokes = stored(pairs.join(partners, "a").select(star.alias("gid"), "a", "b"), "pairs")
    stars = spokes.select("gid", F.col("a").alias("cid")).unionAll(spokes.select("gid", F.col("b").alias("cid")))
    many = found.where("not pair").select(
        F.col("a").alias("token"), F.col("b").alias("cid"), F.col("m").alias("n"), F.col("n").alias("root")
    )
    known = early.where(~_rare()).select(
        "token", "cid", F.col("n").cast("long"), F.coalesce("root", "cid").alias("root")
    )
    frequent = stored(known.unionAll(many), "frequent")
    members = stars.unionAll(_block_groups(frequent, join)).distinct()
    return members.join(classes.select("cid", "doc", "row", "set_id", "root"), "cid")


_BAND = 4  # a band of sizes spans the threshold's ratio so many times


def _block_groups(rows: DataFrame, join: Join) -> DataFrame:
    """(gid, cid): groups of a frequent token's classes whose sizes and components allow a link.

    Classes meet by bands of sizes, where those just above a band's upper edge are guests.
    A band with too many classes is dealt to blocks, and every two blocks are a group. Of
    groups with the same members, as the tokens of one shared passage have, one is kept.
    """
    step = -np.log(join.percent / 100) * (1 + 1e-9)
    size = F.log(F.col("n").cast("double"))
    band = F.floor(size / F.lit(_BAND * step)).cast("int")
    is_guest = size - band * F.lit(_BAND * step) <= F.lit(step)
    placed = rows.withColumn("band", F.explode(F.when(is_guest, F.array(band, band - 1)).otherwise(F.array(band))))
    counts = placed.groupBy("token", "band").agg(F.ceil(F.count("*") / join.block).cast("int").alias("parts"))
    blocks = placed.join(counts, ["token", "band"])
    part = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
    pairs = blocks.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    gid = F.xxhash64("token", "band", F.least("part", "other"), F.greatest("part", "other"))
    members = stored(pairs.select(gid.alias("gid"), "cid", "root"), "block-members")
    groups = members.groupBy("gid").agg(
        F.count("*").alias("k"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.sum(F.shiftright(F.xxhash64("cid"), 20)).alias("s1"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("s2"),
    )
    chosen = groups.where("low < high").groupBy("k", "s1", "s2").agg(F.min("gid").alias("gid"))
    return members.join(chosen.select("gid"), "gid", "left_semi").select("gid", "cid")


# The join.


def class_components(docs: DataFrame, join: Join) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, classes, roots): the set of each row, the distinct sets, and (node, root) of linked classes."""
    sets = stored(shingle_sets(docs, frequency_classes(docs, join), join), "shingle-sets")
    classes = shingle_classes(sets)
    texts = keyed(docs)
    first = group_links(_first_token_groups(classes, join), texts, join)
    roots = stored(connected_components(first), "roots")
    known = classes.join(roots, classes["cid"] == roots["node"], "left").select(
        "cid", "doc", "row", "set_id", "n", F.coalesce("root", "cid").alias("root")
    )
    later = group_links(_later_groups(sets, stored(known, "known-classes"), join), texts, join)
    return sets, classes, connected_components(first.unionAll(later))


def linked_documents(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Texts without words and null texts have an empty set and are linked with nothing: their
    component is their own id. Rows with equal sets are linked, also rows repeated under one
    id. A null id counts as the largest, and a component of null ids alone has a null
    component_id. An empty table gives an empty one; other columns take no part.
    """
    sets, classes, roots = class_components(docs, join)
    placed = classes.join(roots, classes["cid"] == roots["node"], "left").select(
        "set_id", "doc", F.coalesce("root", "cid").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("doc").alias("component"))
    component = placed.join(least, "root").select("set_id", "component")
    none = F.lit(int(_NONE))
    return sets.drop("early", "row").join(component, "set_id", "left").select(
        F.nullif("doc", none).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("component", "doc"), none).alias("component_id"),
    )


def keep_one_each(docs: DataFrame, join: Join = Join(words=5, percent=80)) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, then the longest set.

    A null id counts as the largest. Of rows that repeat the kept id and set, the one whose text
    has the smallest hash stays, then the one whose other columns come first as JSON. Rows without
    words, with an empty or a null text, are in no group and all stay. An empty table gives an
    empty one.
    """
    sets, classes, roots = class_components(docs, join)
    placed = classes.join(roots, classes["cid"] == roots["node"], "left").select(
        "set_id", "doc", "n", F.coalesce("root", "cid").alias("root")
    )
    best = placed.groupBy("root").agg(F.min(F.struct("doc", -F.col("n"), "set_id")).alias("best"))
    chosen = best.select(F.col("best.doc").alias("_doc"), F.col("best.set_id").alias("_set"))
    rows, restored = shielded(docs, "doc_id", "text")
    names = [*rows.columns, "_doc"]
    rows = rows.withColumn("_doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_NONE))))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for data in utf8_texts(batch["text"]):
                tokens = shingles(data, join.words)
                ids.append(set_id(tokens) if len(tokens) else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in names], pa.array(ids, pa.binary())], names=[*names, "_set"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    marked = rows.mapInArrow(mark, f"{schema}, _set binary")
    wordless = marked.where("_set is null")
    whole = F.struct(*rows.columns)
    order = F.struct(F.xxhash64("text"), F.to_json(F.struct(*[c for c in rows.columns if c != "text"])))
    kept = (
        marked.where("_set is not null").join(chosen, ["_doc", "_set"])
        .groupBy("_doc", "_set").agg(F.min_by(whole, order).alias("kept")).select("kept.*")
    )
    return kept.select(*restored).unionAll(wordless.select(*restored))
