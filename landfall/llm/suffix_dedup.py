"""Suffix-array dedup: bytes inside long strings that start anywhere else go.

A suffix matters only by its first ``length`` bytes, its window. Windows are put into suffix
buckets by content: of the short grams in a window the one with the smallest hash is its
anchor, so equal windows have the same anchor at the same distance. Neighbouring windows
with one anchor form a span; only spans are moved, a few bytes for each.

Where a whole span occurs again, all its windows repeat. What is left are the spans at the
edges of repeats. Their bytes are sorted as suffix buckets, a batch of buckets at a time:
the suffixes at the places of a difference cover are ranked first, with the common prefix
of neighbours in rank. Any other suffixes are compared by the few bytes up to the place
where both are in the cover, and a tie there is settled by rank, so no comparison ever
runs over a long common prefix and only one batch is in memory. Buckets too large for a
task are settled by counting fingerprints of single windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import mixed, stored, utf8_texts


@dataclass(frozen=True)
class Dedup:
    length: int = 200
    gram: int = 40
    cover: int = 31  # period of the difference cover
    batch_spans: int = 8192  # of the suffix buckets that a task sorts at a time, about
    bucket_spans: int = 16384  # larger buckets are settled window by window
    segment: int = 1_000_000  # windows of a text that are hashed at a time; below 2**20


# Spans.

_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 20) - 1)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    base[0] = inverse[0] = 1
    return np.cumprod(base), np.cumprod(inverse)


class Fingerprints:
    """64-bit fingerprints of any pieces of a text, by prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray, bound: int):
        power, self.inverse = _powers(bound)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` neighbours, from running minima of blocks."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def spans(data: np.ndarray, dedup: Dedup) -> Iterator[tuple[np.ndarray, ...]]:
    """(bucket, content, first window, last window, anchor) of each span of a text, by segment."""
    with np.errstate(over="ignore"):
        for start in range(0, len(data) - dedup.length + 1, dedup.segment):
            part = data[start : start + dedup.segment + dedup.length - 1]
            prints = Fingerprints(part, dedup.segment + 2 * dedup.length)
            places = np.arange(len(part) - dedup.gram + 1)
            grams = prints(places, places + dedup.gram)
            # Of equal hashes the leftmost counts, which depends on the window alone too.
            keys = (grams & ~_PLACE) | places.astype(np.uint64)
            anchor = (_sliding_least(keys, dedup.length - dedup.gram + 1) & _PLACE).astype(np.int64)
            first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            last = np.r_[first[1:] - 1, len(anchor) - 1]
            at = anchor[first]
            content = prints(first, last + dedup.length)
            content = mixed(content * np.uint64(3) + (at - first).astype(np.uint64))
            yield grams[at].view(np.int64), content.view(np.int64), first + start, last + start, at + start


_SPANS = pa.schema([
    ("bucket", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()),
    ("first", pa.int64()), ("last", pa.int32()), ("anchor", pa.int32()),
])
_SPAN_FIELDS = "bucket long, content long, doc long, row long, first long, last int, anchor int"


def document_spans(docs: DataFrame, dedup: Dedup) -> DataFrame:
    """The spans of all rows of ``docs`` (doc, row, text); last and anchor count from first."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in _SPANS]
            doc, row = (batch[c].to_numpy(zero_copy_only=False) for c in ("doc", "row"))
            for i, data in enumerate(utf8_texts(batch["text"])):
                if data is None or len(data) < dedup.length:
                    continue
                for bucket, content, first, last, anchor in spans(data, dedup):
                    n = len(first)
                    values = (bucket, content, np.full(n, doc[i]), np.full(n, row[i]), first, last - first, anchor - first)
                    for column, value in zip(columns, values):
                        column.append(value)
            if columns[0]:
                arrays = [pa.array(np.concatenate(c), f.type) for c, f in zip(columns, _SPANS)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_SPANS)

    return docs.select("doc", "row", "text").mapInArrow(compute, _SPAN_FIELDS)


# Which spans occur again.

_FATES = f"{_SPAN_FIELDS}, part int, edge int, before int, after int"
_BUCKET, _CONTENT = 1, 2


def _fates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each span of a sorted partition with its neighbours.

    ``before`` and ``after`` tell whether the neighbour has the same bucket (1) and content
    (2). Spans without such a neighbour are left out, but the partition's first (edge 1)
    and last (edge 2) spans always come, as their neighbours are elsewhere.
    """
    part = TaskContext.get().partitionId()
    names = _SPANS.names

    def shared(x: list[np.ndarray]) -> np.ndarray:
        bucket = x[0][1:] == x[0][:-1]
        return bucket * _BUCKET + (bucket & (x[1][1:] == x[1][:-1])) * _CONTENT

    def rows(x: list[np.ndarray], before: np.ndarray, after: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
        keep = (before > 0) | (after > 0) | (edge > 0)
        arrays = [pa.array(c[keep], f.type) for c, f in zip(x, _SPANS)]
        more = [np.full(len(keep), part), edge, before, after]
        arrays += [pa.array(c[keep], pa.int32()) for c in more]
        return pa.RecordBatch.from_arrays(arrays, names=[*names, "part", "edge", "before", "after"])

    held: list[np.ndarray] | None = None  # the last span so far, whose next neighbour is not known
    held_before, held_edge = 0, 1
    for batch in batches:
        x = [batch[c].to_numpy() for c in names]
        if len(x[0]) == 0:
            continue
        if held is not None:
            x = [np.concatenate([h, c]) for h, c in zip(held, x)]
        same = shared(x)
        before = np.r_[held_before if held is not None else 0, same]
        edge = np.zeros(len(before), np.int64)
        edge[0] = held_edge
        if len(before) > 1:
            yield rows([c[:-1] for c in x], before[:-1], same, edge[:-1])
            held_edge = 0
        held, held_before = [c[-1:] for c in x], int(before[-1])
    if held is not None:
        yield rows(held, np.array([held_before]), np.array([0]), np.array([held_edge + 2]))


def repeated_spans(docs: DataFrame, dedup: Dedup) -> DataFrame:
    """Spans whose bucket occurs again; ``same_content`` if the whole span does, and
    ``opens`` for the first of several equal spans.

    Sorting by bucket, content and place splits also a passage that half the corpus holds
    over many tasks; two spans per partition come to the driver to be compared across.
    """
    order = ("bucket", "content", "doc", "row", "first")
    found = document_spans(docs, dedup).repartitionByRange(*order).sortWithinPartitions(*order)
    fates = stored(found.mapInArrow(_fates, _FATES), "span-fates")
    edges = sorted(fates.where("edge > 0").collect(), key=lambda r: (r["part"], r["edge"]))
    settled = []
    for i, r in enumerate(edges):
        value = r.asDict()
        for flag, bit, j in (("before", 1, i - 1), ("after", 2, i + 1)):
            if r["edge"] & bit and 0 <= j < len(edges) and edges[j]["bucket"] == r["bucket"]:
                value[flag] = _BUCKET + _CONTENT * (edges[j]["content"] == r["content"])
        settled.append(tuple(value[f.name] for f in fates.schema))
    inner = fates.where("edge = 0")
    if settled:
        inner = inner.unionAll(docs.sparkSession.createDataFrame(settled, fates.schema))
    either = F.col("before").bitwiseOR(F.col("after"))
    return inner.where(either > 0).select(
        *_SPANS.names,
        (either >= _CONTENT).alias("same_content"),
        ((F.col("after") >= _CONTENT) & (F.col("before") < _CONTENT)).alias("opens"),
    )


# Suffix buckets.


@lru_cache(maxsize=4)
def difference_cover(period: int) -> tuple[int, ...]:
    """Residues such that every difference modulo ``period`` is one of two residues, greedily."""
    cover, missing = [0, 1], set(range(2, period - 1))
    while missing:
        best = max(
            range(period),
            key=lambda r: (len({d for c in cover for d in ((r - c) % period, (c - r) % period)} & missing), -r),
        )
        cover.append(best)
        missing -= {d for c in cover for d in ((best - c) % period, (c - best) % period)}
    return tuple(sorted(cover))


def cover_shift(i: int, j: int, period: int) -> int:
    """The smallest shift that brings both places into the difference cover."""
    cover = difference_cover(period)
    return next(s for s in range(period) if (i + s) % period in cover and (j + s) % period in cover)


def _labels(*columns: np.ndarray) -> np.ndarray:
    """A number per distinct combination of values below 2**31."""
    label = columns[0]
    for column in columns[1:]:
        label = np.unique(label * (int(column.max(initial=0)) + 1) + column, return_inverse=True)[1]
    return label


def repeated_windows(bucket: np.ndarray, texts: list[bytes], anchor: np.ndarray, dedup: Dedup) -> list[np.ndarray]:
    """Per span, which of its windows equals a window of another span of its bucket.

    ``texts`` hold each span's bytes and ``anchor`` the anchor's place in them. Suffixes of a
    bucket can only be equal at one distance from their anchors, so they are lined up at it.
    """
    n, reach = len(texts), dedup.length - dedup.gram  # reach: windows before the anchor at most
    wide = reach + dedup.length
    grid = np.zeros((n, wide), np.uint8)
    begin, count = reach - anchor, np.array([len(t) - dedup.length + 1 for t in texts])
    for i, text in enumerate(texts):
        grid[i, begin[i] : begin[i] + len(text)] = np.frombuffer(text, np.uint8)
    bucket = np.unique(bucket, return_inverse=True)[1].astype(np.int64)
    found = np.zeros((n, reach + 1), bool)
    ranked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for at in range(reach + 1):
        live = np.flatnonzero((begin <= at) & (at < begin + count))
        if len(live) < 2:
            continue
        shift = cover_shift(at, at, dedup.cover)
        if at + shift not in ranked:
            ranked = {at + shift: _ranks(grid, bucket, at + shift, dedup)}
        order, common = ranked[at + shift]
        # Ranks that tie over the rest of the window have one number.
        tie = np.zeros(n, np.int64)
        tie[order] = np.cumsum(np.r_[0, common < dedup.length - shift])
        label = tie[live]
        for column in range(at, at + shift):
            label = _labels(label, grid[live, column].astype(np.int64))
        label = np.unique(label, return_inverse=True)[1]
        found[live, at] = np.bincount(label)[label] > 1
    return [found[i, begin[i] : begin[i] + count[i]] for i in range(n)]


def _ranks(grid: np.ndarray, bucket: np.ndarray, at: int, dedup: Dedup) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at a cover place within their buckets, and the common prefix
    of each with the next, -1 across buckets."""
    rest = grid[:, at : at + dedup.length]
    keyed = np.concatenate([bucket.astype(">u8").view(np.uint8).reshape(-1, 8), rest], axis=1)
    order = np.argsort(_as_text(keyed), kind="stable")
    a, b = rest[order[1:]], rest[order[:-1]]
    differ = a != b
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), dedup.length)
    return order, np.where(bucket[order[1:]] == bucket[order[:-1]], common, -1)


def _as_text(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as fixed-width strings that sort like them; a last byte keeps trailing zeros."""
    ended = np.concatenate([rows, np.ones((len(rows), 1), np.uint8)], axis=1)
    return np.ascontiguousarray(ended).view(f"S{ended.shape[1]}").ravel()


_RANGES = "doc long, row long, start long, end long"
_RANGE_NAMES = ["doc", "row", "start", "end"]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edges[::2], edges[1::2] - 1


def edge_ranges(docs: DataFrame, repeated: DataFrame, dedup: Dedup) -> DataFrame:
    """Byte ranges of repeated windows in spans that do not occur again as a whole."""
    loose = repeated.where(~F.col("same_content"))
    buckets = loose.select("bucket").distinct()
    # Of equal spans one stands for all.
    partners = repeated.where("opens").join(buckets, "bucket", "left_semi")
    members = stored(
        loose.withColumn("open", F.lit(True)).unionAll(partners.withColumn("open", F.lit(False)))
        .drop("same_content", "opens", "content"), "edge-spans",
    )
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    # Copies of a row have one key and the same spans, which count once here.
    wanted = members.join(sizes, "bucket").groupBy("doc", "row").agg(
        F.collect_set(F.struct("bucket", "first", "last", "anchor", "open", (F.col("n") > dedup.bucket_spans).alias("large"))).alias("spans")
    )
    names = ["bucket", "doc", "row", "first", "anchor", "open", "large", "bytes"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
    fields = "bucket long, doc long, row long, first long, anchor int, open boolean, large boolean, bytes binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, row, data, own in zip(batch["doc"].to_pylist(), batch["row"].to_pylist(), utf8_texts(batch["text"]), batch["spans"]):
                rows: list[list] = [[] for _ in names]
                for s in own.as_py():
                    piece = data[s["first"] : s["first"] + s["last"] + dedup.length].tobytes()
                    values = (s["bucket"], doc, row, s["first"], s["anchor"], s["open"], s["large"], piece)
                    for column, value in zip(rows, values):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, types)], names=names)

    spans = docs.join(wanted, ["doc", "row"]).mapInArrow(cut, fields)
    pieces = stored(spans.dropDuplicates(["bucket", "doc", "row", "first"]), "edge-bytes")

    def sort_buckets(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bucket", "ascending")])
        bucket = table["bucket"].to_numpy()
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in _RANGE_NAMES]
        doc, row, first, anchor, is_open = (table[c].to_numpy() for c in ("doc", "row", "first", "anchor", "open"))
        start = 0
        while start < len(bucket):
            end = min(start + dedup.batch_spans, len(bucket))
            end = int(np.searchsorted(bucket, bucket[end - 1], side="right"))
            texts = table["bytes"][start:end].to_pylist()
            flags = repeated_windows(bucket[start:end], texts, anchor[start:end].astype(np.int64), dedup)
            for i, own in zip(range(start, end), flags):
                if is_open[i] and own.any():
                    a, b = _runs(own)
                    for column, value in zip(out, (np.full(len(a), doc[i]), np.full(len(a), row[i]), first[i] + a, first[i] + b + dedup.length)):
                        column.append(value)
            start = end
        return pa.table(dict(zip(_RANGE_NAMES, map(np.concatenate, out))))

    small = pieces.where("not large")
    groups = max(1, -(-small.count() // dedup.batch_spans))
    keyed = small.withColumn("task", F.pmod(F.xxhash64("bucket"), F.lit(groups)))
    sorted_ranges = keyed.groupBy("task").applyInArrow(sort_buckets, _RANGES)
    return sorted_ranges.unionAll(_window_ranges(pieces.where("large"), dedup))


def _window_ranges(pieces: DataFrame, dedup: Dedup) -> DataFrame:
    """The same for buckets beyond any task: fingerprints of single windows are counted."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for doc, row, first, is_open, data in zip(*(batch[c].to_pylist() for c in ("doc", "row", "first", "open", "bytes"))):
                for i in range(len(data) - dedup.length + 1):
                    h = hashlib.blake2b(data[i : i + dedup.length], digest_size=16).digest()
                    values = (int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True), doc, row, first + i, is_open)
                    for column, value in zip(columns, values):
                        column.append(value)
            types = [*[pa.int64()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["h1", "h2", "doc", "row", "at", "open"])

    rows = pieces.mapInArrow(windows, "h1 long, h2 long, doc long, row long, at long, open boolean")
    twice = rows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(twice, ["h1", "h2"]).where("open").select(
        "doc", "row", F.col("at").alias("start"), (F.col("at") + dedup.length).alias("end")
    )


# Removal.


def covered_ranges(docs: DataFrame, dedup: Dedup) -> DataFrame:
    """(doc, row, starts, ends) of each row of ``docs`` that loses bytes; ranges may overlap."""
    repeated = stored(repeated_spans(docs, dedup), "repeated-spans")
    whole = repeated.where("same_content").select(
        "doc", "row", F.col("first").alias("start"), (F.col("first") + F.col("last") + dedup.length).alias("end")
    )
    both = whole.unionAll(edge_ranges(docs, repeated, dedup))
    # As a set: copies of a row have one key, and each would bring the ranges of all to every copy.
    return both.groupBy("doc", "row").agg(F.collect_set(F.struct("start", "end")).alias("ranges")).select(
        "doc", "row", F.col("ranges.start").alias("starts"), F.col("ranges.end").alias("ends")
    )


def kept_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed runs."""
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    gone = np.cumsum(change[:-1]) > 0
    return data[~gone].tobytes(), len(_runs(gone)[0])


def dedup_digests(docs: DataFrame, dedup: Dedup = Dedup()) -> DataFrame:
    """doc_id, sizes and the digest of the remaining bytes of every row of ``docs``.

    A null text is empty, and texts shorter than ``length`` bytes stay. Rows that repeat a
    text repeat all its strings, also under one id. Null ids stay null, empty tables give
    empty ones, and other columns take no part.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc"),
        F.xxhash64("doc_id", "text").alias("row"), "text",
    )
    ranges = covered_ranges(rows.drop("doc_id"), dedup)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            for data, starts, ends in zip(utf8_texts(batch["text"]), batch["starts"], batch["ends"]):
                data = np.zeros(0, np.uint8) if data is None else data
                if starts.is_valid:
                    kept, runs = kept_bytes(data, *(x.values.to_numpy() for x in (starts, ends)))
                else:
                    kept, runs = data.tobytes(), 0
                values = (len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest())
                for column, value in zip(out, values):
                    column.append(value)
            columns = [batch["doc_id"], *[pa.array(x, t) for x, t in zip(out, types[1:])]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = rows.join(ranges, ["doc", "row"], "left").select("doc_id", "text", "starts", "ends")
    return joined.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
