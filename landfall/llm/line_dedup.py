"""Line dedup over a whole corpus.

Every long line gives a 128-bit hash with its document and position. The hashes are
range-partitioned together with the document, so a line that half the corpus holds is
split over many tasks, and sorted within a partition by hash, document and position. One
stream over a partition sees the first document of each hash first; every later document
loses the line. Only what the partition's first hash holds for its first document is open,
as an earlier partition may have begun that hash; those few rows are settled by the last
hashes of the partitions. The result is a compressed bitmap per document that loses lines.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import SPACE_CHARS, shielded, stored, utf8_texts

_WHITE = SPACE_CHARS.encode()
_LAST = np.iinfo(np.int64).max
_DROPPED, _OPEN, _TAIL = 0, 1, 2
_LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("pos", pa.int32())])
_FATES = "kind int, part int, h1 long, h2 long, doc long, row long, pos int"


def _document() -> Column:
    """A null id counts as the largest."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST)))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, place, at = [], [], []
            for i, data in enumerate(utf8_texts(batch["text"])):
                if data is None:
                    continue
                for pos, line in enumerate(data.tobytes().split(b"\n")):
                    key = line.strip(_WHITE).lower()  # bytes.lower changes A-Z alone
                    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
                        continue
                    raw.append(hashlib.blake2b(key, digest_size=16).digest())
                    place.append(i)
                    at.append(pos)
            pair = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
            place = np.array(place, np.int64)
            doc, row = (batch[c].to_numpy(zero_copy_only=False)[place] for c in ("doc", "row"))
            arrays = [np.ascontiguousarray(pair[:, 0]), np.ascontiguousarray(pair[:, 1]), doc, row, np.array(at, np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(arrays, _LINES)], schema=_LINES)

    return docs.select("doc", "row", "text").mapInArrow(
        hashes, "h1 long, h2 long, doc long, row long, pos int"
    )


def _fates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream one sorted partition: lines to drop, open lines, and the last hash."""
    part = TaskContext.get().partitionId()
    names = [f.split()[0] for f in _FATES.split(", ")]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def rows(kind: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
        arrays = [kind, np.full(len(kind), part), *columns]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(arrays, types)], names=names)

    last = first_key = None  # (h1, h2, first document) of the running hash; the partition's first hash
    for batch in batches:
        h1, h2, doc, row, pos = (batch[c].to_numpy() for c in _LINES.names)
        n = len(h1)
        if n == 0:
            continue
        begins = np.ones(n, bool)
        begins[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = last is not None and (h1[0], h2[0]) == last[:2]
        if first_key is None:
            first_key = (h1[0], h2[0], doc[0])
        at = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
        first = doc[at]
        if goes_on:
            first = np.where(at == 0, last[2], first)
        drop = doc != first
        is_open = ~drop & (h1 == first_key[0]) & (h2 == first_key[1]) & (doc == first_key[2])
        keep = drop | is_open
        kind = np.where(drop, _DROPPED, _OPEN)[keep]
        if len(kind):
            yield rows(kind, h1[keep], h2[keep], doc[keep], row[keep], pos[keep])
        last = (h1[-1], h2[-1], first[-1])
    if last is not None:
        one = [np.array([x]) for x in (last[0], last[1], last[2], 0, 0)]
        yield rows(np.array([_TAIL]), *one)


def dropped_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc, row, pos) of every line that goes."""
    rows = docs.select(_document().alias("doc"), F.xxhash64("text").alias("row"), "text")
    order = ("h1", "h2", "doc", "row", "pos")
    # Hash and document decide the range, so one document's copies of a line stay together.
    lines = line_hashes(rows, min_chars).repartitionByRange("h1", "h2", "doc").sortWithinPartitions(*order)
    fates = stored(lines.mapInArrow(_fates, _FATES), "line-fates")
    # One row per partition; an open line goes if an earlier partition ends with its hash.
    tails = fates.where(F.col("kind") == _TAIL).select("h1", "h2", F.col("part").alias("before"))
    began = tails.groupBy("h1", "h2").agg(F.min("before").alias("before"))
    settled = (
        fates.where(F.col("kind") == _OPEN).join(began, ["h1", "h2"]).where("before < part")
    )
    columns = ("doc", "row", "pos")
    return fates.where(F.col("kind") == _DROPPED).select(*columns).unionAll(settled.select(*columns))


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc, row, n_dropped, bitmap) of each document that loses lines.

    ``doc`` is the id, the largest long for null, ``row`` the hash of the text. The bitmap
    has a bit per line, 1 for keep, up to the last dropped line, compressed by zlib.
    """
    gone = dropped_lines(docs, min_chars).groupBy("doc", "row").agg(F.collect_set("pos").alias("pos"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, maps = [], []
            for pos in batch["pos"]:
                at = np.array(pos.as_py(), np.int64)
                keep = np.ones(at.max() + 1, bool)
                keep[at] = False
                counts.append(len(at))
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], batch["row"], pa.array(counts, pa.int64()), pa.array(maps, pa.binary())],
                names=["doc", "row", "n_dropped", "bitmap"],
            )

    return gone.mapInArrow(pack, "doc long, row long, n_dropped long, bitmap binary")


def kept_lines(text: bytes, bitmap: bytes | None, n_dropped: int | None) -> list[bytes]:
    lines = text.split(b"\n")
    if bitmap is None:
        return lines
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    # Bits beyond the last dropped line are padding.
    bound = np.flatnonzero(keep == 0)[:n_dropped]
    gone = set(bound.tolist())
    return [line for i, line in enumerate(lines) if i not in gone]


def with_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Add n_dropped and bitmap (null if nothing is dropped) to the columns of ``docs``."""
    keyed = docs.withColumns({"_doc": _document(), "_row": F.xxhash64("text")})
    maps = keep_bitmaps(docs, min_chars).withColumnsRenamed(
        {"doc": "_doc", "row": "_row", "n_dropped": "_n_dropped", "bitmap": "_bitmap"}
    )
    return keyed.join(maps, ["_doc", "_row"], "left").drop("_doc", "_row")


def line_digests(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """n_lines, n_dropped and the digest of the kept text of every row of ``docs``.

    A key found in two documents or more stays only in the one with the smallest id, with
    all its lines there. Rows with the same id count as one document, a null id as the
    largest. A null or empty text is one empty line, too short to be dropped. Other columns
    take no part.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, dropped, digests = [], [], []
            rows = zip(utf8_texts(batch["text"]), batch["_bitmap"].to_pylist(), batch["_n_dropped"].to_pylist())
            for data, bitmap, n in rows:
                text = b"" if data is None else data.tobytes()
                kept = kept_lines(text, bitmap, n)
                lines.append(text.count(b"\n") + 1)
                dropped.append(n or 0)
                digests.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    rows = with_bitmaps(docs.select("doc_id", "text"), min_chars)
    return rows.select(F.col("doc_id").cast("long"), "text", "_n_dropped", "_bitmap").mapInArrow(
        digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


def drop_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` with the kept lines as text; a null text stays null."""
    rows, restored = shielded(docs, "doc_id", "text")
    text = rows.columns.index("text")
    names = rows.columns

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            rows = zip(utf8_texts(batch["text"]), batch["_bitmap"].to_pylist(), batch["_n_dropped"].to_pylist())
            for data, bitmap, n in rows:
                texts.append(None if data is None else b"\n".join(kept_lines(data.tobytes(), bitmap, n)).decode())
            columns = [batch[c] for c in names]
            columns[text] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return with_bitmaps(rows, min_chars).mapInArrow(rewrite, rows.schema).select(*restored)
