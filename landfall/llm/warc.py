"""WARC archives compressed record by record with a shared Zstandard dictionary.

An archive begins with a skippable frame that holds the dictionary, as readers of
``.warc.zst`` files expect, and then has one frame per record. The dictionary is built from
a bounded sample of the records that are archived. Spark's text writer puts the frames into
files, so archives go through Hadoop's file systems and Spark's commit protocol like any
other output; the line separator is an empty skippable frame, which decoders pass over.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import scratch, utf8_texts

# Fixed values of the formats: frame magics, the header lines that are read back, the profile.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
SEPARATOR = "P*M\x18\0\0\0\0"  # magic 0x184D2A50 and length 0
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archiving:
    min_payload_bytes: int = 0  # smaller payloads are never revisits
    date: str = "2024-01-01T00:00:00Z"  # of all records, so that reruns write the same bytes
    archive_bytes: int = 64 << 20  # payload of one archive, about
    level: int = 3
    dictionary_bytes: int = 112_640
    sample_records: int = 2000  # that the dictionary is built from at most
    sample_record_bytes: int = 65_536  # of each of them


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    number = uri.strip("<>").removeprefix("urn:page:")
    return None if number == "none" else int(number)


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool, date: str
) -> bytes:
    """One WARC record. A revisit holds the HTTP header alone, with the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() if is_revisit else http.encode() + payload
    target = (url or _uri(page_id).strip("<>")).replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {_uri(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if is_revisit:
        lines += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _keyed(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), "html", F.sha1(payload).alias("_digest"),
        F.octet_length(payload).cast("long").alias("_bytes"),
    )


def _first_pages(keyed: DataFrame, least: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a smaller id has."""
    small = keyed.where(F.col("_bytes") >= least).select("page_id", "_digest")
    first = small.groupBy("_digest").agg(F.min("page_id").alias("refers_to"))
    later = F.col("refers_to").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to")))
    return small.distinct().join(first, "_digest").where(later)


def build_dictionary(pages: DataFrame, total: int, archiving: Archiving) -> bytes:
    """A dictionary from a bounded sample of the records; empty if there are too few bytes."""
    space = 1 << 30
    rate = space if total <= archiving.sample_records else max(1, space * archiving.sample_records // total)
    chosen = pages.where(F.pmod(F.xxhash64("page_id", F.octet_length("html")), F.lit(space)) < rate)
    rows = chosen.select("page_id", "url", F.substring(F.encode(F.coalesce("html", F.lit("")), "utf-8"), 1, archiving.sample_record_bytes).alias("start"))
    samples = sorted(
        record(r["page_id"], r["url"], bytes(r["start"]), None, False, archiving.date)
        for r in rows.limit(archiving.sample_records).collect()
    )
    try:
        return zstandard.train_dictionary(archiving.dictionary_bytes, samples, level=archiving.level).as_bytes()
    except zstandard.ZstdError:
        # Too few records to train on: their bytes themselves serve as dictionary.
        return b"".join(samples)[: archiving.dictionary_bytes]


def dictionary_of(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def write_archives(pages: DataFrame, path: str, archiving: Archiving = Archiving()) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to archives below ``path``.

    Of equal payloads the smallest page_id is the response. A null html is an empty
    payload. A null id counts as the largest: its row revisits any row with an id, and is a
    response if there is none. Rows that repeat the smallest id are responses too. Other
    columns take no part; an empty table gives no archive.
    """
    keyed = _keyed(pages)
    sums = keyed.agg(F.count("*").alias("n"), F.sum("_bytes").alias("bytes")).first()
    if not sums["n"]:
        pages.limit(0).select(F.lit("").alias("value")).write.text(path)
        return
    words = build_dictionary(pages, sums["n"], archiving)
    frame = struct.pack("<II", DICTIONARY_MAGIC, len(words)) + words
    archives = max(1, -(-int(sums["bytes"]) // archiving.archive_bytes), -(-sums["n"] // 1_000_000))
    # The pages are shuffled once, by id, so equal payloads do not meet in one task.
    spread = keyed.repartition(archives, F.coalesce("page_id", F.lit(-1)), "_digest")
    roles = _first_pages(keyed, archiving.min_payload_bytes).select(
        F.coalesce("page_id", F.lit(-1)).alias("_key"), F.col("_digest").alias("_same"),
        F.col("page_id").isNull().alias("_none"), "refers_to",
    )
    match = (
        (F.coalesce("page_id", F.lit(-1)) == F.col("_key")) & (F.col("_digest") == F.col("_same"))
        & (F.col("page_id").isNull() == F.col("_none"))
    )
    rows = spread.join(roles, match, "left").select("page_id", "url", "html", "refers_to")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=archiving.level, dict_data=dictionary_of(words))
        begun = False
        for batch in batches:
            out = []
            if batch.num_rows and not begun:
                out.append(frame)
                begun = True
            ids, urls, first = (batch[c].to_pylist() for c in ("page_id", "url", "refers_to"))
            for page_id, url, data, refers_to in zip(ids, urls, utf8_texts(batch["html"]), first):
                payload = b"" if data is None else data.tobytes()
                out.append(compressor.compress(
                    record(page_id, url, payload, refers_to, refers_to is not None, archiving.date)
                ))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    archived = rows.sortWithinPartitions("page_id").mapInArrow(frames, "frame binary")
    # A cast from binary keeps the bytes as they are.
    archived.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def _frames(data: bytes) -> Iterator[bytes]:
    """The content of each record's frame of an archive."""
    view, at, reader = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        (magic,) = struct.unpack_from("<I", view, at)
        if magic in SKIPPABLE:
            (length,) = struct.unpack_from("<I", view, at + 4)
            if magic == DICTIONARY_MAGIC:
                reader = zstandard.ZstdDecompressor(dict_data=dictionary_of(bytes(view[at + 8 : at + 8 + length])))
            at += 8 + length
            continue
        content, decoder = [], reader.decompressobj()
        while not decoder.eof:
            fed = view[at : at + 65536]
            if not len(fed):
                raise ValueError("an archive ends within a record")
            content.append(decoder.decompress(fed))
            at += len(fed) - len(decoder.unused_data)
        yield b"".join(content)


def parse_record(data: bytes) -> tuple[int | None, int, str, str, int | None, bytes]:
    """page_id, payload length, digest, type, refers_to and stored payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    name, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload), digest(payload)) != (length, name):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    refers_to = _page(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
    return _page(fields["WARC-Record-ID"]), length, name, kind, refers_to, payload


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; each response's payload is checked against its digest.

    An archive is one row of the file source, so archives are to stay below 2 GB.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows: list[list] = [[] for _ in names]
                for data in _frames(content.as_py()):
                    for column, value in zip(rows, parse_record(data)):
                        column.append(value)
                    if len(rows[0]) == 256:  # keeps few payloads in memory
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, types)], names=names)
                        rows = [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, types)], names=names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(
        parse, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )


def archive_round_trip(pages: DataFrame, archiving: Archiving = Archiving()) -> DataFrame:
    """Write ``pages`` to archives in the scratch folder and read the records' digests back."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(pages, path, archiving)
    return read_archives(spark, path).drop("payload")
