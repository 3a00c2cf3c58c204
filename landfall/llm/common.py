"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.keys import scratch_root
from landfall.sources.paths import join_path

#: The six ASCII white-space characters that part words: space, \t, \n, \v, \f, \r.
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared scratch root."""
    return join_path(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Later steps read files that every executor sees, so neither a lost executor
    nor a second use makes Spark run the steps before once more.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shielded(docs: DataFrame, *inputs: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but ``inputs`` renamed, and the columns that undo it.

    Operators that pass other columns through add columns of their own in between, which
    may have the same names.
    """
    safe = {c: c if c in inputs else f"_own_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(s) for c, s in safe.items()])
    return renamed, [F.col(f"`{s}`").alias(c) for c, s in safe.items()]


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's decimal text leaves ``remainder``; a null id is never held out."""
    crc = F.crc32(F.encode(doc_id.cast("string"), "utf-8"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def utf8_texts(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The UTF-8 bytes of each string of an Arrow column, without copies; None for null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offset_buffer, data_buffer = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(offset_buffer, dtype=wide)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.zeros(0, np.uint8)
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    for i in range(n):
        yield None if nulls[i] else data[offsets[i] : offsets[i + 1]]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
