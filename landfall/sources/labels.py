"""Label files: text with ``value NAME  key = 'label' ... ;`` blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.codebook import label_rows

_COMMENT = r"(?s)/\*.*?\*/"
_BLOCK_START = r"(?im)^\s*value\s+"
_BLOCK_NAME = r"^(\$?\w+)"


def _body(block: str):
    """Lines of a block up to the one whose unquoted text holds the closing semicolon."""
    lines = F.split(F.col(block), r"\r?\n")
    closes = F.transform(lines, lambda x: F.regexp_replace(x, "'[^']*'", "").contains(";"))
    end = F.array_position(closes, F.lit(True)).cast("int")
    return F.slice(lines, F.lit(1), F.when(end > 0, end).otherwise(F.size(lines)))


def read_labels(spark: SparkSession, path: str, max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """(format, code, label) of every label in the files at ``path``, padding kept in labels.

    A block is only known from the lines above, so each file is one row here
    before it is split into blocks and lines. Label files are code books of at
    most some thousand lines; one larger than ``max_bytes`` is refused.
    """
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    if (largest or 0) > max_bytes:
        raise ValueError(f"a label file of {largest} bytes is larger than {max_bytes}")
    blocks = (
        spark.read.text(path, wholetext=True)
        .select(F.split(F.regexp_replace("value", _COMMENT, ""), _BLOCK_START).alias("parts"))
        .select(F.explode(F.slice("parts", F.lit(2), F.size("parts"))).alias("block"))
    )
    lines = blocks.select(
        F.regexp_extract("block", _BLOCK_NAME, 1).alias("format"),
        F.explode(_body("block")).alias("line"),
    )
    return label_rows(lines)


def labels_of(labels: DataFrame, format: str) -> DataFrame:
    """(code, label) of one block."""
    return labels.where(F.col("format") == format).select("code", "label")
