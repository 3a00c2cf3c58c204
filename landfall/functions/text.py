"""Text helpers for names, regions and coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_name(col: str) -> Column:
    """Trimmed, with each space-separated word capitalised."""
    return F.initcap(F.trim(F.col(col)))


def name_key(col: str) -> Column:
    """Key under which two spellings of a name meet: lower case, punctuation as one space."""
    return F.trim(F.regexp_replace(F.lower(F.col(col)), r"[^\p{L}\p{N}]+", " "))


def region_state(col: str) -> Column:
    """State part of a region such as ``US-CA``."""
    return F.substring(F.col(col), 4, 2**31 - 1)


def coordinate(col: str, index: int) -> Column:
    """One number of an ``a, b`` pair; null when missing or not a number."""
    return F.get(F.split(F.col(col), r",\s*"), F.lit(index)).try_cast("double")
