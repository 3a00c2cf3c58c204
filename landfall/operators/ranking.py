"""Grouped counts and top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_by(df: DataFrame, *by: str | Column, name: str = "arrivals") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias(name))


def top_k(
    counts: DataFrame, k: int, *tie_break: str, measure: str = "arrivals", keep_ties: bool = False
) -> DataFrame:
    """The k rows largest in ``measure``; equal rows in ``tie_break`` order.

    With ``keep_ties`` all rows equal to the k-th stay, found against one scalar
    threshold instead of a window over all groups.
    """
    order = [F.desc(measure), *tie_break]
    top = counts.orderBy(*order).limit(k)
    if not keep_ties:
        return top
    threshold = top.agg(F.min(measure).alias("threshold")).scalar()
    return counts.where(F.col(measure) >= threshold).orderBy(*order)
