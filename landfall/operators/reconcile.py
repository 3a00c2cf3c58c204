"""Names of two lists that mean the same though they are spelt differently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.functions import text
from landfall.operators.keys import fixed

#: Names meet if they share one of their rarest words.
_RARE_WORDS = 2


def similarity(a: str, b: str) -> Column:
    """1 less the edits per character of the longer name."""
    longer = F.greatest(F.length(a), F.length(b))
    return 1 - F.levenshtein(a, b) / longer


def _rare_words(names: DataFrame, side: str) -> DataFrame:
    words = names.withColumn("word", F.explode(F.array_distinct(F.split("name_key", " "))))
    return words.withColumn("side", F.lit(side))


def reconcile(names: DataFrame, known: DataFrame, least: float = 0.8) -> DataFrame:
    """(name_key, known_key, score) for names without an equal that have a likely one.

    Both tables have one column of names, which are compared by ``name_key``. Names that
    are equal by it are left out on both sides, as they need no mapping. The others meet
    over the rarest words of each, so a word that all names have brings no pairs. A pair
    is taken if each is the other's best, the first in order of equally good ones, and
    their similarity is at least ``least``. Nulls and names without a letter or digit are
    left out. No name occurs twice on either side of the result.
    """
    def keys(df: DataFrame) -> DataFrame:
        key = text.name_key(df.columns[0]).alias("name_key")
        return df.select(key).where(F.col("name_key") != "").distinct()

    left, right = fixed(keys(names)), fixed(keys(known))
    words = _rare_words(left.join(right, "name_key", "left_anti"), "a").unionAll(
        _rare_words(right.join(left, "name_key", "left_anti"), "b")
    )
    common = words.groupBy("word").agg(F.count("*").alias("names"))
    rarest = F.row_number().over(Window.partitionBy("side", "name_key").orderBy("names", "word"))
    rare = fixed(words.join(common, "word").withColumn("rarity", rarest).where(F.col("rarity") <= _RARE_WORDS))
    a = rare.where("side = 'a'").select("word", "name_key")
    b = rare.where("side = 'b'").select("word", F.col("name_key").alias("known_key"))
    pairs = a.join(b, "word").select("name_key", "known_key").distinct()
    scored = pairs.withColumn("score", similarity("name_key", "known_key")).where(F.col("score") >= least)
    best = {
        "_a": F.row_number().over(Window.partitionBy("name_key").orderBy(F.desc("score"), "known_key")),
        "_b": F.row_number().over(Window.partitionBy("known_key").orderBy(F.desc("score"), "name_key")),
    }
    return scored.withColumns(best).where("_a = 1 and _b = 1").drop("_a", "_b")
