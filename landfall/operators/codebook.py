"""Code books decoded from label rows ``(code, label)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import codes
from landfall.operators.keys import fixed
from landfall.operators.lookup import lookup_join


def label_rows(lines: DataFrame, line: str = "line") -> DataFrame:
    """(code, label) of every line that defines a label; other columns stay in front."""
    others = [c for c in lines.columns if c != line]
    return (
        lines.where(codes.is_label(line))
        .select(*others, codes.label_parts(line).alias("_parts"))
        .select(
            *others,
            codes.label_code("_parts").alias("code"),
            codes.label_text("_parts").alias("label"),
        )
    )


def decode_countries(labels: DataFrame) -> DataFrame:
    """code, label and class of each country label."""
    return labels.select(
        F.col("code").try_cast("int").alias("code"),
        F.trim("label").alias("label"),
        codes.country_class("label").alias("code_class"),
    )


def valid_countries(labels: DataFrame) -> DataFrame:
    """The country code book: the valid labels as (code, description)."""
    return (
        decode_countries(labels)
        .where("code_class = 'valid'")
        .select("code", F.col("label").alias("description"))
    )


def decode_ports(labels: DataFrame, states: DataFrame) -> DataFrame:
    """code, trimmed label, city and state of each port.

    Two closing capitals are a state only if ``states`` (code, label) lists
    them. Without a state the whole place stands as the city.
    """
    listed = states.select(
        F.col("code").alias("_listed"), F.col("code").alias("_state")
    ).distinct()
    ports = (
        labels.select(
            "code", F.trim("label").alias("label"), codes.port_place("label").alias("_place")
        )
        .withColumn("_parts", codes.port_parts("_place"))
        .withColumn("_candidate", F.get("_parts", F.lit(1)))
    )
    city = F.when(F.col("_state").isNotNull(), F.get("_parts", F.lit(0))).otherwise(F.col("_place"))
    return lookup_join(ports, listed, "_candidate", "_listed").select(
        "code", "label", city.alias("city"), F.col("_state").alias("state")
    )


def _chain_ends(hops: DataFrame) -> DataFrame:
    """(_from, _to) of the end of each chain of ``hops`` (_from, _to; each _from once).

    Every round doubles the hops that are followed, until none leads further or more hops
    were followed than there are, when what still moves runs in a circle. A round writes
    one table of a row per hop.
    """
    n, followed = hops.count(), 1
    while followed <= n:
        onward = hops.select(F.col("_from").alias("_next"), F.col("_to").alias("_after"))
        moved = fixed(
            hops.join(onward, hops["_to"] == onward["_next"], "left")
            .select("_from", F.coalesce("_after", "_to").alias("_to"), F.col("_after").isNotNull().alias("_moved"))
        )
        if moved.where("_moved").isEmpty():
            break
        hops, followed = moved.select("_from", "_to"), 2 * followed
    return hops


def resolve_port_aliases(labels: DataFrame) -> DataFrame:
    """code and label of each port; a collapsed port's target, and the port it ends at.

    Targets that are collapsed themselves are followed, however many, to a port that is
    not. A chain that ends at an unlisted code or runs in a circle has no resolved code and
    label. Of several labels under one code the lowest counts as target.
    """
    ports = labels.select(
        "code", F.trim("label").alias("label"), codes.port_alias_target("label").alias("target_code")
    )
    known = fixed(
        ports.groupBy("code").agg(F.min(F.struct("label", "target_code")).alias("_port"))
        .select(F.col("code").alias("_code"), "_port.*")
    )
    hops = _chain_ends(
        known.where(F.col("target_code").isNotNull())
        .select(F.col("_code").alias("_from"), F.col("target_code").alias("_to"))
    )
    ends = known.where(F.col("target_code").isNull()).select(
        F.col("_code").alias("_end"), F.col("label").alias("_label")
    )
    targets = hops.join(ends, hops["_to"] == ends["_end"]).select("_from", "_end", "_label")
    collapsed = F.col("target_code").isNotNull()
    through = fixed(targets.unionAll(ends.select(F.col("_end").alias("_from"), "_end", "_label")))
    return lookup_join(ports, through, "target_code", "_from").select(
        "code",
        "label",
        "target_code",
        F.when(collapsed, F.col("_end")).otherwise(F.col("code")).alias("resolved_code"),
        F.when(collapsed, F.col("_label")).otherwise(F.col("label")).alias("resolved_label"),
    )


def decode_states(df: DataFrame, states: DataFrame, code: str, name: str) -> DataFrame:
    """Add state name ``name`` for ``code``; codes outside the list fall under one label."""
    listed = states.groupBy(F.col("code").alias("_state")).agg(
        F.min(F.trim("label")).alias("_label")
    )
    return (
        lookup_join(df, listed, code, "_state")
        .withColumn(name, F.coalesce("_label", F.lit(codes.OTHER_STATE)))
        .drop("_label")
    )
