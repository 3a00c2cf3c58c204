"""Bloom filters of the record ids of each stored month.

Ids should be unique over all months, not only in one load. A filter per month, cut into
parts by the ids' hash, tells for most ids that a month does not hold them. A new load's
ids meet the filters part by part, and only months with a hit are read, their ids alone,
to tell real repeats from false ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS_PER_ID, _PROBES = 24, 8
#: Ids of a part of a filter, about; 200 KB. A filter has at most 2**_MOST_BITS parts.
_PART_IDS, _MOST_BITS = 1 << 16, 14

FILTERS = "part_bits int, part int, bits binary"
HITS = "arrival_year int, arrival_month int, immigration_id long, hash long"


def _hash(column: str) -> Column:
    return F.xxhash64(column)


def part_bits(rows: int) -> int:
    """How many leading bits of the hash number the parts of a month of so many rows."""
    return min(_MOST_BITS, max(0, -(-rows // _PART_IDS) - 1).bit_length())


def _part(bits: Column) -> Column:
    # A shift by 64 would be none.
    return F.when(bits == 0, 0).otherwise(F.expr("shiftrightunsigned(hash, 64 - part_bits)")).cast("int")


def _probes(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """Bit positions (probe, id) by double hashing of the hash's halves."""
    low, high = (hashes & np.uint64(0xFFFFFFFF)), (hashes >> np.uint64(22)) & np.uint64(0xFFFFFFFF)
    step = np.arange(_PROBES, dtype=np.uint64)[:, None]
    return (low + step * (high | np.uint64(1))) % np.uint64(n_bits)


def filter_bits(hashes: np.ndarray) -> bytes:
    n_bits = max(64, -(-len(hashes) * _BITS_PER_ID // 64) * 64)
    bits = np.zeros(n_bits, bool)
    bits[_probes(hashes, n_bits).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    packed = np.frombuffer(bits, np.uint8)
    at = _probes(hashes, 8 * len(packed))
    found = np.ones(len(hashes), bool)
    for probe in at:
        rows = np.flatnonzero(found)
        own = probe[rows]
        found[rows] = (packed[own >> np.uint64(3)] >> (np.uint8(7) - (own & np.uint64(7)).astype(np.uint8))) & 1 == 1
    return found


def build_filters(fact: DataFrame, months: list[tuple[int | None, int | None, int]], by: tuple[str, str]) -> DataFrame:
    """(part_bits, part, bits, by...) of the ids of each month; a part without an id has no row.

    ``months`` has year, month and number of rows of each. Null ids are in no filter. Ids
    are made distinct before they are grouped, so copies of one id are no hot group.
    """
    year, month = by

    def build(key: tuple, table: pa.Table) -> pa.Table:
        bits = filter_bits(table["hash"].to_numpy().view(np.uint64))
        row = [*[pa.array([k.as_py()], pa.int32()) for k in key[2:]], pa.array([bits], pa.binary())]
        return pa.Table.from_arrays([*row, *[pa.array([k.as_py()], pa.int32()) for k in key[:2]]], names=["part_bits", "part", "bits", *by])

    sizes = fact.sparkSession.createDataFrame([(y, m, part_bits(n)) for y, m, n in months], "_year int, _month int, part_bits int")
    ids = fact.where("immigration_id is not null").select(*by, _hash("immigration_id").alias("hash")).distinct()
    # A row per month of the load.
    same = ids[year].eqNullSafe(sizes["_year"]) & ids[month].eqNullSafe(sizes["_month"])
    parted = ids.join(F.broadcast(sizes), same).withColumn("part", _part(F.col("part_bits")))
    grouped = parted.groupBy(*by, "part_bits", "part")
    return grouped.applyInArrow(build, FILTERS + "".join(f", {name} int" for name in by))


def hits(ids: DataFrame, filters: DataFrame, most_bits: int) -> DataFrame:
    """(arrival_year, arrival_month, immigration_id, hash) of every id that a month's filter may hold.

    Both sides are dealt by the parts of the largest filters, of which ``most_bits`` is the
    part_bits; a part of a smaller filter goes to all of these that it covers. A task tests
    its ids against one filter after another.
    """
    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"arrival_year": [], "arrival_month": [], "immigration_id": [], "hash": []}
        own, hashes = left["immigration_id"].to_numpy(), left["hash"].to_numpy()
        for row in right.to_pylist():
            found = may_hold(row["bits"], hashes.view(np.uint64))
            n = int(found.sum())
            out["arrival_year"] += [row["arrival_year"]] * n
            out["arrival_month"] += [row["arrival_month"]] * n
            out["immigration_id"] += own[found].tolist()
            out["hash"] += hashes[found].tolist()
        types = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
        return pa.table({name: pa.array(x, t) for (name, x), t in zip(out.items(), types)})

    own = ids.where("immigration_id is not null").select("immigration_id").distinct()
    left = own.withColumns({"hash": _hash("immigration_id"), "part_bits": F.lit(most_bits)})
    left = left.withColumn("part", _part(F.col("part_bits"))).drop("part_bits")
    covered = f"shiftleft(1, {most_bits} - part_bits)"
    right = filters.withColumn("part", F.explode(F.expr(f"sequence(part * {covered}, (part + 1) * {covered} - 1)")))
    return left.groupBy("part").cogroup(right.groupBy("part")).applyInArrow(probe, HITS)
