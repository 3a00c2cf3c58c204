"""Versions of the stored star schema, each visible as a whole or not at all.

A load writes its tables to new folders, ``<table>/load=<id>``, and becomes visible by one
rename of a small file that says which folders make up the version: one for every
dimension, and for the fact one for every month, most of them from earlier loads. Readers
keep the version they opened, as no folder is ever written to twice. What a failed load
has written is removed when it fails, or by the next load if it could not.

There is one load at a time. If two run by mistake, the later to finish is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import schemas
from landfall.operators.id_filters import build_filters, hits, part_bits
from landfall.operators.keys import fixed
from landfall.operators.ranking import counts_by
from landfall.sources.files import Files
from landfall.sources.paths import TABLES, Warehouse, join_path

PARTITION_COLUMNS = ("arrival_year", "arrival_month")
# What the file layout names the folder of a missing value.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: Tables that are stored by month; the others are replaced whole.
BY_MONTH = ("immigration_fact", "daily_arrivals", "id_filters")
#: What the rows of a month are sorted by in its files.
CLUSTERED_BY = ("visa_category", "destination_state", "port_of_entry")

Month = tuple[int | None, int | None]


class LoadRefused(RuntimeError):
    """Another load was published in the meantime."""


@dataclass(frozen=True)
class StoredMonth:
    arrival_year: int | None
    arrival_month: int | None
    load: str  # whose folder holds the month
    arrivals: int
    first_date: str | None
    last_date: str | None
    filtered: bool = False  # whether a filter of its ids is stored

    @property
    def month(self) -> Month:
        return self.arrival_year, self.arrival_month

    def folder(self, table: str) -> str:
        """The month's folder of one table, which only this load writes to."""
        named = zip(PARTITION_COLUMNS, self.month)
        return join_path(table, f"load={self.load}", *[f"{c}={_NULL_FOLDER if v is None else v}" for c, v in named])


@dataclass(frozen=True)
class Version:
    number: int = 0
    load: str = ""
    tables: dict[str, str] = field(default_factory=dict)  # the load of each table that is replaced whole
    months: tuple[StoredMonth, ...] = ()
    notes: dict = field(default_factory=dict)  # what the load reports of itself

    def as_text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of(cls, text: str) -> Version:
        fields = json.loads(text)
        return cls(**fields | {"months": tuple(StoredMonth(**m) for m in fields["months"])})


class Store:
    def __init__(self, spark: SparkSession, warehouse: Warehouse):
        self.spark, self.warehouse, self.files = spark, warehouse, Files(spark)
        self.log = join_path(warehouse.root, "_versions")

    def _number(self, name: str) -> int:
        return int(name.removesuffix(".json"))

    def numbers(self) -> list[int]:
        """Published versions that are kept, oldest first."""
        return [self._number(n) for n in self.files.names(self.log) if n.endswith(".json")]

    def at(self, number: int) -> str:
        return join_path(self.log, f"{number:012d}.json")

    def version(self, number: int | None = None) -> Version:
        """One version, the latest if not named; number 0 if nothing is published."""
        if number is None:
            number = max(self.numbers(), default=0)
        return Version.of(self.files.read(self.at(number))) if number else Version()

    # Reading.

    def table(self, name: str, version: Version | None = None, months: Iterable[StoredMonth] | None = None) -> DataFrame:
        """A table of a version, or some months of it; filters on year and month prune folders."""
        version = version or self.version()
        schema, folder = schemas.STORED[name], self.warehouse.path(name)
        if name in BY_MONTH:
            return self._folders(name, [m.folder(folder) for m in (version.months if months is None else months)])
        if name not in version.tables:
            return self.spark.createDataFrame([], schema)
        path = join_path(folder, f"load={version.tables[name]}")
        return self.spark.read.schema(schema).parquet(path)

    def _folders(self, name: str, folders: list[str]) -> DataFrame:
        schema = schemas.STORED[name]
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.warehouse.path(name))
        return reader.parquet(*folders).select(*schema.names)

    def ranges(self, version: Version | None = None) -> DataFrame:
        """First and last date in each month of the fact."""
        rows = [(*m.month, m.first_date, m.last_date) for m in (version or self.version()).months]
        text = T.StructType([
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType) for f in schemas.FACT_RANGES
        ])
        dated = self.spark.createDataFrame(rows, text)
        return dated.select(*[F.col(f.name).cast(f.dataType) for f in schemas.FACT_RANGES])

    # Loading.

    def load(self, replace_all: bool = False, keep: int = 2) -> Load:
        """A new load, to be used as a context: it is taken back unless it was published.

        ``keep`` versions stay readable after it, the new one among them.
        """
        return Load(self, replace_all, keep)

    def _marker(self, load: str) -> str:
        return join_path(self.log, f"begun-{load}")

    def take_back(self, load: str) -> None:
        """Remove all that a load wrote, and then the mark that it was begun."""
        for table in TABLES:
            self.files.remove(join_path(self.warehouse.path(table), f"load={load}"))
        self.files.remove(self._marker(load))

    def recover(self) -> list[str]:
        """Take back loads that were begun and neither published nor taken back; their ids."""
        begun = [n.removeprefix("begun-") for n in self.files.names(self.log) if n.startswith("begun-")]
        published = {self.version(n).load for n in self.numbers()} if begun else set()
        failed = [load for load in begun if load not in published]
        for load in begun:
            if load in failed:
                self.take_back(load)
            else:
                self.files.remove(self._marker(load))
        return failed

    def expire(self, keep: int) -> None:
        """Forget all but the last ``keep`` versions, and remove the folders that no kept one names."""
        numbers = self.numbers()
        old, kept = numbers[:-keep], [self.version(n) for n in numbers[-keep:]]
        gone = [self.version(n) for n in old]
        for n in old:
            self.files.remove(self.at(n))
        for name in TABLES:
            root = self.warehouse.path(name)
            used = {f for v in kept for f in self._named(name, root, v)}
            for path in {f for v in gone for f in self._named(name, root, v)} - used:
                self.files.remove(path)

    def _named(self, name: str, root: str, version: Version) -> list[str]:
        if name in BY_MONTH:
            return [m.folder(root) for m in version.months if name != "id_filters" or m.filtered]
        return [join_path(root, f"load={version.tables[name]}")] if name in version.tables else []


class Load:
    """Tables of a version in the making, based on the latest published one."""

    def __init__(self, store: Store, replace_all: bool, keep: int):
        self.store, self.replace_all, self.keep = store, replace_all, max(1, keep)
        self.base, self.id = Version(), ""
        self.tables: dict[str, str] = {}
        self.months: list[StoredMonth] = []
        self.covered: set[Month] = set()
        self.notes: dict = {}

    def __enter__(self) -> Load:
        self.store.recover()
        self.base = self.store.version()
        # Notes stay until a load writes them anew.
        self.notes = dict(self.base.notes)
        self.id = f"{self.base.number + 1:08d}-{uuid.uuid4().hex[:12]}"
        self.store.files.write(self.store._marker(self.id), "")
        return self

    def __exit__(self, failure, *_: object) -> None:
        # Reached after publication as well, when the marker is gone.
        if self.store.files.exists(self.store._marker(self.id)):
            self.store.take_back(self.id)

    def _path(self, table: str) -> str:
        return join_path(self.store.warehouse.path(table), f"load={self.id}")

    def write_table(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table that is replaced whole, and read it back."""
        df.select(*schemas.STORED[name].names).write.parquet(self._path(name))
        self.tables[name] = self.id
        return self.store.spark.read.schema(schemas.STORED[name]).parquet(self._path(name))

    def write_fact(self, fact: DataFrame, rebalance: bool = True) -> None:
        """Write fact rows by year and month, then what is known of each month.

        ``rebalance`` shuffles rows to their month first, with large months split over
        several tasks, as files that mix many months would otherwise leave many small
        files. Within its files a month is sorted by the columns that reports filter on, so
        a scan skips row groups by their ranges and dictionaries. The rows are computed once: arrivals per day, mode and visa category are
        counted from three columns of the written files, and the months' ranges and
        numbers of rows are sums over these counts.
        """
        rows = fact.select(*[c for c in schemas.FACT.names if c in fact.columns])
        if rebalance:
            rows = rows.hint("rebalance", *PARTITION_COLUMNS)
        # The writer sorts by month in any case.
        rows = rows.sortWithinPartitions(*PARTITION_COLUMNS, *[c for c in CLUSTERED_BY if c in rows.columns])
        rows.write.partitionBy(*PARTITION_COLUMNS).parquet(self._path("immigration_fact"))
        reader = self.store.spark.read.schema(schemas.FACT)
        written = reader.parquet(self._path("immigration_fact"))
        daily = counts_by(written, *PARTITION_COLUMNS, "arrival_date", "travel_mode", "visa_category")
        daily.repartition(*PARTITION_COLUMNS).write.partitionBy(*PARTITION_COLUMNS).parquet(self._path("daily_arrivals"))
        stored = self.store.spark.read.schema(schemas.DAILY).parquet(self._path("daily_arrivals"))
        ranges = stored.groupBy(*PARTITION_COLUMNS).agg(
            F.sum("arrivals").alias("arrivals"),
            F.min("arrival_date").cast("string").alias("first_date"), F.max("arrival_date").cast("string").alias("last_date"),
        )
        # One row per month of the load.
        self.months = [
            StoredMonth(r["arrival_year"], r["arrival_month"], self.id, r["arrivals"], r["first_date"], r["last_date"])
            for r in ranges.collect()
        ]
        self.covered |= {m.month for m in self.months}

    def write_id_filters(self) -> None:
        """Write a filter of the ids of each month; months loaded without one are always read."""
        sizes = [(*m.month, m.arrivals) for m in self.months]
        filters = build_filters(self.own("immigration_fact"), sizes, PARTITION_COLUMNS)
        filters.write.partitionBy(*PARTITION_COLUMNS).parquet(self._path("id_filters"))
        self.months = [replace(m, filtered=True) for m in self.months]

    def repeated_ids(self) -> DataFrame:
        """(immigration_id, arrival_year, arrival_month) of the load's ids that another month holds.

        Of the other months' fact, only those are read whose filter may hold one of the
        ids, and of these only the ids.
        """
        others = [m for m in self.version.months if m.load != self.id]
        if not others:
            return self.store.table("immigration_fact", months=[]).select("immigration_id", *PARTITION_COLUMNS)
        ids = self.own("immigration_fact").select("immigration_id")
        filtered, blind = [m for m in others if m.filtered], [m for m in others if not m.filtered]
        most_bits = max((part_bits(m.arrivals) for m in filtered), default=0)
        found = fixed(hits(ids, self.store.table("id_filters", months=filtered), most_bits))
        # One row per month at most.
        hit = {tuple(r) for r in found.select(*PARTITION_COLUMNS).distinct().collect()}
        doubtful = self.store.table("immigration_fact", months=[m for m in filtered if m.month in hit])
        columns = ("immigration_id", *PARTITION_COLUMNS)
        sure = doubtful.select(*columns).join(found.select("immigration_id").distinct(), "immigration_id", "left_semi")
        if not blind:
            return sure.distinct()
        unfiltered = self.store.table("immigration_fact", months=blind).select(*columns)
        return sure.unionAll(unfiltered.join(ids.distinct(), "immigration_id", "left_semi")).distinct()

    def covers(self, months: Iterable[Month]) -> None:
        """Months that the load brings whole, also those of which it has no row: these are cleared."""
        self.covered |= set(months)

    @property
    def rows(self) -> int:
        return sum(m.arrivals for m in self.months)

    @property
    def version(self) -> Version:
        """What would be published now: covered months are replaced, the others stay."""
        kept = () if self.replace_all else tuple(m for m in self.base.months if m.month not in self.covered)
        return Version(
            self.base.number + 1, self.id, self.base.tables | self.tables,
            tuple(sorted((*kept, *self.months), key=lambda m: repr(m.month))), self.notes,
        )

    def table(self, name: str) -> DataFrame:
        """A table as it will be once the load is published."""
        return self.store.table(name, self.version)

    def own(self, name: str) -> DataFrame:
        """The rows of a table by month that this load has written."""
        return self.store.table(name, months=self.months)

    def publish(self) -> Version:
        """Make the load visible, by one rename; then remove what no kept version needs."""
        version, files = self.version, self.store.files
        staged = join_path(self.store.log, f"staged-{self.id}")
        files.write(staged, version.as_text())
        place = self.store.at(version.number)
        if files.exists(place) or not files.rename(staged, place):
            files.remove(staged)
            raise LoadRefused(f"version {version.number} was published by another load")
        files.remove(self.store._marker(self.id))
        self.store.expire(self.keep)
        return version
