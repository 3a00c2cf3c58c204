"""Null cleaning of arrival records, and its audit."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from landfall.functions import dates

# Order matters to the audit: a row is charged to the first of these that is null.
REQUIRED = ("arrdate", "depdate", "i94mode", "i94visa", "biryear", "gender")


def _all_present(columns) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))


def clean_arrivals(df: DataFrame, required=REQUIRED) -> DataFrame:
    """Rows with a value in every required column. NaN counts as a value."""
    return df.where(_all_present(required))


def audit_counts(required=REQUIRED) -> list[Column]:
    """Aggregates: rows read, rows removed per column, rows kept, and kept rows without a date."""
    removed = [
        F.count_if(_all_present(required[:i]) & F.col(c).isNull()).alias(f"removed_{c}")
        for i, c in enumerate(required)
    ]
    kept = _all_present(required)
    undated = [
        F.count_if(kept & dates.day_number_to_date(c).isNull()).alias(f"undated_{c}")
        for c in ("arrdate", "depdate")
        if c in required
    ]
    return [F.count("*").alias("total_rows"), *removed, F.count_if(kept).alias("kept_rows"), *undated]


def balanced(required=REQUIRED) -> Column:
    """Whether the rows of an audit are all accounted for."""
    accounted = reduce(lambda a, b: a + b, [F.col(f"removed_{c}") for c in required], F.col("kept_rows"))
    return F.col("total_rows") == accounted


def null_audit(df: DataFrame, required=REQUIRED) -> DataFrame:
    """One row: rows read, rows removed per column, rows kept, and whether they add up.

    Also counts kept rows whose day number stands for no date. One pass.
    """
    return df.agg(*audit_counts(required)).withColumn("balanced", balanced(required))


class Audited:
    """The same audit, and the months of the records, taken while another job reads the rows.

    ``rows`` is the data with the counts attached; they are there once a job has read it.
    """

    def __init__(self, raw: DataFrame, required=REQUIRED):
        self.raw, self.required, self._seen = raw, required, Observation()
        year, month = (F.col(c).try_cast("int").alias(c) for c in ("i94yr", "i94mon"))
        # A few hundred months at most.
        self._months = F.collect_set(F.struct(year, month)).alias("months")
        self.rows = raw.observe(self._seen, *audit_counts(required), self._months)

    def result(self, stored_rows: int) -> tuple[DataFrame, list[tuple[int | None, int | None]]]:
        """The audit as ``null_audit`` gives it, and the months.

        Counts are added up per task, so a task that Spark repeats after losing an executor
        may count twice, and a plan found to be empty has none. Unless they agree with the
        rows that were stored, the records are read once more.
        """
        try:
            found = self._seen.get
        except Py4JJavaError:
            found = None
        if found is None or found["kept_rows"] != stored_rows:
            found = self.raw.agg(*audit_counts(self.required), self._months).first().asDict()
        months = [tuple(m) for m in found["months"]]
        counts = {name: n for name, n in found.items() if name != "months"}
        schema = ", ".join(f"{name} long" for name in counts)
        audit = self.raw.sparkSession.createDataFrame([tuple(counts.values())], schema)
        return audit.withColumn("balanced", balanced(self.required)), months
