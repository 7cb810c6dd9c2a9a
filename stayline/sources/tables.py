"""Result tables on shared storage.

A table is a folder of Parquet with a ``run_date`` for every run. Runs are published as
snapshots: a run's tables, and the replacement of an earlier run of the same date, become
visible together or not at all. The second partition column lets readers skip whole levels of
risk or urgency.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import with_computed
from ..schemas import TABLE_RULES
from .snapshots import Snapshots

PARTITION_BY = {
    "churn_scores": "risk_level",
    "recommendations": "urgency",
}


def _in_path(value: str) -> str:
    """A partition value as Spark writes it into a folder name."""
    return re.sub(r"""[\x01-\x1F\x7F"#%'*/:=?\\{\[\]^]""", lambda c: f"%{ord(c[0]):02X}", value)


class ResultTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.snapshots = Snapshots(spark, root)
        self._base, self._staged, self._schemas = None, {}, {}

    @contextmanager
    def publishing(self) -> Iterator[None]:
        """What is written inside becomes visible together, at the end."""
        if self._base is not None:
            raise RuntimeError("already publishing")
        self._base, self._staged, self._schemas = self.snapshots.current(), {}, {}
        try:
            yield
            if self._staged:
                self.snapshots.publish(self._base, self._staged, schemas=self._schemas)
        finally:
            self._base, self._staged, self._schemas = None, {}, {}

    def stage(self, table: str, run_date: dt.date, report: str | None = None) -> str:
        """A new folder for a run's rows; it takes the place of an earlier one of the run."""
        if self._base is None:
            raise RuntimeError("stage only inside publishing()")
        write, path = self.snapshots.new_folder(table)
        path += f"/run_date={run_date.isoformat()}"
        part = run_date.isoformat()
        if report is not None:
            path, part = f"{path}/report={_in_path(report)}", f"{part}/{report}"
        self._staged[table, part] = write
        return path

    def write_run(
        self, table: str, df: DataFrame, run_date: dt.date, report: str | None = None
    ) -> DataFrame:
        """Replace the run's rows, then read them back: that cuts the lineage.

        Reports are kept side by side: ``report`` names one of several of a date.
        """
        if self._base is None:
            with self.publishing():
                return self.write_run(table, df, run_date, report)
        path = self.stage(table, run_date, report)
        kept = T.StructType([*df.schema.fields, T.StructField("run_date", T.DateType())])
        if report is not None:
            kept = kept.add("report", T.StringType())
        self._schemas[table] = kept.json()
        writer = df.write
        if table in PARTITION_BY:
            writer = writer.partitionBy(PARTITION_BY[table])
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def read(self, table: str) -> DataFrame:
        """All published runs, with the ``run_date`` column."""
        return self.snapshots.read(table)


def upsert(
    existing: DataFrame, changes: DataFrame, key: str = "user_id", version: str | None = None
) -> DataFrame:
    """``existing`` with the rows of ``changes`` in place of those of the same key.

    Of several changes of one key the last by ``version`` counts, of equal ones
    the largest row; a key repeated endlessly collapses map-side. Write the
    result to a new folder, never over the one being read.
    """
    columns = existing.columns
    row = F.struct(*columns)
    order = F.struct(F.col(version), row) if version else row
    last = (
        changes.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, order).alias("row"))
        .select("row.*")
    )
    kept = existing.join(last.select(key), key, "left_anti")
    return kept.select(*columns).unionByName(last.select(*columns))


def save_clustered(
    df: DataFrame, path: str, cluster_by: list[str], partition_by: str | None = None
) -> None:
    """Store a table for lookups: folders by one column, files sorted by others.

    Row-group statistics then skip nearly everything in a lookup by the leading
    column. Ranges over several columns also split one user's many rows; put
    the row's own key last, for instance ``["user_id", "ticket_id"]``.
    """
    keys = ([partition_by] if partition_by else []) + cluster_by
    writer = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


LOOKUP_BITS = 10  # of each column of a layout


def _place(df: DataFrame, name: str) -> Column:
    """A column's values as places from 0 to ``2 ** LOOKUP_BITS - 1``: listed values and dates in
    their order, others by a hash. NULL comes first."""
    size, column = 1 << LOOKUP_BITS, F.col(name)
    domain = {d: v for rules in TABLE_RULES.values() for d, v in rules.domains.items()}.get(name)
    if domain:
        place = F.array_position(F.array(*map(F.lit, domain)), column) * (size // (len(domain) + 1))
    elif isinstance(df.schema[name].dataType, (T.DateType, T.NumericType)):
        number = F.unix_date(column) if isinstance(df.schema[name].dataType, T.DateType) else column
        low, high = df.agg(F.min(number), F.max(number)).first()
        if low is None:
            return F.lit(0).cast("bigint")
        place = F.floor((number - F.lit(low)) * (size - 1) / F.lit(max(high - low, 1)))
    else:
        place = F.pmod(F.xxhash64(column), F.lit(size))
    return F.coalesce(place, F.lit(0)).cast("bigint")


def interleaved(places: list[Column]) -> Column:
    """One number from several, their bits taken in turn: rows near in it are near in each."""
    total = F.lit(0).cast("bigint")
    for bit in range(LOOKUP_BITS):
        for number, place in enumerate(places):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1))
            total = total + F.shiftleft(one, bit * len(places) + number)
    return total


# Columns that readers look rows up by; the user's is also held in bloom filters.
LOOKUPS = {
    "feature_usage": ["user_id", "feature", "last_used_date"],
    "support_tickets": ["user_id", "status", "created_date"],
    "churn_scores": ["user_id", "risk_level", "score"],
    "recommendations": ["user_id", "urgency"],
}


def save_lookup(df: DataFrame, path: str, by: list[str], files: int | None = None) -> None:
    """Store a table so that a lookup by any of the columns reads a small share of it.

    Rows are dealt by range over the interleaved bits of the columns, and within a place by a hash
    of the row: an account with very many rows fills several files. ``files`` is left to
    adaptive execution unless given.
    """
    keyed = with_computed(df, {"_place": interleaved([_place(df, c) for c in by])}).withColumn(
        "_row", F.xxhash64(*df.columns)
    )
    order = ["_place", "_row"]
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).drop(*order).write.option(
        "parquet.bloom.filter.enabled#user_id", "true"
    ).parquet(path)
