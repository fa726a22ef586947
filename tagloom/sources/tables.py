"""Dated tables: `<base>/<table>/dt=<yyyyMMdd>/<version>` as parquet.

A day is published by one marker, an empty file whose name says which version holds. Versions are
numbered, and the one with the highest marker is read. So a reader sees one whole version at any time, whatever
step a writer is at or was killed at, also on stores where a folder can't be renamed at once.
"""

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from tagloom.functions.dates import run_suffix
from tagloom.operators.unique import duplicate_keys
from tagloom.session import create_marker, delete_path, names_in

_MARKERS = "_versions"
_DROPPED = "dropped"


class DatedTables:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def folder(self, table: str, run_date: dt.date) -> str:
        """The folder of all versions of a day."""
        return f"{self.base}/{table}/dt={run_suffix(run_date)}"

    def _markers(self, table: str, run_date: dt.date) -> list[str]:
        return names_in(self.spark, f"{self.folder(table, run_date)}/{_MARKERS}")

    def _publish(self, table: str, run_date: dt.date, version: str) -> None:
        """Make `version` the one that is read."""
        last = max((int(marker.split("-")[0]) for marker in self._markers(table, run_date)), default=0)
        create_marker(self.spark, f"{self.folder(table, run_date)}/{_MARKERS}/{last + 1:012}-{version}")

    def path(self, table: str, run_date: dt.date) -> str | None:
        """The folder of the version that is read, if there is one."""
        markers = self._markers(table, run_date)
        version = markers[-1].split("-", 1)[1] if markers else _DROPPED
        return None if version == _DROPPED else f"{self.folder(table, run_date)}/{version}"

    def exists(self, table: str, run_date: dt.date) -> bool:
        """Whether the day was written to its end."""
        return self.path(table, run_date) is not None

    def latest_before(self, table: str, run_date: dt.date) -> dt.date | None:
        """The last day before `run_date` that the table has."""
        names = names_in(self.spark, f"{self.base}/{table}")
        days = [dt.datetime.strptime(name[3:], "%Y%m%d").date() for name in names if name.startswith("dt=")]
        return next((day for day in sorted(days, reverse=True)
                     if day < run_date and self.exists(table, day)), None)

    def write(self, df: DataFrame, table: str, run_date: dt.date, keys: Sequence[str] = (),
              partitions: int | None = None, check_keys: bool = True) -> None:
        """Replace one day of a table, so that a repeated run leaves the same rows.

        The rows are written as a new version, which is published when it is complete. Rows
        with repeated `keys` are refused, and the old ones stay. `partitions` lays the day out
        in that many files by the hash of the keys; without it the rows are written where they are.
        The version before stays for those who are reading it; older ones, and what killed writers
        left, are deleted.
        """
        if partitions is not None:
            df = df.repartition(partitions, *keys)
        before, folder = self.path(table, run_date), self.folder(table, run_date)
        version = uuid.uuid4().hex
        try:
            df.write.parquet(f"{folder}/{version}")
            if keys and check_keys:
                written = self.spark.read.schema(df.schema).parquet(f"{folder}/{version}")
                if not duplicate_keys(written, keys).isEmpty():
                    raise ValueError(f"{table}: key {tuple(keys)} is not unique")
            self._publish(table, run_date, version)
        except BaseException:
            delete_path(self.spark, f"{folder}/{version}")
            raise
        kept = {version, before and before.rsplit("/", 1)[1]}
        self._clear(table, run_date, kept)

    def _clear(self, table: str, run_date: dt.date, kept: set) -> None:
        """Delete the versions that are not `kept`, and all markers but the last one."""
        folder = self.folder(table, run_date)
        for marker in self._markers(table, run_date)[:-1]:
            delete_path(self.spark, f"{folder}/{_MARKERS}/{marker}")
        for name in names_in(self.spark, folder):
            if name not in kept and name != _MARKERS:
                delete_path(self.spark, f"{folder}/{name}")

    def append(self, df: DataFrame, table: str, run_date: dt.date) -> None:
        """Add rows to the version that is read, or write the first one."""
        path = self.path(table, run_date)
        if path is None:
            self.write(df, table, run_date)
        else:
            df.write.mode("append").parquet(path)

    def read(self, table: str, run_date: dt.date, columns: Sequence[str] = ()) -> DataFrame:
        path = self.path(table, run_date)
        if path is None:
            raise ValueError(f"{table} of {run_date} is missing")
        df = self.spark.read.parquet(path)
        return df.select(*columns) if columns else df

    def read_or_empty(self, table: str, run_date: dt.date, schema: T.StructType,
                      first_run: bool = False) -> DataFrame:
        """A day that was never written is an error, but for the first run, for which it is empty."""
        if self.exists(table, run_date):
            return self.read(table, run_date)
        if not first_run:
            raise ValueError(f"{table} of {run_date} is missing; run that day first")
        return self.spark.createDataFrame([], schema)

    def drop(self, table: str, run_date: dt.date) -> None:
        """Drop one day if it exists."""
        if self.exists(table, run_date):
            self._publish(table, run_date, _DROPPED)
            self._clear(table, run_date, set())
