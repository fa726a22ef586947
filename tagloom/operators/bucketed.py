"""Keyed tables laid out in buckets, whose joins need no shuffle.

The rows of a table lie in `buckets` files by the hash of the key, sorted by it. Two tables with equal keys
and numbers of buckets are joined, or one is changed by the other, bucket by bucket where they lie. A lookup of
given keys reads their buckets only, and within these the row groups that may hold them, as Parquet's
least and greatest values and Bloom filters of the key tell.

A change writes a new version, a table of its own, and then lets the name point to it: the name is a view of the
version that holds, replaced in one step of the catalog. So readers see the table before or after the change.
"""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.operators.unique import duplicate_keys

_OLD, _NEW = "_old_row", "_new_row"


class BucketedTable:
    """The version before the last stays for those who are reading it; older ones are dropped."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], buckets: int):
        self.spark, self.name, self.keys, self.buckets = spark, name, list(keys), buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def versions(self) -> list[str]:
        """All versions, also those of killed writers."""
        prefix = f"{self.name}__"
        return sorted(t.name for t in self.spark.catalog.listTables() if t.name.startswith(prefix))

    def version(self) -> str | None:
        """The version that is read."""
        if not self.exists():
            return None
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").where("key = 'version'").first()["value"]

    def write(self, rows: DataFrame, shuffle: bool = True) -> None:
        """Replace all rows. Repeated keys are refused, and the old rows stay. `shuffle` is needed unless the
        rows are those of bucketed tables with the same layout."""
        if shuffle:
            rows = rows.repartition(self.buckets, *self.keys)
        version = f"{self.name}__{uuid.uuid4().hex}"
        before = self.version()
        writer = rows.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        try:
            writer.saveAsTable(version)
            if not duplicate_keys(self.spark.table(version), self.keys).isEmpty():
                raise ValueError(f"{self.name}: key {tuple(self.keys)} is not unique")
            self._publish(version)
        except BaseException:
            if self.version() != version:
                self.spark.sql(f"DROP TABLE IF EXISTS {version}")
            raise
        for old in self.versions():
            if old not in (version, before):
                self.spark.sql(f"DROP TABLE {old}")

    def _publish(self, version: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('version' = '{version}') "
                       f"AS SELECT * FROM {version}")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def lookup(self, *values) -> DataFrame:
        """Rows whose key, a single column, is one of the values; other buckets are not read."""
        key, = self.keys
        return self.read().where(F.col(key).isin(list(values)))

    def join(self, other: "BucketedTable", how: str = "inner") -> DataFrame:
        """Both tables by their key, without moving either."""
        self._same_layout(other)
        return self.read().hint("merge").join(other.read(), self.keys, how)

    def _same_layout(self, other: "BucketedTable") -> None:
        if (self.keys, self.buckets) != (other.keys, other.buckets):
            raise ValueError(f"{self.name} and {other.name} are laid out differently")

    def upsert(self, other: "BucketedTable") -> None:
        """Rows of `other` replace those with the same key and are added otherwise."""
        self.write(self._matched(other, "full_outer", F.coalesce(_NEW, _OLD)), shuffle=False)

    def delete(self, other: "BucketedTable") -> None:
        """Drop the rows whose key is in `other`."""
        self._same_layout(other)
        kept = self.read().hint("merge").join(other.read().select(*self.keys), self.keys, "left_anti")
        self.write(kept, shuffle=False)

    def update(self, other: "BucketedTable") -> None:
        """Rows whose key is in `other` take its values; others of `other` are not added."""
        self.write(self._matched(other, "left_outer", F.coalesce(_NEW, _OLD)), shuffle=False)

    def _matched(self, other: "BucketedTable", how: str, row) -> DataFrame:
        self._same_layout(other)
        columns = self.read().columns

        def rows(table, name):
            return table.read().select(*self.keys, F.struct(*columns).alias(name))

        joined = rows(self, _OLD).hint("merge").join(rows(other, _NEW), self.keys, how)
        return joined.select(row.alias("row")).select(*[F.col("row")[c].alias(c) for c in columns])

    def drop(self) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        for version in self.versions():
            self.spark.sql(f"DROP TABLE IF EXISTS {version}")
