"""Changes to tables with a key.

The functions take and return frames, and expect that both sides have unique keys; `insert_rows` bears
repeated ones among its rows. `KeyedTable` applies them to a table of the session catalog, and sees
to it that keys are unique.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tagloom.operators.unique import duplicate_keys
from tagloom.session import Scratch, scratch_scope

_PRESENT = "_present"
_PART = "_part"
_RANK = "_rank"


def _require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    repeated = duplicate_keys(rows, keys).take(3)
    if repeated:
        raise ValueError(f"key {tuple(keys)} is not unique: {[r.asDict() for r in repeated]}")


def _ranked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their place among those with the same key."""
    rest = [c for c in rows.columns if c not in keys]
    order = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in rest or keys))
    return rows.withColumn(_RANK, F.row_number().over(order))


def insert_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The target with the rows whose key is new, and all that were not added: rows in conflict
    with an existing key or with another of the rows, of which the highest is added."""
    ranked = _ranked(rows, keys)
    first, again = (ranked.where(c).drop(_RANK) for c in (f"{_RANK} = 1", f"{_RANK} > 1"))
    new = first.join(target, list(keys), "left_anti")
    conflicts = first.join(target, list(keys), "left_semi")
    return target.unionByName(new), conflicts.unionByName(again)


def update_rows(target: DataFrame, patch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set the columns of the patch in rows with its keys; NULL in the patch is a value too."""
    changed = [c for c in patch.columns if c not in keys]
    record = F.struct(*[F.col(c) for c in changed], F.lit(True).alias(_PRESENT)).alias("_patch")
    joined = target.join(patch.select(*keys, record), list(keys), "left")
    present = F.col("_patch")[_PRESENT].isNotNull()
    return joined.select(*[
        F.when(present, F.col("_patch")[c]).otherwise(F.col(c)).alias(c) if c in changed else c
        for c in target.columns])


def delete_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without the given keys. Only key columns may be given."""
    extra = set(rows.columns) - set(keys)
    if extra:
        raise ValueError(f"delete takes key columns only, not {sorted(extra)}")
    return target.join(rows, list(keys), "left_anti")


def upsert_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows replace those with the same key and are added otherwise."""
    return target.join(rows, list(keys), "left_anti").unionByName(rows)


class KeyedTable:
    """A parquet table of the session catalog with a declared key.

    Rows lie in `parts` folders by the hash of their key. A change reads and writes only the folders of
    the keys that it names. `parts` is fixed when the table is created; without it, it is the number
    of shuffle partitions. The new rows of all folders are complete before any old one goes. SQL
    reads the table by its name, and inserts into it if it names the columns.
    """

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], parts: int | None = None):
        self.spark, self.name, self.keys = spark, name, list(keys)
        self._parts = parts

    @property
    def parts(self) -> int:
        if self.exists():
            kept = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").where("key = 'parts'").first()
            return int(kept["value"])
        return self._parts or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_PART, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def create(self, schema: T.StructType) -> None:
        """Create the table if it does not exist."""
        if not self.exists():
            parts = self.parts
            (self.spark.createDataFrame([], schema).withColumn(_PART, F.lit(0))
             .write.format("parquet").partitionBy(_PART)
             # An overwrite replaces the folders that it has rows for, and no others.
             .option("partitionOverwriteMode", "dynamic").saveAsTable(self.name))
            self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('parts' = '{parts}')")

    def drop(self) -> None:
        """Drop the table if it exists."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def read(self, *columns: str) -> DataFrame:
        table = self.spark.table(self.name).drop(_PART)
        return table.select(*columns) if columns else table

    def append(self, rows: DataFrame) -> None:
        """Add rows without a look at their keys."""
        self._write(self._placed(rows.select(*self.read().columns)), "append")

    def _write(self, placed: DataFrame, mode: str) -> None:
        # One file per folder and task of the shuffle, not one per folder and task before it.
        placed = placed.repartition(_PART, *self.keys) if mode == "append" else placed.repartition(_PART)
        placed.select(*self.spark.table(self.name).columns).write.mode(mode).insertInto(self.name)

    def _touched(self, rows: DataFrame) -> DataFrame:
        """The stored rows of the folders that the keys of `rows` lie in. Rows that SQL inserted have no
        folder yet; they and the folders that they belong to are touched by every change."""
        stored = self.spark.table(self.name)
        keys = rows.select(*self.keys).unionByName(
            stored.where(F.col(_PART).isNull()).select(*self.keys))
        parts = [r[_PART] for r in self._placed(keys).select(_PART).distinct().collect()]
        return stored.where(F.col(_PART).isin(parts) | F.col(_PART).isNull())

    def _change(self, rows: DataFrame, change) -> None:
        """Replace the touched folders by what `change` makes of their rows."""
        with scratch_scope(self.spark):
            scratch = Scratch(self.spark, "keyed")
            rows = scratch.save(rows, "rows")
            _require_unique(rows, self.keys)
            touched = self._touched(rows)
            old = [r[_PART] for r in touched.select(_PART).distinct().collect()]
            new = scratch.save(self._placed(change(touched.drop(_PART), rows)), "new")
            self._write(new, "overwrite")
            filled = {r[_PART] for r in new.select(_PART).distinct().collect()}
            for part in set(old) - filled:  # a folder without rows is not overwritten
                value = "NULL" if part is None else part
                self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({_PART} = {value})")

    def insert(self, rows: DataFrame) -> DataFrame:
        """Add rows with new keys; returns all others: those whose key is stored already, and of
        rows with the same key all but the one that was added."""
        scratch = Scratch(self.spark, "insert")
        ranked = scratch.save(_ranked(rows, self.keys), "rows")
        stored = scratch.save(self._touched(rows).select(*self.keys), "stored")
        fresh = ranked.where(F.col(_RANK) == 1).drop(_RANK).join(stored, self.keys, "left_anti")
        again = ranked.where(F.col(_RANK) > 1).drop(_RANK)
        conflicts = ranked.where(F.col(_RANK) == 1).drop(_RANK).join(stored, self.keys, "left_semi")
        self.append(fresh)
        return conflicts.unionByName(again)

    def update(self, patch: DataFrame) -> None:
        """Raises if the patch has a key twice."""
        self._change(patch, lambda target, rows: update_rows(target, rows, self.keys))

    def delete(self, rows: DataFrame) -> None:
        self._change(rows.distinct(), lambda target, keys: delete_rows(target, keys, self.keys))

    def upsert(self, rows: DataFrame) -> None:
        """Raises if the rows have a key twice."""
        self._change(rows, lambda target, new: upsert_rows(target, new, self.keys))
