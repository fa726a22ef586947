"""Placing addresses in tables of address ranges.

A range table has `start_ip`, `end_ip` and any other columns. The record of an address is that with the
largest start not above it, if the address does not lie behind that record's end.

Both ways cut the addresses into blocks by their leading bits. If the tables are small, an index by block
is copied to every task and searched where the rows are. If not, addresses and ranges are sorted
together within blocks.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagloom.functions.ip import ip_to_long
from tagloom.operators.skew import lookup_join
from tagloom.session import Scratch, bytes_fit_broadcast

_ADDRESS_BITS = 32
# Leading bits that make a block.
_BLOCK_BITS = 16
_LEAST_BLOCK_BITS = 4


def locate(points: DataFrame, ranges: dict[str, DataFrame], max_bytes: int | None = None) -> DataFrame:
    """For each distinct `ip` of `points`, the record of each range table that holds it.

    A record comes back as one struct column under the name of its table, and is NULL if there is none
    or the text is no address.
    """
    addresses = points.select("ip").where(F.col("ip").isNotNull()).distinct()
    placed = with_small_ranges(addresses, ranges, max_bytes)
    return _sorted_together(addresses, ranges) if placed is None else placed


def with_ranges(rows: DataFrame, ranges: dict[str, DataFrame], max_bytes: int | None = None,
                spread: Sequence[str] | None = None) -> DataFrame:
    """All rows with the records of their `ip`, as of `locate`.

    With small range tables no row is moved. Otherwise the distinct addresses are located, and looked up
    by the rows, of which frequent addresses are spread by the `spread` columns.
    """
    placed = with_small_ranges(rows, ranges, max_bytes)
    if placed is not None:
        return placed
    scratch = Scratch(rows.sparkSession, "ranges")
    found = scratch.save(_sorted_together(
        rows.select("ip").where(F.col("ip").isNotNull()).distinct(), ranges), "found")
    return lookup_join(rows, found, "ip", spread=spread)


# -- by an index in every task ----------------------------------------------------------

def with_small_ranges(rows: DataFrame, ranges: dict[str, DataFrame],
                      max_bytes: int | None = None) -> DataFrame | None:
    """As `with_ranges`, by an index of each table; None if they are together too large to be copied to
    every task."""
    scratch = Scratch(rows.sparkSession, "range-index")
    counted = {name: _distinct_starts(table, name) for name, table in ranges.items()}
    sizes = {name: records.count() for name, records in counted.items()}
    # An index has at most as many entries as there are records and blocks.
    bits = {name: min(_BLOCK_BITS, max(_LEAST_BLOCK_BITS, math.ceil(math.log2(max(1, n)))))
            for name, n in sizes.items()}
    width = {name: records._jdf.schema().defaultSize() for name, records in counted.items()}
    total = sum((sizes[name] + (1 << bits[name])) * width[name] for name in ranges)
    if not bytes_fit_broadcast(rows.sparkSession, total, max_bytes):
        return None
    indexes = {}
    for name, records in counted.items():
        index = scratch.save(_index(records, name, bits[name]), name)
        longest = index.agg(F.max(F.size("starts"))).first()[0] or 0
        indexes[name] = index, bits[name], longest
    return _looked_up(rows, indexes)


def _distinct_starts(table: DataFrame, name: str) -> DataFrame:
    """`start` and the record; of equal starts the last one, as it is the one that decides."""
    record = F.struct(*table.columns)
    return table.groupBy(F.col("start_ip").cast("long").alias("start")).agg(
        F.max_by(record, F.col("end_ip")).alias(name))


def _index(records: DataFrame, name: str, bits: int) -> DataFrame:
    """For each block the records that may hold its addresses, in order of their starts: the one that is
    carried into the block, and those that start in it."""
    shift = _ADDRESS_BITS - bits
    carried = (_carried(records.withColumnRenamed("start", "_position"), name, bits)
               .where(F.col(name)["end_ip"] >= F.col("_position"))
               .select(F.shiftright("_position", shift).alias("block"),
                       F.col(name)["start_ip"].cast("long").alias("start"), name))
    starting = records.select(F.shiftright("start", shift).alias("block"), "start", name)
    entry = F.struct("start", name)
    near = (carried.unionByName(starting).groupBy("block")
            .agg(F.array_sort(F.collect_list(entry), _by_start).alias("near")))
    return near.select("block", F.col("near.start").alias("starts"), F.col(f"near.{name}").alias("records"))


def _by_start(a: Column, b: Column) -> Column:
    return F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)


def _looked_up(rows: DataFrame, indexes: dict[str, tuple[DataFrame, int, int]]) -> DataFrame:
    # A row goes through the joins as one value, so that its columns are not copied one by one each time.
    rows = rows.select(F.struct(*rows.columns).alias("_row"), ip_to_long(F.col("ip")).alias("_position"))
    for name, (index, bits, longest) in indexes.items():
        rows = (rows.withColumn("block", F.shiftright("_position", _ADDRESS_BITS - bits))
                .join(F.broadcast(index), "block", "left"))
        record = F.get("records", _last_not_above("starts", F.col("_position"), longest))
        rows = rows.withColumn(name, F.when(F.col("_position") <= record["end_ip"], record)
                               ).drop("block", "starts", "records")
    return rows.select("_row.*", *indexes)


def _last_not_above(starts: str, position: Column, longest: int) -> Column:
    """Binary search: place of the last of the sorted `starts` that is not above `position`, or -1. The
    steps are powers of two, from the largest that an array may need."""
    steps = [1 << bit for bit in reversed(range(max(1, longest).bit_length()))]

    def forward(at, step):
        onward = (at + step < F.size(starts)) & (F.get(starts, at + step) <= position)
        return F.when(onward, at + step).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(-1), forward)


# -- by one sort ------------------------------------------------------------------------

def _sorted_together(addresses: DataFrame, ranges: dict[str, DataFrame]) -> DataFrame:
    """Addresses and ranges are sorted together within blocks of 2^16 addresses, so the work is
    that of one shuffle and sort. No block can hold more than 2^16 distinct addresses."""
    addresses = addresses.withColumn("_position", ip_to_long(F.col("ip")))
    # Ranges come before addresses at the same position.
    events = addresses.withColumn("_order", F.lit(2))
    for name, table in ranges.items():
        records = (table.select("start_ip", F.struct(*table.columns).alias(name))
                   .withColumnRenamed("start_ip", "_position"))
        events = (events
                  .unionByName(records.withColumn("_order", F.lit(1)), allowMissingColumns=True)
                  .unionByName(_carried(records, name).withColumn("_order", F.lit(0)),
                               allowMissingColumns=True))

    # Texts that are no addresses have no position; they go to blocks of their own.
    block = F.coalesce(F.shiftright("_position", _ADDRESS_BITS - _BLOCK_BITS),
                       -1 - F.pmod(F.xxhash64("ip"), F.lit(1 << _BLOCK_BITS)))
    ends = [F.col(name)["end_ip"] for name in ranges]
    until_here = (Window.partitionBy(block).orderBy("_position", "_order", *ends)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nearest = {name: F.last(name, ignorenulls=True).over(until_here) for name in ranges}
    placed = events.withColumns(nearest).where(F.col("ip").isNotNull())
    held = [F.when(F.col("_position") <= F.col(name)["end_ip"], F.col(name)).alias(name)
            for name in ranges]
    return placed.select("ip", *held)


def _carried(records: DataFrame, name: str, bits: int = _BLOCK_BITS) -> DataFrame:
    """For the start of each block, the last record that starts before it.

    Works on one row per block, whatever the size of the table, in two levels: blocks within groups, and
    the last record of each group for all later groups.
    """
    shift, half = _ADDRESS_BITS - bits, bits // 2
    groups = 1 << (bits - half)
    block = F.shiftright("_position", shift).alias("_block")
    rank = F.struct("_position", F.col(name)["end_ip"])
    last_of_block = records.groupBy(block).agg(F.max_by(name, rank).alias(name))
    group = F.shiftright("_block", half).alias("_group")
    last_of_group = last_of_block.groupBy(group).agg(F.max_by(name, "_block").alias("_record"))
    later = F.when(F.col("_group") < groups - 1,
                   F.sequence(F.col("_group") + 1, F.lit(groups - 1).cast("long")))
    into_group = (last_of_group.select(F.col("_group").alias("_from"), "_record", F.explode(later).alias("_group"))
                  .groupBy("_group").agg(F.max_by("_record", "_from").alias("_record")))
    blocks = records.sparkSession.range(1 << bits).withColumnRenamed("id", "_block").withColumn("_group", group)
    before = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return (blocks.join(last_of_block, "_block", "left").join(F.broadcast(into_group), "_group", "left")
            .select(F.shiftleft("_block", shift).alias("_position"),
                    F.coalesce(F.last(name, ignorenulls=True).over(before), "_record").alias(name))
            .where(F.col(name).isNotNull()))
