"""Row numbers and ranks over a whole table, without a task that sees all of it.

The rows are range-partitioned in the order wanted and written to the shared
folder, which fixes the ranges for good (a lost executor cannot move a row to
another). What lies before each range is a sum of one number per range; inside
a range each task numbers its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.sources.sinks import written_back

# monotonically_increasing_id: partition above these bits, row inside it below
_ROW_BITS = 33


def _at(values: list[int], index: str) -> Column:
    """The number that the driver holds for a range (one per range, so at most the
    number of partitions)."""
    return F.get(F.lit(values) if values else F.array(F.lit(0)), F.col(index).cast("int"))


def _per_range(rows: dict[int, object], empty):
    return [rows.get(r, empty) for r in range(max(rows, default=-1) + 1)]


def row_numbers(df: DataFrame, order: Sequence[Column], name: str = "row_nr") -> DataFrame:
    """``df`` with the position of each row in the total order ``order``, from 1.

    Sorts by range partitions; equal rows under ``order`` are numbered in any order,
    so end it with a key. The sorted rows are stored in the shared folder.
    """
    placed = written_back(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()),
                          "ranges").withColumn("__range", F.shiftright("__id", _ROW_BITS))
    sizes = _per_range({r["__range"]: r["n"] for r in placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect()}, 0)
    before = [0, *accumulate(sizes)][:len(sizes)]
    inside = F.col("__id") - F.shiftleft("__range", _ROW_BITS) + 1
    return placed.withColumn(name, (_at(before, "__range") + inside).cast("bigint")).drop("__id", "__range")


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)


def rank_by(df: DataFrame, measure: str, name: str = "rank") -> DataFrame:
    """``RANK() OVER (ORDER BY measure DESC)`` with NULLs first (the source
    dialect's default for DESC).

    Rows of one value may fill many ranges (ties are spread by a hash of the row), so a
    value that a third of the rows share is no single task. A range that begins with
    the value its predecessor ended with takes over that value's rank.
    """
    down = F.col(measure).desc_nulls_first()
    spread = F.xxhash64(*df.columns)
    ranged = written_back(df.repartitionByRange(down, spread).withColumn("__range", F.spark_partition_id()), "ranges")
    value = F.struct(F.col(measure).isNull().alias("none"), F.col(measure).alias("value"))
    edges = (ranged.groupBy("__range", value.alias("v")).agg(F.count(F.lit(1)).alias("n"))
             .groupBy("__range").agg(F.sum("n").alias("rows"), F.max("v").alias("first"), F.min("v").alias("last"),
                                     F.min_by("n", "v").alias("last_rows")).collect())
    first_rank: dict[int, int] = {}
    offsets: dict[int, int] = {}
    before, held, held_rank = 0, None, 0
    for e in sorted(edges, key=lambda e: e["__range"]):
        first, last = tuple(e["first"]), tuple(e["last"])
        goes_on = held is not None and first[0] == held[0] and _same(first[1], held[1])
        first_rank[e["__range"]], offsets[e["__range"]] = held_rank if goes_on else before + 1, before
        if not (first[0] == last[0] and _same(first[1], last[1])):
            held_rank = before + e["rows"] - e["last_rows"] + 1
        else:
            held_rank = first_rank[e["__range"]]
        held, before = last, before + e["rows"]
    local = F.rank().over(Window.partitionBy("__range").orderBy(down))
    return (ranged.withColumn("__local", local)
            .withColumn(name, F.when(F.col("__local") == 1, _at(_per_range(first_rank, 0), "__range"))
                        .otherwise(_at(_per_range(offsets, 0), "__range") + F.col("__local")).cast("bigint"))
            .drop("__local", "__range"))
