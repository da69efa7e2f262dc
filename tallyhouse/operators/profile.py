"""Table-level data-quality counting: single-pass profiles, duplicate keys,
orphaned foreign keys, and the wide → long reshape of a profile."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row, one BIGINT column per check: how many rows satisfy it.

    A single global aggregate — every partition computes partial counts and
    only one tiny row per task crosses the shuffle.
    """
    return df.agg(*[F.count_if(pred).alias(name) for name, pred in checks.items()])


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """(key, __n): rows per non-NULL ``key``, combined map-side, so a key
    holding a third of all rows ships one row per task.

    ``duplicates`` and the other side of ``key_report`` are built on it; on the
    same input the subtrees are identical, so Spark runs the scan and shuffle
    once and reuses the exchange.
    """
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))


def duplicates(df: DataFrame, key: str, name: str = "dup_rows") -> DataFrame:
    """One row: all rows (not only the extras) whose non-NULL ``key`` occurs
    more than once."""
    return (key_counts(df, key).filter(F.col("__n") > 1)
            .agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias(name)))


def orphans(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None,
            name: str = "orphan_rows") -> DataFrame:
    """One row: rows of ``left`` with a non-NULL ``key`` that has no match in
    ``right`` (``NOT EXISTS``)."""
    return key_report(left, foreign={key: (right.select(F.col(right_key or key).alias(key)), name)})


def key_report(df: DataFrame, foreign: Mapping[str, tuple[DataFrame, str]] | None = None,
               unique: Mapping[str, str] | None = None) -> DataFrame:
    """One row, one BIGINT column per key rule of ``df``, all rules in one pass.

    ``foreign`` maps a column to (the table that holds it under the same name,
    result name) and counts rows whose non-NULL value is not there. ``unique``
    maps a column to a result name and counts all rows whose non-NULL value
    occurs more than once.

    The key columns are unpivoted to (column, value), counted per pair map-side,
    and meet the per-key counts of the other tables in a single left join: one
    scan and one shuffle of ``df`` whatever the number of rules. It is written as
    left outer + "no match": as a ``left_anti`` join the optimizer would push it
    below the aggregate and shuffle every raw row.
    """
    foreign, unique = foreign or {}, unique or {}
    keys = list(dict.fromkeys([*foreign, *unique]))
    counts = (df.select(*[F.col(k).cast("string").alias(k) for k in keys])
                .unpivot(ids=[], values=keys, variableColumnName="__column", valueColumnName="__key")
                .filter(F.col("__key").isNotNull())
                .groupBy("__column", "__key").agg(F.count(F.lit(1)).alias("__n")))
    held = None
    for k, (table, _) in foreign.items():
        part = key_counts(table, k).select(F.lit(k).alias("__column"), F.col(k).cast("string").alias("__key"),
                                           F.col("__n").alias("__held"))
        held = part if held is None else held.unionByName(part)
    if held is None:
        counts = counts.withColumn("__held", F.lit(None).cast("bigint"))
    else:
        counts = counts.join(held, on=["__column", "__key"], how="left")

    def rows(column: str, broken: Column, name: str) -> Column:
        hit = F.sum(F.when((F.col("__column") == column) & broken, F.col("__n")))
        return F.coalesce(hit, F.lit(0)).cast("bigint").alias(name)

    return counts.agg(*[rows(k, F.col("__held").isNull(), name) for k, (_, name) in foreign.items()],
                      *[rows(k, F.col("__n") > 1, name) for k, name in unique.items()])


def profile_with_code(df: DataFrame, checks: Mapping[str, Column], code: Column, allowed: DataFrame,
                      unlisted: str) -> DataFrame:
    """``profile`` plus ``unlisted``: rows whose non-NULL ``code`` is not in the
    first column of ``allowed``.

    All checks are counted per code value first, map-side, and only one row per
    value meets the list, so a status that holds most rows is one row per task
    however long the list is.
    """
    per_code = (df.groupBy(code.alias("__code"))
                  .agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(pred).alias(n) for n, pred in checks.items()]))
    listed = allowed.select(F.col(allowed.columns[0]).alias("__listed")).distinct()
    off_list = F.col("__code").isNotNull() & F.col("__listed").isNull()
    return (per_code.join(listed, F.col("__listed") == F.col("__code"), "left")
            .agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in checks],
                 F.coalesce(F.sum(F.when(off_list, F.col("__n"))), F.lit(0)).cast("bigint").alias(unlisted)))


def to_long(wide: DataFrame, table: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """Unpivot a one-row profile into (table_name, issue_type, affected_rows).

    ``names`` maps column → issue_type when they differ.
    """
    cols = wide.columns
    renamed = wide.select(*[F.col(c).cast("bigint").alias((names or {}).get(c, c)) for c in cols])
    return (renamed.unpivot(ids=[], values=renamed.columns,
                            variableColumnName="issue_type", valueColumnName="affected_rows")
                   .select(F.lit(table).alias("table_name"), "issue_type", "affected_rows"))
