"""Sinks: full-replace table writes, published as a whole, with declared keys enforced."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import shared_dir
from tallyhouse.sources.published import KEEP, Log


class DuplicateKey(ValueError):
    """Rows of a table share a key that it declares to be unique."""


def check_key(df: DataFrame, key: str | Sequence[str], name: str, nulls: bool = True) -> None:
    """Raise :class:`DuplicateKey`, with the table's name and the number of such keys,
    unless ``key`` is unique in ``df``.

    A NULL is a key like any other (one row may have it), or none at all with
    ``nulls=False``. Reads the key columns alone; counts are combined before
    the shuffle, so a hot key is one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    bad = F.col("__n") > 1
    if not nulls:
        for k in keys:
            bad = bad | F.col(k).isNull()
    found = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(bad)
             .agg(F.count(F.lit(1)).alias("keys"), F.sum("__n").alias("rows"), F.min(F.struct(*keys)).alias("example")).first())
    if found["keys"]:
        example = ", ".join(f"{k}={found['example'][k]!r}" for k in keys)
        raise DuplicateKey(f"{name}: {found['keys']} value(s) of its key ({', '.join(keys)}) are doubled or missing in {found['rows']} rows, "
                           f"such as {example}")


def write_files(df: DataFrame, path: str, key: str | Sequence[str] | None = None,
                partition_by: list[str] | None = None, nulls: bool = True) -> str:
    """Write Parquet to a folder that nobody reads yet, and check its key there.

    Spark's file commit protocol makes a retried task (lost executor) safe:
    only the attempt that commits is published.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if key:
        check_key(df.sparkSession.read.parquet(path), key, path.rstrip("/").rsplit("/", 1)[-1], nulls)
    return path


def _replace(spark: SparkSession, path: str, keep: int, write: Callable[[str], None]) -> str:
    log = Log(spark, path)
    data = f"data-{uuid.uuid4().hex[:12]}"
    try:
        write(f"{log.folder}/{data}")
    except BaseException:
        log.files.delete(f"{log.folder}/{data}")
        raise
    log.publish({"data": data})
    for old in log.forget(keep):
        log.files.delete(f"{log.folder}/{old['data']}")
    return f"{log.folder}/{data}"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, key: str | Sequence[str] | None = None,
                keep: int = KEEP, nulls: bool = True) -> str:
    """Full replace (``CREATE OR REPLACE TABLE``) of the Parquet table ``path``.

    The rows go to a folder of their own beside the present ones and are switched
    to when they are whole and ``key`` holds: :func:`tallyhouse.sources.read_table`
    sees the old rows until then and the new ones after, never none. A write that
    fails leaves the table as it was. The last ``keep`` versions stay for readers
    that opened them. Returns the folder of the rows written.
    """

    def write(folder: str) -> None:
        write_files(df, folder, partition_by=partition_by)
        if key:
            check_key(df.sparkSession.read.parquet(folder), key, path.rstrip("/").rsplit("/", 1)[-1], nulls)

    return _replace(df.sparkSession, path, keep, write)


def write_csv(df: DataFrame, path: str, key: str | Sequence[str] | None = None, keep: int = KEEP) -> str:
    """Full replace as CSV with a header row (``incremental=False``), published like
    :func:`write_table`. ``key`` is the table's primary key: unique and not NULL.
    It is checked on the rows to be written, which are stored first so that they
    are computed once."""
    if key:
        df = written_back(df, "csv-rows")
        check_key(df, key, path.rstrip("/").rsplit("/", 1)[-1], nulls=False)
    return _replace(df.sparkSession, path, keep, lambda folder: csv_files(df, folder))


def csv_files(df: DataFrame, path: str) -> str:
    """Write CSV files with a header to a folder that nobody reads yet, so that every
    value comes back: blanks at its ends, quotes, line breaks; NULL is empty and an
    empty value is quoted."""
    (df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def written_back(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder under the shared one and read back: computed
    once, lineage cut, safe against lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
