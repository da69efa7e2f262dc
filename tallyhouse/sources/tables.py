"""Scans: whole-table Parquet reads with optional scan-time filter and column
subset (pushed into the Parquet reader by Catalyst), typed CSV reads, and the
raw_* source views."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.published import Files, Log, current_folder
from tallyhouse.sources.raw_views import VIEW_INPUTS

RAW_TABLES = ("raw_orders", "raw_products", "raw_users")

# Column order of the source tables: every column is STRING.
SOURCE_COLUMNS = {
    "raw_orders": ("order_id", "user_id", "product_id", "order_date", "quantity",
                   "status", "revenue_czk", "discount_pct"),
    "raw_products": ("product_id", "product_name", "category", "price_czk",
                     "margin_pct", "is_active"),
    "raw_users": ("user_id", "country", "acquisition_channel", "registered_at", "age_group"),
}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path's scheme
    (local, HDFS, object stores alike)."""
    return Files(spark, path).exists(path)


def table_path(spark: SparkSession, base: str, name: str) -> str:
    """Where the rows of a table are: ``<base>/<name>.parquet`` when that exists (driver
    layout), the table of the run that ``base`` publishes, the published version of
    ``<base>/<name>``, or that folder itself."""
    base = base.rstrip("/")
    if path_exists(spark, f"{base}/{name}.parquet"):
        return f"{base}/{name}.parquet"
    run = Log(spark, base).current()
    if run and name in run.get("tables", {}):
        return f"{base}/{run['tables'][name]}"
    return current_folder(spark, f"{base}/{name}")


def as_strings(df: DataFrame, table: str) -> DataFrame:
    """The source columns of ``table`` in order, each cast to STRING (sources
    may arrive typed; every rule reads them as text). Missing columns raise."""
    wanted = SOURCE_COLUMNS[table]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"{table} is missing column(s) {missing}; has {df.columns}")
    return df.select(*[F.col(c).cast("string").alias(c) for c in wanted])


def read_table(spark: SparkSession, base: str, name: str,
               columns: Sequence[str] | None = None,
               where: Mapping[str, Iterable[object]] | None = None,
               where_operator: str = "eq", fmt: str = "parquet") -> DataFrame:
    """Whole-table scan of a mapped table.

    ``columns`` keeps only those columns; ``where`` keeps rows whose column
    value is in the given list (``where_operator="eq"``) or not in it
    (``"ne"``; SQL semantics, so NULLs are dropped) — the value-list filter of
    a table mapping. Both are DataFrame operations, so they land in the scan
    as ``ReadSchema`` and ``PushedFilters``. ``fmt="csv"`` reads a folder of
    header CSV files (``<base>/<name>``) with every column as text.
    """
    if where_operator not in ("eq", "ne"):
        raise ValueError(f"where_operator must be 'eq' or 'ne', not {where_operator!r}")
    if fmt == "csv":
        df = read_csv_typed(spark, f"{base.rstrip('/')}/{name}")
    elif fmt == "parquet":
        df = spark.read.parquet(table_path(spark, base, name))
    else:
        raise ValueError(f"fmt must be 'parquet' or 'csv', not {fmt!r}")
    for column, values in (where or {}).items():
        values = list(values)
        if not values:  # an empty list means "no filter", as in the mapping
            continue
        match = F.col(column).isin(values)
        df = df.filter(match if where_operator == "eq" else ~match)
    if columns:
        df = df.select(*columns)
    return df


#: Bytes of a file in which its header line must end.
HEADER_BYTES = 1 << 20
#: Header lines read at once.
PROBES = 16


def _csv_files(spark: SparkSession, path: str) -> list[str]:
    """The files with content that Spark would read under ``path``."""
    files = Files(spark, path)
    found, todo = [], [files.path(path)]
    while todo:
        for status in files._fs.listStatus(todo.pop()):
            if status.getPath().getName()[0] in "_.":
                continue
            if status.isDirectory():
                todo.append(status.getPath())
            elif status.getLen():
                found.append(status.getPath().toString())
    return sorted(found)


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The names in the first line of a CSV file (line breaks inside quotes belong to a name)."""
    files = Files(spark, file)
    stream = files._fs.open(files.path(file))
    try:
        codec = files._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(files._conf).getCodec(files.path(file))
        start = bytes((codec.createInputStream(stream) if codec else stream).readNBytes(HEADER_BYTES))
    finally:
        stream.close()
    text = start.decode("utf-8-sig", "ignore")
    names = tuple(next(csv.reader(io.StringIO(text, newline="")), []))
    if len(start) == HEADER_BYTES and "\n" not in text and "\r" not in text:
        raise ValueError(f"{file}: no end of the header line in its first {HEADER_BYTES} bytes")
    if len(set(names)) < len(names):
        raise ValueError(f"{file}: its header names a column twice: {names}")
    return names


def _local_part(path: str) -> str:
    return unquote(urlsplit(path).path)


def _broken_lines(spark: SparkSession, files: list[str]) -> set[str]:
    """Files in which a quoted value holds a line break: a line of theirs has an odd number
    of quotes. One pass over the text, split like any text."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    odd = (spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), (quotes % 2 == 1).alias("odd"))
           .where("odd").select("file").distinct())
    return {_local_part(r["file"]) for r in odd.collect()}


def read_csv_typed(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                   header: bool = True, check: bool = True, multi_line: bool | None = None) -> DataFrame:
    """CSV scan that keeps every value as STRING (no inference) and returns only
    ``columns`` when given.

    Values are bound by the names in each file's header line: files of one folder
    may order their columns differently, and may have others beside ``columns``
    (without ``columns``, all must name the same). The driver reads one header line
    per file; files with equal headers are one scan, the scans are united by name.

    An empty field is NULL, a quoted empty one an empty value. Quoted line breaks belong to their value. Files that hold any are found in a
    pass over the text and read whole, one task each; all others are split (say
    ``multi_line`` to skip that pass). With ``check`` a further pass counts rows
    with more or fewer values than their header and fails with the count per file;
    without it such a row fails the read when it comes to it. Whole rows are
    parsed even for a few columns, as pruning would skip those checks.

    ``header=False`` names the columns ``_c0``, ``_c1``, ... by position.
    """
    path = current_folder(spark, path)
    # a null value that no file holds: then an empty field is NULL and a quoted empty one ''
    reader = spark.read.option("escape", '"').option("columnPruning", False).option("nullValue", "\0")
    if not header:
        names = reader.option("multiLine", True).option("inferSchema", False).csv(path).columns
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
        df = reader.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line is not False).csv(path)
        return df.select(*columns) if columns else df

    files = _csv_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no CSV file with a header in {path}")
    with ThreadPoolExecutor(PROBES) as pool:
        headers = dict(zip(files, pool.map(lambda f: _header(spark, f), files)))
    wanted = list(columns or headers[files[0]])
    for file, names in headers.items():
        if missing := [c for c in wanted if c not in names]:
            raise ValueError(f"{file} has no column(s) {missing}; its header names {list(names)}")
        if not columns and len(names) != len(wanted):
            raise ValueError(f"{file} has column(s) {[c for c in names if c not in wanted]} that {files[0]} has not")
    whole = _broken_lines(spark, files) if multi_line is None else set()
    groups: dict[tuple, list[str]] = {}
    for file, names in headers.items():
        groups.setdefault((names, bool(multi_line) or _local_part(file) in whole), []).append(file)

    def scan(names, lines, part, mode, *more):
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in (*names, *more)])
        return (reader.schema(schema).option("header", True).option("enforceSchema", False).option("multiLine", lines)
                .option("mode", mode).option("columnNameOfCorruptRecord", more[0] if more else "_corrupt_record").csv(part))

    if check:
        bad = [scan(names, lines, part, "PERMISSIVE", "__bad").select(
            F.col("_metadata.file_path").alias("file"), F.col("__bad").isNotNull().alias("bad"), F.col(f"`{names[0]}`").alias("value"))
            for (names, lines), part in groups.items()]
        # the value is counted too: Spark refuses to read the mark of a bad row alone
        found = (reduce(DataFrame.unionByName, bad).groupBy("file").agg(F.count_if("bad").alias("rows"), F.count("value").alias("values"))
                 .where("rows > 0").orderBy("file").collect())
        if found:
            listed = ", ".join(f"{r['file']} ({r['rows']})" for r in found[:10])
            raise ValueError(f"{sum(r['rows'] for r in found)} row(s) in {len(found)} file(s) have more or fewer values than their header: {listed}")
    return reduce(DataFrame.unionByName, [scan(names, lines, part, "FAILFAST").select(*[F.col(f"`{c}`") for c in wanted])
                                          for (names, lines), part in groups.items()])


def _view(spark: SparkSession, base: str, view: str) -> DataFrame:
    text, inputs = VIEW_INPUTS[view]
    frames = {name: spark.read.parquet(table_path(spark, base, name)) for name in inputs}
    return spark.sql(text, **frames)


def raw_orders(spark: SparkSession, base: str) -> DataFrame:
    """Source ``orders``: all-STRING, one row per lineitem."""
    return _view(spark, base, "raw_orders")


def raw_products(spark: SparkSession, base: str) -> DataFrame:
    """Source ``products``: all-STRING, with duplicate keys."""
    return _view(spark, base, "raw_products")


def raw_users(spark: SparkSession, base: str) -> DataFrame:
    """Source ``users``: all-STRING, with duplicate and NULL keys."""
    return _view(spark, base, "raw_users")


def raw_sources(spark: SparkSession, base: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All three sources. A folder that already holds ``raw_*`` tables (for
    example a landing zone) must hold all three, and is read directly; a folder
    of the driver's TPC-H-like tables, with none of them, gives the fixture
    views. The two are never mixed."""
    landed = [view for view in RAW_TABLES if path_exists(spark, f"{base.rstrip('/')}/{view}")
              or path_exists(spark, f"{base.rstrip('/')}/{view}.parquet")]
    if not landed and path_exists(spark, table_path(spark, base, "lineitem")):
        return {view: _view(spark, base, view) for view in RAW_TABLES}
    missing = [view for view in RAW_TABLES if view not in landed]
    if missing:
        raise FileNotFoundError(f"{base} has no {', '.join(missing)}")
    return {view: read_table(spark, base, view, columns=SOURCE_COLUMNS[view], fmt=fmt) for view in RAW_TABLES}
