"""Keep the best row per key (``ROW_NUMBER() ... = 1``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_best(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[Column]) -> DataFrame:
    """One row per ``key``: the first under ``order_cols``.

    Written as ``row_number() = 1`` so Catalyst's window-group-limit rule
    turns it into a *partial* ``WindowGroupLimit`` before the shuffle: every
    map task forwards at most one row per key, so a key holding a third of
    the input (e.g. all NULL keys, which share one partition) costs one row
    per task in the exchange instead of a third of the data on one reducer.

    NULL keys form one group, like ``PARTITION BY`` in SQL.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))


def tie_breakers(columns: Sequence[str], exclude: Sequence[str] = ()) -> list[Column]:
    """Ascending NULLS LAST on every remaining column, in the given order.

    The source ordering leaves ties unresolved (non-deterministic winner);
    appending every raw column makes the winner a function of the data.
    """
    return [F.col(c).asc_nulls_last() for c in columns if c not in set(exclude)]
