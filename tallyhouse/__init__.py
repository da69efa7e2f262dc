"""tallyhouse — e-commerce raw → staging → audit → mart batch analytics on Spark.

Every public function takes and returns ``pyspark.sql.DataFrame`` (or
``Column``) objects and stays lazy until a sink is called, so Catalyst sees
the whole plan: filters and column pruning reach the Parquet scan, top-1 per
key becomes a partial ``WindowGroupLimit`` before the shuffle, and counts are
pre-aggregated map-side before any join.
"""

from tallyhouse.session import build_session, shared_dir, size_shuffle_partitions  # noqa: F401

__all__ = ["build_session", "shared_dir", "size_shuffle_partitions"]
