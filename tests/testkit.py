"""Paths and helpers of the tests, apart from ``conftest`` (that name is taken by pytest in every folder)."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def strings(spark, columns, rows):
    """All-STRING DataFrame (the shape of the raw source tables)."""
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame(rows, schema)
