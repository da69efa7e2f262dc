import sys
import tempfile

import pytest

from testkit import ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tallyhouse.session import apply_conf

    spark = (SparkSession.builder.master("local[4]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.codegen.cache.maxEntries", "1000")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyhouse-test-"))
    yield spark

