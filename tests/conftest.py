import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidecast-test-ckpt-"))
    yield s


def bars_df(spark, rows, series="A"):
    """rows: (day, open, high, low, close, volume) tuples."""
    import datetime as dt
    data = [(series, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), float(o), float(h), float(lo), float(c), float(v))
            for d, o, h, lo, c, v in rows]
    return spark.createDataFrame(
        data, "series string, ts timestamp_ntz, open double, high double, low double, close double, volume double")
