"""Tick streams taken from the driver's test tables (see FIXTURES.md §2).

Each function only renames and casts columns into the fixed TICKS schema;
parquet scans keep column pruning and filter pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.schema import TICKS, conform


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one tick per order; series = order priority, price = total price."""
    o = table(spark, sf_dir, "orders")
    return conform(o.select(
        F.col("o_orderpriority").alias("series"), F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("qty")), TICKS)


def events_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one tick per event; series = event type, price = value."""
    e = table(spark, sf_dir, "events")
    return conform(e.select(
        F.col("event_type").alias("series"), F.col("ts"), F.col("event_id").alias("seq"),
        F.col("value").alias("price"), F.lit(1.0).alias("qty")), TICKS)


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one tick per line item; series = supplier key, price = extended price,
    qty = quantity.  seq = order key * 8 + line number is *not* unique; the
    bar operators order by (ts, seq, price), so remaining ties carry equal prices."""
    li = table(spark, sf_dir, "lineitem")
    return conform(li.select(
        F.col("l_suppkey").cast("string").alias("series"), F.col("l_shipdate").alias("ts"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("qty")), TICKS)


FIXTURES = {"orders": orders_ticks, "events": events_ticks, "lineitem": lineitem_ticks}
