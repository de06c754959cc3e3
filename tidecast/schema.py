"""Fixed schemas of the engine's tables. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ts is TIMESTAMP_NTZ in batch (wall-clock, zone-free, as in the source tables).
TICKS = T.StructType([
    T.StructField("series", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("qty", T.DoubleType()),
])

BARS = T.StructType([
    T.StructField("series", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

PREDS = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("fold", T.IntegerType()),
    T.StructField("series", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("yhat", T.DoubleType()),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema``; raise if a column is missing."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; expected {schema.simpleString()}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
