"""X1 (extension): TS1 on a stream.  Tumbling event-time windows, late ticks
dropped once the watermark has passed their window; append mode emits a bar
only when its window is closed, so every emitted bar is final."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.expr import ntz_from_micros, ntz_micros
from tidecast.schema import TICKS


def stream_bars(ticks_stream: DataFrame, freq: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Streaming OHLCV bars of a TICKS-shaped stream.  Event time must be a
    TIMESTAMP for watermarks: the wall clock is carried over as epoch
    microseconds (zone-free both ways), so windows align with batch bars in
    any session time zone."""
    t = (ticks_stream.where(F.col("price").isNotNull())
         .withColumn("ts", F.timestamp_micros(ntz_micros(F.col("ts"))))
         .withWatermark("ts", delay))
    key = F.struct(F.col("ts"), F.col("seq"), F.col("price"))
    return (t.groupBy(F.col("series"), F.window("ts", freq).alias("w"))
            .agg(F.min_by("price", key).alias("open"), F.max("price").alias("high"),
                 F.min("price").alias("low"), F.max_by("price", key).alias("close"),
                 F.sum(F.coalesce(F.col("qty"), F.lit(0.0))).alias("volume"))
            .select("series", ntz_from_micros(F.unix_micros(F.col("w.start"))).alias("ts"),
                    "open", "high", "low", "close", "volume"))


def events_tick_stream(spark, sf_dir: str) -> DataFrame:
    """The events table read as a file stream, renamed to the TICKS schema."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
           .parquet(sf_dir))
    return raw.select(F.col("event_type").alias("series"), F.col("ts"), F.col("event_id").alias("seq"),
                      F.col("value").alias("price"), F.lit(1.0).alias("qty")).select(
        *[F.col(f.name).cast(f.dataType) for f in TICKS.fields])


def stream_session(spark, state_partitions: int | None = None):
    """A session of its own for streams, in the same application: its state stores get
    ``state_partitions`` partitions (default: the cluster's default parallelism; state is one
    row per open (series, window)), and other queries keep their settings.  Spark fixes that
    number in the checkpoint when the query first starts."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return own


def run_available(stream_df: DataFrame, out_path: str, checkpoint: str) -> None:
    """Process everything available now into parquet files (exactly-once file
    sink with its own checkpoint), then stop.  The stream's session sets the number of
    state partitions (``stream_session``)."""
    q = (stream_df.writeStream.outputMode("append").format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
