"""Sources and sinks: landed bar files, cleaning, prediction files, models, chart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.expr import ntz_micros
from tidecast.operators.ordered import join_null_safe
from tidecast.schema import BARS, PREDS, conform


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """IO1: landed bar files read with the fixed BARS schema (types never
    inferred).  Parquet and CSV files that lack one of its columns raise an
    error; JSON files may leave out NULL fields."""
    if fmt in ("parquet", "csv"):
        there = spark.read.parquet(path) if fmt == "parquet" else spark.read.option("header", "true").csv(path)
        missing = [c for c in BARS.fieldNames() if c not in there.columns]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)}")
    reader = spark.read.schema(BARS)
    if fmt == "parquet":
        df = reader.parquet(path)
    elif fmt == "csv":
        df = reader.option("header", "true").csv(path)
    elif fmt == "json":
        df = reader.json(path)
    else:
        raise ValueError(f"unsupported format {fmt}")
    return conform(df, BARS)


def write_bars(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    df.write.mode(mode).format(fmt).option("header", "true").save(path)


REJECT_REASONS = ("duplicate", "null_key", "null_price", "nan_price", "non_positive_price", "high_below_low")
_VALUES = ("open", "high", "low", "close", "volume")


def clean_bars(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """IO2: (clean, rejects).

    Validity: a NULL series or ts, a NULL, NaN or non-positive price, or high <
    low rejects a row; each input row is in one of the two results only.
    Duplicates: one row per (series, ts) is kept, the first valid row in the
    order (volume desc, close, open, high, low); the other copies are rejected
    as ``duplicate``.

    No step sorts a (series, ts) group, so a key holding a large share of all
    rows (many copies) does not land in one task: identical copies collapse
    in a partially-aggregated hash aggregate (``copies`` counts them), the
    winner per key is a ``max_by`` aggregate, and rejects are the distinct
    rows joined to their key's winner (AQE splits a skewed join key).
    ``rejects`` has the bar columns, ``reason`` and ``copies`` (input rows
    the reject row stands for).
    """
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    any_null, any_nan = prices[0].isNull(), F.isnan(prices[0])
    for p in prices[1:]:
        any_null, any_nan = any_null | p.isNull(), any_nan | F.isnan(p)
    invalid = (F.when(F.col("series").isNull() | F.col("ts").isNull(), F.lit("null_key"))
               .when(any_null, F.lit("null_price"))
               .when(any_nan, F.lit("nan_price"))
               .when(F.least(*prices) <= 0, F.lit("non_positive_price"))
               .when(F.col("high") < F.col("low"), F.lit("high_below_low")))
    distinct = (bars.groupBy("series", "ts", *_VALUES).agg(F.count(F.lit(1)).alias("copies"))
                .withColumn("_invalid", invalid))
    # winner: max of (volume, -close, -open, -high, -low) among valid rows
    rank_key = F.struct(F.coalesce(F.col("volume"), F.lit(float("-inf"))).alias("v"),
                        (-F.col("close")).alias("c"), (-F.col("open")).alias("o"),
                        (-F.col("high")).alias("h"), (-F.col("low")).alias("l"))
    winners = (distinct.where(F.col("_invalid").isNull())
               .groupBy("series", "ts")
               .agg(F.max_by(F.struct(*_VALUES), rank_key).alias("_w")))
    clean = winners.select("series", "ts", *[F.col(f"_w.{c}").alias(c) for c in _VALUES])
    tagged = distinct.join(winners, ["series", "ts"], "left")
    is_winner = F.lit(True)
    for c in _VALUES:
        is_winner = is_winner & F.col(c).eqNullSafe(F.col(f"_w.{c}"))
    reason = F.coalesce(F.col("_invalid"), F.lit("duplicate"))
    copies = F.when(F.col("_invalid").isNull() & is_winner, F.col("copies") - 1).otherwise(F.col("copies"))
    rejects = (tagged.select("series", "ts", *_VALUES, reason.alias("reason"), copies.alias("copies"))
               .where(F.col("copies") > 0))
    return clean, rejects


CSV = {"header": "true", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def write_predictions(preds: DataFrame, path: str, fmt: str = "parquet",
                      mode: str = "overwrite") -> None:
    """IO3: predictions (parquet, CSV with header, ...) partitioned by model (one folder per model)."""
    (conform(preds, PREDS).write.mode(mode).format(fmt).options(**(CSV if fmt == "csv" else {}))
     .partitionBy("model").save(path))


def read_predictions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Predictions written by ``write_predictions``, with the fixed schema."""
    d = spark.read.schema(PREDS).format(fmt).options(**(CSV if fmt == "csv" else {})).load(path)
    return d.select(*PREDS.fieldNames())


def save_model(model, path: str) -> None:
    """IO4: persist a fitted pipeline (MLlib writer; overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """IO4: reload a pipeline saved by ``save_model``."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def chart_table(df: DataFrame, x: str, ys: list[str], buckets: int,
                by: str = "series") -> DataFrame:
    """IO5: plot-ready reduction: per series and x bucket, min / max / last of each y.

    Buckets split each series' x range into ``buckets`` equal widths with exact
    integer arithmetic on microseconds: bucket = (x - lo) * n div (hi - lo) + 1,
    the last edge folded into bucket n.  The per-series range is one row per
    series, joined back.  Output is at most series × buckets rows, whatever
    the input size.
    """
    xs = ntz_micros(F.col(x))
    base = df.withColumn("_x", xs)
    rng = base.groupBy(by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    n = F.lit(buckets).cast("long")
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
        F.least(F.expr(f"((_x - _lo) * {buckets}) div (_hi - _lo)") + 1, n))
    j = join_null_safe(base, rng, [by]).withColumn("bucket", b.cast("int"))
    aggs = [F.min(x).alias("x_first"), F.max(x).alias("x_last")]
    for y in ys:
        aggs += [F.min(y).alias(f"{y}_min"), F.max(y).alias(f"{y}_max"),
                 F.max_by(y, F.col("_x")).alias(f"{y}_last")]
    return j.groupBy(by, "bucket").agg(*aggs)
