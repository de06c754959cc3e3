"""Edge cases of FIXTURES.md §4."""

import datetime as dt

import pytest

from conftest import bars_df
from tidecast.operators import bars as tb
from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.operators.ordered import Layout, bar_index
from tidecast.sources.io import clean_bars


def test_clean_bars_rejects_with_reasons(spark):
    rows = [("A", dt.datetime(2024, 1, 1), 1.0, 2.0, 0.5, 1.5, 10.0),
            ("A", dt.datetime(2024, 1, 1), 1.0, 2.0, 0.5, 1.4, 5.0),    # duplicate, lower volume
            ("A", dt.datetime(2024, 1, 2), None, 2.0, 0.5, 1.5, 10.0),  # null price
            ("A", dt.datetime(2024, 1, 3), 1.0, 2.0, -1.0, 1.5, 10.0),  # non-positive
            ("A", dt.datetime(2024, 1, 4), 1.0, 0.5, 2.0, 1.5, 10.0)]   # high < low
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, open double, high double, low double, close double, volume double")
    clean, rej = clean_bars(df)
    c = clean.collect()
    assert len(c) == 1 and c[0]["close"] == 1.5
    assert sorted(r["reason"] for r in rej.collect()) == ["duplicate", "high_below_low", "non_positive_price", "null_price"]


def test_clean_bars_hot_duplicate_group(spark):
    base = ("A", dt.datetime(2024, 1, 1), 1.0, 2.0, 0.5, 1.5, 10.0)
    rows = [base] * 500 + [("A", dt.datetime(2024, 1, 1), 1.0, 2.0, 0.5, 1.6, 10.0)] * 300 + \
        [("A", dt.datetime(2024, 1, 1), 1.0, 2.0, 0.5, 1.0, 20.0)] * 2
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, open double, high double, low double, close double, volume double")
    clean, rej = clean_bars(df)
    c = clean.collect()
    assert len(c) == 1 and c[0]["volume"] == 20.0 and c[0]["close"] == 1.0
    assert sum(r["copies"] for r in rej.collect()) == len(rows) - 1


def test_one_row_and_short_series(spark):
    d = bar_index(bars_df(spark, [(0, 1, 1, 1, 1, 1)]), Layout())
    d = ti.sma(d, 3)
    d = ti.rsi(d, 14)
    d = ti.ema(d, 5)
    d = fe.rolling_corr(d, "close", "volume", 3)
    r = d.first()
    assert r["sma3"] is None and r["rsi14"] is None and r["ema5"] is None and r["corr_close_volume_3"] is None


def test_constant_series_is_safe(spark):
    rows = [(k, 5, 5, 5, 5, 0) for k in range(30)]
    d = bar_index(bars_df(spark, rows), Layout())
    d = fe.rolling_corr(d, "close", "volume", 5)
    d = fe.zscore(d, "close", 5)
    d = ti.rsi(d, 14)
    d = ti.vwap(d, 5)
    d = ti.cmf(d, 5)
    d = ti.stochastic(d, 5, 3)
    out = d.collect()
    assert all(r["corr_close_volume_5"] is None for r in out)
    assert all(r["rsi14"] is None for r in out)          # no gains, no losses
    assert all(r["vwap5"] is None for r in out)          # zero volume
    assert all(r["cmf5"] is None for r in out)
    assert all(r["close_z5"] is None for r in out)


def test_out_of_order_input_and_equal_ts_ticks(spark):
    ticks = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 1, 9), 2, 11.0, 1.0), ("A", dt.datetime(2024, 1, 1, 9), 1, 10.0, 1.0),
         ("A", dt.datetime(2024, 1, 1, 8), 5, 9.0, 2.0), ("A", dt.datetime(2024, 1, 1, 10), 3, 12.0, 1.0),
         ("A", dt.datetime(2024, 1, 1, 10), 3, 13.0, 1.0)],  # equal ts and seq: price breaks the tie
        "series string, ts timestamp_ntz, seq long, price double, qty double")
    b = tb.ticks_to_bars(ticks, "day").first()
    assert (b["open"], b["high"], b["low"], b["close"], b["volume"]) == (9.0, 13.0, 9.0, 13.0, 6.0)


def test_non_positive_price_gives_null_log_return(spark):
    rows = [(0, 1, 1, 1, 10, 1), (1, 1, 1, 1, 0.0, 1), (2, 1, 1, 1, 5, 1)]
    d = tb.returns(bar_index(bars_df(spark, rows), Layout()), "log", 1)
    assert [r["ret_log_1"] for r in d.orderBy("i").collect()] == [None, None, None]


def test_long_gap_and_summary(spark):
    rows = [(0, 1, 1, 1, 1, 1), (1, 1, 1, 1, 2, 1), (40, 1, 1, 1, 3, 1)]
    s = tb.summary(bars_df(spark, rows), "close").first()
    assert s["gaps"] == 1 and s["n"] == 3 and s["q50"] == 2.0


def test_autocorr_constant_series_is_null(spark):
    rows = [(k, 5, 5, 5, 5, 1) for k in range(20)]
    out = tb.autocorr(bars_df(spark, rows), "close", [1, 2]).collect()
    assert all(r["acf"] is None for r in out)


def test_scan_with_null_after_start(spark):
    from pyspark.sql import functions as F

    from tidecast.operators.ordered import linear_scan
    rows = [(k, 1, 1, 1, 1.0 + k, 1) for k in range(6)]
    d = bar_index(bars_df(spark, rows), Layout()).withColumn(
        "x", F.when(F.col("i") == 3, F.lit(None)).otherwise(F.col("close")))
    out = [r["y"] for r in linear_scan(d, "x", 0.5, "y").orderBy("i").collect()]
    # x = 1, 2, 3, NULL, 5, 6: a NULL gives a NULL output and leaves the state as it is
    assert out[:3] == [1.0, 1.5, 2.25] and out[3] is None
    assert out[4] == pytest.approx(3.625) and out[5] == pytest.approx(4.8125)


HALO = Layout(mode="halo", chunk_rows=16, bucket_bars=8)


@pytest.mark.parametrize("layout", [Layout(), HALO])
def test_recurrences_carry_state_over_nulls(spark, layout):
    """Every recurrence on bars with NULL closes equals a loop over the known inputs."""
    import random

    rng = random.Random(4)
    closes = [None if k in (0, 5, 6) or 30 <= k < 60 else 100 + rng.uniform(-3, 3) for k in range(140)]
    rows = [(k, 1, (c or 100) + 1, (c or 100) - 1, c if c is not None else 0, 1) for k, c in enumerate(closes)]
    from pyspark.sql import functions as F

    d = bars_df(spark, rows).withColumn("close", F.when(F.col("close") != 0, F.col("close")))
    d = bar_index(d, layout)
    d = ti.ema(ti.rsi(d, 5, layout=layout), alpha=0.25, out="e", layout=layout)
    got = d.orderBy("ts").collect()

    def smooth(xs, alpha, n):
        out, y, seen = [], None, 0
        for x in xs:
            if x is not None:
                y = x if y is None else alpha * x + (1 - alpha) * y
                seen += 1
            out.append(y if x is not None and seen >= n else None)
        return out

    change = [None if i == 0 or closes[i] is None or closes[i - 1] is None else closes[i] - closes[i - 1] for i in range(140)]
    gain = smooth([None if c is None else max(c, 0) for c in change], 0.2, 5)
    loss = smooth([None if c is None else max(-c, 0) for c in change], 0.2, 5)
    rsi = [None if a is None else 100 - 100 / (1 + a / b) for a, b in zip(gain, loss)]
    assert [r["e"] for r in got] == [x if x is None else pytest.approx(x) for x in smooth(closes, 0.25, 1)]
    assert [r["rsi5"] for r in got] == [x if x is None else pytest.approx(x) for x in rsi]


def test_layouts_keep_rows_with_null_keys(spark):
    from pyspark.sql import functions as F

    d = bars_df(spark, [(k, 1, 2, 1, 1 + k % 3, k) for k in range(60)])
    d = d.withColumn("series", F.when(F.col("volume") % 4 != 0, F.col("series"))).withColumn("ts", F.when(F.col("volume") != 7, F.col("ts")))
    plain, halo = (sorted((r.series or "", r.i, r.obv, r.volume) for r in ti.obv(bar_index(d, lay), layout=lay).collect()) for lay in (Layout(), HALO))
    assert len(plain) == 60 and plain == halo


def test_clean_bars_puts_every_row_in_one_result(spark):
    nan, t = float("nan"), dt.datetime(2024, 1, 1)
    rows = [("A", t, 1.0, 2.0, 0.5, 1.5, 1.0), (None, t, 1.0, 2.0, 0.5, 1.5, 1.0), ("A", None, 1.0, 2.0, 0.5, 1.5, 1.0), ("B", t, 1.0, 2.0, 0.5, nan, 1.0)]
    clean, rejects = clean_bars(spark.createDataFrame(rows, "series string, ts timestamp_ntz, open double, high double, low double, close double, volume double"))
    assert clean.count() == 1 and sorted(r.reason for r in rejects.collect()) == ["nan_price", "null_key", "null_key"]


def test_weekly_bars_keep_their_places(spark):
    rows = [(7 * k, 1, 2, 1, 1 + k, 5) for k in range(25) if k not in (3, 4, 20)]
    out = tb.fill_gaps(bars_df(spark, rows), "week").orderBy("ts").collect()
    assert len(out) == 25 and [r["i"] for r in out if r["is_filled"]] == [3, 4, 20]
    assert [r["close"] for r in out][:6] == [1.0, 2.0, 3.0, 3.0, 3.0, 6.0]
    with pytest.raises(Exception, match="bar widths"):
        tb.fill_gaps(bars_df(spark, rows + [(2, 1, 2, 1, 1, 1)]), "week").collect()


def test_ensemble_and_scenarios_with_nulls(spark):
    from pyspark.sql import functions as F

    from tidecast.operators import models as mo
    from tidecast.operators import scenarios as sc

    preds = spark.createDataFrame([("a", 0, "S", dt.datetime(2024, 1, 1), 1, 9.0, 10.0), ("b", 0, "S", dt.datetime(2024, 1, 1), 1, 9.0, None)],
                                  "model string, fold int, series string, ts timestamp_ntz, horizon int, y double, yhat double")
    r = mo.ensemble_weighted(preds).first()
    assert r["yhat"] == 10.0 and r["members"] == 1
    d = bars_df(spark, [(k, 1, 1, 1, c, 1) for k, c in enumerate((1, 2, 0, 4, 8, 4))])
    rets = sc.past_log_returns(bar_index(d.withColumn("close", F.when(F.col("close") != 1, F.col("close"))), Layout()))
    assert sorted(round(x["r"], 3) for x in rets.collect()) == [-0.693, 0.693] and sorted(x["k"] for x in rets.collect()) == [0, 1]
    assert sc.scenario_paths(rets, paths=20, horizon=3).where("cum_return is null").count() == 0


def test_read_bars_misses_a_column(spark, tmp_path):
    from tidecast.sources import io

    for fmt in ("parquet", "csv"):
        io.write_bars(bars_df(spark, [(0, 1, 1, 1, 1, 1)]).drop("volume"), f"{tmp_path}/{fmt}", fmt)
        with pytest.raises(ValueError, match="volume"):
            io.read_bars(spark, f"{tmp_path}/{fmt}", fmt)


def test_clean_bars_rejects_match_oracle_sql_on_dirty_bars(spark):
    """The registered IO2 rejects oracle and clean_bars agree on bars with
    duplicates, exact copies, invalid prices and a NULL volume."""
    import duckdb
    import pandas as pd

    import __spark_entry__ as entry
    d0 = dt.datetime(2024, 1, 1)
    rows = ([("A", d0, 1.0, 2.0, 0.5, 1.5, 10.0)] * 3 + [("A", d0, 1.0, 2.0, 0.5, 1.4, 5.0)] * 2 +
            [("A", d0 + dt.timedelta(days=1), None, 2.0, 0.5, 1.5, 10.0),
             ("A", d0 + dt.timedelta(days=2), 1.0, 2.0, -1.0, 1.5, 10.0),
             ("A", d0 + dt.timedelta(days=3), 1.0, 0.5, 2.0, 1.5, 10.0),
             ("B", d0, 3.0, 3.0, 3.0, 3.0, None), ("B", d0, 3.0, 3.0, 3.0, 2.0, 1.0)])
    cols = ["series", "ts", "open", "high", "low", "close", "volume"]
    sdf = spark.createDataFrame(rows, "series string, ts timestamp_ntz, open double, high double, low double, close double, volume double")
    _, rej = clean_bars(sdf)
    sql = entry.oracle_sql()["io2_clean_bars_rejects"]
    con = duckdb.connect()
    con.register("bars_df", pd.DataFrame(rows, columns=cols))
    want = con.execute("WITH bars AS (SELECT * FROM bars_df), " + sql[sql.index("d AS ("):]).fetchall()
    got = sorted(tuple(r) for r in rej.collect())
    assert got == sorted(tuple(r) for r in want) and len(got) == 6
