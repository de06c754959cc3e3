"""Sources / sinks round trips and time-zone independence."""

import pytest

from conftest import SF001
from tidecast.operators import bars as tb
from tidecast.sources import io
from tidecast.sources.tables import FIXTURES


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_bars_round_trip(spark, tmp_path, fmt):
    bars = tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day")
    path = str(tmp_path / f"bars_{fmt}")
    io.write_bars(bars, path, fmt)
    back = io.read_bars(spark, path, fmt)
    assert back.schema == io.read_bars(spark, path, fmt).schema
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, bars.collect()))


def test_predictions_partitioned_by_model(spark, tmp_path):
    from tidecast.operators.naive import naive_forecast
    from tidecast.operators.ordered import Layout, bar_index
    bars = bar_index(tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day"), Layout())
    p = naive_forecast(bars, ["last", "ma"], n=5)
    path = str(tmp_path / "preds")
    io.write_predictions(p, path)
    import os
    assert {d for d in os.listdir(path) if d.startswith("model=")} == {"model=naive_last", "model=naive_ma5"}
    assert spark.read.parquet(path).count() == p.count()


@pytest.mark.parametrize("freq", ["hour", "day", "week", "month"])
def test_bars_do_not_depend_on_session_zone(spark, freq):
    def run():
        b = tb.ticks_to_bars(FIXTURES["events"](spark, SF001), freq)
        return sorted(map(tuple, b.collect()))
    utc = run()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert run() == utc
        gaps = sorted(map(tuple, tb.fill_gaps(tb.ticks_to_bars(FIXTURES["events"](spark, SF001), "hour"), "hour").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert gaps == sorted(map(tuple, tb.fill_gaps(tb.ticks_to_bars(FIXTURES["events"](spark, SF001), "hour"), "hour").collect()))
