"""Late ticks in the stream; halo chunks exactly as long as the lookback."""

import datetime as dt

import pytest

from conftest import SF001
from tidecast.operators import bars as tb
from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.operators.ordered import Layout, bar_index
from tidecast.sources.tables import FIXTURES


def test_tick_later_than_watermark_is_dropped(spark, tmp_path):
    """Append mode emits a day bar once the watermark passes its end; a tick for
    that day arriving afterwards is dropped and never changes the emitted bar.
    (Spark filters late rows with the watermark of the previous batch, so the
    late tick comes two batches after the watermark moved past day 1.)"""
    from tidecast.schema import TICKS
    from tidecast.streaming.bars import run_available, stream_bars
    src = tmp_path / "ticks"
    day = dt.datetime(2024, 1, 1)
    batches = [
        [("A", day + dt.timedelta(days=d, hours=h), d * 10 + h, 10.0 + d + h / 100, 1.0)
         for d in range(3) for h in (1, 5, 9)],
        [("A", day + dt.timedelta(days=4, hours=2), 50, 20.0, 1.0)],
        [("A", day + dt.timedelta(hours=12), 999, 1000.0, 1.0),          # late: day 1 already emitted
         ("A", day + dt.timedelta(days=5, hours=2), 60, 21.0, 1.0)],
    ]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, TICKS).coalesce(1).write.parquet(str(src / f"b{k}"))
    stream = (spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(str(src)))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    run_available(stream_bars(stream, "1 day", "1 hour"), out, ck)
    bars = {r["ts"]: r for r in spark.read.parquet(out).collect()}
    first = bars[day]
    assert first["high"] < 1000.0 and first["volume"] == 3.0


@pytest.mark.parametrize("n", [5, 20])
def test_chunk_borders_exactly_at_lookback(spark, n):
    bars = tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day")
    def table(lay):
        d = bar_index(bars, lay)
        d = fe.rolling(d, "close", n, ["mean", "min"], layout=lay)
        d = fe.lags(d, "close", [n], layout=lay)
        d = ti.wma(d, n, layout=lay)
        d = fe.target(d, n, "price", layout=lay)
        return {(r["series"], r["ts"]): tuple(r) for r in d.collect()}
    assert table(Layout()) == table(Layout(mode="halo", chunk_rows=n, bucket_bars=n))
