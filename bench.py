"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is forced to completion with the ``noop`` sink (full computation,
nothing collected to the driver) after one untimed warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("TIDECAST_MASTER", f"local[{cpus}]")
    os.environ.setdefault("TIDECAST_SHUFFLE_PARTITIONS", str(max(1, int(cpus))))  # one partition per core at this size

    from tidecast.operators import features as fe
    from tidecast.operators import indicators as ti
    from tidecast.operators.ordered import Layout
    from tidecast.plans.common import indexed_bars, with_layout
    from tidecast.plans.registry import all_queries
    from tidecast.session import checkpoint_dir, get_session

    spark = get_session()
    checkpoint_dir(spark)
    qs = all_queries()
    headline = {
        "bars_lineitem": "ts1_ticks_to_bars",
        "flagship": "flagship_metrics",
        "features_panel": "features_panel",
        "macd": "ti15_macd",
        "adx": "ti18_adx",
        "fill_gaps": "ts3_fill_gaps",
        "naive_metrics": "ev_metrics_by_fold",
        "ensemble_weighted": "mo5_ensemble_weighted",
        "walk_forward": "va2_walk_forward",
        "scenario_fan": "sc1_scenario_fan",
        "gbt_fit": "mo1_gbt_forecast",
        "hybrid": "hybrid_walk_forward_ensemble",
    }
    # These read all line items (600,000 at sf0.1), so they grow with the data; the panel also in the scale layout.
    def macd_lineitem(spark, sf_dir):
        bars, lay = indexed_bars(spark, sf_dir, "lineitem")
        return ti.macd(bars, layout=lay)

    def wide_window_lineitem(spark, sf_dir):
        bars, lay = indexed_bars(spark, sf_dir, "lineitem")
        return fe.rolling(bars, "close", 300, layout=lay)

    grows = {"macd_lineitem": macd_lineitem, "wide_window_lineitem": wide_window_lineitem,
             "features_panel_halo": with_layout(qs["features_panel"][0], Layout(mode="halo", chunk_rows=65_536))}
    calls = {name: qs[q][0] for name, q in headline.items()} | grows
    of_lineitem = ["bars_lineitem", "features_panel", *grows]
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]

    def run(name: str) -> float:
        t0 = time.time()
        calls[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.time() - t0

    run("flagship")  # warm-up (JVM, code paths), untimed
    times = {}
    for name in calls:
        if only and name not in only:
            continue
        times[name] = round(run(name), 3)
    sf_name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf: float | str = float(sf_name)
    except ValueError:
        sf = sf_name
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    rates = {name: round(rows / times[name]) for name in of_lineitem if name in times}
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "lineitem_rows_per_sec": rates, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
