"""Plan checks: no Python workers, no cartesian products, one shuffle for a
plain-layout feature table, pushed-down projections on the scan."""

from conftest import SF001
from tidecast.operators import bars as tb
from tidecast.operators import features as fe
from tidecast.operators import indicators as ti
from tidecast.operators.ordered import Layout, bar_index
from tidecast.sources.tables import FIXTURES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_is_jvm_only_and_shares_partitioning(spark):
    spark.catalog.clearCache()  # a cached identical plan would replace the aggregate
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        bars = tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day")
        lay = Layout()
        d = bar_index(bars, lay)
        d = fe.rolling(d, "close", 20, layout=lay)
        d = ti.sma(d, 10, layout=lay)
        d = ti.ema(d, 12, layout=lay)
        d = ti.obv(d, layout=lay)
        plan = _plan(d)
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
        # one exchange for the bars aggregate, one for the series windows
        assert plan.count("Exchange hashpartitioning") == 2, plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scan_prunes_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    bars = tb.ticks_to_bars(FIXTURES["lineitem"](spark, SF001), "day")
    plan = _plan(bars)
    schema = plan[plan.index("ReadSchema: "):].split("\n")[0]
    for used in ("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"):
        assert used in schema
    for unused in ("l_partkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus"):
        assert unused not in schema, schema


def test_halo_plan_has_no_cartesian_or_python(spark):
    lay = Layout(mode="halo", chunk_rows=256, bucket_bars=64)
    bars = tb.ticks_to_bars(FIXTURES["orders"](spark, SF001), "day")
    d = bar_index(bars, lay)
    d = fe.rolling(d, "close", 20, layout=lay)
    d = ti.macd(d, layout=lay)
    d = ti.obv(d, layout=lay)
    plan = _plan(d)
    for bad in ("Cartesian", "NestedLoop", "Python"):
        assert bad not in plan


def _shuffles(plan):
    import re
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan))


def test_one_pass_reads_and_shuffles_once(spark, tmp_path):
    """The whole panel in the halo layout: one scan of the ticks, at most eight shuffles, nothing run while planning."""
    import os

    from tidecast.operators.ordered import one_pass
    from tidecast.plans.feature_table import STEPS

    lay = Layout(mode="halo", chunk_rows=256, bucket_bars=64)
    bars = tb.ticks_to_bars(FIXTURES["lineitem"](spark, SF001), "day")
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = sorted(os.listdir(folder)) if os.path.isdir(folder) else []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(one_pass(bars, STEPS, layout=lay))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert (sorted(os.listdir(folder)) if os.path.isdir(folder) else []) == before
    assert plan.count("FileScan") == 1 and _shuffles(plan) <= 8, plan
    for bad in ("Cartesian", "NestedLoop", "Python"):
        assert bad not in plan
