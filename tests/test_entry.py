"""Driver contract and oracle parity on the smallest scale factor."""

import pytest

import __spark_entry__ as entry
from conftest import SF001

FAST = ["ts1_ticks_to_bars", "ts3_fill_gaps", "ts7_summary", "fe3_rolling_quantile", "ti8_cci",
        "ti15_macd", "ti18_adx", "mo5_ensemble_weighted", "va2_walk_forward", "sc2_block_scenario_fan",
        "flagship_metrics", "fe11_assemble", "va2_fold_ranges", "mo8_permuted_column",
        "mo9_learning_curve_linear", "io4_reloaded_same"]
FOLDS = ["va3_walk_forward_linear", "mo10_window_search"]  # sf0.001 has too few steps for them


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"model", "series", "rmse", "mae", "mape", "r2"} <= set(df.columns)


def test_oracle_keys_are_queries():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


@pytest.mark.parametrize("name", FAST)
def test_oracle_parity_sf0001(spark, name):
    from oracle_compare import compare, duck
    status, msg = compare(spark, duck(SF001), name, entry.queries()[name], entry.oracle_sql()[name], SF001)
    assert status == "OK", msg


@pytest.mark.parametrize("name", FOLDS)
def test_walk_forward_parity_sf001(spark, name):
    from oracle_compare import compare, duck
    folder = SF001.replace("sf0.001", "sf0.01")
    status, msg = compare(spark, duck(folder), name, entry.queries()[name], entry.oracle_sql()[name], folder)
    assert status == "OK", msg
