"""Collects the registered queries of all plan modules."""

from __future__ import annotations


def all_queries():
    # the plan modules register their queries on import
    from tidecast.plans import (boosting_plans, catalog, feature_table, flagship, hybrid, modelling, null_recurrences, scenario_plans,  # noqa: F401
                                wide_windows)
    out = dict(catalog.REGISTRY)
    # The scale path (halo windows, distributed index, chunked running
    # aggregates, blocked scans) checked against the same oracles: small chunks
    # make every sf0.01 series span many chunks and index buckets.
    from tidecast.operators.ordered import Layout
    from tidecast.plans.common import with_layout
    halo = Layout(mode="halo", chunk_rows=256, bucket_bars=64)
    for name in HALO_CHECKED:
        fn, sql = out[name]
        out[f"{name}_halo"] = (with_layout(fn, halo), sql)
    return out


HALO_CHECKED = ("ts3_fill_gaps", "ts3_fill_gaps_bfill", "ts3_fill_gaps_linear", "ts3_fill_gaps_weekly", "ts3_fill_gaps_monthly", "ts4_returns", "ts5_drawdown", "ts5_max_drawdown", "ts6_autocorr", "ts7_summary",
                "fe1_lags", "fe2_rolling", "fe3_rolling_quantile", "fe4_zscore", "fe5_rolling_trend",
                "fe6_rolling_corr", "fe8_target", "fe10_sequence_windows",
                "ti1_sma", "ti2_wma", "ti3_roc", "ti4_bollinger", "ti5_donchian", "ti6_stochastic", "ti7_williams_r",
                "ti8_cci", "ti9_vwap", "ti10_cmf", "ti11_mfi", "ti12_obv", "ti13_adl", "ti14_ema", "ti15_macd",
                "ti16_rsi", "ti17_atr", "ti18_adx", "mo4_naive_forecast", "mo5_ensemble_weighted",
                "ev7_interval_coverage", "sc1_scenario_fan", "sc2_block_scenario_fan", "sc3_threshold_probability",
                "flagship_metrics", "features_panel",
                "ti14_ema_nulls", "ti15_macd_nulls", "ti16_rsi_nulls", "ti17_atr_nulls", "ti18_adx_nulls",
                "fe2_rolling_wide", "fe4_zscore_wide", "ti5_donchian_wide", "ti6_stochastic_wide", "ti7_williams_r_wide")
