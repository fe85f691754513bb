"""Operators that exist by name only: they parse, and computing them raises NotImplementedError."""

from __future__ import annotations

from factorloom.plans.dsl import Signature

# The names, by family.
FUNDAMENTAL = """
    fundamental_ttm_stub fundamental_yoy_stub fundamental_qoq_stub fundamental_cagr_stub fundamental_lag_quarter_stub days_since_filing_stub
    days_since_forecast_stub fundamental_revision_stub fundamental_surprise_stub fundamental_report_delay_stub fundamental_accruals_stub
    fundamental_cf_accruals_stub fundamental_asset_growth_stub fundamental_inv_growth_stub fundamental_rec_growth_stub fundamental_no_stub
    fundamental_payout_stub fundamental_rnd_intensity_stub fundamental_goodwill_ratio_stub fundamental_tax_rate_stub fundamental_roe_stub
    fundamental_roa_stub fundamental_gross_margin_stub fundamental_oper_margin_stub fundamental_net_margin_stub fundamental_leverage_stub
    fundamental_current_ratio_stub fundamental_quick_ratio_stub fundamental_interest_coverage_stub fundamental_altman_z_stub analyst_dispersion_stub
    analyst_revision_30d_stub insider_net_buy_stub institutional_ownership_chg_stub
"""
MICROSTRUCTURE = """
    lob_ofi_stub micro_mid_return_stub micro_spread_stub micro_effective_spread_stub micro_depth_imbalance_stub micro_book_slope_stub
    micro_quote_update_rate_stub micro_cancel_trade_ratio_stub micro_vpin_stub micro_trade_imbalance_stub micro_kyle_lambda_stub micro_amihud_hf_stub
    micro_realized_vol_stub micro_bipower_var_stub micro_jump_indicator_stub micro_trade_count_intensity_stub micro_avg_trade_size_stub
    micro_large_trade_ratio_stub micro_tick_rule_agreement_stub event_window_mask_stub universe_reit_stub
"""
ALTERNATIVE = """
    alt_sentiment_stub alt_sentiment_ema_stub alt_sentiment_delta_stub alt_sentiment_vol_stub alt_news_volume_stub alt_news_sentiment_x_volume_stub
    alt_earnings_call_tone_stub alt_8k_item_stub alt_litigation_stub alt_esg_score_stub alt_esg_controversy_stub alt_carbon_intensity_stub
    alt_supply_chain_exposure_stub alt_customer_concentration_stub alt_patent_citation_stub alt_web_traffic_stub alt_job_posting_stub
    alt_credit_spread_stub alt_satellite_activity_stub alt_app_rating_stub alt_social_buzz_stub
"""
INTRADAY = """
    intraday_agg_std_stub intraday_agg_var_stub intraday_agg_mean_stub intraday_agg_median_stub intraday_agg_sum_stub intraday_agg_max_stub
    intraday_agg_min_stub intraday_agg_argmax_stub intraday_agg_argmin_stub intraday_agg_skew_stub intraday_agg_kurt_stub intraday_agg_corr_stub
    intraday_agg_cov_stub intraday_agg_quantile_stub intraday_explode_return_stub intraday_explode_cumsum_stub intraday_explode_cumprod_stub
    intraday_explode_cummin_stub intraday_explode_cummax_stub intraday_explode_ewmmean_stub intraday_explode_ewmstd_stub intraday_explode_ewmvar_stub
    intraday_explode_rollingmean_stub intraday_explode_rollingstd_stub intraday_explode_rollingvar_stub intraday_explode_rollingskew_stub
    intraday_explode_rollingmin_stub intraday_explode_rollingmax_stub intraday_explode_rollingsum_stub intraday_explode_rollingquantile_stub
    intraday_tp_sample_stub
"""

NAMES = [n for family in (FUNDAMENTAL, MICROSTRUCTURE, ALTERNATIVE, INTRADAY) for n in family.split()]
SIGNATURES = {n: Signature.of("@x") for n in NAMES}
