"""Queries over sources, evaluation, composition, portfolios, risk and intraday operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorloom.functions.common import cut_lineage, finite, key_upper, read_table, trimmed
from factorloom.operators import account_figures, asof, cleaning, composite, evaluation, minute, portfolio, risk, single_asset
from factorloom.plans.compiler import compute, panel
from factorloom.plans.factor_queries import ALL, CS, PANEL_SQL, W, daily_panel, ema_sql, prank
from factorloom.sources.lake import merge_new
from factorloom.sources.panels import build_source, composite_panel, table_report

HORIZON, N = 2, 5
REVERSAL = '-(col("open") / ts_delay(col("open"), 5) - 1)'
TREND = 'ts_mean(col("open"), 10) / ts_mean(col("open"), 20) - 1'


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def bars_with_returns(spark: SparkSession, d: str) -> DataFrame:
    p = daily_panel(spark, d)
    base = compute(p, {"value": REVERSAL, "trend": TREND}, keep=["open", "volume", "sector"])
    return evaluation.forward_returns(base, "open", [HORIZON])


def eval_base(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.assign_quantiles(evaluation.prepare_factor(bars_with_returns(spark, d)), n=N)


_WO = "OVER (PARTITION BY instrument ORDER BY timestamp)"
BASE_SQL = f"""{PANEL_SQL},
b0 AS (SELECT *, -(open / nullif(lag(open, 5) {_WO}, 0) - 1) AS value,
  CASE WHEN count(open) OVER (PARTITION BY instrument ORDER BY timestamp ROWS 9 PRECEDING) >= 10 AND count(open) OVER (PARTITION BY instrument ORDER BY timestamp ROWS 19 PRECEDING) >= 20
    THEN avg(open) OVER (PARTITION BY instrument ORDER BY timestamp ROWS 9 PRECEDING) / nullif(avg(open) OVER (PARTITION BY instrument ORDER BY timestamp ROWS 19 PRECEDING), 0) - 1 END AS trend,
  lead(open) {_WO} / nullif(open, 0) - 1 AS one_step_return, lead(open, 3) {_WO} / nullif(lead(open) {_WO}, 0) - 1 AS ret_2 FROM q),
b1 AS (SELECT *, CASE WHEN value IS NOT NULL THEN least(greatest(value, quantile_cont(value, 0.01) {CS}), quantile_cont(value, 0.99) {CS}) END AS cv FROM b0),
b2 AS (SELECT *, (cv - avg(cv) {CS}) / nullif(stddev_pop(cv) {CS}, 0) AS factor_eval FROM b1),
base AS (SELECT *, CASE WHEN factor_eval IS NOT NULL AND count(factor_eval) {CS} >= 5 THEN
  CAST(greatest(least(ceil(row_number() OVER (PARTITION BY timestamp ORDER BY factor_eval NULLS LAST, instrument) / count(factor_eval) {CS} * 5), 5), 1) AS INT) END AS quantile FROM b2)"""
PAIRS = "v AS (SELECT timestamp, factor_eval AS x, ret_2 AS y FROM base WHERE factor_eval IS NOT NULL AND ret_2 IS NOT NULL)"
IC_SQL = f"""{BASE_SQL}, {PAIRS}, rk AS (SELECT *, {prank("x")} AS rx, {prank("y")} AS ry FROM v),
ic AS (SELECT timestamp, covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) AS ic, covar_pop(rx, ry) / nullif(stddev_pop(rx) * stddev_pop(ry), 0) AS rank_ic, count(*) AS universe_size FROM rk GROUP BY 1 HAVING count(*) >= 3)"""
PERIOD_SQL = f"{BASE_SQL}, period AS (SELECT timestamp, quantile, avg(ret_2) AS period_return FROM base WHERE quantile IS NOT NULL AND ret_2 IS NOT NULL GROUP BY 1, 2)"
TRANCHE_SQL = f"""{BASE_SQL}, w0 AS (SELECT *, 1.0 / count(*) OVER (PARTITION BY timestamp, quantile) AS wt FROM base),
w1 AS (SELECT timestamp, one_step_return AS r, lag(quantile, 1) {_WO} AS q1, lag(quantile, 2) {_WO} AS q2, lag(CASE WHEN quantile IS NOT NULL THEN wt END, 1) {_WO} AS x1, lag(CASE WHEN quantile IS NOT NULL THEN wt END, 2) {_WO} AS x2 FROM w0),
w2 AS (SELECT timestamp, r, q1 AS quantile, x1 AS x FROM w1 UNION ALL SELECT timestamp, r, q2, x2 FROM w1),
tr AS (SELECT timestamp, quantile, sum(x * r) / sum(x) AS daily_return FROM w2 WHERE quantile IS NOT NULL AND r IS NOT NULL GROUP BY 1, 2),
tranche AS (SELECT *, product(1 + daily_return) OVER (PARTITION BY quantile ORDER BY timestamp) AS nav FROM tr)"""
LS_SQL = f"""{TRANCHE_SQL}, ls0 AS (SELECT timestamp, max(CASE WHEN quantile = 5 THEN daily_return END) AS top_daily_return, max(CASE WHEN quantile = 1 THEN daily_return END) AS bottom_daily_return FROM tranche GROUP BY 1),
ls AS (SELECT *, top_daily_return - bottom_daily_return AS long_short_return, product(1 + coalesce(top_daily_return - bottom_daily_return, 0)) OVER (ORDER BY timestamp) AS nav FROM ls0 WHERE top_daily_return IS NOT NULL OR bottom_daily_return IS NOT NULL)"""

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


@query("ev_base", f"WITH {BASE_SQL} SELECT instrument, timestamp, round(factor_eval, 6) AS factor_eval, quantile, round(one_step_return, 6) AS one_step_return, round(ret_2, 6) AS ret_2 FROM base")
def ev_base(spark, d):
    return rounded(eval_base(spark, d).select("instrument", "timestamp", "factor_eval", "quantile", "one_step_return", "ret_2"), "factor_eval", "one_step_return", "ret_2")


def _ic(spark, d):
    return evaluation.daily_ic(eval_base(spark, d), "ret_2", least=3)


@query("ev_daily_ic", f"WITH {IC_SQL} SELECT timestamp, round(ic, 6) AS ic, round(rank_ic, 6) AS rank_ic, universe_size FROM ic")
def ev_daily_ic(spark, d):
    return rounded(_ic(spark, d), "ic", "rank_ic")


@query("ev_ic_summary", f"WITH {IC_SQL} SELECT round(avg(ic), 6) AS mean, round(stddev_samp(ic), 6) AS std, round(avg(ic) / nullif(stddev_samp(ic), 0), 6) AS ir, round(avg(CASE WHEN ic > 0 THEN 1.0 ELSE 0.0 END), 6) AS win_rate, count(ic) AS n_dates FROM ic WHERE ic IS NOT NULL")
def ev_ic_summary(spark, d):
    return rounded(evaluation.summarize(_ic(spark, d), "ic"), "mean", "std", "ir", "win_rate")


@query("ev_period_returns", f"WITH {PERIOD_SQL} SELECT timestamp, quantile, round(period_return, 6) AS period_return FROM period")
def ev_period_returns(spark, d):
    return rounded(evaluation.period_returns(eval_base(spark, d), "ret_2"), "period_return")


@query("ev_monotonicity", f"""WITH {PERIOD_SQL}, m AS (SELECT quantile, avg(period_return) AS m, 1 AS one FROM period GROUP BY 1), rk AS (SELECT {prank("quantile", "one")} AS rq, {prank("m", "one")} AS rm FROM m),
s AS (SELECT timestamp, max(CASE WHEN quantile = 5 THEN period_return END) - max(CASE WHEN quantile = 1 THEN period_return END) AS s FROM period GROUP BY 1)
SELECT round((SELECT corr(rq, rm) FROM rk), 6) AS monotonicity, round((SELECT avg(s) FROM s), 6) AS top_minus_bottom_mean""")
def ev_monotonicity(spark, d):
    return rounded(evaluation.monotonicity(evaluation.period_returns(eval_base(spark, d), "ret_2")), "monotonicity", "top_minus_bottom_mean")


def _tranches(spark, d):
    return evaluation.tranche_backtest(eval_base(spark, d), HORIZON, N)


@query("ev_tranche_backtest", f"WITH {TRANCHE_SQL} SELECT timestamp, quantile, round(daily_return, 6) AS daily_return, round(nav, 6) AS nav FROM tranche")
def ev_tranche_backtest(spark, d):
    return rounded(_tranches(spark, d), "daily_return", "nav")


@query("ev_long_short", f"WITH {LS_SQL} SELECT timestamp, round(top_daily_return, 6) AS top_daily_return, round(bottom_daily_return, 6) AS bottom_daily_return, round(long_short_return, 6) AS long_short_return, round(nav, 6) AS nav FROM ls")
def ev_long_short(spark, d):
    return rounded(evaluation.long_short(_tranches(spark, d), N), "top_daily_return", "bottom_daily_return", "long_short_return", "nav")


@query("ev_long_short_summary", f"""WITH {LS_SQL}, x AS (SELECT timestamp, long_short_return AS r, product(1 + long_short_return) OVER (ORDER BY timestamp) AS nav FROM ls WHERE long_short_return IS NOT NULL),
y AS (SELECT *, nav / max(nav) OVER (ORDER BY timestamp) - 1 AS dd FROM x)
SELECT round(arg_max(nav, timestamp) - 1, 6) AS total_return, round(pow(arg_max(nav, timestamp), 252.0 / count(*)) - 1, 6) AS ann_return, round(stddev_samp(r) * sqrt(252), 6) AS ann_vol, round(avg(r) / nullif(stddev_samp(r), 0) * sqrt(252), 6) AS sharpe, round(min(dd), 6) AS max_drawdown FROM y""")
def ev_long_short_summary(spark, d):
    out = evaluation.return_summary(evaluation.long_short(_tranches(spark, d), N), "long_short_return")
    return rounded(out, "total_return", "ann_return", "ann_vol", "sharpe", "max_drawdown")


# sources and joins
LAKE_VALUES = """lv AS (SELECT upper(regexp_replace(asset, '^\\s+|\\s+$', '', 'g')) AS instrument, datetime AS ts, max(CASE WHEN isfinite(value) THEN value END) AS value
  FROM factor_lake WHERE asset IS NOT NULL AND datetime IS NOT NULL GROUP BY 1, 2)"""
BAR_ROWS = "br AS (SELECT bar_id, upper(regexp_replace(ticker, '^\\s+|\\s+$', '', 'g')) AS instrument, align_time AS ts FROM daily_market_summary)"


def _lake_and_bars(spark, d):
    lake = panel(read_table(spark, d, "factor_lake"), F.col("datetime"), key_upper("asset"), {"value": F.col("value")})
    lake = lake.groupBy("timestamp", "instrument").agg(F.max("value").alias("value"))
    bars = read_table(spark, d, "daily_market_summary").select("bar_id", key_upper("ticker").alias("instrument"), F.col("align_time").alias("timestamp"))
    return lake, bars


@query("src_asof_backward", f"WITH {LAKE_VALUES}, {BAR_ROWS} SELECT bar_id, CASE WHEN br.ts - lv.ts <= INTERVAL 3 DAY THEN value END AS value FROM br ASOF LEFT JOIN lv ON br.instrument = lv.instrument AND br.ts >= lv.ts")
def src_asof_backward(spark, d):
    lake, bars = _lake_and_bars(spark, d)
    return asof.as_of(bars, lake, columns=["value"], tolerance_us=3 * asof.DAY_US).select("bar_id", "value")


@query("src_forward_fill", f"WITH {LAKE_VALUES}, {BAR_ROWS} SELECT bar_id, value FROM br ASOF LEFT JOIN (SELECT * FROM lv WHERE value IS NOT NULL) lv ON br.instrument = lv.instrument AND br.ts >= lv.ts")
def src_forward_fill(spark, d):
    lake, bars = _lake_and_bars(spark, d)
    return asof.as_of(bars, lake, columns=["value"], skip_missing=True).select("bar_id", "value")


_AGG_DAYS = """ad AS (SELECT upper(regexp_replace(ticker, '^\\s+|\\s+$', '', 'g')) AS instrument, CAST(make_timestamp(window_start // 1000) AS DATE) AS timestamp,
  max(CASE WHEN isfinite(volume) THEN volume END) AS agg_volume FROM day_aggs WHERE window_start <> 0 GROUP BY 1, 2)"""


def _agg_panel(spark, d):
    aggs = read_table(spark, d, "day_aggs").filter("window_start <> 0")
    day = F.date_from_unix_date(F.floor(F.col("window_start") / 86_400_000_000_000).cast("int"))
    return panel(aggs, day, key_upper("ticker"), {"volume": F.col("volume")}).groupBy("timestamp", "instrument").agg(F.max("volume").alias("volume"))


@query("src_composite_exact", f"WITH {PANEL_SQL}, {_AGG_DAYS} SELECT p.instrument, p.timestamp, p.open, agg_volume AS aggs_volume FROM p LEFT JOIN ad USING (instrument, timestamp)")
def src_composite_exact(spark, d):
    out = composite_panel(daily_panel(spark, d), {"aggs": (_agg_panel(spark, d), "exact")})
    return out.select("instrument", "timestamp", "open", "aggs_volume")


@query("src_one_panel", f"WITH {PANEL_SQL}, {_AGG_DAYS}, a AS (SELECT * FROM ad WHERE instrument <> '') SELECT coalesce(p.instrument, a.instrument) AS instrument, coalesce(p.timestamp, a.timestamp) AS timestamp, p.open, a.agg_volume AS volume FROM p FULL JOIN a ON p.instrument = a.instrument AND p.timestamp = a.timestamp")
def src_one_panel(spark, d):
    bars = daily_panel(spark, d).select("timestamp", "instrument", F.col("open").alias("value"))
    return asof.one_panel({"open": bars, "volume": _agg_panel(spark, d).withColumnRenamed("volume", "value")})


@query("src_clean_explode", f"""SELECT source, time_columns, timezone, sha256(source || chr(31) || time_columns) AS row_key FROM (SELECT source, upper(regexp_replace(c, '^\\s+|\\s+$', '', 'g')) AS time_columns, timezone FROM (SELECT source, unnest(time_columns) AS c, timezone FROM source_config))""")
def src_clean_explode(spark, d):
    out = cleaning.clean_table(read_table(spark, d, "source_config"), key=["source", "time_columns"], lists=["time_columns"], tickers=["time_columns"])
    return out.select("source", "time_columns", "timezone", "row_key")


_ASSET = "upper(regexp_replace(ticker, '^\\s+|\\s+$', '', 'g'))"
SPAN = ("2023-01-01", "2024-06-30")


@query("src_parquet", f"""SELECT instrument, timestamp, open, volume FROM (SELECT regexp_replace(ticker, '^\\s+|\\s+$', '', 'g') AS instrument, CAST(CAST(make_timestamp(window_start // 1000) AS DATE) AS TIMESTAMP) AS timestamp, CASE WHEN isfinite(open) THEN open END AS open, CASE WHEN isfinite(volume) THEN volume END AS volume,
  row_number() OVER (PARTITION BY regexp_replace(ticker, '^\\s+|\\s+$', '', 'g'), CAST(make_timestamp(window_start // 1000) AS DATE) ORDER BY ingested_at DESC NULLS LAST, open DESC NULLS LAST, volume DESC NULLS LAST) AS k FROM day_aggs WHERE ticker IS NOT NULL AND window_start <> 0
  AND CAST(make_timestamp(window_start // 1000) AS DATE) BETWEEN DATE '{SPAN[0]}' AND DATE '{SPAN[1]}') WHERE k = 1 AND instrument <> ''""")
def src_parquet(spark, d):
    """Daily bars of a year and a half, the bounds reaching the scan in nanoseconds."""
    spec = {"type": "parquet_kline", "path": f"{d}/day_aggs.parquet", "fields": {"open": "open", "volume": "volume"}, "start": SPAN[0], "end": SPAN[1], "last_by": "ingested_at"}
    return build_source(spark, spec).select("instrument", "timestamp", "open", "volume")


@query("src_validate", """SELECT count(*) AS rows, CAST(sum((ticker IS NULL)::INT + (window_start IS NULL)::INT + coalesce(isnan(open), true)::INT + coalesce(isnan(high), true)::INT + coalesce(isnan(low), true)::INT + coalesce(isnan(close), true)::INT + coalesce(isnan(volume), true)::INT
  + coalesce(isnan(transactions), true)::INT + (ingested_at IS NULL)::INT) AS BIGINT) AS nulls, count(*) FILTER (WHERE volume < 0) AS negatives, CAST(0 AS BIGINT) AS problems FROM day_aggs""")
def src_validate(spark, d):
    report = table_report(spark, f"{d}/day_aggs.parquet", not_negative=["volume"])
    return report.agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("negatives").alias("negatives"), F.count("problem").alias("problems"))


@query("src_one_to_one", f"WITH {PANEL_SQL}, {_AGG_DAYS} SELECT p.instrument, p.timestamp, p.open, ad.agg_volume AS volume FROM p JOIN ad ON p.instrument = ad.instrument AND p.timestamp = ad.timestamp")
def src_one_to_one(spark, d):
    bars, aggs = asof.on_common_dates(daily_panel(spark, d).select("timestamp", "instrument", "open"), _agg_panel(spark, d))
    return asof.one_to_one(bars, aggs, ["timestamp", "instrument"]).select("instrument", "timestamp", "open", "volume")


LEAST = {"ic_mean": 0.0, "ic_win_rate": 0.5, "long_short_sharpe": 0.5, "long_short_max_drawdown": -0.3}
_FAILED = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} IS NULL OR isnan({c}) THEN '{c} missing' WHEN {c} < {v} THEN '{c} below {v}' END" for c, v in LEAST.items()) + "], lambda x: x IS NOT NULL), '; ')"


@query("ev_thresholds", f"SELECT run_id, horizon, written_at, failures = '' AS passed, failures FROM (SELECT run_id, horizon, written_at, {_FAILED} AS failures FROM factor_evaluation_summary)")
def ev_thresholds(spark, d):
    return evaluation.below_thresholds(read_table(spark, d, "factor_evaluation_summary"), LEAST, ["run_id", "horizon", "written_at"])


_BAR_DAYS = f"SELECT {_ASSET} AS asset, CAST(trade_date AS DATE) AS day, max(CASE WHEN isfinite(v) THEN v END) AS volume FROM daily_market_summary GROUP BY 1, 2"


@query("lake_upsert", f"""WITH old AS ({_BAR_DAYS}), {_AGG_DAYS} SELECT coalesce(ad.instrument, old.asset) AS asset, coalesce(ad.timestamp, old.day) AS day, CASE WHEN ad.instrument IS NOT NULL THEN agg_volume ELSE volume END AS volume
  FROM (SELECT * FROM old WHERE asset <> '') old FULL JOIN (SELECT * FROM ad WHERE instrument <> '') ad ON ad.instrument = old.asset AND ad.timestamp = old.day""")
def lake_upsert(spark, d):
    """The bars' volumes with those of the daily aggregates over them, which win where both have a key."""
    bars = read_table(spark, d, "daily_market_summary").select(key_upper("ticker").alias("asset"), F.to_date("trade_date").alias("day"), finite("v").alias("volume"))
    old = bars.dropna(subset=["asset"]).groupBy("asset", "day").agg(F.max("volume").alias("volume"))
    new = _agg_panel(spark, d).select(F.col("instrument").alias("asset"), F.col("timestamp").alias("day"), "volume")
    return merge_new(old, new, ["asset", "day"]).select("asset", "day", "volume")


# composite
def _factors(spark, d):
    df = bars_with_returns(spark, d)
    return composite.preprocess(df, ["value", "trend"], directions={"trend": -1.0})


CLIP = lambda x: f"CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, quantile_cont({x}, 0.01) {CS}), quantile_cont({x}, 0.99) {CS}) END"
ZP = lambda x: f"CASE WHEN stddev_pop({x}) {CS} > 0 THEN ({x} - avg({x}) {CS}) / stddev_pop({x}) {CS} WHEN {x} IS NOT NULL THEN 0 END"
FACTORS_SQL = f"""{BASE_SQL}, c0 AS (SELECT instrument, timestamp, sector, one_step_return, ret_2, value, -trend AS trend, volume FROM base),
c1 AS (SELECT * REPLACE ({CLIP("value")} AS value, {CLIP("trend")} AS trend) FROM c0), c2 AS (SELECT * REPLACE ({ZP("value")} AS value, {ZP("trend")} AS trend) FROM c1)"""


@query("co_preprocess", f"WITH {FACTORS_SQL} SELECT instrument, timestamp, round(value, 6) AS value, round(trend, 6) AS trend FROM c2")
def co_preprocess(spark, d):
    return rounded(_factors(spark, d).select("instrument", "timestamp", "value", "trend"), "value", "trend")


@query("co_group_demean", f"WITH {FACTORS_SQL} SELECT instrument, timestamp, round(value - avg(value) OVER (PARTITION BY timestamp, sector), 6) AS value FROM c2")
def co_group_demean(spark, d):
    return rounded(composite.group_demean(_factors(spark, d), ["value"], "sector").select("instrument", "timestamp", "value"), "value")


@query("co_neutralize_ols")
def co_neutralize_ols(spark, d):
    return composite.neutralize_ols(_factors(spark, d), ["value"], ["trend", "sector"]).select("instrument", "timestamp", "value")


@query("co_orthogonalize_sequential", f"WITH {FACTORS_SQL}, s AS (SELECT *, CASE WHEN value IS NOT NULL THEN trend END AS y, CASE WHEN trend IS NOT NULL THEN value END AS x FROM c2) SELECT instrument, timestamp, round(value, 6) AS value, round(CASE WHEN count(y) {CS} > 1 THEN y - coalesce(sum(x * y) {CS} / nullif(sum(x * x) {CS}, 0), 0) * x END, 6) AS trend FROM s")
def co_orthogonalize_sequential(spark, d):
    return rounded(composite.orthogonalize_sequential(_factors(spark, d), ["value", "trend"]).select("instrument", "timestamp", "value", "trend"), "value", "trend")


@query("co_orthogonalize_symmetric")
def co_orthogonalize_symmetric(spark, d):
    return composite.orthogonalize_symmetric(_factors(spark, d), ["value", "trend"], 0.1).select("instrument", "timestamp", "value", "trend")


WEIGHT_SQL = f"""{FACTORS_SQL}, icv AS (SELECT timestamp, CASE WHEN count(*) >= 2 THEN covar_pop(value, ret_2) / nullif(stddev_pop(value) * stddev_pop(ret_2), 0) END AS a FROM c2 WHERE value IS NOT NULL AND ret_2 IS NOT NULL GROUP BY 1),
ict AS (SELECT timestamp, CASE WHEN count(*) >= 2 THEN covar_pop(trend, ret_2) / nullif(stddev_pop(trend) * stddev_pop(ret_2), 0) END AS b FROM c2 WHERE trend IS NOT NULL AND ret_2 IS NOT NULL GROUP BY 1),
wd AS (SELECT DISTINCT timestamp FROM c2), wj AS (SELECT timestamp, a, b FROM wd LEFT JOIN icv USING (timestamp) LEFT JOIN ict USING (timestamp)),
wm AS (SELECT timestamp, avg(a) OVER x AS a, avg(b) OVER x AS b, count(*) OVER x AS n FROM wj WINDOW x AS (ORDER BY timestamp ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
wz AS (SELECT timestamp, a, b, n, coalesce(abs(a), 0) + coalesce(abs(b), 0) AS s FROM wm),
wt AS (SELECT timestamp, CASE WHEN n >= 5 AND s > 1e-12 THEN coalesce(a, 0) / s ELSE 0.5 END AS value, CASE WHEN n >= 5 AND s > 1e-12 THEN coalesce(b, 0) / s ELSE 0.5 END AS trend FROM wz)"""


def _weights(f):
    return composite.ic_weights(f, ["value", "trend"], "ret_2", lookback=20, min_history=5)


@query("co_ic_weights", f"WITH {WEIGHT_SQL} SELECT timestamp, round(value, 6) AS value, round(trend, 6) AS trend FROM wt")
def co_ic_weights(spark, d):
    return rounded(_weights(_factors(spark, d)), "value", "trend")


def _signal(spark, d, f=None):
    f = _factors(spark, d) if f is None else f
    return composite.compose(f, ["value", "trend"], composite.constant_weights(f, ["value", "trend"], {"value": 3, "trend": 1}), long_top=5, short_bottom=5)


SIGNAL_SQL = f"""{FACTORS_SQL}, g0 AS (SELECT instrument, timestamp, coalesce(value, 0) * 0.75 + coalesce(trend, 0) * 0.25 AS s FROM c2),
g1 AS (SELECT *, rank() OVER (PARTITION BY timestamp ORDER BY s DESC) + (count(*) OVER (PARTITION BY timestamp, s) - 1) / 2.0 AS rank,
  row_number() OVER (PARTITION BY timestamp ORDER BY s DESC, instrument) <= 5 AS lg, row_number() OVER (PARTITION BY timestamp ORDER BY s, instrument) <= 5 AS sh FROM g0),
sig AS (SELECT instrument, timestamp, s AS composite_score, rank, lg OR sh AS selected_flag, CASE WHEN sh THEN 'SHORT' WHEN lg THEN 'LONG' ELSE 'NONE' END AS side FROM g1)"""


@query("co_signal", f"WITH {SIGNAL_SQL} SELECT instrument, timestamp, round(composite_score, 6) AS composite_score, rank, selected_flag, side FROM sig")
def co_signal(spark, d):
    return rounded(_signal(spark, d), "composite_score")


# portfolio
def _holdings(spark, d, f=None):
    return portfolio.allocate(_signal(spark, d, f), gross=1.0)


HOLD_SQL = f"""{SIGNAL_SQL}, h0 AS (SELECT *, greatest(abs(composite_score), 1e-12) AS p FROM sig WHERE selected_flag),
h1 AS (SELECT instrument, timestamp, p / sum(p) OVER (PARTITION BY timestamp, side) * CASE WHEN side = 'LONG' THEN 0.5 ELSE -0.5 END AS w FROM h0),
hold AS (SELECT instrument, timestamp, w / nullif(sum(abs(w)) OVER (PARTITION BY timestamp), 0) AS weight FROM h1)"""


@query("pf_holdings", f"WITH {HOLD_SQL} SELECT instrument, timestamp, round(weight, 6) AS weight FROM hold")
def pf_holdings(spark, d):
    return rounded(_holdings(spark, d), "weight")


@query("pf_exposures", f"WITH {HOLD_SQL} SELECT timestamp, count(CASE WHEN weight <> 0 THEN 1 END) AS holdings_count, round(sum(greatest(weight, 0)), 6) AS long_exposure, round(sum(greatest(-weight, 0)), 6) AS short_exposure, round(sum(weight), 6) + 0.0 AS net_exposure, round(sum(abs(weight)), 6) AS gross_exposure FROM hold GROUP BY 1")
def pf_exposures(spark, d):
    out = rounded(portfolio.exposures(_holdings(spark, d)), "long_exposure", "short_exposure", "net_exposure", "gross_exposure")
    return out.withColumn("net_exposure", F.col("net_exposure") + 0.0)


BT_SQL = f"""{HOLD_SQL}, hd AS (SELECT timestamp, lead(timestamp) OVER (ORDER BY timestamp) AS nx FROM (SELECT DISTINCT timestamp FROM hold)),
wx AS (SELECT nx AS timestamp, instrument, weight FROM hold JOIN hd USING (timestamp) WHERE nx IS NOT NULL),
pr AS (SELECT instrument, timestamp, open AS price FROM q WHERE open IS NOT NULL), pd AS (SELECT timestamp, lead(timestamp) OVER (ORDER BY timestamp) AS nx FROM (SELECT DISTINCT timestamp FROM pr)),
rt AS (SELECT a.instrument, a.timestamp, b.price / nullif(a.price, 0) - 1 AS ret FROM pr a JOIN pd USING (timestamp) LEFT JOIN pr b ON b.instrument = a.instrument AND b.timestamp = pd.nx),
cal AS (SELECT timestamp, lag(timestamp) OVER (ORDER BY timestamp) AS pv FROM (SELECT DISTINCT timestamp FROM hold UNION SELECT DISTINCT timestamp FROM pr)),
g AS (SELECT timestamp, sum(weight * coalesce(ret, 0)) AS gr, count(CASE WHEN weight <> 0 THEN 1 END) AS holding_cells, count(CASE WHEN weight <> 0 AND ret IS NOT NULL THEN 1 END) AS valid_holding_cells FROM wx LEFT JOIN rt USING (instrument, timestamp) GROUP BY 1),
keys AS (SELECT DISTINCT instrument FROM wx), tn AS (SELECT cal.timestamp, sum(abs(coalesce(a.weight, 0) - coalesce(b.weight, 0))) AS turnover FROM cal CROSS JOIN keys
  LEFT JOIN wx a ON a.timestamp = cal.timestamp AND a.instrument = keys.instrument LEFT JOIN wx b ON b.timestamp = cal.pv AND b.instrument = keys.instrument GROUP BY 1),
bt0 AS (SELECT timestamp, coalesce(gr, 0) AS gross_return, turnover, coalesce(gr, 0) - turnover * 0.0005 AS net_return, coalesce(holding_cells, 0) AS holding_cells, coalesce(valid_holding_cells, 0) AS valid_holding_cells FROM cal LEFT JOIN g USING (timestamp) LEFT JOIN tn USING (timestamp)),
bt1 AS (SELECT *, product(1 + net_return) OVER (ORDER BY timestamp) AS nav_net FROM bt0), bt AS (SELECT *, nav_net / max(nav_net) OVER (ORDER BY timestamp) - 1 AS drawdown_net FROM bt1)"""


def _backtest(spark, d):
    prices = daily_panel(spark, d).select("timestamp", "instrument", F.col("open").alias("price"))
    return portfolio.backtest(_holdings(spark, d), prices)


@query("pf_backtest", f"WITH {BT_SQL} SELECT timestamp, round(gross_return, 6) AS gross_return, round(turnover, 6) AS turnover, round(net_return, 6) AS net_return, holding_cells, valid_holding_cells, round(nav_net, 6) AS nav_net, round(drawdown_net, 6) AS drawdown_net FROM bt")
def pf_backtest(spark, d):
    out = _backtest(spark, d).select("timestamp", "gross_return", "turnover", "net_return", "holding_cells", "valid_holding_cells", "nav_net", "drawdown_net")
    return rounded(out, "gross_return", "turnover", "net_return", "nav_net", "drawdown_net")


def _net_returns(spark, d):
    """Every known net return, however large; a record delivered again counts once."""
    r = read_table(spark, d, "backtest_returns").select(trimmed("strategy_id").alias("strategy_id"), "trade_date", finite("net_return").alias("net_return"))
    return r.dropna(subset=["strategy_id", "net_return"]).distinct()


def _strategy_days(spark, d):
    """All that is known of each strategy's days with a net return; a record delivered again counts once."""
    names = ["net_return", "gross_return", *portfolio.BACKTEST_COLUMNS]
    r = read_table(spark, d, "backtest_returns").select(trimmed("strategy_id").alias("strategy_id"), "trade_date", *[finite(c).alias(c) for c in names])
    return r.dropna(subset=["strategy_id", "net_return"]).groupBy("strategy_id", "trade_date", "net_return").agg(*[F.max(c).alias(c) for c in names[1:]])


_SR = "sr AS (SELECT DISTINCT strategy_id, CAST(trade_date AS DATE) AS dt, net_return AS r FROM backtest_returns WHERE isfinite(net_return) AND strategy_id IS NOT NULL)"
_STREAK = lambda f, n: f"(SELECT strategy_id, max(CASE WHEN f THEN n ELSE 0 END) AS {n} FROM (SELECT strategy_id, f, isl, count(*) AS n FROM (SELECT strategy_id, {f} AS f, row_number() OVER (PARTITION BY strategy_id ORDER BY dt, r) - row_number() OVER (PARTITION BY strategy_id, {f} ORDER BY dt, r) AS isl FROM m2) GROUP BY 1, 2, 3) GROUP BY 1)"
METRIC_SQL = f"""WITH {_SR}, m1 AS (SELECT *, product(1 + r) OVER w AS nav, row_number() OVER w AS i, quantile_cont(r, 0.05) OVER (PARTITION BY strategy_id) AS va, row_number() OVER (PARTITION BY strategy_id ORDER BY r DESC, dt) AS tp FROM sr WINDOW w AS (PARTITION BY strategy_id ORDER BY dt, r)),
m2 AS (SELECT *, nav / max(nav) OVER (PARTITION BY strategy_id ORDER BY dt, r) - 1 AS dd FROM m1),
m3 AS (SELECT strategy_id, count(*) AS trade_days, arg_max(nav, i) AS nv, avg(r) AS m, stddev_samp(r) AS sd, stddev_samp(r) FILTER (WHERE r < 0) AS sl, min(dd) AS max_drawdown, avg(CASE WHEN r > 0 THEN 1.0 ELSE 0.0 END) AS daily_win_rate, median(r) AS median_daily_return,
  max(r) AS best_day, min(r) AS worst_day, max(va) AS var_95, avg(r) FILTER (WHERE r <= va) AS cvar_95, avg(r) FILTER (WHERE r > 0) AS aw, avg(r) FILTER (WHERE r < 0) AS al, sum(r) FILTER (WHERE tp <= 5) AS t5, sum(r) FILTER (WHERE r > 0) AS ps FROM m2 GROUP BY 1),
wk AS (SELECT strategy_id, avg(CASE WHEN x > 1 THEN 1.0 ELSE 0.0 END) AS weekly_win_rate FROM (SELECT strategy_id, date_trunc('week', dt) AS p, product(1 + r) AS x FROM sr GROUP BY 1, 2) GROUP BY 1),
mo AS (SELECT strategy_id, avg(CASE WHEN x > 1 THEN 1.0 ELSE 0.0 END) AS monthly_win_rate FROM (SELECT strategy_id, date_trunc('month', dt) AS p, product(1 + r) AS x FROM sr GROUP BY 1, 2) GROUP BY 1)
SELECT strategy_id, trade_days, round(nv - 1, 6) AS total_return, round(CASE WHEN nv > 0 THEN pow(nv, 252.0 / trade_days) END - 1, 6) AS annual_return, round(sd * sqrt(252), 6) AS annual_volatility, round(m / nullif(sd, 0) * sqrt(252), 6) AS sharpe, round(m / nullif(sl, 0) * sqrt(252), 6) AS sortino,
  round(max_drawdown, 6) AS max_drawdown, round(daily_win_rate, 6) AS daily_win_rate, round(m, 6) AS avg_daily_return, round(median_daily_return, 6) AS median_daily_return, round(best_day, 6) AS best_day, round(worst_day, 6) AS worst_day, round(sl * sqrt(252), 6) AS downside_volatility,
  round(var_95, 6) AS var_95, round(cvar_95, 6) AS cvar_95, round(aw / nullif(abs(al), 0), 6) AS profit_loss_ratio, round(t5 / nullif(ps, 0), 6) AS top5_day_pnl_contribution, round((CASE WHEN nv > 0 THEN pow(nv, 252.0 / trade_days) END - 1) / nullif(abs(max_drawdown), 0), 6) AS calmar,
  max_drawdown_duration, longest_win_streak, longest_loss_streak, round(weekly_win_rate, 6) AS weekly_win_rate, round(monthly_win_rate, 6) AS monthly_win_rate
FROM m3 JOIN wk USING (strategy_id) JOIN mo USING (strategy_id) JOIN {_STREAK("dd < 0", "max_drawdown_duration")} a USING (strategy_id) JOIN {_STREAK("r > 0", "longest_win_streak")} b USING (strategy_id) JOIN {_STREAK("r < 0", "longest_loss_streak")} c USING (strategy_id)"""


WHOLE = {"strategy_id", "trade_days", "max_drawdown_duration", "longest_win_streak", "longest_loss_streak"}
_MAXES = ", ".join(f"max(CASE WHEN isfinite({c}) THEN {c} END) AS {c}" for c in ["gross_return", *portfolio.BACKTEST_COLUMNS])
FULL_SQL = f"""WITH fd AS (SELECT strategy_id, CAST(trade_date AS DATE) AS dt, net_return AS r, {_MAXES} FROM backtest_returns WHERE isfinite(net_return) AND strategy_id IS NOT NULL GROUP BY ALL),
f1 AS (SELECT *, coalesce(gross_return, 0) AS g, product(1 + coalesce(gross_return, 0)) OVER w AS gnav, product(1 + r) OVER w AS nav, row_number() OVER w AS i FROM fd WINDOW w AS (PARTITION BY strategy_id ORDER BY dt, r)),
f2 AS (SELECT *, gnav / max(gnav) OVER (PARTITION BY strategy_id ORDER BY i) - 1 AS gdd FROM f1),
f3 AS (SELECT strategy_id, round(arg_max(gnav, i) - 1, 6) AS gross_total_return, round(CASE WHEN arg_max(gnav, i) > 0 THEN pow(arg_max(gnav, i), 252.0 / count(*)) - 1 END, 6) AS gross_annual_return, round(stddev_samp(g) * sqrt(252), 6) AS gross_annual_volatility,
  round(avg(g) * sqrt(252) / nullif(stddev_samp(g), 0), 6) AS gross_sharpe, round(min(gdd), 6) AS gross_max_drawdown, round(avg(turnover), 6) AS avg_turnover, round(median(turnover), 6) AS median_turnover, round(max(turnover), 6) AS max_turnover, round(avg(holdings_count), 6) AS avg_holding_count,
  round(avg(long_exposure), 6) AS avg_long_exposure, round(avg(short_exposure), 6) AS avg_short_exposure, round(avg(net_exposure), 6) AS avg_net_exposure, round(avg(gross_exposure), 6) AS avg_gross_exposure, round(sum(trading_cost), 6) AS total_trading_cost,
  round(arg_max(gnav, i) - arg_max(nav, i), 6) AS cost_drag, round(sum(valid_holding_cells) / nullif(sum(holding_cells), 0), 6) AS effective_asset_return_ratio, round(avg(asset_return_coverage), 6) AS avg_daily_asset_return_coverage FROM f2 GROUP BY 1)
SELECT * FROM ({METRIC_SQL}) JOIN f3 USING (strategy_id)"""


@query("pf_metrics", FULL_SQL)
def pf_metrics(spark, d):
    """All 40 figures, over every day with a net return."""
    out = portfolio.metrics(_strategy_days(spark, d), ["strategy_id"], order="trade_date", gross="gross_return")
    return rounded(out, *[c for c in out.columns if c not in WHOLE])


@query("pf_metrics_net", METRIC_SQL)
def pf_metrics_net(spark, d):
    out = portfolio.metrics(_net_returns(spark, d), ["strategy_id"], order="trade_date")
    return rounded(out, *[c for c in out.columns if c not in WHOLE])


_BENCH = f"""{_SR}, bm AS (SELECT dt, max(r) AS b FROM sr WHERE strategy_id = (SELECT min(strategy_id) FROM sr) GROUP BY 1), x AS (SELECT strategy_id, dt, r, coalesce(b, 0) AS b FROM sr LEFT JOIN bm USING (dt)),
bx AS (SELECT strategy_id, count(*) AS n, product(1 + b) AS bn, product(1 + r - b) AS xn, stddev_samp(r - b) AS sx, avg(r - b) AS mx, CASE WHEN count(*) > 2 AND var_samp(b) >= 1e-12 THEN covar_samp(r, b) / var_samp(b) END AS beta, avg(r) AS mr, avg(b) AS mb FROM x GROUP BY 1)"""


@query("pf_benchmark", f"""WITH {_BENCH} SELECT strategy_id, round(bn - 1, 6) AS benchmark_total_return, round(xn - 1, 6) AS excess_total_return, round(CASE WHEN xn > 0 THEN pow(xn, 252.0 / n) - 1 END, 6) AS excess_annual_return, round(sx * sqrt(252), 6) AS tracking_error,
  round(CASE WHEN sx * sqrt(252) > 1e-12 AND xn > 0 THEN (pow(xn, 252.0 / n) - 1) / (sx * sqrt(252)) END, 6) AS information_ratio, round(CASE WHEN sx >= 1e-12 THEN mx / sx * sqrt(252) END, 6) AS excess_sharpe, round(beta, 6) AS beta, round((mr - beta * mb) * 252, 6) AS alpha FROM bx""")
def pf_benchmark(spark, d):
    """All 8 figures against the first strategy, over every net return."""
    r = _net_returns(spark, d)
    first = r.agg(F.min("strategy_id").alias("strategy_id"))
    bench = r.join(F.broadcast(first), "strategy_id").select("trade_date", F.col("net_return").alias("benchmark_return"))  # one strategy
    out = portfolio.against_benchmark(r, bench, ["strategy_id"], order="trade_date")
    return rounded(out, *[c for c in out.columns if c != "strategy_id"])


# risk
def _risk_input(f):
    return f.select("timestamp", "instrument", "value", "trend", F.col("one_step_return").alias("ret"), (F.col("open") * F.col("volume")).alias("cap"))


_CLIPPED = lambda x: f"least(greatest({x}, avg({x}) {CS} - 3 * coalesce(stddev_samp({x}) {CS}, 0)), avg({x}) {CS} + 3 * coalesce(stddev_samp({x}) {CS}, 0))"
_STANDARD = lambda x: f"({x} - avg({x}) {CS}) / coalesce(nullif(stddev_samp({x}) {CS}, 0), 1)"
_WLS = f"""rk0 AS (SELECT c2.timestamp, c2.instrument, c2.value AS x1, c2.trend AS x2, c2.one_step_return AS y, q.open * q.volume AS cap FROM c2 JOIN q USING (timestamp, instrument)),
rk1 AS (SELECT * FROM rk0 WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND y IS NOT NULL AND cap > 0 QUALIFY count(*) {CS} >= 5),
rk2 AS (SELECT * REPLACE ({_CLIPPED("x1")} AS x1, {_CLIPPED("x2")} AS x2) FROM rk1), rk3 AS (SELECT * REPLACE ({_STANDARD("x1")} AS x1, {_STANDARD("x2")} AS x2), sqrt(cap) AS w FROM rk2),
rk4 AS (SELECT timestamp, sum(w * x1 * x1) AS a, sum(w * x1 * x2) AS b, sum(w * x2 * x2) AS c, sum(w * x1 * y) AS u, sum(w * x2 * y) AS v FROM rk3 GROUP BY 1),
rk5 AS (SELECT timestamp, (c * u - b * v) / (a * c - b * b) AS f_value, (a * v - b * u) / (a * c - b * b) AS f_trend FROM rk4),
fitted AS (SELECT timestamp, instrument, y - x1 * f_value - x2 * f_trend AS residual, f_value, f_trend FROM rk3 JOIN rk5 USING (timestamp))"""
WLS_SQL = f"{FACTORS_SQL}, {_WLS}"


def _fitted(spark, d):
    return risk.cross_sectional_wls(_risk_input(_factors(spark, d)), ["value", "trend"], least=5)


@query("rk_wls", f"WITH {WLS_SQL} SELECT timestamp, instrument, round(residual, 6) + 0.0 AS residual, round(f_value, 6) + 0.0 AS f_value, round(f_trend, 6) + 0.0 AS f_trend FROM fitted")
def rk_wls(spark, d):
    return rounded(_fitted(spark, d), "residual", "f_value", "f_trend")


_SPECIFIC = """sp AS (SELECT instrument, timestamp, stddev_samp(residual) OVER (PARTITION BY instrument ORDER BY timestamp) AS sd FROM fitted),
last_day AS (SELECT instrument, sd FROM sp WHERE timestamp = (SELECT max(timestamp) FROM sp)), spec AS (SELECT instrument, pow(coalesce(sd, (SELECT median(sd) FROM last_day), 0), 2) AS specific_var FROM last_day)"""


@query("rk_specific_risk", f"WITH {WLS_SQL}, {_SPECIFIC} SELECT instrument, round(specific_var, 9) + 0.0 AS specific_var FROM spec")
def rk_specific_risk(spark, d):
    return rounded(risk.specific_risk(_fitted(spark, d)), "specific_var", digits=9)


@query("rk_market_cap", f"WITH {PANEL_SQL}, {_AGG_DAYS}, a AS (SELECT instrument, timestamp, agg_volume FROM ad WHERE instrument <> '') SELECT p.instrument, p.timestamp, round(p.open * agg_volume, 4) + 0.0 AS cap FROM p ASOF LEFT JOIN a ON p.instrument = a.instrument AND p.timestamp >= a.timestamp")
def rk_market_cap(spark, d):
    prices = daily_panel(spark, d).select("timestamp", "instrument", F.col("open").alias("price"))
    out = risk.market_cap(prices, _agg_panel(spark, d).withColumnRenamed("volume", "free_float"))
    return out.select("instrument", "timestamp", F.round("cap", 4).alias("cap"))


def _model(spark, d):
    """The prepared factors, the fitted regressions and the factors' covariance; the first two are kept for reuse."""
    f = cut_lineage(_factors(spark, d))
    fitted = cut_lineage(risk.cross_sectional_wls(_risk_input(f), ["value", "trend"], least=5))
    return f, fitted, risk.factor_covariance(fitted)[1]


TOTAL_SQL = f"""{HOLD_SQL}, {_WLS}, {_SPECIFIC}, fr AS (SELECT timestamp, max(f_value) AS a, max(f_trend) AS b FROM fitted GROUP BY 1),
fw AS (SELECT *, pow(0.5, (count(*) OVER () - row_number() OVER (ORDER BY timestamp)) / 63.0) AS w0 FROM fr), fn AS (SELECT *, w0 / sum(w0) OVER () AS w FROM fw),
fx AS (SELECT timestamp, (a - sum(w * a) OVER ()) * sqrt(w) AS a, (b - sum(w * b) OVER ()) * sqrt(w) AS b FROM fn),
fl AS (SELECT a, b, lag(a, 1) OVER o AS a1, lag(b, 1) OVER o AS b1, lag(a, 2) OVER o AS a2, lag(b, 2) OVER o AS b2 FROM fx WINDOW o AS (ORDER BY timestamp)),
cv AS (SELECT sum(a * a) + 4 / 3.0 * sum(a * a1) + 2 / 3.0 * sum(a * a2) AS aa, sum(b * b) + 4 / 3.0 * sum(b * b1) + 2 / 3.0 * sum(b * b2) AS bb, sum(a * b) + 2 / 3.0 * (sum(a * b1) + sum(b * a1)) + 1 / 3.0 * (sum(a * b2) + sum(b * a2)) AS ab FROM fl),
tr0 AS (SELECT hold.timestamp, weight, coalesce(c2.value, 0) AS x, coalesce(c2.trend, 0) AS z, coalesce(specific_var, median(specific_var) OVER (PARTITION BY hold.timestamp), 0) AS sv
  FROM hold LEFT JOIN c2 ON c2.timestamp = hold.timestamp AND c2.instrument = hold.instrument LEFT JOIN spec ON spec.instrument = hold.instrument),
tr1 AS (SELECT timestamp, sum(weight * x) AS x, sum(weight * z) AS z, sum(weight * weight * sv) AS specific_var FROM tr0 GROUP BY 1),
tr2 AS (SELECT timestamp, x * x * aa + 2 * x * z * ab + z * z * bb AS factor_var, specific_var FROM tr1, cv)"""


@query("rk_total_risk", f"WITH {TOTAL_SQL} SELECT timestamp, round(factor_var, 9) + 0.0 AS factor_var, round(specific_var, 9) + 0.0 AS specific_var, round(sqrt((factor_var + specific_var) * 252), 6) + 0.0 AS annual_risk FROM tr2")
def rk_total_risk(spark, d):
    f, fitted, cov = _model(spark, d)
    out = risk.total_risk(_holdings(spark, d, f), f.select("timestamp", "instrument", "value", "trend"), ["value", "trend"], cov, risk.specific_risk(fitted))
    return rounded(rounded(out, "annual_risk"), "factor_var", "specific_var", digits=9)


@query("rk_optimize")
def rk_optimize(spark, d):
    f, fitted, cov = _model(spark, d)
    picks = _signal(spark, d, f).filter("selected_flag").join(f.select("timestamp", "instrument", "value", "trend"), ["timestamp", "instrument"])
    df = picks.join(risk.specific_risk(fitted), "instrument", "left").withColumn("alpha", F.col("composite_score") / 100).na.fill(1e-4, ["specific_var"])
    return risk.optimize(df, ["value", "trend"], cov, aversion=5.0, cap=0.2)


# intraday, over the events as ticks of their type
def _ticks(spark, d):
    e = read_table(spark, d, "events")
    return panel(e, F.col("ts"), F.col("event_type"), {"close": F.col("value"), "average": F.col("value"), "volume": F.lit(1.0) + F.col("event_id") % 7})


TICKS = """t0 AS (SELECT event_type AS instrument, ts AS timestamp, value AS close, 1.0 + event_id % 7 AS volume FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL),
tk AS (SELECT *, CAST(timestamp AS DATE) AS date FROM (SELECT *, row_number() OVER (PARTITION BY instrument, timestamp ORDER BY close DESC NULLS LAST, volume DESC) AS k FROM t0) WHERE k = 1)"""
_DAY = "OVER (PARTITION BY instrument, date ORDER BY timestamp)"
VWAP_SQL = f"{TICKS}, vw AS (SELECT *, sum(close * volume) {_DAY} / nullif(sum(volume) {_DAY}, 0) AS cum_vwap, row_number() {_DAY} AS k2 FROM tk), vf AS (SELECT * EXCLUDE (k, k2), CASE WHEN k2 > 5 THEN -((close - cum_vwap) / nullif(cum_vwap, 0)) END AS factor FROM vw)"


@query("in_vwap_reversion", f"WITH {VWAP_SQL} SELECT instrument, timestamp, round(cum_vwap, 6) AS cum_vwap, round(factor, 6) AS factor FROM vf")
def in_vwap_reversion(spark, d):
    return rounded(minute.vwap_reversion(_ticks(spark, d)).select("instrument", "timestamp", "cum_vwap", "factor"), "cum_vwap", "factor")


_IW = "OVER (PARTITION BY instrument ORDER BY timestamp)"
_IW2 = "OVER (PARTITION BY tk.instrument ORDER BY tk.timestamp)"
_R20 = "OVER (PARTITION BY instrument ORDER BY timestamp ROWS 19 PRECEDING)"
PREP_SQL = f"""{VWAP_SQL}, pp0 AS (SELECT *, CASE WHEN count(factor) {_R20} >= 20 THEN (factor - avg(factor) {_R20}) / nullif(stddev_pop(factor) {_R20}, 0) END AS factor_z, lead(close, 4) {_IW} / nullif(lead(close) {_IW}, 0) - 1 AS target_ret,
  row_number() {_DAY} - 1 < count(*) OVER (PARTITION BY instrument, date) - 3 AS ok FROM vf),
pp1 AS (SELECT *, CASE WHEN ok THEN factor_z END AS fe, CASE WHEN ok THEN target_ret END AS target_eval FROM pp0),
pp AS (SELECT *, CASE WHEN fe IS NOT NULL THEN least(greatest(fe, quantile_cont(fe, 0.01) OVER (PARTITION BY instrument, date)), quantile_cont(fe, 0.99) OVER (PARTITION BY instrument, date)) END AS factor_eval FROM pp1)"""


def _prepared(spark, d):
    return minute.prepare(minute.vwap_reversion(_ticks(spark, d)), "factor", "close", horizon=3, z_window=20)


@query("in_prepare", f"WITH {PREP_SQL} SELECT instrument, timestamp, round(factor_eval, 6) AS factor_eval, round(target_eval, 6) AS target_eval FROM pp")
def in_prepare(spark, d):
    return rounded(_prepared(spark, d).select("instrument", "timestamp", "factor_eval", "target_eval"), "factor_eval", "target_eval")


@query("in_session_label", f"WITH {TICKS}, s AS (SELECT instrument, timestamp, hour(timestamp) * 100 + minute(timestamp) AS t FROM tk) SELECT instrument, timestamp, CASE WHEN t >= 930 AND t < 1000 THEN 'OPEN' WHEN t >= 1000 AND t < 1530 THEN 'MID' WHEN t >= 1530 AND t < 1600 THEN 'CLOSE' ELSE 'OFF' END AS label FROM s")
def in_session_label(spark, d):
    return _ticks(spark, d).select("instrument", "timestamp", minute.session_label(F.col("timestamp")).alias("label"))


def _grouped(spark, d):
    return minute.layer_groups(_prepared(spark, d), "factor_eval", 5, 100)


GROUP_SQL = f"""{PREP_SQL}, kn AS (SELECT instrument, timestamp, target_eval, factor_eval, list(factor_eval) OVER (PARTITION BY instrument ORDER BY timestamp ROWS 99 PRECEDING) AS a FROM pp WHERE factor_eval IS NOT NULL),
gr AS (SELECT instrument, timestamp, target_eval, CASE WHEN len(a) = 100 THEN CAST(greatest(least(ceil((len(list_filter(a, lambda v: v < factor_eval)) + 1 + len(list_filter(a, lambda v: v <= factor_eval))) / 2.0 / 100 * 5), 5), 1) AS INT) END AS g FROM kn)"""


@query("in_layered_returns", f"WITH {GROUP_SQL} SELECT instrument, g AS \"group\", round(pow(1 + avg(target_eval), 1.0 / 3) - 1, 6) AS avg_single_period_ret FROM gr WHERE g IS NOT NULL AND target_eval IS NOT NULL GROUP BY 1, 2")
def in_layered_returns(spark, d):
    return rounded(minute.layered_returns(_grouped(spark, d), "target_eval", 3), "avg_single_period_ret")


@query("in_daily_ic", f"""WITH {PREP_SQL}, v AS (SELECT instrument, date, factor_eval AS x, target_eval AS y FROM pp WHERE factor_eval IS NOT NULL AND target_eval IS NOT NULL), rk AS (SELECT *, {prank("x", "instrument, date")} AS rx, {prank("y", "instrument, date")} AS ry FROM v)
SELECT instrument, date, round(covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0), 6) AS ic, round(covar_pop(rx, ry) / nullif(stddev_pop(rx) * stddev_pop(ry), 0), 6) AS rank_ic, count(*) AS n FROM rk GROUP BY 1, 2 HAVING count(*) >= 5""")
def in_daily_ic(spark, d):
    return rounded(minute.daily_ic(_prepared(spark, d), "factor_eval", "target_eval", least=5), "ic", "rank_ic")


HOLD_PNL_SQL = f"""{GROUP_SQL}, hz AS (SELECT tk.instrument, tk.timestamp, tk.close, row_number() {_IW2} AS rn, lag(gr.g) {_IW2} AS before FROM tk LEFT JOIN gr ON gr.instrument = tk.instrument AND gr.timestamp = tk.timestamp),
hp AS (SELECT instrument, timestamp, close, rn, 0.0 AS pos, 0 AS left_bars FROM hz WHERE rn = 1 UNION ALL
  SELECT hz.instrument, hz.timestamp, hz.close, hz.rn, CASE WHEN hp.left_bars > 0 THEN hp.pos WHEN hz.before = 5 THEN 1.0 WHEN hz.before = 1 THEN -1.0 ELSE 0.0 END, CASE WHEN hp.left_bars > 0 THEN hp.left_bars - 1 WHEN hz.before IN (1, 5) THEN 2 ELSE 0 END
  FROM hp JOIN hz ON hz.instrument = hp.instrument AND hz.rn = hp.rn + 1)"""


@query("in_holding_pnl", f"WITH RECURSIVE {HOLD_PNL_SQL} SELECT instrument, timestamp, pos AS net_position, round(coalesce(pos * (lead(close) {_IW} / nullif(close, 0) - 1), 0) - abs(pos - coalesce(lag(pos) {_IW}, 0)) * 0.0001, 6) AS pnl FROM hp")
def in_holding_pnl(spark, d):
    return rounded(minute.holding_pnl(_grouped(spark, d), "close", 5, 3, 0.0001).select("instrument", "timestamp", "net_position", "pnl"), "pnl")


REGIME_SQL = f"""{TICKS}, rg0 AS (SELECT instrument, timestamp, CASE WHEN close / nullif(lag(close) {_IW}, 0) > 0 THEN ln(close / nullif(lag(close) {_IW}, 0)) END AS lr FROM tk),
rg1 AS (SELECT instrument, timestamp, CASE WHEN count(lr) {_R20} >= 20 THEN stddev_samp(lr) {_R20} END AS vol FROM rg0),
rg2 AS (SELECT instrument, timestamp, vol, list(vol) OVER (PARTITION BY instrument ORDER BY timestamp ROWS 199 PRECEDING) AS a FROM rg1 WHERE vol IS NOT NULL),
rg3 AS (SELECT instrument, timestamp, CASE WHEN len(a) = 200 THEN (len(list_filter(a, lambda v: v < vol)) + 1 + len(list_filter(a, lambda v: v <= vol))) / 2.0 / 200 END AS p FROM rg2)"""


@query("in_volatility_regime", f"WITH {REGIME_SQL} SELECT tk.instrument, tk.timestamp, CASE WHEN p < 1 / 3.0 THEN 'LV' WHEN p >= 2 / 3.0 THEN 'HV' WHEN p IS NOT NULL THEN 'MV' END AS regime FROM tk LEFT JOIN rg3 USING (instrument, timestamp)")
def in_volatility_regime(spark, d):
    return minute.volatility_regime(_ticks(spark, d), "close", 20, 200).select("instrument", "timestamp", "regime")


@query("in_downsample", f"WITH {VWAP_SQL} SELECT instrument, date, sum(volume) AS volume, arg_max(close, CASE WHEN close IS NOT NULL THEN timestamp END) AS close, round(avg(factor), 6) AS factor FROM vf GROUP BY 1, 2")
def in_downsample(spark, d):
    return rounded(minute.downsample(minute.vwap_reversion(_ticks(spark, d)), ["volume"], ["close"], ["factor"]), "factor")


# single assets
def _bars(spark, d):
    return daily_panel(spark, d).withColumn("price", F.col("open"))


_SQUASH = lambda x, d: f"CASE WHEN {d} IS NOT NULL THEN tanh({x} / greatest({d}, 1e-8)) END"
MA_SQL = f"""s0 AS (SELECT instrument, timestamp, rn, CASE WHEN count(open) OVER a >= 5 AND count(open) OVER b >= 20 THEN (avg(open) OVER a - avg(open) OVER b) / nullif(avg(open) OVER b, 0) END AS g FROM q
  WINDOW a AS (PARTITION BY instrument ORDER BY timestamp ROWS 4 PRECEDING), b AS (PARTITION BY instrument ORDER BY timestamp ROWS 19 PRECEDING)),
s1 AS (SELECT *, CASE WHEN count(g) OVER c >= 20 THEN stddev_samp(g) OVER c END AS sd FROM s0 WINDOW c AS (PARTITION BY instrument ORDER BY timestamp ROWS 39 PRECEDING)),
ms AS (SELECT instrument, timestamp, rn, {_SQUASH("g", "sd")} AS signal FROM s1)"""


@query("sa_dual_ma", f"WITH {PANEL_SQL}, {MA_SQL} SELECT instrument, timestamp, round(signal, 6) + 0.0 AS signal FROM ms")
def sa_dual_ma(spark, d):
    return rounded(single_asset.dual_ma_signal(_bars(spark, d), price="price"), "signal")


@query("sa_macd_signal", f"""WITH RECURSIVE {PANEL_SQL}, {ema_sql([("f", "open", "(2.0 / 13)"), ("s", "open", "(2.0 / 27)"), ("g", "f - s", "(2.0 / 10)")])}, h AS (SELECT *, f - s - g AS h FROM e),
h1 AS (SELECT *, CASE WHEN count(h) OVER c >= 26 THEN stddev_samp(h) OVER c END AS sd FROM h WINDOW c AS (PARTITION BY instrument ORDER BY timestamp ROWS 51 PRECEDING))
SELECT instrument, timestamp, round({_SQUASH("h", "sd")}, 6) + 0.0 AS signal FROM h1""")
def sa_macd_signal(spark, d):
    return rounded(single_asset.macd_signal(_bars(spark, d), price="price"), "signal")


BOUNDS = {"long_entry": 0.3, "long_exit": 0.1, "short_entry": -0.3, "short_exit": -0.1}


def _positions(spark, d):
    return single_asset.threshold_positions(single_asset.dual_ma_signal(_bars(spark, d), price="price"), **BOUNDS, short=True)


RSI_SQL = f"""{PANEL_SQL}, {ema_sql([("ag", "gain", "(1.0 / 14)"), ("al", "loss", "(1.0 / 14)")], f", CASE WHEN rn > 1 THEN greatest(open - lag(open) {W}, 0) + 0 * (open - lag(open) {W}) END AS gain, CASE WHEN rn > 1 THEN greatest(lag(open) {W} - open, 0) + 0 * (open - lag(open) {W}) END AS loss")},
st AS (SELECT instrument, timestamp, count(step) {ALL} AS n FROM (SELECT instrument, timestamp, open - lag(open) {W} AS step FROM q)),
rs AS (SELECT e.instrument, e.timestamp, CASE WHEN n >= 14 THEN tanh(-(100 - 100 / (1 + ag / greatest(al, 1e-10)) - 50) / 20) END AS signal FROM e JOIN st USING (instrument, timestamp))"""


def _step(p: str, le: str, lx: str, se: str, sx: str, size: str) -> str:
    """The position after a bar of signal v, p being the one before it."""
    flat = f"CASE WHEN v >= {le} THEN {size} WHEN v <= {se} THEN -{size} ELSE 0.0 END"
    held = f"CASE WHEN v <= {lx} THEN CASE WHEN v <= {se} THEN -{size} ELSE 0.0 END ELSE {size} END"
    owed = f"CASE WHEN v >= {sx} THEN CASE WHEN v >= {le} THEN {size} ELSE 0.0 END ELSE -{size} END"
    return f"CASE WHEN v IS NULL THEN {p} WHEN {p} = 0 THEN {flat} WHEN {p} > 0 THEN {held} ELSE {owed} END"


def _machine_sql(table: str, *bounds: str) -> str:
    """CTEs fsm and tp over table (instrument, timestamp, rn, v and what bounds name)."""
    first, step = _step("0.0", *bounds), _step("fsm.p", *[x if x[-1].isdigit() else f"m.{x}" for x in bounds])
    return f"""fsm AS (SELECT instrument, timestamp, rn, v, CAST({first} AS DOUBLE) AS p FROM {table} WHERE rn = 1 UNION ALL
  SELECT m.instrument, m.timestamp, m.rn, m.v, CAST({step.replace("v IS", "m.v IS").replace("WHEN v ", "WHEN m.v ")} AS DOUBLE) FROM fsm JOIN {table} m ON m.instrument = fsm.instrument AND m.rn = fsm.rn + 1),
tp AS (SELECT instrument, timestamp, rn, coalesce(lag(v) {W}, 0) AS signal, coalesce(lag(p) {W}, 0) AS target_position,
  CASE WHEN p > 0 AND coalesce(lag(p) {W}, 0) <= 0 THEN 'ENTRY_LONG' WHEN p < 0 AND coalesce(lag(p) {W}, 0) >= 0 THEN 'ENTRY_SHORT' WHEN p = 0 AND lag(p) {W} > 0 THEN 'EXIT_LONG' WHEN p = 0 AND lag(p) {W} < 0 THEN 'EXIT_SHORT' ELSE 'HOLD' END AS action FROM fsm)"""


POSITION_SQL = f"{PANEL_SQL}, {MA_SQL}, mv AS (SELECT *, signal AS v FROM ms), {_machine_sql('mv', '0.3', '0.1', '-0.3', '-0.1', '1.0')}"


@query("sa_rsi_signal", f"WITH RECURSIVE {RSI_SQL} SELECT instrument, timestamp, round(signal, 6) + 0.0 AS signal FROM rs")
def sa_rsi_signal(spark, d):
    return rounded(single_asset.rsi_signal(_bars(spark, d), price="price"), "signal")


_Z60 = lambda x: f"CASE WHEN count({x}) OVER k >= 30 THEN ({x} - avg({x}) OVER k) / greatest(stddev_samp({x}) OVER k, 1e-8) END"


@query("sa_factor_signal", f"WITH {BASE_SQL} SELECT instrument, timestamp, round(tanh({_Z60('value')} / 1.5 - {_Z60('trend')} * 0.5 / 1.5), 6) + 0.0 AS signal FROM b0 WINDOW k AS (PARTITION BY instrument ORDER BY timestamp ROWS 59 PRECEDING)")
def sa_factor_signal(spark, d):
    return rounded(single_asset.factor_signal(bars_with_returns(spark, d), {"value": 1.0, "trend": -0.5}), "signal")


def _two_signals(spark, d):
    b = _bars(spark, d)
    return {"ma": single_asset.dual_ma_signal(b, price="price"), "rsi": single_asset.rsi_signal(b, price="price")}


@query("sa_combined", f"WITH RECURSIVE {RSI_SQL}, {MA_SQL} SELECT ms.instrument, ms.timestamp, round(tanh(coalesce(ms.signal, 0) * 2 / 3.0 + coalesce(rs.signal, 0) / 3.0), 6) + 0.0 AS signal FROM ms JOIN rs USING (instrument, timestamp)")
def sa_combined(spark, d):
    return rounded(single_asset.combine_signals(_two_signals(spark, d), {"ma": 2, "rsi": 1}), "signal")


_PR = lambda x: f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY instrument ORDER BY {x} NULLS LAST) + (count({x}) OVER (PARTITION BY instrument, {x}) - 1) / 2.0) / count({x}) OVER (PARTITION BY instrument) * 2 - 1 END"


@query("sa_rank_average", f"WITH RECURSIVE {RSI_SQL}, {MA_SQL}, b AS (SELECT ms.instrument, ms.timestamp, round(ms.signal, 9) + 0.0 AS m, round(rs.signal, 9) + 0.0 AS x FROM ms JOIN rs USING (instrument, timestamp)) SELECT instrument, timestamp, round(tanh({_PR('m')} * 2 / 3.0 + {_PR('x')} / 3.0), 6) + 0.0 AS signal FROM b")
def sa_rank_average(spark, d):
    signals = {n: rounded(s, "signal", digits=9) for n, s in _two_signals(spark, d).items()}
    return rounded(single_asset.combine_signals(signals, {"ma": 2, "rsi": 1}, "rank_avg"), "signal")


@query("sa_threshold_positions", f"WITH RECURSIVE {POSITION_SQL} SELECT instrument, timestamp, round(signal, 6) + 0.0 AS signal, target_position, action FROM tp")
def sa_threshold_positions(spark, d):
    return rounded(_positions(spark, d), "signal")


ATR_SQL = f"""{PANEL_SQL}, {MA_SQL}, at0 AS (SELECT instrument, timestamp, rn, greatest(high - low, abs(high - lag(close) {W}), abs(low - lag(close) {W})) AS tr, close / nullif(lag(close) {W}, 0) - 1 AS ret FROM q),
at1 AS (SELECT instrument, timestamp, rn, CASE WHEN count(tr) OVER a >= 14 THEN avg(tr) OVER a END AS atr, CASE WHEN count(ret) OVER b >= 14 THEN stddev_samp(ret) OVER b END AS rv FROM at0
  WINDOW a AS (PARTITION BY instrument ORDER BY timestamp ROWS 13 PRECEDING), b AS (PARTITION BY instrument ORDER BY timestamp ROWS 27 PRECEDING)),
at2 AS (SELECT *, CASE WHEN count(atr) OVER c >= 28 THEN quantile_cont(atr, 0.5) OVER c END AS med FROM at1 WINDOW c AS (PARTITION BY instrument ORDER BY timestamp ROWS 139 PRECEDING)),
mv AS (SELECT at2.instrument, at2.timestamp, at2.rn, ms.signal AS v, 0.5 * k AS le, 0.2 * k AS lx, -0.5 * k AS se, -0.2 * k AS sx, CASE WHEN rv IS NULL THEN 0.5 ELSE greatest(least(0.15 / greatest(rv * sqrt(252), 0.01), 1.0), 0.1) END AS size
  FROM (SELECT *, coalesce(atr / CASE WHEN med IS NOT NULL THEN greatest(med, 1e-10) END, 1.0) AS k FROM at2) at2 JOIN ms USING (instrument, timestamp)),
{_machine_sql('mv', 'le', 'lx', 'se', 'sx', 'size')}"""


@query("sa_atr_positions", f"WITH RECURSIVE {ATR_SQL} SELECT instrument, timestamp, round(signal, 6) + 0.0 AS signal, round(target_position, 6) + 0.0 AS target_position, action FROM tp")
def sa_atr_positions(spark, d):
    b = _bars(spark, d)
    return rounded(single_asset.atr_positions(b, single_asset.dual_ma_signal(b, price="price"), short=True), "signal", "target_position")


@query("sa_debounce", f"WITH RECURSIVE {POSITION_SQL}, db AS (SELECT *, lag(target_position) {W} AS b, row_number() {W} AS k FROM tp) SELECT instrument, timestamp, round(signal, 6) + 0.0 AS signal, target_position, action FROM db WHERE k = 1 OR b <> target_position")
def sa_debounce(spark, d):
    return rounded(single_asset.debounce(_positions(spark, d)), "signal")


@query("sa_check_positions", """WITH f AS (SELECT factor_id, asset, datetime, value FROM factor_lake)
SELECT (SELECT count(*) FROM f WHERE value IS NULL OR isnan(value)) AS missing, (SELECT count(*) FROM f WHERE abs(value) > 1) AS out_of_range,
  (SELECT count(*) FROM (SELECT 1 FROM f GROUP BY asset, datetime HAVING count(*) > 1)) AS repeated""")
def sa_check_positions(spark, d):
    """Factor values taken for positions: missing ones, those beyond 1, and repeated keys."""
    lake = read_table(spark, d, "factor_lake").select(F.col("datetime").alias("timestamp"), F.col("asset").alias("instrument"), F.col("value").alias("target_position"))
    return single_asset.check_positions(lake)


ACCOUNT_SQL = f"""{POSITION_SQL}, ai AS (SELECT tp.instrument, tp.timestamp, tp.rn, tp.target_position AS z, q.open AS o, q.open AS c FROM tp JOIN q USING (instrument, timestamp)),
ac AS (SELECT instrument, timestamp, rn, 1e5::DOUBLE AS cash, 0.0::DOUBLE AS shares, CASE WHEN abs(z) > 1e-9 THEN z::DOUBLE END AS pending, CASE WHEN abs(z) > 1e-9 THEN z::DOUBLE ELSE 0.0 END AS asked, CASE WHEN c IS NOT NULL THEN 1e5::DOUBLE END AS equity FROM ai WHERE rn = 1 UNION ALL
  SELECT instrument, timestamp, rn, cash, shares, CASE WHEN abs(z - asked) > 1e-9 THEN z ELSE pending END, CASE WHEN abs(z - asked) > 1e-9 THEN z ELSE asked END, cash + shares * c FROM (
    SELECT instrument, timestamp, rn, z, c, asked, CASE WHEN go THEN NULL ELSE pending END AS pending, want AS shares,
      cash - CASE WHEN go THEN (want - shares) * o * (1 + sign(want - shares) * 0.0002) + abs((want - shares) * o * (1 + sign(want - shares) * 0.0002)) * 0.0005 ELSE 0 END AS cash FROM (
      SELECT ai.*, ac.cash, ac.shares, ac.pending, ac.asked, ac.pending IS NOT NULL AND ai.o > 0 AS go, CASE WHEN ac.pending IS NOT NULL AND ai.o > 0 THEN ac.pending * (ac.cash + ac.shares * ai.o) / ai.o ELSE ac.shares END AS want
      FROM ac JOIN ai ON ai.instrument = ac.instrument AND ai.rn = ac.rn + 1)))"""


@query("sa_backtest", f"WITH RECURSIVE {ACCOUNT_SQL} SELECT instrument, timestamp, round(equity, 4) + 0.0 AS equity, round(equity / nullif(lag(equity) {W}, 0) - 1, 6) + 0.0 AS period_return FROM ac")
def sa_backtest(spark, d):
    df = _positions(spark, d).join(_bars(spark, d).select("timestamp", "instrument", "open", F.col("price").alias("close")), ["timestamp", "instrument"])
    return rounded(rounded(single_asset.single_asset_backtest(df), "period_return"), "equity", digits=4)


LEDGER_SQL = f"""{POSITION_SQL}, lg0 AS (SELECT tp.instrument, tp.timestamp, sign(target_position) AS s, q.open AS price, q.high, q.low FROM tp JOIN q USING (instrument, timestamp)),
lg1 AS (SELECT *, CASE WHEN s <> coalesce(lag(s) {W}, 0) THEN 1 ELSE 0 END AS new FROM lg0), lg2 AS (SELECT *, sum(new) {ALL} AS trade FROM lg1),
lg3 AS (SELECT instrument, trade, min(timestamp) AS entry, max(timestamp) AS exit, CAST(max(s) AS DOUBLE) AS side, count(*) AS bars, first(price ORDER BY timestamp) AS entry_price, last(price ORDER BY timestamp) AS exit_price, max(high) AS hi, min(low) AS lo FROM lg2 WHERE s <> 0 GROUP BY 1, 2),
lg4 AS (SELECT *, CASE WHEN entry_price > 0 THEN entry_price END AS e FROM lg3)"""


@query("sa_trade_ledger", f"""WITH RECURSIVE {LEDGER_SQL} SELECT instrument, entry, exit, side, bars, entry_price, exit_price, round((exit_price / nullif(entry_price, 0) - 1) * side, 6) + 0.0 AS trade_return,
  round(greatest(CASE WHEN side > 0 THEN hi / e - 1 ELSE e / greatest(lo, 1e-12) - 1 END, 0), 6) + 0.0 AS mfe, round(least(CASE WHEN side > 0 THEN lo / e - 1 ELSE e / greatest(hi, 1e-12) - 1 END, 0), 6) + 0.0 AS mae FROM lg4""")
def sa_trade_ledger(spark, d):
    df = _positions(spark, d).join(_bars(spark, d).select("timestamp", "instrument", "price", "high", "low"), ["timestamp", "instrument"])
    return rounded(single_asset.trade_ledger(df, price="price"), "trade_return", "mfe", "mae")


EXEC_SQL = f"""{HOLD_SQL}, ex0 AS (SELECT q.instrument, q.timestamp, q.rn, q.open AS close, coalesce(last_value(hold.weight IGNORE NULLS) OVER (PARTITION BY q.instrument ORDER BY q.timestamp), 0) AS t,
  coalesce(greatest(q.open * q.volume, 0), 0) * 0.3 / 1e6 AS cap FROM q LEFT JOIN hold ON hold.instrument = q.instrument AND hold.timestamp = q.timestamp),
exw AS (SELECT instrument, timestamp, rn, CAST(greatest(least(t, cap), -cap) AS DOUBLE) AS weight FROM ex0 WHERE rn = 1 UNION ALL
  SELECT x.instrument, x.timestamp, x.rn, exw.weight + greatest(least(x.t - exw.weight, x.cap), -x.cap) FROM exw JOIN ex0 x ON x.instrument = exw.instrument AND x.rn = exw.rn + 1),
ex1 AS (SELECT exw.instrument, exw.timestamp, weight, cap, abs(weight - coalesce(lag(weight) OVER w, 0)) AS trade, close / nullif(lag(close) OVER w, 0) - 1 AS ret, lag(weight) OVER w AS held
  FROM exw JOIN ex0 ON ex0.instrument = exw.instrument AND ex0.timestamp = exw.timestamp WINDOW w AS (PARTITION BY exw.instrument ORDER BY exw.timestamp)),
exd AS (SELECT timestamp, sum(coalesce(held * ret, 0)) AS gross_return, sum(trade) AS turnover, sum(CASE WHEN cap > 0 THEN trade * (trade / cap) * (trade / cap) ELSE 0 END) * 0.1 AS impact_cost, max(CASE WHEN cap > 0 THEN trade / cap ELSE 0 END) AS participation, sum(abs(weight)) AS gross_leverage FROM ex1 GROUP BY 1)"""


def _execution(spark, d):
    bars = _bars(spark, d).select("timestamp", "instrument", F.col("price").alias("close"), "volume")
    return single_asset.multi_asset_backtest(_holdings(spark, d).withColumnRenamed("weight", "target_weight"), bars, adv_share=0.3, impact="square")


@query("sa_multi_asset_weights", f"WITH RECURSIVE {EXEC_SQL} SELECT instrument, timestamp, round(weight, 6) + 0.0 AS weight FROM exw")
def sa_multi_asset_weights(spark, d):
    return rounded(_execution(spark, d)[0], "weight")


@query("sa_multi_asset_returns", f"""WITH RECURSIVE {EXEC_SQL} SELECT timestamp, round(gross_return, 6) + 0.0 AS gross_return, round(turnover, 6) + 0.0 AS turnover, round(impact_cost, 6) + 0.0 AS impact_cost, round(participation, 6) + 0.0 AS participation, round(gross_leverage, 6) + 0.0 AS gross_leverage,
  round(turnover * 0.0005 + impact_cost, 6) + 0.0 AS cost, round(gross_return - turnover * 0.0005 - impact_cost, 6) + 0.0 AS net_return FROM exd""")
def sa_multi_asset_returns(spark, d):
    out = _execution(spark, d)[1].drop("nav")
    return rounded(out, *[c for c in out.columns if c != "timestamp"])


FIGURES_SQL = f"""{ACCOUNT_SQL}, fgr AS (SELECT instrument, timestamp, equity, equity / nullif(lag(equity) {W}, 0) - 1 AS r FROM ac),
fg0 AS (SELECT ac.instrument, ac.timestamp, equity, r, z AS pos, coalesce(z, 0) - coalesce(lag(z) OVER w, 0) AS step, max(equity) OVER w AS peak, date_diff('day', lag(ac.timestamp) OVER w, ac.timestamp) AS gap
  FROM fgr ac JOIN ai USING (instrument, timestamp) WHERE equity IS NOT NULL WINDOW w AS (PARTITION BY ac.instrument ORDER BY ac.timestamp)),
fg1 AS (SELECT instrument, count(*) AS bars, last(equity ORDER BY timestamp) / first(equity ORDER BY timestamp) - 1 AS total, greatest(1, 252.0 / median(gap)) AS y, stddev_pop(r) AS sd, min(equity / peak - 1) AS dd, sum(abs(step)) AS turnover,
  stddev_pop(r) FILTER (WHERE r < 0) AS down, avg((r > 0)::INT) FILTER (WHERE r IS NOT NULL) AS hits, quantile_cont(r, 0.05) AS low, quantile_cont(r, 0.95) AS high, avg((abs(pos) > 1e-12)::INT) AS inside, avg(abs(pos)) AS exposure,
  sqrt(avg((equity / peak - 1) * (equity / peak - 1)) FILTER (WHERE equity < peak)) AS ulcer, avg(equity / peak - 1) FILTER (WHERE equity < peak) AS mean_dd, sum(r) FILTER (WHERE r > 0) AS up, -sum(r) FILTER (WHERE r < 0) AS lost FROM fg0 GROUP BY 1),
fg2 AS (SELECT *, pow(1 + total, coalesce(y, 252) / bars) - 1 AS annual, coalesce(y, 252) AS yy FROM fg1)"""
_PER = lambda a, b: f"CASE WHEN abs({b}) > 1e-12 THEN {a} / {b} ELSE 0 END"


@query("sa_figures", f"""WITH RECURSIVE {FIGURES_SQL} SELECT instrument, bars, round(total, 6) + 0.0 AS total_return, round(annual, 6) + 0.0 AS annual_return, round(coalesce(sd * sqrt(yy), 0), 6) + 0.0 AS volatility, round({_PER("annual", "coalesce(sd * sqrt(yy), 0)")}, 5) + 0.0 AS sharpe, round(dd, 6) + 0.0 AS max_drawdown, round(turnover, 6) + 0.0 AS turnover,
  round(coalesce(down * sqrt(yy), 0), 6) + 0.0 AS downside_volatility, round({_PER("annual", "dd")} * -1 + 0.0, 5) + 0.0 AS calmar, round(coalesce(hits, 0), 6) + 0.0 AS hit_rate_bar, round(coalesce(low, 0), 6) + 0.0 AS var_95, round({_PER("coalesce(high, 0)", "abs(coalesce(low, 0))")}, 5) + 0.0 AS tail_ratio, round(coalesce(inside, 0), 6) + 0.0 AS time_in_market,
  round(coalesce(exposure, 0), 6) + 0.0 AS exposure, round(coalesce(ulcer, 0), 6) + 0.0 AS ulcer_index, round(coalesce(mean_dd, 0), 6) + 0.0 AS avg_drawdown, round({_PER("coalesce(up, 0)", "coalesce(lost, 0)")}, 5) + 0.0 AS omega_ratio, round(turnover / bars * yy, 5) + 0.0 AS turnover_annualized FROM fg2""")
def sa_figures(spark, d):
    df = _positions(spark, d).join(_bars(spark, d).select("timestamp", "instrument", "open", F.col("price").alias("close")), ["timestamp", "instrument"])
    account = single_asset.single_asset_backtest(df).join(df.select("timestamp", "instrument", F.col("target_position").alias("position")), ["timestamp", "instrument"])
    out = account_figures.account_figures(account, profile="industrial")
    five = ["sharpe", "calmar", "tail_ratio", "omega_ratio", "turnover_annualized"]
    six = ["total_return", "annual_return", "volatility", "max_drawdown", "turnover", "downside_volatility", "hit_rate_bar", "var_95", "time_in_market", "exposure", "ulcer_index", "avg_drawdown"]
    return rounded(rounded(out.select("instrument", "bars", *six, *five), *six), *five, digits=5)


@query("sa_trade_figures", f"""WITH RECURSIVE {LEDGER_SQL}, tg0 AS (SELECT instrument, entry, bars, coalesce((exit_price / nullif(entry_price, 0) - 1) * side, 0) AS x, row_number() OVER (PARTITION BY instrument ORDER BY entry) AS i FROM lg4),
tg1 AS (SELECT *, i - coalesce(max(CASE WHEN x >= 0 THEN i END) OVER (PARTITION BY instrument ORDER BY i), 0) AS run FROM tg0)
SELECT instrument, count(*) AS trades, round(avg((x > 0)::INT), 6) + 0.0 AS win_rate_trade, max(run) AS max_consecutive_losses, round(avg(bars), 6) + 0.0 AS avg_holding_period_bars, round(avg((x > 0)::INT) * coalesce(avg(x) FILTER (WHERE x > 0), 0) + (1 - avg((x > 0)::INT)) * coalesce(avg(x) FILTER (WHERE x < 0), 0), 6) + 0.0 AS expectancy,
  round({_PER("coalesce(sum(x) FILTER (WHERE x > 0), 0)", "coalesce(sum(x) FILTER (WHERE x < 0), 0)")} * -1 + 0.0, 6) + 0.0 AS profit_factor FROM tg1 GROUP BY 1""")
def sa_trade_figures(spark, d):
    df = _positions(spark, d).join(_bars(spark, d).select("timestamp", "instrument", "price", "high", "low"), ["timestamp", "instrument"])
    out = account_figures.trade_figures(single_asset.trade_ledger(df, price="price"))
    return rounded(out.select("instrument", "trades", "win_rate_trade", "max_consecutive_losses", "avg_holding_period_bars", "profit_factor", "expectancy"), "win_rate_trade", "avg_holding_period_bars", "profit_factor", "expectancy")


@query("sa_align", f"WITH RECURSIVE {POSITION_SQL} SELECT instrument, timestamp, target_position FROM tp")
def sa_align(spark, d):
    """The changes of position alone, brought back to all bars: the positions again."""
    changes = single_asset.debounce(_positions(spark, d))
    return single_asset.align_targets(single_asset.valid_targets(changes), _bars(spark, d)).select("instrument", "timestamp", "target_position")


_LABEL = "CASE WHEN t >= 930 AND t < 1000 THEN 'OPEN' WHEN t >= 1000 AND t < 1530 THEN 'MID' WHEN t >= 1530 AND t < 1600 THEN 'CLOSE' ELSE 'OFF' END"


@query("in_status_ic", f"""WITH {PREP_SQL}, v AS (SELECT instrument, date, {_LABEL} AS status, factor_eval AS x, target_eval AS y FROM (SELECT *, hour(timestamp) * 100 + minute(timestamp) AS t FROM pp) WHERE factor_eval IS NOT NULL AND target_eval IS NOT NULL),
rk AS (SELECT *, {prank("x", "instrument, status, date")} AS rx, {prank("y", "instrument, status, date")} AS ry FROM v)
SELECT instrument, status, date, round(covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0), 6) + 0.0 AS ic, round(covar_pop(rx, ry) / nullif(stddev_pop(rx) * stddev_pop(ry), 0), 6) + 0.0 AS rank_ic, count(*) AS n FROM rk GROUP BY 1, 2, 3 HAVING count(*) >= 5""")
def in_status_ic(spark, d):
    """Daily correlations per part of the session."""
    df = _prepared(spark, d).withColumn("status", minute.session_label(F.col("timestamp")))
    return rounded(minute.daily_ic(df, "factor_eval", "target_eval", least=5, keys=("instrument", "status", "date")), "ic", "rank_ic")


STATUS_SQL = f"""{GROUP_SQL}, gs AS (SELECT gr.*, {_LABEL} AS status FROM (SELECT *, hour(timestamp) * 100 + minute(timestamp) AS t FROM gr) gr)"""


@query("in_status_returns", f"WITH {STATUS_SQL} SELECT instrument, status, g AS \"group\", round(pow(1 + avg(target_eval), 1.0 / 3) - 1, 6) + 0.0 AS avg_single_period_ret FROM gs WHERE g IS NOT NULL AND target_eval IS NOT NULL GROUP BY 1, 2, 3")
def in_status_returns(spark, d):
    """Mean returns of the factor's groups per part of the session."""
    df = _grouped(spark, d).withColumn("status", minute.session_label(F.col("timestamp")))
    return rounded(minute.layered_returns(df, "target_eval", 3, keys=("instrument", "status")), "avg_single_period_ret")
