"""A query per operator of the factor language over the daily bars, and SQL for the same values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorloom.functions import ops
from factorloom.functions.common import key_upper, read_table
from factorloom.plans.compiler import compute, panel

COLUMNS = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v", "vwap": "vw", "trades": "n"}


def daily_panel(spark: SparkSession, d: str) -> DataFrame:
    """The bars of daily_market_summary as a panel: the latest delivery of each ticker and day."""
    bars = read_table(spark, d, "daily_market_summary")
    sector = F.substring(key_upper("ticker"), 3, 1)
    return panel(bars, F.to_date("trade_date"), key_upper("ticker"), {n: F.col(c) for n, c in COLUMNS.items()} | {"sector": sector}, keep_last_by=F.col("align_time"))


_TICKER = r"upper(regexp_replace(ticker, '^\s+|\s+$', '', 'g'))"
_FINITE = ", ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS {n}" for n, c in COLUMNS.items())
PANEL_SQL = f"""p AS (SELECT * EXCLUDE (k) FROM (
  SELECT *, row_number() OVER (PARTITION BY instrument, timestamp ORDER BY align_time DESC NULLS LAST, {", ".join(f"{n} DESC NULLS LAST" for n in COLUMNS)}) AS k
  FROM (SELECT {_TICKER} AS instrument, CAST(trade_date AS DATE) AS timestamp, align_time, {_FINITE}, {_TICKER}[3:3] AS sector FROM daily_market_summary WHERE {_TICKER} <> '')) WHERE k = 1),
q AS (SELECT *, row_number() OVER (PARTITION BY instrument ORDER BY timestamp) AS rn FROM p)"""


def r(d: int) -> str:
    return f"OVER (PARTITION BY instrument ORDER BY timestamp ROWS {d - 1} PRECEDING)"


W = "OVER (PARTITION BY instrument ORDER BY timestamp)"
CS = "OVER (PARTITION BY timestamp)"
G = "OVER (PARTITION BY timestamp, sector)"
ALL = "OVER (PARTITION BY instrument ORDER BY timestamp ROWS UNBOUNDED PRECEDING)"


def gate(x: str, d: int, n: int, e: str) -> str:
    return f"CASE WHEN count({x}) {r(d)} >= {n} THEN {e} END"


def nz(x: str) -> str:
    return f"nullif({x}, 0)"


def lst(x: str, d: int) -> str:
    return f"coalesce(list({x}) FILTER (WHERE ({x}) IS NOT NULL) {r(d)}, [])"


def prank(x: str, part: str = "timestamp") -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY {part} ORDER BY {x} NULLS LAST) + (count({x}) OVER (PARTITION BY {part}, {x}) - 1) / 2.0) / count({x}) OVER (PARTITION BY {part}) END"


def both(x: str, y: str) -> tuple[str, str]:
    return f"(CASE WHEN {y} IS NOT NULL THEN {x} END)", f"(CASE WHEN {x} IS NOT NULL THEN {y} END)"


def clip(x: str, lo: str, hi: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, {lo}), {hi}) END"


def known(*xs: str) -> str:
    return " AND ".join(f"{x} IS NOT NULL" for x in xs)


def _poly(c: tuple[float, ...], r: str) -> str:
    out = repr(c[-1])
    for k in reversed(c[:-1]):
        out = f"({out} * {r} + {k!r})"
    return out


# the normal quantile of a column p (stages); it is also tested against Python's statistics.NormalDist
NORMAL_STAGES = ("CASE WHEN p IS NOT NULL THEN least(greatest(p, 1e-12), 1 - 1e-12) END AS u", "u - 0.5 AS h, sqrt(-ln(least(u, 1 - u))) AS r, 0.180625 - (u - 0.5) * (u - 0.5) AS m")
NORMAL = f"""CASE WHEN abs(h) <= 0.425 THEN h * {_poly(ops._A, "m")} / {_poly(ops._B, "m")} ELSE sign(h) *
  CASE WHEN r <= 5 THEN {_poly(ops._C, "(r - 1.6)")} / {_poly(ops._D, "(r - 1.6)")} ELSE {_poly(ops._E, "(r - 5)")} / {_poly(ops._FF, "(r - 5)")} END END"""

# name -> (expression, SQL over q) or (expression, SQL over the last stage, earlier stages of added columns)
SPECS: dict[str, tuple] = {}


def add(name: str, dsl: str, sql: str | None, *stages: str) -> None:
    SPECS[f"f_{name}"] = (dsl, sql, stages)


C, V = 'col("close")', 'col("volume")'
HLC = 'col("high"), col("low"), col("close")'

# row-wise
add("abs", f"abs({C} - col(\"open\"))", "abs(close - open)")
add("log", f"log({C})", "CASE WHEN close > 0 THEN ln(close) END")
add("exp", f"exp(log({C}) / 10)", "CASE WHEN close > 0 THEN exp(ln(close) / 10) END")
add("sqrt", f"sqrt({C} - col(\"open\"))", "CASE WHEN close >= open THEN sqrt(close - open) END")
add("sin", f"sin({C} / 1000000)", "sin(close / 1000000)")
add("cos", f"cos({C} / 1000000)", "cos(close / 1000000)")
add("sign", f"sign({C} - col(\"open\"))", "sign(close - open)")
add("reverse", f"reverse({C})", "-close")
add("unary_minus", f"-rank({C})", f"-({prank('close')})")
add("inverse", f"inverse({C})", f"1 / {nz('close')}")
add("power", f"power({C} / {V}, 2)", f"pow(close / {nz('volume')}, 2)")
add("signed_power", f"signed_power({C} - col(\"open\"), 0.5)", "sign(close - open) * pow(abs(close - open), 0.5)")
add("add", f"add({C}, col(\"trades\"), col(\"vwap\"), filter=True)", "coalesce(close, 0) + coalesce(trades, 0) + coalesce(vwap, 0)")
add("subtract", f"subtract({C}, col(\"vwap\"), filter=True)", "coalesce(close, 0) - coalesce(vwap, 0)")
add("multiply", f"multiply({C}, col(\"vwap\"), filter=True)", "coalesce(close, 1) * coalesce(vwap, 1)")
add("infix", f"({C} + 2) * col(\"open\") - {C} / col(\"vwap\")", f"(close + 2) * open - close / {nz('vwap')}")
add("max", f"max({C}, col(\"vwap\"))", f"CASE WHEN {known('close', 'vwap')} THEN greatest(close, vwap) END")
add("min", f"min({C}, col(\"vwap\"))", f"CASE WHEN {known('close', 'vwap')} THEN least(close, vwap) END")
add("divide", f"divide(col(\"high\"), {C})", f"high / {nz('close')}")
add("densify", "densify(sign(col(\"close\") - col(\"open\")))", "CASE WHEN x IS NULL THEN -1 ELSE dense_rank() OVER (PARTITION BY timestamp ORDER BY CASE WHEN x IS NOT NULL THEN f END NULLS LAST) - 1 END",
    "sign(close - open) AS x", "min(instrument) OVER (PARTITION BY timestamp, x) AS f")
T1, T2 = "coalesce(close > open, false)", "coalesce(vwap > open, false)"
add("and_", f"and_({C} > col(\"open\"), col(\"vwap\") > col(\"open\"))", f"CAST({T1} AND {T2} AS DOUBLE)")
add("or_", f"or_({C} > col(\"open\"), col(\"vwap\") > col(\"open\"))", f"CAST({T1} OR {T2} AS DOUBLE)")
add("not_", f"not_({C} - 20)", "CASE WHEN close IS NOT NULL THEN CAST(NOT close - 20 > 0.5 AS DOUBLE) END")
add("if_else", f"if_else({C} > col(\"open\"), 1, {V})", f"CASE WHEN {T1} THEN 1 ELSE volume END")
add("is_nan", f"is_nan({C})", "CAST(close IS NULL AS DOUBLE)")
for _n, _s in {"lt": "<", "le": "<=", "eq": "==", "gt": ">", "ge": ">="}.items():
    add(_n, f"{C} {_s} col(\"vwap\")", f"CAST(coalesce(close {_s} vwap, false) AS DOUBLE)")
add("ne", f"{C} != col(\"vwap\")", "CAST(coalesce(close <> vwap, true) AS DOUBLE)")
add("pasteurize", f"pasteurize({C}, fill_value=0)", "coalesce(close, 0)")
add("protected_div", f"protected_div({C}, col(\"vwap\"))", f"CASE WHEN {known('close', 'vwap')} AND abs(vwap) >= 1e-12 THEN close / vwap ELSE 0 END")
add("protected_log", f"protected_log({C})", "ln(greatest(abs(close), 1e-12)) + 0 * close")
add("protected_sqrt", f"protected_sqrt({C} - col(\"open\"))", "sqrt(abs(close - open))")

# time series
for _n, _f, _d, _least in [("ts_mean", "avg", 20, 20), ("ts_std_dev", "stddev_samp", 10, 10), ("ts_std", "stddev_samp", 10, 10), ("ts_max", "max", 10, 10), ("ts_min", "min", 10, 10), ("ts_sum", "sum", 5, 5)]:
    add(_n, f"{_n}({C}, {_d})", gate("close", _d, _least, f"{_f}(close) {r(_d)}"))
add("ts_mean_min_periods", f"ts_mean({C}, 20, min_periods=3)", gate("close", 20, 3, f"avg(close) {r(20)}"))
add("ts_product", f"ts_product(1 + col(\"trades\") / 1000000, 5)", gate("x", 5, 5, f"product(x) {r(5)}"), "1 + trades / 1000000 AS x")
add("ts_delay", f"ts_delay({C}, 3)", f"lag(close, 3) {W}")
add("delay", f"delay({C}, 2)", f"lag(close, 2) {W}")
add("ts_delta", f"ts_delta({C}, 5)", f"close - lag(close, 5) {W}")
add("ts_av_diff", f"ts_av_diff({C}, 10)", f"close - {gate('close', 10, 10, f'avg(close) {r(10)}')}")
add("ts_zscore", f"ts_zscore({C}, 10)", gate("close", 10, 2, f"(close - avg(close) {r(10)}) / {nz(f'stddev_samp(close) {r(10)}')}"))
SHARE = "CASE WHEN close IS NOT NULL THEN len(list_filter(a, lambda v: v <= close)) / len(a) END"
add("ts_rank", f"ts_rank({C}, 10)", SHARE, f"{lst('close', 10)} AS a")
add("ts_scale", f"ts_scale({C}, 10, constant=1.0)", f"(close - min(close) {r(10)}) / {nz(f'(max(close) {r(10)} - min(close) {r(10)})')} + 1")
add("ts_count_nans", f"ts_count_nans({C}, 10)", gate("close", 10, 1, f"count(*) {r(10)} - count(close) {r(10)}"))
add("ts_backfill", f"ts_backfill({C}, 5, k=2)", "CASE WHEN len(a) >= 2 THEN a[len(a) - 1] ELSE a[1] END", f"{lst('close', 5)} AS a")
for _n, _f in (("ts_arg_max", "max"), ("ts_arg_min", "min")):
    add(_n, f"{_n}({C}, 10)", "rn - list_min(list_transform(list_filter(a, lambda e: e.x = m), lambda e: e.i))", f"{_f}(close) {r(10)} AS m, list({{'x': close, 'i': rn}}) {r(10)} AS a")
DOT = "list_sum(list_transform(range(1, len(a) + 1), lambda i: i * a[i])) / (len(a) * (len(a) + 1) / 2)"
add("ts_decay_linear", f"ts_decay_linear({C}, 10)", f"CASE WHEN n = len(a) THEN {DOT} END", f"list(close) {r(10)} AS a, count(close) {r(10)} AS n")
add("ts_decay_linear_dense", f"ts_decay_linear({C}, 10, dense=True)", f"CASE WHEN len(a) > 0 THEN {DOT} END", f"{lst('close', 10)} AS a")
VA, VB = both("close", "volume")
VARY = f"stddev_pop({VA}) {r(10)} > 0 AND stddev_pop({VB}) {r(10)} > 0"
add("ts_corr", f"ts_corr({C}, {V}, 10)", f"CASE WHEN {VARY} AND count({VA}) {r(10)} >= 2 THEN corr(close, volume) {r(10)} END")
add("ts_covariance", f"ts_covariance(log({V} + 1), log(abs({C}) + 1), 10)", f"CASE WHEN count(CASE WHEN x IS NOT NULL THEN y END) {r(10)} >= 2 THEN covar_samp(y, x) {r(10)} END", "CASE WHEN volume > -1 THEN ln(volume + 1) END AS y, ln(abs(close) + 1) AS x")
REG = "ln(abs(volume) + 1) AS y, ln(abs(close) + 1) AS x"
REG1 = (
    f"regr_count(y, x) {r(10)} AS n, regr_sxx(y, x) {r(10)} AS sxx, regr_syy(y, x) {r(10)} AS syy, regr_sxy(y, x) {r(10)} AS sxy, avg(CASE WHEN x IS NOT NULL THEN y END) {r(10)} AS my, avg(CASE WHEN y IS NOT NULL THEN x END) {r(10)} AS mx"
)
REG2 = "CASE WHEN n >= 2 AND sxx <> 0 THEN sxy / sxx END AS b"
REG_OUT = {
    0: "y - (my - b * mx + b * x)",
    1: "my - b * mx",
    2: "b",
    3: "my - b * mx + b * x",
    4: "greatest(syy - b * sxy, 0 * b)",
    5: "syy + 0 * b",
    6: f"1 - greatest(syy - b * sxy, 0 * b) / {nz('syy')}",
    7: "CASE WHEN n > 2 THEN greatest(syy - b * sxy, 0 * b) / (n - 2) END",
}
for _k, _e in REG_OUT.items():
    add(f"ts_regression_{_k}", f"ts_regression(log(abs({V}) + 1), log(abs({C}) + 1), 10, rettype={_k})", _e, REG, REG1, REG2)
_LAGGED = "OVER (PARTITION BY instrument ORDER BY timestamp ROWS 7 PRECEDING)"
add("ts_regression_lag", f"ts_regression(log(abs({V}) + 1), log(abs({C}) + 1), 10, lag=2, rettype=2)", "CASE WHEN rn > 2 THEN b ELSE b0 END",
    REG, f"lag(x, 2) {W} AS z", f"regr_count(y, z) {_LAGGED} AS n, regr_sxx(y, z) {_LAGGED} AS sxx, regr_sxy(y, z) {_LAGGED} AS sxy, regr_count(y, x) {r(10)} AS n0, regr_sxx(y, x) {r(10)} AS sxx0, regr_sxy(y, x) {r(10)} AS sxy0",
    "CASE WHEN n >= 2 AND sxx <> 0 THEN sxy / sxx END AS b, CASE WHEN n0 >= 2 AND sxx0 <> 0 THEN sxy0 / sxx0 END AS b0")
add("ts_quantile", f"ts_quantile({C}, 10)", f"CASE WHEN n >= 2 THEN {NORMAL} END", f"{lst('close', 10)} AS a, count(close) {r(10)} AS n", f"{SHARE} AS p", *NORMAL_STAGES)
add("days_from_last_change", "days_from_last_change(sign(col(\"close\") - col(\"open\")))", f"rn - coalesce(max(CASE WHEN ch THEN rn END) {ALL}, 1)", "sign(close - open) AS x", f"rn > 1 AND x IS DISTINCT FROM lag(x) {W} AS ch")
add("kth_element", f"kth_element({C}, 10, 3)", "list_sort(a)[3]", f"{lst('close', 10)} AS a")
add("last_diff_value", f"last_diff_value(sign(col(\"close\") - col(\"open\")), 6)", "list_filter(a, lambda v: v <> x)[-1]", "sign(close - open) AS x", "coalesce(list(x) FILTER (WHERE x IS NOT NULL) OVER (PARTITION BY instrument ORDER BY timestamp ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), []) AS a")
for _n, _f in (("ts_skew", "skewness"), ("ts_kurt", "kurtosis")):
    add(_n, f"{_n}(log(abs({V}) + 1), 10)", f"CASE WHEN var_pop(x) {r(10)} > 0 AND count(x) {r(10)} >= 10 THEN {_f}(x) {r(10)} END", "ln(abs(volume) + 1) AS x")
add("ts_step", f"ts_step(7, {C})", "(rn - 1) % 7")

# cross-section
add("rank", f"rank({C})", prank("close"))
add("zscore", f"zscore(log({V} + 1))", f"(x - avg(x) {CS}) / {nz(f'stddev_samp(x) {CS}')}", "CASE WHEN volume > -1 THEN ln(volume + 1) END AS x")
LOGV = "CASE WHEN volume > -1 THEN ln(volume + 1) END AS x"
add("normalize", f"normalize(log({V} + 1), useStd=True, limit=1.5)", clip("z", "-1.5", "1.5"), LOGV, f"(x - avg(x) {CS}) / {nz(f'stddev_samp(x) {CS}')} AS z")
add("quantile", f"quantile({C})", NORMAL, f"{prank('close')} AS p", *NORMAL_STAGES)
add("scale", f"scale(ts_delta({C}, 1), longscale=2.0)", f"CASE WHEN x > 0 THEN x / sum(CASE WHEN x > 0 THEN x END) {CS} * 2 WHEN x < 0 THEN x / sum(CASE WHEN x < 0 THEN -x END) {CS} ELSE x END", f"close - lag(close) {W} AS x")
add("winsorize", f"winsorize({C}, std=1.0)", clip("close", f"avg(close) {CS} - s", f"avg(close) {CS} + s"), f"CASE WHEN stddev_samp(close) {CS} > 0 THEN stddev_samp(close) {CS} END AS s")
_NA, _NB = "(CASE WHEN y IS NOT NULL THEN x END)", "(CASE WHEN x IS NOT NULL THEN y END)"
add("neutralize", f"neutralize(log({V} + 1), log(abs({C}) + 1))", f"CASE WHEN count({_NA}) {CS} >= 2 AND regr_sxx(x, y) {CS} >= 1e-18 THEN {_NA} - avg({_NA}) {CS} - regr_sxy(x, y) {CS} / regr_sxx(x, y) {CS} * ({_NB} - avg({_NB}) {CS}) END", LOGV + ", ln(abs(close) + 1) AS y")
add("orthogonalize", f"orthogonalize(log({V} + 1), log(abs({C}) + 1))", f"CASE WHEN count({_NA}) {CS} >= 2 THEN {_NA} - sum({_NA} * {_NB}) {CS} / sum({_NB} * {_NB}) {CS} * {_NB} END", LOGV + ", ln(abs(close) + 1) AS y")
add("tail", f"tail({C}, 0.1, 0.9)", clip("close", f"quantile_cont(close, 0.1) {CS}", f"quantile_cont(close, 0.9) {CS}"))
add("bucket", f"bucket({C}, buckets=\"5\", skipBoth=True, NaNGroup=True)", "CASE WHEN close IS NULL THEN -1 WHEN b NOT IN (0, 4) THEN b END", f"{prank('close')} AS pr", "floor(least(pr, 1 - 1e-15) * 5) AS b")
add("bucket_range", f"bucket({C}, range=\"0.2,0.5,0.9\")", "CASE WHEN close IS NOT NULL THEN CAST(pr >= 0.2 AS INT) + CAST(pr >= 0.5 AS INT) + CAST(pr >= 0.9 AS INT) END", f"{prank('close')} AS pr")
add("change_instrument", f"change_instrument({C}, \"vwap\")", f"close / {nz(f'avg(vwap) {CS}')}")
add("group_mean", f"group_mean({C}, {V}, col(\"sector\"))", f"coalesce(sum(close * volume) {G}, 0) / {nz(f'sum(volume) {G}')}")
add("group_neutralize", f"group_neutralize({C}, col(\"sector\"))", f"close - avg(close) {G}")
add("group_rank", f"group_rank({C}, col(\"sector\"))", prank("close", "timestamp, sector"))
add("group_scale", f"group_scale({C}, col(\"sector\"))", f"(close - min(close) {G}) / {nz(f'(max(close) {G} - min(close) {G})')}")
add("group_zscore", f"group_zscore({C}, col(\"sector\"))", f"(close - avg(close) {G}) / {nz(f'stddev_samp(close) {G}')}")
add("group_backfill", f"group_backfill({C}, col(\"sector\"), 5, std=1.0)",
    "CASE WHEN close IS NOT NULL THEN close WHEN len(a) = 0 THEN NULL WHEN s > 0 THEN list_avg(list_transform(a, lambda v: least(greatest(v, m - s), m + s))) ELSE m END",
    "coalesce(list(close) FILTER (WHERE close IS NOT NULL) OVER (PARTITION BY instrument, sector ORDER BY timestamp ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), []) AS a", "list_avg(a) AS m, list_stddev_pop(a) AS s")
add("trade_when", f"trade_when({C} > ts_delay({C}, 1), {V}, {C} < 0.97 * ts_delay({C}, 1))", "CASE WHEN st IS NULL OR ex_at = st THEN NULL ELSE first_value(al) OVER (PARTITION BY instrument, st ORDER BY timestamp) END",
    f"lag(close) {W} AS y", "coalesce(close > y, false) AS tr, coalesce(close < 0.97 * y, false) AS ex, volume AS al", f"max(CASE WHEN tr OR ex THEN rn END) {ALL} AS st, max(CASE WHEN ex THEN rn END) {ALL} AS ex_at")

# technical, without a recursion
add("ts_sma", f"ts_sma({C}, 10)", f"avg(close) {r(10)}")
for _b, _sgn in (("upper", "+"), ("middle", "+ 0 *"), ("lower", "-")):
    add(f"ts_bbands_{_b}", f"ts_bbands({C}, 10, band=\"{_b}\")", f"avg(close) {r(10)} {_sgn} 2 * stddev_samp(close) {r(10)}" if _b != "middle" else f"avg(close) {r(10)}")
TR = f"CASE WHEN rn = 1 THEN high - low WHEN {known('high', 'low')} AND lag(close) {W} IS NOT NULL THEN greatest(high - low, abs(high - lag(close) {W}), abs(low - lag(close) {W})) END"
add("ts_trange", f"ts_trange({HLC})", TR)
add("ts_donchian", "ts_donchian(col(\"high\"), col(\"low\"), 10)", f"(max(high) {r(10)} + min(low) {r(10)}) / 2")
add("ts_ma_envelope", f"ts_ma_envelope({C}, 10, band=\"upper\")", f"avg(close) {r(10)} * 1.025")
TPX = "(high + low + close) / 3 AS tp"
add("ts_cci", f"ts_cci({HLC}, 10)", "CASE WHEN n = len(a) THEN (tp - m) / (0.015 * nullif(list_avg(list_transform(a, lambda v: abs(v - m))), 0)) END", TPX, f"list(tp) {r(10)} AS a, count(tp) {r(10)} AS n, avg(tp) {r(10)} AS m")
FK = f"CASE WHEN max(high) {r(5)} > min(low) {r(5)} THEN 100 * (close - min(low) {r(5)}) / (max(high) {r(5)} - min(low) {r(5)}) END AS k"
add("ts_stoch", f"ts_stoch({HLC}, line=\"slowd\")", f"avg(s) {r(3)}", FK, f"avg(k) {r(3)} AS s")
add("ts_stochf", f"ts_stochf({HLC}, line=\"fastd\")", f"avg(k) {r(3)}", FK)
add("ts_willr", f"ts_willr({HLC}, 10)", f"CASE WHEN max(high) {r(10)} > min(low) {r(10)} THEN -100 * (max(high) {r(10)} - close) / (max(high) {r(10)} - min(low) {r(10)}) END")
PREV = f"{nz(f'lag(close, 5) {W}')}"
add("ts_roc", f"ts_roc({C}, 5)", f"100 * (close - lag(close, 5) {W}) / {PREV}")
add("ts_rocr", f"ts_rocr({C}, 5)", f"close / {PREV}")
add("ts_rocr100", f"ts_rocr100({C}, 5)", f"(close / {PREV} - 1) * 100")
add("ts_mom", f"ts_mom({C}, 5)", f"close - lag(close, 5) {W}")
RUN = f"CASE WHEN count(x) {ALL} = count(*) {ALL} THEN sum(x) {ALL} END"
add("ts_obv", f"ts_obv({C}, {V})", RUN, f"CASE WHEN rn = 1 THEN 0 * volume ELSE sign(close - lag(close) {W}) * volume END AS x")
MF = "CASE WHEN high - low > 1e-12 AND volume IS NOT NULL THEN ((close - low) - (high - close)) / (high - low) * volume ELSE 0 END AS x"
add("ts_ad", f"ts_ad({HLC}, {V})", RUN, MF)
add("ts_mfi", f"ts_mfi({HLC}, {V}, 10)", f"100 - 100 / (1 + sum(u) {r(10)} / nullif(sum(d) {r(10)}, 0))", TPX,
    f"CASE WHEN coalesce(tp > lag(tp) {W}, false) THEN tp * volume ELSE 0 END AS u, CASE WHEN coalesce(tp < lag(tp) {W}, false) THEN tp * volume ELSE 0 END AS d")
add("ts_cmo", f"ts_cmo({C}, 10)", f"100 * (sum(u) {r(10)} - sum(d) {r(10)}) / nullif(sum(u) {r(10)} + sum(d) {r(10)}, 0)", f"greatest(coalesce(close - lag(close) {W}, 0), 0) AS u, greatest(coalesce(lag(close) {W} - close, 0), 0) AS d")
add("ts_wma", f"ts_wma({C}, 10)", f"CASE WHEN n = 10 THEN {DOT} END", f"list(close) {r(10)} AS a, count(close) {r(10)} AS n")
AR = f"max(high) {r(10)} AS mh, min(low) {r(10)} AS ml, list({{'h': high, 'l': low, 'i': rn}}) {r(10)} AS a"
AUP, ADN = (f"100 * (10 - (rn - list_min(list_transform(list_filter(a, lambda e: e.{x} IS NULL OR e.{x} = {m}), lambda e: e.i)))) / 10.0" for x, m in (("h", "mh"), ("l", "ml")))
# a missing value stands before any extreme, wherever it is
_nan = lambda x, e: f"CASE WHEN rn >= 10 THEN CASE WHEN len(list_filter(a, lambda e: e.{x} IS NULL)) > 0 THEN 100 * (10 - (rn - list_min(list_transform(list_filter(a, lambda e: e.{x} IS NULL), lambda e: e.i)))) / 10.0 ELSE {e} END END"
add("ts_aroon", "ts_aroon(col(\"high\"), col(\"low\"), 10, line=\"osc\")", f"{_nan('h', AUP)} - {_nan('l', ADN)}", AR)
PC = f"CASE WHEN rn = 1 THEN close ELSE lag(close) {W} END AS pc"
UO = lambda p: f"sum(bp) {r(p)} / CASE WHEN sum(tr) {r(p)} > 1e-12 THEN sum(tr) {r(p)} END"
add("ts_ultosc", f"ts_ultosc({HLC})", f"100 * (4 * ({UO(7)}) + 2 * ({UO(14)}) + {UO(28)}) / 7", PC,
    f"CASE WHEN {known('close', 'low', 'pc')} THEN close - least(low, pc) END AS bp, CASE WHEN {known('high', 'low', 'pc')} THEN greatest(high, pc) - least(low, pc) END AS tr")
add("ts_trima", f"ts_trima({C}, 10)", f"avg(x) {r(6)}", f"avg(close) {r(6)} AS x")
add("ts_bop", f"ts_bop({HLC})", "CASE WHEN high - low > 1e-12 THEN (close - pc) / (high - low) END", PC)
SLOPE = gate("close", 10, 10, f"regr_slope(close, rn) {r(10)}")
add("ts_linearreg_slope", f"ts_linearreg_slope({C}, 10)", SLOPE)
add("ts_linearreg_angle", f"ts_linearreg_angle({C}, 10)", f"degrees(atan({SLOPE}))")

# compositions
add("chain", f"rank(ts_mean({C}, 20))", prank("x"), gate("close", 20, 20, f"avg(close) {r(20)}") + " AS x")
add("nested", f"zscore(ts_mean(rank({V}), 5)) - group_rank(ts_delta({C}, 5), col(\"sector\"))",
    f"(m - avg(m) {CS}) / {nz(f'stddev_samp(m) {CS}')} - ({prank('dl', 'timestamp, sector')})", f"{prank('volume')} AS rv, close - lag(close, 5) {W} AS dl", gate("rv", 5, 5, f"avg(rv) {r(5)}") + " AS m")


# recursions along time, as recursive SQL: state columns are carried from bar to bar
def _ema_step(y: str, w: str, x: str, a: str) -> tuple[str, str]:
    mixed = f"({w} * (1 - {a}) * {y} + {a} * {x}) / ({w} * (1 - {a}) + {a})"
    return f"CASE WHEN {x} IS NULL THEN {y} WHEN {y} IS NULL THEN {x} ELSE {mixed} END", f"CASE WHEN {x} IS NOT NULL THEN 1.0 WHEN {y} IS NULL THEN {w} ELSE {w} * (1 - {a}) END"


def ema_sql(chain: list[tuple[str, str, str]], prepare: str = "") -> str:
    """CTE e with a column per (name, input, alpha); an input is a column of q or an expression over earlier names."""
    rows = f"z AS (SELECT q.* {prepare} FROM q)"
    inner = "SELECT z.*, " + ", ".join(f"CAST(NULL AS DOUBLE) AS y_{n}, 1.0::DOUBLE AS w_{n}" for n, _, _ in chain) + " FROM z WHERE rn = 1"
    step = "SELECT z.*, " + ", ".join(f"e.{n} AS y_{n}, e.w_{n} AS w_{n}" for n, _, _ in chain) + " FROM e JOIN z ON z.instrument = e.instrument AND z.rn = e.rn + 1"

    def out(src: str) -> str:
        for n, x, a in chain:
            y, w = _ema_step(f"y_{n}", f"w_{n}", f"({x})", a)
            src = f"SELECT * EXCLUDE (w_{n}), {y} AS {n}, {w} AS w_{n} FROM ({src})"
        return "SELECT instrument, timestamp, rn, close, high, low, " + ", ".join(f"{n}, w_{n}" for n, _, _ in chain) + f" FROM ({src})"

    return f"{rows}, e AS ({out(inner)} UNION ALL {out(step)})"


RECURSIVE: dict[str, tuple[str, str, str, str]] = {}  # name -> expression, CTEs, SQL over e, columns of another stage


def alpha(d: int) -> str:
    return f"(2.0 / {d + 1})"


def rec(name: str, dsl: str, ctes: str, sql: str, stage: str = "") -> None:
    RECURSIVE[f"f_{name}"] = (dsl, ctes, sql, stage)


rec("ts_ema", f"ts_ema({C}, 10)", ema_sql([("a", "close", alpha(10))]), "a")
rec("ts_kama", f"ts_kama({C}, 10)", ema_sql([("a", "close", alpha(10))]), "a")
rec("ts_ma_envelope_ema", f"ts_ma_envelope({C}, 10, band=\"lower\", use_ema=True)", ema_sql([("a", "close", alpha(10))]), "a * 0.975")
MACD = [("f", "close", alpha(12)), ("s", "close", alpha(26)), ("g", "f - s", alpha(9))]
rec("ts_macd", f"ts_macd({C}, line=\"hist\")", ema_sql(MACD), "f - s - g")
rec("ts_apo", f"ts_apo({C}, line=\"signal\")", ema_sql(MACD), "g")
rec("ts_ppo", f"ts_ppo({C}, line=\"signal\")", ema_sql([*MACD[:2], ("g", "100 * (f - s) / nullif(s, 0)", alpha(9))]), "g")
CHAIN = [("a1", "close", alpha(10)), *((f"a{i}", f"a{i - 1}", alpha(10)) for i in range(2, 7))]
rec("ts_dema", f"ts_dema({C}, 10)", ema_sql(CHAIN[:2]), "2 * a1 - a2")
rec("ts_tema", f"ts_tema({C}, 10)", ema_sql(CHAIN[:3]), "3 * a1 - 3 * a2 + a3")
rec("ts_t3", f"ts_t3({C}, 10)", ema_sql(CHAIN), "-0.343 * a6 + (3 * 0.49 + 3 * 0.343) * a5 + (-3 * 0.49 - 1.4 - 3 * 0.343) * a4 + (1 + 1.4 + 3 * 0.49 + 0.343) * a3")
rec("ts_trix", f"ts_trix({C}, 10)", ema_sql(CHAIN[:3]), "100 * (a3 - p) / nullif(p, 0)", f"lag(a3) {W} AS p")
MOVE = f", CASE WHEN rn > 1 THEN greatest(close - lag(close) {W}, 0) + 0 * (close - lag(close) {W}) END AS gain, CASE WHEN rn > 1 THEN greatest(lag(close) {W} - close, 0) + 0 * (close - lag(close) {W}) END AS loss"
RSI = lambda d: [("ag", "gain", f"(1.0 / {d})"), ("al", "loss", f"(1.0 / {d})")]
RS = "100 - 100 / (1 + ag / nullif(al, 0))"
rec("ts_rsi", f"ts_rsi({C}, 10)", ema_sql(RSI(10), MOVE), RS)
rec("ts_stochrsi", f"ts_stochrsi({C})", ema_sql(RSI(14), MOVE), f"100 * (x - min(x) {r(5)}) / nullif(max(x) {r(5)} - min(x) {r(5)}, 0)", f"{RS} AS x")
FLOW = ", sum(CASE WHEN high - low > 1e-12 AND volume IS NOT NULL THEN ((greatest(least(close, high), low) - low) - (high - greatest(least(close, high), low))) / (high - low) * least(volume, 100000) / 1000000 + 0 * close ELSE 0 END) " + ALL + " AS s, count(CASE WHEN high - low > 1e-12 AND volume IS NOT NULL AND close IS NULL THEN 1 END) " + ALL + " AS miss"
rec("ts_adosc", f"ts_adosc(col(\"high\"), col(\"low\"), max(min({C}, col(\"high\")), col(\"low\")), min({V}, 100000) / 1000000)", ema_sql([("f", "CASE WHEN miss = 0 THEN s END", alpha(3)), ("g", "CASE WHEN miss = 0 THEN s END", alpha(10))], FLOW), "f - g")
_ATR = f"""z AS (SELECT q.*, {TR} AS tr FROM q), seed AS (SELECT instrument, avg(tr) AS s, count(*) AS n FROM z WHERE rn <= 10 GROUP BY 1),
e AS (SELECT z.*, s AS atr FROM z JOIN seed USING (instrument) WHERE rn = 10 UNION ALL
  SELECT z.*, (e.atr * 9 + z.tr) / 10 AS atr FROM e JOIN z ON z.instrument = e.instrument AND z.rn = e.rn + 1),
full_e AS (SELECT z.*, e.atr FROM z LEFT JOIN e USING (instrument, rn))"""
rec("ts_atr", f"ts_atr({HLC}, 10)", _ATR, "atr", "full")
rec("ts_natr", f"ts_natr({HLC}, 10)", _ATR, "100 * atr / nullif(close, 0)", "full")
_HUMP = """z AS (SELECT * FROM q), e AS (SELECT z.*, close AS y, close AS o FROM z WHERE rn = 1 UNION ALL
  SELECT z.*, CASE WHEN z.close IS NULL THEN e.y WHEN e.y IS NULL THEN z.close ELSE least(greatest(z.close, e.y - 0.5), e.y + 0.5) END AS y,
  CASE WHEN z.close IS NULL THEN NULL WHEN e.y IS NULL THEN z.close ELSE least(greatest(z.close, e.y - 0.5), e.y + 0.5) END AS o
  FROM e JOIN z ON z.instrument = e.instrument AND z.rn = e.rn + 1)"""
rec("hump", f"hump({C}, 0.5)", _HUMP, "o")
rec("ts_keltner", f"ts_keltner({HLC}, 10, band=\"upper\", atr_d=5)", ema_sql([("a", "(high + low + close) / 3", alpha(10))]) + """,
k0 AS (SELECT q.*, """ + TR + """ AS tr FROM q), ks AS (SELECT instrument, avg(tr) AS s FROM k0 WHERE rn <= 5 GROUP BY 1),
k AS (SELECT k0.*, s AS atr FROM k0 JOIN ks USING (instrument) WHERE rn = 5 UNION ALL SELECT k0.*, (k.atr * 4 + k0.tr) / 5 AS atr FROM k JOIN k0 ON k0.instrument = k.instrument AND k0.rn = k.rn + 1),
full_e AS (SELECT e.instrument, e.timestamp, e.a, k.atr FROM e LEFT JOIN k ON k.instrument = e.instrument AND k.rn = e.rn)""", "a + 2 * atr", "full")
_DMI = f"""d0 AS (SELECT q.*, {TR} AS tr, high - lag(high) {W} AS up, lag(low) {W} - low AS dn, count(coalesce(high, low, close)) OVER (PARTITION BY instrument) AS whole, max(CASE WHEN coalesce(high, low, close) IS NOT NULL THEN rn END) OVER (PARTITION BY instrument) AS last_known FROM q),
d1 AS (SELECT *, CASE WHEN coalesce(up > dn AND up > 0, false) THEN up ELSE 0 END AS pm, CASE WHEN coalesce(dn > up AND dn > 0, false) THEN dn ELSE 0 END AS mm FROM d0),
ds AS (SELECT instrument, avg(tr) AS st, avg(pm) AS sp, avg(mm) AS sm FROM d1 WHERE rn <= 10 GROUP BY 1),
d2 AS (SELECT d1.*, st AS a, sp AS b, sm AS c FROM d1 JOIN ds USING (instrument) WHERE rn = 10 AND last_known > 10 UNION ALL
  SELECT d1.*, (d2.a * 9 + d1.tr) / 10 AS a, (d2.b * 9 + d1.pm) / 10 AS b, (d2.c * 9 + d1.mm) / 10 AS c FROM d2 JOIN d1 ON d1.instrument = d2.instrument AND d1.rn = d2.rn + 1),
d3 AS (SELECT instrument, rn, CASE WHEN a > 1e-12 THEN 100 * b / a END AS pdi, CASE WHEN a > 1e-12 THEN 100 * c / a END AS mdi FROM d2),
d4 AS (SELECT *, CASE WHEN pdi + mdi > 1e-12 THEN 100 * abs(pdi - mdi) / (pdi + mdi) END AS dx FROM d3),
d5 AS (SELECT instrument, avg(dx) AS s FROM d4 WHERE rn BETWEEN 10 AND 19 GROUP BY 1),
d6 AS (SELECT d4.*, s AS adx FROM d4 JOIN d5 USING (instrument) WHERE rn = 19 UNION ALL SELECT d4.*, (d6.adx * 9 + d4.dx) / 10 AS adx FROM d6 JOIN d4 ON d4.instrument = d6.instrument AND d4.rn = d6.rn + 1),
full_e AS (SELECT q.instrument, q.timestamp, d4.pdi, d4.dx, d6.adx, lag(d6.adx, 10) OVER (PARTITION BY q.instrument ORDER BY q.timestamp) AS adx10
  FROM q LEFT JOIN d4 ON d4.instrument = q.instrument AND d4.rn = q.rn LEFT JOIN d6 ON d6.instrument = q.instrument AND d6.rn = q.rn)"""
rec("ts_adx", f"ts_adx({HLC}, 10)", _DMI, "adx", "full")
rec("ts_adx_plus", f"ts_adx({HLC}, 10, line=\"plus_di\")", _DMI, "pdi", "full")
rec("ts_adxr", f"ts_adxr({HLC}, 10)", _DMI, "(adx + adx10) / 2", "full")
rec("ts_dx", f"ts_dx({HLC}, 10)", _DMI, "dx", "full")
_SAR = f"""z AS (SELECT instrument, timestamp, rn, high, low, lag(high) {W} AS ph, lag(low) {W} AS pl, lead(high) {W} AS nh, lead(low) {W} AS nl, count(*) OVER (PARTITION BY instrument) AS n FROM q),
e AS (SELECT instrument, timestamp, rn, coalesce(nh + nl > high + low, false) AS up, CASE WHEN n < 2 THEN NULL WHEN coalesce(nh + nl > high + low, false) THEN low ELSE high END AS sar,
    CASE WHEN coalesce(nh + nl > high + low, false) THEN high ELSE low END AS ep, 0.02::DOUBLE AS af FROM z WHERE rn = 1
  UNION ALL SELECT instrument, timestamp, rn, CASE WHEN turn THEN NOT up ELSE up END, CASE WHEN turn THEN ep2 ELSE nx END, CASE WHEN turn THEN CASE WHEN up THEN low ELSE high END ELSE ep2 END, CASE WHEN turn THEN 0.02 ELSE af2 END
  FROM (SELECT *, coalesce(CASE WHEN up THEN low < nx ELSE high > nx END, false) AS turn FROM
    (SELECT z.instrument, z.timestamp, z.rn, z.high, z.low, e.up, CASE WHEN e.up THEN least(e.sar + e.af * (e.ep - e.sar), z.pl, z.low) ELSE greatest(e.sar + e.af * (e.ep - e.sar), z.ph, z.high) END + 0 * e.sar AS nx,
      CASE WHEN e.up THEN greatest(e.ep, z.high) ELSE least(e.ep, z.low) END AS ep2,
      CASE WHEN coalesce(CASE WHEN e.up THEN z.high > e.ep ELSE z.low < e.ep END, false) THEN least(e.af + 0.02, 0.2) ELSE e.af END AS af2
     FROM e JOIN z ON z.instrument = e.instrument AND z.rn = e.rn + 1)))"""
rec("ts_sar", "ts_sar(col(\"high\"), col(\"low\"))", _SAR, "sar")


def _query(dsl: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        out = compute(daily_panel(spark, d), {"value": dsl})
        return out.select("instrument", "timestamp", F.round("value", 6).alias("value"))

    return run


def _sql(sql: str, stages: tuple[str, ...]) -> str:
    ctes, last = [PANEL_SQL], "q"
    for i, s in enumerate(stages):
        ctes.append(f"s{i} AS (SELECT *, {s} FROM {last})")
        last = f"s{i}"
    return f"WITH {', '.join(ctes)} SELECT instrument, timestamp, round(CAST({sql} AS DOUBLE), 6) AS value FROM {last}"


def _recursive_sql(ctes: str, sql: str, stage: str) -> str:
    source = "full_e" if stage == "full" else f"(SELECT *, {stage} FROM e)" if stage else "e"
    return f"WITH RECURSIVE {PANEL_SQL}, {ctes} SELECT instrument, timestamp, round(CAST({sql} AS DOUBLE), 6) AS value FROM {source}"


def _vec(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        vectors = panel(read_table(spark, d, "embeddings"), F.col("label"), F.col("vec_id"), {"embedding": F.col("embedding").cast("array<double>")})
        out = compute(vectors, {"value": f'{name}(col("embedding"))'})
        return out.select("instrument", "timestamp", F.round("value", 6).alias("value"))

    return run


FACTORS = {n: dsl for n, (dsl, *_) in {**SPECS, **RECURSIVE}.items()}


def f_run_many(spark: SparkSession, d: str) -> DataFrame:
    """Many factors in one plan that share parts: one scan, common stages."""
    out = compute(daily_panel(spark, d), {"a": SPECS["f_chain"][0], "b": SPECS["f_ts_mean"][0], "c": SPECS["f_nested"][0]})
    return out.select("instrument", "timestamp", *[F.round(c, 6).alias(c) for c in "abc"])


QUERIES = {n: _query(dsl) for n, dsl in FACTORS.items()} | {"f_ts_adosc_raw": _query(f'ts_adosc(col("high"), col("low"), {C}, {V})'), "f_vec_avg": _vec("vec_avg"), "f_vec_sum": _vec("vec_sum"), "f_run_many": f_run_many}
ORACLE_SQL = {n: _sql(sql, stages) for n, (_, sql, stages) in SPECS.items() if sql} | {n: _recursive_sql(c, s, g) for n, (_, c, s, g) in RECURSIVE.items()}
for _n, _f in (("avg", "list_avg"), ("sum", "list_sum")):
    ORACLE_SQL[f"f_vec_{_n}"] = f"SELECT CAST(vec_id AS VARCHAR) AS instrument, label AS timestamp, round({_f}(CAST(embedding AS DOUBLE[])), 6) AS value FROM embeddings WHERE label IS NOT NULL"
ORACLE_SQL["f_run_many"] = f"""SELECT instrument, timestamp, a.value AS a, b.value AS b, c.value AS c
FROM ({ORACLE_SQL["f_chain"]}) a JOIN ({ORACLE_SQL["f_ts_mean"]}) b USING (instrument, timestamp) JOIN ({ORACLE_SQL["f_nested"]}) c USING (instrument, timestamp)"""
