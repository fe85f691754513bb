"""What a single asset's account comes to: figures of its equity, returns, position, benchmark and trades."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.common import group_count, task_count
from factorloom.functions.ops import INST, TS

TINY = 1e-12
DAY_NS, DAYS_A_YEAR = 86_400_000_000_000, 252
# The part of the usual volume that a strategy may be, and the lags of the Hurst exponent.
PARTICIPATION, HURST_LAGS, HURST_LEAST = 0.02, (2, 20), 20

CORE = ["total_return", "annual_return", "volatility", "sharpe", "max_drawdown", "turnover"]
STANDARD = [
    "downside_volatility", "sortino", "calmar", "hit_rate_bar", "alpha", "beta", "capacity_estimate", "information_ratio", "tracking_error", "treynor",
    "up_market_capture", "down_market_capture", "r_squared",
]
INDUSTRIAL = [
    "skew", "kurtosis", "var_95", "cvar_95", "max_drawdown_duration_bars", "avg_drawdown", "turnover_annualized", "ulcer_index", "mar_ratio", "sterling_ratio",
    "burke_ratio", "tail_ratio", "omega_ratio", "recovery_factor", "hurst_exponent", "time_in_market", "exposure",
]
PROFILES = {"core": CORE, "standard": CORE + STANDARD, "industrial": CORE + STANDARD + INDUSTRIAL}


def _over(a: float, b: float) -> float:
    """a / b, 0 where b is next to nothing."""
    return a / b if abs(b) > TINY else 0.0


def _episodes(drawdown: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Depth and length of each stretch under water."""
    under = drawdown < 0
    edge = np.flatnonzero(np.diff(np.r_[False, under, False]))
    starts, ends = edge[::2], edge[1::2]
    depth = np.abs(np.minimum.reduceat(drawdown, starts)) if len(starts) else np.array([])
    return depth, ends - starts


def _moments(r: np.ndarray) -> tuple[float, float]:
    """Unbiased skewness and excess kurtosis."""
    n = len(r)
    x = r - r.mean() if n else r
    m2 = (x**2).sum()
    if n < 3 or m2 <= TINY**2:
        return 0.0, 0.0
    skew = n * (n - 1) ** 0.5 / (n - 2) * (x**3).sum() / m2**1.5
    if n < 4:
        return skew, 0.0
    kurt = n * (n + 1) * (n - 1) / ((n - 2) * (n - 3)) * (x**4).sum() / m2**2 - 3 * (n - 1) ** 2 / ((n - 2) * (n - 3))
    return skew, kurt


def _hurst(x: np.ndarray) -> float:
    """Twice the slope of the logarithm of the spread of lagged differences over that of the lag."""
    if len(x) < HURST_LEAST:
        return 0.0
    lags = np.arange(HURST_LAGS[0], min(HURST_LAGS[1], len(x) // 2))
    spread = np.array([(x[k:] - x[:-k]).std() for k in lags])
    ok = spread > TINY
    return 2.0 * float(np.polyfit(np.log(lags[ok]), np.log(spread[ok]), 1)[0]) if ok.sum() > 2 else 0.0


def figures(at: np.ndarray, equity: np.ndarray, ret: np.ndarray, position: np.ndarray, bench: np.ndarray, volume: np.ndarray, risk_free: float) -> dict[str, float]:
    """All figures of one account, its bars in order; missing values are NaN. at is in nanoseconds."""
    step = np.median(np.diff(at)) if len(at) > 1 else 0
    year = max(1.0, DAYS_A_YEAR * DAY_NS / step) if step > 0 else float(DAYS_A_YEAR)
    n, r = len(equity), ret[~np.isnan(ret)]
    out = dict.fromkeys(PROFILES["industrial"], 0.0)
    total = equity[-1] / equity[0] - 1
    annual = (1 + total) ** (year / n) - 1 if total > -1 else -1.0
    vol = r.std() * year**0.5 if len(r) else 0.0
    drawdown = equity / np.maximum.accumulate(equity) - 1
    worst = drawdown.min()
    turnover = np.abs(np.diff(np.r_[0.0, np.nan_to_num(position)])).sum()
    per_year = turnover / n * year
    out |= {"total_return": total, "annual_return": annual, "volatility": vol, "sharpe": _over(annual - risk_free, vol), "max_drawdown": worst, "turnover": turnover, "turnover_annualized": per_year}

    down = r[r < 0].std() * year**0.5 if (r < 0).any() else 0.0
    out |= {"downside_volatility": down, "sortino": _over(annual, down), "calmar": _over(annual, abs(worst)), "mar_ratio": _over(annual, abs(worst)), "hit_rate_bar": (r > 0).mean() if len(r) else 0.0}
    usual = volume[~np.isnan(volume)].mean() if (~np.isnan(volume)).any() else 0.0
    room = max(usual, 0.0) * PARTICIPATION * DAYS_A_YEAR
    out["capacity_estimate"] = room / per_year if per_year > TINY else room
    both = ~np.isnan(ret) & ~np.isnan(bench)
    if both.any():
        s, b = ret[both], bench[both]
        active, spread = s - b, b.var()
        beta = ((s - s.mean()) * (b - b.mean())).mean() / spread if spread > TINY else 0.0
        error = active.std() * year**0.5
        grown = lambda x: (1 + x).prod() - 1
        capture = lambda leg: _over(grown(s[leg]), grown(b[leg])) if leg.any() else 0.0
        together = np.corrcoef(s, b)[0, 1] if s.std() > 0 and b.std() > 0 else 0.0
        out |= {
            "beta": beta, "alpha": (s.mean() - beta * b.mean()) * year if spread > TINY else 0.0, "tracking_error": error, "information_ratio": _over(active.mean() * year, error),
            "treynor": _over(annual - risk_free, beta), "up_market_capture": capture(b > 0), "down_market_capture": capture(b < 0), "r_squared": together**2,
        }

    if len(r):
        low, high = np.quantile(r, [0.05, 0.95])
        hurdle = risk_free / year
        over = r - hurdle
        skew, kurt = _moments(r)
        out |= {"skew": skew, "kurtosis": kurt, "var_95": low, "cvar_95": r[r <= low].mean(), "tail_ratio": _over(high, abs(low)), "omega_ratio": _over(over[over > 0].sum(), -over[over < 0].sum())}
    depth, length = _episodes(drawdown)
    if len(depth):
        out |= {
            "max_drawdown_duration_bars": float(length.max()), "avg_drawdown": drawdown[drawdown < 0].mean(), "ulcer_index": (drawdown[drawdown < 0] ** 2).mean() ** 0.5,
            "sterling_ratio": _over(annual, np.sort(depth)[::-1][:3].mean()), "burke_ratio": _over(annual, (depth**2).sum() ** 0.5),
        }
    held = np.abs(np.nan_to_num(position))
    moves = np.r_[0.0, np.divide(np.diff(equity), equity[:-1], out=np.zeros(n - 1), where=equity[:-1] != 0)]
    out |= {"recovery_factor": _over(total, abs(worst)), "hurst_exponent": _hurst(moves), "time_in_market": (held > TINY).mean(), "exposure": held.mean()}
    return {k: float(v) if np.isfinite(v) else 0.0 for k, v in out.items()}


def account_figures(bars: DataFrame, *, profile: str = "core", risk_free: float = 0.0) -> DataFrame:
    """One row per instrument: its number of bars, and the figures of the profile ('core', 'standard', 'industrial').

    bars: timestamp, instrument, equity, period_return, position, and for the larger profiles
    benchmark_return and volume where there are any. Bars are as many a year as their usual distance
    says. Bars without equity are left out; what divides by nothing is 0. An instrument's bars are in one task.
    """
    names = PROFILES[profile]
    inputs = ["equity", "period_return", "position", "benchmark_return", "volume"]
    have = [F.col(c).cast("double").alias(c) if c in bars.columns else F.lit(None).cast("double").alias(c) for c in inputs]
    df = bars.select(F.unix_micros(F.col(TS).cast("timestamp")).alias("at"), INST, *have).filter("equity is not null and not isnan(equity) and at is not null and instrument is not null")
    groups = group_count(bars, bytes_each=16 << 20)

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([(INST, "ascending"), ("at", "ascending")])
        code = t[INST].combine_chunks().dictionary_encode().indices.to_numpy()
        starts = np.flatnonzero(np.r_[True, np.diff(code) != 0])
        columns = [t["at"].to_numpy() * 1000, *[t[c].to_numpy().astype(float) for c in inputs]]
        rows = [figures(*(c[a:b] for c in columns), risk_free) for a, b in zip(starts, [*starts[1:], len(code)])]
        out = {INST: t[INST].take(pa.array(starts)), "bars": pa.array(np.diff(np.r_[starts, len(code)]), pa.int64())}
        return pa.table(out | {n: pa.array([r[n] for r in rows], pa.float64()) for n in names})

    keyed = df.withColumn("_g", F.pmod(F.xxhash64(INST), F.lit(groups))).repartition(task_count(groups, bars), "_g")
    return keyed.groupBy("_g").applyInArrow(run, "instrument string, bars long, " + ", ".join(f"{n} double" for n in names))


def trade_figures(ledger: DataFrame, result: str = "trade_return") -> DataFrame:
    """One row per instrument of a trade ledger: win rate, profit factor, expectancy, Kelly fraction, streak and excursions."""
    w = Window.partitionBy(INST).orderBy("entry")
    x = F.coalesce(F.col(result), F.lit(0.0))
    df = ledger.withColumn("_i", F.row_number().over(w)).withColumn("_x", x)
    df = df.withColumn("_run", F.col("_i") - F.coalesce(F.max(F.when(~(F.col("_x") < 0), F.col("_i"))).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    x = F.col("_x")
    won, lost = F.when(x > 0, x), F.when(x < 0, -x)
    out = df.groupBy(INST).agg(
        F.count("*").alias("trades"), F.avg((x > 0).cast("double")).alias("win_rate_trade"), F.coalesce(F.sum(won), F.lit(0.0)).alias("_won"), F.coalesce(F.sum(lost), F.lit(0.0)).alias("_lost"),
        F.coalesce(F.avg(won), F.lit(0.0)).alias("_win"), F.coalesce(F.avg(lost), F.lit(0.0)).alias("_loss"), F.max("_run").alias("max_consecutive_losses"),
        F.avg(F.col("bars").cast("double")).alias("avg_holding_period_bars"), F.avg(F.coalesce("mfe", F.lit(0.0))).alias("avg_mfe"), F.avg(F.coalesce("mae", F.lit(0.0))).alias("avg_mae"),
    )
    rate = F.col("win_rate_trade")
    kelly = F.when((F.col("_loss") > TINY) & (F.col("_win") > 0), rate - (1 - rate) / (F.col("_win") / F.col("_loss"))).otherwise(0.0)
    return out.select(
        INST, "trades", "win_rate_trade", F.when(F.col("_lost") > TINY, F.col("_won") / F.col("_lost")).otherwise(0.0).alias("profit_factor"), "max_consecutive_losses", "avg_holding_period_bars",
        (rate * F.col("_win") - (1 - rate) * F.col("_loss")).alias("expectancy"), kelly.alias("kelly_fraction"), "avg_mfe", "avg_mae",
    )
