"""A cross-sectional factor risk model, and portfolios that weigh return against it."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.ops import TS
from factorloom.operators.asof import as_of


def market_cap(prices: DataFrame, floats: DataFrame) -> DataFrame:
    """prices (timestamp, instrument, price) with cap: price times the free_float last known then."""
    return as_of(prices, floats, columns=["free_float"]).withColumn("cap", F.col("price") * F.col("free_float"))


def cross_sectional_wls(df: DataFrame, factors: Sequence[str], ret: str = "ret", cap: str = "cap", least: int | None = None) -> DataFrame:
    """Per date a regression of returns on factors weighted by the root of cap.

    Comes out long: timestamp, instrument, residual and the date's factor returns f_<name>, for every
    row that was used (all known, cap positive). Factors are clipped at three sample deviations and
    standardised per date. Dates with fewer than least rows (or factors, or 2) have none.
    """
    factors = list(factors)
    need = max(least or len(factors), 2)
    ddl = "timestamp " + dict(df.dtypes)[TS] + ", instrument string, residual double, " + ", ".join(f"f_{f} double" for f in factors)

    def one(t: pa.Table) -> pa.Table:
        t = t.sort_by("instrument")
        x = np.column_stack([t[f].to_numpy().astype(float) for f in factors])
        y, c = t[ret].to_numpy().astype(float), t[cap].to_numpy().astype(float)
        with np.errstate(invalid="ignore"):
            ok = np.isfinite(y) & np.isfinite(x).all(axis=1) & np.isfinite(c) & (c > 0)
        t, x, y, c = t.filter(pa.array(ok)), x[ok], y[ok], c[ok]
        if len(y) < need:
            t, x, y, beta = t.slice(0, 0), x[:0], y[:0], np.zeros(len(factors))
        else:
            sd = np.nan_to_num(x.std(axis=0, ddof=1))
            x = np.clip(x, x.mean(axis=0) - 3 * sd, x.mean(axis=0) + 3 * sd)
            sd = x.std(axis=0, ddof=1)
            x = (x - x.mean(axis=0)) / np.where((sd > 0) & np.isfinite(sd), sd, 1.0)
            w = np.sqrt(np.sqrt(c))[:, None]  # the root of the regression's weights
            beta = np.linalg.lstsq(x * w, y * w[:, 0], rcond=None)[0]
        columns = [t[TS], t["instrument"], pa.array(y - x @ beta), *[pa.array(np.full(len(y), b)) for b in beta]]
        return pa.table(columns, names=[TS, "instrument", "residual", *[f"f_{f}" for f in factors]])

    return df.select(TS, "instrument", *factors, ret, cap).groupBy(TS).applyInArrow(one, ddl)


def factor_returns(fitted: DataFrame) -> DataFrame:
    """One row per date of cross_sectional_wls."""
    return fitted.groupBy(TS).agg(*[F.max(c).alias(c) for c in fitted.columns if c.startswith("f_")])


def specific_risk(fitted: DataFrame) -> DataFrame:
    """instrument and specific_var of the latest date: expanding sample deviation of residuals, gaps by the date's median."""
    w = Window.partitionBy("instrument").orderBy(TS).rowsBetween(Window.unboundedPreceding, 0)
    sd = fitted.select(TS, "instrument", F.stddev_samp("residual").over(w).alias("sd"), F.max(TS).over(Window.partitionBy("instrument")).alias("_own_last"))
    sd = sd.filter(F.col(TS) == F.col("_own_last"))  # one row an instrument
    latest = sd.agg(F.max(TS).alias("_last"))
    sd = sd.join(F.broadcast(latest), F.col(TS) == F.col("_last"))  # one row
    median = F.percentile("sd", F.lit(0.5)).over(Window.partitionBy(TS))
    return sd.select("instrument", F.pow(F.coalesce("sd", median, F.lit(0.0)), F.lit(2.0)).alias("specific_var"))


def ewma_newey_west(returns: np.ndarray, half_life: float = 63, lags: int = 2) -> np.ndarray:
    """Covariance of factor returns (dates by factors, a bounded matrix): decaying weights, Bartlett lags, symmetric."""
    n = len(returns)
    if n < 2:
        raise ValueError("at least two dates are needed")
    w = 0.5 ** (np.arange(n - 1, -1, -1) / half_life)
    w /= w.sum()
    x = (returns - w @ returns) * np.sqrt(w)[:, None]
    out = x.T @ x
    for k in range(1, min(lags, n - 1) + 1):
        c = x[k:].T @ x[:-k]
        out += (1 - k / (lags + 1)) * (c + c.T)
    return (out + out.T) / 2


def factor_covariance(fitted: DataFrame, half_life: float = 63, lags: int = 2) -> tuple[list[str], np.ndarray]:
    """Names and covariance of the factors; one row a date comes to the driver."""
    r = factor_returns(fitted).orderBy(TS)
    names = [c for c in r.columns if c.startswith("f_")]
    return names, ewma_newey_west(np.array([[row[c] for c in names] for row in r.collect()], float), half_life, lags)


def total_risk(holdings: DataFrame, exposures: DataFrame, factors: Sequence[str], covariance: np.ndarray, specific: DataFrame, per_year: int = 252) -> DataFrame:
    """timestamp, factor_var, specific_var and annual risk of portfolios: w'XFX'w and the sum of w²δ.

    holdings: timestamp, instrument, weight; exposures: timestamp, instrument and factors.
    """
    df = holdings.join(exposures, [TS, "instrument"], "left").join(specific, "instrument", "left")
    # a name without a specific variance has the median of its date's
    median = F.percentile("specific_var", F.lit(0.5)).over(Window.partitionBy(TS))
    df = df.withColumn("specific_var", F.coalesce("specific_var", median, F.lit(0.0)))
    agg = [F.sum(F.col("weight") * F.coalesce(F.col(f), F.lit(0.0))).alias(f"_x{i}") for i, f in enumerate(factors)]
    out = df.groupBy(TS).agg(*agg, F.sum(F.col("weight") ** 2 * F.col("specific_var")).alias("specific_var"))
    quad = sum((F.col(f"_x{i}") * F.col(f"_x{j}") * float(covariance[i, j]) for i in range(len(factors)) for j in range(len(factors))), F.lit(0.0))
    return out.select(TS, quad.alias("factor_var"), "specific_var", F.sqrt((quad + F.col("specific_var")) * per_year).alias("annual_risk"))


def _capped(v: np.ndarray, budget: float, cap: float) -> np.ndarray:
    """The point nearest v with entries in [0, cap] that sum to budget (or to all that cap allows)."""
    if not len(v) or budget >= cap * len(v):
        return np.full(len(v), cap if len(v) else 0.0)
    # the shift t for which sum(clip(v - t, 0, cap)) is budget: that sum is linear between breakpoints
    up, top = np.sort(v)[::-1], np.sort(v - cap)[::-1]
    at = np.sort(np.concatenate([up, top]))[::-1]
    sums = []
    for x in (up, top):
        n = np.searchsorted(-x, -at, side="left")
        sums.append(np.r_[0.0, np.cumsum(x)][n] - n * at)
    total = sums[0] - sums[1]
    k = int(np.searchsorted(total, budget))
    if k == 0:
        return np.clip(v - at[0], 0, cap)
    k = min(k, len(at) - 1)
    rise = total[k] - total[k - 1]
    t = at[k] if rise <= 0 else at[k - 1] + (at[k] - at[k - 1]) * (budget - total[k - 1]) / rise
    return np.clip(v - t, 0, cap)


def mean_variance(mu: np.ndarray, x: np.ndarray, cov: np.ndarray, delta: np.ndarray, side: np.ndarray, *, aversion: float, long_budget: float, short_budget: float, cap: float, steps: int = 500) -> np.ndarray:
    """Weights maximising mu'w - aversion/2 (w'XFX'w + sum of w²δ) with signs, budgets per side and a cap per name.

    Accelerated projected gradient; the sides of a date are given (+1 long, -1 short).
    """
    w = np.zeros(len(mu))

    def project(v: np.ndarray) -> np.ndarray:
        out = np.zeros(len(v))
        for s, b in ((1, long_budget), (-1, short_budget)):
            m = side == s
            out[m] = s * _capped(s * v[m], b, cap)
        return out

    w = project(w)
    scale = aversion * (np.linalg.norm(x @ np.linalg.cholesky(cov + 1e-15 * np.eye(len(cov))), 2) ** 2 + (delta.max() if len(delta) else 0.0))
    rate = 1.0 / scale if scale > 0 else 1.0
    ahead, momentum = w, 1.0
    for _ in range(steps):
        g = mu - aversion * (x @ (cov @ (x.T @ ahead)) + delta * ahead)
        nxt = project(ahead + rate * g)
        if np.abs(nxt - w).max(initial=0.0) < 1e-11:
            return nxt
        faster = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead = nxt + (momentum - 1) / faster * (nxt - w)
        w, momentum = nxt, faster
    return w


def optimize(df: DataFrame, factors: Sequence[str], covariance: np.ndarray, *, aversion: float = 1.0, long_budget: float = 0.5, short_budget: float = 0.5, cap: float = 0.1) -> DataFrame:
    """timestamp, instrument, weight per date of df (timestamp, instrument, alpha, side, specific_var, factors).

    side is 'LONG' or 'SHORT'; rows with a missing input keep no weight. A date whose problem can't
    be solved has equal weights on each side.
    """
    factors = list(factors)

    def one(t: pa.Table) -> pa.Table:
        t = t.sort_by("instrument")
        x = np.column_stack([t[f].to_numpy().astype(float) for f in factors])
        mu, delta = t["alpha"].to_numpy().astype(float), t["specific_var"].to_numpy().astype(float)
        side = np.array([{"LONG": 1, "SHORT": -1}.get(s, 0) for s in t["side"].to_pylist()])
        ok = np.isfinite(x).all(axis=1) & np.isfinite(mu) & np.isfinite(delta) & (side != 0)
        w = np.zeros(len(mu))
        try:
            w[ok] = mean_variance(mu[ok], x[ok], covariance, delta[ok], side[ok], aversion=aversion, long_budget=long_budget, short_budget=short_budget, cap=cap)
        except np.linalg.LinAlgError:
            for s, b in ((1, long_budget), (-1, short_budget)):
                m = ok & (side == s)
                w[m] = s * b / max(m.sum(), 1)
        return pa.table({TS: t[TS], "instrument": t["instrument"], "weight": w})

    cols = df.select(TS, "instrument", "alpha", "side", "specific_var", *factors)
    return cols.groupBy(TS).applyInArrow(one, f"timestamp {dict(df.dtypes)[TS]}, instrument string, weight double")
