"""Timing signals per instrument, position machines, and execution with costs.

Signals are expressions of the factor language; machines and execution recur along time and run as
kernels, all instruments of a block at once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.kernels import ema, kernel, lagged
from factorloom.functions.ops import INST, R, TS, W, div, gate, pct_rank
from factorloom.plans.compiler import compute, run_kernels


LEAST_DEVIATION, LEAST_LOSS, LEAST_MEDIAN = 1e-8, 1e-10, 1e-10  # floors of what signals are divided by


def _squashed(x, deviation):
    """The tanh of x over a deviation, which is taken as LEAST_DEVIATION at least; null where either is."""
    return F.when(deviation.isNotNull(), F.tanh(x / F.greatest(deviation, F.lit(LEAST_DEVIATION))))


def dual_ma_signal(panel: DataFrame, fast: int = 5, slow: int = 20, ema: bool = False, price: str = "close") -> DataFrame:
    """signal: the tanh of the averages' relative gap over its deviation in 2 * slow bars (slow of them known)."""
    f = "ts_ema" if ema else "ts_mean"
    gap = f'({f}(col("{price}"), {fast}) - {f}(col("{price}"), {slow})) / {f}(col("{price}"), {slow})'
    return compute(panel, {"gap": gap, "sd": f"ts_std({gap}, {2 * slow}, min_periods={slow})"}).select(TS, INST, _squashed(F.col("gap"), F.col("sd")).alias("signal"))


def macd_signal(panel: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, price: str = "close") -> DataFrame:
    hist = f'ts_macd(col("{price}"), {fast}, {slow}, {signal}, line="hist")'
    return compute(panel, {"h": hist, "sd": f"ts_std({hist}, {2 * slow}, min_periods={slow})"}).select(TS, INST, _squashed(F.col("h"), F.col("sd")).alias("signal"))


@kernel("_relative_strength", "@x, d")
def _relative_strength(x, d):
    """RSI with a floor under the mean loss, so that no loss at all is 100; there after d known steps."""
    step = x - lagged(x)
    with np.errstate(invalid="ignore"):
        gain, loss = ema(np.maximum(step, 0.0), 1.0 / d), ema(np.maximum(-step, 0.0), 1.0 / d)
        out = 100.0 - 100.0 / (1.0 + gain / np.maximum(loss, LEAST_LOSS))
    return np.where(np.cumsum(~np.isnan(step), axis=1) >= d, out, np.nan)


def rsi_signal(panel: DataFrame, period: int = 14, upper: float = 70, lower: float = 30, price: str = "close") -> DataFrame:
    """Against the extremes: the tanh of minus RSI's distance from the middle of its bounds."""
    mid, half = (upper + lower) / 2, max((upper - lower) / 2, 1e-6)
    out = run_kernels(panel.select(TS, INST, price), [("_r", "_relative_strength", [price], {"d": period})])
    return out.select(TS, INST, F.tanh(-(F.col("_r") - mid) / half).alias("signal"))


def factor_signal(panel: DataFrame, weights: dict[str, float], d: int = 60, standardise: bool = True) -> DataFrame:
    """The tanh of the weighted mean of the factors' rolling z-scores (of d bars, half of them known); null if one is."""
    z = lambda f: gate((F.col(f) - F.avg(f).over(R(d))) / F.greatest(F.stddev_samp(f).over(R(d)), F.lit(LEAST_DEVIATION)), F.col(f), R(d), max(d // 2, 2))
    total = sum(map(abs, weights.values())) or 1.0
    return panel.select(TS, INST, F.tanh(sum(((z(f) if standardise else F.col(f)) * (w / total) for f, w in weights.items()), F.lit(0.0))).alias("signal"))


def combine_signals(signals: dict[str, DataFrame], weights: dict[str, float] | None = None, how: str = "weighted_avg") -> DataFrame:
    """The tanh of the weighted mean of signals by key, a missing one counting 0.

    With how 'rank_avg' each signal is replaced by its rank over the instrument's bars, from -1 to 1, and
    a missing one makes the result missing.
    """
    from factorloom.operators.asof import one_panel

    wide = one_panel({n: s.withColumnRenamed("signal", "value") for n, s in signals.items()})
    weights = weights or dict.fromkeys(signals, 1.0)
    total = sum(map(abs, weights.values())) or 1.0
    if how == "rank_avg":
        wide = wide.withColumns({n: pct_rank(F.col(n), INST) * 2 - 1 for n in signals})
    elif how != "weighted_avg":
        raise ValueError(f"unknown way to combine signals: {how!r}")
    part = (lambda n: F.col(n)) if how == "rank_avg" else (lambda n: F.coalesce(F.col(n), F.lit(0.0)))
    return wide.select(TS, INST, F.tanh(sum((part(n) * (w / total) for n, w in weights.items()), F.lit(0.0))).alias("signal"))


@kernel("_machine", "@signal, @long_entry, @long_exit, @short_entry, @short_exit, @size, short")
def _machine(x, long_entry, long_exit, short_entry, short_exit, size, short):
    """The position after each bar: entered at a bound or beyond it, left at the exit's, turned over where
    the signal is at the other entry too; a missing signal holds it, a held one follows the size."""
    out = np.zeros(x.shape)
    pos = np.zeros(len(x))
    size = np.where(np.isnan(size), 0.5, size)
    for t in range(x.shape[1]):
        z, s = x[:, t], size[:, t]
        with np.errstate(invalid="ignore"):
            buys, sells = z >= long_entry[:, t], short & (z <= short_entry[:, t])
            leaves, covers = z <= long_exit[:, t], z >= short_exit[:, t]
        flat = np.where(buys, s, np.where(sells, -s, 0.0))
        held = np.where(leaves, np.where(sells, -s, 0.0), s)
        owed = np.where(covers, np.where(buys, s, 0.0), -s)
        nxt = np.where(pos == 0, flat, np.where(pos > 0, held, owed))
        pos = np.where(np.isnan(z) | np.isnan(long_entry[:, t]), pos, nxt)
        out[:, t] = pos
    return out


def _positions(df: DataFrame, short: bool, shift: int) -> DataFrame:
    """timestamp, instrument, signal and target_position (both shift bars later, 0 at first) and the bar's own action."""
    names = ["long_entry", "long_exit", "short_entry", "short_exit", "size"]
    out = run_kernels(df.select(TS, INST, "signal", *names), [("_p", "_machine", ["signal", *names], {"short": short})], drop=names)
    p, b = F.col("_p"), F.coalesce(F.lag("_p").over(W()), F.lit(0.0))
    action = F.when((p > 0) & (b <= 0), "ENTRY_LONG").when((p < 0) & (b >= 0), "ENTRY_SHORT").when((p == 0) & (b > 0), "EXIT_LONG").when((p == 0) & (b < 0), "EXIT_SHORT").otherwise("HOLD")
    later = lambda c: F.coalesce(F.lag(c, shift).over(W()) if shift else F.col(c), F.lit(0.0))
    return out.select(TS, INST, later("signal").alias("signal"), later("_p").alias("target_position"), action.alias("action"))


def threshold_positions(
    signal: DataFrame, long_entry: float = 0.5, long_exit: float = 0.0, short_entry: float = -0.5, short_exit: float = 0.0, *, short: bool = False, size: float = 1.0, shift: int = 1
) -> DataFrame:
    """target_position with hysteresis between four thresholds, acting shift bars later; a missing signal holds."""
    bounds = {"long_entry": long_entry, "long_exit": long_exit, "short_entry": short_entry, "short_exit": short_exit, "size": size}
    return _positions(signal.withColumns({n: F.lit(float(v)) for n, v in bounds.items()}), short, shift)


def atr_positions(
    panel: DataFrame,
    signal: DataFrame,
    *,
    d: int = 14,
    long_entry: float = 0.5,
    short_entry: float = -0.5,
    exit_ratio: float = 0.4,
    power: float = 1.0,
    target_volatility: float = 0.15,
    short: bool = False,
    most: float = 1.0,
    least: float = 0.1,
    per_year: float = 252,
    shift: int = 1,
) -> DataFrame:
    """Positions whose thresholds rise with the average true range over its median of 10 d bars, and whose
    size is the target over the realised volatility of 2 d bars, between least and most."""
    before = F.lag("close").over(W())
    df = panel.select(TS, INST, F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)).alias("_tr"), (div(F.col("close"), before) - 1).alias("_r"))
    df = df.select(TS, INST, gate(F.avg("_tr").over(R(d)), F.col("_tr"), R(d), d).alias("_a"), gate(F.stddev_samp("_r").over(R(2 * d)), F.col("_r"), R(2 * d), d).alias("_v"))
    median = gate(F.percentile("_a", F.lit(0.5)).over(R(10 * d)), F.col("_a"), R(10 * d), 2 * d)
    ratio = F.pow(F.coalesce(F.col("_a") / F.greatest(median, F.lit(LEAST_MEDIAN)) * F.when(median.isNotNull(), 1), F.lit(1.0)), power)
    size = F.greatest(F.least(target_volatility / F.greatest(F.col("_v") * per_year**0.5, F.lit(0.01)), F.lit(float(most))), F.lit(float(least)))
    bounds = df.select(TS, INST, ratio.alias("_k"), F.when(F.col("_v").isNotNull(), size).alias("size"))
    df = signal.join(bounds, [TS, INST], "left")
    k = F.coalesce("_k", F.lit(1.0))
    df = df.withColumns({"long_entry": long_entry * k, "long_exit": long_entry * exit_ratio * k, "short_entry": short_entry * k, "short_exit": short_entry * exit_ratio * k})
    return _positions(df, short, shift)


def debounce(df: DataFrame, column: str = "target_position") -> DataFrame:
    """The rows where the position differs from the one before (by more than 1e-9), and each instrument's first."""
    moved = F.coalesce(F.abs(F.col(column) - F.lag(column).over(W())) > 1e-9, F.lit(False))
    return df.withColumn("_b", (F.row_number().over(W()) == 1) | moved).filter("_b").drop("_b")


def check_positions(df: DataFrame, column: str = "target_position") -> DataFrame:
    """One row: missing, out_of_range (beyond ±1) and repeated keys; all 0 in a sound table."""
    bad = df.agg(F.count(F.when(F.col(column).isNull() | F.isnan(column), 1)).alias("missing"), F.count(F.when(F.abs(column) > 1, 1)).alias("out_of_range"))
    twice = df.groupBy(TS, INST).count().filter("count > 1").agg(F.count("*").alias("repeated"))
    return bad.withColumn("_", F.lit(1)).join(twice.withColumn("_", F.lit(1)), "_").drop("_")


def valid_targets(targets: DataFrame, column: str = "target_position", *, strict: bool = True, bounds: bool = True) -> DataFrame:
    """timestamp, instrument and column, a missing value being the one before it, or 0 at first.

    A repeated key is a ValueError; so is, with bounds, a value beyond 1 in size, which is cut to it
    instead if not strict.
    """
    c = F.col(column).cast("double")
    known = F.when(~F.isnan(c), c)
    state = targets.agg(F.count(F.when(F.abs(known) > 1, 1)).alias("n")).first().n if bounds and strict else 0
    if state:
        raise ValueError(f"{state} values of {column} are beyond 1 in size")
    if targets.groupBy(TS, INST).count().filter("count > 1").limit(1).count():
        raise ValueError("a key has several rows")
    filled = F.coalesce(F.last(known, ignorenulls=True).over(W().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0))
    return targets.select(TS, INST, (F.greatest(F.least(filled, F.lit(1.0)), F.lit(-1.0)) if bounds else filled).alias(column))


def align_targets(targets: DataFrame, bars: DataFrame, column: str = "target_position") -> DataFrame:
    """timestamp, instrument and column for each bar: the target at its very time, else the last bar's, 0 at first."""
    df = bars.select(TS, INST).join(targets.select(TS, INST, column), [TS, INST], "left")
    filled = F.last(column, ignorenulls=True).over(W().rowsBetween(Window.unboundedPreceding, 0))
    return df.select(TS, INST, F.coalesce(filled, F.lit(0.0)).alias(column))


@kernel("_executed_weight", "@target, @cap, min_trade")
def _executed_weight(target, cap, min_trade):
    """The weight that is held after each bar: small trades are skipped, large ones cut to the bar's cap (NaN: none)."""
    out = np.full(target.shape, np.nan)
    held = np.zeros(len(target))
    for t in range(target.shape[1]):
        trade = np.nan_to_num(target[:, t] - held)
        trade = np.where(np.abs(trade) < min_trade, 0.0, trade)
        most = np.where(np.isnan(cap[:, t]), np.inf, cap[:, t])
        held = held + np.clip(trade, -most, most)
        out[:, t] = held
    return out


def multi_asset_backtest(
    targets: DataFrame,
    bars: DataFrame,
    *,
    lag: int = 1,
    min_trade: float = 0.0,
    adv_share: float | None = None,
    capital: float = 1e6,
    fee_rate: float = 0.0005,
    impact: str = "none",
    impact_rate: float = 0.1,
    half_turnover: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(weights, returns): executed weights per key, and per date gross and net return, cost, turnover, participation, nav.

    targets: timestamp, instrument, target_weight; bars: timestamp, instrument, close, volume. A bar
    without a target keeps the last one. With adv_share a trade is at most that share of the bar's own
    close times volume, over capital; where these are missing or not positive, nothing trades. Turnover
    is the sum of changes, or half of it. Cost is fee_rate of it plus, by impact, nothing, or impact_rate
    times each change times its part of the cap ('linear') or the square of that ('square'); without a
    cap no part is taken. Weights act lag bars later.
    """
    df = bars.select(TS, INST, "close", "volume").join(targets.select(TS, INST, "target_weight"), [TS, INST], "left")
    cap = F.lit(None).cast("double") if adv_share is None else F.coalesce(F.greatest(F.col("close") * F.col("volume"), F.lit(0.0)), F.lit(0.0)) * (adv_share / capital)
    df = df.withColumn("_t", F.coalesce(F.last("target_weight", ignorenulls=True).over(W().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0))).withColumn("_cap", cap)
    df = run_kernels(df, [("weight", "_executed_weight", ["_t", "_cap"], {"min_trade": min_trade})])
    trade = F.abs(F.col("weight") - F.coalesce(F.lag("weight").over(W()), F.lit(0.0)))
    df = df.withColumns({"_trade": trade, "_ret": div(F.col("close"), F.lag("close").over(W())) - 1, "_held": F.lag("weight", lag).over(W())})
    df = df.withColumn("_part", F.when(F.col("_cap") > 0, F.col("_trade") / F.col("_cap")).otherwise(0.0))
    push = {"none": F.lit(0.0), "linear": F.col("_part"), "square": F.col("_part") ** 2}[impact] * impact_rate
    daily = df.groupBy(TS).agg(
        F.sum(F.coalesce(F.col("_held") * F.col("_ret"), F.lit(0.0))).alias("gross_return"), (F.sum("_trade") * (0.5 if half_turnover else 1.0)).alias("turnover"),
        F.sum(F.col("_trade") * push).alias("impact_cost"), F.max("_part").alias("participation"), F.sum(F.abs("weight")).alias("gross_leverage"),
    )
    daily = daily.withColumn("cost", F.col("turnover") * fee_rate + F.col("impact_cost")).withColumn("net_return", F.col("gross_return") - F.col("cost"))
    run = Window.partitionBy(F.lit(1)).orderBy(TS).rowsBetween(Window.unboundedPreceding, 0)  # one row a date
    return df.select(TS, INST, "weight"), daily.withColumn("nav", F.product(1 + F.col("net_return")).over(run))


def trade_ledger(positions: DataFrame, price: str = "close", high: str = "high", low: str = "low", position: str = "target_position") -> DataFrame:
    """A row per stretch of one sign of position: entry, exit, bars held, return, best and worst excursion.

    Excursions are those of the bars' highs and lows from the entry price, 0 at least and at most; a short
    one's are the entry price over them.
    """
    side = F.signum(F.coalesce(F.col(position), F.lit(0.0)))
    df = positions.withColumn("_s", side)
    df = df.withColumn("_new", (F.col("_s") != F.coalesce(F.lag("_s").over(W()), F.lit(0.0))).cast("int"))
    df = df.withColumn("_trade", F.sum("_new").over(W().rowsBetween(Window.unboundedPreceding, 0))).filter("_s <> 0")
    p = F.col(price)
    out = df.groupBy(INST, "_trade").agg(
        F.min(TS).alias("entry"), F.max(TS).alias("exit"), F.max("_s").alias("side"), F.count("*").alias("bars"), F.min_by(p, TS).alias("entry_price"), F.max_by(p, TS).alias("exit_price"), F.max(high).alias("_hi"), F.min(low).alias("_lo")
    )
    entry = F.when(F.col("entry_price") > 0, F.col("entry_price"))
    to = lambda x: F.when(F.col("side") > 0, F.col(x) / entry).otherwise(entry / F.greatest(F.col(x), F.lit(1e-12))) - 1
    best, worst = F.when(F.col("side") > 0, to("_hi")).otherwise(to("_lo")), F.when(F.col("side") > 0, to("_lo")).otherwise(to("_hi"))
    move = (F.try_divide(F.col("exit_price"), F.col("entry_price")) - 1) * F.col("side")
    return out.select(INST, "entry", "exit", "side", "bars", "entry_price", "exit_price", move.alias("trade_return"), F.greatest(best, F.lit(0.0)).alias("mfe"), F.least(worst, F.lit(0.0)).alias("mae"))


@kernel("_equity", "@target, @open, @close, start, commission, slippage, borrow, min_change")
def _equity(target, open_, close, start, commission, slippage, borrow, min_change):
    """Account value after each bar: a changed target is filled at the next bar's open, shorts pay borrow."""
    out = np.full(target.shape, np.nan)
    cash, shares = np.full(len(target), float(start)), np.zeros(len(target))
    pending, asked = np.full(len(target), np.nan), np.zeros(len(target))
    for t in range(target.shape[1]):
        o, c = open_[:, t], close[:, t]
        go = ~np.isnan(pending) & np.isfinite(o) & (o > 0)
        value = cash + shares * np.nan_to_num(o)
        want = np.where(go, pending * value / np.where(go, o, 1.0), shares)
        trade = want - shares
        fill = np.where(go, o, 0.0) * (1 + np.sign(trade) * slippage)
        cash = cash - trade * fill - np.abs(trade * fill) * commission
        shares = want
        pending = np.where(go, np.nan, pending)
        mark = np.isfinite(c)
        cash = cash - np.where(mark & (shares < 0), np.abs(shares) * np.nan_to_num(c) * borrow, 0.0)
        out[:, t] = np.where(mark, cash + shares * np.nan_to_num(c), np.nan)
        z = target[:, t]
        change = ~np.isnan(z) & (np.abs(z - asked) > min_change)
        pending, asked = np.where(change, z, pending), np.where(change, z, asked)
    return out


def single_asset_backtest(df: DataFrame, *, start: float = 1e5, commission: float = 0.0005, slippage: float = 0.0002, borrow: float = 0.0, min_change: float = 1e-9) -> DataFrame:
    """timestamp, instrument, equity and period_return of target_position filled at the next open (open, close)."""
    params = {"start": start, "commission": commission, "slippage": slippage, "borrow": borrow, "min_change": min_change}
    cols = df.select(TS, INST, "target_position", "open", "close")
    out = run_kernels(cols, [("equity", "_equity", ["target_position", "open", "close"], params)])
    return out.select(TS, INST, "equity", (div(F.col("equity"), F.lag("equity").over(W())) - 1).alias("period_return"))
