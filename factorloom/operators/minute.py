"""Evaluation of an intraday factor, per instrument: labels, forward returns, layered groups, holding returns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.common import group_count, task_count
from factorloom.functions.ops import INST, TS, R, W, clip, div, gate, nonzero, pct_rank
from factorloom.operators.evaluation import correlation, cumulative

# Bounds of the session's parts as HHMM.
OPEN_START, OPEN_END, CLOSE_START, SESSION_END = 930, 1000, 1530, 1600
RANK_BLOCK = 2048  # windows that are ranked at once


def day_of(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date(TS))


def _in_day():
    return Window.partitionBy(INST, "date").orderBy(TS)


def vwap_reversion(df: DataFrame, price: str = "close", average: str = "average", volume: str = "volume", warm_up: int = 5) -> DataFrame:
    """cum_vwap of the day so far and factor, minus the price's relative distance from it; none for the day's first bars."""
    run = _in_day().rowsBetween(Window.unboundedPreceding, 0)
    df = day_of(df)
    df = df.withColumn("cum_vwap", div(F.sum(F.col(average) * F.col(volume)).over(run), F.sum(volume).over(run)))
    factor = -div(F.col(price) - F.col("cum_vwap"), F.col("cum_vwap"))
    return df.withColumn("factor", F.when(F.row_number().over(_in_day()) > warm_up, factor))


def overlap(factor: DataFrame, market: DataFrame) -> DataFrame:
    """Both series side by side on the union of their times within the range that both cover, per instrument."""
    span = lambda d, s: d.groupBy(INST).agg(F.min(TS).alias(f"a{s}"), F.max(TS).alias(f"b{s}"))
    common = span(factor, 1).join(span(market, 2), INST).select(INST, F.greatest("a1", "a2").alias("_a"), F.least("b1", "b2").alias("_b"))
    both = factor.join(market, [TS, INST], "full_outer").join(common, INST)
    return both.filter(F.col(TS).between(F.col("_a"), F.col("_b"))).drop("_a", "_b")


def rolling_z(x: Column, d: int) -> Column:
    """Standardised over the last d bars by the population deviation; needs all of them."""
    return gate(div(x - F.avg(x).over(R(d)), nonzero(F.stddev_pop(x).over(R(d)))), x, R(d), d)


def forward_return(x: Column, h: int) -> Column:
    """From the next bar to h bars after it, across days."""
    return div(F.lead(x, h + 1).over(W()), F.lead(x, 1).over(W())) - 1


def eligible(h: int) -> Column:
    """Whether more than h bars of the day follow; needs date."""
    return F.row_number().over(_in_day()) - 1 < F.count("*").over(Window.partitionBy(INST, "date")) - h


def winsorize_by_day(x: Column, q: float) -> Column:
    day = Window.partitionBy(INST, "date")
    return clip(x, F.percentile(x, F.lit(q)).over(day), F.percentile(x, F.lit(1 - q)).over(day))


def prepare(df: DataFrame, factor: str, price: str, *, horizon: int, z_window: int, q: float = 0.01) -> DataFrame:
    """factor_z, target_ret, and factor_eval and target_eval on the bars that have horizon bars of their day after them."""
    df = day_of(df).withColumn("factor_z", rolling_z(F.col(factor), z_window)).withColumn("target_ret", forward_return(F.col(price), horizon))
    df = df.withColumn("_ok", eligible(horizon))
    df = df.withColumn("factor_eval", F.when(F.col("_ok"), F.col("factor_z"))).withColumn("target_eval", F.when(F.col("_ok"), F.col("target_ret"))).drop("_ok")
    return df.withColumn("factor_eval", winsorize_by_day(F.col("factor_eval"), q))


def session_label(ts: Column) -> Column:
    """OPEN, MID, CLOSE or OFF by the time of day."""
    t = F.hour(ts) * 100 + F.minute(ts)
    return F.when((t >= OPEN_START) & (t < OPEN_END), "OPEN").when((t >= OPEN_END) & (t < CLOSE_START), "MID").when((t >= CLOSE_START) & (t < SESSION_END), "CLOSE").otherwise("OFF")


def rolling_rank(df: DataFrame, column: str, d: int, out: str) -> DataFrame:
    """Average rank of each known value among the last d known ones, over d; null until there are d.

    Frames are ranked in numpy: views sliding along each instrument, RANK_BLOCK bars at a time.
    """
    schema = df.schema.add(out, "double")
    groups = group_count(df, bytes_each=16 << 20)

    def run(t: pa.Table) -> pa.Table:
        t = t.select(schema.names[:-1]).sort_by([(INST, "ascending"), (TS, "ascending")])
        code = t[INST].combine_chunks().dictionary_encode().indices.to_numpy()
        x = t[column].to_numpy().astype(float)
        res = np.full(len(x), np.nan)
        known = np.nonzero(~np.isnan(x))[0]
        starts = np.flatnonzero(np.r_[True, np.diff(code[known]) != 0]) if len(known) else np.array([], int)
        for a, b in zip(starts, [*starts[1:], len(known)]):
            at = known[a:b]
            for lo in range(0, len(at) - d + 1, RANK_BLOCK):
                own = x[at[lo : lo + RANK_BLOCK + d - 1]]
                window = np.lib.stride_tricks.sliding_window_view(own, d)
                v = window[:, -1:]
                res[at[lo + d - 1 : lo + d - 1 + len(window)]] = ((window < v).sum(axis=1) + 1 + (window <= v).sum(axis=1)) / 2 / d
        return t.append_column(out, pa.array(res, from_pandas=True))

    keyed = df.withColumn("_g", F.pmod(F.xxhash64(INST), F.lit(groups)))
    return keyed.repartition(task_count(groups, df), "_g").groupBy("_g").applyInArrow(run, schema)


def volatility_regime(df: DataFrame, price: str, d: int = 120, rank_over: int = 7200, low: float = 1 / 3, high: float = 2 / 3) -> DataFrame:
    """regime LV, MV or HV: the rolling rank of the deviation of log returns over d bars."""
    r = F.ln(div(F.col(price), F.lag(price).over(W())))
    df = df.withColumn("_r", r)
    df = df.withColumn("_vol", gate(F.stddev_samp("_r").over(R(d)), F.col("_r"), R(d), d)).drop("_r")
    df = rolling_rank(df, "_vol", rank_over, "_p").drop("_vol")
    p = F.col("_p")
    return df.withColumn("regime", F.when(p.isNotNull(), F.when(p < low, "LV").when(p >= high, "HV").otherwise("MV"))).drop("_p")


def layer_groups(df: DataFrame, column: str, n: int, d: int) -> DataFrame:
    """group 1 to n by the rolling rank of the factor."""
    df = rolling_rank(df, column, d, "_p")
    return df.withColumn("group", F.greatest(F.least(F.ceil(F.col("_p") * n), F.lit(n)), F.lit(1)).cast("int")).withColumn("group", F.when(F.col("_p").isNotNull(), F.col("group"))).drop("_p")


def layered_returns(df: DataFrame, target: str, horizon: int, keys: Sequence[str] = (INST,)) -> DataFrame:
    """Mean return of a bar per group: that of the horizon, spread evenly."""
    return df.filter(F.col("group").isNotNull() & F.col(target).isNotNull()).groupBy(*keys, "group").agg((F.pow(1 + F.avg(target), F.lit(1.0 / horizon)) - 1).alias("avg_single_period_ret"))


def daily_ic(df: DataFrame, x: str, y: str, least: int = 30, keys: Sequence[str] = (INST, "date")) -> DataFrame:
    """ic and rank_ic per instrument and day of at least so many known pairs."""
    v = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, F.col(x).alias("x"), F.col(y).alias("y"))
    v = v.withColumns({"rx": pct_rank(F.col("x"), *keys), "ry": pct_rank(F.col("y"), *keys)})
    out = v.groupBy(*keys).agg(correlation(F.col("x"), F.col("y")).alias("ic"), correlation(F.col("rx"), F.col("ry")).alias("rank_ic"), F.count("*").alias("n"))
    return out.filter(F.col("n") >= least)


def capped_positions(long: np.ndarray, short: np.ndarray, horizon: int) -> np.ndarray:
    """A trigger opens a position of horizon bars; triggers while one is held are passed over; long before short."""
    out = np.zeros(len(long))
    free = 0
    for i in np.nonzero(long | short)[0]:
        if i >= free:
            out[i : i + horizon] = 1.0 if long[i] else -1.0
            free = i + horizon
    return out


def holding_pnl(df: DataFrame, price: str, n: int, horizon: int, fee_rate: float = 0.0) -> DataFrame:
    """df with net_position, pnl, transaction_cost and cum_pnl of holding the top group long, the bottom one short.

    A group triggers the bar after it. pnl is the position times the next bar's return, less fee_rate
    times the change of position.
    """
    schema = df.schema.add("net_position", "double")
    groups = group_count(df, bytes_each=16 << 20)

    def run(t: pa.Table) -> pa.Table:
        t = t.select(schema.names[:-1]).sort_by([(INST, "ascending"), (TS, "ascending")])
        code = t[INST].combine_chunks().dictionary_encode().indices.to_numpy()
        g = t["group"].to_numpy().astype(float)
        pos = np.zeros(len(g))
        starts = np.flatnonzero(np.r_[True, np.diff(code) != 0]) if len(code) else np.array([], int)
        for a, b in zip(starts, [*starts[1:], len(code)]):
            before = np.r_[np.nan, g[a : b - 1]]
            pos[a:b] = capped_positions(before == n, before == 1, horizon)
        return t.append_column("net_position", pa.array(pos))

    keyed = df.withColumn("_g", F.pmod(F.xxhash64(INST), F.lit(groups))).repartition(task_count(groups, df), "_g")
    out = keyed.groupBy("_g").applyInArrow(run, schema)
    step = F.abs(F.col("net_position") - F.coalesce(F.lag("net_position").over(W()), F.lit(0.0)))
    out = out.withColumn("transaction_cost", step * fee_rate)
    out = out.withColumn("pnl", F.coalesce(F.col("net_position") * (div(F.lead(price).over(W()), F.col(price)) - 1), F.lit(0.0)) - F.col("transaction_cost"))
    return out.withColumn("cum_pnl", cumulative(F.col("pnl"), W().rowsBetween(Window.unboundedPreceding, 0)))


def holding_stats(df: DataFrame, per_year: float = 252.0, keys: Sequence[str] = (INST,)) -> DataFrame:
    """sharpe, max_drawdown, annual_return, turnover and win_rate of holding_pnl."""
    w = Window.partitionBy(*keys).orderBy(TS).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_dd", F.col("cum_pnl") / F.max("cum_pnl").over(w) - 1)
    change = F.abs(F.col("net_position") - F.coalesce(F.lag("net_position").over(Window.partitionBy(*keys).orderBy(TS)), F.lit(0.0)))
    df = df.withColumn("_c", change)
    last, n = F.max_by("cum_pnl", TS), F.count("*")
    return df.groupBy(*keys).agg(
        (F.try_divide(F.avg("pnl"), nonzero(F.stddev_samp("pnl"))) * per_year**0.5).alias("sharpe"), F.min("_dd").alias("max_drawdown"),
        F.when(last > 0, F.pow(last, per_year / n) - 1).alias("annual_return"), F.avg("_c").alias("turnover"), F.avg(F.when(F.col("net_position") != 0, (F.col("pnl") > 0).cast("double"))).alias("win_rate"),
    )


def downsample(df: DataFrame, sums: Sequence[str] = (), lasts: Sequence[str] = (), means: Sequence[str] = ()) -> DataFrame:
    """One row per instrument and day: sums, last known values and means of the columns."""
    aggs = [F.sum(c).alias(c) for c in sums] + [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(TS))).alias(c) for c in lasts] + [F.avg(c).alias(c) for c in means]
    return day_of(df).groupBy(INST, "date").agg(*aggs)
