"""Holdings from signals, the portfolio's daily returns, and what they come to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.common import broadcast_if_small, cut_lineage
from factorloom.functions.ops import TS, div, nonzero
from factorloom.operators.evaluation import cumulative


# The columns of backtest that the figures of turnover, exposure, cost and coverage sum up.
BACKTEST_COLUMNS = ["turnover", "holdings_count", "long_exposure", "short_exposure", "net_exposure", "gross_exposure", "trading_cost", "holding_cells", "valid_holding_cells", "asset_return_coverage"]


def allocate(signal: DataFrame, *, long_budget: float = 0.5, short_budget: float = 0.5, by_score: bool = True, floor: float = 1e-12, gross: float | None = None) -> DataFrame:
    """timestamp, instrument and weight of the selected rows: each side shares its budget equally or by |score|.

    With gross the weights of a date are scaled to that sum of sizes.
    """
    s = signal.filter("selected_flag and side in ('LONG', 'SHORT')")
    part = F.greatest(F.abs("composite_score"), F.lit(floor)) if by_score else F.lit(1.0)
    s = s.withColumn("_p", part)
    share = F.col("_p") / F.sum("_p").over(Window.partitionBy(TS, "side"))
    s = s.withColumn("weight", share * F.when(F.col("side") == "LONG", long_budget).otherwise(-short_budget))
    if gross is not None:
        s = s.withColumn("weight", div(F.col("weight") * gross, nonzero(F.sum(F.abs("weight")).over(Window.partitionBy(TS)))))
    return s.select(TS, "instrument", "weight")


def exposures(holdings: DataFrame) -> DataFrame:
    """Per date: holdings_count, long, short, net and gross exposure."""
    w = F.col("weight")
    return holdings.groupBy(TS).agg(
        F.count(F.when(w != 0, 1)).alias("holdings_count"), F.sum(F.greatest(w, F.lit(0.0))).alias("long_exposure"), F.sum(F.greatest(-w, F.lit(0.0))).alias("short_exposure"),
        F.sum(w).alias("net_exposure"), F.sum(F.abs(w)).alias("gross_exposure"),
    )


def backtest(holdings: DataFrame, prices: DataFrame, *, window: int = 1, cost_rate: float = 0.0005, tradable: DataFrame | None = None) -> DataFrame:
    """A row per date of holdings or prices: returns, cost, turnover, exposures, coverage, nav and drawdown.

    holdings: timestamp, instrument, weight (several rows of a key add up); prices: timestamp,
    instrument, price (of several the greatest). A weight acts on the holdings' next date, and is 0 on
    dates that have none; an asset's return is that from its price to the one window price dates later,
    missing (then 0) if either is missing or tradable (timestamp, instrument, tradable) isn't true.
    Rows stay long: a key of weights, one of prices, and the two dates around each; no grid is made.
    """
    # both are read several times below, so what made them runs once
    h = cut_lineage(holdings.select(TS, "instrument", "weight").dropna().groupBy(TS, "instrument").agg(F.sum("weight").alias("weight")))
    p = cut_lineage(prices.select(TS, "instrument", "price").dropna().groupBy(TS, "instrument").agg(F.max("price").alias("price")))
    one = Window.partitionBy(F.lit(1)).orderBy(TS)  # calendars have one row a date
    h_days, p_days = h.select(TS).distinct(), p.select(TS).distinct()
    after = h_days.select(TS, F.lead(TS).over(one).alias("_next"))
    w = h.join(broadcast_if_small(after), TS).filter("_next is not null").select(F.col("_next").alias(TS), "instrument", "weight")
    later = p_days.select(TS, F.lead(TS, window).over(one).alias("_later"))
    priced = p.join(broadcast_if_small(later), TS)
    by_asset = Window.partitionBy("instrument").orderBy(TS)
    # the asset's own row window dates later, if it has one there: at most window rows ahead
    r = F.lit(None).cast("double")
    for k in range(1, window + 1):
        r = F.when(F.lead(TS, k).over(by_asset) == F.col("_later"), div(F.lead("price", k).over(by_asset), F.col("price")) - 1).otherwise(r)
    priced = priced.select(TS, "instrument", r.alias("ret"))
    if tradable is not None:
        t = tradable.groupBy(TS, "instrument").agg(F.max(F.coalesce("tradable", F.lit(False)).cast("int")).alias("_ok"))
        priced = priced.join(t, [TS, "instrument"], "left").select(TS, "instrument", F.when(F.col("_ok") == 1, F.col("ret")).alias("ret"))
    all_days = h_days.union(p_days) if tradable is None else h_days.union(p_days).union(tradable.select(TS))
    calendar = all_days.dropna().distinct().select(TS, F.lead(TS).over(one).alias("_next"))
    calendar = broadcast_if_small(calendar)
    held = w.join(priced, [TS, "instrument"], "left")
    daily = held.groupBy(TS).agg(
        F.sum(F.col("weight") * F.coalesce("ret", F.lit(0.0))).alias("gross_return"), F.count(F.when(F.col("weight") != 0, 1)).alias("holding_cells"),
        F.count(F.when((F.col("weight") != 0) & F.col("ret").isNotNull(), 1)).alias("valid_holding_cells"),
    )
    # turnover: what each weight is on its date less what it was on the date before
    moves = w.select(TS, "instrument", F.col("weight").alias("d")).unionByName(
        w.join(calendar, TS).filter("_next is not null").select(F.col("_next").alias(TS), "instrument", (-F.col("weight")).alias("d"))
    )
    turnover = moves.groupBy(TS, "instrument").agg(F.sum("d").alias("d")).groupBy(TS).agg(F.sum(F.abs("d")).alias("turnover"))
    out = calendar.select(TS).join(daily, TS, "left").join(turnover, TS, "left").join(exposures(w), TS, "left")
    out = out.na.fill(0.0, ["gross_return", "turnover", "long_exposure", "short_exposure", "net_exposure", "gross_exposure"]).na.fill(0, ["holding_cells", "valid_holding_cells", "holdings_count"])
    out = out.withColumn("trading_cost", F.col("turnover") * cost_rate).withColumn("net_return", F.col("gross_return") - F.col("trading_cost"))
    out = out.withColumn("asset_return_coverage", F.try_divide(F.col("valid_holding_cells").cast("double"), "holding_cells"))
    run = one.rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({"nav_gross": cumulative(F.col("gross_return"), run), "nav_net": cumulative(F.col("net_return"), run)})
    return out.withColumns({f"drawdown_{x}": F.col(f"nav_{x}") / F.max(f"nav_{x}").over(run) - 1 for x in ("gross", "net")})


def metrics(returns: DataFrame, keys: Sequence[str], *, order: str = "timestamp", net: str = "net_return", gross: str | None = None, per_year: int = 252) -> DataFrame:
    """One row of performance figures per key of daily net returns: see the column names.

    Missing returns are left out. Figures that divide by nothing are null: volatility ratios with a
    deviation under 1e-12 or fewer than two (losing) days, a profit-loss ratio without wins or losses.
    var_95 is the 5 % quantile (linear), cvar_95 the mean of the days at or under it. With gross, the
    gross returns' column, come the figures of gross returns, and those of the columns of backtest:
    turnover, exposures, cost and coverage.

    All is one window stage over a key's days and one aggregate: streaks are distances to the last day
    that breaks them, weeks and months are counted on their last day.
    """
    keys = list(keys)
    extra = [gross, *BACKTEST_COLUMNS] if gross else []
    df = returns.select(*keys, F.col(order).cast("date").alias("_d"), F.col(net).alias("r"), *[F.col(c).alias(f"_{c}") for c in extra]).filter("r is not null and not isnan(r)")
    part = Window.partitionBy(*keys)
    w = part.orderBy("_d", "r")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_i", F.row_number().over(w)).withColumn("nav", F.product(1 + F.col("r")).over(run))
    if gross:
        df = df.withColumn("_g", F.coalesce(F.col(f"_{gross}"), F.lit(0.0))).withColumn("_gnav", F.product(1 + F.col("_g")).over(run))
        df = df.withColumn("_gdd", F.col("_gnav") / F.max("_gnav").over(run) - 1)
    df = df.withColumn("dd", F.col("nav") / F.max("nav").over(run) - 1)
    r, n, sd = F.col("r"), F.count("*"), F.stddev_samp("r")
    flags = {"max_drawdown_duration": F.col("dd") < 0, "longest_win_streak": r > 0, "longest_loss_streak": r < 0}
    units = {"weekly_win_rate": "week", "monthly_win_rate": "month"}
    for name, flag in flags.items():
        df = df.withColumn(f"_{name}", F.col("_i") - F.coalesce(F.max(F.when(~flag, F.col("_i"))).over(run), F.lit(0)))
    for name, unit in units.items():
        p = F.date_trunc(unit, "_d")
        df = df.withColumn(f"_{name}", F.when(F.coalesce(F.lead(p).over(w) != p, F.lit(True)), F.product(1 + r).over(Window.partitionBy(*keys, p))))
    df = df.withColumn("_var", F.percentile("r", F.lit(0.05)).over(part)).withColumn("_top", F.row_number().over(part.orderBy(F.desc("r"), "_i")))
    loss = F.when(r < 0, r)
    year = float(per_year) ** 0.5
    sized = lambda x, s: F.when(F.abs(s) >= 1e-12, x / s)
    end = lambda c: F.max_by(c, "_i")
    annual = lambda nav: F.when(nav > 0, F.pow(nav, per_year / n) - 1)
    aggs = [
        n.alias("trade_days"), (end("nav") - 1).alias("total_return"), annual(end("nav")).alias("annual_return"),
        (sd * year).alias("annual_volatility"), sized(F.avg("r") * year, sd).alias("sharpe"), F.when(F.count(loss) > 1, sized(F.avg("r") * year, F.stddev_samp(loss))).alias("sortino"),
        F.min("dd").alias("max_drawdown"), F.avg((r > 0).cast("double")).alias("daily_win_rate"), F.avg("r").alias("avg_daily_return"), F.percentile("r", F.lit(0.5)).alias("median_daily_return"),
        F.max("r").alias("best_day"), F.min("r").alias("worst_day"), F.when(F.count(loss) > 1, F.stddev_samp(loss) * year).alias("downside_volatility"), F.max("_var").alias("var_95"),
        F.avg(F.when(r <= F.col("_var"), r)).alias("cvar_95"), F.try_divide(F.avg(F.when(r > 0, r)), F.when(F.abs(F.avg(loss)) >= 1e-12, F.abs(F.avg(loss)))).alias("profit_loss_ratio"),
        F.try_divide(F.sum(F.when(F.col("_top") <= 5, r)), F.when(F.sum(F.when(r > 0, r)) > 0, F.sum(F.when(r > 0, r)))).alias("top5_day_pnl_contribution"),
        *[F.max(f"_{name}").alias(name) for name in flags], *[F.avg((F.col(f"_{name}") > 1).cast("double")).alias(name) for name in units],
    ]
    if gross:
        g = F.stddev_samp("_g")
        aggs += [
            (end("_gnav") - 1).alias("gross_total_return"), annual(end("_gnav")).alias("gross_annual_return"), (g * year).alias("gross_annual_volatility"), sized(F.avg("_g") * year, g).alias("gross_sharpe"),
            F.min("_gdd").alias("gross_max_drawdown"), F.avg("_turnover").alias("avg_turnover"), F.percentile("_turnover", F.lit(0.5)).alias("median_turnover"), F.max("_turnover").alias("max_turnover"),
            F.avg("_holdings_count").alias("avg_holding_count"), *[F.avg(f"_{x}_exposure").alias(f"avg_{x}_exposure") for x in ("long", "short", "net", "gross")], F.sum("_trading_cost").alias("total_trading_cost"),
            (end("_gnav") - end("nav")).alias("cost_drag"), F.try_divide(F.sum("_valid_holding_cells").cast("double"), F.sum("_holding_cells")).alias("effective_asset_return_ratio"),
            F.avg("_asset_return_coverage").alias("avg_daily_asset_return_coverage"),
        ]
    return df.groupBy(*keys).agg(*aggs).withColumn("calmar", F.when(F.abs("max_drawdown") >= 1e-12, F.col("annual_return") / F.abs("max_drawdown")))


def upper_bits(c: Column) -> Column:
    """The upper 26 bits of a double's fraction, rounded: the product of two such numbers is exact."""
    return F.when(F.abs(c) < 1e300, c * 134217729.0 - (c * 134217729.0 - c)).otherwise(c)  # 2^27 + 1


def against_benchmark(returns: DataFrame, benchmark: DataFrame, keys: Sequence[str], *, order: str = "timestamp", net: str = "net_return", per_year: int = 252) -> DataFrame:
    """Per key: excess return, tracking error, information ratio, excess sharpe, beta and alpha.

    benchmark: order column and benchmark_return; a day it lacks counts 0. beta and alpha come from what a first
    slope leaves of the returns: a mean less beta times the other would keep only the digits that the greatest
    returns leave (alpha of the benchmark itself would be 1e-4 or 0 by the order of rows, for a return of 1e12).
    """
    keys = list(keys)
    b = benchmark.groupBy(order).agg(F.max("benchmark_return").alias("b"))
    df = returns.select(*keys, order, F.col(net).alias("r")).filter("r is not null and not isnan(r)").join(broadcast_if_small(b), order, "left").na.fill(0.0, ["b"])
    df = df.withColumn("x", F.col("r") - F.col("b"))
    part, high_b = Window.partitionBy(*keys), upper_bits(F.col("b"))
    var = F.var_samp("b").over(part)
    df = df.withColumn("_k", F.when(var >= 1e-12, F.try_divide(F.covar_samp("r", "b").over(part), var)))
    df = df.withColumn("_k", F.coalesce(F.when(F.abs("_k") < float("inf"), upper_bits(F.col("_k"))), F.lit(0.0)))
    df = df.withColumn("_rest", F.col("r") - F.col("_k") * high_b - F.col("_k") * (F.col("b") - high_b))  # both products are exact
    n, year = F.count("*"), float(per_year) ** 0.5
    nav = F.product(1 + F.col("x"))
    te = F.stddev_samp("x") * year
    annual = F.when(nav > 0, F.pow(nav, per_year / n) - 1)
    slope = F.when((n > 2) & (F.var_samp("b") >= 1e-12), F.try_divide(F.covar_samp("_rest", "b"), F.var_samp("b")))
    return df.groupBy(*keys).agg(
        (F.product(1 + F.col("b")) - 1).alias("benchmark_total_return"), (nav - 1).alias("excess_total_return"), annual.alias("excess_annual_return"), te.alias("tracking_error"),
        F.when(te > 1e-12, annual / te).alias("information_ratio"), F.when(F.stddev_samp("x") >= 1e-12, F.avg("x") / F.stddev_samp("x") * year).alias("excess_sharpe"),
        (F.max("_k") + slope).alias("beta"), ((F.avg("_rest") - slope * F.avg("b")) * per_year).alias("alpha"),
    )
