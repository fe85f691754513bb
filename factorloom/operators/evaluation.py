"""How well a factor orders later returns: information coefficients, quantile portfolios, summaries.

base is one row per timestamp and instrument throughout; each function adds columns or aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.ops import CS, TS, W, clip, div, nonzero, pct_rank


def prepare_factor(df: DataFrame, column: str = "value", direction: float = 1.0, lower: float = 0.01, upper: float = 0.99, out: str = "factor_eval") -> DataFrame:
    """Signed, clipped to its date's quantiles (linear), and standardised by the population deviation; zero deviation: null."""
    df = df.withColumn(out, F.col(column) * float(direction))
    x = F.col(out)
    df = df.withColumn(out, clip(x, F.percentile(x, F.lit(lower)).over(CS()), F.percentile(x, F.lit(upper)).over(CS())))
    return df.withColumn(out, div(x - F.avg(x).over(CS()), nonzero(F.stddev_pop(x).over(CS()))))


def forward_returns(df: DataFrame, price: str, horizons: Sequence[int]) -> DataFrame:
    """one_step_return, and ret_h for each horizon: bought at the next bar, held h bars."""
    p = F.col(price)
    ahead = lambda n: F.lead(p, n).over(W())
    df = df.withColumn("one_step_return", div(ahead(1), p) - 1)
    return df.withColumns({f"ret_{h}": div(ahead(h + 1), ahead(1)) - 1 for h in horizons})


def assign_quantiles(df: DataFrame, column: str = "factor_eval", n: int = 5, least: int = 5) -> DataFrame:
    """quantile 1 to n by rank within the date, ties by instrument; dates with too few values have none."""
    x = F.col(column)
    place = F.row_number().over(CS().orderBy(x.asc_nulls_last(), "instrument"))
    count = F.count(x).over(CS())
    q = F.greatest(F.least(F.ceil(place / count * n), F.lit(n)), F.lit(1))
    return df.withColumn("quantile", F.when(x.isNotNull() & (count >= max(least, n)), q.cast("int")))


def _pairs(df: DataFrame, x: str, y: str, keys: Sequence[str]) -> DataFrame:
    df = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return df.select(*keys, F.col(x).alias("x"), F.col(y).alias("y"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson's correlation as an aggregate; null if either side doesn't vary."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def daily_ic(df: DataFrame, ret: str, column: str = "factor_eval", least: int = 2, keys: Sequence[str] = (TS,)) -> DataFrame:
    """Per date ic (Pearson), rank_ic (average ranks) and universe_size, where enough pairs are known."""
    v = _pairs(df, column, ret, keys)
    v = v.withColumns({"rx": pct_rank(F.col("x"), *keys), "ry": pct_rank(F.col("y"), *keys)})
    out = v.groupBy(*keys).agg(correlation(F.col("x"), F.col("y")).alias("ic"), correlation(F.col("rx"), F.col("ry")).alias("rank_ic"), F.count("*").alias("universe_size"))
    return out.filter(F.col("universe_size") >= least)


def summarize(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """mean, std (sample), ir, win_rate and n_dates of a daily series."""
    c = F.col(column)
    return df.filter(c.isNotNull()).groupBy(*keys).agg(
        F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.try_divide(F.avg(c), nonzero(F.stddev_samp(c))).alias("ir"), F.avg((c > 0).cast("double")).alias("win_rate"), F.count("*").alias("n_dates")
    )


def period_returns(df: DataFrame, ret: str) -> DataFrame:
    """Mean later return per date and quantile."""
    return df.filter(F.col("quantile").isNotNull() & F.col(ret).isNotNull()).groupBy(TS, "quantile").agg(F.avg(ret).alias("period_return"))


def monotonicity(periods: DataFrame) -> DataFrame:
    """One row: Spearman correlation of the quantiles and their mean returns, and top less bottom."""
    means = periods.groupBy("quantile").agg(F.avg("period_return").alias("m")).withColumn("one", F.lit(1))
    ranks = means.withColumns({"rq": pct_rank(F.col("quantile"), "one"), "rm": pct_rank(F.col("m"), "one")})
    rho = ranks.agg(correlation(F.col("rq"), F.col("rm")).alias("monotonicity"), F.max("quantile").alias("top")).withColumn("one", F.lit(1))
    per_date = periods.withColumn("one", F.lit(1)).join(F.broadcast(rho), "one").groupBy(TS).agg(
        F.max(F.when(F.col("quantile") == F.col("top"), F.col("period_return"))).alias("t"), F.max(F.when(F.col("quantile") == 1, F.col("period_return"))).alias("b")
    )
    spread = per_date.agg(F.avg(F.col("t") - F.col("b")).alias("top_minus_bottom_mean")).withColumn("one", F.lit(1))
    return rho.join(spread, "one").select("monotonicity", "top_minus_bottom_mean")


def cumulative(r: Column, w) -> Column:
    """Running wealth of a return series; a missing return is none."""
    return F.product(1 + F.coalesce(r, F.lit(0.0))).over(w)


def tranche_backtest(df: DataFrame, horizon: int, n: int) -> DataFrame:
    """timestamp, quantile, daily_return, nav of overlapping equal-weight tranches held horizon bars."""
    members = F.count("*").over(Window.partitionBy(TS, "quantile"))
    df = df.select(TS, "instrument", "quantile", "one_step_return", F.when(F.col("quantile").isNotNull(), 1 / members).alias("w"))
    signal = F.struct("quantile", "w")
    df = df.select(TS, "one_step_return", *[F.lag(signal, k).over(W()).alias(f"_{k}") for k in range(1, horizon + 1)])
    held = df.select(TS, "one_step_return", F.explode(F.array(*[f"_{k}" for k in range(1, horizon + 1)])).alias("h")).select(TS, "one_step_return", "h.*")
    held = held.filter(F.col("quantile").isNotNull() & F.col("one_step_return").isNotNull())
    out = held.groupBy(TS, "quantile").agg((F.sum(F.col("w") * F.col("one_step_return")) / F.sum("w")).alias("daily_return"))
    w = Window.partitionBy("quantile").orderBy(TS).rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("nav", cumulative(F.col("daily_return"), w))


def long_short(quantiles: DataFrame, n: int) -> DataFrame:
    """timestamp, top and bottom daily return, their difference and its nav."""
    side = lambda q: F.max(F.when(F.col("quantile") == q, F.col("daily_return")))
    out = quantiles.groupBy(TS).agg(side(n).alias("top_daily_return"), side(1).alias("bottom_daily_return"))
    out = out.filter("top_daily_return is not null or bottom_daily_return is not null")
    out = out.withColumn("long_short_return", F.col("top_daily_return") - F.col("bottom_daily_return"))
    w = Window.partitionBy(F.lit(1)).orderBy(TS).rowsBetween(Window.unboundedPreceding, 0)  # one row a date
    return out.withColumn("nav", cumulative(F.col("long_short_return"), w))


def return_summary(df: DataFrame, column: str, keys: Sequence[str] = (), order: str = TS, per_year: int = 252) -> DataFrame:
    """total_return, ann_return, ann_vol, sharpe and max_drawdown of return series."""
    df = df.filter(F.col(column).isNotNull()).select(*keys, order, F.col(column).alias("r"))
    part = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    run = part.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("nav", cumulative(F.col("r"), run))
    df = df.withColumn("dd", F.col("nav") / F.max("nav").over(run) - 1)
    sd = F.stddev_samp("r")
    out = df.groupBy(*keys).agg(F.max_by("nav", order).alias("last"), F.count("*").alias("n"), F.avg("r").alias("m"), sd.alias("sd"), F.min("dd").alias("max_drawdown"))
    return out.select(
        *keys, (F.col("last") - 1).alias("total_return"), (F.pow("last", per_year / F.col("n")) - 1).alias("ann_return"), (F.col("sd") * per_year**0.5).alias("ann_vol"),
        F.try_divide(F.col("m") * per_year**0.5, nonzero(F.col("sd"))).alias("sharpe"), "max_drawdown",
    )


def below_thresholds(summary: DataFrame, least: dict[str, float], keys: Sequence[str]) -> DataFrame:
    """keys, passed, and failures: the measures of a summary row that are missing or under their least value."""
    failed = F.array_compact(F.array(*[F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.lit(f"{c} missing")).when(F.col(c) < v, F.lit(f"{c} below {v}")) for c, v in least.items()]))
    return summary.select(*keys, (F.size(failed) == 0).alias("passed"), F.array_join(failed, "; ").alias("failures"))
