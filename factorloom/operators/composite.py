"""Several factors to one signal: preparing, neutralising, orthogonalising, weighting, ranking."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.ops import CS, TS, clip, pct_rank
from factorloom.operators.evaluation import correlation

KEYS = (TS, "instrument")


def preprocess(df: DataFrame, factors: Sequence[str], *, directions: Mapping[str, float] | None = None, lower: float | None = 0.01, upper: float = 0.99, standardize: str = "zscore", fill: str = "keep") -> DataFrame:
    """Per date: sign, clip to quantiles, standardise ('zscore' by population deviation, 0 where it is 0; 'rank'; 'none') and fill ('keep', 'zero', 'median')."""
    directions = directions or {}
    df = df.withColumns({f: F.col(f) * float(directions.get(f, 1.0)) for f in factors})
    if lower is not None:
        bound = lambda f, p: F.percentile(f, F.lit(float(p))).over(CS())
        df = df.withColumns({f: clip(F.col(f), bound(f, lower), bound(f, upper)) for f in factors})
    if standardize == "zscore":
        z = lambda f: F.when(F.stddev_pop(f).over(CS()) > 0, (F.col(f) - F.avg(f).over(CS())) / F.stddev_pop(f).over(CS())).when(F.col(f).isNotNull(), 0.0)
        df = df.withColumns({f: z(f) for f in factors})
    elif standardize == "rank":
        df = df.withColumns({f: pct_rank(F.col(f), TS) for f in factors})
    if fill == "zero":
        df = df.withColumns({f: F.coalesce(f, F.lit(0.0)) for f in factors})
    elif fill == "median":
        df = df.withColumns({f: F.coalesce(f, F.percentile(f, F.lit(0.5)).over(CS())) for f in factors})
    return df


def group_demean(df: DataFrame, factors: Sequence[str], group: str) -> DataFrame:
    """Less the mean of the date and group; rows without a group become null."""
    w = Window.partitionBy(TS, group)
    return df.withColumns({f: F.when(F.col(group).isNotNull(), F.col(f) - F.avg(f).over(w)) for f in factors})


def per_date(df: DataFrame, columns: Sequence[str], f: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """df with columns replaced, date by date, by what f makes of the date's rows in the order of instruments."""
    schema = df.schema

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("instrument")
        done = f(table.to_pandas())
        for c in columns:
            table = table.set_column(table.schema.get_field_index(c), c, pa.array(done[c].to_numpy(float), from_pandas=True))
        return table

    return df.groupBy(TS).applyInArrow(run, schema)


def residual(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    return y - x @ np.linalg.lstsq(x, y, rcond=None)[0]


def neutralize_ols(df: DataFrame, factors: Sequence[str], controls: Sequence[str], intercept: bool = True) -> DataFrame:
    """Residuals of each factor on the controls per date; text controls become dummies less the first.

    A date with no more known rows than regressors has none; so has a row with a missing control.
    """
    text = {c for c, t in df.dtypes if t == "string"}

    def one(g: pd.DataFrame) -> pd.DataFrame:
        parts = [np.ones((len(g), 1))] if intercept else []
        for c in controls:
            if c in text:
                levels = sorted(g[c].dropna().unique())
                parts += [(g[c] == v).to_numpy(float)[:, None] for v in (levels[1:] if len(levels) > 1 else levels)]
            else:
                parts.append(g[c].to_numpy(float)[:, None])
        x = np.hstack(parts)
        for f in factors:
            y = g[f].to_numpy(float)
            ok = ~np.isnan(y) & ~np.isnan(x).any(axis=1)
            out = np.full(len(g), np.nan)
            if ok.sum() > x.shape[1]:
                out[ok] = residual(y[ok], x[ok])
            g[f] = out
        return g

    return per_date(df, factors, one)


def orthogonalize_sequential(df: DataFrame, factors: Sequence[str]) -> DataFrame:
    """Each factor less its projection on those before it (already orthogonal), per date, without intercept."""

    def one(g: pd.DataFrame) -> pd.DataFrame:
        for i, f in enumerate(factors):
            if i:
                v = g[[f, *factors[:i]]].to_numpy(float)
                ok = ~np.isnan(v).any(axis=1)
                out = np.full(len(g), np.nan)
                if ok.sum() > i:
                    out[ok] = residual(v[ok, 0], v[ok, 1:])
                g[f] = out
        return g

    return per_date(df, factors, one)


def orthogonalize_symmetric(df: DataFrame, factors: Sequence[str], shrinkage: float = 0.0) -> DataFrame:
    """Loewdin: standardised factors times the inverse root of their correlation, per date.

    Eigenvalues are at least 1e-8. Rows with a missing factor, and dates with too few rows or a
    constant factor, have none.
    """
    factors = list(factors)

    def one(g: pd.DataFrame) -> pd.DataFrame:
        v = g[factors].to_numpy(float)
        ok = ~np.isnan(v).any(axis=1)
        out = np.full(v.shape, np.nan)
        if ok.sum() > len(factors) and (v[ok].std(axis=0) > 0).all():
            z = (v[ok] - v[ok].mean(axis=0)) / v[ok].std(axis=0)
            c = (1 - shrinkage) * np.corrcoef(z, rowvar=False).reshape(len(factors), -1) + shrinkage * np.eye(len(factors))
            values, vectors = np.linalg.eigh(c)
            out[ok] = z @ (vectors / np.sqrt(np.clip(values, 1e-8, None))) @ vectors.T
        g[factors] = out
        return g

    return per_date(df, factors, one)


def constant_weights(df: DataFrame, factors: Sequence[str], weights: Mapping[str, float] | None = None) -> DataFrame:
    """timestamp and a weight per factor: equal, or the given ones over the sum of their sizes."""
    raw = {f: float((weights or {}).get(f, 0.0)) for f in factors} if weights is not None else dict.fromkeys(factors, 1.0)
    size = sum(map(abs, raw.values()))
    raw = {f: w / size for f, w in raw.items()} if size > 1e-12 else dict.fromkeys(factors, 1 / len(factors))
    return df.select(TS).distinct().select(TS, *[F.lit(w).alias(f) for f, w in raw.items()])


def ic_weights(df: DataFrame, factors: Sequence[str], target: str, lookback: int = 20, min_history: int = 1, rank: bool = False) -> DataFrame:
    """timestamp and a weight per factor: the mean daily IC of the dates before, over the sum of sizes.

    The dates before are the lookback last; fewer than min_history, or no known IC, give equal weights.
    """
    stats = None
    for f in factors:
        v = df.select(TS, F.col(f).alias("x"), F.col(target).alias("y")).filter("x is not null and y is not null")
        if rank:
            v = v.select(TS, pct_rank(F.col("x"), TS).alias("x"), pct_rank(F.col("y"), TS).alias("y"))
        one = v.groupBy(TS).agg(F.when(F.count("*") >= 2, correlation(F.col("x"), F.col("y"))).alias("ic")).select(TS, F.lit(f).alias("f"), "ic")
        stats = one if stats is None else stats.unionByName(one)
    dates = df.select(TS).distinct()
    wide = stats.groupBy(TS).agg(*[F.max(F.when(F.col("f") == f, F.col("ic"))).alias(f) for f in factors])
    w = Window.partitionBy(F.lit(1)).orderBy(TS)  # one row a date
    past = w.rowsBetween(-lookback, -1)
    out = dates.join(wide, TS, "left").select(TS, *[F.avg(f).over(past).alias(f) for f in factors], F.count(TS).over(past).alias("_n"))
    size = sum((F.coalesce(F.abs(f), F.lit(0.0)) for f in factors), F.lit(0.0))
    usable = (F.col("_n") >= min_history) & (size > 1e-12)
    return out.select(TS, *[F.when(usable, F.coalesce(f, F.lit(0.0)) / size).otherwise(1 / len(factors)).alias(f) for f in factors])


def compose(df: DataFrame, factors: Sequence[str], weights: DataFrame, *, transform: str = "none", long_top: int | None = None, short_bottom: int | None = None) -> DataFrame:
    """timestamp, instrument, composite_score, rank, selected_flag and side.

    A missing factor counts 0. Ranks are descending, ties averaged; the selection breaks ties by
    instrument, and a row both long and short is short.
    """
    w = weights.select(TS, *[F.col(f).alias(f"_w_{f}") for f in factors])
    score = sum((F.coalesce(F.col(f), F.lit(0.0)) * F.coalesce(F.col(f"_w_{f}"), F.lit(0.0)) for f in factors), F.lit(0.0))
    out = df.join(w, TS, "left").select(*KEYS, score.alias("composite_score"))
    if transform != "none":
        out = preprocess(out, ["composite_score"], lower=None, standardize=transform)
    s = F.col("composite_score")
    ties = F.count("*").over(Window.partitionBy(TS, s))
    out = out.withColumn("rank", F.rank().over(CS().orderBy(s.desc())) + (ties - 1) / 2)
    pick = lambda order, k: F.row_number().over(CS().orderBy(order, "instrument")) <= k if k is not None else F.lit(False)
    out = out.withColumns({"_long": pick(s.desc(), long_top), "_short": pick(s.asc(), short_bottom)})
    side = F.when(F.col("_short"), "SHORT").when(F.col("_long"), "LONG").otherwise("NONE")
    return out.select(*KEYS, "composite_score", "rank", (F.col("_long") | F.col("_short")).alias("selected_flag"), side.alias("side"))
