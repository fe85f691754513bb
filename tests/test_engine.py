"""The language, the compiler, sources, the lake, alignment, composition and portfolios on small fixtures."""

from datetime import date, datetime, timedelta
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from factorloom.operators import account_figures, asof, composite, minute, portfolio, risk, single_asset
from factorloom.operators.cleaning import clean_table
from factorloom.plans import catalog, factor_queries, research_queries, stubs
from factorloom.plans.compiler import SIGNATURES, Plan, compile_text, compute, panel
from factorloom.plans.dsl import DslError, columns_of, lookback
from factorloom.sources.lake import HashMismatch, Lake
from factorloom.sources.panels import composite_panel, in_universe, parquet_panel, table_report
from factorloom.streaming.incremental import stream_to_lake, windowed_bars


def tiny(spark, rows, extra="x double"):
    df = spark.createDataFrame(rows, f"d date, i string, {extra}")
    return panel(df, "d", "i", {c.split()[0]: c.split()[0] for c in extra.split(", ")})


def values(df, name="value"):
    return [r[name] for r in df.orderBy("instrument", "timestamp").collect()]


D = [date(2024, 1, 1) + timedelta(i) for i in range(10)]


def test_hand_computed_steps(spark):
    p = tiny(spark, [(D[i], "A", float(v), t, a, e) for i, (v, t, a, e) in enumerate([(0, 0.0, 5.0, 0.0), (1, 1.0, 7.0, 0.0), (10, 0.0, 9.0, 1.0)])], "x double, t double, a double, e double")
    assert values(compute(p, {"value": 'hump(col("x"), 0.5)'})) == [0.0, 0.5, 1.0]
    assert values(compute(p, {"value": 'trade_when(col("t"), col("a"), col("e"))'})) == [None, 7.0, None]
    assert values(compute(p, {"value": 'ts_step(2, col("x"))'})) == [0.0, 1.0, 0.0]
    assert values(compute(p, {"value": '-col("x") + 2 * 3'})) == [6.0, 5.0, -4.0]
    assert values(compute(p, {"value": 'if_else(col("x") > 0, 1, 0)'})) == [0.0, 1.0, 1.0]


def test_ragged_panel_and_missing(spark):
    p = tiny(spark, [(D[0], "A", 1.0), (D[1], "A", float("nan")), (D[2], "A", 4.0), (D[0], "B", 10.0), (D[1], "B", 20.0), (None, "B", 1.0), (D[0], None, 1.0), (D[2], "A", 4.0)])
    assert p.count() == 5
    assert values(compute(p, {"value": 'rank(col("x"))'})) == [0.5, None, 1.0, 1.0, 1.0]
    assert values(compute(p, {"value": 'ts_mean(col("x"), 2, min_periods=1)'})) == [1.0, 1.0, 4.0, 10.0, 15.0]
    assert compute(p.limit(0), {"value": 'ts_ema(rank(col("x")), 3)'}).count() == 0


@pytest.mark.parametrize("text", ["", "import os", "foo(1)", "col(x)", 'col("x") < 1 < 2', 'col("x") ** 2', 'ts_mean(col("x"))', 'ts_mean(col("x"), 2, 3, 4)', 'ts_mean(col("x"), d=col("y"))', "[1]", 'rank(*[col("x")])', 'add(col("x"))'])
def test_rejected(text):
    with pytest.raises(DslError):
        compile_text(text)


def test_plans_share_and_describe():
    plan = Plan({"a": 'rank(ts_mean(col("x"), 5))', "b": 'ts_mean(col("x"), 5) + 1'})
    assert len(plan.names) == 2 and "stage 2" in plan.explain()  # the average is one node
    n = compile_text('change_instrument(ts_mean(col("x"), 5), "y")')
    assert columns_of(n) == {"x", "y"} and lookback(n) == 5
    assert len(stubs.NAMES) == 107
    for name in stubs.NAMES:
        with pytest.raises(NotImplementedError):
            Plan({"a": f'{name}(col("x"))'})
    assert len([n for n in SIGNATURES if not n.endswith("_stub")]) >= 124


def test_unknown_column(spark):
    with pytest.raises(DslError):
        compute(tiny(spark, [(D[0], "A", 1.0)]), {"value": 'col("nope")'})


def test_as_of_alignment(spark):
    price = tiny(spark, [(D[i], k, 1.0) for i in (1, 2) for k in ("AAA", "BBB")])
    ratio = tiny(spark, [(D[0], "AAA", 2.0), (D[0], "BBB", 5.0), (D[2], "AAA", 3.0), (D[2], "BBB", None)])
    got = {(r.instrument, r.timestamp): r.pe_x for r in composite_panel(price, {"pe": (ratio, "asof_backward")}).collect()}
    assert got == {("AAA", D[1]): 2.0, ("AAA", D[2]): 3.0, ("BBB", D[1]): 5.0, ("BBB", D[2]): None}
    got = {(r.instrument, r.timestamp): r.pe_x for r in composite_panel(price, {"pe": (ratio, "exact")}).collect()}
    assert got[("AAA", D[1])] is None and got[("AAA", D[2])] == 3.0
    filled = asof.as_of(price, ratio.select("timestamp", "instrument", F.col("x").alias("y")), columns=["y"], skip_missing=True, slice_us=asof.DAY_US)
    assert {(r.instrument, r.timestamp): r.y for r in filled.collect()}[("BBB", D[2])] == 5.0
    short = asof.as_of(price.limit(0), ratio, columns=["x"])
    assert short.count() == 0 and asof.as_of(price, ratio.limit(0), columns=["x"]).filter("x is not null").count() == 0


def test_universe_and_one_panel(spark):
    p = tiny(spark, [(D[i], k, 1.0) for i in range(2) for k in "ABC"])
    members = p.filter("not (instrument = 'A' and timestamp = '2024-01-01')").select("timestamp", "instrument")
    assert in_universe(p, members, least=3).count() == 3
    f = p.withColumnRenamed("x", "value")
    assert asof.one_panel({"a": f, "b": f.filter("instrument <> 'C'")}, how="inner").count() == 4


def test_lake_round_trip(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    node = compile_text('rank(col("x"))')
    rows = spark.createDataFrame([(datetime(2023, 12, 31), " A ", 1.0), (datetime(2024, 1, 1), "A", 2.0), (datetime(2024, 1, 1), "B", float("inf")), (datetime(2024, 1, 2), None, 1.0)], "timestamp timestamp, instrument string, value double")
    assert lake.write("f1", rows, node) == 2
    new = spark.createDataFrame([(datetime(2024, 1, 1), "A", 5.0), (datetime(2024, 1, 3), "C", 7.0)], "timestamp timestamp, instrument string, value double")
    assert lake.write("f1", new, node) == 3 and lake.write("f1", new, node) == 3
    got = {(str(r.timestamp)[:10], r.instrument): r.value for r in lake.read("f1").collect()}
    assert got == {("2023-12-31", "A"): 1.0, ("2024-01-01", "A"): 5.0, ("2024-01-03", "C"): 7.0}
    assert lake.read("f1", start="2024-01-02", assets=["C "]).count() == 1 and lake.read("none").count() == 0
    entry = lake.catalog("f1").first()
    assert (entry.start_date, entry.end_date, entry.row_count) == ("2023-12-31", "2024-01-03", 3)
    with pytest.raises(HashMismatch):
        lake.write("f1", new, compile_text('col("x")'))
    new.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("timestamp timestamp, instrument string, value double").parquet(str(tmp_path / "in"))
    stream_to_lake(stream, lake, "f2", str(tmp_path / "cp")).awaitTermination()
    assert lake.read("f2").count() == 2
    bars = windowed_bars(stream.withColumn("v", F.lit(1.0)), time="timestamp", key="instrument", price="value", volume="v").writeStream.format("memory").queryName("bars").outputMode("complete").trigger(availableNow=True).start()
    bars.awaitTermination()
    assert spark.table("bars").count() == 2
    lake.delete("f1")
    assert lake.read("f1").count() == 0


def test_parquet_sources(spark, tmp_path):
    rows = [(1704067200_000_000_000, " A", 1.0), (1704153600_000_000_000, "A", 2.0), (1704153600_000_000_000, "B ", -3.0)]
    spark.createDataFrame(rows, "window_start long, ticker string, c double").write.parquet(str(tmp_path / "x/2024"))
    p = parquet_panel(spark, str(tmp_path / "x"), {"close": "c"}, timestamp="window_start", unit="ns", day=True, start="2024-01-02", instruments=["A"])
    assert [tuple(r) for r in p.collect()] == [(datetime(2024, 1, 2), "A", 2.0)]
    report = table_report(spark, str(tmp_path / "x"), not_negative=["c"]).agg(F.sum("rows"), F.sum("negatives")).first()
    assert tuple(report) == (3, 1)


def test_cleaning(spark):
    df = spark.createDataFrame([(1, [" a", "b"], 1), (1, ["A"], 2), (2, [], 1), (2, None, 1)], "id int, tickers array<string>, at int")
    out = clean_table(df, key=["id", "tickers"], lists=["tickers"], tickers=["tickers"], align_by="at")
    assert sorted((r.id, r.tickers or "", r.at) for r in out.collect()) == [(1, "A", 2), (1, "B", 1), (2, "", 1)]
    assert out.select("row_key").distinct().count() == 3


def cross(spark, n=30, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(D[i], f"I{k:02d}", float(rng.normal()), float(rng.normal()), ["u", "v", "w"][k % 3]) for i in range(3) for k in range(n)]
    rows[5] = (*rows[5][:2], None, *rows[5][3:])
    return tiny(spark, rows, "x double, y double, g string"), rows


def test_neutralise_and_orthogonalise(spark):
    p, _ = cross(spark)
    g = composite.neutralize_ols(p, ["x"], ["y", "g"]).toPandas().dropna()
    for _, s in g.groupby("timestamp"):
        assert abs(s.x.sum()) < 1e-9 and abs(s.x @ s.y) < 1e-9 and abs(s.groupby("g").x.sum()).max() < 1e-9
    o = composite.orthogonalize_sequential(p, ["x", "y"]).toPandas().dropna()
    assert all(abs(s.x @ s.y) < 1e-9 for _, s in o.groupby("timestamp"))
    z = composite.orthogonalize_symmetric(p, ["x", "y"]).toPandas().dropna()
    assert all(abs(np.corrcoef(s.x, s.y)[0, 1]) < 1e-9 for _, s in z.groupby("timestamp"))


def test_holdings_by_score(spark):
    rows = [(D[0], "a", 3.0, "LONG"), (D[0], "b", 1.0, "LONG"), (D[0], "c", -2.0, "SHORT"), (D[0], "d", -1.0, "SHORT"), (D[0], "e", 0.0, "NONE")]
    s = spark.createDataFrame([(*r, r[3] != "NONE") for r in rows], "timestamp date, instrument string, composite_score double, side string, selected_flag boolean")
    got = {r.instrument: r.weight for r in portfolio.allocate(s, long_budget=0.6, short_budget=0.4).collect()}
    assert got == pytest.approx({"a": 0.45, "b": 0.15, "c": -0.4 * 2 / 3, "d": -0.4 / 3})


def test_portfolio_weights_act_a_date_later(spark):
    h = spark.createDataFrame([(D[0], "a", 1.0), (D[1], "a", 0.5), (D[1], "b", 0.5)], "timestamp date, instrument string, weight double")
    p = spark.createDataFrame([(D[0], "a", 10.0), (D[1], "a", 11.0), (D[2], "a", 22.0), (D[1], "b", 5.0)], "timestamp date, instrument string, price double")
    got = {r.timestamp: r for r in portfolio.backtest(h, p, cost_rate=0.01).collect()}
    assert got[D[0]].gross_return == 0 and got[D[1]].gross_return == pytest.approx(1.0) and got[D[1]].turnover == 1.0
    assert got[D[2]].turnover == 1.0 and got[D[2]].gross_return == 0 and got[D[1]].net_return == pytest.approx(0.99)
    assert portfolio.backtest(h.limit(0), p.limit(0)).count() == 0


def test_wls_and_covariance(spark):
    p, rows = cross(spark)
    df = p.withColumn("ret", F.col("x") * 0.5 - F.col("y") * 0.2).withColumn("cap", F.abs("y") + 1)
    fitted = risk.cross_sectional_wls(df, ["x", "y"])
    first = [r for r in rows if r[0] == D[1]]
    x = np.array([[r[2], r[3]] for r in first])
    sd = x.std(axis=0, ddof=1)
    z = np.clip(x, x.mean(0) - 3 * sd, x.mean(0) + 3 * sd)
    z = (z - z.mean(0)) / z.std(axis=0, ddof=1)
    y, w = x @ [0.5, -0.2], np.sqrt(np.abs(x[:, 1]) + 1)
    beta = np.linalg.solve(z.T @ (w[:, None] * z), z.T @ (w * y))
    got = risk.factor_returns(fitted).filter(F.col("timestamp") == D[1]).first()
    assert (got.f_x, got.f_y) == pytest.approx(tuple(beta))
    r = np.random.default_rng(1).normal(size=(50, 2))
    c = risk.ewma_newey_west(r, 10, 0)
    w = 0.5 ** (np.arange(49, -1, -1) / 10)
    assert c == pytest.approx(np.cov(r.T, aweights=w, ddof=0))


def test_optimiser_beats_other_feasible_weights():
    rng = np.random.default_rng(2)
    x, cov, delta, mu = rng.normal(size=(8, 2)), np.eye(2) * 1e-3, np.full(8, 1e-3), rng.normal(size=8) / 100
    side = np.array([1] * 4 + [-1] * 4)
    w = risk.mean_variance(mu, x, cov, delta, side, aversion=5, long_budget=0.5, short_budget=0.5, cap=0.3)
    goal = lambda v: mu @ v - 2.5 * (v @ x @ cov @ x.T @ v + (v * v) @ delta)
    assert w[:4].sum() == pytest.approx(0.5) and w[4:].sum() == pytest.approx(-0.5) and np.abs(w).max() <= 0.3 + 1e-12
    for _ in range(500):
        v = np.r_[risk._capped(rng.normal(size=4), 0.5, 0.3), -risk._capped(rng.normal(size=4), 0.5, 0.3)]
        assert goal(v) <= goal(w) + 1e-9


def test_rolling_rank_and_capped_positions(spark):
    rng = np.random.default_rng(3)
    x = [float(v) for v in rng.integers(0, 9, 40)]
    rows = [(D[0] + timedelta(i), "A", None if i == 7 else v) for i, v in enumerate(x)]
    got = values(minute.rolling_rank(tiny(spark, rows), "x", 10, "value"))
    known = [v for i, v in enumerate(x) if i != 7]
    want = []
    for i in range(len(known)):
        w = known[max(0, i - 9) : i + 1]
        want.append((sum(v < w[-1] for v in w) + (sum(v == w[-1] for v in w) + 1) / 2) / 10 if len(w) == 10 else None)
    want.insert(7, None)
    assert got == want
    t = np.array([0, 1, 1, 0, 0, 0, 1, 0], bool)
    assert list(minute.capped_positions(t, ~t & (np.arange(8) == 4), 3)) == [0, 1, 1, 1, -1, -1, -1, 0]


def test_threshold_machine_and_equity(spark):
    s = [0.0, 0.6, 0.3, 0.1, -0.7, 0.8, 0.0, None]
    how = {"long_entry": 0.5, "long_exit": 0.2, "short_entry": -0.5, "short_exit": -0.2, "short": True}
    p = tiny(spark, [(D[i], "A", v) for i, v in enumerate(s)], "signal double")
    assert values(single_asset.threshold_positions(p, **how, shift=0), "target_position") == [0, 1, 1, 0, -1, 1, 0, 0]
    assert values(single_asset.threshold_positions(p, **how), "target_position") == [0, 0, 1, 1, 0, -1, 1, 0]
    at_bounds = tiny(spark, [(D[i], "A", v) for i, v in enumerate([0.5, None, 0.2, -0.5])], "signal double")
    assert values(single_asset.threshold_positions(at_bounds, **how, shift=0), "target_position") == [1, 1, 0, -1]
    assert values(single_asset.threshold_positions(at_bounds, shift=0), "target_position") == [1, 1, 1, 0]  # no shorts, and out at 0
    bars = tiny(spark, [(D[i], "A", t, o, c) for i, (t, o, c) in enumerate([(1.0, 10.0, 10.0), (1.0, 10.0, 12.0), (0.0, 12.0, 12.0), (0.0, 15.0, 15.0)])], "target_position double, open double, close double")
    out = single_asset.single_asset_backtest(bars, start=100, commission=0, slippage=0)
    assert values(out, "equity") == [100.0, 120.0, 120.0, 150.0]
    ledger = single_asset.trade_ledger(bars.withColumns({"price": F.col("close"), "high": F.col("close") + 1, "low": F.col("close") - 1}), price="price").collect()
    assert len(ledger) == 1 and ledger[0].bars == 2 and ledger[0].mfe == pytest.approx(0.3) and ledger[0].mae == pytest.approx(-0.1)


def test_metrics_of_every_net_return(spark):
    d = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{d}/backtest_returns.parquet").toPandas()
    table = table[np.isfinite(table.net_return)].drop_duplicates(["strategy_id", "trade_date", "net_return"])
    assert (table.net_return.abs() >= 1).any()
    got = catalog.QUERIES["pf_metrics_net"](spark, d).toPandas().set_index("strategy_id")
    bench = catalog.QUERIES["pf_benchmark"](spark, d).toPandas().set_index("strategy_id")
    assert set(got.index) == set(bench.index) == set(table.strategy_id)
    for key, own in table.groupby("strategy_id").net_return:
        assert got.trade_days[key] == len(own)
        assert got.best_day[key] == pytest.approx(own.max(), abs=1e-6) and got.worst_day[key] == pytest.approx(own.min(), abs=1e-6)
        assert got.total_return[key] == pytest.approx((1 + own).prod() - 1, abs=1e-6, rel=1e-6)


def test_benchmark_figures_in_any_order(spark):
    """Against exact fractions, on returns some of which are far greater than the rest."""
    rng = np.random.default_rng(3)
    days = [date(2024, 1, 1) + timedelta(i) for i in range(60)]
    b = rng.normal(0, 0.02, 60)
    b[[7, 31]] = 1e12, -1.2e11
    near, apart = b.copy(), rng.normal(0, 0.02, 60)
    near[40] += 0.25
    series = {"own": b, "near": near, "twice": 2 * b, "against": -0.7 * b + apart, "apart": apart}
    own = [Fraction(x) for x in b.tolist()]
    mb = sum(own) / 60
    want = {}
    for name, r in series.items():
        r = [Fraction(x) for x in r.tolist()]
        beta = sum((x - mb) * y for x, y in zip(own, r)) / sum((x - mb) ** 2 for x in own)
        want[name] = float(beta), float((sum(r) / 60 - beta * mb) * 252)
    assert want["own"] == (1, 0) == (want["twice"][0] - 1, want["twice"][1]) and abs(want["near"][1]) > 1
    rows = [(name, days[i], float(x)) for name, r in series.items() for i, x in enumerate(r)]
    for parts in (1, 2, 3, 5):
        order = rng.permutation(len(rows))
        returns = spark.createDataFrame([rows[i] for i in order], "strategy_id string, timestamp date, net_return double").repartition(parts)
        bench = spark.createDataFrame(list(zip(days, b.tolist())), "timestamp date, benchmark_return double")
        for r in portfolio.against_benchmark(returns, bench, ["strategy_id"]).collect():
            assert (r.beta, r.alpha) == pytest.approx(want[r.strategy_id], rel=1e-9, abs=1e-7), (parts, r.strategy_id)


def test_queries_meet_the_columns_as_they_are(spark):
    d = "/root/testdata/sf0.01"
    p = factor_queries.daily_panel(spark, d).select("instrument", "timestamp", "high", "low", "close", "volume").toPandas().sort_values(["instrument", "timestamp"])
    assert (p.volume > 1e7).any() and ((p.close > p.high) | (p.close < p.low)).any()
    got = catalog.QUERIES["f_ts_adosc_raw"](spark, d).toPandas().set_index(["instrument", "timestamp"]).value
    for key, own in p.groupby("instrument"):
        total, fast, slow, seen, lost = 0.0, np.nan, np.nan, 0.0, False
        for t, h, lo, c, v in own[["timestamp", "high", "low", "close", "volume"]].itertuples(index=False):
            if h - lo > 1e-12 and v == v:
                lost |= c != c
                total += ((c - lo) - (h - c)) / (h - lo) * v
            seen = max(seen, abs(total))  # sums may differ by the digits that the largest total holds
            if not lost:  # from there on the means stay
                fast, slow = (total if x != x else x + 2 / (n + 1) * (total - x) for x, n in ((fast, 3), (slow, 10)))
            assert got[key, t] == pytest.approx(fast - slow, rel=1e-9, abs=1e-9 * seen + 1e-6, nan_ok=True)


def test_account_figures_by_hand():
    at = np.arange(6) * 86_400_000_000_000
    equity = np.array([100.0, 110.0, 99.0, 99.0, 121.0, 60.5])
    ret = np.r_[np.nan, np.diff(equity) / equity[:-1]]
    got = account_figures.figures(at, equity, ret, np.array([0.0, 1.0, 1.0, 0.0, -1.0, np.nan]), np.array([np.nan, 0.1, -0.1, 0.0, 0.2, -0.2]), np.full(6, 1000.0), 0.0)
    assert got["total_return"] == pytest.approx(-0.395) and got["max_drawdown"] == pytest.approx(-0.5) and got["max_drawdown_duration_bars"] == 2
    assert got["turnover"] == 1 + 1 + 1 + 1 and got["time_in_market"] == 0.5 and got["exposure"] == 0.5
    assert got["sterling_ratio"] == pytest.approx(got["annual_return"] / 0.3) and got["burke_ratio"] == pytest.approx(got["annual_return"] / 0.26**0.5)
    assert got["up_market_capture"] == pytest.approx((1.1 * 121 / 99 - 1) / (1.1 * 1.2 - 1)) and got["down_market_capture"] == pytest.approx((0.9 * 0.5 - 1) / (0.9 * 0.8 - 1))
    assert got["capacity_estimate"] == pytest.approx(1000 * 0.02 * 252 / (4 / 6 * 252)) and got["hurst_exponent"] == 0  # too few bars
    x = np.random.default_rng(1).normal(0, 0.01, 400)
    import pandas as pd

    skew, kurt = account_figures._moments(x)
    assert skew == pytest.approx(pd.Series(x).skew()) and kurt == pytest.approx(pd.Series(x).kurt())
    walk = np.cumsum(np.random.default_rng(2).normal(0, 0.01, 50_000))
    assert abs(account_figures._hurst(walk) - 1) < 0.05 and set(account_figures.PROFILES["standard"]) < set(got)


def test_account_figures_of_odd_tables(spark):
    df = spark.createDataFrame([(D[0], "A", 100.0, None, 1.0), (D[1], "A", None, 0.1, 1.0), (D[2], None, 5.0, 0.1, 1.0), (D[0], "B", 0.0, None, None)], "timestamp date, instrument string, equity double, period_return double, position double")
    got = {r.instrument: r for r in account_figures.account_figures(df, profile="standard").collect()}
    assert got["A"].bars == 1 and got["A"].total_return == 0 and got["B"].total_return == 0
    assert account_figures.account_figures(df.limit(0)).count() == 0


def test_targets_are_checked(spark):
    rows = [(D[0], "A", None), (D[1], "A", 0.5), (D[2], "A", float("nan")), (D[3], "A", -3.0)]
    p = tiny(spark, rows, "target_position double")
    with pytest.raises(ValueError):
        single_asset.valid_targets(p)
    with pytest.raises(ValueError):
        single_asset.valid_targets(p.union(p), strict=False)
    assert values(single_asset.valid_targets(p, strict=False), "target_position") == [0, 0.5, 0.5, -1]
    assert values(single_asset.valid_targets(p, bounds=False), "target_position") == [0, 0.5, 0.5, -3]
    few = tiny(spark, rows[1:2], "target_position double")
    assert values(single_asset.align_targets(few, p.select("timestamp", "instrument")), "target_position") == [0, 0.5, 0.5, 0.5]
