"""Recursive operators: bars worked out by hand, properties, and plain means."""

import math
from datetime import date, timedelta
from statistics import NormalDist

import numpy as np
import pytest

from factorloom.plans.compiler import compute, panel


def bars(n=60, seed=3, gaps=()):
    rng = np.random.default_rng(seed)
    c = np.exp(np.cumsum(rng.normal(0, 0.02, n))) * 20
    h, l = c * (1 + rng.random(n) * 0.02), c * (1 - rng.random(n) * 0.02)
    rows = []
    for i in range(n):
        x = None if i in gaps else float(c[i])
        rows.append((date(2024, 1, 1) + timedelta(i), "A", float(h[i]), float(l[i]), x))
    return rows


def run(spark, rows, expression):
    df = spark.createDataFrame(rows, "d date, i string, high double, low double, close double")
    p = panel(df, "d", "i", {c: c for c in ("high", "low", "close")})
    return [r.value for r in compute(p, {"value": expression}).orderBy("instrument", "timestamp").collect()]


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert (a is None) == (b is None or math.isnan(b)), (a, b)
        if a is not None:
            assert a == pytest.approx(b, rel=1e-9, abs=1e-9)


HLC = 'col("high"), col("low"), col("close")'


def of_bars(spark, hlc, expression):
    """The operator over bars given as (high, low, close)."""
    return run(spark, [(date(2024, 1, 1) + timedelta(i), "A", *map(float, x)) for i, x in enumerate(hlc)], expression)


def test_directional_movement_by_hand(spark):
    # up moves 1, 2, 0, 0, 3; down moves 0, 0, 1, 2, 0; true ranges 2, 2, 3, 2, 3, 4
    hlc = [(10, 8, 9), (11, 9, 10), (13, 10, 12), (12, 10, 11), (11, 8, 9), (14, 10, 13)]
    # smoothed over 2 bars from the second on: plus 0.5, 1.25, 0.625, 0.3125, 1.65625 (and minus likewise) over ranges
    plus, minus, ranges = [0.5, 1.25, 0.625, 0.3125, 1.65625], [0.0, 0.0, 0.0, 1.0, 0.5], [2.0, 2.5, 2.25, 2.625, 3.8125]
    same(of_bars(spark, hlc, f"ts_adx({HLC}, 2, line='plus_di')"), [None, *(100 * p / t for p, t in zip(plus, ranges))])
    same(of_bars(spark, hlc, f"ts_adx({HLC}, 2, line='minus_di')"), [None, *(100 * m / t for m, t in zip(minus, ranges))])
    dx = [100.0, 100.0, 100.0, 100 * 0.6875 / 1.3125, 100 * 1.15625 / 2.15625]
    same(of_bars(spark, hlc, f"ts_dx({HLC}, 2)"), [None, *dx])
    third = 100.0  # the mean of the first two, then half the last and half the new one
    adx = [third, (third + dx[2]) / 2]
    adx += [(adx[-1] + dx[3]) / 2]
    adx += [(adx[-1] + dx[4]) / 2]
    same(of_bars(spark, hlc, f"ts_adx({HLC}, 2)"), [None, None, *adx])
    same(of_bars(spark, hlc, f"ts_adxr({HLC}, 2)"), [None, None, None, None, (adx[2] + adx[0]) / 2, (adx[3] + adx[1]) / 2])


def test_keltner_by_hand(spark):
    # typical prices 9, 12, 9; their mean with half weights 9, 10.5, 9.75; true ranges 2, 4, 4: smoothed over 2 bars 3, 3.5
    hlc = [(10, 8, 9), (13, 11, 12), (10, 8, 9)]
    same(of_bars(spark, hlc, f'ts_keltner({HLC}, 3, mult=2.0, band="middle", atr_d=2)'), [9.0, 10.5, 9.75])
    same(of_bars(spark, hlc, f'ts_keltner({HLC}, 3, mult=2.0, band="upper", atr_d=2)'), [None, 16.5, 16.75])


def test_parabolic_stop_by_hand(spark):
    # rising: from the first low 8, by 2 % of the way to 10, but not above a low; then it steps by 4 % and 6 %
    hlc = [(10, 8, 9), (11, 9, 10), (12, 10, 11), (13, 11, 12), (12, 7, 8), (9, 6, 7)]
    # 8; min(8 + .02 * 2, 8, 9) = 8; 8 + .04 * 3 = 8.12; 8.12 + .06 * 3.88 = 8.3528; 8.3528 + .08 * 4.6472 = 8.7 is above the low 7, so 7; 7 + .08 * 6 is above the low 6
    same(of_bars(spark, hlc, 'ts_sar(col("high"), col("low"))'), [8.0, 8.0, 8.12, 8.3528, 7.0, 6.0])


def test_parabolic_stop_keeps_its_side(spark):
    """As it is kept within the bar's own low (or high), the stop stays on the side on which it began."""
    rows = bars(200, seed=9)
    stop = run(spark, rows, 'ts_sar(col("high"), col("low"))')
    rising = rows[1][2] + rows[1][3] > rows[0][2] + rows[0][3]
    assert all(s <= r[3] + 1e-9 if rising else s >= r[2] - 1e-9 for s, r in zip(stop, rows))
    assert len({round(s, 9) for s in stop}) > 20


def test_one_bar_has_no_stop(spark):
    assert run(spark, bars(1), 'ts_sar(col("high"), col("low"))') == [None]


def test_ema_decays_over_gaps(spark):
    rows = bars(20, gaps=(4, 5, 11))
    a, mean, weight, want = 2 / 6, None, 1.0, []
    for r in rows:
        x = r[4]
        if mean is not None:
            weight *= 1 - a
        if x is not None:
            mean = x if mean is None else (weight * mean + a * x) / (weight + a)
            weight = 1.0
        want.append(mean)
    same(run(spark, rows, 'ts_ema(col("close"), 5)'), want)


def test_normal_quantiles(spark):
    rows = [(date(2024, 1, 1), f"i{k:02d}", 1.0, 1.0, float(k)) for k in range(40)]
    got = run(spark, rows, 'quantile(col("close"))')
    same(got, [NormalDist().inv_cdf(min(max((k + 1) / 40, 1e-12), 1 - 1e-12)) for k in range(40)])
    rows = bars(30)
    c = [r[4] for r in rows]
    want = []
    for i in range(len(c)):
        w = c[max(0, i - 9) : i + 1]
        want.append(NormalDist().inv_cdf(min(max(sum(v <= c[i] for v in w) / len(w), 1e-12), 1 - 1e-12)) if len(w) > 1 else None)
    same(run(spark, rows, 'ts_quantile(col("close"), 10)'), want)
