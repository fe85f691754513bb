"""Operators that recur along time: numpy steps over time, all instruments of a block at once.

Every kernel takes arrays of instruments by bars (NaN where missing; the padding after an instrument's
last bar is NaN too and never matters, as time only runs forward) and returns one such array.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

import numpy as np

from factorloom.functions.ops import OPS, Op
from factorloom.plans.dsl import Signature

KERNELS: dict[str, Callable[..., np.ndarray]] = {}


def kernel(name: str, spec: str):
    def add(f):
        KERNELS[name] = f
        OPS[name] = Op(name, "KERNEL", Signature.of(spec), f)
        return f

    return add


def ema(x: np.ndarray, alpha: float) -> np.ndarray:
    """Exponential mean, unadjusted; the weight of the past decays over missing bars too."""
    out = np.full(x.shape, np.nan)
    mean, weight = np.full(len(x), np.nan), np.ones(len(x))
    for t in range(x.shape[1]):
        z = x[:, t]
        seen, begun = ~np.isnan(z), ~np.isnan(mean)
        weight = np.where(begun, weight * (1 - alpha), weight)
        mixed = (weight * mean + alpha * z) / (weight + alpha)
        mean = np.where(seen, np.where(begun, mixed, z), mean)
        weight = np.where(seen, 1.0, weight)
        out[:, t] = mean
    return out


def span_ema(x: np.ndarray, d: int, times: int = 1) -> np.ndarray:
    for _ in range(times):
        x = ema(x, 2.0 / (max(int(d), 1) + 1))
    return x


def lagged(x: np.ndarray, n: int = 1) -> np.ndarray:
    out = np.full(x.shape, np.nan)
    if n < x.shape[1]:
        out[:, n:] = x[:, : x.shape[1] - n]
    return out


def ratio(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> np.ndarray:
    """a / b where b is beyond least in size, else NaN."""
    ok = np.abs(b) > least
    return np.divide(a, b, out=np.full(np.broadcast(a, b).shape, np.nan), where=ok)


def true_range(h: np.ndarray, l: np.ndarray, c: np.ndarray) -> np.ndarray:
    pc = lagged(c)
    tr = np.maximum(np.maximum(h - l, np.abs(h - pc)), np.abs(l - pc))
    tr[:, :1] = (h - l)[:, :1]
    return tr


def mean_known(x: np.ndarray) -> np.ndarray:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)
        return np.nanmean(x, axis=1)


def wilder(x: np.ndarray, d: int, start: int | None = None, first: int = 0) -> np.ndarray:
    """Wilder's smoothing, begun at bar start (d - 1) with the mean of the known values from first on."""
    out = np.full(x.shape, np.nan)
    start = d - 1 if start is None else start
    if d < 1 or start >= x.shape[1]:
        return out
    out[:, start] = mean_known(x[:, first : start + 1])
    for t in range(start + 1, x.shape[1]):
        out[:, t] = (out[:, t - 1] * (d - 1) + x[:, t]) / d
    return out


def directional(h: np.ndarray, l: np.ndarray, c: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """+DI, -DI and DX; an instrument without a known price after its d-th bar has none."""
    none = np.isnan(h[:, d:]).all(axis=1) & np.isnan(l[:, d:]).all(axis=1) & np.isnan(c[:, d:]).all(axis=1)
    up, down = h - lagged(h), lagged(l) - l
    with np.errstate(invalid="ignore"):
        plus = np.where((up > down) & (up > 0), up, 0.0)
        minus = np.where((down > up) & (down > 0), down, 0.0)
        tr, p, m = (wilder(x, d) for x in (true_range(h, l, c), plus, minus))
        plus_di, minus_di = (np.where(tr > 1e-12, 100 * ratio(x, tr), np.nan) for x in (p, m))
        both = plus_di + minus_di
        dx = np.where(both > 1e-12, 100 * ratio(np.abs(plus_di - minus_di), both), np.nan)
    for x in (plus_di, minus_di, dx):
        x[none] = np.nan
    return plus_di, minus_di, dx


def average_dx(dx: np.ndarray, d: int) -> np.ndarray:
    """ADX: begins at bar 2d - 2 with the mean of DX so far; stays missing once DX is."""
    return wilder(dx, d, start=2 * d - 2, first=d - 1)


def relative_strength(x: np.ndarray, d: int) -> np.ndarray:
    step = x - lagged(x)
    with np.errstate(invalid="ignore"):
        gain, loss = ema(np.maximum(step, 0.0), 1.0 / d), ema(np.maximum(-step, 0.0), 1.0 / d)
    return 100.0 - 100.0 / (1.0 + ratio(gain, loss))


def pick(line: str, **lines: np.ndarray) -> np.ndarray:
    return lines.get(str(line).lower(), next(iter(lines.values())))


kernel("ts_ema", "@child, d")(lambda x, d: span_ema(x, d))
kernel("ts_kama", "@child, d, fast_period=2, slow_period=30")(lambda x, d, fast_period, slow_period: span_ema(x, d))
kernel("ts_rsi", "@child, d")(lambda x, d: relative_strength(x, int(d)))
kernel("ts_atr", "@high, @low, @close, d")(lambda h, l, c, d: wilder(true_range(h, l, c), int(d)))
kernel("ts_natr", "@high, @low, @close, d")(lambda h, l, c, d: ratio(100 * wilder(true_range(h, l, c), int(d)), c, 1e-18))


@kernel("ts_keltner", "@high, @low, @close, d, mult=2.0, band='middle', atr_d=None")
def _keltner(h, l, c, d, mult, band, atr_d):
    mid, width = span_ema((h + l + c) / 3, d), float(mult) * wilder(true_range(h, l, c), max(int(atr_d or d), 1))
    return pick(band, middle=mid, upper=mid + width, lower=mid - width)


def _oscillator(base, signal: int, line: str, name: str) -> np.ndarray:
    smooth = span_ema(base, signal)
    return pick(line, **{name: base}, signal=smooth, hist=base - smooth)


kernel("ts_macd", "@child, fast=12, slow=26, signal=9, line='macd'")(lambda x, fast, slow, signal, line: _oscillator(span_ema(x, fast) - span_ema(x, slow), signal, line, "macd"))
kernel("ts_apo", "@child, fast=12, slow=26, signal=9, line='apo'")(lambda x, fast, slow, signal, line: _oscillator(span_ema(x, fast) - span_ema(x, slow), signal, line, "apo"))


@kernel("ts_ppo", "@child, fast=12, slow=26, signal=9, line='ppo'")
def _ppo(x, fast, slow, signal, line):
    base = span_ema(x, slow)
    return _oscillator(100 * ratio(span_ema(x, fast) - base, base), signal, line, "ppo")


@kernel("ts_dema", "@child, d")
def _dema(x, d):
    e = span_ema(x, d)
    return 2 * e - span_ema(e, d)


@kernel("ts_tema", "@child, d")
def _tema(x, d):
    a = span_ema(x, d)
    b = span_ema(a, d)
    return 3 * a - 3 * b + span_ema(b, d)


@kernel("ts_t3", "@child, d, vfactor=0.7")
def _t3(x, d, vfactor):
    # The polynomial of the six means, whose middle terms aren't the textbook's.
    v = float(vfactor)
    weights = {6: -(v**3), 5: 3 * v**2 + 3 * v**3, 4: -3 * v**2 - 2 * v - 3 * v**3, 3: 1 + 2 * v + 3 * v**2 + v**3}
    out, e = 0.0, x
    for k in range(1, 7):
        e = span_ema(e, d)
        out = out + weights.get(k, 0.0) * e
    return out


@kernel("ts_trix", "@child, d")
def _trix(x, d):
    e = span_ema(x, d, 3)
    return 100 * ratio(e - lagged(e), lagged(e))


@kernel("ts_adx", "@high, @low, @close, d, line='adx'")
def _adx(h, l, c, d, line):
    plus, minus, dx = directional(h, l, c, int(d))
    return pick(line, adx=average_dx(dx, int(d)), plus_di=plus, minus_di=minus)


kernel("ts_dx", "@high, @low, @close, d")(lambda h, l, c, d: directional(h, l, c, int(d))[2])


@kernel("ts_adxr", "@high, @low, @close, d")
def _adxr(h, l, c, d):
    adx = average_dx(directional(h, l, c, int(d))[2], int(d))
    return (adx + lagged(adx, int(d))) / 2


@kernel("ts_adosc", "@high, @low, @close, @volume, fast=3, slow=10")
def _adosc(h, l, c, v, fast, slow):
    with np.errstate(invalid="ignore"):
        flow = np.where((h - l > 1e-12) & np.isfinite(v), ratio((c - l) - (h - c), h - l) * v, 0.0)
    line = np.cumsum(flow, axis=1)
    return span_ema(line, fast) - span_ema(line, slow)


@kernel("hump", "@x, hump=0.01")
def _hump(x, hump):
    out = np.full(x.shape, np.nan)
    last = np.full(len(x), np.nan)
    for t in range(x.shape[1]):
        z = x[:, t]
        held = np.where(np.isfinite(last), np.clip(z, last - hump, last + hump), z)
        last = np.where(np.isnan(z), last, held)
        out[:, t] = np.where(np.isnan(z), np.nan, held)
    return out


@kernel("ts_sar", "@high, @low, acceleration=0.02, maximum=0.2")
def _sar(h, l, acceleration, maximum):
    """Parabolic stop and reverse; the first direction is that of the first two bars' mid prices."""
    n, length = h.shape
    out = np.full(h.shape, np.nan)
    if length < 2:
        return out
    with np.errstate(invalid="ignore"):
        rising = h[:, 1] + l[:, 1] > h[:, 0] + l[:, 0]
        stop, extreme = np.where(rising, l[:, 0], h[:, 0]), np.where(rising, h[:, 0], l[:, 0])
        speed = np.full(n, float(acceleration))
        short = np.isnan(h[:, 1:]).all(axis=1) & np.isnan(l[:, 1:]).all(axis=1)  # one bar only
        out[:, 0] = np.where(short, np.nan, stop)
        for t in range(1, length):
            hi, lo = h[:, t], l[:, t]
            alive = np.isfinite(stop)
            nxt = stop + speed * (extreme - stop)
            bound = lambda a, b, less: np.where(less, np.where(b < a, b, a), np.where(b > a, b, a))
            nxt = bound(bound(nxt, np.where(rising, l[:, t - 1], h[:, t - 1]), rising), np.where(rising, lo, hi), rising)
            further = np.where(rising, hi > extreme, lo < extreme)
            extreme = np.where(alive & further, np.where(rising, hi, lo), extreme)
            speed = np.where(alive & further, np.minimum(speed + acceleration, maximum), speed)
            turn = alive & np.where(rising, lo < nxt, hi > nxt)
            nxt = np.where(turn, extreme, nxt)
            extreme = np.where(turn, np.where(rising, lo, hi), extreme)
            speed = np.where(turn, float(acceleration), speed)
            rising = np.where(turn, ~rising, rising)
            stop = np.where(alive, nxt, np.nan)
            out[:, t] = stop
    return out
