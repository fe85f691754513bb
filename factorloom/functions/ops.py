"""The operators of the factor language as column expressions.

Kinds: ROW works on a row; WIN needs window functions, over one instrument (TS) or one timestamp
(CS); KERNEL is a recursion along time (functions.kernels); MACRO is a composition of others. Missing
is NULL throughout; where the arithmetic gives an infinity or NaN, the result is NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from factorloom.plans.dsl import Node, Signature, literal


@dataclass(frozen=True)
class Op:
    name: str
    kind: str
    signature: Signature
    build: Callable[..., Any]


OPS: dict[str, Op] = {}
TS, INST = "timestamp", "instrument"


def CS():
    return Window.partitionBy(TS)


def W():
    return Window.partitionBy(INST).orderBy(TS)


def so_far():
    return W().rowsBetween(Window.unboundedPreceding, 0)



def op(name: str, spec: str, kind: str = "ROW"):
    def add(f):
        OPS[name] = Op(name, kind, Signature.of(spec), f)
        return f

    return add


def R(d: int):
    return W().rowsBetween(-(max(int(d), 1) - 1), 0)


def ok(c: Column) -> Column:
    """c with NaN and infinities as null."""
    return F.when(F.abs(c) < float("inf"), c)


def gate(expr: Column, x: Column, w, n: int) -> Column:
    return F.when(F.count(x).over(w) >= n, expr)


def mp_of(d: int, min_periods: int | None) -> int:
    return d if min_periods is None else max(1, min(int(min_periods), d))


def truthy(c: Column) -> Column:
    return F.coalesce(c > 0.5, F.lit(False))


def clip(x: Column, lo: Column, hi: Column) -> Column:
    """x between lo and hi; a null bound doesn't bind."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, lo), hi))


def nonzero(c: Column) -> Column:
    return F.when(c != 0, c)


def div(a: Column, b: Column) -> Column:
    return ok(F.try_divide(a, b))


def pct_rank(x: Column, *keys: str) -> Column:
    """Average rank over the number of values, in (0, 1], within the keys."""
    part = Window.partitionBy(*keys)
    low = F.rank().over(part.orderBy(x.asc_nulls_last()))
    ties = F.count(x).over(Window.partitionBy(*keys, x))
    return F.when(x.isNotNull(), (low + (ties - 1) / 2) / F.count(x).over(part))


# arithmetic
op("abs", "@x")(lambda x: F.abs(x))
op("log", "@x")(lambda x: F.ln(x))
op("exp", "@x")(lambda x: ok(F.exp(x)))
op("sqrt", "@x")(lambda x: F.when(x >= 0, F.sqrt(x)))
op("sin", "@x")(lambda x: F.sin(x))
op("cos", "@x")(lambda x: F.cos(x))
op("sign", "@x")(lambda x: F.signum(x))
op("reverse", "@x")(lambda x: -x)
op("inverse", "@x")(lambda x: div(F.lit(1.0), x))
op("power", "@x, @y")(lambda x, y: ok(F.pow(x, y)))
op("signed_power", "@x, @y")(lambda x, y: ok(F.signum(x) * F.pow(F.abs(x), y)))
op("divide", "@x, @y")(lambda x, y: div(x, y))


def _fold(f, fill):
    def build(*xs, filter):
        xs = [F.coalesce(x, F.lit(fill)) if filter else x for x in xs]
        out = xs[0]
        for x in xs[1:]:
            out = f(out, x)
        return out

    return build


op("add", "*xs, filter=False")(_fold(lambda a, b: a + b, 0.0))
op("multiply", "*xs, filter=False")(_fold(lambda a, b: a * b, 1.0))
op("subtract", "*xs, filter=False")(_fold(lambda a, b: a - b, 0.0))


def _extreme(f):
    def build(*xs):
        known = xs[0].isNotNull()
        for x in xs[1:]:
            known &= x.isNotNull()
        return F.when(known, f(*xs))

    return build


op("max", "*xs")(_extreme(F.greatest))
op("min", "*xs")(_extreme(F.least))


# logic
op("and_", "@a, @b")(lambda a, b: (truthy(a) & truthy(b)).cast("double"))
op("or_", "@a, @b")(lambda a, b: (truthy(a) | truthy(b)).cast("double"))
op("not_", "@x")(lambda x: F.when(x.isNotNull(), (~truthy(x)).cast("double")))
op("if_else", "@condition, @then_, @else_")(lambda c, t, f: F.when(truthy(c), t).otherwise(f))
op("is_nan", "@x")(lambda x: x.isNull().cast("double"))
for _name, _f in {"lt": lambda a, b: a < b, "le": lambda a, b: a <= b, "eq": lambda a, b: a == b, "gt": lambda a, b: a > b, "ge": lambda a, b: a >= b}.items():
    op(_name, "@a, @b")(lambda a, b, _f=_f: F.coalesce(_f(a, b), F.lit(False)).cast("double"))
op("ne", "@a, @b")(lambda a, b: F.coalesce(a != b, F.lit(True)).cast("double"))

# cleaning
op("pasteurize", "@child, fill_value=None")(lambda x, fill_value: ok(x) if fill_value is None else F.coalesce(ok(x), F.lit(float(fill_value))))
op("protected_div", "@left, @right, epsilon=1e-12, default=0.0")(lambda a, b, epsilon, default: F.when(ok(a).isNotNull() & (F.abs(ok(b)) >= epsilon), F.try_divide(a, b)).otherwise(float(default)))
op("protected_log", "@child, epsilon=1e-12")(lambda x, epsilon: F.when(ok(x).isNotNull(), F.ln(F.greatest(F.abs(x), F.lit(float(epsilon))))))
op("protected_sqrt", "@child")(lambda x: F.sqrt(F.abs(ok(x))))
op("vec_avg", "@x")(lambda x: F.try_divide(F.aggregate(x, F.lit(0.0), lambda a, v: a + v), F.size(x)))
op("vec_sum", "@x")(lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v))

# time series
op("bar_index", "", "WIN")(lambda: F.row_number().over(W()))


def _rolling(name: str, f, least: int = 1):
    @op(name, "@x, d, min_periods=None", "WIN")
    def build(x, d, min_periods):
        return gate(f(x).over(R(d)), x, R(d), max(least, mp_of(d, min_periods)))


_rolling("ts_mean", F.avg)
_rolling("ts_std_dev", F.stddev_samp, 2)
_rolling("ts_std", F.stddev_samp, 2)
_rolling("ts_max", F.max)
_rolling("ts_min", F.min)
_rolling("ts_sum", F.sum)
_rolling("ts_product", F.product)
op("ts_delay", "@x, d", "WIN")(lambda x, d: F.lag(x, int(d)).over(W()) if d >= 0 else F.lead(x, -int(d)).over(W()))
op("delay", "@x, periods", "WIN")(lambda x, periods: OPS["ts_delay"].build(x, periods))
op("ts_delta", "@x, d", "WIN")(lambda x, d: x - OPS["ts_delay"].build(x, d))
op("ts_av_diff", "@x, d", "WIN")(lambda x, d: x - gate(F.avg(x).over(R(d)), x, R(d), d))
op("ts_zscore", "@x, d", "WIN")(lambda x, d: gate(div(x - F.avg(x).over(R(d)), nonzero(F.stddev_samp(x).over(R(d)))), x, R(d), 2))


def _window_share(x, d):
    values = F.collect_list(x).over(R(d))
    return F.when(x.isNotNull(), F.size(F.filter(values, lambda v: v <= x)) / F.size(values))


op("ts_rank", "@x, d, constant=0.0", "WIN")(lambda x, d, constant: _window_share(x, d) + float(constant))


@op("ts_scale", "@x, d, constant=0.0", "WIN")
def _ts_scale(x, d, constant):
    lo, hi = F.min(x).over(R(d)), F.max(x).over(R(d))
    return div(x - lo, nonzero(hi - lo)) + float(constant)


op("ts_count_nans", "@x, d", "WIN")(lambda x, d: gate((F.count(F.lit(1)).over(R(d)) - F.count(x).over(R(d))).cast("double"), x, R(d), 1))


@op("ts_backfill", "@x, lookback, k=1", "WIN")
def _ts_backfill(x, lookback, k):
    v = F.collect_list(x).over(R(lookback))
    return F.when(F.size(v) >= k, F.get(v, F.size(v) - int(k))).otherwise(F.get(v, F.lit(0)))


def _arg(name, pick):
    op(f"_{name}", "@x, @rn, d", "WIN")(lambda x, rn, d: F.when(F.count(x).over(R(d)) > 0, (rn - pick(x, rn, R(d))).cast("double")))
    op(name, "@x, d", "MACRO")(lambda x, d: Node(f"_{name}", (x, Node("bar_index")), (("d", d),)))


_arg("ts_arg_max", lambda x, rn, w: -F.max(F.when(x.isNotNull(), F.struct(x.alias("v"), (-rn).alias("i")))).over(w)["i"])
_arg("ts_arg_min", lambda x, rn, w: F.min(F.when(x.isNotNull(), F.struct(x.alias("v"), rn.alias("i")))).over(w)["i"])


@op("ts_decay_linear", "@x, d, dense=False", "WIN")
def _ts_decay_linear(x, d, dense):
    v = F.collect_list(F.struct(x.alias("v"))).over(R(d))
    v = F.transform(v, lambda e: e["v"])
    used = F.filter(v, lambda e: e.isNotNull()) if dense else v
    n = F.size(used)
    dot = F.aggregate(F.zip_with(used, F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return F.when(n > 0, dot / (n * (n + 1) / 2))


op("ts_wma", "@child, d", "WIN")(lambda x, d: gate(_ts_decay_linear(x, d, False), x, R(d), d))


def _both(x, y):
    known = x.isNotNull() & y.isNotNull()
    return F.when(known, x), F.when(known, y)


@op("ts_corr", "@x, @y, d", "WIN")
def _ts_corr(x, y, d):
    a, b = _both(x, y)
    spread = F.stddev_pop(a).over(R(d)) * F.stddev_pop(b).over(R(d))  # corr itself divides by it unguarded
    return gate(ok(F.try_divide(F.covar_pop(a, b).over(R(d)), spread)), a, R(d), 2)


op("ts_covariance", "@y, @x, d", "WIN")(lambda y, x, d: gate(F.covar_samp(y, x).over(R(d)), _both(x, y)[0], R(d), 2))


@op("_ts_regression", "@y, @x, @xl, @rn, d, lag, rettype", "WIN")
def _ts_regression(y, x, xl, rn, d, lag, rettype):
    def fit(x, w):
        a, b = _both(y, x)
        n = F.count(a).over(w)
        sxx, syy, sxy = F.regr_sxx(a, b).over(w), F.regr_syy(a, b).over(w), F.regr_sxy(a, b).over(w)
        beta = F.when(n >= 2, F.try_divide(sxy, nonzero(sxx)))
        alpha = F.avg(a).over(w) - beta * F.avg(b).over(w)
        sse = F.greatest(syy - beta * sxy, F.lit(0.0))
        return F.struct(n.alias("n"), alpha.alias("alpha"), beta.alias("beta"), F.when(beta.isNotNull(), sse).alias("sse"), F.when(beta.isNotNull(), syy).alias("sst"))

    plain = fit(x, R(d))
    if lag > 0 and d > lag:
        f = F.when(rn > lag, fit(xl, W().rowsBetween(-(d - 1) + lag, 0))).otherwise(plain)
    else:
        f = plain
    fitted = f["alpha"] + f["beta"] * x
    return {
        1: f["alpha"],
        2: f["beta"],
        3: fitted,
        4: f["sse"],
        5: f["sst"],
        6: 1 - F.try_divide(f["sse"], nonzero(f["sst"])),
        7: F.when(f["n"] > 2, f["sse"] / (f["n"] - 2)),
    }.get(int(rettype), y - fitted)


@op("ts_regression", "@y, @x, d, lag=0, rettype=0", "MACRO")
def _regression(y, x, d, lag, rettype):
    lagged = Node("ts_delay", (x,), (("d", lag),)) if lag else x
    return Node("_ts_regression", (y, x, lagged, Node("bar_index")), (("d", d), ("lag", lag), ("rettype", rettype)))


# Coefficients of the AS241 rational approximation of the normal quantile.
_A = (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3)
_B = (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3)
_C = (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4)
_D = (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9)
_E = (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7)
_FF = (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)


def normal_quantile(p: Column) -> Column:
    def poly(c, r):
        out = F.lit(c[-1])
        for k in reversed(c[:-1]):
            out = out * r + k
        return out

    q = p - 0.5
    mid = 0.180625 - q * q
    r = F.sqrt(-F.ln(F.when(q < 0, p).otherwise(1 - p)))
    near, far = poly(_C, r - 1.6) / poly(_D, r - 1.6), poly(_E, r - 5.0) / poly(_FF, r - 5.0)
    tail = F.when(r <= 5.0, near).otherwise(far)
    return F.when(F.abs(q) <= 0.425, q * poly(_A, mid) / poly(_B, mid)).otherwise(F.when(q < 0, -tail).otherwise(tail))


def _clipped(p):
    return F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))


def _gaussian(driver):
    if str(driver).lower() != "gaussian":
        raise ValueError(f"quantile driver {driver!r} isn't available")


@op("_probit", "@p, sigma")
def _probit(p, sigma):
    return F.when(p.isNotNull(), normal_quantile(_clipped(p))) * float(sigma)


op("_share", "@x, d", "WIN")(lambda x, d: gate(_window_share(x, d), x, R(d), 2))


@op("ts_quantile", "@x, d, driver='gaussian'", "MACRO")
def _ts_quantile(x, d, driver):
    _gaussian(driver)
    return Node("_probit", (Node("_share", (x,), (("d", d),)),), (("sigma", 1.0),))


op("_since_change", "@changed, @rn", "WIN")(lambda c, rn: (rn - F.coalesce(F.max(F.when(c > 0, rn)).over(W().rowsBetween(Window.unboundedPreceding, 0)), F.lit(1))).cast("double"))
op("_changed", "@x, @rn", "WIN")(lambda x, rn: ((rn > 1) & ~x.eqNullSafe(F.lag(x).over(W()))).cast("int"))
op("days_from_last_change", "@x", "MACRO")(lambda x: Node("_since_change", (Node("_changed", (x, Node("bar_index"))), Node("bar_index"))))
op("kth_element", "@x, d, k, ignore='NaN'", "WIN")(lambda x, d, k, ignore: F.get(F.array_sort(F.collect_list(x).over(R(d))), F.lit(int(k) - 1)))


@op("last_diff_value", "@x, d", "WIN")
def _last_diff_value(x, d):
    if d < 2:
        return F.lit(None).cast("double")
    v = F.filter(F.collect_list(x).over(W().rowsBetween(-(d - 1), -1)), lambda e: e != x)
    return F.get(v, F.size(v) - 1)


def _moment(name, least, f):
    @op(name, "@x, d, min_periods=None", "WIN")
    def build(x, d, min_periods):
        n = F.count(x).over(R(d))
        return F.when(F.var_pop(x).over(R(d)) > 0, gate(ok(f(x, n, R(d))), x, R(d), max(least, mp_of(d, min_periods))))


_moment("ts_skew", 3, lambda x, n, w: F.skewness(x).over(w) * F.sqrt(n * (n - 1)) / (n - 2))
_moment("ts_kurt", 4, lambda x, n, w: (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x).over(w) + 6))
op("ts_step", "d, @anchor", "WIN")(lambda anchor, d: ((F.row_number().over(W()) - 1) % max(1, int(d))).cast("double"))

# cross-section
op("rank", "@x, rate=2", "WIN")(lambda x, rate: pct_rank(x, TS))
op("zscore", "@x", "WIN")(lambda x: div(x - F.avg(x).over(CS()), nonzero(F.stddev_samp(x).over(CS()))))


@op("normalize", "@x, useStd=False, limit=0.0", "WIN")
def _normalize(x, useStd, limit):
    out = x - F.avg(x).over(CS())
    if useStd:
        out = div(out, nonzero(F.stddev_samp(x).over(CS())))
    return clip(out, F.lit(-float(limit)), F.lit(float(limit))) if limit > 0 else out


@op("quantile", "@x, driver='gaussian', sigma=1.0", "MACRO")
def _quantile(x, driver, sigma):
    _gaussian(driver)
    return Node("_probit", (Node("rank", (x,), (("rate", 2),)),), (("sigma", sigma),))


@op("scale", "@x, scale=1.0, longscale=1.0, shortscale=1.0", "WIN")
def _scale(x, scale, longscale, shortscale):
    up, down = F.sum(F.when(x > 0, x)).over(CS()), F.sum(F.when(x < 0, -x)).over(CS())
    return F.when(x > 0, x / up * float(scale * longscale)).when(x < 0, x / down * float(scale * shortscale)).otherwise(x)


@op("winsorize", "@x, std=4.0", "WIN")
def _winsorize(x, std):
    mean, sd = F.avg(x).over(CS()), nonzero(F.stddev_samp(x).over(CS()))
    return clip(x, mean - float(std) * sd, mean + float(std) * sd)


@op("neutralize", "@x, @y", "WIN")
def _neutralize(x, y):
    a, b = _both(x, y)
    sxx = F.regr_sxx(a, b).over(CS())
    beta = F.when((F.count(a).over(CS()) >= 2) & (sxx >= 1e-18), F.try_divide(F.regr_sxy(a, b).over(CS()), sxx))
    return a - F.avg(a).over(CS()) - beta * (b - F.avg(b).over(CS()))


@op("orthogonalize", "@x, @y", "WIN")
def _orthogonalize(x, y):
    a, b = _both(x, y)
    yy = F.sum(b * b).over(CS())
    return F.when((F.count(a).over(CS()) >= 2) & (yy > 0), a - F.sum(a * b).over(CS()) / yy * b)


op("_densify", "@x, @first", "WIN")(lambda x, first: F.when(x.isNull(), -1.0).otherwise((F.dense_rank().over(CS().orderBy(F.when(x.isNotNull(), first).asc_nulls_last())) - 1).cast("double")))
op("_first_of_value", "@x", "WIN")(lambda x: F.min(INST).over(Window.partitionBy(TS, x)))
op("densify", "@x", "MACRO")(lambda x: Node("_densify", (x, Node("_first_of_value", (x,)))))
op("tail", "@child, lower=0.01, upper=0.99", "WIN")(lambda x, lower, upper: clip(x, F.percentile(x, F.lit(float(lower))).over(CS()), F.percentile(x, F.lit(float(upper))).over(CS())))


@op("bucket", "@x, range=None, buckets=None, skipBoth=False, NaNGroup=False", "WIN")
def _bucket(x, range, buckets, skipBoth, NaNGroup):
    r = pct_rank(x, TS)
    last = None
    if buckets is not None and str(buckets).strip().lstrip("+-").isdigit():
        n = max(1, int(str(buckets).strip()))
        out, last = F.floor(F.least(r, F.lit(1 - 1e-15)) * n).cast("double"), n - 1 if n >= 3 else None
    elif range is not None and str(range).strip():
        cuts = sorted({float(p) for p in str(range).split(",") if p.strip() and 0 < float(p) < 1})
        if not cuts:
            return F.lit(None).cast("double")
        out = sum((r >= c).cast("double") for c in cuts)
        last = len(cuts)
    else:
        return F.lit(None).cast("double")
    if skipBoth and last is not None:
        out = F.when((out != 0) & (out != last), out)
    out = F.when(x.isNotNull(), out)
    return F.when(x.isNull(), -1.0).otherwise(out) if NaNGroup else out


op("change_instrument", "@child, benchmark_column", "MACRO")(lambda x, benchmark_column: Node("divide", (x, Node("_cs_mean", (Node("col", (), (("name", benchmark_column),)),)))))
op("_cs_mean", "@x", "WIN")(lambda x: F.avg(x).over(CS()))


# groups within a timestamp; they need the group as a materialised column, which a node always is
def _group(g):
    return Window.partitionBy(TS, g)


op("group_mean", "@x, @weight, @group", "WIN")(lambda x, w, g: F.when(g.isNotNull(), F.try_divide(F.coalesce(F.sum(x * w).over(_group(g)), F.lit(0.0)), nonzero(F.sum(w).over(_group(g))))))
op("group_neutralize", "@x, @group", "WIN")(lambda x, g: F.when(g.isNotNull(), x - F.avg(x).over(_group(g))))
op("group_zscore", "@x, @group", "WIN")(lambda x, g: F.when(g.isNotNull(), div(x - F.avg(x).over(_group(g)), nonzero(F.stddev_samp(x).over(_group(g))))))


@op("group_rank", "@x, @group", "WIN")
def _group_rank(x, g):
    low = F.rank().over(_group(g).orderBy(x.asc_nulls_last()))
    ties = F.count(x).over(Window.partitionBy(TS, g, x))
    return F.when(x.isNotNull() & g.isNotNull(), (low + (ties - 1) / 2) / F.count(x).over(_group(g)))


@op("group_scale", "@x, @group", "WIN")
def _group_scale(x, g):
    lo, hi = F.min(x).over(_group(g)), F.max(x).over(_group(g))
    return F.when(g.isNotNull(), div(x - lo, nonzero(hi - lo)))


@op("group_backfill", "@x, @group, d, std=4.0", "WIN")
def _group_backfill(x, g, d, std):
    past = F.collect_list(F.when(x.isNotNull(), F.struct(x.alias("v"), g.alias("g")))).over(W().rowsBetween(-int(d), -1))
    v = F.transform(F.filter(past, lambda e: e["g"] == g), lambda e: e["v"])
    n = F.size(v)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, e: s + e)
    mean = total(v) / n
    sd = F.sqrt(total(F.transform(v, lambda e: (e - mean) * (e - mean))) / n)
    clipped = F.when(sd > 0, total(F.transform(v, lambda e: F.least(F.greatest(e, mean - float(std) * sd), mean + float(std) * sd))) / n).otherwise(mean)
    return F.when(x.isNotNull(), x).when(n > 0, clipped)


@op("trade_when", "@trigger, @alpha, @exit_", "WIN")
def _trade_when(trigger, alpha, exit_):
    out, enter = truthy(exit_), truthy(trigger)
    state = F.when(out | enter, F.struct(F.when(~out, alpha).alias("a")))
    return F.last(state, ignorenulls=True).over(W().rowsBetween(Window.unboundedPreceding, 0))["a"]


# technical indicators without a recursion
def _sma(x, d):
    return F.avg(x).over(R(d))


op("ts_sma", "@child, d", "WIN")(lambda x, d: _sma(x, d))


def _band(band, mid, width):
    return {"upper": mid + width, "lower": mid - width}.get(str(band).lower(), mid)


op("ts_bbands", "@child, d, nbdev=2.0, band='middle'", "WIN")(lambda x, d, nbdev, band: _band(band, _sma(x, d), float(nbdev) * F.stddev_samp(x).over(R(d))))


@op("ts_trange", "@high, @low, @close", "WIN")
def _trange(h, l, c):
    pc = F.lag(c).over(W())
    tr = _extreme(F.greatest)(h - l, F.abs(h - pc), F.abs(l - pc))
    return F.when(F.row_number().over(W()) == 1, h - l).otherwise(tr)


@op("ts_donchian", "@high, @low, d, band='middle'", "WIN")
def _donchian(h, l, d, band):
    hi, lo = F.max(h).over(R(d)), F.min(l).over(R(d))
    return {"upper": hi, "lower": lo}.get(str(band).lower(), (hi + lo) / 2)


@op("ts_ma_envelope", "@child, d, pct=0.025, band='middle', use_ema=False", "MACRO")
def _ma_envelope(x, d, pct, band, use_ema):
    mid = Node("ts_ema" if use_ema else "ts_sma", (x,), (("d", d),))
    k = {"upper": 1 + pct, "lower": 1 - pct}.get(str(band).lower(), 1.0)
    return Node("multiply", (mid, literal(k)), (("filter", False),))


@op("ts_cci", "@high, @low, @close, d", "WIN")
def _cci(h, l, c, d):
    tp = (h + l + c) / 3
    v = F.collect_list(tp).over(R(d))
    mean = _sma(tp, d)
    mad = F.aggregate(F.transform(v, lambda e: F.abs(e - mean)), F.lit(0.0), lambda a, b: a + b) / F.size(v)
    # like a window with a gap, which has no mean deviation
    whole = F.size(v) == F.count(F.lit(1)).over(R(d))
    return F.when(whole, div(tp - mean, 0.015 * F.when(mad > 0, mad)))


def _fast_k(h, l, c, d):
    lo, hi = F.min(l).over(R(d)), F.max(h).over(R(d))
    return F.when(hi - lo > 0, 100 * (c - lo) / (hi - lo))


op("_fast_k", "@high, @low, @close, d", "WIN")(_fast_k)


def _mean_of(x: Node, d: int) -> Node:
    return Node("ts_sma", (x,), (("d", d),))


@op("ts_stoch", "@high, @low, @close, fastk_period=5, slowk_period=3, slowd_period=3, line='slowk'", "MACRO")
def _stoch(h, l, c, fastk_period, slowk_period, slowd_period, line):
    k = _mean_of(Node("_fast_k", (h, l, c), (("d", fastk_period),)), slowk_period)
    return _mean_of(k, slowd_period) if str(line).lower() == "slowd" else k


@op("ts_stochf", "@high, @low, @close, fastk_period=5, fastd_period=3, line='fastk'", "MACRO")
def _stochf(h, l, c, fastk_period, fastd_period, line):
    k = Node("_fast_k", (h, l, c), (("d", fastk_period),))
    return _mean_of(k, fastd_period) if str(line).lower() == "fastd" else k


@op("ts_stochrsi", "@child, timeperiod=14, fastk_period=5, fastd_period=3, line='fastk'", "MACRO")
def _stochrsi(x, timeperiod, fastk_period, fastd_period, line):
    rsi = Node("ts_rsi", (x,), (("d", timeperiod),))
    k = Node("multiply", (Node("ts_scale", (rsi,), (("d", fastk_period), ("constant", 0.0))), literal(100.0)), (("filter", False),))
    return _mean_of(k, fastd_period) if str(line).lower() == "fastd" else k


@op("ts_willr", "@high, @low, @close, d", "WIN")
def _willr(h, l, c, d):
    lo, hi = F.min(l).over(R(d)), F.max(h).over(R(d))
    return F.when(hi - lo > 0, -100 * (hi - c) / (hi - lo))


op("ts_mom", "@child, d", "WIN")(lambda x, d: x - F.lag(x, int(d)).over(W()))
op("ts_roc", "@child, d", "WIN")(lambda x, d: div(x - F.lag(x, int(d)).over(W()), F.lag(x, int(d)).over(W())) * 100)
op("ts_rocr", "@child, d", "WIN")(lambda x, d: div(x, F.lag(x, int(d)).over(W())))
op("ts_rocr100", "@child, d", "WIN")(lambda x, d: (div(x, F.lag(x, int(d)).over(W())) - 1) * 100)


def _running(term: Column) -> Column:
    """Running total of a materialised term; null from the first missing term on."""
    return F.when(F.count(term).over(so_far()) == F.count(F.lit(1)).over(so_far()), F.sum(term).over(so_far()))


op("_running", "@term", "WIN")(_running)
op("_signed_volume", "@close, @volume", "WIN")(lambda c, v: F.when(F.row_number().over(W()) == 1, 0.0 * v).otherwise(F.signum(c - F.lag(c).over(W())) * v))
op("ts_obv", "@close, @volume", "MACRO")(lambda c, v: Node("_running", (Node("_signed_volume", (c, v)),)))


def _money_flow(h, l, c, v):
    rng = h - l
    return F.when((rng > 1e-12) & v.isNotNull(), ((c - l) - (h - c)) / rng * v).otherwise(0.0)


op("_money_flow", "@high, @low, @close, @volume")(_money_flow)
op("ts_ad", "@high, @low, @close, @volume", "MACRO")(lambda h, l, c, v: Node("_running", (Node("_money_flow", (h, l, c, v)),)))


op("_typical", "@high, @low, @close")(lambda h, l, c: (h + l + c) / 3)
op("_signed_flow", "@tp, @volume, sign", "WIN")(
    lambda tp, v, sign: F.when(F.coalesce((tp - F.lag(tp).over(W())) * sign > 0, F.lit(False)), tp * v).otherwise(0.0)
)
op("_flow_index", "@pos, @neg, d", "WIN")(lambda p, n, d: 100 - 100 / (1 + F.sum(p).over(R(d)) / F.when(F.sum(n).over(R(d)) > 0, F.sum(n).over(R(d)))))


@op("ts_mfi", "@high, @low, @close, @volume, d", "MACRO")
def _mfi(h, l, c, v, d):
    tp = Node("_typical", (h, l, c))
    pos, neg = (Node("_signed_flow", (tp, v), (("sign", s),)) for s in (1, -1))
    return Node("_flow_index", (pos, neg), (("d", d),))


op("_move", "@x, sign", "WIN")(lambda x, sign: F.greatest(F.coalesce((x - F.lag(x).over(W())) * sign, F.lit(0.0)), F.lit(0.0)))


@op("_cmo", "@up, @down, d", "WIN")
def _cmo(up, down, d):
    a, b = F.sum(up).over(R(d)), F.sum(down).over(R(d))
    return 100 * F.try_divide(a - b, nonzero(a + b))


op("ts_cmo", "@child, d", "MACRO")(lambda x, d: Node("_cmo", tuple(Node("_move", (x,), (("sign", s),)) for s in (1, -1)), (("d", d),)))


@op("ts_aroon", "@high, @low, d, line='up'", "MACRO")
def _aroon(h, l, d, line):
    side = lambda name, x: Node("_aroon", (Node(f"_{name}", (x, Node("bar_index")), (("d", d),)), x, Node("bar_index")), (("d", d),))
    up, down = side("ts_arg_max", h), side("ts_arg_min", l)
    if str(line).lower() == "osc":
        return Node("subtract", (up, down), (("filter", False),))
    return down if str(line).lower() == "down" else up


# the position of a missing value counts as the extreme, as argmax and argmin of numpy have it
@op("_aroon", "@ago, @x, @rn, d", "WIN")
def _aroon_line(ago, x, rn, d):
    gap = rn - F.min(F.when(x.isNull(), rn)).over(R(d))
    return F.when(rn >= d, 100 * (d - F.coalesce(gap, ago)) / d)


@op("_buying", "@low, @close", "WIN")
def _buying(l, c):
    pc = F.when(F.row_number().over(W()) == 1, c).otherwise(F.lag(c).over(W()))
    return c - _extreme(F.least)(l, pc)


@op("_true_span", "@high, @low, @close", "WIN")
def _true_span(h, l, c):
    pc = F.when(F.row_number().over(W()) == 1, c).otherwise(F.lag(c).over(W()))
    return _extreme(F.greatest)(h, pc) - _extreme(F.least)(l, pc)


@op("_ultosc", "@bp, @tr, p1, p2, p3", "WIN")
def _ultosc(bp, tr, p1, p2, p3):
    avg = lambda p: F.sum(bp).over(R(p)) / F.when(F.sum(tr).over(R(p)) > 1e-12, F.sum(tr).over(R(p)))
    return 100 * (4 * avg(p1) + 2 * avg(p2) + avg(p3)) / 7


@op("ts_ultosc", "@high, @low, @close, timeperiod1=7, timeperiod2=14, timeperiod3=28", "MACRO")
def _ultosc_macro(h, l, c, timeperiod1, timeperiod2, timeperiod3):
    return Node("_ultosc", (Node("_buying", (l, c)), Node("_true_span", (h, l, c))), (("p1", timeperiod1), ("p2", timeperiod2), ("p3", timeperiod3)))


@op("ts_trima", "@child, d", "MACRO")
def _trima(x, d):
    return _mean_of(_mean_of(x, (d + 2) // 2), (d + 1) // 2 + 1)


@op("ts_bop", "@high, @low, @close", "WIN")
def _bop(h, l, c):
    o = F.when(F.row_number().over(W()) == 1, c).otherwise(F.lag(c).over(W()))
    return F.when(h - l > 1e-12, (c - o) / (h - l))


@op("_slope", "@x, @rn, d", "WIN")
def _slope(x, rn, d):
    return gate(F.regr_slope(x, rn.cast("double")).over(R(d)), x, R(d), d) if d >= 2 else F.lit(None).cast("double")


op("ts_linearreg_slope", "@child, d", "MACRO")(lambda x, d: Node("_slope", (x, Node("bar_index")), (("d", d),)))
op("_angle", "@x")(lambda x: F.degrees(F.atan(x)))
op("ts_linearreg_angle", "@child, d", "MACRO")(lambda x, d: Node("_angle", (Node("_slope", (x, Node("bar_index")), (("d", d),)),)))
