"""Implausible values in series of measurements, judged by each source's own behaviour.

A local-level state-space model runs over every series forwards and backwards: a Kalman filter
predicts each value, an innovation beyond the threshold is flagged and its update withheld, and
after three flagged values in a row the filter starts anew at the new level. A value that both
passes flag is a candidate; the rule of the measurement then decides. A size (a return, say) has the
level zero, so its two passes are one, and its candidates begin at GATE of the rule's bound. Where the
variance of the standardised innovations vanishes, values are candidates for stuck ones, and the very
same value six times decides.

What is usual is that of the whole source, by a mergeable quantile sketch. A source is numbered in
slices of its days, whose row counts add up, and cut into tiles of records with a halo on either
side; so neither numbering nor filtering gathers a source in a task. Within a task all cells run at
once: one numpy step per position, over the cells of a block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.common import broadcast_if_small, cut_lineage, group_count, task_count

TILE, HALO, BLOCK = 512, 128, 512
FLAG_AT = 3.0  # standardised innovation beyond which a value is flagged
LEVEL_RUN = 3  # so many flagged values in a row are a new level
STUCK_RUN = 6
CALM = 1e-4  # variance of the last two standardised innovations below which it has vanished
LEAST_SCALE = 1e-9  # stands for the usual move of a source that never moves
GATE = 0.9  # candidates of kind 'size' begin at this part of the bound in the exact rule
LEAST_STEPS = 5  # a source with fewer moves (or sizes) has no usual one
SLICE = 7  # leading characters of a day that make a slice: a month
SLICE_ROWS = 1_000_000  # a month of more records is cut into its days
ACCURACY = 100_000  # of the sketch of usual moves; it is exact for sources of fewer moves


@dataclass(frozen=True)
class Measure:
    """How one measurement behaves.

    kind 'ratio': moves are relative, a spike is more than times_move usual moves off the level;
    'factor': a spike is more than factor times above or below the level; 'size': a spike exceeds
    times_move times the usual size. A value below least (or at it, if least_open) is impossible.
    """

    kind: str
    least: float
    least_open: bool
    times_move: float = 10.0
    factor: float = 50.0


def _run_filter(x: np.ndarray, q: np.ndarray, r: np.ndarray, level_fixed: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """One pass over the columns of x, missing values being NaN: the flagged ones, and those at which
    the variance of the standardised innovations has vanished."""
    n, length = x.shape
    level, var = np.zeros(n), np.zeros(n)
    begun, run = np.full(n, level_fixed), np.zeros(n, int)
    before = np.full(n, np.inf)  # squared standardised innovation of the value before
    flags, calm = np.zeros((n, length), bool), np.zeros((n, length), bool)
    for t in range(length):
        z = x[:, t]
        seen = ~np.isnan(z)
        var = var + q
        s = var + r
        innovation = z - level
        with np.errstate(invalid="ignore", over="ignore"):
            power = np.where(begun, innovation**2 / s, np.inf)
            flag = seen & begun & (power > FLAG_AT**2)
            calm[:, t] = seen & (power + before < 2 * CALM)
        before = np.where(seen, power, before)
        run = np.where(seen, np.where(flag, run + 1, 0), run)
        anew = seen & (~begun | (run >= LEVEL_RUN)) & (not level_fixed)
        gain = np.where(seen & ~flag & ~anew, var / s, 0.0)  # of a size it stays 0, as var does
        level = np.where(anew, z, level + np.where(gain > 0, gain * np.nan_to_num(innovation), 0.0))
        var = np.where(anew, r, (1 - gain) * var)
        run = np.where(anew, 0, run)
        begun |= seen
        flags[:, t] = flag
    return flags, calm


def _walk(x: np.ndarray, sd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A pass in which the level follows nearly every move, as that of kind 'ratio' does."""
    return _run_filter(x, sd**2, 0.05 * sd**2)


def _candidates(x: np.ndarray, raw: np.ndarray, scale: np.ndarray, m: Measure) -> tuple[np.ndarray, np.ndarray]:
    """Masks of x (in the model's scale; raw keeps idle records): maybe spikes, maybe the end of a stuck run."""
    known = ~np.isnan(scale)
    sd = np.where(known, np.maximum(scale, LEAST_SCALE), LEAST_SCALE) * 1.4826
    if m.kind == "size":
        flags = _run_filter(x, np.zeros(len(x)), (GATE * m.times_move * scale / FLAG_AT) ** 2, level_fixed=True)[0]
        return flags & known[:, None], _walk(raw, sd)[1]
    if m.kind == "factor":
        wide = np.minimum(sd, np.log(m.factor) / (2 * FLAG_AT))
        q, r = 0.2 * wide**2, wide**2
        flags, calm = _run_filter(x, q, r)[0], _walk(raw, sd)[1]
    else:
        q, r = sd**2, 0.05 * sd**2
        flags, calm = _run_filter(x, q, r)
    flags &= known[:, None]
    some = flags.any(axis=1)  # what the other pass can't confirm needs no other pass
    flags[some] &= _run_filter(x[some][:, ::-1], q[some], r[some])[0][:, ::-1]
    return flags, calm


def _to_left(x: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's kept values in front, NaN after them, and the columns that they come from."""
    order = np.argsort(~keep, axis=1, kind="stable")
    out = np.take_along_axis(x, order, axis=1)
    out[np.arange(x.shape[1]) >= keep.sum(axis=1)[:, None]] = np.nan
    return out, order


def _median3(values: np.ndarray, row: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The median of the known ones among values[row, first : first + 3]; NaN if there are none."""
    at = first[:, None] + np.arange(3)
    inside = (at >= 0) & (at < values.shape[1])
    v = np.sort(np.where(inside, values[row[:, None], np.clip(at, 0, values.shape[1] - 1)], np.nan), axis=1)  # NaN last
    n = (~np.isnan(v)).sum(axis=1)
    return np.select([n == 3, n == 2, n == 1], [v[:, 1], (v[:, 0] + v[:, 1]) / 2, v[:, 0]], np.nan)


def _spikes(x: np.ndarray, flags: np.ndarray, scale: np.ndarray, m: Measure) -> np.ndarray:
    """The exact rule on the flagged values of x: alone or two in a row among those present, and far off."""
    found = np.zeros(x.shape, bool)
    some = np.nonzero(flags.any(axis=1))[0]
    if not len(some):
        return found
    scale, flags = scale[some], flags[some]
    v, order = _to_left(x[some], ~np.isnan(x[some]))
    c = np.take_along_axis(flags, order, axis=1) & ~np.isnan(v)
    if m.kind == "size":
        with np.errstate(invalid="ignore"):
            c &= np.abs(v) > m.times_move * scale[:, None]  # a candidate within the bound makes no run longer
    edge = np.zeros((len(c), 1), bool)
    row, start = np.nonzero(c & ~np.hstack([edge, c[:, :-1]]))
    stop = np.nonzero(c & ~np.hstack([c[:, 1:], edge]))[1]
    short = stop - start < 2
    row, start, stop = row[short], start[short], stop[short]
    hit = np.ones((len(row), 2), bool)
    if m.kind != "size":
        good = ~c & ~np.isnan(v)
        level, _ = _to_left(v, good)
        passed = np.cumsum(good, axis=1)[row, start]  # good values before the run
        before, after = _median3(level, row, passed - 3), _median3(level, row, passed)
        bound = np.full(len(row), np.log(m.factor)) if m.kind == "factor" else m.times_move * scale[row]
        for k, at in enumerate((start, stop)):
            a, b = v[row, at] - before, v[row, at] - after
            with np.errstate(invalid="ignore"):
                hit[:, k] = (np.minimum(np.abs(a), np.abs(b)) > bound) & (np.sign(a) == np.sign(b))
    for k, at in enumerate((start, stop)):
        found[some[row], order[row, at]] |= hit[:, k]
    return found


def _stuck(value: np.ndarray, idle: np.ndarray, calm: np.ndarray) -> np.ndarray:
    """The exact rule on rows with a calm value: runs of STUCK_RUN columns or more of the very same value, one of them calm."""
    out = np.zeros(value.shape, bool)
    rows = np.nonzero(calm.any(axis=1))[0]
    if not len(rows):
        return out
    value, idle, calm = value[rows], idle[rows], calm[rows]
    same = np.zeros(value.shape, bool)
    same[:, 1:] = (value[:, 1:] == value[:, :-1]) & ~idle[:, 1:] & ~idle[:, :-1]
    run = np.cumsum(~same.ravel()) - 1  # a run ends with its row, as no first column is like the one before
    long = np.bincount(run) >= STUCK_RUN
    still = np.bincount(run, weights=(calm & ~idle).ravel()) > 0
    out[rows] = (long & still)[run].reshape(value.shape) & ~np.isnan(value) & ~idle
    return out


OUT = pa.schema([("cell", pa.string()), ("pos", pa.int64()), ("reason", pa.string())])


def _judge(part: pa.Table, m: Measure, width: int) -> pa.Table:
    """cell, position and reason of the implausible values among the records of one measure."""
    enc = part["cell"].combine_chunks().dictionary_encode()
    code, pos = enc.indices.to_numpy(), part["pos"].to_numpy()
    order = np.lexsort((pos, code))
    code, pos = code[order], pos[order]
    value = part["value"].to_numpy(zero_copy_only=False).astype(float)[order]
    idle = part["idle"].to_numpy(zero_copy_only=False)[order].astype(bool)
    tile = part["tile"].to_numpy()[order]
    scale = part["scale"].to_numpy(zero_copy_only=False).astype(float)[order]
    starts = np.searchsorted(code, np.arange(len(enc.dictionary) + 1))
    out = []
    for lo in range(0, len(starts) - 1, BLOCK):
        hi = min(lo + BLOCK, len(starts) - 1)
        a, b = starts[lo], starts[hi]
        row = code[a:b] - lo
        col = np.arange(a, b) - starts[code[a:b]]
        shape = (hi - lo, int(col.max()) + 1)
        v, off = np.full(shape, np.nan), np.zeros(shape, bool)
        v[row, col], off[row, col] = value[a:b], idle[a:b]
        usual = scale[starts[lo:hi]]
        impossible = np.isinf(v) | (v < m.least) | ((v == m.least) & m.least_open)
        raw = np.where(impossible, np.nan, v)
        raw = raw if m.kind == "size" else np.log(np.maximum(raw, LEAST))
        x = np.where(off, np.nan, raw) if m.kind == "size" else raw
        flags, calm = _candidates(x, raw, usual, m)
        reason = np.where(impossible, "impossible", np.where(_stuck(v, off, calm), "stuck", np.where(_spikes(x, flags, usual, m), "spike", "")))[row, col]
        keep = (reason != "") & (pos[a:b] // width == tile[a:b])
        out.append(pa.table([pc.take(enc.dictionary, pa.array(code[a:b][keep])), pa.array(pos[a:b][keep]), pa.array(reason[keep].tolist(), pa.string())], schema=OUT))
    return pa.concat_tables(out) if out else OUT.empty_table()


FOUND = pa.schema([("measure", pa.string()), ("source", pa.string()), ("day", pa.string()), ("value", pa.float64()), ("reason", pa.string())])


def _found(table: pa.Table, measures: dict[str, Measure], width: int) -> pa.Table:
    """The flagged records of one group of cells, with their days and values."""
    out = []
    for name in pc.unique(table["measure"]).to_pylist():
        own = table.filter(pc.equal(table["measure"], name))
        hit = _judge(own, measures[name], width)
        if hit.num_rows:
            hit = hit.join(own.select(["cell", "pos", "source", "day", "value"]), ["cell", "pos"], join_type="inner")
            out.append(pa.table([pa.array([name] * hit.num_rows), hit["source"], hit["day"], hit["value"], hit["reason"]], schema=FOUND))
    return pa.concat_tables(out) if out else FOUND.empty_table()


LEAST = 1e-9  # what the logarithm of 0 is taken of


def _model_value(measures: dict[str, Measure]) -> Column:
    """value as the model sees it, null where it is impossible (or says nothing, as of an idle size)."""
    v, out = F.col("value"), F.lit(None).cast("double")
    for name, m in measures.items():
        possible = (F.abs(v) < float("inf")) & ((v > m.least) if m.least_open else (v >= m.least))
        x = F.when(~F.col("idle"), v) if m.kind == "size" else F.log(F.greatest(v, F.lit(LEAST)))
        out = F.when((F.col("measure") == name) & possible, x).when(F.col("measure") == name, None).otherwise(out)
    return out


def _median(step: Column) -> tuple[Column, Column]:
    """The two middle values of step, which are one for an odd number of them."""
    both = F.percentile_approx(step, F.array(F.lit(0.5), F.lit(0.5 + 1e-9)), ACCURACY)
    return both[0], both[1]


def implausible_values(records: DataFrame, measures: dict[str, Measure], *, width: int = TILE, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(measure, source, day, value, reason) of the values that cannot be real.

    records has measure, source, day (string or date, gives the order), value (double) and idle
    (boolean; an idle record is never stuck and tells nothing about the usual size). reason is
    'impossible', 'stuck' or 'spike'. Rows whose source, day or measure is null are left out; a null
    or NaN value is no case but still a record, so it ends a stuck run. Repeated rows count once;
    two different values of a source and day are two successive records, the smaller first. A source
    with fewer than six values has no usual move and so no spikes. The usual move (or size) is the
    median over the whole source, without those of 0 if that is 0. width, the records in a tile, sets
    the work of a cell and changes no row; neither does slice_rows. Only the records of one source and
    day are numbered in one task, however many they are.
    """
    rows = records.select("measure", "source", F.col("day").cast("string").alias("day"), F.when(~F.isnan("value"), F.col("value")).alias("value"), F.coalesce("idle", F.lit(False)).alias("idle"))
    rows = rows.filter(F.col("measure").isin(list(measures))).dropna(subset=["source", "day"]).withColumn("slice", F.substring("day", 1, SLICE))
    keys = ["measure", "source", "slice"]
    crowded = rows.groupBy(*keys).count().filter(F.col("count") > slice_rows).select(*keys, F.lit(True).alias("crowded"))  # at most records / slice_rows rows
    crowded = cut_lineage(crowded)
    if crowded.limit(1).count():
        rows = rows.join(broadcast_if_small(crowded), keys, "left").withColumn("slice", F.when(F.col("crowded"), F.col("day")).otherwise(F.col("slice"))).drop("crowded")
    rows = rows.repartition(*keys).distinct().sortWithinPartitions(*keys, "day", "value", "idle")  # one exchange and one sort serve all that is done by slice
    # a null beside a value of the same source and day is a poorer copy of it
    rows = rows.withColumn("known", F.count("value").over(Window.partitionBy(*keys, "day"))).filter("known = 0 or value is not null").drop("known")
    order = Window.partitionBy(*keys).orderBy("day", "value", "idle")
    rows = rows.withColumn("at", F.row_number().over(order).cast("long")).withColumn("x", _model_value(measures))
    is_size = F.col("measure").isin([n for n, m in measures.items() if m.kind == "size"])
    moved = F.abs(F.col("x") - F.last("x", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("step", F.when(is_size, F.when(F.col("x") != 0, F.abs("x"))).otherwise(moved))

    # a row per slice: how many records come before it, and the move from the slice before
    has = F.when(F.col("x").isNotNull(), F.col("at"))
    slices = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min_by("x", has).alias("head"), F.max_by("x", has).alias("end"), F.collect_list("step").alias("steps"))
    slices = cut_lineage(slices)  # a row per slice, and a number per record
    earlier = Window.partitionBy("measure", "source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(*keys, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"), F.when(~is_size, F.abs(F.col("head") - F.last("end", ignorenulls=True).over(earlier))).alias("step"), "steps")
    steps = slices.select("measure", "source", F.explode(F.array_append("steps", F.col("step"))).alias("step"))
    (low, high), (low_moved, high_moved) = _median(F.col("step")), _median(F.when(F.col("step") > 0, F.col("step")))
    usual = steps.groupBy("measure", "source").agg(F.count("step").alias("n"), ((low + high) / 2).alias("all"), ((low_moved + high_moved) / 2).alias("moved"))
    usual = usual.select("measure", "source", F.when(F.col("n") >= LEAST_STEPS, F.when(F.col("all") > 0, F.col("all")).otherwise(F.col("moved"))).alias("scale"))
    slices = slices.drop("step", "steps").join(usual, ["measure", "source"])

    rows = rows.join(slices, keys).withColumn("pos", F.col("offset") + F.col("at") - 1)
    tiles = F.sequence(F.floor(F.greatest(F.col("pos") - HALO, F.lit(0)) / width), F.floor((F.col("pos") + HALO) / width))
    cells = rows.withColumn("tile", F.explode(tiles))
    cell = F.concat_ws("\x01", "source", "tile").alias("cell")
    groups = group_count(records)
    cells = cells.select(F.pmod(F.xxhash64("measure", "source", "tile"), F.lit(groups)).alias("g"), "measure", cell, "source", "tile", "pos", "value", "idle", "day", "scale")
    return cells.repartition(task_count(groups, records), "g").groupBy("g").applyInArrow(lambda table: _found(table, measures, width), "measure string, source string, day string, value double, reason string")
