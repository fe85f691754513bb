"""Totals and averages over trailing calendar periods, days without records included.

Entities by days become dense numpy blocks: a cell is one entity and one tile of days, its columns
the tile's days preceded by a halo of the longest window less one. Windows are banded 0/1 operators,
so one matrix product gives all sums of a block of cells.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.functions.common import finite, group_count, task_count

BLOCK = 1024  # cells in one dense block


def _bands(halo: int, tile: int, windows: Sequence[int]) -> list[np.ndarray]:
    """For each window the (halo + tile) x tile operator that sums the days j - w + 1 .. j."""
    row, col = np.arange(halo + tile)[:, None], np.arange(tile)[None, :] + halo
    return [((row <= col) & (row > col - w)).astype(np.float64) for w in windows]


def _tiles(cells: pa.Table, bars: pa.Table, tile: int, windows: Sequence[int], schema: pa.Schema) -> pa.Table:
    halo = max(windows) - 1
    bands = _bands(halo, tile, windows)
    keys = cells["cell"].combine_chunks()
    n = len(keys)
    code = pc.index_in(bars["cell"], value_set=keys)
    ok = pc.is_valid(code).to_numpy()
    code = pc.fill_null(code, 0).to_numpy()[ok]
    start = cells["tile"].to_numpy() * tile
    first, last = cells["first"].to_numpy(), cells["last"].to_numpy()
    at = bars["day"].to_numpy()[ok] - start[code] + halo
    volume = bars["volume"].to_numpy(zero_copy_only=False)[ok]
    close = bars["close"].to_numpy(zero_copy_only=False)[ok]
    out = []
    order = np.argsort(code, kind="stable")
    code, at, volume, close = code[order], at[order], volume[order], close[order]
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        a, b = np.searchsorted(code, [lo, hi])
        shape = (hi - lo, halo + tile)
        v, c, has = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        rows, cols = code[a:b] - lo, at[a:b]
        v[rows, cols] = np.nan_to_num(volume[a:b])
        known = ~np.isnan(close[a:b])
        c[rows[known], cols[known]] = close[a:b][known]
        has[rows[known], cols[known]] = 1.0
        day = start[lo:hi, None] + np.arange(tile)[None, :]
        inside = (day >= first[lo:hi, None]) & (day <= last[lo:hi, None])
        i, j = np.nonzero(inside)
        age = day[i, j] - first[lo:hi][i] + 1
        cols_out = [pc.take(cells["entity"].combine_chunks(), pa.array(lo + i)), pa.array(day[i, j], pa.int64()), pa.array(age, pa.int64())]
        for w, band in zip(windows, bands):
            total = (v @ band)[i, j]
            n_close = (has @ band)[i, j]
            mean = np.divide((c @ band)[i, j], n_close, out=np.zeros(len(i)), where=n_close > 0)
            cols_out += [pa.array(total), pa.array(total / np.minimum(age, w)), pa.array(mean, mask=n_close == 0)]
        out.append(pa.table(cols_out, schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def trailing_totals(
    df: DataFrame,
    *,
    entity: Column,
    day: Column,
    volume: Column,
    close: Column,
    latest_by: Column | None = None,
    windows: Sequence[int] = (7, 30),
    tile: int = 128,
) -> DataFrame:
    """One row per entity and calendar day from its first to its last record.

    Columns: entity, day (date), age (1 on the entity's first day), and for each window w
    volume_w (total), avg_volume_w (per calendar day of the window on which the entity existed) and
    avg_close_w (over the days that have a close; null if none has).

    Of several records of an entity and day the one with the greatest latest_by counts, once; ties
    are broken by the greatest (volume, close), so the result is deterministic. A null, NaN or
    infinite volume is 0, such a close is no close, null latest_by is oldest. Records whose entity or day is
    null are left out; an empty table gives an empty result.
    """
    windows = tuple(windows)
    pick = F.struct(latest_by if latest_by is not None else F.lit(0), finite(volume), finite(close))
    bars = (
        df.select(entity.alias("entity"), F.unix_date(day.cast("date")).cast("long").alias("day"), pick.alias("pick"))
        .filter(F.col("entity").isNotNull() & F.col("day").isNotNull())
        .groupBy("entity", "day")
        .agg(F.max("pick").alias("pick"))
        .select("entity", "day", F.col("pick")["col2"].alias("volume"), F.col("pick")["col3"].alias("close"))
    )
    halo = max(windows) - 1
    spans = (
        df.select(entity.alias("entity"), F.unix_date(day.cast("date")).cast("long").alias("day"))
        .dropna()
        .groupBy("entity")
        .agg(F.min("day").alias("first"), F.max("day").alias("last"))
    )
    cell = F.concat_ws("\x01", "entity", "tile").alias("cell")
    cells = spans.withColumn("tile", F.explode(F.sequence(F.floor(F.col("first") / tile), F.floor(F.col("last") / tile))))
    tiles = F.sequence(F.floor(F.col("day") / tile), F.floor((F.col("day") + halo) / tile))
    bars = bars.withColumn("tile", F.explode(tiles))
    groups = group_count(df)
    g = F.pmod(F.xxhash64("entity", "tile"), F.lit(groups)).alias("g")
    tasks = task_count(groups, df)
    cells = cells.select(g, cell, "entity", "tile", "first", "last")
    bars = bars.select(g, cell, "day", "volume", "close")
    fields = [pa.field("entity", pa.string()), pa.field("day", pa.int64()), pa.field("age", pa.int64())]
    for w in windows:
        fields += [pa.field(f"{c}_{w}", pa.float64()) for c in ("volume", "avg_volume", "avg_close")]
    schema = pa.schema(fields)
    ddl = "entity string, day long, age long, " + ", ".join(f"{f.name} double" for f in fields[3:])
    out = cells.repartition(tasks, "g").groupBy("g").cogroup(bars.repartition(tasks, "g").groupBy("g")).applyInArrow(lambda a, b: _tiles(a, b, tile, windows, schema), ddl)
    return out.withColumn("day", F.date_from_unix_date(F.col("day").cast("int")))
