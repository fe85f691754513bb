"""Pairing records of two tables by the nearest time of the same entity.

Both tables are cut into cells of one entity and one time range, the right one's overlapping by the
neighbouring rows. Cells are hashed into groups that are co-grouped as Arrow tables, and a vectorised
binary search compares each left time with its two neighbours on the right.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.common import broadcast_if_small, cut_lineage, group_count, task_count

RESULT = "left_id long, right_id long, gap_us long"
OUT = pa.schema([("left_id", pa.int64()), ("right_id", pa.int64()), ("gap_us", pa.int64())])


def _search(left: pa.Table, right: pa.Table, tolerance_us: int) -> pa.Table:
    """The nearest right row of each left row; columns id, k, t on both sides."""
    if not left.num_rows or not right.num_rows:
        return OUT.empty_table()
    names = pc.unique(right["k"])
    r_code = pc.index_in(right["k"], value_set=names).to_numpy().astype(np.int64)
    l_code = pc.index_in(left["k"], value_set=names)
    known = pc.is_valid(l_code).to_numpy()
    l_code = pc.fill_null(l_code, 0).to_numpy().astype(np.int64)[known]
    l_id, l_t = left["id"].to_numpy()[known], left["t"].to_numpy()[known]
    r_id, r_t = right["id"].to_numpy(), right["t"].to_numpy()
    order = np.lexsort((r_id, r_t, r_code))
    r_id, r_t, r_code = r_id[order], r_t[order], r_code[order]
    # of several right rows of an entity and time only the one with the smallest id can be chosen
    first = np.ones(len(r_t), bool)
    first[1:] = (r_t[1:] != r_t[:-1]) | (r_code[1:] != r_code[:-1])
    r_id, r_t, r_code = r_id[first], r_t[first], r_code[first]
    # entity and time in one integer: times are replaced by their ranks, so nothing can overflow
    times = np.unique(r_t)
    span = len(times) + 1
    r_key = r_code * span + np.searchsorted(times, r_t)
    at = np.searchsorted(r_key, l_code * span + np.searchsorted(times, l_t, side="left"))
    far = np.iinfo(np.int64).max
    n = len(r_t)
    after = np.minimum(at, n - 1)
    before = np.maximum(at - 1, 0)
    d_after = np.where((at < n) & (r_code[after] == l_code), r_t[after] - l_t, far)
    d_before = np.where((at > 0) & (r_code[before] == l_code), l_t - r_t[before], far)
    early = d_before <= d_after
    gap = np.where(early, d_before, d_after)
    keep = gap <= tolerance_us
    chosen = np.where(early, before, after)[keep]
    return pa.table([l_id[keep], r_id[chosen], gap[keep]], schema=OUT)


def nearest_time_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_id: Column,
    left_entity: Column,
    left_time: Column,
    right_id: Column,
    right_entity: Column,
    right_time: Column,
    tolerance_us: int,
    bucket_us: int | None = None,
    cell_rows: int = 500_000,
) -> DataFrame:
    """(left_id, right_id, gap_us): each left row with the right row of its entity nearest in time.

    Only pairs within tolerance_us (inclusive) come out. At equal distance the earlier right time
    wins, then the smaller right_id. Rows whose entity, time or id is null take no part; repeated
    left rows each get their row, repeated right rows (same entity and time) count as the one with
    the smallest id. An empty side gives an empty result. The arguments are column expressions, so
    clashing or additional column names of the tables don't matter.

    A cell is an entity and bucket_us of time. Its margin is the last right row before it and the
    first after it, known from a table of cells, so no row is copied for the tolerance's sake. A cell
    of more than cell_rows rows on either side is cut finer in time, and if its left rows still
    crowd one moment, salted.
    """
    width = bucket_us or max(2 * tolerance_us, 1)
    groups = group_count(left, right)
    tasks = task_count(groups, left, right)
    side = lambda df, i, k, t: df.select(i.cast("long").alias("id"), k.alias("k"), F.unix_micros(t.cast("timestamp")).alias("t")).dropna()
    l, r = side(left, left_id, left_entity, left_time), side(right, right_id, right_entity, right_time)
    l, r = (x.withColumn("b", F.floor(F.col("t") / width)) for x in (l, r))
    cells = cut_lineage(_cells(l, r, ["k", "b"]))  # one row per entity and bucket
    most = F.greatest("nl", "nr")
    crowded = cells.filter(most > cell_rows).select("k", "b", F.ceil(most / cell_rows).alias("cuts"))  # at most rows / cell_rows of them
    if crowded.limit(1).count():
        crowded = broadcast_if_small(crowded)
        r = r.groupBy("k", "b", "t").agg(F.min("id").alias("id"))  # repeated times count once, before any copy is made
        sub = F.coalesce(F.floor((F.col("t") - F.col("b") * width) * F.col("cuts") / width), F.lit(0))
        l, r = (x.join(crowded, ["k", "b"], "left").withColumn("sub", sub) for x in (l, r))
        fine = _cells(l.filter("cuts is not null"), r.filter("cuts is not null"), ["k", "b", "sub"])
        cells = cells.join(crowded.select("k", "b"), ["k", "b"], "left_anti").withColumn("sub", F.lit(0).cast("long"))
        cells = cut_lineage(cells.unionByName(fine)).withColumn("salts", F.greatest(F.ceil(F.col("nl") / cell_rows), F.lit(1)))
        salts = broadcast_if_small(cells.filter("salts > 1").select("k", "b", "sub", "salts"))
        l, r = (x.drop("cuts").join(salts, ["k", "b", "sub"], "left").withColumn("salts", F.coalesce("salts", F.lit(1))) for x in (l, r))
    else:
        l, r, cells = (x.withColumns({"sub": F.lit(0).cast("long"), "salts": F.lit(1).cast("long")}) for x in (l, r, cells))

    by_time = Window.partitionBy("k").orderBy("b", "sub")
    before = F.last("hi", ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("lo", ignorenulls=True).over(by_time.rowsBetween(1, Window.unboundedFollowing))
    edge = lambda x, i: F.struct(x["t"].alias("t"), i.alias("id"))
    margins = cells.select("k", "b", "sub", "salts", "nl", before.alias("p"), after.alias("n")).filter("nl > 0")
    margins = margins.select("k", "b", "sub", "salts", F.explode(F.array(edge(F.col("p"), -F.col("p.neg")), edge(F.col("n"), F.col("n.id")))).alias("e")).select("k", "b", "sub", "salts", "e.*").filter("t is not null")
    r = r.select("k", "b", "sub", "salts", "t", "id").unionByName(margins)
    l = l.withColumn("s", F.pmod(F.xxhash64("id"), F.col("salts")))
    r = r.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    l, r = (x.select(F.pmod(F.xxhash64("k", "b", "sub", "s"), F.lit(groups)).alias("g"), "id", "k", "t") for x in (l, r))
    l, r = (x.repartition(tasks, "g") for x in (l, r))
    return l.groupBy("g").cogroup(r.groupBy("g")).applyInArrow(lambda a, b: _search(a, b, tolerance_us), RESULT)


def _cells(l: DataFrame, r: DataFrame, keys: list[str]) -> DataFrame:
    """Per cell the rows of either side, and the right side's first and last row (of ties the smallest id)."""
    of_r = r.groupBy(*keys).agg(F.count("*").alias("nr"), F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", (-F.col("id")).alias("neg"))).alias("hi"))
    return l.groupBy(*keys).agg(F.count("*").alias("nl")).join(of_r, keys, "full_outer").na.fill(0, ["nl", "nr"])
