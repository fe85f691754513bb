"""Aligning another source to the rows of an anchor: the last value before, exactly, or filled forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def as_of(
    anchor: DataFrame,
    source: DataFrame,
    *,
    columns: Sequence[str],
    timestamp: str = "timestamp",
    instrument: str = "instrument",
    tolerance_us: int | None = None,
    skip_missing: bool = False,
    slice_us: int = 90 * DAY_US,
) -> DataFrame:
    """anchor's rows with columns of source as of each row: its last source row at or before that time.

    A matched row whose value is null gives null, unless skip_missing, which takes each column's last
    known value (a forward fill). A match older than tolerance_us is none. Of several source rows of an
    instrument and time the greatest by values counts. Anchor rows with a null key get nulls; repeated
    anchor rows stay. Columns of anchor with the names of columns are replaced.

    Rows meet in slices of one instrument and slice_us of time; what a slice needs of earlier ones is
    one row, found among one row per slice. So a long or crowded instrument is many tasks.
    """
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    columns = list(columns)
    rest = [c for c in anchor.columns if c not in columns]
    found = F.struct(F.col("t").alias("t"), *columns)
    s = source.select(F.col(instrument).alias("k"), at(timestamp).alias("t"), *columns).filter("k is not null and t is not null")
    s = s.groupBy("k", "t").agg(F.max(F.struct(*columns)).alias("v")).select("k", "t", "v.*").select("k", "t", found.alias("hit"))
    s = s.withColumn("slice", F.floor(F.col("t") / slice_us))
    a = anchor.select(F.struct(*rest).alias("row"), F.col(instrument).alias("k"), at(timestamp).alias("t")).withColumn("slice", F.floor(F.col("t") / slice_us))

    def last(value, w):
        if not skip_missing:
            return F.last(value, ignorenulls=True).over(w)
        each = [F.last(F.when(value[c].isNotNull(), F.struct(value["t"].alias("t"), value[c].alias("v"))), ignorenulls=True).over(w) for c in columns]
        return F.struct(*[e.alias(f"_{i}") for i, e in enumerate(each)])

    slices = s.groupBy("k", "slice").agg(*_last_of(columns, skip_missing)).unionByName(a.filter("t is not null and k is not null").select("k", "slice").distinct(), allowMissingColumns=True)
    slices = slices.groupBy("k", "slice").agg(F.max("hit").alias("hit")) if not skip_missing else slices.groupBy("k", "slice").agg(*[F.max(f"h{i}").alias(f"h{i}") for i in range(len(columns))])
    earlier = Window.partitionBy("k").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    names = ["hit"] if not skip_missing else [f"h{i}" for i in range(len(columns))]
    slices = slices.select("k", "slice", *[F.last(n, ignorenulls=True).over(earlier).alias(f"carry_{n}") for n in names])

    rows = a.withColumn("is_anchor", F.lit(1)).unionByName(s.withColumn("is_anchor", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy("k", "slice").orderBy("t", "is_anchor").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("here", last(F.col("hit"), w)).filter("is_anchor = 1").select("row", "k", "slice", "t", "here")
    rows = rows.join(slices, ["k", "slice"], "left")
    near = lambda m: m if tolerance_us is None else F.when(F.col("t") - m["t"] <= tolerance_us, m)
    if not skip_missing:
        match = near(F.when(F.col("t").isNotNull() & F.col("k").isNotNull(), F.coalesce("here", "carry_hit")))
        return rows.select("row", match.alias("m")).select("row.*", *[F.col("m")[c].alias(c) for c in columns])
    picked = [near(F.when(F.col("t").isNotNull() & F.col("k").isNotNull(), F.coalesce(F.col("here")[f"_{i}"], F.col(f"carry_h{i}"))))["v"].alias(c) for i, c in enumerate(columns)]
    return rows.select("row", *picked).select("row.*", *columns)


def _last_of(columns: Sequence[str], skip_missing: bool) -> list:
    """The last row of a slice, or of each column its last known value."""
    if not skip_missing:
        return [F.max_by("hit", "t").alias("hit")]
    hit = F.col("hit")
    return [F.max(F.when(hit[c].isNotNull(), F.struct(hit["t"].alias("t"), hit[c].alias("v")))).alias(f"h{i}") for i, c in enumerate(columns)]


def exact(anchor: DataFrame, source: DataFrame, *, columns: Sequence[str], timestamp: str = "timestamp", instrument: str = "instrument") -> DataFrame:
    """anchor's rows with columns of source at the very same time; of repeated source rows the greatest counts."""
    s = source.filter(F.col(timestamp).isNotNull() & F.col(instrument).isNotNull()).groupBy(timestamp, instrument).agg(F.max(F.struct(*columns)).alias("_v"))
    rest = [c for c in anchor.columns if c not in columns]
    return anchor.select(*rest).join(s, [timestamp, instrument], "left").select(*rest, *[F.col("_v")[c].alias(c) for c in columns])


def one_panel(factors: dict[str, DataFrame], how: str = "outer", timestamp: str = "timestamp", instrument: str = "instrument", value: str = "value") -> DataFrame:
    """Long factors side by side: one union and one pivot, so one shuffle for any number of them.

    how 'outer' keeps every key, 'inner' those that all factors have. Of repeated keys of a factor the
    greatest value counts.
    """
    long = None
    for name, df in factors.items():
        part = df.select(timestamp, instrument, F.lit(name).alias("_f"), F.col(value).alias("_v")).dropna(subset=[timestamp, instrument])
        long = part if long is None else long.unionByName(part)
    wide = long.groupBy(timestamp, instrument).agg(*[F.max(F.when(F.col("_f") == n, F.col("_v"))).alias(n) for n in factors], F.count_distinct("_f").alias("_n"))
    if how == "inner":
        wide = wide.filter(F.col("_n") == len(factors))
    return wide.drop("_n")


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """The join of two tables that have each key once; a repeated key on either side is a ValueError."""
    keys = list(keys)
    for name, df in (("left", left), ("right", right)):
        twice = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"the {name} side has {twice[0]['count']} rows of {[twice[0][k] for k in keys]}")
    return left.join(right, keys, how)


def on_common_dates(*panels: DataFrame, timestamp: str = "timestamp") -> list[DataFrame]:
    """The panels on the timestamps that all of them have."""
    days = None
    for i, df in enumerate(panels):
        own = df.select(timestamp).dropna().distinct()
        days = own if days is None else days.join(own, timestamp, "left_semi")
    return [df.join(days, timestamp, "left_semi") for df in panels]
