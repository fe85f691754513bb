"""References to keys that do not exist at the time of the reference.

Targets live from created to deleted. References are added up per key and period first. The counts
split them: the few keys that hold a large share are checked against a broadcast table of their
lives, without moving a row; all others meet the lives in a shuffled anti join by key, period and
salt. Both parts' orphans are put together, as rows and as counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.common import cut_lineage

FAR = "9999-12-31 00:00:00"
NO_TIME = "1000-01-01"  # the period of references without a time
BROADCAST_ROWS = 1_000_000  # periods and lives of heavy keys, some 100 bytes each
CELL_ROWS = 500_000  # references of a key and period in one task


def _living(cells: DataFrame, lives: DataFrame) -> DataFrame:
    """k, m, a, b: the spans within which a key is alive, by the periods that have references.

    What earlier periods come to is one span, up to the latest end of any life begun by then.
    """
    carried = cells.filter("end_before is not null").select("k", "m", F.lit(None).cast("timestamp").alias("a"), F.col("end_before").alias("b"))
    own = lives.select("k", "m", F.col("c").alias("a"), F.col("d").alias("b"))
    return carried.unionByName(own)


def _parts(refs: DataFrame, targets: DataFrame, heavy_share: float, cell_rows: int) -> list[DataFrame]:
    """The orphans (record_key, at, kind) of the heavy keys, if there are any, and those of the others."""
    month = lambda c: F.coalesce(F.trunc(c, "month"), F.to_date(F.lit(NO_TIME)))
    r = refs.withColumn("m", month("at"))
    lives = cut_lineage(targets.groupBy("k", month("c").alias("m"), "c").agg(F.max("d").alias("d")))  # of one beginning the longest
    counts = r.groupBy("k", "m").agg(F.count("*").alias("n"))

    # one row per key and period: its references, and what is known of the key
    known = lives.groupBy("k", "m").agg(F.max(F.when(F.col("c").isNotNull(), F.col("d"))).alias("end"), F.min("c").alias("first"), F.count("*").alias("lives"))
    cells = counts.unionByName(known, allowMissingColumns=True).groupBy("k", "m").agg(*[f(c).alias(c) for c, f in (("n", F.max), ("end", F.max), ("first", F.min), ("lives", F.max))])
    of_key = Window.partitionBy("k")
    before = of_key.orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "k", "m", "n", F.max("end").over(before).alias("end_before"), F.min("first").over(of_key).alias("first"), F.max("lives").over(of_key).isNotNull().alias("known"),
        F.sum("n").over(of_key).alias("refs"), (F.coalesce(F.sum("lives").over(of_key), F.lit(0)) + F.count("n").over(of_key)).alias("rows"),
    ).filter("n is not null")
    cells = cut_lineage(cells)

    total = cells.agg(F.sum("n")).first()[0] or 0
    of_heavy = cells.filter(F.col("refs") >= max(heavy_share * total, 1)).groupBy("k").agg(F.max("rows").alias("rows"))
    heavy, room = [], BROADCAST_ROWS
    for x in sorted(of_heavy.collect(), key=lambda x: (x.rows, x.k)):  # 1 / heavy_share rows at most
        room -= x.rows
        if room >= 0:
            heavy.append(x.k)
    list_of = cells.sparkSession.createDataFrame([(k,) for k in heavy], "k string")
    is_heavy = lambda x: x.join(F.broadcast(list_of), "k", "left_semi")
    is_light = lambda x: x.join(F.broadcast(list_of), "k", "left_anti")

    alive = (F.col("a").isNull() | (F.col("a") <= F.col("at"))) & (F.col("at") < F.col("b"))
    kind = F.when(~F.col("known"), "missing").when(F.col("first").isNull() | (F.col("first") > F.col("at")), "late").otherwise("deleted")

    def orphans(r: DataFrame, living: DataFrame, facts: DataFrame, keys: list[str], hint) -> DataFrame:
        l, v = r.alias("l"), hint(living).alias("v")
        same = [F.col(f"l.{c}") == F.col(f"v.{c}") for c in keys]
        left = l.join(v, [*same, alive], "left_anti").join(hint(facts), keys)
        # without a time a reference can only be missing
        return left.filter(F.col("at").isNotNull() | ~F.col("known")).select("record_key", "at", F.when(F.col("at").isNull() & F.col("known"), None).otherwise(kind).alias("kind"))

    facts = cells.select("k", "m", "known", "first", "n", "end_before")
    parts = []
    if heavy:
        own = is_heavy(facts)
        parts.append(orphans(is_heavy(r), _living(own, is_heavy(lives)), own.select("k", "m", "known", "first"), ["k", "m"], F.broadcast))
        r, lives, facts = is_light(r), is_light(lives), is_light(facts)
    # the others: a crowded key and period is spread over salts, for each of which its few lives are copied
    facts = facts.withColumn("salts", F.ceil(F.col("n") / cell_rows))
    most = facts.agg(F.max("salts")).first()[0] or 1
    keys = ["k", "m"]
    living = _living(facts, lives)
    if most > 1:
        salts = facts.filter("salts > 1").select("k", "m", "salts")  # at most references / cell_rows rows
        salted = lambda x: x.join(salts, ["k", "m"], "left").withColumn("salts", F.coalesce("salts", F.lit(1).cast("long")))
        copies = lambda x: x.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
        few = salts.limit(100_001).count() <= 100_000
        salts = F.broadcast(salts) if few else salts
        r = salted(r).withColumn("s", F.pmod(F.xxhash64("record_key", "at"), F.col("salts"))).drop("salts")
        living, facts, keys = copies(salted(living)), copies(facts), [*keys, "s"]
    parts.append(orphans(r, living, facts.select(*keys, "known", "first"), keys, lambda x: x))
    return parts


def _sides(refs: DataFrame, targets: DataFrame, ref_key: Column, record_key: Column, at: Column, target_key: Column, created: Column, deleted: Column) -> tuple[DataFrame, DataFrame]:
    far = F.to_timestamp(F.lit(FAR))
    r = refs.select(ref_key.cast("string").alias("k"), record_key.alias("record_key"), at.cast("timestamp").alias("at")).filter(F.col("k").isNotNull())
    t = targets.select(target_key.cast("string").alias("k"), created.cast("timestamp").alias("c"), F.coalesce(deleted.cast("timestamp"), far).alias("d"))
    return r, t.filter(F.col("k").isNotNull())


def orphan_references(
    refs: DataFrame,
    targets: DataFrame,
    *,
    ref_key: Column,
    record_key: Column,
    at: Column,
    target_key: Column,
    created: Column,
    deleted: Column,
    heavy_share: float = 0.0001,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(record_key, at, kind) of the references without a living target; rows are distinct.

    A target row lives from created up to but not including deleted (null: still alive). kind is
    'missing' if no target row has the key, 'late' if all its rows were created after the reference,
    else 'deleted'. A null key is no reference and no target. A reference without a time can only be
    'missing'; a target row without created is never alive, but its key is known. Repeated rows on
    either side change nothing. An empty target table makes every reference 'missing'.

    Keys with at least heavy_share of all references (1 / heavy_share keys at most) are checked by
    broadcast, in the order of their lives' number as long as these are BROADCAST_ROWS at most. Any
    other key goes by shuffle; one of more than cell_rows references in a period is salted.
    """
    parts = _parts(*_sides(refs, targets, ref_key, record_key, at, target_key, created, deleted), heavy_share, cell_rows)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def orphan_counts(
    refs: DataFrame,
    targets: DataFrame,
    *,
    ref_key: Column,
    record_key: Column,
    at: Column,
    target_key: Column,
    created: Column,
    deleted: Column,
    by: Sequence[Column],
    heavy_share: float = 0.0001,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Columns by (of record_key and at), kind and records: orphan_references of both parts, counted."""
    out = orphan_references(
        refs, targets, ref_key=ref_key, record_key=record_key, at=at, target_key=target_key, created=created, deleted=deleted, heavy_share=heavy_share, cell_rows=cell_rows
    )
    return out.groupBy(*by, "kind").agg(F.count("*").alias("records"))
