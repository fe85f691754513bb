"""Local times to instants: offset histories of time zones, and zones estimated from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorloom.functions.common import cut_lineage

DAY_US = 86_400_000_000


def _wall(instant_us: Column, zone: Column) -> Column:
    """Microseconds that a clock in zone shows at the instant."""
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(instant_us), zone))


def resolve_local(local_us: Column, zone: Column) -> Column:
    """The instant (microseconds) of a wall-clock time in a zone.

    Both offsets of the zone's history around the time are tried, the earlier first; an offset is
    violated if a clock in the zone doesn't show the time at the instant it gives. The first with the
    fewest violations is chosen: a time that occurs twice is the first of the two, a skipped one is
    read with the offset before the change.
    """
    offset = lambda at: _wall(at, zone) - at
    first = local_us - offset(local_us - DAY_US)
    second = local_us - offset(local_us + DAY_US)
    violated = lambda at: _wall(at, zone) != local_us
    return F.when(violated(first) & ~violated(second), second).otherwise(first)


def known_zones(df: DataFrame) -> dict[str, str]:
    """The zone ids of the session's JVM by their lower-case spelling."""
    jvm = df.sparkSession._jvm
    ids = jvm.java.lang.String.join(",", jvm.java.time.ZoneId.getAvailableZoneIds()).split(",")
    return {z.lower(): z for z in ids if "SystemV" not in z}


EVIDENCE = 4.0  # standard deviations by which fewer violations must differ from chance
SEQUENCE_BLOCK = 1_000_000  # sequence numbers that are compared in one task


def _steps_back(rows: DataFrame) -> DataFrame:
    """source and the array bad: for each of the instants u whether it is before the one of the record it follows.

    Records are compared in blocks of the sequence; the last of each block is handed to the next one.
    """
    rows = rows.withColumn("block", F.floor(F.col("ref") / SEQUENCE_BLOCK))
    before = lambda a, b: F.zip_with(a, b, lambda x, y: (x < y).cast("int"))
    order = Window.partitionBy("source", "block").orderBy("ref", "u")
    steps = rows.select("source", "u", F.lag("u").over(order).alias("last")).filter("last is not null")
    ends = rows.groupBy("source", "block").agg(F.min(F.struct("ref", "u")).alias("head"), F.max(F.struct("ref", "u")).alias("end"))
    edges = ends.select("source", F.col("head.u").alias("u"), F.lag("end.u").over(Window.partitionBy("source").orderBy("block")).alias("last"))
    return steps.unionByName(edges.filter("last is not null")).select("source", before(F.col("u"), F.col("last")).alias("bad"))


def estimate_zones(
    df: DataFrame,
    *,
    source: Column,
    local: Column,
    candidates: Sequence[str],
    ingested: Column | None = None,
    sequence: Column | None = None,
    fixed: Column | None = None,
    longest_delay_hours: float = 24.0,
) -> DataFrame:
    """(source, zone, violations, records): the zone whose offset history fits each source best.

    local is the wall-clock time (a timestamp without zone) of a record, fixed, if given, the instant
    (timestamp) of one that needs no zone. With ingested (the instant a record arrived), a record
    violates a candidate zone if it would have arrived before its own time or more than
    longest_delay_hours after it; of zones with as few violations the one with the smallest spread of
    delays wins. With sequence (the order of arrival), a record violates a zone if its instant is before
    that of the record it follows. Where the order of arrival says nothing of time, all zones are violated
    alike, and only by chance is one of them less so; so the first candidate stands unless another is
    violated less by more than EVIDENCE standard deviations of the records at which the two differ.
    Remaining ties go to the earlier candidate. Rows with nulls are left out; a source without rows
    doesn't come out. One pass with an aggregate per candidate, so no source gathers anywhere.
    """
    if (ingested is None) == (sequence is None):
        raise ValueError("give ingested or sequence")
    known = F.unix_micros(fixed.cast("timestamp")) if fixed is not None else F.lit(None).cast("long")
    rows = df.select(source.alias("source"), F.unix_micros(local.cast("timestamp")).alias("local"), known.alias("fixed"), (ingested if ingested is not None else sequence).alias("ref"))
    rows = rows.dropna(subset=["source", "ref"]).filter("local is not null or fixed is not null")
    zones = F.array(*map(F.lit, candidates))
    rows = rows.select("source", "ref", F.transform(zones, lambda z: F.coalesce("fixed", resolve_local(F.col("local"), z))).alias("u"))
    rows = cut_lineage(rows)  # read several times below
    n = range(len(candidates))
    bad = lambda i: F.col("bad")[i]
    violated = [F.coalesce(F.sum(bad(i)), F.lit(0)).alias(f"v{i}") for i in n]
    records = rows.groupBy("source").agg(F.count("*").alias("records"))
    if ingested is not None:
        late = int(longest_delay_hours * 3.6e9)
        rows = rows.withColumn("delay", F.transform("u", lambda u: F.unix_micros(F.col("ref").cast("timestamp")) - u))
        rows = rows.withColumn("bad", F.transform("delay", lambda x: ((x < 0) | (x > late)).cast("int")))
        spread = [F.coalesce(F.stddev_pop(F.col("delay")[i] / 1e6), F.lit(0.0)).alias(f"s{i}") for i in n]
        counts = rows.groupBy("source").agg(*violated, *spread, *[F.lit(True).alias(f"ok{i}") for i in n])
    else:
        gain = [F.sum(bad(0) - bad(i)) for i in n]
        differ = [F.sum(F.abs(bad(0) - bad(i))) for i in n]
        clear = [F.lit(True) if i == 0 else gain[i] > EVIDENCE * F.sqrt(differ[i]) for i in n]
        counts = _steps_back(rows.select("source", "ref", "u")).groupBy("source").agg(*violated, *[F.lit(0.0).alias(f"s{i}") for i in n], *[clear[i].alias(f"ok{i}") for i in n])
    counts = records.join(counts, "source", "left").na.fill(0, [f"v{i}" for i in n]).na.fill(0.0, [f"s{i}" for i in n]).withColumn("ok0", F.lit(True))
    scores = F.array(*[F.when(F.col(f"ok{i}"), F.struct(F.col(f"v{i}").alias("violations"), F.col(f"s{i}").alias("spread"), F.lit(i).alias("i"), F.lit(z).alias("zone"))) for i, z in enumerate(candidates)])
    best = F.array_min(F.array_compact(scores))
    return counts.select("source", "records", best.alias("best")).select("source", F.col("best.zone").alias("zone"), F.col("best.violations").alias("violations"), "records")
