"""Times as received, in many forms, to one instant in UTC each.

A form is recognised and taken apart in Arrow batches (its date, time of day and zone), and the
wall-clock time is placed by the offset history of its zone, in columns (see functions.zones).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorloom.functions.common import trimmed
from factorloom.functions.zones import known_zones, resolve_local

# Zone abbreviations in minutes east of UTC.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
    "ist": 330, "hkt": 480, "sgt": 480, "jst": 540, "kst": 540, "aest": 600, "aedt": 660,
}
# Months.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH = r"(?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
WEEKDAY = r"(?:(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"

DAY8 = r"^(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})(?P<r>)$"
NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
# the forms of a date, tried in this order; r, the rest, can't begin with a digit, and p and q are the same sign
FORMS = {
    "ymd": r"^(?P<y>\d{4})(?P<p>[-/.])(?P<m>\d{1,2})(?P<q>[-/.])(?P<d>\d{1,2})(?P<r>.*)$",
    "compact6": r"^(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})[Tt\s](?P<h>\d{2})(?P<i>\d{2})(?P<s>\d{2})(?P<r>.*)$",
    "compact4": r"^(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})[Tt\s](?P<h>\d{2})(?P<i>\d{2})(?P<r>.*)$",
    "compact": r"^(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})(?P<r>[Tt\s]\d{1,2}:.*)$",
    "year_last": r"^(?P<m>\d{1,2})(?P<p>[-/.])(?P<d>\d{1,2})(?P<q>[-/.])(?P<y>\d{4})(?P<r>.*)$",
    "day_name": rf"^{WEEKDAY}(?P<d>\d{{1,2}})[\s-]+(?P<m>{MONTH})\.?,?[\s-]+(?P<y>\d{{4}})(?P<r>.*)$",
    "name_day": rf"^{WEEKDAY}(?P<m>{MONTH})\.?\s+(?P<d>\d{{1,2}}),?\s+(?P<y>\d{{4}})(?P<r>.*)$",
}
CLOCK = r"^[Tt\s]\s*(?P<h>\d{1,2}):(?P<i>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d+))?)?\s*(?P<a>[AaPp]\.?[Mm]\.?)?(?P<w>\s*)(?P<z>.*)$"
OFFSET = r"^(?i:utc|gmt)?(?P<g>[+-])(?P<h>\d{1,2}):?(?P<m>\d{2})?(?:\s*\[[^\]]*\]|\s*\([^)]*\))?$"
READ = pa.struct([("form", pa.string()), ("local", pa.int64()), ("fixed", pa.int64()), ("zone", pa.string())])
READ_DDL = "struct<form: string, local: bigint, fixed: bigint, zone: string>"
CLOSE_US = 16 * 3_600_000_000

# Seconds at the start of 2000 and of 2035.
EPOCH_FROM, EPOCH_TO = 946_684_800, 2_051_222_400
# Units of epoch times in a second.
UNITS = [1, 1_000, 1_000_000, 1_000_000_000]


def _epoch_micros(s: Column) -> Column:
    """Microseconds of an epoch time in the one unit that puts it between 2000 and 2035, else null."""
    x = F.when(s.rlike(NUMBER), s.try_cast("decimal(38,18)"))
    out = F.lit(None).cast("long")
    for unit in UNITS:
        inside = (x >= F.lit(EPOCH_FROM * unit).cast("decimal(20,0)")) & (x < F.lit(EPOCH_TO * unit).cast("decimal(20,0)"))
        micros = F.floor(x * F.lit(1_000_000 // unit)) if unit <= 1_000_000 else F.floor(x / F.lit(unit // 1_000_000))
        out = F.when(inside, micros.cast("long")).otherwise(out)
    return out


def _int(c: pa.Array, empty: int = 0) -> np.ndarray:
    """Digits as numbers, no digits being empty."""
    return pc.cast(pc.if_else(pc.equal(c, ""), str(empty), c), pa.int64()).to_numpy(zero_copy_only=False)


def _true(c: pa.Array) -> np.ndarray:
    return pc.fill_null(c, False).to_numpy(zero_copy_only=False)


def _dates(s: pa.Array, order: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of the texts that begin with a date: their positions, forms, days since 1970 (or an impossible one), and the rest."""
    left = np.nonzero(_true(pc.is_valid(s)))[0]
    at, forms, days, rests = [], [], [], []
    for form, pattern in {"date8": DAY8, **FORMS}.items():
        if form == "ymd":  # all other numbers are epochs
            left = left[~_true(pc.match_substring_regex(s.take(pa.array(left)), NUMBER))]
        if not len(left):
            break
        own = s.take(pa.array(left))
        g = pc.extract_regex(own, pattern)
        hit = _true(pc.is_valid(g))
        if not hit.any():
            continue
        field = lambda n: pc.struct_field(g, n)  # noqa: B023, E731
        names = {g.type.field(i).name for i in range(g.type.num_fields)}
        hit &= ~_true(pc.match_substring_regex(field("r"), r"^\d"))
        if "q" in names:
            hit &= _true(pc.equal(field("p"), field("q")))
        name = np.full(len(left), form, object)
        swap = np.zeros(len(left), bool)
        if form == "year_last":
            by = order.take(pa.array(left))
            swap = _true(pc.equal(by, "dmy"))
            hit &= swap | _true(pc.equal(by, "mdy"))
            name = np.where(swap, "dmy", "mdy").astype(object)
        g, at_hit, swap = g.filter(pa.array(hit)), left[hit], swap[hit]
        month, day = field("m"), _int(field("d"))
        month = pc.fill_null(pc.index_in(pc.utf8_lower(pc.utf8_slice_codeunits(month, 0, 3)), value_set=pa.array(MONTHS)), -1).to_numpy().astype(np.int64) + 1 if form in ("day_name", "name_day") else _int(month)
        month, day = np.where(swap, day, month), np.where(swap, month, day)
        year, rest = _int(field("y")), field("r")
        if "h" in names:  # a clock without colons gets them
            clock = [pa.scalar(" "), field("h"), pa.scalar(":"), field("i"), *([pa.scalar(":"), field("s")] if "s" in names else []), rest, ""]
            rest = pc.binary_join_element_wise(*clock)
        ok = (month >= 1) & (month <= 12) & (day >= 1)
        first = ((year - 1970) * 12 + np.where(ok, month, 1) - 1).astype("datetime64[M]")
        ok &= day <= ((first + 1).astype("datetime64[D]") - first.astype("datetime64[D]")).astype(np.int64)
        days.append(np.where(ok, first.astype("datetime64[D]").astype(np.int64) + day - 1, NO_DAY))
        at.append(at_hit)
        forms.append(name[hit])
        rests.append(rest)
        left = left[~hit]
    if not at:
        return np.array([], int), np.array([], object), np.array([], np.int64), pa.array([], pa.string())
    return np.concatenate(at), np.concatenate(forms), np.concatenate(days), pa.concat_arrays([r.combine_chunks() if isinstance(r, pa.ChunkedArray) else r for r in rests])


NO_DAY = np.iinfo(np.int64).min


def _read(s: pa.Array, order: pa.Array, close: pa.Array) -> pa.Array:
    """READ of each text: what read_times says, but for epoch times, whose form alone comes out."""
    n = len(s)
    at, forms, days, rest = _dates(s, order)
    g = pc.extract_regex(rest, CLOCK)
    timed = _true(pc.is_valid(g))
    field = lambda name: pc.fill_null(pc.struct_field(g, name), "")
    half, zone = field("a"), field("z")
    # letters straight after a half of the day make it a part of the zone's name
    glued = pc.and_(pc.and_(pc.not_equal(half, ""), pc.equal(field("w"), "")), pc.match_substring_regex(zone, r"^[A-Za-z]"))
    zone = pc.if_else(glued, pc.binary_join_element_wise(half, zone, ""), zone)
    half = pc.utf8_lower(pc.utf8_slice_codeunits(pc.if_else(glued, "", half), 0, 1))
    zone = pc.utf8_trim(pc.if_else(pa.array(timed), zone, rest), characters=" ")
    hour, minute, second = _int(field("h")), _int(field("i")), _int(field("s"))
    micros = _int(pc.utf8_rpad(pc.utf8_slice_codeunits(field("f"), 0, 6), 6, "0"))
    by_half, pm = _true(pc.not_equal(half, "")), _true(pc.equal(half, "p"))
    ok = (minute < 60) & (second < 60) & np.where(by_half, (hour >= 1) & (hour <= 12), hour < 24)
    hour = np.where(by_half, hour % 12 + 12 * pm, hour)
    bare = _true(pc.equal(zone, ""))
    of_day = np.where(timed, (hour * 3600 + minute * 60 + second) * 1_000_000 + micros, np.where(_true(close)[at] & bare, CLOSE_US, 0))
    valid = (days != NO_DAY) & (ok | ~timed)
    local = np.where(valid, days, 0) * 86_400_000_000 + of_day
    # an offset
    o = pc.extract_regex(zone, OFFSET)
    part = lambda name: pc.fill_null(pc.struct_field(o, name), "")
    h, m = _int(part("h")), _int(part("m"))
    has = _true(pc.is_valid(o)) & (h <= 18) & (m < 60)
    minutes = np.where(_true(pc.equal(part("g"), "-")), -1, 1) * (h * 60 + m)
    name = pc.utf8_lower(pc.replace_substring_regex(zone, r"^\[(.*)\]$|^\((.*)\)$", r"\1\2"))
    name = pc.if_else(pa.array(has | bare), pa.scalar(None, pa.string()), name)

    where = np.full(n, -1)
    where[at] = np.arange(len(at))
    index = pa.array(where, mask=where < 0)
    form = pa.array(forms.tolist(), pa.string()).take(index)
    form = pc.if_else(pc.and_(pc.is_null(form), pc.fill_null(pc.match_substring_regex(s, NUMBER), False)), "epoch", form)
    fixed = pa.array(local - minutes * 60_000_000, mask=~(valid & has))
    columns = [form, pa.array(local, mask=~valid).take(index), fixed.take(index), name.take(index)]
    return pa.StructArray.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], fields=list(READ))


def read_times(df: DataFrame, *, raw: Column, time_format: Column, close: Column) -> DataFrame:
    """df with __time_form, __time_local (microseconds on the wall clock, null where unreadable), __time_fixed
    (the instant, of an epoch time or one with an offset), and __time_zone (what stands in the place of a
    zone, in lower case; null if there is nothing or an offset). close tells where a bare date is 16:00.

    Texts are matched in Arrow batches, a form at a time over what no form before it has taken.
    """
    order = F.lower(F.substring(F.coalesce(time_format, F.lit("")), 1, 3))
    out = df.withColumn("__time_s", trimmed(raw)).withColumn("__time_order", order).withColumn("__time_close", close)
    out = out.withColumn("__time_r", F.arrow_udf(_read, READ_DDL)("__time_s", "__time_order", "__time_close"))
    r = F.col("__time_r")
    fixed = F.when(r["form"] == "epoch", _epoch_micros(F.col("__time_s"))).otherwise(r["fixed"])
    out = out.withColumns({"__time_form": r["form"], "__time_local": r["local"], "__time_fixed": fixed, "__time_zone": r["zone"]})
    return out.drop("__time_s", "__time_order", "__time_close", "__time_r")


def normalise_times(df: DataFrame, *, raw: Column, time_format: Column, zone: Column, default_zone: Column | str = "UTC") -> DataFrame:
    """df with utc_micros (long, null where unreadable) and time_form (the form that was recognised).

    raw is the text as received. A zone or offset in it wins; otherwise zone holds: an IANA name, or
    'us_market_close' (New York, a bare date being 16:00), or 'unknown' or null, which mean
    default_zone - a literal or a column such as the result of functions.zones.estimate_zones. A bare
    date is midnight otherwise; eight digits are a date. Any other number is an epoch time in the unit
    (s, ms, us, ns) that puts it between 2000 and 2035. Dates that don't begin with the year follow
    time_format ('mdy...' or 'dmy...'; anything else: unreadable). Digits finer than a microsecond are
    cut off. A wall-clock time that occurs twice is the first of the two, a skipped one is read with
    the offset before the change. Dates and times that don't exist, unknown zones, placeholders, other
    numbers, empty texts and nulls give null. df's own columns of these two names are replaced.
    """
    default_zone = F.lit(default_zone) if isinstance(default_zone, str) else default_zone
    df = df.withColumns({"__time_default": default_zone, "__time_of_source": F.lower(trimmed(zone))})
    of_source = F.col("__time_of_source")
    close = of_source == "us_market_close"
    out = read_times(df, raw=raw, time_format=time_format, close=F.coalesce(close, F.lit(False))).drop("utc_micros", "time_form")
    of_source = F.when(close, "america/new_york").when(of_source.isNull() | (of_source == "unknown"), F.lower("__time_default")).otherwise(of_source)
    out = out.withColumn("__time_name", F.coalesce("__time_zone", F.when(F.col("__time_fixed").isNull(), of_source)))
    # the zones that there are, some six hundred, by join: as literals they would swell every plan
    table = [(k, None, v) for k, v in known_zones(df).items() if k not in ABBREVIATIONS] + [(k, m, None) for k, m in ABBREVIATIONS.items()]
    table = df.sparkSession.createDataFrame(table, "__time_name string, __time_minutes int, __time_id string")
    out = out.join(F.broadcast(table), "__time_name", "left")
    local = F.col("__time_local")
    placed = F.when(F.col("__time_minutes").isNotNull(), local - F.col("__time_minutes").cast("long") * 60_000_000).when(F.col("__time_id").isNotNull(), resolve_local(local, F.col("__time_id")))
    out = out.withColumn("utc_micros", F.coalesce("__time_fixed", F.when(F.col("__time_form") != "epoch", placed)))
    out = out.withColumn("time_form", F.when(F.col("utc_micros").isNotNull(), F.col("__time_form")))
    return out.drop(*[c for c in out.columns if c.startswith("__time_")])
