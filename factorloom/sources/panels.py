"""Reading panels, factors and universes from parquet."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factorloom.functions.common import broadcast_if_small, trimmed
from factorloom.operators.asof import as_of, exact
from factorloom.plans.compiler import panel

# Units of numeric timestamps in a second.
PER_SECOND = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}


def read_time(c: Column, unit: str | None = None) -> Column:
    """A time column as timestamp: numbers in unit, else whatever casts to a timestamp (in UTC)."""
    if unit is None:
        return c.cast("timestamp")
    per = PER_SECOND[unit]
    return F.timestamp_micros(F.floor(c / (per // 1_000_000)).cast("long") if per > 1_000_000 else (c.cast("long") * (1_000_000 // per)))


def instrument_key(df: DataFrame, name: str) -> Column:
    """An instrument column as trimmed text; of a list the first element; blank is null."""
    c = F.col(name)
    return trimmed(F.get(c, F.lit(0)) if dict(df.dtypes)[name].startswith("array") else c.cast("string"))


FILE_DAY = r"(\d{4}-\d{2}-\d{2})"


def _bounds(start: str | None, end: str | None, day: bool) -> tuple[datetime | None, datetime | None, bool]:
    """From and to, and whether to is itself outside, for times that may be cut to their day."""
    lo, hi = (datetime.fromisoformat(x) if x else None for x in (start, end))
    if not day:
        return lo, hi, False
    midnight = lambda t: t.replace(hour=0, minute=0, second=0, microsecond=0)
    if lo is not None:
        lo = lo if lo == midnight(lo) else midnight(lo) + timedelta(days=1)
    return lo, None if hi is None else midnight(hi) + timedelta(days=1), True


def parquet_panel(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Mapping[str, str],
    *,
    timestamp: str = "align_time",
    instrument: str = "ticker",
    unit: str | None = None,
    start: str | None = None,
    end: str | None = None,
    instruments: Iterable[str] | None = None,
    day: bool = False,
    last_by: str | None = None,
    file_days: bool = False,
    skip_corrupt: bool = False,
) -> DataFrame:
    """A panel from parquet files, sub-folders included: fields maps panel columns to stored ones.

    Only the columns named are read. start and end (inclusive, ISO) are turned into the stored unit, so
    that they reach the scan; instruments are compared trimmed, which needs their rows. day cuts the
    time to the day, as daily bars in nanoseconds need. With file_days, files whose name holds a day
    outside start and end aren't opened; names without a day are. A file that can't be read is an
    error, unless skip_corrupt; table_report names such files. Of repeated keys the last by last_by counts.
    """
    df = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", str(skip_corrupt).lower()).parquet(*([path] if isinstance(path, str) else path))
    if file_days:
        of_file = F.regexp_extract(F.col("_metadata.file_name"), FILE_DAY, 1)
        df = df.filter((of_file == "") | ((of_file >= (start or "")[:10]) & (of_file <= (end or "9999")[:10])))
    lo, hi, open_end = _bounds(start, end, day)
    per = PER_SECOND[unit] if unit else None

    def stored(t: datetime) -> Column:
        if per is None:
            return F.lit(t)
        micros = (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)
        return F.lit(micros * (per // 1_000_000) if per >= 1_000_000 else -(-micros // (1_000_000 // per)))

    raw = F.col(timestamp)
    if lo is not None:
        df = df.filter(raw >= stored(lo))
    if hi is not None:
        df = df.filter(raw < stored(hi) if open_end else raw <= stored(hi))
    ts = read_time(raw, unit)
    ts = F.date_trunc("day", ts) if day else ts
    inst = instrument_key(df, instrument)
    if instruments is not None:
        df = df.filter(inst.isin([str(i).strip() for i in instruments]))
    return panel(df, ts, inst, fields, keep_last_by=F.col(last_by) if last_by else None)


def read_tables(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The columns of all parquet (.parquet, .pq) and csv files under path, or of the one file, as text where csv has them.

    Values of csv files take the type of the parquet files' column where there is one.
    """
    read = lambda kind, glob: spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("header", "true").format(kind).load(path)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.regexp_extract("path", r"\.([^./]+)$", 1).alias("kind")).distinct()
    kinds = {r.kind.lower() for r in listed.collect()}  # a row per ending
    parts = []
    if kinds & {"parquet", "pq"}:
        parts.append(read("parquet", "*.{parquet,pq}").select(*columns))
    if "csv" in kinds:
        own = read("csv", "*.csv").select(*columns)
        types = dict(parts[0].dtypes) if parts else {}
        parts.append(own.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in columns]))
    if not parts:
        raise FileNotFoundError(f"no parquet or csv files under {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# Texts that say that an instrument is a member.
MEMBER = ["1", "true", "yes", "y", "member", "in"]


def members(df: DataFrame, flag: str | None = None, include: Iterable[str] | None = None) -> DataFrame:
    """timestamp and instrument of a universe table's members: rows whose flag is among include, or says yes."""
    if flag is not None:
        text = F.col(flag).cast("string")
        number = dict(df.dtypes)[flag] in ("boolean", "int", "bigint", "double", "float", "smallint", "tinyint")
        yes = text.isin([str(v) for v in include]) if include is not None else (F.coalesce(F.col(flag).cast("double"), F.lit(0.0)) != 0 if number else F.lower(text).isin(MEMBER))
        df = df.filter(yes)
    return df.select("timestamp", trimmed("instrument").alias("instrument")).dropna().distinct()


# The options of each kind of source.
KINDS = {
    "parquet": {"timestamp": "align_time", "instrument": "ticker"},
    "cleaned_parquet": {"timestamp": "align_time", "instrument": "ticker"},
    "parquet_kline": {"timestamp": "window_start", "instrument": "ticker", "unit": "ns", "day": True, "file_days": True},
}
OPTIONS = {"timestamp", "instrument", "unit", "start", "end", "instruments", "day", "last_by", "file_days", "skip_corrupt"}


def build_source(spark: SparkSession, spec: Mapping) -> DataFrame:
    """The panel that a specification describes; an unknown type or option is an error.

    {type: parquet | cleaned_parquet | parquet_kline, path, fields, and options of parquet_panel}, or
    {type: composite, anchor: name, sources: {name: specification}, joins: {name: exact | asof_backward |
    forward_fill}, aliases: {column: name_column or an alias of one}}.
    """
    spec = dict(spec)
    kind = spec.pop("type", None)
    if kind == "composite":
        sources, anchor, joins, aliases = (spec.pop(k, d) for k, d in (("sources", {}), ("anchor", None), ("joins", {}), ("aliases", {})))
        if spec or anchor not in sources:
            raise ValueError(f"unknown options {sorted(spec)}" if spec else "a composite needs sources and the anchor's name")
        built = {n: build_source(spark, s) for n, s in sources.items()}
        out = composite_panel(built.pop(anchor), {n: (df, joins.get(n, "exact")) for n, df in built.items()})
        for name in aliases:
            seen, to = [name], aliases[name]
            while to in aliases and to not in out.columns:
                if to in seen:
                    raise ValueError(f"the aliases {' -> '.join([*seen, to])} go round in a circle")
                seen.append(to)
                to = aliases[to]
            out = out.withColumn(name, F.col(to))
        return out
    if kind not in KINDS:
        raise ValueError(f"unknown type of source {kind!r}")
    path, fields = spec.pop("path", None), spec.pop("fields", None)
    unknown = set(spec) - OPTIONS
    if unknown or not path or not fields:
        raise ValueError(f"unknown options {sorted(unknown)}" if unknown else "a source needs path and fields")
    return parquet_panel(spark, path, fields, **{**KINDS[kind], **spec})


def composite_panel(anchor: DataFrame, sources: Mapping[str, tuple[DataFrame, str]], *, tolerance_us: int | None = None) -> DataFrame:
    """anchor with the columns of each source as name_column, aligned exact, asof_backward or forward_fill.

    forward_fill aligns as asof_backward does. Sources are canonical panels.
    """
    out = anchor
    for name, (df, how) in sources.items():
        values = [c for c in df.columns if c not in ("timestamp", "instrument")]
        renamed = df.select("timestamp", "instrument", *[F.col(c).alias(f"{name}_{c}") for c in values])
        columns = [f"{name}_{c}" for c in values]
        if how == "exact":
            out = exact(out, renamed, columns=columns)
        elif how in ("asof_backward", "forward_fill"):
            out = as_of(out, renamed, columns=columns, tolerance_us=tolerance_us)
        else:
            raise ValueError(f"unknown alignment {how!r}")
    return out


def in_universe(df: DataFrame, members: DataFrame, least: int = 1, keys: Sequence[str] = ("timestamp", "instrument")) -> DataFrame:
    """Rows of df whose key is in members, on dates that then have at least so many instruments."""
    out = df.join(members.select(*keys).dropna().distinct(), list(keys), "left_semi")
    full = out.groupBy("timestamp").agg(F.count_distinct("instrument").alias("_n")).filter(F.col("_n") >= least)
    return out.join(broadcast_if_small(full.select("timestamp")), "timestamp", "left_semi")


def table_report(spark: SparkSession, path: str, *, day_column: str | None = None, not_negative: Sequence[str] = ()) -> DataFrame:
    """(file, rows, nulls, negatives, first_day, last_day, problem) of each parquet file under path.

    nulls counts null or NaN cells of all columns, negatives those of not_negative's columns. problem is
    'nothing read' for a file that is empty or can't be read, 'other days' where the day in the file's
    name isn't among its days, else null. One pass over the data, and one over the list of files.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    df = reader.option("ignoreCorruptFiles", "true").parquet(path)
    number = {c for c, t in df.dtypes if t in ("double", "float")}
    missing = sum(((F.col(c).isNull() | F.isnan(c)) if c in number else F.col(c).isNull()).cast("long") for c in df.columns)
    negative = sum((F.coalesce(F.col(c) < 0, F.lit(False)).cast("long") for c in not_negative), F.lit(0).cast("long"))
    days = [f(F.col(day_column).cast("string")) if day_column else F.lit(None).cast("string") for f in (F.min, F.max)]
    name = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    of_file = F.regexp_extract(name(F.col("_metadata.file_path")), FILE_DAY, 1)
    met = F.max((F.substring(F.col(day_column).cast("string"), 1, 10) == of_file).cast("int")) if day_column else F.lit(1)
    seen = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("rows"), F.sum(missing).alias("nulls"), F.sum(negative).alias("negatives"), days[0].alias("first_day"), days[1].alias("last_day"), met.alias("met")
    )
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    both = listed.select(plain("path").alias("path")).join(seen.withColumn("path", plain("path")), "path", "left").na.fill(0, ["rows", "nulls", "negatives"])
    problem = F.when(F.col("rows") == 0, "nothing read").when((F.regexp_extract(name(F.col("path")), FILE_DAY, 1) != "") & (F.col("met") == 0), "other days")
    return both.select(name(F.col("path")).alias("file"), "rows", "nulls", "negatives", "first_day", "last_day", problem.alias("problem"))
