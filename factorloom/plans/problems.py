"""Queries of the general data problems over the test tables, with SQL to compare them with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factorloom.functions.common import broadcast_if_small, cut_lineage, key_lower, key_upper, read_table
from factorloom.functions.zones import estimate_zones, known_zones
from factorloom.operators.drift import consistent_table, schema_history
from factorloom.operators.nearest_time import nearest_time_join
from factorloom.operators.orphans import orphan_counts, orphan_references
from factorloom.operators.times import normalise_times, read_times
from factorloom.operators.spikes import Measure, implausible_values
from factorloom.operators.rolling import trailing_totals

HOUR_US = 3_600_000_000


# 1. schemas that drift between files
def p1_changes(spark: SparkSession, d: str) -> DataFrame:
    return schema_history(read_table(spark, d, "raw_files")).filter("change <> 'field'").drop("canonical")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_changes(spark, d).select("file_name", "change", "old_field", "new_field").distinct()


def p1_moves(spark: SparkSession, d: str) -> DataFrame:
    """The changes of p1_found that two files alone decide: fields added, removed and renamed."""
    return p1_found(spark, d).filter("change <> 'type_changed'")


_JSON = "CASE WHEN json_type(v) IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE') THEN CAST(CAST(v AS DOUBLE) AS VARCHAR) ELSE json_type(v) || CAST(v AS VARCHAR) END"
_P1 = f"""
WITH line AS (SELECT dataset, shard, file_seq AS seq, file_name, record_key, payload FROM raw_files),
files AS (SELECT dataset, shard, seq, max(file_name) AS file_name, lag(seq) OVER (PARTITION BY dataset, shard ORDER BY seq) AS before FROM line GROUP BY 1, 2, 3),
field AS (SELECT DISTINCT dataset, shard, seq, record_key, k, json_extract(payload, '$."' || k || '"') AS v FROM (SELECT *, unnest(json_keys(payload)) AS k FROM line WHERE json_type(payload) = 'OBJECT')),
name AS (SELECT DISTINCT dataset, shard, seq, k FROM field),
came AS (SELECT f.*, n.k FROM files f JOIN name n ON n.dataset = f.dataset AND n.shard = f.shard AND n.seq = f.seq WHERE f.before IS NOT NULL AND NOT EXISTS (SELECT 1 FROM name o WHERE o.dataset = f.dataset AND o.shard = f.shard AND o.seq = f.before AND o.k = n.k)),
gone AS (SELECT f.*, o.k FROM files f JOIN name o ON o.dataset = f.dataset AND o.shard = f.shard AND o.seq = f.before WHERE NOT EXISTS (SELECT 1 FROM name n WHERE n.dataset = f.dataset AND n.shard = f.shard AND n.seq = f.seq AND n.k = o.k)),
val AS (SELECT dataset, shard, seq, record_key, k, {_JSON} AS t FROM field WHERE record_key IS NOT NULL AND json_type(v) <> 'NULL'),
moved AS (SELECT g.file_name, g.dataset, g.shard, g.seq, g.k AS old_field, c.k AS new_field FROM gone g JOIN came c ON c.dataset = g.dataset AND c.shard = g.shard AND c.seq = g.seq
  JOIN val a ON a.dataset = g.dataset AND a.shard = g.shard AND a.seq = g.before AND a.k = g.k JOIN val b ON b.dataset = g.dataset AND b.shard = g.shard AND b.seq = g.seq AND b.k = c.k AND b.record_key = a.record_key
  GROUP BY ALL HAVING bool_and(a.t = b.t))
SELECT file_name, 'renamed' AS change, old_field, new_field FROM moved
UNION ALL SELECT file_name, 'removed', k, '' FROM gone g WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.dataset = g.dataset AND m.shard = g.shard AND m.seq = g.seq AND m.old_field = g.k)
UNION ALL SELECT file_name, 'added', '', k FROM came c WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.dataset = c.dataset AND m.shard = c.shard AND m.seq = c.seq AND m.new_field = c.k)"""


def _p1_table(dataset: str):
    return lambda spark, d: consistent_table(read_table(spark, d, "raw_files"), dataset)


# 2. references to records that do not exist
def _orphans(spark: SparkSession, d: str, operator=orphan_references, **more) -> DataFrame:
    registry, marks, runs, summary = (read_table(spark, d, f"factor_{t}") for t in ("registry", "watermark", "evaluation_runs", "evaluation_summary"))
    # one pass for all three: keys carry the kind of their target, records the name of their table
    def refs(table: DataFrame, name: str, target: str, key: Column, record_key: Column, at: str) -> DataFrame:
        record = F.struct(F.lit(name).alias("table_name"), record_key.alias("record_key"))
        return table.select(F.concat(F.lit(target), key).alias("key"), record.alias("record"), F.try_to_timestamp(at).alias("at"))

    def lives(table: DataFrame, target: str, key: Column) -> DataFrame:
        return table.select(F.concat(F.lit(target), key).alias("key"), F.try_to_timestamp("created_at").alias("created"), F.try_to_timestamp("deleted_at").alias("deleted"))

    factor, run = key_lower("factor_id"), key_lower("run_id")
    all_refs = (
        refs(marks, "factor_watermark", "f:", factor, factor, "last_updated")
        .unionByName(refs(runs, "factor_evaluation_runs", "f:", factor, run, "created_at"))
        .unionByName(refs(summary, "factor_evaluation_summary", "r:", run, F.concat(run, F.lit("|"), F.col("horizon").cast("string")), "written_at"))
    )
    return operator(
        all_refs,
        lives(registry, "f:", factor).unionByName(lives(runs, "r:", run)),
        ref_key=F.col("key"),
        record_key=F.col("record"),
        at=F.col("at"),
        target_key=F.col("key"),
        created=F.col("created"),
        deleted=F.col("deleted"),
        **more,
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("record_key.*", "kind").distinct()


def p2_per_month(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d, orphan_counts, by=[F.col("record_key.table_name"), F.date_format("at", "yyyy-MM").alias("month")])


_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_LOW = lambda c: f"lower({_TRIM.format(c)})"
_UP = lambda c: f"upper({_TRIM.format(c)})"


def _orphan_sql(name: str, ref: str, key: str, at: str, target: str, target_key: str) -> str:
    return f"""
    SELECT DISTINCT '{name}' AS table_name, r.rk AS record_key, r.seen,
      CASE WHEN n = 0 THEN 'missing' WHEN begun = 0 THEN 'late' ELSE 'deleted' END AS kind
    FROM (SELECT x.rk, x.k, x.seen, count(t.k) AS n, count(*) FILTER (WHERE t.c <= x.seen) AS begun,
            count(*) FILTER (WHERE t.c <= x.seen AND (t.d IS NULL OR t.d > x.seen)) AS alive
          FROM (SELECT DISTINCT {key} AS rk, {ref} AS k, {at} AS seen FROM {name} WHERE {ref} <> '') x
          LEFT JOIN (SELECT DISTINCT {target_key} AS k, created_at AS c, deleted_at AS d FROM {target}) t ON t.k = x.k
          GROUP BY x.rk, x.k, x.seen) r WHERE alive = 0"""


_P2 = " UNION ALL ".join(
    [
        _orphan_sql("factor_watermark", _LOW("factor_id"), _LOW("factor_id"), "last_updated", "factor_registry", _LOW("factor_id")),
        _orphan_sql("factor_evaluation_runs", _LOW("factor_id"), _LOW("run_id"), "created_at", "factor_registry", _LOW("factor_id")),
        _orphan_sql("factor_evaluation_summary", _LOW("run_id"), f"{_LOW('run_id')} || '|' || horizon", "written_at", "factor_evaluation_runs", _LOW("run_id")),
    ]
)


# 3. implausible measurements
MEASURES = {"c": Measure("ratio", 0.0, True), "v": Measure("factor", 0.0, False), "net_return": Measure("size", -1.0, False)}


def p3_reasons(spark: SparkSession, d: str) -> DataFrame:
    bars, returns = read_table(spark, d, "daily_market_summary"), read_table(spark, d, "backtest_returns")
    pair = lambda f: F.struct(F.lit(f).alias("measure"), F.col(f).alias("value"))
    of_bars = bars.select(key_upper("ticker").alias("source"), F.col("trade_date").alias("day"), F.lit(False).alias("idle"), F.explode(F.array(pair("c"), pair("v"))).alias("m"))
    of_returns = returns.select(F.col("strategy_id").alias("source"), F.col("trade_date").alias("day"), (F.col("holdings_count") == 0).alias("idle"), pair("net_return").alias("m"))
    records = of_bars.unionByName(of_returns).select("m.*", "source", "day", "idle")
    found = implausible_values(records, MEASURES)
    table = F.when(F.col("measure") == "net_return", F.lit("backtest_returns")).otherwise(F.lit("daily_market_summary"))
    return found.select(table.alias("table_name"), F.col("source").alias("source_key"), F.col("day").alias("trade_date"), F.col("measure").alias("field"), "value", "reason")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_reasons(spark, d).select("table_name", "source_key", "trade_date", "field").distinct()


def p3_rules(spark: SparkSession, d: str) -> DataFrame:
    """The part of p3_reasons that follows from rules alone: impossible and stuck values, and sizes."""
    return p3_reasons(spark, d).filter("reason <> 'spike' or field = 'net_return'")


_NOT_NAN = lambda c: f"CASE WHEN NOT isnan({c}) THEN {c} END"
_P3 = f"""
WITH raw AS (SELECT 'c' AS field, {_UP("ticker")} AS source_key, trade_date, {_NOT_NAN("c")} AS value, false AS idle FROM daily_market_summary
  UNION ALL SELECT 'v', {_UP("ticker")}, trade_date, {_NOT_NAN("v")}, false FROM daily_market_summary
  UNION ALL SELECT 'net_return', strategy_id, trade_date, {_NOT_NAN("net_return")}, coalesce(holdings_count = 0, false) FROM backtest_returns),
own AS (SELECT * FROM (SELECT DISTINCT * FROM raw WHERE source_key IS NOT NULL AND trade_date IS NOT NULL AND (field = 'net_return' OR source_key <> '')) QUALIFY value IS NOT NULL OR count(value) OVER (PARTITION BY field, source_key, trade_date) = 0),
steps AS (SELECT *, coalesce(isinf(value) OR (field = 'c' AND value <= 0) OR (field = 'v' AND value < 0) OR (field = 'net_return' AND value < -1), false) AS impossible,
  CASE WHEN value = lag(value) OVER w AND NOT idle AND NOT lag(idle) OVER w THEN 0 ELSE 1 END AS new, row_number() OVER w AS i FROM own WINDOW w AS (PARTITION BY field, source_key ORDER BY trade_date, value NULLS FIRST, idle)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY field, source_key ORDER BY i) AS run FROM steps),
long AS (SELECT *, count(*) OVER (PARTITION BY field, source_key, run) >= 6 AND value IS NOT NULL AND NOT idle AND NOT impossible AS stuck FROM runs),
sizes AS (SELECT source_key, median(abs(value)) AS usual FROM own WHERE field = 'net_return' AND value <> 0 AND NOT idle AND NOT isinf(value) AND value >= -1 GROUP BY 1 HAVING count(*) >= 5),
far AS (SELECT long.*, abs(value) > 10 * usual AS far FROM long JOIN sizes USING (source_key) WHERE field = 'net_return' AND value IS NOT NULL AND NOT idle AND NOT impossible),
far2 AS (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY i) - row_number() OVER (PARTITION BY source_key, far ORDER BY i) AS island FROM far),
spikes AS (SELECT * FROM far2 QUALIFY far AND count(*) OVER (PARTITION BY source_key, far, island) <= 2 AND NOT stuck)
SELECT CASE WHEN field = 'net_return' THEN 'backtest_returns' ELSE 'daily_market_summary' END AS table_name, source_key, trade_date, field, value, reason FROM (
  SELECT field, source_key, trade_date, value, CASE WHEN impossible THEN 'impossible' ELSE 'stuck' END AS reason FROM long WHERE impossible OR stuck
  UNION ALL SELECT field, source_key, trade_date, value, 'spike' FROM spikes)"""


# 4. one instant per time
def _raw_times(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The times as received with their source's configuration, and the zones of the sources that have none."""
    raw = read_table(spark, d, "raw_times").select("record_id", "source", "time_column", "raw_value").withColumn("key", key_lower("source"))
    config = read_table(spark, d, "source_config").select(key_lower("source").alias("key"), "time_format", "timezone").dropDuplicates(["key"])
    raw = raw.join(broadcast_if_small(config), "key", "left")
    # UTC stands for an unknown zone, unless the order of the records speaks for another zone in use
    named = sorted({r[0] for r in config.select("timezone").distinct().collect() if r[0]} & set(known_zones(config).values()))
    is_unknown = F.coalesce(key_lower("timezone"), F.lit("unknown")) == "unknown"
    read = read_times(raw.filter(is_unknown), raw=F.col("raw_value"), time_format=F.col("time_format"), close=F.lit(False)).filter("__time_zone is null")
    moment = lambda c: F.timestamp_micros(F.col(c))
    zones = estimate_zones(read, source=F.col("key"), local=moment("__time_local"), fixed=moment("__time_fixed"), sequence=F.col("record_id"), candidates=["UTC", *named])
    return raw, cut_lineage(zones)  # a row per source without a zone


def p4_times(spark: SparkSession, d: str) -> DataFrame:
    raw, zones = _raw_times(spark, d)
    raw = raw.join(broadcast_if_small(zones.select(F.col("source").alias("key"), F.col("zone").alias("estimated"))), "key", "left")
    out = normalise_times(raw, raw=F.col("raw_value"), time_format=F.col("time_format"), zone=F.col("timezone"), default_zone=F.coalesce("estimated", F.lit("UTC")))
    return out.select("record_id", "source", "time_column", "time_form", "utc_micros")


def p4_zones(spark: SparkSession, d: str) -> DataFrame:
    """The zone estimated for each source without one, its violations and records."""
    return _raw_times(spark, d)[1]


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_times(spark, d).filter("utc_micros is not null").select("record_id", "utc_micros")


def p4_epochs(spark: SparkSession, d: str) -> DataFrame:
    """The times that came as numbers, in whatever unit."""
    return p4_times(spark, d).filter("time_form = 'epoch'").select("record_id", "utc_micros")


def p4_offsets(spark: SparkSession, d: str) -> DataFrame:
    """The times that begin with the year and end with an offset or Z, whose source's zone doesn't matter."""
    stated = F.col("raw_value").rlike(r"^\s*\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})\s*$")
    own = read_table(spark, d, "raw_times").filter(stated).select("record_id")
    return p4_found(spark, d).join(own, "record_id")


_EPOCH_UNIT = lambda u, sql: f"WHEN x >= {946_684_800 * u} AND x < {2_051_222_400 * u} THEN {sql}"
_P4_EPOCHS = f"""
WITH n AS (SELECT record_id, {_TRIM.format("raw_value")} AS s FROM raw_times), x AS (SELECT record_id, TRY_CAST(s AS DECIMAL(38, 18)) AS x FROM n
  WHERE regexp_full_match(s, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') AND NOT regexp_full_match(s, '[0-9]{{8}}')),
y AS (SELECT record_id, x, CAST(floor(x) AS HUGEINT) AS whole, x - floor(x) AS rest FROM x)
SELECT record_id, utc_micros FROM (SELECT record_id, CAST(CASE {_EPOCH_UNIT(1, "whole * 1000000 + floor(rest * 1000000)")} {_EPOCH_UNIT(1_000, "whole * 1000 + floor(rest * 1000)")}
  {_EPOCH_UNIT(1_000_000, "whole")} {_EPOCH_UNIT(1_000_000_000, "whole // 1000")} END AS BIGINT) AS utc_micros FROM y) WHERE utc_micros IS NOT NULL"""
_P4_OFFSETS = f"""
WITH n AS (SELECT record_id, {_TRIM.format("raw_value")} AS s FROM raw_times), p AS (SELECT record_id, regexp_extract(s, '^([0-9]{{4}})-([0-9]{{2}})-([0-9]{{2}})[T ]([0-9]{{2}}):([0-9]{{2}}):([0-9]{{2}})(?:\\.([0-9]+))?(Z|[+-][0-9]{{2}}:[0-9]{{2}})$', ['y', 'm', 'd', 'h', 'i', 's', 'f', 'z']) AS g FROM n),
t AS (SELECT record_id, g.z AS z, g.f AS f, CAST(g.s AS INT) AS sec, TRY_CAST(g.y || '-' || g.m || '-' || g.d AS DATE) AS day, CAST(g.h AS INT) AS h, CAST(g.i AS INT) AS i FROM p WHERE g.y <> '')
SELECT record_id, epoch_us(CAST(day AS TIMESTAMP)) + (h * 3600 + i * 60 + sec) * 1000000::BIGINT + CAST(rpad(left(f, 6), 6, '0') AS BIGINT)
  - CASE WHEN z = 'Z' THEN 0 ELSE (CASE WHEN z[1] = '-' THEN -1 ELSE 1 END) * (CAST(z[2:3] AS BIGINT) * 60 + CAST(z[5:6] AS BIGINT)) * 60000000 END AS utc_micros FROM t WHERE day IS NOT NULL AND h < 24 AND i < 60 AND sec < 60"""


# 5. the nearest bar of each factor value
def _nearest_bars(spark: SparkSession, d: str, **how: int) -> DataFrame:
    lake, bars = read_table(spark, d, "factor_lake"), read_table(spark, d, "daily_market_summary")
    out = nearest_time_join(
        lake,
        bars,
        left_id=F.col("lake_row_id"),
        left_entity=key_upper("asset"),
        left_time=F.col("datetime"),
        right_id=F.col("bar_id"),
        right_entity=key_upper("ticker"),
        right_time=F.col("align_time"),
        tolerance_us=16 * HOUR_US,
        **how,
    )
    return out.select(F.col("left_id").alias("lake_row_id"), F.col("right_id").alias("bar_id"), "gap_us")


def p5_nearest_bars(spark: SparkSession, d: str) -> DataFrame:
    return _nearest_bars(spark, d)


def p5_crowded(spark: SparkSession, d: str) -> DataFrame:
    """The same rows by way of crowded cells: long buckets of few rows each, which are cut and salted."""
    return _nearest_bars(spark, d, bucket_us=400 * 24 * HOUR_US, cell_rows=200)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_nearest_bars(spark, d).select("lake_row_id", "bar_id")


_P5 = f"""
WITH l AS (SELECT lake_row_id, {_UP("asset")} AS k, epoch_us(datetime) AS t FROM factor_lake WHERE datetime IS NOT NULL AND asset IS NOT NULL),
b AS (SELECT min(bar_id) AS bar_id, {_UP("ticker")} AS k, epoch_us(align_time) AS t FROM daily_market_summary WHERE align_time IS NOT NULL AND ticker IS NOT NULL GROUP BY 2, 3),
before AS (SELECT l.lake_row_id, b.bar_id, l.t - b.t AS gap FROM l ASOF JOIN b ON l.k = b.k AND l.t >= b.t),
after AS (SELECT l.lake_row_id, b.bar_id, b.t - l.t AS gap FROM l ASOF JOIN b ON l.k = b.k AND l.t <= b.t),
both_sides AS (SELECT *, 0 AS side FROM before UNION ALL SELECT *, 1 FROM after)
SELECT lake_row_id, bar_id, gap AS gap_us FROM (SELECT *, row_number() OVER (PARTITION BY lake_row_id ORDER BY gap, side, bar_id) AS rn FROM both_sides)
WHERE rn = 1 AND gap <= {16 * HOUR_US}"""


# 6. trailing totals
def _trailing(spark: SparkSession, d: str) -> DataFrame:
    aggs = read_table(spark, d, "day_aggs")
    day = F.when(F.col("window_start") != 0, F.date_from_unix_date(F.floor(F.col("window_start") / 86_400_000_000_000).cast("int")))
    return trailing_totals(aggs, entity=key_upper("ticker"), day=day, volume=F.col("volume"), close=F.col("close"), latest_by=F.col("ingested_at")).withColumnRenamed("entity", "ticker")


def p6_trailing(spark: SparkSession, d: str) -> DataFrame:
    out = _trailing(spark, d)
    return out.withColumns({c: F.round(c, 8) for c in out.columns if c.startswith("avg_")})


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    surge = _trailing(spark, d).filter("age >= 30 and 2 * volume_7 > volume_30")
    return surge.select("ticker", F.date_format("day", "yyyy-MM-dd").alias("day"))


_P6 = f"""
WITH raw AS (SELECT {_UP("ticker")} AS ticker, CAST(make_timestamp(window_start // 1000) AS DATE) AS day, ingested_at,
    CASE WHEN isfinite(volume) THEN volume END AS volume, CASE WHEN isfinite(close) THEN close END AS close FROM day_aggs WHERE window_start <> 0),
bars AS (SELECT ticker, day, coalesce(volume, 0) AS volume, close FROM (SELECT *, row_number() OVER (PARTITION BY ticker, day
    ORDER BY ingested_at DESC NULLS LAST, volume DESC NULLS LAST, close DESC NULLS LAST) AS rn FROM raw WHERE ticker <> '') WHERE rn = 1),
spans AS (SELECT ticker, min(day) AS first, max(day) AS last FROM bars GROUP BY 1),
days AS (SELECT ticker, first, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS day FROM spans),
grid AS (SELECT days.ticker, days.day, date_diff('day', first, days.day) + 1 AS age, coalesce(volume, 0) AS volume, close FROM days LEFT JOIN bars USING (ticker, day))
SELECT ticker, day, age, sum(volume) OVER w7 AS volume_7, round(sum(volume) OVER w7 / least(age, 7), 8) AS avg_volume_7, round(avg(close) OVER w7, 8) AS avg_close_7,
  sum(volume) OVER w30 AS volume_30, round(sum(volume) OVER w30 / least(age, 30), 8) AS avg_volume_30, round(avg(close) OVER w30, 8) AS avg_close_30
FROM grid WINDOW w7 AS (PARTITION BY ticker ORDER BY day ROWS 6 PRECEDING), w30 AS (PARTITION BY ticker ORDER BY day ROWS 29 PRECEDING)"""

QUERIES = {
    "p1_found": p1_found,
    "p1_changes": p1_changes,
    "p1_moves": p1_moves,
    "p1_income_statement": _p1_table("income_statement"),
    "p1_corp_dividends": _p1_table("corp_dividends"),
    "p1_filing_risk_factors": _p1_table("filing_risk_factors"),
    "p4_found": p4_found,
    "p4_times": p4_times,
    "p4_zones": p4_zones,
    "p4_epochs": p4_epochs,
    "p4_offsets": p4_offsets,
    "p3_found": p3_found,
    "p3_reasons": p3_reasons,
    "p3_rules": p3_rules,
    "p2_found": p2_found,
    "p2_per_month": p2_per_month,
    "p5_found": p5_found,
    "p5_nearest_bars": p5_nearest_bars,
    "p5_crowded": p5_crowded,
    "p6_found": p6_found,
    "p6_trailing": p6_trailing,
}

ORACLE_SQL = {
    "p1_moves": _P1,
    "p3_rules": _P3,
    "p4_epochs": _P4_EPOCHS,
    "p4_offsets": _P4_OFFSETS,
    "p2_found": f"SELECT DISTINCT table_name, record_key, kind FROM ({_P2})",
    "p2_per_month": f"SELECT table_name, left(seen, 7) AS month, kind, count(*) AS records FROM ({_P2}) GROUP BY 1, 2, 3",
    "p5_found": f"SELECT lake_row_id, bar_id FROM ({_P5})",
    "p5_nearest_bars": _P5,
    "p5_crowded": _P5,
    "p6_found": f"SELECT ticker, strftime(day, '%Y-%m-%d') AS day FROM ({_P6}) WHERE age >= 30 AND 2 * volume_7 > volume_30",
    "p6_trailing": _P6,
}
