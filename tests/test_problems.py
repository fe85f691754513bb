"""The general data operators: brute force on fixtures, and the cases that any table may hold."""

import json
import random
from datetime import date, datetime, timedelta, timezone
from itertools import groupby
from statistics import median

import numpy as np
import pytest
from drift_reference import changes
from pyspark.sql import functions as F
from times_reference import read

from factorloom.functions.common import key_lower, key_upper
from factorloom.functions.zones import estimate_zones
from factorloom.operators.drift import consistent_table, schema_history
from factorloom.operators import spikes
from factorloom.operators.nearest_time import nearest_time_join
from factorloom.operators.orphans import orphan_references
from factorloom.operators.rolling import trailing_totals
from factorloom.operators.spikes import Measure, implausible_values
from factorloom.operators.times import normalise_times
from factorloom.plans.problems import p3_reasons

UTC = timezone.utc
T0 = datetime(2024, 1, 1, tzinfo=UTC)


# 1. drift
RAW = "dataset string, shard int, file_seq int, file_name string, line_no int, record_key long, payload string, extra string"


def raw(files):
    """files: list of lists of (key, payload)."""
    return [("d", 0, s, f"f{s}", i, k, p if p is None or isinstance(p, str) else json.dumps(p), "x") for s, lines in enumerate(files, 1) for i, (k, p) in enumerate(lines)]


def found(spark, rows):
    h = schema_history(spark.createDataFrame(rows, RAW)).filter("change <> 'field'")
    return {(r.file_name, r.change, r.old_field, r.new_field) for r in h.collect()}


FILES = [
    [(1, {"a": 1, "b": "x", "c": None}), (2, {"a": 2, "b": "y", "c": None})],
    [(1, {"a": 1.0, "bb": "x", "c": 5}), (2, {"a": 2, "bb": "y"}), (3, {"a": "3", "bb": None})],
    [(2, {"a": None, "bb": "y", "d": [1]}), (3, {"a": None, "bb": "z"}), (3, {"a": None, "bb": "z"})],
    [(3, {"a": 7, "bb": {"k": 1}, "d": True})],
]


def test_drift_matches_plain_reading(spark):
    rows = raw(FILES)
    want = changes([r[:4] + r[5:7] for r in rows])
    assert found(spark, rows) == want
    assert ("f2", "renamed", "b", "bb") in want and ("f4", "type_changed", "a", "a") in want


def test_drift_of_unreadable_and_missing(spark):
    rows = raw([[(1, {"a": 1})], [(1, "no json"), (None, None), (2, "[1, 2]")], [(1, {"a": 1})]])
    assert found(spark, rows) == {("f2", "removed", "a", ""), ("f3", "added", "", "a")}
    assert found(spark, []) == set()
    assert found(spark, [(None, 0, 1, "f", 1, 1, "{}", "x"), ("d", None, 1, "f", 1, 1, "{}", "x")]) == set()


def test_consistent_table_keeps_everything(spark):
    t = consistent_table(spark.createDataFrame(raw(FILES), RAW), "d")
    assert {"a", "a__number", "a__string", "b", "b__string", "b__object", "c", "d__array", "d__boolean"} <= set(t.columns)
    rows = {(r.file_seq, r.record_key): r for r in t.collect()}
    assert len(rows) == 2 + 3 + 2 + 1
    assert rows[2, 3].a == "3" and rows[2, 3].a__string == "3" and rows[2, 1].a__number == 1.0
    assert json.loads(rows[4, 3].b__object) == {"k": 1} and rows[4, 3].d__boolean is True
    few = consistent_table(spark.createDataFrame(raw(FILES), RAW), "d", most_columns=1)
    assert any(r.other_fields for r in few.collect())
    assert consistent_table(spark.createDataFrame([], RAW), "d").count() == 0


# 2. orphans
def orphans(spark, refs, lives, **kw):
    r = spark.createDataFrame(refs, "k string, at timestamp, created timestamp")
    t = spark.createDataFrame(lives, "k string, created timestamp, deleted timestamp, at int")
    out = orphan_references(r, t, ref_key=key_lower("k"), record_key=key_lower("k"), at=F.col("at"), target_key=key_lower("k"), created=F.col("created"), deleted=F.col("deleted"), **kw)
    return sorted(((x.record_key, x.at.replace(tzinfo=UTC) if x.at else None, x.kind) for x in out.collect()), key=str)


def day(n):
    return T0 + timedelta(n)


def test_orphans_against_brute_force(spark):
    rng = random.Random(5)
    keys = ["A", " b", "c\t", "D", None, ""]
    lives = [(rng.choice(keys[:3] + [None]), day(rng.randrange(200)), rng.choice([None, day(rng.randrange(100, 300))]), 1) for _ in range(12)] * 2
    lives = [(k, c, e if e is None or e > c else c + timedelta(1), x) for k, c, e, x in lives]
    refs = [(rng.choice(keys), day(rng.randrange(250)), None) for _ in range(150)] * 2 + [("a", lives[0][1], None), ("d", None, None), ("a", None, None)]
    clean = lambda k: (k or "").strip().lower()
    want = set()
    for k, at, _ in refs:
        own = [x for x in lives if clean(x[0]) == clean(k)]
        if not clean(k):
            continue
        if not own:
            want.add((clean(k), at, "missing"))
        elif at is not None and not any(c <= at and (e is None or at < e) for _, c, e, _ in own):
            want.add((clean(k), at, "late" if all(c > at for _, c, _, _ in own) else "deleted"))
    key = str
    assert sorted(orphans(spark, refs, lives), key=key) == sorted(want, key=key)
    heavy = [("a", day(n % 250), None) for n in range(1500)]
    more = {("a", at, "late" if all(c > at for k, c, _, _ in lives if clean(k) == "a") else "deleted") for _, at, _ in heavy if not any(clean(k) == "a" and c <= at and (e is None or at < e) for k, c, e, _ in lives)}
    for how in ({"heavy_share": 0.1}, {"heavy_share": 0.1, "cell_rows": 3}, {"heavy_share": 2.0, "cell_rows": 3}, {"heavy_share": 0.0}):
        assert sorted(orphans(spark, refs + heavy, lives, **how), key=key) == sorted(want | more, key=key)


def test_orphans_of_a_heavy_key(spark):
    n = 100_000
    refs = spark.range(n).select(F.when(F.col("id") % 10 == 0, F.concat(F.lit("light"), F.col("id") % 2000)).otherwise("hot").alias("k"), F.col("id").alias("n"), F.timestamp_seconds(F.col("id") * 1000).alias("at"))
    lives = spark.createDataFrame([("hot", 1_000_000, 2_000_000), ("hot", 1_500_000, 50_000_000), ("hot", 60_000_000, None), ("light0", 5_000, 7_000), ("light0", 90_000_000, None)], "k string, c long, d long")
    out = orphan_references(refs, lives, ref_key=F.col("k"), record_key=F.col("n"), at=F.col("at"), target_key=F.col("k"), created=F.timestamp_seconds("c"), deleted=F.timestamp_seconds("d"), heavy_share=0.1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan
    got = {r.kind: r.n for r in out.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    of = lambda k, t: "missing" if k not in ("hot", "light0") else ("late" if t < (1_000_000 if k == "hot" else 5_000) else "deleted")
    alive = lambda k, t: (k == "hot" and (1_000_000 <= t < 50_000_000 or t >= 60_000_000)) or (k == "light0" and (5_000 <= t < 7_000 or t >= 90_000_000))
    rows = [("hot" if i % 10 else f"light{i % 2000}", i * 1000) for i in range(n)]
    want = [of(k, t) for k, t in rows if not alive(k, t)]
    assert got == {k: want.count(k) for k in set(want)}


def test_orphans_of_empty_tables(spark):
    assert orphans(spark, [], [("a", day(1), None, 1)]) == []
    assert orphans(spark, [("a", day(1), None)], []) == [("a", day(1), "missing")]


# 3. spikes
MEASURES = {"c": Measure("ratio", 0.0, True), "v": Measure("factor", 0.0, False), "r": Measure("size", -1.0, False)}


def judged(spark, rows):
    df = spark.createDataFrame(rows, "measure string, source string, day string, value double, idle boolean, pos int")
    return sorted((r.measure, r.source, r.day, r.reason) for r in implausible_values(df, MEASURES).collect())


def series(measure, values, source="s", start=date(2024, 1, 1), idle=False):
    return [(measure, source, str(start + timedelta(i)), v, idle, 9) for i, v in enumerate(values)]


def test_spikes_stuck_and_impossible(spark):
    rng = random.Random(1)
    walk = [100.0]
    for _ in range(79):
        walk.append(walk[-1] * (1 + rng.gauss(0, 0.01)))
    c = walk[:]
    c[20] *= 3
    c[40], c[41] = c[40] * 0.2, c[41] * 0.2
    c[50] = -1.0
    c[60:66] = [c[60]] * 6
    c[70:75] = [c[70]] * 5
    split = [x / 4 for x in walk[:30]] + walk[30:]
    v = [1000.0 * (1 + rng.random()) for _ in range(60)]
    v[10], v[30], v[31], v[32], v[33] = 1e6, 6e4, 3e4, 1.5e4, 7e3
    v[45] = None
    r = [rng.gauss(0, 0.01) for _ in range(60)]
    r[15], r[30], r[40] = 0.9, -1.5, float("inf")
    idle = [0.0] * 10
    rows = series("c", c) + series("c", split, "split") + series("v", v) + series("r", r) + series("r", idle, "idle", idle=True)
    got = judged(spark, rows + rows[:50])
    d = lambda n: str(date(2024, 1, 1) + timedelta(n))
    want = [("c", "s", d(i), "spike") for i in (20, 40, 41)] + [("c", "s", d(50), "impossible")] + [("c", "s", d(i), "stuck") for i in range(60, 66)]
    want += [("v", "s", d(10), "spike"), ("r", "s", d(15), "spike"), ("r", "s", d(30), "impossible"), ("r", "s", d(40), "impossible")]
    assert got == sorted(want)


def test_spikes_across_tiles(spark):
    rng = random.Random(2)
    c = [100 + rng.gauss(0, 0.1) for _ in range(1200)]
    c[511] *= 2
    c[512] *= 2
    c[1020:1030] = [c[1020]] * 10
    d = lambda n: str(date(2024, 1, 1) + timedelta(n))
    assert judged(spark, series("c", c)) == sorted([("c", "s", d(511), "spike"), ("c", "s", d(512), "spike")] + [("c", "s", d(i), "stuck") for i in range(1020, 1030)])


def test_spikes_of_odd_tables(spark):
    assert judged(spark, []) == []
    rows = [("c", None, "2024-01-01", 5.0, False, 1), ("c", "s", None, 5.0, False, 1), ("c", "s", "2024-01-02", None, None, 1), ("c", "s", "2024-01-03", float("nan"), False, 1), (None, "s", "2024-01-04", -5.0, False, 1)]
    assert judged(spark, rows) == []


def test_spikes_of_sizes_by_the_rule_alone(spark):
    small = [0.01 * (-1) ** (i * i // 3) for i in range(80)]  # the usual size is 0.01
    small[20], small[35], small[50] = 0.09, -0.11, 0.14
    small[60:63] = [0.095, 0.11, -0.12]  # only two in a row exceed the bound
    small[70:73] = [0.11, 0.12, 0.13]
    d = lambda n: str(date(2024, 1, 1) + timedelta(n))
    got = [x for x in judged(spark, series("r", small)) if x[3] == "spike"]
    assert got == [("r", "s", d(i), "spike") for i in (35, 50, 61, 62)]


def test_stuck_by_vanishing_innovations():
    """No run of six equal values escapes the filter, whatever came before it, and values that differ are none."""
    rng = np.random.default_rng(3)
    n, length = 400, 40
    value = np.round(100 + np.cumsum(rng.normal(0, 1, (n, length)) * rng.choice([1, 1, 30], (n, length)), axis=1), 6)
    for i in range(n):
        a = int(rng.integers(0, length - 8))
        value[i, a : a + int(rng.integers(3, 9))] = value[i, a] * rng.choice([1.0, 1.0, 5.0, 0.0])
    value[rng.random(value.shape) < 0.02] = np.nan
    value[0] = 7.0
    value[1, :8] = [1e-200 * k for k in range(8)]
    idle = rng.random(value.shape) < 0.01
    want = np.zeros(value.shape, bool)
    for i in range(n):
        for j in range(length - 5):
            if len(set(value[i, j : j + 6])) == 1 and not np.isnan(value[i, j]) and not idle[i, j : j + 6].any():
                want[i, j : j + 6] = True
    for scale in (1.0, 1e-3, 40.0, np.nan):
        calm = spikes._candidates(np.where(idle, np.nan, value), value, np.full(n, scale), MEASURES["r"])[1]
        assert (spikes._stuck(value, idle, calm) == want).all()
    assert 0 < want.sum() and not calm.all()
    assert not spikes._stuck(value, idle, np.zeros(value.shape, bool)).any()


def test_spikes_do_not_depend_on_tiles(spark):
    rng = random.Random(8)
    c = [100.0]
    for i in range(3000):
        c.append(c[-1] * (1 + rng.gauss(0, 0.001 + i / 60_000)))  # the deviation rises from 0.1 % to 5 %
    for i in range(0, 3000, 127):
        c[i] *= 1.9
    df = spark.createDataFrame(series("c", c), "measure string, source string, day string, value double, idle boolean, pos int")
    rows = [sorted((r.day, r.reason) for r in implausible_values(df, MEASURES, width=w).collect()) for w in (64, 512, 4096)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) >= 20
    days = sorted((r.day, r.reason) for r in implausible_values(df, MEASURES, slice_rows=28).collect())  # months of 29 days and more are cut
    assert days == rows[0]


def test_net_return_of_a_table_against_plain_reading(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/backtest_returns.parquet")
    series_of = {}
    for r in table.select("strategy_id", "trade_date", "net_return", "holdings_count").distinct().collect():
        if r.strategy_id is not None and r.trade_date is not None and r.net_return is not None and r.net_return == r.net_return:
            series_of.setdefault(r.strategy_id, set()).add((r.trade_date, r.net_return, r.holdings_count == 0))
    want = set()
    for key, own in series_of.items():
        possible = [x for x in sorted(own) if -1 <= x[1] < float("inf")]
        sizes = [abs(v) for _, v, idle in possible if v and not idle]
        runs = [list(g) for big, g in groupby((x for x in possible if not x[2]), lambda x: abs(x[1]) > 10 * median(sizes)) if big]
        want |= {(key, day) for run in runs if len(run) <= 2 for day, _, _ in run}
    found = p3_reasons(spark, "/root/testdata/sf0.1").filter("field = 'net_return' and reason = 'spike'")
    assert {(r.source_key, r.trade_date) for r in found.collect()} == want
    assert ("strat_neutral_000009", "2025-03-25") in want


# 4. times
def test_times_against_plain_reading(spark):
    values = [
        "2024-03-10 02:30:00", "2024-11-03T01:30:00", "2024-11-03 01:30:00 EST", "03/04/2024 05:06", "3/4/2024 12:00:00 AM", "3/4/2024 12:00:00 PM", "13/04/2024 05:06:07", "4.3.2024 05:06",
        "20240304", "20240332", "20240304T050607Z", "1709528767", "1709528767.1234567", "1.709528767E+12", "1709528767123456789", "-1", "0", "999", "Mon, 04 Mar 2024 05:06:07 +0530",
        "4 Mar 2024 05:06:07", "2024-03-04T05:06:07.123456789-03:30", "2024-03-04T05:06:07[Asia/Tokyo]", "2024-03-04 05:06:07 Mars/Base", "2024-02-30", "2024-03-04 25:00", "tbd", "", "  ", None,
        "2024-03-04", "2024-03-04T05:06:07+08", "2024-03-04 05:06:07 cest", "x" * 100_000,
    ]
    rows = [(i, v, f, z, "clash") for i, (v, f, z) in enumerate((v, f, z) for v in values for f in ("mdy_datetime", "dmy_datetime", "iso_datetime", None) for z in ("America/New_York", "Europe/London", "unknown", "us_market_close", None))]
    df = spark.createDataFrame(rows, "id int, raw string, fmt string, zone string, utc_micros string")
    got = {r.id: r.utc_micros for r in normalise_times(df, raw=F.col("raw"), time_format=F.col("fmt"), zone=F.col("zone")).collect()}
    for i, v, f, z, _ in rows:
        assert got[i] == read(v, f, z), (v, f, z)


def test_times_of_no_rows(spark):
    df = spark.createDataFrame([], "raw string, fmt string, zone string")
    assert normalise_times(df, raw=F.col("raw"), time_format=F.col("fmt"), zone=F.col("zone")).count() == 0


def test_zone_estimates(spark):
    from zoneinfo import ZoneInfo

    rows = []
    for source, z in (("a", "America/New_York"), ("b", "Asia/Tokyo")):
        for i in range(300):
            at = T0 + timedelta(hours=29 * i)
            rows.append((source, at.astimezone(ZoneInfo(z)).replace(tzinfo=None), at + timedelta(minutes=i % 50), i))
    rows.append((None, None, None, None))
    df = spark.createDataFrame(rows, "source string, local timestamp_ntz, ingested timestamp, n long")
    zones = ["UTC", "America/New_York", "America/Chicago", "Asia/Tokyo", "Europe/Berlin"]
    got = {r.source: (r.zone, r.violations) for r in estimate_zones(df, source=F.col("source"), local=F.col("local"), candidates=zones, ingested=F.col("ingested")).collect()}
    assert got == {"a": ("America/New_York", 0), "b": ("Asia/Tokyo", 0)}
    minutes = [T0.replace(month=11, day=3, hour=4) + timedelta(minutes=10 * i) for i in range(40)]  # over the end of daylight saving
    rows = [("n", t.astimezone(ZoneInfo("America/New_York")).replace(tzinfo=None), None, i) for i, t in enumerate(minutes) if not 6 <= t.hour < 7]
    df = spark.createDataFrame(rows, "source string, local timestamp_ntz, ingested timestamp, n long")
    got = estimate_zones(df, source=F.col("source"), local=F.col("local"), candidates=["America/New_York", "UTC"], sequence=F.col("n")).first()
    assert got.zone == "America/New_York"


# 5. nearest time
def nearest(spark, left, right, tolerance=3600, **kw):
    l = spark.createDataFrame(left, "id long, k string, t timestamp, gap_us int")
    r = spark.createDataFrame(right, "id long, k string, t timestamp, left_id int")
    out = nearest_time_join(l, r, left_id=F.col("id"), left_entity=key_upper("k"), left_time=F.col("t"), right_id=F.col("id"), right_entity=key_upper("k"), right_time=F.col("t"), tolerance_us=tolerance * 1_000_000, **kw)
    return sorted((x.left_id, x.right_id) for x in out.collect())


def brute_nearest(left, right, tolerance):
    out = []
    for i, k, t, _ in left:
        best = min(((abs((t - u).total_seconds()), u, j) for j, q, u, _ in right if u and q and k and t and q.strip().upper() == k.strip().upper() and abs((t - u).total_seconds()) <= tolerance), default=None)
        if best:
            out.append((i, best[2]))
    return sorted(out)


@pytest.mark.parametrize("cell_rows", [500_000, 5])
def test_nearest_against_brute_force(spark, cell_rows):
    rng = random.Random(3)
    at = lambda: T0 + timedelta(minutes=rng.randrange(0, 3000, 5))
    left = [(i, rng.choice(["a", " A ", "b", "hot", "hot", None, ""]), rng.choice([at(), at(), None]), 0) for i in range(200)] + [(900, "hot", T0, 0), (901, "hot", T0, 0)]
    right = [(i, rng.choice(["A", "b\t", "HOT", None]), rng.choice([at(), at(), at(), None]), 0) for i in range(150)]
    right += [(1000 + i, *r[1:]) for i, r in enumerate(right[:20])]
    assert nearest(spark, left, right, 3600, cell_rows=cell_rows) == brute_nearest([x for x in left if (x[1] or "").strip()], right, 3600)


def test_nearest_of_empty_tables(spark):
    assert nearest(spark, [], [(1, "a", T0, 0)]) == [] and nearest(spark, [(1, "a", T0, 0)], []) == []
    assert nearest(spark, [(1, "a", T0, 0)], [(1, "a", T0, 0)], 0) == [(1, 1)]


# 6. trailing totals
def test_trailing_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for k in ("A", "b", "C"):
        for _ in range(60):
            rows.append((k, date(2024, 1, 1) + timedelta(rng.randrange(400)), rng.choice([float(rng.randrange(100)), None, float("nan")]), rng.choice([rng.random(), None, float("inf")]), rng.randrange(3)))
    rows += rows[:10] + [(None, date(2024, 1, 1), 1.0, 1.0, 1), ("A", None, 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "k string, d date, v double, c double, day int")
    got = {(r.entity, r.day): r for r in trailing_totals(df, entity=F.col("k"), day=F.col("d"), volume=F.col("v"), close=F.col("c"), latest_by=F.col("day"), tile=50).collect()}
    fin = lambda x: x if x is not None and x == x and abs(x) != float("inf") else None
    low = lambda x: (x is not None, x or 0.0)
    n = 0
    for k in ("A", "b", "C"):
        best = {}
        for q, d, v, c, at in rows:
            if q == k and d:
                best[d] = max(best.get(d, (-1,)), (at, low(fin(v)), low(fin(c))))
        first, last = min(best), max(best)
        for i in range((last - first).days + 1):
            d = first + timedelta(i)
            n += 1
            r = got[k, d]
            for w in (7, 30):
                own = [best[x] for x in (d - timedelta(j) for j in range(w)) if x in best]
                closes = [b[2][1] for b in own if b[2][0]]
                assert r[f"volume_{w}"] == pytest.approx(sum(b[1][1] for b in own))
                assert r[f"avg_volume_{w}"] == pytest.approx(r[f"volume_{w}"] / min(w, i + 1))
                assert r[f"avg_close_{w}"] == (pytest.approx(sum(closes) / len(closes)) if closes else None)
            assert r.age == i + 1
    assert len(got) == n
    assert trailing_totals(df.limit(0), entity=F.col("k"), day=F.col("d"), volume=F.col("v"), close=F.col("c")).count() == 0
