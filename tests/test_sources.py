"""Sources: what reaches the scan, files that can't be read, specifications, and joins that must be one to one."""

from datetime import date, datetime

import pytest

from factorloom.operators import asof, evaluation
from factorloom.sources.panels import build_source, members, parquet_panel, read_tables, table_report

NS = 86_400_000_000_000


@pytest.fixture
def folder(spark, tmp_path):
    """Two daily files and one that is no parquet at all."""
    for d in (date(2024, 1, 2), date(2024, 1, 3)):
        at = (d - date(1970, 1, 1)).days * NS + 5 * 3_600_000_000_000
        spark.createDataFrame([("A", at, 1.0, -2.0), (" B ", at, float("nan"), 5.0)], "ticker string, window_start long, close double, volume double").coalesce(1).write.parquet(f"{tmp_path}/w/{d}")
        (next((tmp_path / "w" / str(d)).glob("*.parquet"))).rename(tmp_path / f"{d}.parquet")
    return tmp_path


def bars(spark, folder, **options):
    spec = {"type": "parquet_kline", "path": [str(folder / f) for f in ("2024-01-02.parquet", "2024-01-03.parquet")], "fields": {"close": "close"}, **options}
    return build_source(spark, spec)


def test_bounds_and_columns_reach_the_scan(spark, folder):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = bars(spark, folder, start="2024-01-03", end="2024-01-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(window_start" in plan and "LessThan(window_start" in plan and "volume" not in plan
    assert sorted((r.instrument, r.timestamp, r.close) for r in df.collect()) == [("A", datetime(2024, 1, 3), 1.0), ("B", datetime(2024, 1, 3), None)]
    assert bars(spark, folder, start="2024-01-03T01:00:00").count() == 0  # the day begins before that
    assert bars(spark, folder, end="2024-01-02T23:00:00", instruments=["B"]).count() == 1


def test_numeric_units_and_plain_times(spark, tmp_path):
    rows = [("A", 1_704_067_200_000 + k * 1000, datetime(2024, 1, 1, 0, 0, k), float(k)) for k in range(10)]
    spark.createDataFrame(rows, "ticker string, t long, align_time timestamp, v double").write.parquet(f"{tmp_path}/x")
    between = {"start": "2024-01-01T00:00:03", "end": "2024-01-01T00:00:05"}
    for how in ({"timestamp": "t", "unit": "ms"}, {"timestamp": "align_time"}):
        assert sorted(r.v for r in parquet_panel(spark, f"{tmp_path}/x", {"v": "v"}, **how, **between).collect()) == [3.0, 4.0, 5.0]


def test_unreadable_files_are_named(spark, folder):
    (folder / "2024-01-04.parquet").write_bytes(b"no parquet")
    (folder / "2024-01-05.parquet").write_bytes((folder / "2024-01-02.parquet").read_bytes())
    for d in folder.glob("w/*"):
        for f in d.iterdir():
            f.unlink()
    report = {r.file: r for r in table_report(spark, str(folder), not_negative=["volume"]).collect()}
    assert {f: r.problem for f, r in report.items()} == {"2024-01-02.parquet": None, "2024-01-03.parquet": None, "2024-01-04.parquet": "nothing read", "2024-01-05.parquet": None}
    assert report["2024-01-02.parquet"].rows == 2 and report["2024-01-02.parquet"].nulls == 1 and report["2024-01-02.parquet"].negatives == 1
    both = [str(folder / f) for f in ("2024-01-02.parquet", "2024-01-04.parquet")]
    with pytest.raises(Exception, match="(?i)parquet"):
        parquet_panel(spark, both, {"close": "close"}, timestamp="window_start", unit="ns").count()


def test_days_of_files(spark, tmp_path):
    for name, day in (("2024-01-02", "2024-01-02"), ("2024-01-03", "2024-01-09")):
        spark.createDataFrame([(day, 1.0)], "day string, v double").coalesce(1).write.parquet(f"{tmp_path}/{name}")
        next((tmp_path / name).glob("*.parquet")).rename(tmp_path / name / f"{name}.parquet")
    assert {r.file: r.problem for r in table_report(spark, str(tmp_path), day_column="day").collect()} == {"2024-01-02.parquet": None, "2024-01-03.parquet": "other days"}


def test_specifications(spark, folder):
    one = {"type": "parquet_kline", "path": str(folder / "2024-01-02.parquet"), "fields": {"close": "close"}}
    whole = build_source(spark, {"type": "composite", "anchor": "a", "sources": {"a": one, "b": one}, "aliases": {"other": "last", "last": "b_close"}})
    assert {"close", "b_close", "other", "last"} <= set(whole.columns) and whole.filter("close = other").count() == 1
    for bad in ({"type": "ftp"}, {**one, "color": 1}, {"type": "parquet", "path": "x"}, {"type": "composite", "anchor": "z", "sources": {"a": one}}, {"type": "composite", "anchor": "a", "sources": {"a": one}, "aliases": {"x": "y", "y": "x"}}):
        with pytest.raises(ValueError):
            build_source(spark, bad)


def test_tables_of_csv_and_parquet(spark, tmp_path):
    spark.createDataFrame([("a", 1.5, 0)], "k string, v double, extra int").write.parquet(f"{tmp_path}/p")
    (tmp_path / "q.csv").write_text("v,k,more\n2.5,b,x\nnone,c,y\n")
    assert sorted((r.k, r.v) for r in read_tables(spark, str(tmp_path), ["k", "v"]).collect() if r.v is not None) == [("a", 1.5), ("b", 2.5)]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        read_tables(spark, str(tmp_path / "none"), ["k"])


def test_members(spark):
    df = spark.createDataFrame([(1, " A ", "Yes"), (1, "B", "no"), (1, "C", None), (1, None, "yes")], "timestamp int, instrument string, flag string")
    assert [r.instrument for r in members(df, "flag").collect()] == ["A"]
    assert sorted(r.instrument for r in members(df, "flag", ["no", "Yes"]).collect()) == ["A", "B"]
    assert members(df).count() == 3


def test_one_to_one_and_common_dates(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "timestamp int, a string")
    b = spark.createDataFrame([(1, "p"), (3, "q"), (None, "r")], "timestamp int, b string")
    assert asof.one_to_one(a, b, ["timestamp"]).count() == 1
    with pytest.raises(ValueError):
        asof.one_to_one(a, b.union(b), ["timestamp"])
    assert [df.count() for df in asof.on_common_dates(a, b, a)] == [1, 1, 1]


def test_thresholds(spark):
    df = spark.createDataFrame([("r", 0.1, 0.6), ("s", None, 0.4)], "run string, ic double, win double")
    got = {r.run: (r.passed, r.failures) for r in evaluation.below_thresholds(df, {"ic": 0.0, "win": 0.5}, ["run"]).collect()}
    assert got == {"r": (True, ""), "s": (False, "ic missing; win below 0.5")}
