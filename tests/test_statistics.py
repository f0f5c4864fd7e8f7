"""Statistics of years against the rows of their files."""

import shutil

import pytest

import barloom.plans.consolidate as jobs
from barloom import consolidate, read_bars, year_statistics
from barloom.sources import publish
from test_consolidate import day_frame, put_day

DAYS = ("2024-12-30", "2025-01-05", "2025-01-06")


@pytest.fixture
def daily(tmp_path):
    folder = tmp_path / "daily"
    for day in DAYS:
        for symbol in ("AAA", "BBB"):
            put_day(folder, symbol, day)
    return folder


@pytest.fixture
def yearly(tmp_path):
    return str(tmp_path / "yearly")


@pytest.fixture
def read(monkeypatch):
    """Symbols and years whose files are read."""
    seen, load = [], jobs._years

    def noted(spark, path, listing, merge_schema):
        seen.extend((r.symbol, r.year) for r in listing.collect())
        return load(spark, path, listing, merge_schema)

    monkeypatch.setattr(jobs, "_years", noted)
    return seen


def rows(df):
    return sorted((r.symbol, r.year, r.n_rows, str(r.last_day), [str(d) for d in r.days]) for r in df.collect())


def from_files(spark, yearly):
    found = {}
    for r in read_bars(spark, yearly).selectExpr("symbol", "int(year) y", "string(to_date(timestamp)) d").collect():
        found.setdefault((r.symbol, r.y), []).append(r.d)
    return sorted((*key, len(days), max(days), sorted(set(days))) for key, days in found.items())


@pytest.mark.parametrize("extend", [False, True])
@pytest.mark.parametrize("mode", ["hwm", "missing_days"])
def test_a_night_opens_no_year_to_decide(spark, daily, yearly, read, mode, extend):
    consolidate(spark, str(daily), yearly, mode)
    assert read == [] and rows(year_statistics(spark, yearly)) == from_files(spark, yearly)
    assert consolidate(spark, str(daily), yearly, mode).where("status <> 'up_to_date'").isEmpty() and read == []
    put_day(daily, "AAA", "2025-01-02")  # late
    put_day(daily, "AAA", "2025-01-07", day_frame("AAA", "2025-01-07", copies=3))
    consolidate(spark, str(daily), yearly, mode, extend=extend)
    assert set(read) == {("AAA", 2025)}, "the year with new days alone"
    read.clear()
    expected = from_files(spark, yearly)
    assert rows(year_statistics(spark, yearly)) == expected and read == []
    assert ("2025-01-02" in expected[1][4]) == (mode == "missing_days")


def test_files_of_others_are_read_again(spark, daily, yearly, read, tmp_path):
    consolidate(spark, str(daily), yearly)
    folder = tmp_path / "yearly" / "symbol=BBB" / "year=2025"
    spark.read.parquet(str(folder)).limit(2).write.mode("append").parquet(str(folder))
    assert rows(year_statistics(spark, yearly)) == from_files(spark, yearly) and set(read) == {("BBB", 2025)}
    read.clear()
    assert rows(year_statistics(spark, yearly)) == from_files(spark, yearly) and read == []
    shutil.rmtree(tmp_path / "yearly" / "symbol=AAA" / "year=2024")
    assert rows(year_statistics(spark, yearly)) == from_files(spark, yearly) and read == []
    consolidate(spark, str(daily), yearly)
    assert len(from_files(spark, yearly)) == 4
    shutil.rmtree(tmp_path / "yearly" / "_statistics")
    assert rows(year_statistics(spark, yearly, (2025, 2025))) == from_files(spark, yearly)[1::2]
    assert set(read) == {("AAA", 2025), ("BBB", 2025)}


def test_a_run_cut_off_before_its_statistics(spark, daily, yearly, read, monkeypatch):
    consolidate(spark, str(daily), yearly)
    put_day(daily, "AAA", "2025-01-07")
    monkeypatch.setattr(jobs, "_keep", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
    with pytest.raises(RuntimeError, match="cut off"):
        consolidate(spark, str(daily), yearly)
    monkeypatch.undo()
    assert rows(year_statistics(spark, yearly)) == from_files(spark, yearly)
    assert publish.unfinished(spark, yearly) is None


def test_years_without_rows_or_stamps_and_an_empty_table(spark, daily, yearly, tmp_path):
    assert rows(year_statistics(spark, yearly)) == []
    consolidate(spark, str(daily), yearly)
    like = spark.read.parquet(str(tmp_path / "yearly" / "symbol=AAA" / "year=2024"))
    like.limit(0).write.parquet(str(tmp_path / "yearly" / "symbol=CCC" / "year=2024"))
    bare = like.selectExpr("cast(null as timestamp) timestamp", *[c for c in like.columns if c != "timestamp"])
    bare.write.parquet(str(tmp_path / "yearly" / "symbol=DDD" / "year=2024"))
    found = {r[0]: r[2:] for r in rows(year_statistics(spark, yearly, (2024, 2024)))}
    assert found["CCC"] == (0, "None", []) and found["DDD"] == (4, "None", [])
