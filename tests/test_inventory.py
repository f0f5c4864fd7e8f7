"""The inventory of days against the directories and exported listings."""

import json
import shutil

import pytest

import barloom.sources.inventory as inventory
from barloom import consolidate, known_days, merge_listing, plan_head, read_bars, read_key_days, refresh_inventory
from barloom.sources import listings
from test_consolidate import day_frame, put_day


@pytest.fixture
def daily(tmp_path):
    folder = tmp_path / "daily"
    for day in ("2024-12-31", "2025-01-05", "2025-01-06"):
        for symbol in ("AAA", "BBB"):
            put_day(folder, symbol, day)
    return folder


def days(df):
    return sorted((r.symbol, str(r.date)) for r in df.collect())


def changes(df):
    return sorted((r.symbol, str(r.date), r.change) for r in df.collect())


def test_nights(spark, daily, tmp_path, monkeypatch):
    path = str(tmp_path / "inventory")
    assert len(changes(refresh_inventory(spark, path, str(daily)))) == 6
    assert days(known_days(spark, path)) == days(listings.day_listing(spark, str(daily)))
    put_day(daily, "AAA", "2025-01-07")
    put_day(daily, "AAA", "2024-12-30")  # another year: this night does not look there
    shutil.rmtree(daily / "symbol=BBB" / "date=2025-01-06")
    put_day(daily, "BBB", "2025-01-05", day_frame("BBB", "2025-01-05", n=3000))
    patterns = []
    listed = listings._list_files
    monkeypatch.setattr(listings, "_list_files", lambda s, pattern, *a, **k: patterns.append(pattern) or listed(s, pattern, *a, **k))
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "inventory").glob("year=*/*.parquet")}
    before = files()
    assert changes(refresh_inventory(spark, path, str(daily), (2025, 2025))) == [
        ("AAA", "2025-01-07", "added"), ("BBB", "2025-01-05", "changed"), ("BBB", "2025-01-06", "gone"),
    ]
    assert patterns and all("date={2025}-*" in p for p in patterns)
    after = files()
    assert {p for p in after if "2024" in str(p)} and all(after[p] == t for p, t in before.items() if "2024" in str(p))
    assert ("AAA", "2024-12-30") not in days(known_days(spark, path))
    assert days(known_days(spark, path, (2025, 2025))) == [("AAA", f"2025-01-0{d}") for d in (5, 6, 7)] + [("BBB", "2025-01-05")]
    assert changes(refresh_inventory(spark, path, str(daily), (2025, 2025))) == [] and files() == after
    assert changes(refresh_inventory(spark, path, str(daily))) == [("AAA", "2024-12-30", "added")]


def test_a_year_without_days_left(spark, daily, tmp_path):
    path = str(tmp_path / "inventory")
    refresh_inventory(spark, path, str(daily))
    for symbol in ("AAA", "BBB"):
        shutil.rmtree(daily / f"symbol={symbol}" / "date=2024-12-31")
    assert {c for *_, c in changes(refresh_inventory(spark, path, str(daily)))} == {"gone"}
    assert {d for _, d in days(known_days(spark, path))} == {"2025-01-05", "2025-01-06"}
    assert changes(refresh_inventory(spark, path, str(daily))) == []


def test_exported_keys(spark, catalog, tmp_path):
    keys = ["1s/symbol=AAA/date=2025-01-05/", "1s/symbol=AAA/date=2025-01-05/AAA_2025-01-05.parquet", "1s/symbol=AAA/date=2025-1-7/",
            "1s/symbol=AAA/date=2025-02-30/", "1s/symbol=AAA/date=soon/", "1s/symbol=A%2FB+C/date=2025-01-09/x.parquet", "date=2025-01-04/", "", None]
    (tmp_path / "keys.json").write_text("\n".join(json.dumps({"key": k, "size": 10} if k else {"other": 1}) for k in keys))
    found = read_key_days(spark, str(tmp_path / "keys.json"))
    assert sorted((r.symbol, str(r.date), r.day, r.folder, r.bytes, r.n_files) for r in found.collect()) == [
        ("A/B+C", "2025-01-09", "2025-01-09", "1s/symbol=A%2FB+C/date=2025-01-09", 10, 1),
        ("AAA", "2025-01-05", "2025-01-05", "1s/symbol=AAA/date=2025-01-05", 10, 1),
        ("AAA", "2025-01-07", "2025-1-7", "1s/symbol=AAA/date=2025-1-7", 0, 0),
    ]
    # keys relative to one symbol
    own = read_key_days(spark, str(tmp_path / "keys.json"), symbol="BBB")
    assert ("BBB", "2025-01-04") in days(own)
    path = str(tmp_path / "inventory")
    assert {r.change for r in merge_listing(spark, path, found).collect()} == {"added"}
    assert merge_listing(spark, path, own.where("symbol = 'BBB'")).count() == 1
    assert len(days(known_days(spark, path))) == 4
    planned = days(plan_head(catalog, known_days(spark, path), "2025-01-08"))
    assert [d for s, d in planned if s == "AAA"] == [f"2025-01-0{d}" for d in range(1, 5)]
    assert [d for s, d in planned if s == "BBB"] == ["2025-01-03"]
    assert len([d for s, d in planned if s == "007"]) == 7
    assert sorted(merge_listing(spark, path, found.where("symbol = 'AAA'"), whole=True).select("symbol").collect()) == [("A/B+C",), ("BBB",)]


def test_consolidating_by_an_inventory(spark, daily, tmp_path, monkeypatch):
    path, yearly = str(tmp_path / "inventory"), str(tmp_path / "yearly")
    refresh_inventory(spark, path, str(daily))
    put_day(daily, "AAA", "2025-01-09")  # not known yet
    monkeypatch.setattr(inventory, "day_listing", None)
    consolidate(spark, str(daily), yearly, inventory=path)
    assert read_bars(spark, yearly).count() == 24


def test_unpadded_directories_count(spark, daily, tmp_path):
    put_day(daily, "AAA", "2025-1-8", day_frame("AAA", "2025-01-08"))
    put_day(daily, "AAA", "2025-1-5", day_frame("AAA", "2025-01-05"))  # the same day under both names
    assert ("AAA", "2025-01-08") in days(listings.day_listing(spark, str(daily), (2025, 2025)))
    result = consolidate(spark, str(daily), str(tmp_path / "yearly"), years=(2025, 2025)).where("symbol = 'AAA'").first()
    assert (result.n_days, result.n_rows_in, result.n_rows_out) == (3, 16, 12)
