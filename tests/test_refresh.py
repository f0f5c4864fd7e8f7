import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from barloom import refresh_catalog
from barloom.plans.refresh import yearly_latest
from barloom.session import read_whole
from barloom.sources.instruments import read_instrument_rows, read_instruments, write_document, write_instrument_rows
from test_consolidate import day_frame

DOCUMENT = {
    "_data_boundaries_updated": "2025-01-01T00:00:00Z",
    "_note": {"kept": [1, 2.5, None]},
    "AAA": {"name": "A", "n": 1, "x": 1.50, "dataRange": {"earliest": "2011-01-01", "sources": {"1s": {"latest": "x"}}}},
    "BBB": {"name": "B", "z": None},
    "CCC": {"dataRange": {"latest": "2020-01-01", "sources": {"1Ys": {"latest": "2020-01-01", "rows": 7}}}},
    "DDD": {"name": "no data", "dataRange": {"latest": "2019-01-01"}},
}
STAMP = "2026-02-03T04:05:06Z"


def put_year(yearly, symbol, year, frame):
    folder = yearly / f"symbol={symbol}" / f"year={year}"
    folder.mkdir(parents=True)
    frame.to_parquet(folder / f"{symbol}_{year}.parquet", index=False)


@pytest.fixture
def yearly(tmp_path):
    folder = tmp_path / "yearly"
    put_year(folder, "AAA", 2024, day_frame("AAA", "2024-12-31"))
    put_year(folder, "AAA", 2025, day_frame("AAA", "2025-03-04"))
    put_year(folder, "BBB", 2023, day_frame("BBB", "2023-03-04"))
    put_year(folder, "CCC", 2024, day_frame("CCC", "2024-06-07"))
    put_year(folder, "ZZZ", 2024, day_frame("ZZZ", "2024-06-07"))
    return folder


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "instruments.json"
    path.write_text(json.dumps(DOCUMENT, indent=2))
    return str(path)


def written(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def expected_document():
    document = json.loads(json.dumps(DOCUMENT))
    document["_data_boundaries_updated"] = STAMP
    for symbol, latest in (("AAA", "2025-03-04"), ("BBB", "2023-03-04"), ("CCC", "2024-06-07")):
        data_range = document[symbol].setdefault("dataRange", {})
        data_range["latest"] = latest
        data_range.setdefault("sources", {}).setdefault("1Ys", {})["latest"] = latest
    return document


def test_document_and_bounds(spark, source, yearly, tmp_path):
    out = tmp_path / "out"
    bounds = refresh_catalog(spark, source, str(yearly), "2026-01-01", str(out), stamp=STAMP)
    assert json.loads(written(out / "instruments")) == expected_document()
    assert sorted(tuple(r) for r in bounds.collect()) == [
        ("AAA", date(2025, 3, 4), "data", datetime(2026, 2, 3, 4, 5, 6)),
        ("BBB", date(2023, 3, 4), "data", datetime(2026, 2, 3, 4, 5, 6)),
        ("CCC", date(2024, 6, 7), "data", datetime(2026, 2, 3, 4, 5, 6)),
    ]


def test_second_refresh_changes_nothing(spark, source, yearly, tmp_path):
    refresh_catalog(spark, source, str(yearly), "2026-01-01", str(tmp_path / "one"), stamp=STAMP)
    refresh_catalog(spark, str(tmp_path / "one" / "instruments"), str(yearly), "2026-01-01", str(tmp_path / "two"), stamp=STAMP)
    assert written(tmp_path / "one" / "instruments") == written(tmp_path / "two" / "instruments")


@pytest.mark.parametrize("as_rows", [False, True])
def test_refresh_in_place(spark, source, yearly, tmp_path, as_rows):
    out = str(tmp_path / "out")
    write = write_instrument_rows if as_rows else write_document
    write(read_instruments(spark, source), f"{out}/instruments")
    for _ in range(2):
        refresh_catalog(spark, f"{out}/instruments", str(yearly), "2026-01-01", out, stamp=STAMP, as_rows=as_rows)
    read = read_instrument_rows if as_rows else read_instruments
    documents = read(spark, f"{out}/instruments").select("symbol", F.to_json("document").alias("text"))
    assert {r.symbol: json.loads(r.text) for r in documents.collect()} == expected_document()


def test_rows_form_has_the_same_content(spark, source, yearly, tmp_path):
    rows = str(tmp_path / "rows")
    write_instrument_rows(read_instruments(spark, source), rows)
    refresh_catalog(spark, rows, str(yearly), "2026-01-01", str(tmp_path / "out"), stamp=STAMP, as_rows=True)
    lines = [json.loads(line) for line in written(tmp_path / "out" / "instruments").splitlines()]
    assert {line["symbol"]: line["document"] for line in lines} == expected_document()


def test_no_yearly_table_keeps_all_dates(spark, source, tmp_path):
    bounds = refresh_catalog(spark, source, str(tmp_path / "nothing"), "2026-01-01", str(tmp_path / "out"), stamp=STAMP)
    assert bounds.count() == 0
    document = json.loads(written(tmp_path / "out" / "instruments"))
    assert document == {**DOCUMENT, "_data_boundaries_updated": STAMP}


def test_newest_year_without_rows_keeps_the_date(spark, source, yearly, tmp_path):
    put_year(yearly, "CCC", 2025, day_frame("CCC", "2025-01-01").astype({"symbol": "string"}).head(0))
    latest = {r.symbol: r.latest for r in yearly_latest(spark, str(yearly), "2026-01-01").collect()}
    assert latest == {"AAA": "2025-03-04", "BBB": "2023-03-04", "CCC": None, "ZZZ": "2024-06-07"}
    out = tmp_path / "out"
    refresh_catalog(spark, source, str(yearly), "2026-01-01", str(out), stamp=STAMP)
    assert json.loads(written(out / "instruments"))["CCC"] == DOCUMENT["CCC"]


def test_no_date_column_assumes_the_day(spark, tmp_path):
    for symbol, year in (("AAA", 2024), ("BBB", 2026)):
        frame = day_frame(symbol, "2024-01-01")[["symbol", "open", "high"]]
        put_year(tmp_path / "yearly", symbol, year, frame)
    rows = yearly_latest(spark, str(tmp_path / "yearly"), "2026-01-15").collect()
    assert sorted((r.symbol, r.latest, r.latest_source) for r in rows) == [
        ("AAA", "2024-12-31", "fallback"), ("BBB", "2026-01-15", "fallback"),
    ]


def test_each_symbol_has_its_own_date_column(spark, yearly):
    put_year(yearly, "NONE", 2024, day_frame("NONE", "2024-01-01")[["symbol", "open", "high"]])
    other = day_frame("OTHER", "2024-05-06").drop(columns=["timestamp", "unix_time"]).assign(trade_date="2024-05-06")
    put_year(yearly, "OTHER", 2024, other)
    rows = yearly_latest(spark, str(yearly), "2026-01-15").collect()
    found = {r.symbol: (r.latest, r.latest_source) for r in rows}
    assert found["NONE"] == ("2024-12-31", "fallback")
    assert found["OTHER"] == ("2024-05-06", "data")
    assert found["AAA"] == ("2025-03-04", "data")


def test_stamp_is_utc_now_by_default(spark, source, yearly, tmp_path):
    refresh_catalog(spark, source, str(yearly), "2026-01-01", str(tmp_path / "out"))
    stamp = json.loads(written(tmp_path / "out" / "instruments"))["_data_boundaries_updated"]
    assert abs((datetime.now(timezone.utc) - datetime.strptime(stamp + "+0000", "%Y-%m-%dT%H:%M:%SZ%z")).total_seconds()) < 300


def test_document_size_is_checked(spark, source, tmp_path):
    with pytest.raises(ValueError, match="write_instrument_rows"):
        write_document(read_instruments(spark, source), str(tmp_path / "out"), max_bytes=10)
    with pytest.raises(ValueError, match="one task may read"):
        read_whole(spark, source, max_bytes=10)


def test_only_the_newest_years_files_are_read(spark, yearly):
    (yearly / "symbol=BBB" / "year=2023" / "BBB_2023.parquet").write_bytes(b"bytes that are no parquet file")
    put_year(yearly, "BBB", 2025, day_frame("BBB", "2025-05-06"))
    rows = yearly_latest(spark, str(yearly), "2026-01-01", merge_schema=False).collect()
    assert {r.symbol: r.latest for r in rows} == {
        "AAA": "2025-03-04", "BBB": "2025-05-06", "CCC": "2024-06-07", "ZZZ": "2024-06-07",
    }


def test_unreadable_newest_file(spark, yearly):
    (yearly / "symbol=BBB" / "year=2023" / "BBB_2023.parquet").write_bytes(b"bytes that are no parquet file")
    put_year(yearly, "CCC", 2025, day_frame("CCC", "2025-01-01").astype({"symbol": "string"}).head(0))
    with pytest.raises(Exception, match="BBB_2023"):
        yearly_latest(spark, str(yearly), "2026-01-01").collect()
    rows = yearly_latest(spark, str(yearly), "2026-01-01", unreadable="assume").collect()
    assert {r.symbol: (r.latest, r.latest_source) for r in rows} == {
        "AAA": ("2025-03-04", "data"),
        "BBB": ("2023-12-31", "fallback"),
        "CCC": (None, "data"),
        "ZZZ": ("2024-06-07", "data"),
    }


def test_only_unreadable_files(spark, tmp_path):
    put_year(tmp_path / "yearly", "AAA", 2024, day_frame("AAA", "2024-12-31"))
    (tmp_path / "yearly" / "symbol=AAA" / "year=2024" / "AAA_2024.parquet").write_bytes(b"bytes, but not Parquet")
    rows = yearly_latest(spark, str(tmp_path / "yearly"), "2026-01-01", unreadable="assume").collect()
    assert [(r.symbol, r.latest, r.latest_source) for r in rows] == [("AAA", "2024-12-31", "fallback")]
