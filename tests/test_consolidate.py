from datetime import datetime, timedelta, timezone

from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import barloom.plans.consolidate as jobs
import barloom.sources.publish as publish
from barloom import consolidate, consolidate_history, summary
from barloom.session import scratch_root
from barloom.sources.tables import read_bars

COLUMNS = ["symbol", "timestamp", "unix_time", "open", "high", "low", "close", "volume"]


def day_frame(symbol, day, n=4, copies=1, price=1.0, step=60):
    start = datetime.fromisoformat(day).replace(tzinfo=timezone.utc)
    stamps = [start + timedelta(seconds=step * i) for i in range(n) for _ in range(copies)]
    frame = pd.DataFrame({"symbol": symbol, "timestamp": pd.to_datetime(stamps, utc=True)})
    frame["unix_time"] = [int(s.timestamp()) for s in stamps]
    for i, name in enumerate(COLUMNS[3:]):
        frame[name] = price + i
    return frame


def put_day(daily, symbol, day, frame=None, unit="us"):
    """Write one day file the way a pandas writer would, with the symbol in the file."""
    frame = day_frame(symbol, day) if frame is None else frame
    folder = daily / f"symbol={symbol}" / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    table = pa.Table.from_pandas(frame, preserve_index=False)
    at = table.schema.get_field_index("timestamp")
    if at >= 0:
        table = table.set_column(at, "timestamp", table.column(at).cast(pa.timestamp(unit, "UTC")))
    pq.write_table(table, folder / f"{symbol}_{day}.parquet")
    return frame


@pytest.fixture
def daily(tmp_path):
    folder = tmp_path / "daily"
    folder.mkdir()
    return folder


@pytest.fixture
def yearly(tmp_path):
    return str(tmp_path / "yearly")


def held(spark, yearly):
    """Sorted rows of the yearly table."""
    df = read_bars(spark, yearly)
    if df is None:
        return []
    return sorted(tuple(r) for r in df.select("symbol", "year", "unix_time", "open", "volume").collect())


def days_held(spark, yearly, symbol):
    df = read_bars(spark, yearly).where(f"symbol = '{symbol}'").selectExpr("cast(to_date(timestamp) as string) d")
    return sorted(r.d for r in df.distinct().collect())


def by_group(result):
    return {(r.symbol, r.year): r for r in result.collect()}


def test_new_years_of_all_symbols(spark, daily, yearly):
    scratch = Path(scratch_root(spark))
    frames = [
        put_day(daily, "AAA", "2024-12-31"),
        put_day(daily, "AAA", "2025-01-01"),
        put_day(daily, "AAA", "2025-01-02", day_frame("AAA", "2025-01-02", copies=3)),
        put_day(daily, "007", "2025-01-02"),
    ]
    result = consolidate(spark, str(daily), yearly)
    expected = pd.concat(frames).drop_duplicates()
    staged = list(scratch.glob("staged-*/**/*.parquet"))
    assert staged and all(pq.ParquetFile(path).metadata.num_rows == 0 for path in staged), "scratch is freed"
    got = read_bars(spark, yearly)
    assert got.count() == len(expected) == 16
    assert set(r.symbol for r in got.select("symbol").distinct().collect()) == {"AAA", "007"}
    groups = by_group(result)
    assert tuple(groups["AAA", 2025])[2:] == (2, 16, 8, "merged")
    assert tuple(groups["AAA", 2024])[2:] == (1, 4, 4, "merged")
    assert tuple(groups["007", 2025])[2:] == (1, 4, 4, "merged")
    assert {r.status: r.n for r in summary(result).collect()} == {"merged": 3}


def test_bars_sharing_a_minute_are_kept_unless_equal_in_all_columns(spark, daily, yearly):
    frame = day_frame("AAA", "2025-01-02", n=1, copies=60)
    frame["close"] = [float(i // 2) for i in range(60)]
    put_day(daily, "AAA", "2025-01-02", frame)
    consolidate(spark, str(daily), yearly)
    assert sorted(r.close for r in read_bars(spark, yearly).collect()) == list(range(30))


def test_second_run_changes_nothing(spark, daily, yearly):
    put_day(daily, "AAA", "2025-01-02")
    consolidate(spark, str(daily), yearly)
    before = held(spark, yearly)
    result = by_group(consolidate(spark, str(daily), yearly))
    assert tuple(result["AAA", 2025])[2:] == (0, 0, 4, "up_to_date")
    assert held(spark, yearly) == before


@pytest.mark.parametrize("mode, days", [("hwm", ["05", "06", "08"]), ("missing_days", ["01", "05", "06", "07", "08"])])
def test_late_days(spark, daily, yearly, mode, days):
    put_day(daily, "BBB", "2025-01-05")
    for day in ("05", "06"):
        put_day(daily, "AAA", f"2025-01-{day}")
    consolidate(spark, str(daily), yearly)
    put_day(daily, "AAA", "2025-01-01")
    put_day(daily, "AAA", "2025-01-08")
    put_day(daily, "AAA", "2025-01-07") if mode == "missing_days" else None
    consolidate(spark, str(daily), yearly, mode=mode)
    assert days_held(spark, yearly, "AAA") == [f"2025-01-{d}" for d in days]


def test_a_changed_day_at_the_mark_is_not_merged(spark, daily, yearly):
    put_day(daily, "AAA", "2025-01-05")
    consolidate(spark, str(daily), yearly)
    put_day(daily, "AAA", "2025-01-05", day_frame("AAA", "2025-01-05", n=9))
    for mode in ("hwm", "missing_days"):
        consolidate(spark, str(daily), yearly, mode=mode)
        assert len(held(spark, yearly)) == 4


def test_only_years_with_new_days_are_written(spark, daily, yearly, tmp_path):
    put_day(daily, "AAA", "2024-05-05")
    put_day(daily, "AAA", "2025-05-05")
    put_day(daily, "BBB", "2025-05-05")
    consolidate(spark, str(daily), yearly)
    files = lambda key: sorted(p.name for p in (tmp_path / "yearly").glob(f"{key}/*.parquet"))
    before = {k: files(k) for k in ("symbol=AAA/year=2024", "symbol=BBB/year=2025", "symbol=AAA/year=2025")}
    put_day(daily, "AAA", "2025-05-06")
    consolidate(spark, str(daily), yearly)
    after = {k: files(k) for k in before}
    assert after["symbol=AAA/year=2024"] == before["symbol=AAA/year=2024"]
    assert after["symbol=BBB/year=2025"] == before["symbol=BBB/year=2025"]
    assert after["symbol=AAA/year=2025"] != before["symbol=AAA/year=2025"]
    assert len(held(spark, yearly)) == 16


def test_year_bounds_and_symbols(spark, daily, yearly):
    for symbol in ("AAA", "BBB"):
        for day in ("2023-05-05", "2024-05-05", "2025-05-05"):
            put_day(daily, symbol, day)
    result = consolidate_history(spark, str(daily), yearly, limit=2024, symbols="AAA, ZZZ")
    assert set(by_group(result)) == {("AAA", 2023), ("AAA", 2024)}
    consolidate(spark, str(daily), yearly, years=(2025, 2025))
    assert {row[:2] for row in held(spark, yearly)} == {
        ("AAA", "2023"), ("AAA", "2024"), ("AAA", "2025"), ("BBB", "2025"),
    }


@pytest.mark.parametrize("max_copies", [jobs.MAX_COPIES, 1])
def test_rows_stamped_on_another_day_than_their_directory(spark, daily, yearly, monkeypatch, max_copies):
    """A day file may hold a row of the day before; equal rows still end up once."""
    monkeypatch.setattr(jobs, "MAX_COPIES", max_copies)
    first = put_day(daily, "AAA", "2025-01-05")
    consolidate(spark, str(daily), yearly)
    spill = pd.concat([first.tail(1), day_frame("AAA", "2025-01-06")])
    put_day(daily, "AAA", "2025-01-06", spill)
    result = by_group(consolidate(spark, str(daily), yearly))
    assert tuple(result["AAA", 2025])[2:] == (1, 5, 8, "merged")
    assert len(held(spark, yearly)) == len(set(held(spark, yearly))) == 8


def test_files_are_in_time_order_and_do_not_overlap(spark, daily, yearly, tmp_path):
    for i in range(1, 5):
        day = f"2025-01-0{i}"
        frame = day_frame("HOT", day, n=1440).sample(frac=1, random_state=i)
        frame["close"] = [float(c) for c in range(1440)]
        put_day(daily, "HOT", day, frame)
    put_day(daily, "AAA", "2025-01-01")
    consolidate(spark, str(daily), yearly, target_rows=1_000)
    files = sorted((tmp_path / "yearly" / "symbol=HOT" / "year=2025").glob("*.parquet"))
    assert len(files) > 1, "a large group is split"
    spans = []
    for path in files:
        stamps = pq.ParquetFile(path).read(columns=["unix_time"]).column(0).to_pylist()
        assert stamps == sorted(stamps)
        spans.append((stamps[0], stamps[-1]))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert len(held(spark, yearly)) == 4 * 1440 + 4


@pytest.mark.parametrize("max_copies", [jobs.MAX_COPIES, 100])
def test_one_minute_with_most_rows_is_split(spark, daily, yearly, tmp_path, monkeypatch, max_copies):
    """Copies are dropped within their range or, when a day is too large for that, before."""
    monkeypatch.setattr(jobs, "MAX_COPIES", max_copies)
    frame = day_frame("HOT", "2025-01-01", n=1, copies=20_000)
    frame["close"] = [float(i % 19_000) for i in range(20_000)]
    put_day(daily, "HOT", "2025-01-01", frame)
    consolidate(spark, str(daily), yearly, target_rows=1_000)
    assert len(list((tmp_path / "yearly").glob("*/*/*.parquet"))) > 1
    closes = [r.close for r in read_bars(spark, yearly).select("close").collect()]
    assert sorted(closes) == [float(i) for i in range(19_000)]


def test_zero_row_day_malformed_day_and_empty_directory(spark, daily, yearly):
    put_day(daily, "AAA", "2025-01-02")
    put_day(daily, "AAA", "2025-01-03", day_frame("AAA", "2025-01-03").head(0))
    put_day(daily, "AAA", "2025-13-99", day_frame("AAA", "2025-01-04"))
    (daily / "symbol=AAA" / "date=2025-01-09").mkdir()
    for merge_schema in (True, False):  # the file without rows has columns without a type
        path = f"{yearly}-{merge_schema}"
        result = by_group(consolidate(spark, str(daily), path, merge_schema=merge_schema))
        assert tuple(result["AAA", 2025])[2:] == (2, 4, 4, "merged")
        assert days_held(spark, path, "AAA") == ["2025-01-02"]


def test_only_a_zero_row_day(spark, daily, yearly):
    put_day(daily, "AAA", "2025-01-03", day_frame("AAA", "2025-01-03").head(0))
    result = by_group(consolidate(spark, str(daily), yearly))
    assert tuple(result["AAA", 2025])[2:] == (1, 0, 0, "merged")
    assert held(spark, yearly) == []


def test_no_daily_table(spark, yearly, tmp_path):
    assert consolidate(spark, str(tmp_path / "nothing"), yearly).count() == 0


def test_missing_price_column_fails_and_leaves_the_years(spark, daily, yearly):
    put_day(daily, "AAA", "2025-01-02")
    consolidate(spark, str(daily), yearly)
    before = held(spark, yearly)
    for path in daily.glob("*/*/*.parquet"):
        pq.write_table(pq.ParquetFile(path).read().drop(["volume"]), path)
    put_day(daily, "AAA", "2025-01-03", day_frame("AAA", "2025-01-03").drop(columns="volume"))
    with pytest.raises(Exception, match="volume"):
        consolidate(spark, str(daily), yearly)
    assert held(spark, yearly) == before


def test_a_file_without_a_price_column_others_have(spark, daily, yearly):
    put_day(daily, "AAA", "2025-01-02")
    put_day(daily, "AAA", "2025-01-03", day_frame("AAA", "2025-01-03").drop(columns="volume"))
    put_day(daily, "AAA", "2024-01-03")
    put_day(daily, "BBB", "2025-01-02", day_frame("BBB", "2025-01-02").assign(volume=[1.0, None, None, 2.0]))
    with pytest.raises(Exception, match="no column volume"):
        consolidate(spark, str(daily), yearly)
    assert held(spark, yearly) == []
    result = by_group(consolidate(spark, str(daily), yearly, on_bad="skip"))
    assert tuple(result["AAA", 2025])[2:] == (0, 0, 0, "error", "no column volume")
    assert tuple(result["AAA", 2024])[2:] == (1, 4, 4, "merged", None)
    assert tuple(result["BBB", 2025])[2:] == (1, 4, 4, "merged", None)
    assert {r.status: r.n for r in summary(consolidate(spark, str(daily), yearly, on_bad="skip")).collect()} == {
        "error": 1, "up_to_date": 2,
    }
    assert len(read_bars(spark, yearly).where("symbol = 'BBB' and volume is null").collect()) == 2


def test_symbols_outside_the_catalog_stay_out(spark, daily, yearly, catalog):
    for symbol in ("AAA", "ZZZ"):
        put_day(daily, symbol, "2025-01-02")
    assert set(by_group(consolidate(spark, str(daily), yearly, catalog=catalog))) == {("AAA", 2025)}
    assert {row[0] for row in held(spark, yearly)} == {"AAA"}


def test_extra_columns_pass_through(spark, daily, yearly):
    put_day(daily, "AAA", "2025-01-02", day_frame("AAA", "2025-01-02").assign(note="x"))
    consolidate(spark, str(daily), yearly)
    assert {r.note for r in read_bars(spark, yearly).collect()} == {"x"}


def test_nanosecond_files(spark, daily, yearly):
    put_day(daily, "AAA", "2025-01-02", unit="ns")
    consolidate(spark, str(daily), yearly)
    df = read_bars(spark, yearly)
    assert df.schema["timestamp"].dataType.simpleString() == "timestamp"
    assert df.where("unix_seconds(timestamp) <> unix_time").count() == 0


def test_bad_mode(spark, daily, yearly):
    with pytest.raises(ValueError, match="mode"):
        consolidate(spark, str(daily), yearly, mode="all")


def test_extending_adds_files_and_gives_the_same_rows(spark, daily, yearly, tmp_path):
    other = str(tmp_path / "other")
    for symbol in ("AAA", "BBB"):
        put_day(daily, symbol, "2025-01-05")
    for path in (yearly, other):
        consolidate(spark, str(daily), path)
    names = lambda: {p for p in (tmp_path / "yearly").glob("symbol=*/*/*.parquet")}
    before = names()
    put_day(daily, "AAA", "2025-01-01")
    put_day(daily, "AAA", "2025-01-06", day_frame("AAA", "2025-01-06", copies=2))
    put_day(daily, "AAA", "2026-01-06")
    extended = by_group(consolidate(spark, str(daily), yearly, extend=True))
    rewritten = by_group(consolidate(spark, str(daily), other))
    assert before < names()
    assert extended == rewritten
    assert held(spark, yearly) == held(spark, other)
    put_day(daily, "AAA", "2025-01-07")
    consolidate(spark, str(daily), yearly)
    assert not {p for p in before if "symbol=AAA/year=2025" in str(p)} & names(), "a rewrite joins the files"
    assert len(held(spark, yearly)) == len(set(held(spark, yearly))) == 20


def test_extending_with_stray_rows_rewrites(spark, daily, yearly):
    first = put_day(daily, "AAA", "2025-01-05")
    consolidate(spark, str(daily), yearly)
    put_day(daily, "AAA", "2025-01-06", pd.concat([first.tail(1), day_frame("AAA", "2025-01-06")]))
    consolidate(spark, str(daily), yearly, extend=True)
    assert len(held(spark, yearly)) == len(set(held(spark, yearly))) == 8


class CutOff(Exception):
    pass


@pytest.mark.parametrize("extend", [False, True])
@pytest.mark.parametrize("damage", ["before", "within"])
def test_a_run_cut_off_while_publishing_is_finished_by_the_next(
    spark, daily, yearly, tmp_path, monkeypatch, extend, damage
):
    for symbol in ("AAA", "BBB"):
        put_day(daily, symbol, "2025-01-05")
        put_day(daily, symbol, "2025-01-06")
    consolidate(spark, str(daily), yearly)
    for symbol in ("AAA", "BBB"):
        for path in daily.glob(f"symbol={symbol}/date=2025-01-05/*.parquet"):
            path.write_bytes(b"old days are not needed any more")
        put_day(daily, symbol, "2025-01-07")
        put_day(daily, symbol, "2025-01-08")
    put = publish._put

    def cut_off(staged, path, extends):
        """Die before anything is in place, or when one symbol is done and the other one removed."""
        if damage == "within":
            put(staged.where("symbol = 'AAA'"), path, extends)
            if not extends:
                for file in (tmp_path / "yearly" / "symbol=BBB").glob("*/*.parquet"):
                    file.rename(file.with_suffix(".gone"))
        raise CutOff

    monkeypatch.setattr(publish, "_put", cut_off)
    with pytest.raises(CutOff):
        consolidate(spark, str(daily), yearly, extend=extend, merge_schema=False)
    monkeypatch.setattr(publish, "_put", put)
    result = by_group(consolidate(spark, str(daily), yearly, extend=extend, merge_schema=False))
    assert {r.status for r in result.values()} == {"up_to_date"}
    assert {r.n_rows_out for r in result.values()} == {16}
    assert len(held(spark, yearly)) == len(set(held(spark, yearly))) == 32
    assert publish.unfinished(spark, yearly) is None


def test_a_check_that_fails_replaces_nothing(spark, daily, yearly, monkeypatch):
    put_day(daily, "AAA", "2025-01-05")
    consolidate(spark, str(daily), yearly)
    before = held(spark, yearly)
    put_day(daily, "AAA", "2025-01-06")
    stage = jobs._stage
    monkeypatch.setattr(jobs, "_stage", lambda bars, *rest: stage(bars.limit(3), *rest))
    with pytest.raises(RuntimeError, match="nothing was replaced"):
        consolidate(spark, str(daily), yearly)
    assert held(spark, yearly) == before


def spoil(daily, symbol, day, content=b"no parquet at all"):
    (path,) = daily.glob(f"symbol={symbol}/date={day}/*.parquet")
    path.write_bytes(content)


def test_files_that_cannot_be_read_stop_their_year_alone(spark, daily, yearly):
    for symbol in ("AAA", "BBB", "CCC"):
        for day in ("2024-01-02", "2025-01-02", "2025-01-03", "2025-01-04"):
            put_day(daily, symbol, day)
    put_day(daily, "BBB", "2025-01-05", day_frame("BBB", "2025-01-05").head(0))  # no rows, but sound
    spoil(daily, "AAA", "2025-01-03")
    spoil(daily, "AAA", "2025-01-04", b"")
    with pytest.raises(Exception):
        consolidate(spark, str(daily), yearly)
    assert held(spark, yearly) == []
    result = by_group(consolidate(spark, str(daily), yearly, on_bad="skip"))
    assert tuple(result["AAA", 2025])[2:] == (0, 0, 0, "error", "a file cannot be read")
    assert tuple(result["AAA", 2024])[2:] == (1, 4, 4, "merged", None)
    assert tuple(result["BBB", 2025])[2:] == (4, 12, 12, "merged", None)
    assert tuple(result["CCC", 2025])[2:] == (3, 12, 12, "merged", None)


def test_pages_that_cannot_be_read(spark, daily, yearly):
    """The footer is sound, what it points to is not."""
    for symbol in ("AAA", "BBB"):
        put_day(daily, symbol, "2025-01-02")
    (path,) = daily.glob("symbol=AAA/date=2025-01-02/*.parquet")
    raw = bytearray(path.read_bytes())
    raw[4 : len(raw) // 3] = b"\xff" * (len(raw) // 3 - 4)
    path.write_bytes(bytes(raw))
    result = by_group(consolidate(spark, str(daily), yearly, on_bad="skip"))
    assert tuple(result["AAA", 2025])[2:] == (0, 0, 0, "error", "a file cannot be read")
    assert tuple(result["BBB", 2025])[2:] == (1, 4, 4, "merged", None)


def test_a_year_file_that_cannot_be_read(spark, daily, yearly, tmp_path):
    for symbol in ("AAA", "BBB"):
        put_day(daily, symbol, "2025-01-02")
    consolidate(spark, str(daily), yearly)
    for path in (tmp_path / "yearly").glob("symbol=AAA/*/*.parquet"):
        path.write_bytes(b"cut off")
    for symbol in ("AAA", "BBB"):
        put_day(daily, symbol, "2025-01-03")
    result = by_group(consolidate(spark, str(daily), yearly, on_bad="skip"))
    assert tuple(result["AAA", 2025])[2:] == (0, 0, 0, "error", "a file cannot be read")
    assert tuple(result["BBB", 2025])[2:] == (1, 4, 8, "merged", None)


def test_types_that_differ_between_files(spark, daily, yearly):
    """Prices are cast, a nanosecond stamp is read; any other column must have one type."""
    for symbol in ("AAA", "BBB", "CCC", "DDD"):
        for day in ("2025-01-02", "2025-01-03", "2025-01-04"):
            put_day(daily, symbol, day, day_frame(symbol, day).assign(note="x"))
    put_day(daily, "AAA", "2025-01-05", day_frame("AAA", "2025-01-05").assign(note=1))
    put_day(daily, "BBB", "2025-01-05", day_frame("BBB", "2025-01-05").assign(note="x", volume=[1, 2, 3, 4]))
    put_day(daily, "CCC", "2025-01-05", day_frame("CCC", "2025-01-05").assign(note="x", volume=[1, 2, 3, 4]).drop(columns="open"))
    with pytest.raises(Exception, match="column types differ"):
        consolidate(spark, str(daily), yearly)
    result = by_group(consolidate(spark, str(daily), yearly, on_bad="skip"))
    assert tuple(result["AAA", 2025])[2:] == (0, 0, 0, "error", "another type of note")
    assert tuple(result["BBB", 2025])[2:] == (4, 16, 16, "merged", None)
    assert tuple(result["CCC", 2025])[2:] == (0, 0, 0, "error", "no column open")
    assert tuple(result["DDD", 2025])[2:] == (3, 12, 12, "merged", None)
    rows = read_bars(spark, yearly).where("symbol = 'BBB' and day(timestamp) = 5").collect()
    assert sorted(r.volume for r in rows) == [1.0, 2.0, 3.0, 4.0] and {r.note for r in rows} == {"x"}
