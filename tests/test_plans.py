"""Fetch plans, windows, listings and key parsing, against brute force in Python."""

import json
from datetime import date, timedelta
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom import plan_head, plan_ranges, plan_tail
from barloom.functions.bars import epoch_seconds
from barloom.functions.days import date_columns, iso_day, year_of_key
from barloom.operators.days import (
    available_years,
    day_counts,
    day_status,
    fetch_window,
    year_range,
)
from barloom.operators.merge import merge_bars
from barloom.operators.symbols import known_symbols, requested_symbols, unknown_symbols
from barloom.sources.catalog import read_catalog
from barloom.sources.listings import day_listing, read_key_listing, year_listing

END = date(2025, 1, 10)


def existing_days(spark, days):
    return spark.createDataFrame([(s, date.fromisoformat(d)) for s, d in days], "symbol string, date date")


def plan(df):
    return sorted((r.symbol, r.date.isoformat()) for r in df.collect())


def span(symbol, first, last):
    days = (date.fromisoformat(last) - date.fromisoformat(first)).days
    return [(symbol, (date.fromisoformat(first) + timedelta(days=i)).isoformat()) for i in range(days + 1)]


def test_tail_starts_after_the_newest_day_or_at_the_earliest_date(spark, catalog):
    existing = existing_days(spark, [("AAA", "2025-01-02"), ("AAA", "2025-01-08"), ("BBB", "2025-01-10")])
    got = plan(plan_tail(catalog, existing, END))
    assert got == sorted(span("AAA", "2025-01-09", "2025-01-10") + span("007", "2025-01-01", "2025-01-10"))


def test_tail_override_fills_gaps_and_keeps_to_the_earliest_date(spark, catalog):
    existing = existing_days(spark, [("AAA", "2025-01-02"), ("BBB", "2025-01-04")])
    got = plan(plan_tail(catalog, existing, "2025-01-05", "1990-01-01", symbols=" AAA ,BBB"))
    assert got == [
        ("AAA", "2025-01-01"), ("AAA", "2025-01-03"), ("AAA", "2025-01-04"), ("AAA", "2025-01-05"),
        ("BBB", "2025-01-03"), ("BBB", "2025-01-05"),
    ]


def test_tail_with_start_after_end_is_empty(spark, catalog):
    existing = existing_days(spark, [])
    assert plan(plan_tail(catalog, existing, "2024-12-31")) == []
    assert plan(plan_tail(catalog, existing, "2025-01-05", "2025-02-01")) == []


def test_tail_carries_the_vendor_id(spark, catalog):
    rows = plan_tail(catalog, existing_days(spark, []), "2025-01-01", symbols="007").collect()
    assert [tuple(r) for r in rows] == [("007", "seven", date(2025, 1, 1))]


def test_head_is_half_open_and_full_without_days(spark, catalog):
    existing = existing_days(spark, [("AAA", "2025-01-04"), ("AAA", "2025-01-09"), ("BBB", "2025-01-03")])
    got = plan(plan_head(catalog, existing, "2025-01-03"))
    assert got == sorted(span("AAA", "2025-01-01", "2025-01-03") + span("007", "2025-01-01", "2025-01-02"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    held=st.sets(st.tuples(st.sampled_from(["AAA", "BBB", "007"]), st.integers(0, 12)), max_size=12),
    override=st.one_of(st.none(), st.integers(-3, 12)),
    end=st.integers(-2, 12),
)
def test_plans_against_loops(spark, catalog, held, override, end):
    base = date(2025, 1, 1)
    day = lambda n: base + timedelta(days=n)
    first = {"AAA": 0, "BBB": 2, "007": 0}
    existing = spark.createDataFrame([(s, day(n)) for s, n in held], "symbol string, date date")
    tail, head = [], []
    for symbol, earliest in first.items():
        days = {n for s, n in held if s == symbol}
        start = override if override is not None else (max(days) + 1 if days else earliest)
        tail += [(symbol, day(n).isoformat()) for n in range(max(start, earliest), end + 1) if n not in days]
        head += [(symbol, day(n).isoformat()) for n in range(earliest, min(days) if days else end)]
    start_day = None if override is None else day(override)
    assert plan(plan_tail(catalog, existing, day(end), start_day)) == sorted(tail)
    assert plan(plan_head(catalog, existing, day(end))) == sorted(head)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    held=st.lists(st.tuples(st.sampled_from(["AAA", "BBB", "007", "ZZZ"]), st.integers(-2, 12)), max_size=20),
    end=st.integers(-2, 10),
)
def test_ranges_against_loops(spark, catalog, held, end):
    base = date(2025, 1, 1)
    existing = spark.createDataFrame([(s, base + timedelta(days=n)) for s, n in held], "symbol string, date date")
    expected = []
    for symbol, earliest in {"AAA": 0, "BBB": 2, "007": 0}.items():
        lacking = [n for n in range(earliest, end + 1) if (symbol, n) not in held]
        for n in lacking:
            if n - 1 not in lacking:
                last = next(m for m in range(n, end + 1) if m + 1 not in lacking)
                expected.append((symbol, base + timedelta(days=n), base + timedelta(days=last)))
    got = plan_ranges(catalog, existing, base + timedelta(days=end))
    assert sorted((r.symbol, r.first, r.last) for r in got.collect()) == sorted(expected)


def test_requests(spark, catalog):
    requested = requested_symbols(spark, "AAA, ZZZ ,007,AAA")
    assert sorted(r.symbol for r in requested.collect()) == ["007", "AAA", "ZZZ"]
    assert sorted(r.symbol for r in known_symbols(catalog, requested).collect()) == ["007", "AAA"]
    assert [r.symbol for r in unknown_symbols(requested, catalog).collect()] == ["ZZZ"]


def test_window_and_status(spark):
    marks = spark.createDataFrame(
        [("A", 2024, date(2024, 12, 30)), ("B", 2024, date(2024, 12, 31)), ("C", 2025, None)],
        "symbol string, year int, hwm date",
    )
    got = {r.symbol: (r.start, r.end, r.status) for r in fetch_window(marks, F.lit(date(2025, 2, 1))).collect()}
    assert got == {
        "A": (date(2024, 12, 31), date(2024, 12, 31), "behind"),
        "B": (date(2025, 1, 1), date(2024, 12, 31), "up_to_date"),
        "C": (date(2025, 1, 1), date(2025, 2, 1), "behind"),
    }
    days = existing_days(spark, [("A", "2025-01-01"), ("A", "2025-01-10"), ("B", "2025-01-02")])
    status = day_status(days, F.lit(date(2025, 1, 1)), F.lit(END))
    assert sorted(tuple(r) for r in status.collect()) == [
        ("A", "up_to_date", "full_history"), ("B", "behind", "backfill"),
    ]


def test_years(spark):
    rows = spark.createDataFrame(
        [("A", 2023, 1), ("A", 2023, 1), ("A", 2024, 2), ("B", 2025, 1)], "symbol string, year int, date int"
    )
    years = available_years(rows, 2024)
    assert sorted(tuple(r) for r in years.collect()) == [("A", 2023), ("A", 2024)]
    assert [tuple(r) for r in year_range(years).collect()] == [("A", 2023, 2024, 2)]
    assert sorted(tuple(r) for r in day_counts(rows).collect()) == [
        ("A", 2023, 1, 2), ("A", 2024, 1, 1), ("B", 2025, 1, 1),
    ]


def test_listings(spark, tmp_path):
    from test_consolidate import day_frame, put_day

    put_day(tmp_path, "007", "2025-01-02")
    put_day(tmp_path, "AAA", "2025-01-03", day_frame("AAA", "2025-01-03").head(0))
    put_day(tmp_path, "AAA", "2025-13-99", day_frame("AAA", "2025-01-04"))
    (tmp_path / "symbol=AAA" / "date=2025-01-09").mkdir()
    days = day_listing(spark, str(tmp_path))
    assert sorted((r.symbol, r.date) for r in days.collect()) == [("007", date(2025, 1, 2)), ("AAA", date(2025, 1, 3))]
    assert day_listing(spark, str(tmp_path / "nothing")).count() == 0
    (tmp_path / "empty").mkdir()
    assert year_listing(spark, str(tmp_path / "empty")).count() == 0


def test_exported_listing(spark, tmp_path):
    keys = ["date=2024-01-05/", "date=2024-13-99/", "x/", "date=2024-01-06", "a/date=2024-01-07/", "date=2024-01-08/x/", "date=2024-1-8/"]
    lines = [f'{{"key": "{k}", "size": 1}}' for k in keys] + ['{"size": 2}']
    (tmp_path / "listing.json").write_text("\n".join(lines))
    got = read_key_listing(spark, str(tmp_path / "listing.json"))
    assert sorted(r.day for r in got.collect()) == [date(2024, 1, 5), date(2024, 1, 7), date(2024, 1, 8)]


def test_year_keys(spark):
    rows = spark.createDataFrame([("date=2024-01-05/",), ("year=2023/",), ("year=x/",), ("date=24/",)], "k string")
    assert [r.y for r in rows.select(year_of_key(F.col("k")).alias("y")).collect()] == [2024, 2023, None, None]


@pytest.mark.parametrize("day", ["2025-13-01", "soon", None])
def test_bad_catalog_dates(spark, tmp_path, day):
    line = {"symbol": "AAA", "id": "a", "name": "A", "earliest_date": day, "location": ""}
    (tmp_path / "c.json").write_text(json.dumps(line))
    spark.createDataFrame([line], "symbol string, id string, name string, earliest_date string, location string").write.parquet(
        str(tmp_path / "c")
    )
    for path in ("c.json", "c"):
        with pytest.raises(Exception, match="catalog|earliest_date"):
            read_catalog(spark, str(tmp_path / path)).collect()


def test_catalog_files(spark, tmp_path):
    text = "AAA:\n  id: aaausd\n  name: A\n  earliest_date: '2025-01-01'\n  location: USA\n"
    (tmp_path / "symbols.yaml").write_text(text)
    expected = ("AAA", "aaausd", "A", date(2025, 1, 1), "USA")
    from_yaml = read_catalog(spark, str(tmp_path / "symbols.yaml"))
    assert [tuple(r) for r in from_yaml.collect()] == [expected]
    from_yaml.write.parquet(str(tmp_path / "table"))
    assert [tuple(r) for r in read_catalog(spark, str(tmp_path / "table")).collect()] == [expected]
    (tmp_path / "symbols.json").write_text(
        '{"symbol":"AAA","id":"aaausd","name":"A","earliest_date":"2025-01-01","location":"USA"}'
    )
    assert [tuple(r) for r in read_catalog(spark, str(tmp_path / "symbols.json")).collect()] == [expected]


def test_epoch_rounds_down_before_1970(spark):
    row = spark.sql("select timestamp'1969-12-31 23:59:59.5' t").select(epoch_seconds("t").alias("s")).first()
    assert row.s == -1


def test_date_column_by_name_and_iso_day(spark):
    df = spark.sql(
        "select 1 a, timestamp'2024-05-06 23:59:00' Timestamp, date'2024-05-07' d, '2024-05-08T01' s, 3L unix_time"
    )
    assert date_columns(df.schema)[0] == "Timestamp"
    assert date_columns(df.select("a", "s").schema) == []
    assert date_columns(df.select("unix_time", "Timestamp").schema) == ["unix_time", "Timestamp"]
    row = df.select(*[iso_day(F.col(c), df.schema[c].dataType).alias(c) for c in ("Timestamp", "d", "s")]).first()
    assert tuple(row) == ("2024-05-06", "2024-05-07", "2024-05-08")


@pytest.mark.parametrize("mode", ["hwm", "missing_days"])
def test_merge_against_loops_with_a_hot_symbol_and_copies(spark, mode):
    rng = random.Random(7)
    cell = lambda: ("HOT" if rng.random() < 0.5 else rng.choice("ABC"), rng.randrange(40), rng.randrange(3))
    make = lambda n: [cell() for _ in range(n)]
    old = sorted(set(make(60)))
    daily = make(400) + [("HOT", 39, 1)] * 300
    base = date(2024, 12, 15)
    row = lambda s, n, v: (s, base + timedelta(days=n), (base + timedelta(days=n)).year, v)
    schema = "symbol string, timestamp date, year int, volume int"
    existing = spark.createDataFrame([row(*c) for c in old], schema)
    days = spark.createDataFrame([row(*c) for c in daily], schema).withColumn("date", F.col("timestamp"))
    year = lambda n: (base + timedelta(days=n)).year
    expected = set(old)
    for s, n, v in daily:
        marks = [m for t, m, _ in old if t == s and year(m) == year(n)]
        held = {m for t, m, _ in old if t == s}
        if (n > max(marks, default=-1)) if mode == "hwm" else (n not in held):
            expected.add((s, n, v))
    got = merge_bars(existing, days, mode).collect()
    assert sorted(tuple(r) for r in got) == sorted(row(*c) for c in expected)
