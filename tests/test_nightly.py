"""Nights of planning, landing, ingesting, consolidating and refreshing, against a model in plain Python."""

import json
import random
from datetime import date, timedelta

import pytest
from bar_files import land

from barloom import catalog_from_map, consolidate, day_listing, ingest_days, plan_head, plan_tail, read_bars, refresh_catalog

BASE = date(2024, 12, 29)
FIRST = {"AAA": date(2024, 12, 30), "BBB": date(2025, 1, 1), "007": date(2024, 12, 30)}
IDS = {"AAA": "aaausd", "BBB": "bbbusd", "007": "seven"}


def rows_of_day(rng):
    """A few bars with repeats: (minute, price)."""
    return [(rng.randrange(3), rng.randrange(2)) for _ in range(rng.randrange(1, 6))]


@pytest.mark.parametrize("seed, extend, mode", [(1, False, "hwm"), (2, True, "hwm"), (3, False, "missing_days")])
def test_nights(spark, catalog, tmp_path, seed, extend, mode):
    rng = random.Random(seed)
    catalog = catalog.withColumn("earliest_date", catalog.earliest_date - 2)
    daily, yearly, landing = str(tmp_path / "daily"), str(tmp_path / "yearly"), tmp_path / "landing"
    landing.mkdir()
    days, years = {}, {}
    (tmp_path / "instruments.json").write_text(json.dumps({"AAA": {"n": 1}, "007": {}}))
    for night in range(3):
        today = BASE + timedelta(days=3 * night + 3)
        yesterday = today - timedelta(days=1)
        existing = day_listing(spark, daily)
        plan = plan_tail(catalog, existing, yesterday)
        wanted = {(r.symbol, r.date) for r in plan.collect()}
        model = set()
        for symbol, earliest in FIRST.items():
            have = [d for s, d in days if s == symbol]
            start = max(have) + timedelta(days=1) if have else earliest
            model |= {(symbol, start + timedelta(days=i)) for i in range((yesterday - start).days + 1)}
        assert wanted == model
        if night == 2:  # days that were missed come in late
            wanted |= {(r.symbol, r.date) for r in plan_head(catalog, existing, today).collect()}
            wanted |= {(r.symbol, r.date) for r in plan_tail(catalog, existing, yesterday, "1990-01-01").collect()}
        for symbol, day in wanted:
            if rng.random() < 0.3:
                continue  # a holiday: nothing lands
            rows = rows_of_day(rng)
            days.setdefault((symbol, day), rows)
            text = [[f"{day} 00:0{m}", p, p, p, p, 1] for m, p in rows]
            land(landing, IDS[symbol], day.isoformat(), text)
        ingest_days(spark, str(landing), catalog, daily)
        got = read_bars(spark, daily)
        assert got.count() == sum(len(rows) for rows in days.values())

        consolidate(spark, daily, yearly, mode, extend=extend)
        marks = {key: set(rows) for key, rows in years.items()}
        for (symbol, day), rows in days.items():
            held = {d for d, _, _ in marks.get((symbol, day.year), ())}
            take = day not in held if mode == "missing_days" else day > max(held, default=date.min)
            if take:
                years.setdefault((symbol, day.year), set()).update((day, m, p) for m, p in rows)
        found = {}
        for r in read_bars(spark, yearly).collect():
            row = (r.timestamp.date(), r.timestamp.minute, int(r.open))
            group = found.setdefault((r.symbol, int(r.year)), [])
            group.append(row)
        assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in years.items()}

    bounds = refresh_catalog(spark, str(tmp_path / "instruments.json"), yearly, today, str(tmp_path / "out"))
    newest = {}
    for (symbol, _), rows in years.items():
        newest[symbol] = max([newest.get(symbol, date.min), *(d for d, _, _ in rows)])
    assert {r.symbol: r.latest for r in bounds.collect()} == {s: newest[s] for s in ("AAA", "007")}


def test_paths_and_symbols_with_special_characters(spark, tmp_path):
    base = tmp_path / "a b % c"
    (base / "landing").mkdir(parents=True)
    catalog = catalog_from_map(spark, {"A/B x": {"id": "ab", "earliest_date": "2025-01-01"}})
    for day in ("2025-01-02", "2025-01-03"):
        land(base / "landing", "ab", day, [[f"{day} 00:00", 1, 1, 1, 1, 1]])
    ingest_days(spark, str(base / "landing"), catalog, str(base / "daily"))
    have = day_listing(spark, str(base / "daily"))
    assert [r.date for r in plan_tail(catalog, have, "2025-01-04").collect()] == [date(2025, 1, 4)]
    consolidate(spark, str(base / "daily"), str(base / "yearly"), years=(2025, 2025))
    result = consolidate(spark, str(base / "daily"), str(base / "yearly"), years=(2025, 2025))
    assert [tuple(r) for r in result.collect()] == [("A/B x", 2025, 0, 0, 2, "up_to_date")]
    assert {r.symbol for r in read_bars(spark, str(base / "yearly")).collect()} == {"A/B x"}
