"""Landed files that come twice."""

from barloom import ingest_days, read_bars
from barloom.sources.ledger import read_ledger
from bar_files import HEADER, bars, land


def status(df):
    return {(r.symbol, str(r.date)): r.status for r in df.collect()}


def stored(spark, path):
    return {(r.symbol, r.date): r["count"] for r in read_bars(spark, path).groupBy("symbol", "date").count().collect()}


def test_one_day_in_two_folders(spark, catalog, tmp_path):
    landing, daily = tmp_path / "landing", str(tmp_path / "daily")
    for name in ("a", "b"):
        (landing / name).mkdir(parents=True)
        land(landing / name, "aaausd", "2025-01-02", bars("2025-01-02", [1, 2]))
        land(landing / name, "bbbusd", "2025-01-03", bars("2025-01-03", [1, 2], price=1.0 if name == "a" else 2.0))
        land(landing / name, "seven", "2025-01-04", bars("2025-01-04", [2, 1] if name == "a" else [1, 2]))
    found = status(ingest_days(spark, str(landing), catalog, daily))
    assert found == {("AAA", "2025-01-02"): "ingested", ("BBB", "2025-01-03"): "conflict", ("007", "2025-01-04"): "ingested"}
    assert stored(spark, daily) == {("AAA", "2025-01-02"): 2, ("007", "2025-01-04"): 2}
    assert status(ingest_days(spark, str(landing), catalog, daily))["AAA", "2025-01-02"] == "exists"


def test_ledger(spark, catalog, tmp_path):
    landing, daily, ledger = tmp_path / "landing", str(tmp_path / "daily"), str(tmp_path / "ledger")
    landing.mkdir()
    run = lambda: status(ingest_days(spark, str(landing), catalog, daily, ledger_path=ledger))
    assert run() == {}
    land(landing, "aaausd", "2025-01-02", bars("2025-01-02", [1, 2]))
    land(landing, "bbbusd", "2025-01-03", bars("2025-01-03", [1, 2]))
    land(landing, "seven", "2025-01-03", [])
    assert set(run().values()) == {"ingested", "empty"}
    first = read_ledger(spark, ledger).collect()
    assert {r.id: r.bytes > 0 and len(r.digest) == 64 for r in first} == {"aaausd": True, "bbbusd": True, "seven": True}
    again = run()
    assert (again["AAA", "2025-01-02"], again["BBB", "2025-01-03"]) == ("exists", "exists")
    before = read_ledger(spark, ledger).where("id <> 'seven'").count()
    assert before == 2  # files known by name, length and time are not opened again
    land(landing, "aaausd", "2025-01-02", bars("2025-01-02", [1, 3]))
    for _ in range(2):
        found = run()
        assert (found["AAA", "2025-01-02"], found["BBB", "2025-01-03"]) == ("changed", "exists")
    land(landing, "aaausd", "2025-01-02", bars("2025-01-02", [2, 1]), HEADER)
    assert run()["AAA", "2025-01-02"] == "exists"  # the lines of the first delivery again
    assert stored(spark, daily) == {("AAA", "2025-01-02"): 2, ("BBB", "2025-01-03"): 2}
