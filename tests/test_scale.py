"""What the plans must look like for large tables, and skewed data."""

import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import barloom.plans.consolidate as jobs
import barloom.sources.tables as tables
from barloom import consolidate, read_bars
from barloom.functions.bars import parse_bars
from barloom.operators.days import day_counts, high_water_marks
from barloom.operators.merge import merge_bars
from barloom.operators.symbols import known_symbols, unknown_symbols, with_catalog
from barloom.sources.landing import read_landed
from barloom.sources.listings import day_listing, landed_listing
from barloom.suite import QUERIES
from bar_files import bars, land
from test_consolidate import put_day

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def exchanges(plan):
    return len(re.findall(r"^[ :+\-*]*Exchange \(", plan, re.M))


@pytest.fixture
def daily(tmp_path):
    folder = tmp_path / "daily"
    for day in ("2025-01-05", "2025-01-06", "2025-01-07"):
        for symbol in ("AAA", "BBB"):
            put_day(folder, symbol, day)
    return folder


def written_plans(monkeypatch):
    plans = []
    write = jobs.write_years

    def record(bars, path, partitions, distinct):
        order = tables.time_order(bars)
        ranged = bars.repartitionByRange(max(2, partitions), *order)
        plans.append(plan_of(ranged.dropDuplicates() if distinct else ranged))
        write(bars, path, partitions, distinct)

    monkeypatch.setattr(jobs, "write_years", record)
    return plans


def test_marks_read_only_the_stamp(spark, daily, tmp_path):
    yearly = str(tmp_path / "yearly")
    consolidate(spark, str(daily), yearly)
    plan = plan_of(high_water_marks(read_bars(spark, yearly)))
    assert re.findall(r"ReadSchema: (.*)", plan) == ["struct<timestamp:timestamp>"]


def test_old_rows_are_not_shuffled_for_the_distinct(spark, daily, tmp_path, monkeypatch):
    yearly = str(tmp_path / "yearly")
    plans = written_plans(monkeypatch)
    consolidate(spark, str(daily), yearly)
    put_day(daily, "AAA", "2025-01-08")
    consolidate(spark, str(daily), yearly)
    first, plan = plans
    assert exchanges(first) == 1, "a first run shuffles once: duplicates are dropped within their range"
    assert exchanges(plan) == 2
    old_side = plan.split("Union")[1].split(":-")[1].split("+-")[0]
    assert "Exchange" not in old_side


def test_extending_reads_no_old_row(spark, daily, tmp_path, monkeypatch):
    yearly = str(tmp_path / "yearly")
    consolidate(spark, str(daily), yearly)
    put_day(daily, "AAA", "2025-01-08")
    plans = written_plans(monkeypatch)
    consolidate(spark, str(daily), yearly, extend=True)
    (plan,) = plans
    assert "/yearly/" not in plan and "date=2025-01-08" in plan
    assert "date=2025-01-07" not in plan


def test_listed_folders_alone_are_read(spark, daily):
    """A folder that is gone fails the read, and columns of folders that are not listed do not show up."""
    days = day_listing(spark, str(daily))
    wanted = days.where("symbol = 'AAA' and day > '2025-01-05'")
    columns = jobs._days(spark, str(daily), wanted, merge_schema=True).columns
    put_day(daily, "BBB", "2024-02-02")
    odd = daily / "symbol=BBB" / "date=2024-02-02"
    frame = spark.read.parquet(str(odd)).withColumn("odd", F.lit(1))
    frame.write.mode("append").parquet(str(odd))
    assert jobs._days(spark, str(daily), wanted, merge_schema=True).columns == columns
    gone = wanted.withColumn("folder", F.concat("folder", F.lit("-gone")))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        jobs._days(spark, str(daily), wanted.union(gone), merge_schema=True)


def test_only_directories_of_the_years_are_listed(spark, daily, monkeypatch):
    put_day(daily, "AAA", "2024-05-05")
    (daily / "symbol=AAA" / "date=2023-05-05" / "odd=1").mkdir(parents=True)
    (daily / "symbol=AAA" / "date=2023-05-05" / "odd=1" / "x.parquet").write_bytes(b"a listing of all would fail")
    days = day_listing(spark, str(daily), (2024, 2025))
    assert days.count() == 7
    assert day_listing(spark, str(daily), (2025, 2025)).count() == 6


def test_ingest_shuffles_no_row(spark, catalog, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    land(landing, "aaausd", "2025-01-02", bars("2025-01-02", [0]))
    files = landed_listing(spark, str(landing)).select("file_path", F.lit("AAA").alias("symbol"), "date")
    raw = read_landed(spark, str(landing), files)
    plan = plan_of(parse_bars(raw))
    assert exchanges(plan) == 0 and "BroadcastHashJoin" in plan
    assert parse_bars(raw).count() == 1


def test_a_catalog_of_the_driver_is_broadcast(spark, catalog):
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").select(F.col("event_type").alias("id"))
    plan = plan_of(with_catalog(rows, catalog))
    assert exchanges(plan) == 0 and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name", [n for n in QUERIES if "files" not in n])
def test_no_query_makes_pairs_or_runs_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert operator not in plan


def test_counts_are_combined_before_the_shuffle(spark):
    plan = plan_of(QUERIES["consolidation_summary"](spark, SF_DIR))
    assert "partial_count" in plan and exchanges(plan) == 2
    assert re.findall(r"ReadSchema: (.*)", plan) == ["struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>"]


def test_a_symbol_requested_a_million_times(spark, catalog):
    """The hot symbol leaves each task once, whatever its share."""
    requested = spark.range(1_000_000).select(F.when(F.col("id") < 999_990, "AAA").otherwise("ZZZ").alias("symbol"))
    assert [r.symbol for r in known_symbols(catalog, requested).collect()] == ["AAA"]
    assert [r.symbol for r in unknown_symbols(requested, catalog).collect()] == ["ZZZ"]
    plan = plan_of(known_symbols(catalog, requested))
    assert re.search(r"HashAggregate \(\d+\)\n.*Exchange \(\d+\)\n.*HashAggregate", plan)


def test_copies_that_are_a_third_of_all_rows(spark):
    """Copies, one hot symbol and one hot day, through both modes."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), F.col("id") % 50)).alias("symbol"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 40).cast("int").alias("n"),
    )
    days = rows.select(
        "symbol",
        F.date_add(F.lit("2025-01-01").cast("date"), F.col("n")).alias("timestamp"),
        F.lit(2025).alias("year"),
        F.date_add(F.lit("2025-01-01").cast("date"), F.col("n")).alias("date"),
    )
    existing = days.where("date < '2025-01-10'").drop("date").distinct()
    for mode in ("hwm", "missing_days"):
        merged = merge_bars(existing, days, mode)
        assert merged.count() == days.distinct().count()
        assert exchanges(plan_of(merged)) <= 2
    counted = {r.symbol: (r.n_days, r.n_rows_in) for r in day_counts(days).collect()}
    assert counted["HOT"] == (1, 100_000)


def test_a_listed_folder_that_is_gone_is_an_error(spark, daily):
    wanted = day_listing(spark, str(daily))
    for file in (daily / "symbol=AAA" / "date=2025-01-06").iterdir():
        file.unlink()
    (daily / "symbol=AAA" / "date=2025-01-06").rmdir()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs._days(spark, str(daily), wanted, merge_schema=True)


@pytest.mark.parametrize(
    "n_rows, cores, ranges",
    [(0, 8, 1), (400_000, 8, 1), (10_000_000, 8, 8), (10_000_000, 4000, 20), (10**9, 8, 250), (10**12, 4000, 20_000)],
)
def test_ranges_follow_the_rows(n_rows, cores, ranges):
    assert jobs._ranges(n_rows, jobs.TARGET_ROWS, cores) == ranges
