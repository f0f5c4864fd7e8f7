"""Days a symbol has, lacks, or has past its mark."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.days import days_between


def newest_day(days: DataFrame) -> DataFrame:
    return days.groupBy("symbol").agg(F.max("date").alias("newest_date"))


def earliest_day(days: DataFrame) -> DataFrame:
    return days.groupBy("symbol").agg(F.min("date").alias("earliest_date"))


def calendar(spans: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per day from start to end, both included."""
    return spans.withColumn("date", F.explode(days_between(start, end)))


def without_existing(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    return wanted.join(existing, ["symbol", "date"], "left_anti")


def with_landed(wanted: DataFrame, landed: DataFrame) -> DataFrame:
    """Wanted days whose file has landed."""
    return wanted.join(landed, ["id", "date"], "left_semi")


def high_water_marks(years: DataFrame) -> DataFrame:
    """Last day per symbol and year; only ``timestamp`` is read from the files."""
    return years.groupBy("symbol", "year").agg(F.to_date(F.max("timestamp")).alias("hwm"))


def held_days(years: DataFrame) -> DataFrame:
    """Days that a yearly table has rows of."""
    return years.select("symbol", F.to_date("timestamp").alias("date")).distinct()


def after_mark(days: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of days strictly after the mark of their symbol and year, or all where there is none."""
    marked = days.join(marks, ["symbol", "year"], "left")
    return marked.where(F.col("hwm").isNull() | (F.col("date") > F.col("hwm"))).drop("hwm")


def fetch_window(marks: DataFrame, as_of: Column) -> DataFrame:
    """Days still to be read per symbol and year: from the day after the mark, or January 1, to
    ``as_of`` but not past December 31; ``status`` tells when there are none."""
    first = F.make_date("year", F.lit(1), F.lit(1))
    start = F.coalesce(F.date_add("hwm", 1), first)
    end = F.least(as_of, F.make_date("year", F.lit(12), F.lit(31)))
    return marks.select("symbol", "year", start.alias("start"), end.alias("end")).withColumn(
        "status", F.when(F.col("start") > F.col("end"), "up_to_date").otherwise("behind")
    )


def held_ranges(days: DataFrame) -> DataFrame:
    """(symbol, first, last) of each run of consecutive days."""
    before = Window.partitionBy("symbol").orderBy("date")
    distinct = days.select("symbol", "date").where("date is not null").distinct()
    island = F.date_sub("date", F.row_number().over(before)).alias("island")
    runs = distinct.select("symbol", "date", island).groupBy("symbol", "island")
    return runs.agg(F.min("date").alias("first"), F.max("date").alias("last")).drop("island")


def missing_ranges(spans: DataFrame, days: DataFrame) -> DataFrame:
    """(columns of spans, first, last) of each run of days that a symbol lacks.

    ``spans`` has (symbol, start, end), one row for each symbol, both ends included.  As many rows as there are gaps are
    made, not one for each missing day; a symbol without days has one, the whole span.
    """
    runs = held_ranges(days.join(spans, "symbol", "left_semi"))
    in_time = Window.partitionBy("symbol").orderBy("first")
    # the gap before each run, and the one after the last run
    gaps = runs.select(
        "symbol",
        F.date_add(F.lag("last").over(in_time), 1).alias("after"),
        F.date_sub("first", 1).alias("before"),
        F.when(F.lead("first").over(in_time).isNull(), F.date_add("last", 1)).alias("beyond"),
    )
    none = F.lit(None).cast("date")
    pair = lambda low, high: F.struct(low.alias("low"), high.alias("high"))
    both = F.array(pair(F.col("after"), F.col("before")), pair(F.col("beyond"), none))
    last_too = F.when(F.col("beyond").isNotNull(), both).otherwise(F.slice(both, 1, 1))
    gaps = gaps.select("symbol", F.inline(last_too))
    ranges = spans.join(gaps, "symbol", "left")
    first = F.greatest(F.col("start"), F.col("low")).alias("first")
    last = F.least(F.col("end"), F.col("high")).alias("last")
    return ranges.select(*spans.columns, first, last).where("first <= last").drop("start", "end")


def day_status(days: DataFrame, required: Column, end: Column) -> DataFrame:
    """Per symbol: does its tail reach ``end``, does its history start at ``required``?"""
    spans = days.groupBy("symbol").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return spans.select(
        "symbol",
        F.when(F.col("last") >= end, "up_to_date").otherwise("behind").alias("tail_status"),
        F.when(required < F.col("first"), "backfill").otherwise("full_history").alias("head_status"),
    )


def available_years(years: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct (symbol, year), up to and including ``limit``."""
    found = years.select("symbol", "year").distinct()
    return found if limit is None else found.where(F.col("year") <= limit)


def year_range(years: DataFrame) -> DataFrame:
    """First, last and number of years per symbol, of distinct (symbol, year) rows."""
    return years.groupBy("symbol").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("*").alias("n_years")
    )


def day_counts(rows: DataFrame) -> DataFrame:
    """Days and rows per symbol and year."""
    return rows.groupBy("symbol", "year").agg(
        F.countDistinct("date").alias("n_days"), F.count("*").alias("n_rows_in")
    )
