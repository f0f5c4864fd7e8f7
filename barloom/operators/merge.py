"""Merging new days into years.

A row is a duplicate only when all its columns are equal.  Stamps are cut to the minute, so up to
sixty bars share one; a de-dup on the stamp would lose fifty-nine of them.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.days import after_mark, held_days, high_water_marks
from barloom.session import work_table

MODES = ("hwm", "missing_days")


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def distinct_bars(bars: DataFrame) -> DataFrame:
    """Whole-row distinct.  Copies are dropped in each task before the shuffle, so a group of copies
    reaches it as one row per task however large it is."""
    return bars.dropDuplicates()


def union_distinct(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both sides without duplicate rows; a column that one side lacks is an error."""
    return distinct_bars(existing.unionByName(new))


def new_rows(existing: DataFrame, daily: DataFrame, mode: str = "hwm") -> DataFrame:
    """Rows of ``daily`` (symbol, year, date, ...) that a merge into ``existing`` takes.

    ``hwm``: rows of days after the last day of the same symbol and year.  ``missing_days``: rows of
    all days the symbol has no row of.  Marks and held days are small tables next to the bars; they
    are written to scratch so that Spark sees their size and need not shuffle the bars for the join.
    """
    check_mode(mode)
    if mode == "hwm":
        return after_mark(daily, work_table(high_water_marks(existing), "marks"))
    return daily.join(work_table(held_days(existing), "held"), ["symbol", "date"], "left_anti")


def new_days(known: DataFrame, days: DataFrame, mode: str = "hwm") -> DataFrame:
    """The same of statistics of years, (symbol, year, last_day, days), instead of their rows."""
    check_mode(mode)
    if mode == "hwm":
        return after_mark(days, known.select("symbol", "year", F.col("last_day").alias("hwm")))
    return days.join(known.select("symbol", F.explode("days").alias("date")).distinct(), ["symbol", "date"], "left_anti")


def merge_bars(existing: DataFrame, daily: DataFrame, mode: str = "hwm") -> DataFrame:
    """Existing rows and the new rows of ``daily``, each row once, in the columns of ``existing``."""
    return union_distinct(existing, new_rows(existing, daily, mode).select(*existing.columns))
