"""Which days are missing, as a table of (symbol, id, date)."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.days import day_literal
from barloom.operators.days import calendar, earliest_day, missing_ranges, newest_day, without_existing
from barloom.operators.symbols import choose_symbols


def plan_tail(
    catalog: DataFrame,
    existing: DataFrame,
    end_date: date | str,
    start_override: date | str | None = None,
    symbols: str | DataFrame | None = None,
) -> DataFrame:
    """Days to fetch up to and including ``end_date``.

    A symbol starts at ``start_override``, else the day after its newest day, else its earliest date,
    and never before its earliest date.  ``existing`` is (symbol, date); days it holds are left out,
    which only a start override can bring up, so only then is it joined.
    """
    chosen = choose_symbols(catalog, symbols).select("symbol", "id", "earliest_date")
    if start_override is None:
        newest = newest_day(existing)
        spans = chosen.join(newest, "symbol", "left")
        start = F.coalesce(F.date_add("newest_date", 1), F.col("earliest_date"))
    else:
        spans, start = chosen, day_literal(start_override)
    first = F.greatest(start, F.col("earliest_date"))
    days = calendar(spans, first, day_literal(end_date)).select("symbol", "id", "date")
    if start_override is None:
        return days
    return without_existing(days, existing.select("symbol", "date").distinct())


def plan_ranges(catalog: DataFrame, existing: DataFrame, end_date: date | str) -> DataFrame:
    """(symbol, id, first, last) of each run of days to fetch, from a symbol's own earliest date to ``end_date``: its
    head, the gaps between its days, and its tail."""
    spans = catalog.select("symbol", "id", F.col("earliest_date").alias("start"), day_literal(end_date).alias("end"))
    return missing_ranges(spans, existing)


def plan_head(catalog: DataFrame, existing: DataFrame, as_of: date | str) -> DataFrame:
    """Days to fetch from a symbol's earliest date up to, not including, its first existing day, or
    ``as_of`` when it has none."""
    have = earliest_day(existing).withColumnRenamed("earliest_date", "first_day")
    spans = catalog.select("symbol", "id", "earliest_date").join(have, "symbol", "left")
    stop = F.coalesce(F.col("first_day"), day_literal(as_of))
    return calendar(spans, F.col("earliest_date"), F.date_sub(stop, 1)).select("symbol", "id", "date")
