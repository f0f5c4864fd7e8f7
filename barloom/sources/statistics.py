"""Rows, last day and days of each year, kept beside a yearly table.

They are held against the listing: each row has a fingerprint of the names, lengths and times of its year's files.
A year whose files are others than those is read again, so nothing that writes, cuts off or replaces files can make
them wrong, and they can be deleted at any time.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.schema import ANY_YEAR, YEARLY_KEYS
from barloom.session import local_table, work_table
from barloom.sources.listings import or_none, within_years

_FOLDER = "_statistics"  # Spark lists no name that starts with an underscore as data
_SCHEMA = "symbol string, year int, n_rows long, last_day date, days array<date>, fingerprint long"
COLUMNS = ["symbol", "year", "n_rows", "last_day", "days"]


def statistics_of(bars: DataFrame) -> DataFrame:
    """(symbol, year, n_rows, last_day, days) of bars; only ``timestamp`` is read.  A row without a stamp counts as a row.

    Rows are counted by day first, so what is gathered is at most the days of a year, however many rows these have.
    """
    days = bars.groupBy(*YEARLY_KEYS, F.to_date("timestamp").alias("day")).agg(F.count("*").alias("n"))
    return days.groupBy(*YEARLY_KEYS).agg(
        F.sum("n").alias("n_rows"), F.max("day").alias("last_day"), F.array_sort(F.collect_list("day")).alias("days")
    )


def added(old: DataFrame, new: DataFrame) -> DataFrame:
    """Statistics of years to which the rows of ``new`` were added as further files."""
    was, now = (d.select(*YEARLY_KEYS, F.struct(*COLUMNS[2:]).alias(name)) for d, name in ((old, "was"), (new, "now")))
    none = F.array().cast("array<date>")
    return now.join(was, YEARLY_KEYS, "left").select(
        *YEARLY_KEYS,
        (F.coalesce("was.n_rows", F.lit(0)) + F.col("now.n_rows")).alias("n_rows"),
        F.greatest("was.last_day", "now.last_day").alias("last_day"),
        F.array_sort(F.array_union(F.coalesce("was.days", none), "now.days")).alias("days"),
    )


def _kept(spark: SparkSession, path: str, years: tuple[int | None, int | None] = ANY_YEAR) -> DataFrame:
    found = or_none(lambda: spark.read.schema(_SCHEMA).parquet(f"{path}/{_FOLDER}"))
    return within_years(local_table(spark, [], _SCHEMA) if found is None else found, years)


def known_statistics(
    spark: SparkSession,
    path: str,
    held: DataFrame,
    read: Callable[[DataFrame], DataFrame | None],
    years: tuple[int | None, int | None] = ANY_YEAR,
) -> DataFrame:
    """Statistics of the years of a listing.  Years whose files are not those the statistics were made of are given to
    ``read``, and what it shows is kept; of the others no file is opened."""
    kept, same = _kept(spark, path, years), [*YEARLY_KEYS, "fingerprint"]
    fresh = work_table(kept.join(held.select(*same), same, "left_semi").select(*COLUMNS), "known")
    stale = work_table(held.join(fresh, YEARLY_KEYS, "left_anti"), "stale")
    if stale.isEmpty():
        return fresh
    bars = read(stale)
    if bars is None:
        return fresh
    found = keep_statistics(spark, path, stale, statistics_of(bars))
    return work_table(fresh.unionByName(found), "known")


def keep_statistics(spark: SparkSession, path: str, held: DataFrame, statistics: DataFrame) -> DataFrame:
    """Record the statistics of the listed years and return them; a listed year without statistics has no row."""
    none = F.array().cast("array<date>")
    rows = held.select(*YEARLY_KEYS, "fingerprint").join(statistics, YEARLY_KEYS, "left").select(
        *YEARLY_KEYS, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "last_day", F.coalesce("days", none).alias("days"),
        "fingerprint",
    )
    rows = work_table(rows, "statistics")
    others = _kept(spark, path).join(rows.select("year").distinct(), "year", "left_semi")
    others = others.join(rows, YEARLY_KEYS, "left_anti").select(*rows.columns)
    every = work_table(others.unionByName(rows), "statistics")
    writer = every.repartitionByRange("year", "symbol").write.partitionBy("year").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{_FOLDER}")
    return rows.select(*COLUMNS)
