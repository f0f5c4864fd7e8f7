"""A table of the days that are there, kept from night to night.

A listing of all directories costs as much as there are days.  The inventory keeps what was listed, so that a
night lists the years that can have changed, or takes an exported object listing, and writes only years that differ.
It can be made anew from the directories at any time.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.schema import ANY_YEAR
from barloom.session import local_table, work_table
from barloom.sources.listings import DAY_COLUMNS, day_listing, or_none, within_years

_DAYS = "symbol string, date date, year int, day string, folder string, bytes long, n_files long"
_KEY = ["symbol", "date", "day"]


def known_days(spark: SparkSession, path: str, years: tuple[int | None, int | None] = ANY_YEAR) -> DataFrame:
    """(symbol, date, year, day, folder, bytes, n_files) of the days that an inventory knows, read from the years asked for."""
    found = or_none(lambda: spark.read.schema(_DAYS).parquet(path))
    found = local_table(spark, [], _DAYS) if found is None else found.where("symbol is not null")
    return within_years(found.select(*DAY_COLUMNS), years)


def _changes(known: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows of both sides with ``change``: added, gone, changed (other bytes or files) or null."""
    old = known.select(*_KEY, F.struct("folder", "bytes", "n_files").alias("old"), F.struct(*DAY_COLUMNS).alias("was"))
    new = listed.select(*_KEY, F.struct("folder", "bytes", "n_files").alias("new"), F.struct(*DAY_COLUMNS).alias("now"))
    change = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "gone").when(F.col("old") != F.col("new"), "changed")
    )
    return old.join(new, _KEY, "full").withColumn("change", change)


def _merge(spark: SparkSession, path: str, known: DataFrame, listed: DataFrame, keep_unlisted: bool) -> DataFrame:
    both = _changes(known, listed)
    if keep_unlisted:
        both = both.withColumn("change", F.when(F.col("change") != "gone", F.col("change")))
    both = work_table(both, "inventory")
    day = F.coalesce("now", "was")
    rows = both.select(day.alias("day_row"), "change").select("day_row.*", "change")
    touched = rows.where("change is not null").select("year").distinct()
    if not touched.isEmpty():
        there = rows.join(touched, "year", "left_semi").where("change is null or change <> 'gone'")
        # a year without a day left keeps an empty file, since nothing would replace the old one
        none_left = touched.join(there, "year", "left_anti").select(F.col("year"))
        kept = there.select(*DAY_COLUMNS).unionByName(none_left, allowMissingColumns=True)
        writer = kept.repartition("year").write.partitionBy("year").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return rows.where("change is not null").select("symbol", "date", "folder", "bytes", "n_files", "change")


def refresh_inventory(
    spark: SparkSession, path: str, daily_path: str, years: tuple[int | None, int | None] = ANY_YEAR
) -> DataFrame:
    """Bring an inventory up to the directories of ``years`` and return what differs: (symbol, date, folder, bytes,
    n_files, change).  No directory of another year is listed, and only years with a difference are written."""
    listed = day_listing(spark, daily_path, years)
    return _merge(spark, path, known_days(spark, path, years), listed, keep_unlisted=False)


def merge_listing(spark: SparkSession, path: str, listed: DataFrame, whole: bool = False) -> DataFrame:
    """Bring an inventory up to a listing such as ``read_key_days`` gives and return what differs.  If it is ``whole``,
    days that it lacks are gone; else they stay, as a listing may be of one symbol or prefix."""
    return _merge(spark, path, known_days(spark, path), listed, keep_unlisted=not whole)

