"""Putting rows into a table so that a run whose driver dies half-way can be finished.

Replacing partitions is not one atomic step.  Before it starts, a marker below the table names the staged
rows; it is cleared when all is in place.  A marker found at the start of a run means that the run before
was cut off, and that its staged rows have to be put in place again.

Days are not staged, as they can be read from their CSV files again: there the marker lists the days.
"""

from pyspark.sql import DataFrame, Row, SparkSession

from barloom.schema import YEARLY_KEYS
from barloom.session import local_table, settings, work_table
from barloom.sources.listings import or_none
from barloom.sources.tables import read_bars, time_order

_MARKER = "_publishing"  # Spark lists no name that starts with an underscore as data
_SCHEMA = "staging string, extends boolean"
_DAYS_MARKER = "_ingesting"
_DAYS = "symbol string, date date"


def _mark(spark: SparkSession, path: str, rows: list[dict]) -> None:
    local_table(spark, rows, _SCHEMA).write.mode("overwrite").json(f"{path}/{_MARKER}")


def unfinished(spark: SparkSession, path: str) -> Row | None:
    """(staging, extends) of a publication that was cut off."""
    marker = or_none(lambda: spark.read.schema(_SCHEMA).json(f"{path}/{_MARKER}"))
    return None if marker is None else marker.first()


def publish_years(spark: SparkSession, staging: str, path: str, extends: bool) -> None:
    """Put staged years in place and free the staging folder.

    They replace the years of the same symbols, or with ``extends`` are added to them as further files.
    """
    _mark(spark, path, [{"staging": staging, "extends": extends}])
    _put(read_bars(spark, staging, merge_schema=False), path, extends)
    _mark(spark, path, [])
    free(spark, staging)


def free(spark: SparkSession, staging: str) -> None:
    local_table(spark, [], "done int").write.mode("overwrite").parquet(staging)


def _put(staged: DataFrame, path: str, extends: bool) -> None:
    """One task writes one staged file, so the new files cover the same stretches of time."""
    writer = staged.sortWithinPartitions(*time_order(staged)).write.partitionBy(*YEARLY_KEYS)
    if extends:
        writer = writer.mode("append")
    else:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    whole = 1 << 50
    with settings(
        staged.sparkSession, spark__sql__files__maxPartitionBytes=whole, spark__sql__files__openCostInBytes=whole
    ):
        writer.parquet(path)


def unfinished_days(spark: SparkSession, path: str) -> DataFrame | None:
    """(symbol, date) of days that a run which was cut off may have written in part."""
    marker = or_none(lambda: spark.read.schema(_DAYS).parquet(f"{path}/{_DAYS_MARKER}"))
    return None if marker is None or marker.isEmpty() else work_table(marker.distinct(), "unfinished")


def mark_days(days: DataFrame, path: str) -> None:
    days.select("symbol", "date").distinct().write.mode("append").parquet(f"{path}/{_DAYS_MARKER}")


def clear_days(spark: SparkSession, path: str) -> None:
    local_table(spark, [], _DAYS).write.mode("overwrite").parquet(f"{path}/{_DAYS_MARKER}")
