"""Latest day of each symbol, from its newest year."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.functions.days import assumed_latest, date_columns, day_text, iso_day


def newest_years(years: DataFrame) -> DataFrame:
    """The newest year per symbol of distinct (symbol, year) rows."""
    newest_first = Window.partitionBy("symbol").orderBy(F.desc("year"))
    return years.withColumn("rank", F.row_number().over(newest_first)).where("rank = 1").drop("rank")


def latest_days(newest: DataFrame, bars: DataFrame | None, as_of: Column) -> DataFrame:
    """(symbol, year, latest, latest_source) of the newest years and the bars of those years.

    ``newest`` comes from a listing, so a newest year whose file has no rows gives a null day.  Each symbol's
    day is that of its first date column with a value; a symbol whose rows have none gets the assumed day.
    """
    columns = [] if bars is None else date_columns(bars.schema, skip=("symbol", "year"))
    if not columns:
        return assumed_days(newest, as_of)
    tops = [F.max(c).alias(f"top_{i}") for i, c in enumerate(columns)]
    tops = bars.groupBy("symbol", "year").agg(F.count("*").alias("n_rows"), *tops)
    day = F.coalesce(*[iso_day(F.col(f"top_{i}"), bars.schema[c].dataType) for i, c in enumerate(columns)])
    found = newest.select("symbol", "year").join(tops, ["symbol", "year"], "left").withColumn("day", day)
    undated = F.col("day").isNull() & (F.col("n_rows") > 0)
    return found.select(
        "symbol",
        "year",
        F.when(undated, day_text(assumed_latest(F.col("year"), as_of))).otherwise(F.col("day")).alias("latest"),
        F.when(undated, "fallback").otherwise("data").alias("latest_source"),
    )


def assumed_days(years: DataFrame, as_of: Column) -> DataFrame:
    """Latest days by the year alone, marked ``fallback``: today in the running year, else December 31."""
    day = day_text(assumed_latest(F.col("year"), as_of))
    return years.select("symbol", "year", day.alias("latest"), F.lit("fallback").alias("latest_source"))


def keep_or_update(rows: DataFrame, latest: DataFrame, old: Column) -> DataFrame:
    """Left join on symbol; a symbol without a latest day keeps ``old``."""
    return rows.join(latest, "symbol", "left").withColumn("latest", F.coalesce("latest", old))
