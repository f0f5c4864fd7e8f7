"""Keep the latest dates of the instrument catalog current."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.days import day_literal, day_of_text
from barloom.functions.documents import set_latest
from barloom.operators.latest import assumed_days, latest_days, newest_years
from barloom.schema import STAMP_FORMAT
from barloom.session import local_table, prepare, work_table
from barloom.sources.health import broken_folders
from barloom.sources.instruments import (
    read_instrument_rows,
    read_instruments,
    write_document,
    write_instrument_rows,
)
from barloom.sources.listings import year_listing
from barloom.sources.tables import read_listed

STAMP_KEY = "_data_boundaries_updated"


def run_stamp(stamp: str | None):
    """ISO stamp of this run in UTC, or the given text."""
    return F.lit(stamp) if stamp else F.date_format(F.current_timestamp(), STAMP_FORMAT)


def resolved_stamp(spark: SparkSession, stamp: str | None) -> str:
    """The run's stamp as text, so that all its jobs write the same one."""
    return stamp or spark.range(1).select(run_stamp(None)).first()[0]


def yearly_latest(
    spark: SparkSession,
    yearly_path: str,
    as_of: date | str,
    merge_schema: bool = True,
    unreadable: str = "raise",
) -> DataFrame:
    """Latest day per symbol of a yearly table; only files of each symbol's newest year are read.

    A file that is not Parquet fails the run, or with ``unreadable="assume"`` gives the day assumed for
    its year, marked ``fallback``.
    """
    if unreadable not in ("raise", "assume"):
        raise ValueError(f"unreadable must be 'raise' or 'assume', not {unreadable!r}")
    skip = unreadable == "assume"
    newest = newest_years(year_listing(spark, yearly_path))
    folders = newest.withColumn("year", F.col("year").cast("string"))
    bars = read_listed(spark, yearly_path, folders, "year", merge_schema, skip)
    if bars is not None:
        bars = bars.withColumn("year", F.col("year").cast("int"))
    latest = latest_days(newest, bars, day_literal(as_of))
    if not skip:
        return latest
    latest = work_table(latest, "latest")
    suspects = newest.join(latest.where("latest is null"), "symbol", "left_semi")
    broken = newest.join(broken_folders(spark, yearly_path, suspects), "folder", "left_semi")
    kept = latest.join(broken, "symbol", "left_anti")
    return kept.unionByName(assumed_days(broken, day_literal(as_of)))


def patch_documents(instruments: DataFrame, latest: DataFrame, stamp: str | None = None) -> DataFrame:
    """Instrument rows with their new latest dates and the run stamp.

    Rows whose symbol starts with ``_`` are not instruments.  A symbol without a latest day keeps its
    document.
    """
    metadata = F.col("symbol").startswith("_")
    patched = (
        instruments.where(~metadata)
        .join(latest.select("symbol", "latest"), "symbol", "left")
        .select(
            "symbol",
            F.when(F.col("latest").isNull(), F.col("document"))
            .otherwise(set_latest(F.col("document"), F.col("latest")))
            .alias("document"),
        )
    )
    kept = instruments.where(metadata & (F.col("symbol") != STAMP_KEY))
    key = local_table(instruments.sparkSession, [{"symbol": STAMP_KEY}], "symbol string")
    stamped = key.withColumn("document", run_stamp(stamp).cast("variant"))
    return patched.unionByName(kept).unionByName(stamped)


def instrument_bounds(instruments: DataFrame, latest: DataFrame, stamp: str | None = None) -> DataFrame:
    """(symbol, latest, latest_source, updated_at) of the instruments that have a latest day."""
    symbols = instruments.where(~F.col("symbol").startswith("_")).select("symbol")
    return (
        symbols.join(latest, "symbol")
        .where("latest is not null")
        .select(
            "symbol",
            day_of_text(F.col("latest")).alias("latest"),
            "latest_source",
            F.to_timestamp(run_stamp(stamp), STAMP_FORMAT).alias("updated_at"),
        )
    )


def refresh_catalog(
    spark: SparkSession,
    instruments_path: str,
    yearly_path: str,
    as_of: date | str,
    out_path: str,
    stamp: str | None = None,
    as_rows: bool = False,
    merge_schema: bool = True,
    unreadable: str = "raise",
) -> DataFrame:
    """Write ``out_path/bounds`` (Parquet) and ``out_path/instruments`` (JSON); return the bounds.

    With ``as_rows`` the instruments are read and written as JSON lines of (symbol, document).  The
    instruments may be the ones of the last run below ``out_path``.
    """
    prepare(spark)
    stamp = resolved_stamp(spark, stamp)
    read = read_instrument_rows if as_rows else read_instruments
    instruments = work_table(read(spark, instruments_path), "instruments")
    latest = work_table(yearly_latest(spark, yearly_path, as_of, merge_schema, unreadable), "latest")
    documents = patch_documents(instruments, latest, stamp)
    (write_instrument_rows if as_rows else write_document)(documents, f"{out_path}/instruments")
    bounds = instrument_bounds(instruments, latest, stamp)
    bounds.write.mode("overwrite").parquet(f"{out_path}/bounds")
    return spark.read.parquet(f"{out_path}/bounds")
