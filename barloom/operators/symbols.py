"""Requested symbols against the catalog."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import local_table


def split_request(text: Column | str) -> Column:
    """Array of trimmed symbols of a comma-separated request."""
    return F.transform(F.split(text, ","), lambda part: F.trim(part))


def requested_symbols(spark: SparkSession, request: str) -> DataFrame:
    line = local_table(spark, [{"request": request}], "request string")
    return line.select(F.explode(split_request("request")).alias("symbol")).distinct()


def known_symbols(catalog: DataFrame, requested: DataFrame) -> DataFrame:
    """Catalog rows of the requested symbols.  The distinct keeps a symbol requested very often from
    filling one task of the join."""
    return catalog.join(requested.select("symbol").distinct(), "symbol", "left_semi")


def unknown_symbols(requested: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requested symbols the catalog does not have."""
    distinct = lambda rows: rows.select("symbol").distinct()
    return distinct(requested).join(distinct(catalog), "symbol", "left_anti")


def choose_symbols(catalog: DataFrame, symbols: str | DataFrame | None) -> DataFrame:
    if symbols is None:
        return catalog
    if isinstance(symbols, str):
        symbols = requested_symbols(catalog.sparkSession, symbols)
    return known_symbols(catalog, symbols)


def with_catalog(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows of a vendor id with the catalog columns of that id.

    A row that the catalog repeats counts once.  No hint is given: Spark broadcasts the catalog when its
    size allows it.
    """
    return rows.join(catalog.distinct(), "id")
