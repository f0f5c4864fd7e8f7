"""Instrument documents: one JSON object keyed by symbol, or one row per instrument."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import MAX_DOCUMENT_BYTES, read_whole


def read_instruments(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, document) rows of a JSON object keyed by symbol, its ``_`` keys included.

    One object is read by one task, so its size is checked; ``read_instrument_rows`` has no limit.
    """
    whole = read_whole(spark, path)
    members = F.parse_json("value").cast("map<string,variant>")
    return whole.select(F.explode(members).alias("symbol", "document"))


def read_instrument_rows(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, document) rows of JSON lines ``{"symbol": ..., "document": {...}}``."""
    return spark.read.schema("symbol string, document variant").json(path)


def write_instrument_rows(rows: DataFrame, path: str) -> None:
    rows.select("symbol", "document").write.mode("overwrite").json(path)


def write_document(rows: DataFrame, path: str, max_bytes: int = MAX_DOCUMENT_BYTES) -> None:
    """Write all rows as the one JSON object they were read from.

    One object is one line of one file, so its size is checked; beyond ``max_bytes`` keep the rows
    of ``write_instrument_rows``, which are the same content.
    """
    size = rows.agg(F.sum(F.octet_length(F.to_json("document")))).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"document of {size} bytes is over {max_bytes}; use write_instrument_rows")
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("symbol", "text"))))
    texts = rows.select("symbol", F.to_json("document").alias("text")).agg(entries.alias("texts"))
    document = F.to_variant_object(F.transform_values("texts", lambda _, text: F.parse_json(text)))
    texts.select(F.to_json(document).alias("value")).write.mode("overwrite").text(path)
