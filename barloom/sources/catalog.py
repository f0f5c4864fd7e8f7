"""The symbol catalog."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schema import CATALOG
from barloom.session import local_table, read_whole


_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in CATALOG])


def _typed(rows: DataFrame) -> DataFrame:
    """Catalog columns in their types, each row once; a date that is none, or a missing id or date, fails
    the read.  (A typed JSON reader would turn it into null, and nothing would be planned for the symbol.)"""
    needed = lambda c: F.when(c.isNull(), F.raise_error(F.lit("every symbol needs an id and an earliest_date"))).otherwise(c)
    day = F.col("earliest_date")
    fine = day.try_cast("date").isNotNull()
    bad = F.raise_error(F.concat(F.lit("not a date in the catalog: "), day.cast("string")))
    columns = {f.name: F.col(f.name).cast(f.dataType) for f in CATALOG}
    columns["id"] = needed(columns["id"])
    columns["earliest_date"] = F.when(fine, day.try_cast("date")).when(day.isNotNull(), bad.cast("date")).otherwise(
        needed(day.try_cast("date"))
    )
    return rows.select(*[column.alias(name) for name, column in columns.items()]).distinct()


def catalog_from_map(spark: SparkSession, entries: dict) -> DataFrame:
    """Catalog of a mapping ``symbol -> {id, name, earliest_date, location}``."""
    rows = [{**entry, "symbol": str(symbol)} for symbol, entry in entries.items()]
    if any(row.get(field) is None for row in rows for field in ("id", "earliest_date")):
        raise ValueError("every symbol needs an id and an earliest_date")
    return _typed(local_table(spark, rows, _TEXT))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalog from a YAML file, JSON lines (``.json``) or a Parquet table."""
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as error:
            raise ImportError("reading a YAML catalog needs PyYAML") from error
        text = read_whole(spark, path).first()[0]
        return catalog_from_map(spark, yaml.safe_load(text) or {})
    if path.endswith(".json"):
        return _typed(spark.read.schema(_TEXT).json(path))
    return _typed(spark.read.parquet(path))
