"""Projections on bar rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schema import MINUTE_FORMAT, OHLCV


def _lacking(kind: T.DataType) -> str | None:
    """SQL of a value that no bar has, as text of the type; None for types that prices do not come in."""
    lowest = {"double": "-1.7976931348623157E308", "float": "-3.4028235E38", "bigint": -(2**63), "int": -(2**31)}
    if isinstance(kind, T.DecimalType):
        value = f"-{'9' * (kind.precision - kind.scale) or '0'}.{'9' * kind.scale}".rstrip(".")
    else:
        value = lowest.get(kind.simpleString())
    return None if value is None else f"CAST('{value}' AS {kind.simpleString()})"


def with_lacking(schema: T.StructType) -> T.StructType:
    """The schema with a default for prices, which the reader gives the rows of files without the column.  Their
    rows would else have nulls, as if the file had the column and no price in it."""
    fields = []
    for field in schema.fields:
        value = _lacking(field.dataType) if field.name in OHLCV else None
        default = {} if value is None else {"CURRENT_DEFAULT": value, "EXISTS_DEFAULT": value}
        fields.append(T.StructField(field.name, field.dataType, True, default))
    return T.StructType(fields)


def prices_as_double(df: DataFrame, strict: bool = False) -> DataFrame:
    """Prices as double.  With ``strict`` a column that the file of a row lacks stays told from one without a price: of
    rows read ``with_lacking``, and of all rows if the column is not there at all."""
    typed = {}
    for c in OHLCV:
        lacking = F.expr(_lacking(T.DoubleType()))
        if c in df.columns:
            value = _lacking(df.schema[c].dataType) if strict else None
            cast = F.col(c).cast("double")
            typed[c] = cast if value is None else F.when(F.col(c) == F.expr(value), lacking).otherwise(cast)
        elif strict:
            typed[c] = lacking
    return df.withColumns(typed)


def lacking_fault(df: DataFrame) -> Column:
    """Which price the file of a row lacks, for rows read ``with_lacking``; null for a good row."""
    faults = []
    for c in OHLCV:
        value = _lacking(df.schema[c].dataType)
        if value is not None:
            faults.append(F.when(F.col(c) == F.expr(value), F.lit(f"no column {c}")))
    return F.coalesce(*faults, F.lit(None).cast("string"))


def cast_required(df: DataFrame) -> DataFrame:
    """OHLCV columns to double.  A missing column is an analysis error, and one that only some files miss fails the
    job when their rows are used, if they were read ``with_lacking``."""
    typed = {}
    for c in OHLCV:
        value = _lacking(df.schema[c].dataType) if c in df.columns else None
        cast = F.col(c).cast("double")
        if value is not None:
            fault = F.raise_error(F.lit(f"a file has no column {c}")).cast("double")
            cast = F.when(F.col(c) == F.expr(value), fault).otherwise(cast)
        typed[c] = cast
    return df.withColumns(typed)


def utc_minute(text: Column | str) -> Column:
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text, F.lit(MINUTE_FORMAT))


def epoch_seconds(stamp: Column | str) -> Column:
    """Whole seconds since 1970, rounded down, whatever unit the stamp is stored in."""
    return F.unix_seconds(stamp)


def with_epoch_after_stamp(df: DataFrame) -> DataFrame:
    """Add ``unix_time`` and put it right behind ``timestamp``."""
    names = [c for c in df.columns if c != "unix_time"]
    at = names.index("timestamp") + 1
    return df.withColumn("unix_time", epoch_seconds("timestamp")).select(*names[:at], "unix_time", *names[at:])


def with_utc_stamp(df: DataFrame) -> DataFrame:
    """Turn a nanosecond count, as read from foreign Parquet files, into a timestamp."""
    if "timestamp" in df.columns and isinstance(df.schema["timestamp"].dataType, T.LongType):
        return df.withColumn("timestamp", F.timestamp_micros(F.expr("timestamp div 1000")))
    return df


def read_fields(df: DataFrame) -> DataFrame:
    """Add the typed value of each text field as ``_read_<name>``; null where the text cannot be read.

    A projection of its own, so that a value is parsed once, however often it is used after.
    """
    values = {f"_read_{c}": F.col(c).try_cast("double") for c in OHLCV if c in df.columns}
    return df.withColumns({**values, "_read_timestamp": utc_minute("timestamp")})


def _read_names(df: DataFrame) -> list[str]:
    return [c.removeprefix("_read_") for c in df.columns if c.startswith("_read_")]


def parse_fault(df: DataFrame) -> Column:
    """Why a row of ``read_fields`` is not a bar; null for a good row.  A price may be empty, the
    timestamp may not."""
    faults = [
        F.when(F.col(f"_read_{c}").isNull() & (F.col(c).isNotNull() | F.lit(c == "timestamp")), F.lit(f"bad {c}"))
        for c in _read_names(df)
    ]
    return F.coalesce(*faults)


def parse_bars(df: DataFrame, fault: Column | None = None) -> DataFrame:
    """Text fields to typed bars.  A row with a ``parse_fault``, or the ``fault`` given, fails the job."""
    read = read_fields(df)
    faults = parse_fault(read) if fault is None else F.coalesce(fault, parse_fault(read))
    stamp = F.when(faults.isNotNull(), F.raise_error(faults).cast("timestamp")).otherwise(F.col("_read_timestamp"))
    values = {c: F.col(f"_read_{c}") for c in _read_names(read)}
    typed = [{**values, "timestamp": stamp}.get(c, F.col(c)).alias(c) for c in df.columns]
    return with_epoch_after_stamp(read.select(*typed))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
