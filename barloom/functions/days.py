"""Day, year and key expressions."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schema import DATE_WORDS, DAY_FORMAT


def day_literal(day: date | str | Column) -> Column:
    if isinstance(day, Column):
        return day
    return F.lit(day if isinstance(day, date) else date.fromisoformat(day))


def day_of_text(text: Column) -> Column:
    """ISO day, or null where the text is not one."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def day_of_value(value: Column) -> Column:
    """Day of a ``date=`` directory value, null where it names none; ``2024-1-5`` is the same day as ``2024-01-05``."""
    return F.when(value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), value.try_cast("date"))


def day_of_key(key: Column) -> Column:
    """Day of a listing key such as ``date=2024-01-05/``, or null.  A key without the slash is a file."""
    return day_of_value(F.regexp_extract(key, r"date=([^/]*)/+$", 1))


def day_of_file_key(key: Column) -> Column:
    """Day of the key of a day directory or of a file in it, or null."""
    return day_of_value(F.regexp_extract(key, r"(?:^|/)date=([^/]*)/", 1))


def symbol_of_key(key: Column) -> Column:
    """Symbol of a key such as ``1s/symbol=A%2FB/date=2024-01-05/``, special characters put back; null without one."""
    found = F.regexp_extract(key, r"(?:^|/)symbol=([^/]*)/", 1)
    return F.when(found != "", F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))))


def year_of_key(key: Column) -> Column:
    """Year of a day key or of a year key, or null."""
    return F.regexp_extract(key, r"(?:date=(?=\d{4}-\d{1,2}-\d{1,2}/)|year=(?=\d{4}/))(\d{4})", 1).try_cast("int")


def day_text(day: Column) -> Column:
    return F.date_format(day, DAY_FORMAT)


def landed_name(vendor_id: Column, day: Column) -> Column:
    """Name of the CSV file in which a day lands."""
    return F.format_string("%s-s1-bid-%s-%s.csv", vendor_id, day_text(day), day_text(F.date_add(day, 1)))


def daily_key(symbol: Column, day: Column) -> Column:
    """Directory of a day below the daily table."""
    return F.format_string("symbol=%s/date=%s/", symbol, day_text(day))


def last_day_of_year(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def days_between(start: Column, end: Column) -> Column:
    """Array of all days from start to end, both included; empty when start is after end."""
    none = F.array().cast("array<date>")
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))).otherwise(none)


def date_columns(schema: T.StructType, skip: tuple[str, ...] = ()) -> list[str]:
    """Columns whose names look like a date or time, in the order of the schema."""
    return [name for name in schema.names if name not in skip and any(word in name.lower() for word in DATE_WORDS)]


def iso_day(value: Column, kind: T.DataType) -> Column:
    """ISO day of a timestamp or date, else the first ten characters of the value's text."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return day_text(F.to_date(value))
    return F.substring(value.cast("string"), 1, 10)


def assumed_latest(year: Column, as_of: Column) -> Column:
    """Latest day of a year that cannot be read: today in the running year, else December 31."""
    return F.when(year == F.year(as_of), as_of).otherwise(last_day_of_year(year))
