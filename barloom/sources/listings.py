"""Directory listings as tables.  No file is opened: only paths and lengths are read.

Jobs decide on the listing what to read, and then read those directories only.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.days import day_of_file_key, day_of_key, day_of_text, day_of_value, symbol_of_key
from barloom.schema import ANY_YEAR, DAILY_KEYS, LANDED_NAME, YEARLY_KEYS
from barloom.session import local_table, settings, work_table

DAY_COLUMNS = ["symbol", "date", "year", "day", "folder", "bytes", "n_files"]
_NOTHING_THERE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def or_none(load) -> DataFrame | None:
    """Result of ``load()``, or None when its path does not exist or holds no file."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            return None
        raise


def _list_files(spark: SparkSession, pattern: str, suffix: str, **options) -> DataFrame | None:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").options(**options)
    return or_none(lambda: reader.load(pattern))


def _listing(listed: DataFrame, name: str) -> DataFrame:
    """Write a listing to scratch.  Spark plans a scan by the size of its files, here by the size of the
    bars; as no bar is read, one task per core is enough."""
    with settings(listed.sparkSession, spark__sql__files__maxPartitionBytes=1 << 50):
        return work_table(listed, name)


def list_partitions(spark: SparkSession, path: str, keys: list[str], pattern: str = "") -> DataFrame:
    """(folder, path, length, modified, keys): one row per Parquet file, with its partition values as text.

    A file without rows is listed too, which a scan of the rows would miss.  ``pattern`` narrows the
    directories that are listed at all.
    """
    files = _list_files(spark, f"{path}/{pattern}", ".parquet", basePath=path)
    if files is None or not set(keys) <= set(files.columns):
        columns = ["folder string", "path string", "length long", "modified timestamp", *[f"{k} string" for k in keys]]
        return local_table(spark, [], ", ".join(columns))
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    modified = F.col("modificationTime").alias("modified")
    return files.select(folder, "path", "length", modified, *[F.col(k).cast("string").alias(k) for k in keys])


def _year_pattern(key: str, years: tuple[int | None, int | None], rest: str = "") -> str:
    """Directories of the given years; all directories when the years are open-ended."""
    low, high = years
    if low is None or high is None or high < low:
        return ""
    return f"symbol=*/{key}={{{','.join(f'{y:04d}' for y in range(low, high + 1))}}}{rest}"


def within_years(df: DataFrame, years: tuple[int | None, int | None]) -> DataFrame:
    low, high = years
    if low is not None:
        df = df.where(F.col("year") >= low)
    return df if high is None else df.where(F.col("year") <= high)


def day_listing(spark: SparkSession, daily_path: str, years: tuple[int | None, int | None] = ANY_YEAR) -> DataFrame:
    """(symbol, date, year, day, folder, bytes, n_files): days that have a file; malformed day directories are
    dropped.  ``day`` is the directory value, ``date`` the same as a date."""
    files = list_partitions(spark, daily_path, DAILY_KEYS, _year_pattern("date", years, "-*"))
    days = files.withColumnRenamed("date", "day").groupBy("symbol", "day")
    days = days.agg(F.min("folder").alias("folder"), F.sum("length").alias("bytes"), F.count("*").alias("n_files"))
    days = days.withColumn("date", day_of_value(F.col("day"))).withColumn("year", F.year("date"))
    return _listing(within_years(days.where("date is not null"), years), "days")


def year_listing(spark: SparkSession, yearly_path: str, years: tuple[int | None, int | None] = ANY_YEAR) -> DataFrame:
    """(symbol, year, folder, bytes, n_files, fingerprint): years that have a file.  ``fingerprint`` is of the names,
    lengths and times of the files."""
    files = list_partitions(spark, yearly_path, YEARLY_KEYS, _year_pattern("year", years))
    found = files.withColumn("year", F.col("year").try_cast("int")).where("year is not null")
    sums = [F.min("folder").alias("folder"), F.sum("length").alias("bytes"), F.count("*").alias("n_files")]
    fingerprint = F.bit_xor(F.xxhash64("path", "length", "modified")).alias("fingerprint")
    found = found.groupBy("symbol", "year").agg(*sums, fingerprint)
    return _listing(within_years(found, years), "years")


def landed_listing(spark: SparkSession, landing_path: str) -> DataFrame:
    """(file_path, source, bytes, modified, id, date): landed CSV files, id and day taken from the file name.

    Files may lie in subfolders, and a day may be a folder of CSV parts, as Spark writes it; ``source`` is the file or
    that folder.  Spark lists no file of zero bytes, so such a day counts as not landed.
    """
    files = _list_files(spark, landing_path, ".csv", recursiveFileLookup=True)
    if files is None:
        return local_table(spark, [], "file_path string, source string, bytes long, modified timestamp, id string, date date")
    path = F.col("_metadata.file_path")  # special characters are escaped in it; a plus sign is not
    vendor_id = F.regexp_extract(path, LANDED_NAME, 1)
    landed = files.select(
        path.alias("file_path"),
        F.regexp_extract(path, r"^(.*-s1-bid-[^/]*\.csv)(?:/[^/]*)?$", 1).alias("source"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
        F.url_decode(F.replace(vendor_id, F.lit("+"), F.lit("%2B"))).alias("id"),
        day_of_text(F.regexp_extract(path, LANDED_NAME, 2)).alias("date"),
    )
    return _listing(landed.where("date is not null"), "landed")


def days_of_keys(listing: DataFrame, key: str = "key") -> DataFrame:
    """Add ``day`` to rows of listing keys and drop the rows whose key names no day."""
    return listing.withColumn("day", day_of_key(F.coalesce(F.col(key), F.lit("")))).where("day is not null")


def read_key_listing(spark: SparkSession, path: str) -> DataFrame:
    """(key, day) of an exported object listing: JSON lines with a ``key`` field."""
    return days_of_keys(spark.read.schema("key string").json(path))


def read_key_days(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    """(symbol, date, year, day, folder, bytes, n_files) of an exported object listing, as :func:`day_listing` gives
    them of directories.  The listing is JSON lines with ``key`` and, if it has it, ``size``.

    Keys are those of day directories or of files in them; the symbol is taken from the key, or is ``symbol`` for keys
    that have none.  Keys without a day or a symbol are dropped.  A day listed as a directory alone has no bytes.
    """
    rows = spark.read.schema("key string, size long").json(path)
    key = F.coalesce("key", F.lit(""))
    parsed = rows.select(
        F.coalesce(symbol_of_key(key), F.lit(symbol)).alias("symbol"), day_of_file_key(key).alias("date"),
        F.regexp_extract(key, r"(?:^|/)date=([^/]*)/", 1).alias("day"), F.regexp_extract(key, r"^(.*date=[^/]*)/", 1).alias("folder"),
        F.when(key.endswith("/"), 0).otherwise(F.coalesce("size", F.lit(0))).alias("bytes"),
        F.when(key.endswith("/"), 0).otherwise(1).alias("file"),
    ).where("date is not null and symbol is not null")
    days = parsed.groupBy("symbol", "date", "day").agg(
        F.min("folder").alias("folder"), F.sum("bytes").alias("bytes"), F.sum("file").alias("n_files")
    )
    return _listing(days.withColumn("year", F.year("date")).select(*DAY_COLUMNS), "keys")
