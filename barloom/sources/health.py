"""Which listed files cannot be read, or not together with the others.

A tolerant scan skips what it cannot read without a word.  What it returned is therefore held against the
listing, and only what is missing there is read again, strictly and in ever smaller lots.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schema import OHLCV
from barloom.session import literal_path, local_table, work_table
from barloom.sources.listings import or_none

FAILURES = (PySparkException, Py4JJavaError)  # how a failed job reaches Python
UNREADABLE = "a file cannot be read"
_FAULTS = "folder string, reason string"


@dataclass
class Layout:
    """Folders whose files can be read with one schema."""

    schema: T.StructType
    folders: list[str] = field(default_factory=list)


def _lots(folders: list[str], works: Callable[[list[str]], bool]) -> tuple[list[list[str]], list[str]]:
    """Lots of neighbouring folders that work, as large as they can be by halving, and the folders that do not.
    One attempt if all work; a few for each that does not."""
    if not folders:
        return [], []
    if works(folders):
        return [folders], []
    if len(folders) == 1:
        return [], folders
    middle = len(folders) // 2
    good, bad = _lots(folders[:middle], works)
    more, worse = _lots(folders[middle:], works)
    return good + more, bad + worse


def _folders(listing: DataFrame) -> list[str]:
    return sorted(row[0] for row in listing.select("folder").toLocalIterator())


def _faults(spark: SparkSession, folders: list[str], reason: str) -> DataFrame:
    return local_table(spark, [{"folder": folder, "reason": reason} for folder in folders], _FAULTS)


def broken_folders(spark: SparkSession, path: str, listing: DataFrame) -> DataFrame:
    """(folder, reason) of listed folders with a file that is not Parquet.  Only footers are read."""

    def readable(folders: list[str]) -> bool:
        reader = spark.read.schema("symbol string").option("basePath", path)
        try:
            reader.parquet(*map(literal_path, folders)).groupBy().count().collect()
        except FAILURES:
            return False
        return True

    return _faults(spark, _lots(_folders(listing), readable)[1], UNREADABLE)


def unreadable_folders(spark: SparkSession, path: str, listing: DataFrame, key: str) -> DataFrame:
    """(folder, reason) of listed folders (symbol, ``key``, folder, n_files) with a file that cannot be read.

    A tolerant scan that opens footers alone tells which files have rows.  Days of which it saw fewer files than
    the listing has, for a file without rows or one that is broken, are read again by themselves.
    """
    folders = _folders(listing)
    if not folders:
        return _faults(spark, [], UNREADABLE)
    reader = spark.read.schema(f"symbol string, {key} string").options(basePath=path, ignoreCorruptFiles=True)
    rows = reader.parquet(*map(literal_path, folders)).select("symbol", key, F.col("_metadata.file_path").alias("file"))
    seen = work_table(rows.groupBy("symbol", key).agg(F.count_distinct("file").alias("n_seen")), "seen")
    known = listing.withColumn(key, F.col(key).cast("string")).join(seen, ["symbol", key], "left")
    return broken_folders(spark, path, known.where(F.coalesce("n_seen", F.lit(0)) < F.col("n_files")))


def _merged(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """Columns of both, or None where one has another type in each."""
    have = {f.name: f.dataType for f in a}
    if any(have.get(f.name, f.dataType) != f.dataType for f in b):
        return None
    return T.StructType([*a.fields, *(f for f in b if f.name not in have)])


def layouts(spark: SparkSession, path: str, folders: list[str]) -> tuple[list[Layout], list[str]]:
    """Groups of folders by the types of their columns, the largest first, and folders whose own files differ.

    One schema is merged from all footers if that can be done; else halves are tried, so that the work grows with
    the number of places where types change, and lots that agree are put together again.
    """
    schemas = {}

    def agree(lot: list[str]) -> bool:
        reader = spark.read.options(basePath=path, mergeSchema=True, ignoreCorruptFiles=True)
        try:
            read = or_none(lambda: reader.parquet(*map(literal_path, lot)))
            schemas[lot[0], len(lot)] = T.StructType() if read is None else read.schema
        except Py4JJavaError as error:
            if "CANNOT_MERGE_SCHEMAS" not in str(error.java_exception):
                raise
            return False
        return True

    lots, mixed = _lots(folders, agree)
    groups: list[Layout] = []
    for lot in sorted(lots, key=len, reverse=True):
        schema = schemas[lot[0], len(lot)]
        for group in groups:
            both = _merged(group.schema, schema)
            if both is not None:
                group.schema, group.folders = both, group.folders + lot
                break
        else:
            groups.append(Layout(schema, lot))
    return sorted(groups, key=lambda g: -len(g.folders)), mixed


def other_types(schema: T.StructType, main: T.StructType) -> list[str]:
    """Columns that have another type than in ``main``.  Prices are cast in any case, and a stamp may be a count of
    nanoseconds."""
    have = {f.name: f.dataType for f in main}
    free = {"timestamp"} if {T.LongType()} & {have.get("timestamp"), dict((f.name, f.dataType) for f in schema).get("timestamp")} else set()
    return [f.name for f in schema if f.name not in {*OHLCV, *free} and have.get(f.name, f.dataType) != f.dataType]


def differing_folders(spark: SparkSession, path: str, listing: DataFrame) -> DataFrame:
    """(folder, reason) of listed folders with a column of another type than in most folders."""
    folders = _folders(listing)
    if not folders:
        return _faults(spark, [], "")
    groups, mixed = layouts(spark, path, folders)
    faults = _faults(spark, mixed, "files of one day have different types")
    for group in groups[1:]:
        names = other_types(group.schema, groups[0].schema)
        if names:
            faults = faults.unionByName(_faults(spark, group.folders, f"another type of {', '.join(names)}"))
    return faults
