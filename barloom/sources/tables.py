"""Daily and yearly bar tables."""

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.bars import prices_as_double, with_lacking, with_utc_stamp
from barloom.schema import YEARLY_KEYS
from barloom.session import literal_path, names_of
from barloom.sources.health import layouts, other_types
from barloom.sources.listings import or_none


class TypesDiffer(ValueError):
    """Files that no one schema reads."""


def _load(spark: SparkSession, base: str, paths: list[str], strict: bool = False, **options) -> DataFrame:
    """With ``strict`` the rows of a file without a price column can be told from those without a price."""
    reader = spark.read.options(basePath=base, **options)
    try:
        bars = reader.parquet(*paths)
        if strict:
            bars = reader.schema(with_lacking(bars.schema)).parquet(*paths)
        return with_utc_stamp(bars)
    except Py4JJavaError as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error.java_exception):
            raise
        raise TypesDiffer(f"column types differ between files of {base}; see merge_schema") from error


def read_bars(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame | None:
    """A partitioned bar table, or None when there is none yet.

    With ``merge_schema`` a column that only some files have is kept, and null in the others; files
    whose types differ are an error.  Without it Spark takes the columns of one file, which saves
    opening every footer and reads foreign zero-row files, whose ``symbol`` column has no type.
    """
    return or_none(lambda: _load(spark, path, [path], mergeSchema=merge_schema))


def read_listed(
    spark: SparkSession,
    path: str,
    listing: DataFrame,
    key: str,
    merge_schema: bool = True,
    skip_unreadable: bool = False,
    strict: bool = False,
) -> DataFrame | None:
    """Bars of the listed partitions of a table, or None when nothing is listed.

    A listing has ``folder``.  Folders are
    read by name, however many, so that no other directory is listed, no other footer opened, and the
    columns are those of the listed files.  A listed folder that is not there is an error.  With
    ``skip_unreadable`` files that are not Parquet have no rows; None when there is no other file.
    ``strict`` is for ``cast_required``: it finds files that lack a price column which others have.
    Where types differ between files, each group of equal types is read by itself; prices and stamps may differ,
    other columns may not.
    """
    options = {"mergeSchema": merge_schema, "ignoreCorruptFiles": skip_unreadable, "strict": strict}
    load = lambda paths: _load(spark, path, paths, **options)
    folders = names_of(listing, "folder")
    if not folders:
        return None
    try:
        return or_none(lambda: load(folders)) if skip_unreadable else load(folders)
    except TypesDiffer as error:
        return _by_layout(spark, path, listing, error, strict, skip_unreadable)


def _by_layout(
    spark: SparkSession, path: str, listing: DataFrame, error: Exception, strict: bool, skip_unreadable: bool
) -> DataFrame:
    """Folders of each layout in a read of their own, put together by name.  Prices become double and stamps
    timestamps; any other column must have one type."""
    groups, mixed = layouts(spark, path, sorted(row[0] for row in listing.select("folder").toLocalIterator()))
    if mixed or any(other_types(group.schema, groups[0].schema) for group in groups):
        raise error
    parts = []
    for group in groups:
        read = spark.read.options(basePath=path, ignoreCorruptFiles=skip_unreadable)
        schema = with_lacking(group.schema) if strict else group.schema
        parts.append(prices_as_double(with_utc_stamp(read.schema(schema).parquet(*map(literal_path, group.folders))), strict))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def bar_columns(df: DataFrame, *keys: str) -> list[str]:
    """``symbol`` first, the file's columns in their order, the other partition keys last."""
    return ["symbol", *[c for c in df.columns if c != "symbol" and c not in keys], *keys]


def time_order(df: DataFrame) -> list[str]:
    """Sort columns of a yearly table: the partition keys, the stamp, then all else.

    No two rows of a de-duplicated table are equal in all of them, so a range partitioning on this
    order can split any group, however many rows share one symbol or even one minute.
    """
    sortable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    first = [*YEARLY_KEYS, "timestamp"]
    return first + [c for c in sortable if c not in first]


def append_daily(bars: DataFrame, path: str, position: str = "_pos", replace: bool = False) -> None:
    """Add days, or with ``replace`` write these days anew.  Rows stay where they were read, so nothing is
    shuffled; ``position`` keeps their order inside a day, which is all that tells the seconds of one
    minute apart."""
    writer = bars.sortWithinPartitions("symbol", "date", position).drop(position).write.partitionBy("symbol", "date")
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def write_years(bars: DataFrame, path: str, partitions: int, distinct: bool = False) -> None:
    """Write years in time order: files of one year do not overlap in time.

    Equal rows are in one range, so with ``distinct`` they are dropped there without a shuffle of their own.
    """
    order = time_order(bars)
    ranged = bars.repartitionByRange(partitions, *order)
    if distinct:
        ranged = ranged.dropDuplicates()
    ranged.sortWithinPartitions(*order).write.partitionBy(*YEARLY_KEYS).parquet(path)


def count_rows(bars: DataFrame, *keys: str) -> DataFrame:
    """Rows per partition; only footers are read."""
    return bars.groupBy(*keys).agg(F.count("*").alias("n_rows"))
