"""Landed CSV day files.

Spark's CSV reader assigns columns by position, while a landed file states its columns by name, in any
order and number.  Where all files have the same header, Spark checks that while it reads.  Else the
header lines are looked up first, and all files are read in one scan and put right by name.
"""

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.bars import any_of
from barloom.schema import MISSING
from barloom.session import names_of, work_table

RESERVED = {"symbol", "date"}  # the columns that a day gets from its file name
_CORRUPT = "_corrupt"
_FILES = {"pathGlobFilter": "*.csv", "recursiveFileLookup": True}


def _paths(files: DataFrame) -> list[str]:
    """Files to read, by name, however many."""
    return names_of(files, "file_path", decode=True)


def first_header(spark: SparkSession, files: DataFrame) -> list[str] | None:
    """Columns that the first of the files names; None when it names no ``timestamp``."""
    path = names_of(files.agg(F.min("file_path").alias("file_path")), "file_path", decode=True)
    line = spark.read.text(path).where(F.trim("value") != "").first()
    names = [] if line is None else split_header(line.value)
    return names if "timestamp" in names else None


def is_other_header(error: Exception) -> bool:
    """Was a read with stated columns refused because of a file's header?"""
    return "CSV header" in str(error)


def header_lines(spark: SparkSession, paths: list[str], files: DataFrame) -> DataFrame:
    """(file_path, header): the first line that is not blank of each of the files."""
    lines = (
        spark.read.options(**_FILES)
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("at"),
            "value",
        )
        .where((F.col("start") == 0) & (F.trim("value") != ""))
        .join(files.select("file_path"), "file_path", "left_semi")
    )
    return lines.groupBy("file_path").agg(F.min_by("value", "at").alias("header"))


def line_digests(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(source, digest) of files (file_path, source): the same for equal lines, whatever their order and parts.

    Lines are hashed where they are read and only sums are shuffled, so a file may be of any size.
    """
    lines = spark.read.options(**_FILES).text(_paths(files)).select(F.col("_metadata.file_path").alias("file_path"), "value")
    lines = lines.join(files.select("file_path", "source"), "file_path")
    wide = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(38,0)")).cast("string")
    sums = F.concat_ws("-", F.count("*").cast("string"), wide("value"), wide(F.lit(1), "value"))
    return lines.groupBy("source").agg(F.sha2(sums, 256).alias("digest"))


def split_header(line: str) -> list[str]:
    names = next(csv.reader([line.lstrip("\ufeff")]))
    folded = {name.lower() for name in names}
    if len(folded) < len(names) or folded & RESERVED:
        raise ValueError(f"a landed file repeats a column, or names one of {sorted(RESERVED)}: {line}")
    return names


def _field(name: str) -> Column:
    return F.when(~F.col(name).isin(*MISSING), F.col(name))


def read_landed(
    spark: SparkSession,
    landing_path: str,
    files: DataFrame,
    columns: list[str] | None = None,
) -> DataFrame:
    """Text fields of the rows of ``files`` (file_path, symbol, date), under the names of their headers,
    with ``_pos`` for the row order and ``_surplus`` for rows with more fields than names.

    ``columns`` states the header of all files; then no header is looked up, and a file whose header
    differs fails the read.
    """
    paths = _paths(files)
    if columns is None:
        headers = work_table(header_lines(spark, paths, files), "headers")
        lines = [row.header for row in headers.select("header").distinct().orderBy("header").collect()]
        layouts = [split_header(line) for line in lines]
    else:
        layouts = [list(columns)]
    width = max((len(names) for names in layouts), default=1)
    fields = [f"f{i}" for i in range(width)]
    stated = columns is not None
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in (columns if stated else fields)]
        + [T.StructField(_CORRUPT, T.StringType())]
    )
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", not stated)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("escape", '"')
        .options(**_FILES)
        .csv(paths)
        .select("*", F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("_pos"))
    )
    if stated:
        rows = rows.withColumnsRenamed(dict(zip(columns, fields)))
    if len(layouts) > 1:
        files = files.join(headers, "file_path")
    rows = rows.join(files, "file_path")
    unquoted = F.regexp_replace(_CORRUPT, '"[^"]*"', "")
    surplus = F.when(F.col(_CORRUPT).isNotNull(), F.size(F.split(unquoted, ","))).otherwise(0)
    no_stamp = [F.lit(None).cast("string").alias("timestamp")]
    if len(layouts) <= 1:
        names = layouts[0] if layouts else []
        picked = [_field(f).alias(name) for f, name in zip(fields, names)]
        picked += [] if "timestamp" in names else no_stamp
        return rows.select("symbol", *picked, "date", "_pos", (surplus > width).alias("_surplus"))
    of_layout = [F.col("header") == line for line in lines]
    picked = [] if any("timestamp" in names for names in layouts) else no_stamp
    for name in dict.fromkeys(name for names in layouts for name in names):
        value = F.lit(None).cast("string")
        for is_layout, names in zip(of_layout, layouts):
            if name in names:
                value = F.when(is_layout, _field(fields[names.index(name)])).otherwise(value)
        picked.append(value.alias(name))
    beyond = [
        is_layout & ((surplus > len(names)) | any_of([F.col(f).isNotNull() for f in fields[len(names) :]]))
        for is_layout, names in zip(of_layout, layouts)
    ]
    return rows.select("symbol", *picked, "date", "_pos", any_of(beyond).alias("_surplus"))
