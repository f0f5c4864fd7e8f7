"""Daily bars to yearly bars, for all symbols and years in one job."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.bars import cast_required, lacking_fault
from barloom.operators.merge import check_mode, distinct_bars, new_days
from barloom.operators.symbols import requested_symbols
from barloom.schema import ANY_YEAR, YEARLY_KEYS
from barloom.session import local_table, prepare, scratch_path, shuffle_width, work_table
from barloom.sources.health import UNREADABLE, differing_folders, unreadable_folders
from barloom.sources.inventory import known_days
from barloom.sources.listings import day_listing, year_listing
from barloom.sources.publish import free, publish_years, unfinished
from barloom.sources.statistics import added, keep_statistics, known_statistics, statistics_of
from barloom.sources.tables import bar_columns, count_rows, read_bars, read_listed, time_order, write_years

TARGET_ROWS = 4_000_000  # of a task and a file of a year
LEAST_ROWS = 500_000  # of a task, as long as there are cores without one
MAX_RANGES = 20_000  # more rows make the ranges larger, since a shuffle has map tasks times ranges blocks
MAX_COPIES = 1_000_000  # rows that may be equal and still go to one task undropped


def _years(spark: SparkSession, path: str, listing: DataFrame, merge_schema: bool) -> DataFrame | None:
    """Bars of the listed years."""
    listing = listing.withColumn("year", F.col("year").cast("string"))
    bars = read_listed(spark, path, listing, "year", merge_schema, strict=True)
    if bars is None:
        return None
    return cast_required(bars).withColumn("year", F.col("year").cast("int")).select(*bar_columns(bars, "year"))


def _days(spark: SparkSession, path: str, listing: DataFrame, merge_schema: bool, tolerant: bool = False) -> DataFrame:
    """Bars of the listed days as they are in the files, with ``year`` and ``date`` of their directory."""
    listing = listing.select("folder", "symbol", F.col("day").alias("date"))
    bars = read_listed(spark, path, listing, "date", merge_schema, tolerant, strict=True)
    bars = bars.withColumn("date", F.to_date("date")).withColumn("year", F.year("date"))
    return bars.select(*bar_columns(bars, "year", "date"))


def _read_days(spark: SparkSession, path: str, wanted: DataFrame, merge_schema: bool, tolerant: bool) -> DataFrame:
    """(symbol, year, n_rows_in, n_stray, n_largest, reason) of the days to merge.

    The prices are read for this only if it is ``tolerant``; then all columns are, and a day that gives other rows than
    its footers promise has a file that cannot be read.
    """
    raw = _days(spark, path, wanted, merge_schema, tolerant)
    keys = [*YEARLY_KEYS, "date"]
    # Rows whose stamp lies on another day than their directory may equal a row the year has already.
    stray = F.to_date("timestamp").isNull() | (F.to_date("timestamp") != F.col("date"))
    fault = lacking_fault(raw) if tolerant else F.lit(None).cast("string")
    sums = [F.count("*").alias("n"), F.count_if(stray).alias("n_stray"), F.max(fault).alias("reason")]
    if tolerant:
        every = F.bit_xor(F.xxhash64(*[F.col(c) for c in time_order(raw)]))  # reads all pages
        counted = count_rows(raw, *keys)
        by_day = counted.join(raw.groupBy(*keys).agg(*sums, every.alias("every")), keys, "left")
        short = F.when(F.coalesce("n", F.lit(0)) != F.col("n_rows"), UNREADABLE)
        by_day = by_day.withColumn("reason", F.coalesce(short, F.when(F.col("every").isNotNull(), F.col("reason"))))
    else:
        by_day = raw.groupBy(*keys).agg(*sums)
    read = by_day.groupBy(*YEARLY_KEYS).agg(
        F.sum("n").alias("n_rows_in"),
        F.sum("n_stray").alias("n_stray"),
        F.max("n").alias("n_largest"),
        F.max("reason").alias("reason"),
    )
    return work_table(read, "read")


def year_statistics(
    spark: SparkSession, yearly_path: str, years: tuple[int | None, int | None] = ANY_YEAR, merge_schema: bool = True
) -> DataFrame:
    """(symbol, year, n_rows, last_day, days) of a yearly table.  Files are opened of those years only that were written
    by something else than ``consolidate`` since the last call."""
    return _known(prepare(spark), yearly_path, year_listing(spark, yearly_path, years), merge_schema, years)


def _known(spark: SparkSession, path: str, held: DataFrame, merge_schema: bool, years=ANY_YEAR) -> DataFrame:
    return known_statistics(spark, path, held, lambda stale: _years(spark, path, stale, merge_schema), years)


def _ranges(n_rows: int, target_rows: int, cores: int) -> int:
    """Number of ranges for a number of rows, which is known from footers."""
    wanted = max(-(-n_rows // target_rows), min(cores, n_rows // LEAST_ROWS))
    return min(max(wanted, 1), MAX_RANGES)


def _stage(bars: DataFrame, staging: str, n_rows: int, target_rows: int, distinct: bool = False) -> DataFrame:
    """Write years to scratch and return them."""
    spark = bars.sparkSession
    ranges = _ranges(n_rows, target_rows, spark.sparkContext.defaultParallelism)
    with shuffle_width(spark, ranges):
        write_years(bars, staging, ranges, distinct)
    staged = read_bars(spark, staging, merge_schema=False)
    return staged.withColumn("year", F.col("year").cast("int")).select(*bars.columns)


def _finish(spark: SparkSession, yearly_path: str, merge_schema: bool, target_rows: int) -> None:
    """Finish the publication of a run that was cut off."""
    cut_off = unfinished(spark, yearly_path)
    if cut_off is None:
        return
    staged = read_bars(spark, cut_off.staging, merge_schema=False)
    if staged is None or "symbol" not in staged.columns:
        raise RuntimeError(f"a run was cut off while it published {cut_off.staging}, which is gone")
    if not cut_off.extends:
        publish_years(spark, cut_off.staging, yearly_path, extends=False)
        return
    # Some of the files may be in place already: a distinct with what is there leaves each row once.
    staged = cast_required(staged).withColumn("year", F.col("year").cast("int"))
    held = year_listing(spark, yearly_path).join(staged.select(*YEARLY_KEYS).distinct(), YEARLY_KEYS, "left_semi")
    merged = _years(spark, yearly_path, held, merge_schema).unionByName(staged)
    again = scratch_path(spark, "staged")
    _stage(merged, again, merged.count(), target_rows, distinct=True)  # at most two copies of a row
    publish_years(spark, again, yearly_path, extends=False)
    free(spark, cut_off.staging)


def consolidate(
    spark: SparkSession,
    daily_path: str,
    yearly_path: str,
    mode: str = "hwm",
    years: tuple[int | None, int | None] = ANY_YEAR,
    symbols: str | None = None,
    extend: bool = False,
    target_rows: int = TARGET_ROWS,
    merge_schema: bool = True,
    catalog: DataFrame | None = None,
    on_bad: str = "raise",
    inventory: str | None = None,
) -> DataFrame:
    """Merge new days into their years and return the run's summary, one row per symbol and year.

    With a ``catalog`` (``symbol``, ...) only its symbols are consolidated.  A file that cannot be read, lacks
    a price column which others have, or has a column of another type than most (prices are cast, so theirs may
    differ) fails the run; with ``on_bad="skip"`` its symbol and year stay as they are, the
    others go on, and the summary shows them with status ``error`` and a ``reason``.

    With an ``inventory`` (see ``refresh_inventory``) the days it knows are taken, and no directory of days is listed.

    ``mode="hwm"`` takes days after the last day of their symbol and year; ``"missing_days"`` takes all
    days the year has no row of; both are known from the statistics of each year (see ``year_statistics``).  ``years`` bounds the years, both ends included; a nightly run gives
    the running year, so that only its directories are listed and read.  Only years with new days are
    written: first to scratch, where they are checked, then in place of the old ones.

    ``extend`` adds the new days as further files and leaves the old ones as they are, so that a run
    costs as much as its new days.  The rows are the same; a later run without it joins the files.  It
    applies in mode ``hwm``, where new days lie after all old rows; else the years are rewritten.
    """
    check_mode(mode)
    if on_bad not in ("raise", "skip"):
        raise ValueError(f"on_bad must be 'raise' or 'skip', not {on_bad!r}")
    prepare(spark)
    _finish(spark, yearly_path, merge_schema, target_rows)
    days = day_listing(spark, daily_path, years) if inventory is None else known_days(spark, inventory, years)
    if symbols is not None:
        days = days.join(requested_symbols(spark, symbols), "symbol", "left_semi")
    if catalog is not None:
        days = days.join(catalog.select("symbol"), "symbol", "left_semi")
    held = year_listing(spark, yearly_path, years).join(days, YEARLY_KEYS, "left_semi")
    faults = None
    if on_bad == "skip":
        faults = work_table(_faulty_years(spark, yearly_path, held, "year", merge_schema), "faults")
        held = work_table(held.join(faults, YEARLY_KEYS, "left_anti"), "held")
    known = _known(spark, yearly_path, held, merge_schema, years)
    wanted = work_table(new_days(known, _without(days, faults), mode), "wanted")
    if on_bad == "skip":
        faults = work_table(faults.unionByName(_faulty_years(spark, daily_path, wanted, "date", merge_schema)), "faults")
        wanted = work_table(_without(wanted, faults), "wanted")
    if wanted.isEmpty():
        return work_table(_with_errors(_summary(days, None, known), faults), "summary")

    touched = wanted.groupBy(*YEARLY_KEYS).agg(F.count_distinct("date").alias("n_days"))
    read = _read_days(spark, daily_path, wanted, merge_schema, tolerant=on_bad == "skip")
    bad = None
    if on_bad == "skip":
        bad = work_table(read.where("reason is not null").select(*YEARLY_KEYS, "reason").unionByName(faults), "bad")
        read, wanted, touched = (_without(listing, bad) for listing in (read, wanted, touched))
    n_new, n_stray, n_largest = read.agg(F.sum("n_rows_in"), F.sum("n_stray"), F.max("n_largest")).first()
    if n_new is None:
        return work_table(_with_errors(_summary(days, touched, known), bad), "summary")
    new = cast_required(_days(spark, daily_path, wanted, merge_schema)).drop("date")
    extend = extend and mode == "hwm" and not n_stray
    held = held.join(touched, YEARLY_KEYS, "left_semi")
    old = _years(spark, yearly_path, held, merge_schema)
    n_old = 0 if old is None or extend else known.join(held, YEARLY_KEYS, "left_semi").agg(F.sum("n_rows")).first()[0] or 0
    # Equal rows share a stamp and so, but for strays, a day: a small largest day bounds their number.
    few_copies = n_largest + n_stray <= MAX_COPIES
    if old is None or extend:
        bars, distinct = new if old is None else new.select(*old.columns), True
    elif n_stray:
        bars, distinct = old.unionByName(new), True
    else:
        # Years hold no duplicates, and a day is merged only when its year has no row of that day, so the
        # old rows need no distinct.
        bars, distinct = old.unionByName(distinct_bars(new)), False
    if distinct and not few_copies:
        bars, distinct = distinct_bars(bars), False

    staging = scratch_path(spark, "staged")
    staged = work_table(statistics_of(_stage(bars, staging, n_old + n_new, target_rows, distinct)), "statistics")
    results = work_table(_summary(days, touched, known, read, staged, extend), "summary")
    _check(results, n_stray, extend)
    publish_years(spark, staging, yearly_path, extend)
    _keep(spark, yearly_path, added(known, staged) if extend else staged)
    return _with_errors(results.drop("n_rows_old", "n_rows_staged"), bad)


def _keep(spark: SparkSession, path: str, statistics: DataFrame) -> None:
    """Record statistics of years that have just been put in place."""
    years = statistics.agg(F.min("year"), F.max("year")).first()
    held = year_listing(spark, path, tuple(years)).join(statistics, YEARLY_KEYS, "left_semi")
    keep_statistics(spark, path, held, statistics)


def _faulty_years(spark: SparkSession, path: str, listing: DataFrame, key: str, merge_schema: bool) -> DataFrame:
    """(symbol, year, reason) of the listed symbols and years that have a file which cannot be read, or not with the
    others; of a year with several faults the first by text."""
    named = listing.withColumn("date", F.col("day")) if key == "date" else listing
    bad = work_table(unreadable_folders(spark, path, named, key), "unreadable")
    if merge_schema:
        bad = bad.unionByName(differing_folders(spark, path, listing.join(bad, "folder", "left_anti")))
    return listing.join(bad, "folder").groupBy(*YEARLY_KEYS).agg(F.min("reason").alias("reason"))


def _without(listing: DataFrame, faults: DataFrame | None) -> DataFrame:
    return listing if faults is None else listing.join(faults, YEARLY_KEYS, "left_anti")


def _with_errors(results: DataFrame, bad: DataFrame | None) -> DataFrame:
    """The summary with status ``error`` and the reason for symbols and years that were skipped."""
    if bad is None:
        return results
    status = F.when(F.col("reason").isNotNull(), "error").otherwise(F.col("status"))
    return results.join(bad, YEARLY_KEYS, "left").withColumn("status", status)


def consolidate_history(
    spark: SparkSession, daily_path: str, yearly_path: str, limit: int, first: int | None = None, **options
) -> DataFrame:
    """Consolidate all years that have days, up to and including ``limit``."""
    return consolidate(spark, daily_path, yearly_path, years=(first, limit), **options)


def _summary(days, touched, known, read=None, staged=None, extend=False) -> DataFrame:
    """(symbol, year, n_days, n_rows_in, n_rows_out, status) and, of a run that staged years, also
    ``n_rows_old`` and ``n_rows_staged``."""
    groups = days.select(*YEARLY_KEYS).distinct()
    spark = days.sparkSession
    old = known.select(*YEARLY_KEYS, "n_rows")
    out = local_table(spark, [], "symbol string, year int, n_rows long") if staged is None else staged.select(*old.columns)
    if touched is None:
        touched = local_table(spark, [], "symbol string, year int, n_days long")
    if read is None:
        read = local_table(spark, [], "symbol string, year int, n_rows_in long")
    zero = F.lit(0).cast("long")
    counts = ["n_days", "n_rows_in", "n_rows_old", "n_rows_staged"]
    joined = (
        groups.join(touched, YEARLY_KEYS, "left")
        .join(read.select(*YEARLY_KEYS, "n_rows_in"), YEARLY_KEYS, "left")
        .join(old.withColumnRenamed("n_rows", "n_rows_old"), YEARLY_KEYS, "left")
        .join(out.withColumnRenamed("n_rows", "n_rows_staged"), YEARLY_KEYS, "left")
        .withColumn("status", F.when(F.col("n_days").isNotNull(), "merged").otherwise("up_to_date"))
        .withColumns({c: F.coalesce(c, zero) for c in counts})
    )
    old, staged_rows = F.col("n_rows_old"), F.col("n_rows_staged")
    rows_out = old + staged_rows if extend else F.when(staged_rows > 0, staged_rows).otherwise(old)
    results = joined.withColumn("n_rows_out", rows_out)
    results = results.select("symbol", "year", "n_days", "n_rows_in", "n_rows_out", "status", *counts[2:])
    return results if staged is not None else results.drop(*counts[2:])


def _check(results: DataFrame, n_stray: int, extend: bool) -> None:
    """Staged years hold some row of what they are made of and no more rows than that; a rewritten year
    keeps every old row unless the old rows went through the distinct, too."""
    staged, old, new = F.col("n_rows_staged"), F.col("n_rows_old"), F.col("n_rows_in")
    source = new if extend else old + new
    wrong = (staged > source) | ((staged == 0) & (source > 0))
    if not (extend or n_stray):
        wrong = wrong | (staged < old)
    found = results.where((F.col("status") == "merged") & wrong).count()
    if found:
        raise RuntimeError(f"{found} staged years do not hold the rows they should; nothing was replaced")
