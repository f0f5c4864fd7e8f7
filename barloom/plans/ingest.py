"""Landed CSV day files to the daily table."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.bars import parse_bars, parse_fault, read_fields
from barloom.operators.days import with_landed
from barloom.operators.symbols import with_catalog
from barloom.session import prepare, work_table
from barloom.sources.health import FAILURES
from barloom.sources.landing import first_header, is_other_header, read_landed
from barloom.sources.ledger import record, settle
from barloom.sources.listings import day_listing, landed_listing
from barloom.sources.publish import clear_days, mark_days, unfinished_days
from barloom.sources.tables import append_daily

RESULT = ["symbol", "id", "date", "status"]


class BadRows(ValueError):
    """Landed rows that are not bars."""


def landed_work(
    spark: SparkSession,
    landing_path: str,
    catalog: DataFrame,
    daily_path: str,
    plan: DataFrame | None = None,
    unfinished: DataFrame | None = None,
) -> DataFrame:
    """(file_path, source, bytes, modified, symbol, id, date, status) of landed files of catalog ids.

    ``exists``: the day is there and is left alone; else ``wanted``.  A file without bytes is not
    listed, as if it had not landed.  With ``plan`` (symbol, id, date) only planned days are listed.
    Days that are ``unfinished`` are wanted in any case.
    """
    landed = landed_listing(spark, landing_path)
    years = landed.agg(F.year(F.min("date")), F.year(F.max("date"))).first()
    work = with_catalog(landed, catalog.select("id", "symbol"))
    if plan is not None:
        days = plan.select("symbol", "date")
        days = days if unfinished is None else days.unionByName(unfinished)
        work = work.join(days.distinct(), ["symbol", "date"], "left_semi")
    there = day_listing(spark, daily_path, tuple(years)).select("symbol", "date")
    if unfinished is not None:
        there = there.join(unfinished, ["symbol", "date"], "left_anti")
    work = work.join(there.withColumn("there", F.lit(True)), ["symbol", "date"], "left")
    status = F.when(F.col("there"), "exists").otherwise("wanted")
    return work.select("file_path", "source", "bytes", "modified", "symbol", "id", "date", status.alias("status"))


def _check_unfinished(spark: SparkSession, daily_path: str, unfinished: DataFrame, wanted: DataFrame) -> None:
    there = unfinished.join(day_listing(spark, daily_path), ["symbol", "date"], "left_semi")
    gone = there.join(wanted, ["symbol", "date"], "left_anti").count()
    if gone:
        raise RuntimeError(f"a run was cut off; {gone} days may be there in part, and their CSV files are gone")


def planned_and_landed(plan: DataFrame, landing_path: str) -> DataFrame:
    """Planned days whose CSV has landed and has bytes."""
    return with_landed(plan, landed_listing(plan.sparkSession, landing_path))


def _surplus_fault() -> Column:
    return F.when(F.col("_surplus"), F.lit("too many fields"))


def rejected_rows(raw: DataFrame) -> DataFrame:
    """Rows that cannot become bars, as text, with the ``_reason``."""
    read = read_fields(raw)
    faulty = read.withColumn("_reason", F.coalesce(_surplus_fault(), parse_fault(read))).where("_reason is not null")
    return faulty.select(*[c for c in raw.columns if c not in ("_pos", "_surplus")], "_reason")


def typed_rows(raw: DataFrame) -> DataFrame:
    """Bars of landed rows; a row that is not one fails the job."""
    return parse_bars(raw, _surplus_fault()).drop("_surplus")


def ingest_days(
    spark: SparkSession,
    landing_path: str,
    catalog: DataFrame,
    daily_path: str,
    plan: DataFrame | None = None,
    columns: list[str] | None = None,
    on_bad: str = "raise",
    reject_path: str | None = None,
    ledger_path: str | None = None,
) -> DataFrame:
    """Add the landed days that the daily table lacks; return (symbol, id, date, status).

    ``on_bad="raise"``: any bad row fails the run, which then adds nothing.  ``on_bad="skip_day"``: a
    day with a bad row is left out whole and gets status ``rejected``.  Either way the bad rows go to
    ``reject_path`` if one is given.  A day of which several files landed is stored once if their lines are the same,
    else it has the status ``conflict`` and is left out.  With a ``ledger_path`` each landed file is recorded there with
    its length and a digest of its lines; a file that lands with other lines for a day that is there already then gives
    it the status ``changed`` (the day stays as it is).  Days that a run which was cut off may have written in part are
    written anew.
    """
    if on_bad not in ("raise", "skip_day"):
        raise ValueError(f"on_bad must be 'raise' or 'skip_day', not {on_bad!r}")
    prepare(spark)
    unfinished = unfinished_days(spark, daily_path)
    work = work_table(landed_work(spark, landing_path, catalog, daily_path, plan, unfinished), "landed")
    work, opened = settle(spark, work, ledger_path)
    work = work_table(work, "settled")
    wanted = work.where("status = 'wanted'").select("file_path", "symbol", "date")
    if unfinished is not None:
        _check_unfinished(spark, daily_path, unfinished, wanted)
    first, last = wanted.agg(F.min("date"), F.max("date")).first()
    if first is None:
        results = work_table(work.select(*RESULT).distinct(), "ingested")
        if ledger_path is not None:
            record(spark, ledger_path, opened, results)
        return results
    replace = unfinished is not None
    add = lambda names: _add_days(
        read_landed(spark, landing_path, wanted, names), daily_path, on_bad, reject_path, replace
    )
    mark_days(wanted, daily_path)
    try:
        bad_days = add(columns or first_header(spark, wanted))
    except FAILURES as error:
        if columns or not is_other_header(error):
            raise
        bad_days = add(None)
    clear_days(spark, daily_path)
    added = day_listing(spark, daily_path, (first.year, last.year))
    results = work_table(_results(work, added, bad_days), "ingested")
    if ledger_path is not None:
        record(spark, ledger_path, opened, results)
    return results


def _add_days(
    raw: DataFrame, daily_path: str, on_bad: str, reject_path: str | None, replace: bool
) -> DataFrame | None:
    """Add the days of landed rows; return the days that were left out for a bad row, if asked to."""
    bad_days = None
    if on_bad == "skip_day":
        rejects = work_table(rejected_rows(raw), "rejects")
        if reject_path:
            rejects.write.mode("append").parquet(reject_path)
        bad_days = work_table(rejects.select("symbol", "date").distinct(), "bad-days")
        raw = raw.join(bad_days, ["symbol", "date"], "left_anti")
    try:
        append_daily(typed_rows(raw), daily_path, replace=replace)
    except FAILURES as error:
        if on_bad == "raise" and not is_other_header(error):
            _report(rejected_rows(raw), reject_path, error)
        raise
    return bad_days


def _report(rejects: DataFrame, reject_path: str | None, error: Exception) -> None:
    if reject_path:
        rejects.write.mode("append").parquet(reject_path)
    found = rejects.count()
    if found:
        raise BadRows(f"{found} landed rows are not bars") from error


def _results(work: DataFrame, added: DataFrame, bad_days: DataFrame | None) -> DataFrame:
    added = added.select("symbol", "date", F.lit(True).alias("added"))
    done = work.select(*RESULT).distinct().join(added, ["symbol", "date"], "left")
    status = F.when(F.col("status") != "wanted", F.col("status")).when(F.col("added"), "ingested")
    if bad_days is not None:
        done = done.join(bad_days.withColumn("bad", F.lit(True)), ["symbol", "date"], "left")
        status = status.when(F.col("bad"), "rejected")
    return done.select("symbol", "id", "date", status.otherwise("empty").alias("status"))
