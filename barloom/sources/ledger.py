"""What has landed so far: one row for each file that a run looked at, with its length and a digest of its lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import local_table, work_table
from barloom.sources.landing import line_digests
from barloom.sources.listings import or_none

_LEDGER = "id string, date date, source string, bytes long, modified timestamp, digest string, status string, run long"
_DAY = ["id", "date"]


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    """(id, date, source, bytes, modified, digest, status, run) of all runs."""
    found = None if path is None else or_none(lambda: spark.read.schema(_LEDGER).parquet(path))
    return local_table(spark, [], _LEDGER) if found is None else found


def _sources(work: DataFrame) -> DataFrame:
    """One row for each landed file or folder of parts of a day; a file that several symbols share counts once."""
    files = work.select("file_path", "source", "bytes", "modified", *_DAY, "status").distinct()
    return files.groupBy("source", *_DAY, "status").agg(F.sum("bytes").alias("bytes"), F.max("modified").alias("modified"))


def settle(spark: SparkSession, work: DataFrame, ledger_path: str | None) -> tuple[DataFrame, DataFrame]:
    """``work`` (file_path, source, bytes, modified, symbol, id, date, status) with one source for each day, and the
    sources looked at, with their digests.

    Wanted days of which several sources landed: if these have the same lines, the first by name is taken, else the
    day's status is ``conflict``.  With a ledger, a day that is there already has the status ``changed`` if what landed
    now has other lines than what was recorded first.  Files that the ledger knows by name, length and time of change
    are not opened again; without a ledger only those of days with several sources are opened.
    """
    sources = _sources(work)
    known = read_ledger(spark, ledger_path)
    seen = known.groupBy("source", "bytes", "modified", *_DAY).agg(F.max_by("status", "run").alias("was"))
    sources = sources.join(seen, ["source", "bytes", "modified", *_DAY], "left")
    several = sources.where("status = 'wanted'").groupBy(*_DAY).count().where("count > 1").select(*_DAY, F.lit(True).alias("several"))
    sources = work_table(sources.join(several, _DAY, "left"), "sources")
    look = F.coalesce("several", F.lit(False))
    if ledger_path is not None:
        look = look | (F.col("status") == "wanted") | F.col("was").isNull()
    opened = sources.where(look)
    digests = local_table(spark, [], "source string, digest string")
    if not opened.isEmpty():
        digests = work_table(line_digests(spark, work.join(opened.select("source"), "source", "left_semi").select("file_path", "source").distinct()), "digests")
    opened = opened.join(digests, "source", "left")
    first = known.where("status in ('ingested', 'exists', 'empty')").groupBy(*_DAY).agg(F.min_by("digest", "run").alias("first"))
    judged = sources.join(digests, "source", "left").join(first, _DAY, "left")
    other = (F.col("was") == "changed") | (F.col("digest") != F.col("first"))
    day = judged.groupBy(*_DAY).agg(
        F.min("source").alias("taken"),
        F.bool_or((F.col("status") == "exists") & other).alias("changed"),
        ((F.count_if(F.col("status") == "wanted") > 1) & (F.count_distinct("digest") > 1)).alias("conflict"),
    )
    work = work.join(day, _DAY).where((F.col("source") == F.col("taken")) | (F.col("status") != "wanted"))
    status = F.when((F.col("status") == "wanted") & F.col("conflict"), "conflict")
    status = status.when((F.col("status") == "exists") & F.col("changed"), "changed").otherwise(F.col("status"))
    return work.withColumn("status", status).drop("taken", "changed", "conflict"), opened.drop("several", "was")


def record(spark: SparkSession, ledger_path: str, opened: DataFrame, results: DataFrame) -> None:
    """Add the sources that a run looked at, with what became of their day."""
    last = read_ledger(spark, ledger_path).agg(F.max("run")).first()[0] or 0
    of_day = results.groupBy(*_DAY).agg(F.min("status").alias("status"))
    rows = opened.drop("status").join(of_day, _DAY).withColumn("run", F.lit(last + 1).cast("long"))
    rows.select("id", "date", "source", "bytes", "modified", "digest", "status", "run").write.mode("append").parquet(ledger_path)
