"""The operators on the test tables.

``events`` holds bars with gaps between days (symbol ``U<user_id>``), ``lineitem`` bars over several
years (symbol = supplier), ``customer`` the symbol and instrument catalog.  Every query runs over whole
tables; ``suite_sql`` has the same results as SQL.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.bars import parse_bars, utc_minute, with_epoch_after_stamp
from barloom.functions.days import daily_key, day_literal, landed_name, year_of_key
from barloom.operators import days as D
from barloom.operators.latest import assumed_days, keep_or_update, latest_days, newest_years
from barloom.operators.merge import distinct_bars, merge_bars
from barloom.operators.symbols import known_symbols, split_request, unknown_symbols, with_catalog
from barloom.plans.consolidate import consolidate, consolidate_history, year_statistics
from barloom.plans.fetch import plan_head, plan_ranges, plan_tail
from barloom.plans.ingest import ingest_days
from barloom.plans.refresh import patch_documents, refresh_catalog
from barloom.plans.summary import summary
from barloom.schema import MINUTE_FORMAT
from barloom.session import prepare, scratch_path
from barloom.sources.instruments import read_instruments, write_document
from barloom.sources.inventory import known_days, merge_listing, refresh_inventory
from barloom.sources.listings import days_of_keys, read_key_days
from barloom.sources.tables import append_daily, read_bars, write_years

FIRST_DAY = date(2024, 1, 1)
LAST_DAY = date(2024, 1, 30)
TODAY = date(2024, 1, 31)
LIMIT_YEAR = 2000
STAMP = "2024-01-31T00:00:00Z"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _user_symbol(column: str):
    return F.concat(F.lit("U"), F.col(column).cast("string"))


def _event_days(spark, sf_dir) -> DataFrame:
    """(symbol, date), one row per event."""
    events = _table(spark, sf_dir, "events")
    return events.select(_user_symbol("user_id").alias("symbol"), F.to_date("ts").alias("date"))


def _catalog(spark, sf_dir) -> DataFrame:
    """Customers as the symbol catalog; the earliest date differs by nation."""
    customer = _table(spark, sf_dir, "customer")
    return customer.select(
        _user_symbol("c_custkey").alias("symbol"),
        F.col("c_custkey").cast("string").alias("id"),
        F.date_add(F.lit(FIRST_DAY), F.col("c_nationkey")).alias("earliest_date"),
    )


def _line_bars(spark, sf_dir) -> DataFrame:
    """Line items as bars (symbol, timestamp, volume, year, date)."""
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("symbol"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("volume"),
        F.year("l_shipdate").alias("year"),
        F.to_date("l_shipdate").alias("date"),
    )


def _bars_of(events, symbol) -> DataFrame:
    """Events as typed bars of the given symbol column, stamps cut to the minute."""
    price = F.col("value")
    rows = events.select(
        symbol.alias("symbol"),
        utc_minute(F.date_format("ts", MINUTE_FORMAT)).alias("timestamp"),
        *[price.alias(c) for c in ("open", "high", "low", "close", "volume")],
        F.to_date("ts").alias("date"),
    )
    return with_epoch_after_stamp(rows)


def ingest_bars(spark, sf_dir):
    """Rows of text fields, as a landed file has them, to bars of their catalog symbol."""
    events = _table(spark, sf_dir, "events")
    raw = events.select(
        F.col("user_id").cast("string").alias("id"),
        F.date_format("ts", MINUTE_FORMAT).alias("timestamp"),
        F.col("value").cast("string").alias("open"),
        F.col("value").cast("string").alias("close"),
    )
    bars = parse_bars(with_catalog(raw, _catalog(spark, sf_dir).select("id", "symbol")))
    return bars.select("symbol", F.col("timestamp").cast("timestamp_ntz"), "unix_time", "open", "close")


def day_listing(spark, sf_dir):
    days = _event_days(spark, sf_dir).withColumnRenamed("date", "d")
    return days.groupBy("symbol", "d").agg(F.count("*").alias("n_rows"))


def newest_date(spark, sf_dir):
    return D.newest_day(_event_days(spark, sf_dir))


def earliest_date(spark, sf_dir):
    return D.earliest_day(_event_days(spark, sf_dir))


def _as_plan(plan: DataFrame) -> DataFrame:
    return plan.select("symbol", "id", F.col("date").alias("d"))


def tail_gap(spark, sf_dir):
    return _as_plan(plan_tail(_catalog(spark, sf_dir), _event_days(spark, sf_dir), TODAY))


def head_backfill(spark, sf_dir):
    return _as_plan(plan_head(_catalog(spark, sf_dir), _event_days(spark, sf_dir), TODAY))


def override_gap(spark, sf_dir):
    return _as_plan(plan_tail(_catalog(spark, sf_dir), _event_days(spark, sf_dir), LAST_DAY, FIRST_DAY))


def missing_ranges(spark, sf_dir):
    """Runs of days without an error event of the symbol."""
    events = _table(spark, sf_dir, "events").where("event_type = 'error'")
    days = events.select(_user_symbol("user_id").alias("symbol"), F.to_date("ts").alias("date"))
    ranges = plan_ranges(_catalog(spark, sf_dir), days, LAST_DAY)
    return ranges.select("symbol", "id", F.col("first").alias("first_day"), F.col("last").alias("last_day"))


def planned_landed(spark, sf_dir):
    """Days without an error event, of which some event has landed."""
    events = _table(spark, sf_dir, "events")
    day = events.select(_user_symbol("user_id").alias("symbol"), F.to_date("ts").alias("date"), "event_type", "user_id")
    plan = plan_tail(_catalog(spark, sf_dir), day.where("event_type = 'error'"), LAST_DAY, FIRST_DAY)
    landed = day.select(F.col("user_id").cast("string").alias("id"), "date").distinct()
    return _as_plan(D.with_landed(plan, landed))


def work_status(spark, sf_dir):
    return D.day_status(_event_days(spark, sf_dir), day_literal(FIRST_DAY), day_literal(LAST_DAY))


def fetch_window(spark, sf_dir):
    marks = D.high_water_marks(_line_bars(spark, sf_dir))
    return D.fetch_window(marks, day_literal(date(2001, 10, 15))).withColumnRenamed("year", "yr")


def run_summary(spark, sf_dir):
    return summary(fetch_window(spark, sf_dir))


def catalog_filter(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    customer = _table(spark, sf_dir, "customer")
    bars = with_catalog(events, customer.select(F.col("c_custkey").alias("id"), "c_name"))
    return bars.groupBy(F.col("id").alias("user_id"), "c_name").agg(F.count("*").alias("n_rows"))


def _requested(spark, sf_dir) -> DataFrame:
    """Symbols asked for: the buyer and the clerk's own code of every order."""
    orders = _table(spark, sf_dir, "orders")
    line = F.concat(_user_symbol("o_custkey"), F.lit(", "), F.col("o_orderpriority"), F.lit(" ,"), "o_orderstatus")
    return orders.select("o_orderkey", F.explode(split_request(line)).alias("symbol"))


def request_list(spark, sf_dir):
    return _requested(spark, sf_dir)


def requested_known(spark, sf_dir):
    return known_symbols(_catalog(spark, sf_dir), _requested(spark, sf_dir)).select("symbol", "id")


def requested_unknown(spark, sf_dir):
    return unknown_symbols(_requested(spark, sf_dir), _catalog(spark, sf_dir))


def symbols_without_bars(spark, sf_dir):
    return unknown_symbols(_catalog(spark, sf_dir), _event_days(spark, sf_dir))


def partition_key_parse(spark, sf_dir):
    """Listing keys whose month comes from the event's JSON, so that most name no day."""
    month = F.lpad(F.get_json_object("props", "$.k"), 2, "0")
    day = F.lpad(F.dayofmonth("ts").cast("string"), 2, "0")
    key = F.concat(F.lit("date=2024-"), month, F.lit("-"), day, F.lit("/"))
    keys = _table(spark, sf_dir, "events").select("event_id", key.alias("k"))
    return days_of_keys(keys, "k").withColumnRenamed("day", "d")


def json_key(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


def hwm_symbol_year(spark, sf_dir):
    return D.high_water_marks(_line_bars(spark, sf_dir)).withColumnRenamed("year", "yr")


def historical_years(spark, sf_dir):
    return D.available_years(_line_bars(spark, sf_dir), LIMIT_YEAR).withColumnRenamed("year", "yr")


def year_range(spark, sf_dir):
    return D.year_range(D.available_years(_line_bars(spark, sf_dir), LIMIT_YEAR))


def distinct_line_bars(spark, sf_dir):
    return distinct_bars(_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity"))


def _merged(existing: DataFrame, daily: DataFrame, mode: str = "hwm") -> DataFrame:
    existing = existing.select("symbol", "timestamp", "volume", "year")
    return merge_bars(existing, daily, mode).withColumnRenamed("year", "yr")


def hwm_merge(spark, sf_dir):
    """Merge all days into years that end, by symbol, in the month of their supplier's nation."""
    bars = _line_bars(spark, sf_dir)
    supplier = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("symbol"), "s_nationkey")
    existing = bars.join(supplier, "symbol").where(F.month("timestamp") <= F.col("s_nationkey") + 1)
    return _merged(existing, bars)


def _march_to_june(bars: DataFrame) -> DataFrame:
    return bars.where(F.month("timestamp").between(3, 6))


def hwm_merge_late(spark, sf_dir):
    """Years that hold March to June: later days come in, January and February stay out."""
    bars = _line_bars(spark, sf_dir)
    return _merged(_march_to_june(bars), bars)


def missing_days_merge(spark, sf_dir):
    bars = _line_bars(spark, sf_dir)
    return _merged(_march_to_june(bars), bars, "missing_days")


def shipped_merge(spark, sf_dir):
    """Years that hold the finished lines (status F): of the open ones those after the last finished day."""
    finished = _table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'")
    existing = finished.select(
        F.col("l_suppkey").alias("symbol"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("volume"),
        F.year("l_shipdate").alias("year"),
    )
    return _merged(existing, _line_bars(spark, sf_dir))


def consolidation_summary(spark, sf_dir):
    return D.day_counts(_line_bars(spark, sf_dir)).withColumnRenamed("year", "yr")


def latest_from_latest_year(spark, sf_dir):
    bars = _line_bars(spark, sf_dir)
    newest = newest_years(D.available_years(bars))
    latest = latest_days(newest, bars.join(newest, ["symbol", "year"], "left_semi"), day_literal(TODAY))
    return latest.select("symbol", "latest")


def metadata_left_join(spark, sf_dir):
    newest = D.newest_day(_event_days(spark, sf_dir)).withColumnRenamed("newest_date", "latest")
    rows = _table(spark, sf_dir, "customer").select(_user_symbol("c_custkey").alias("symbol"))
    return keep_or_update(rows, newest, day_literal(date(2023, 12, 31)))


def _two_runs(spark, sf_dir, mode, **options):
    """Daily files of January 11 to 20 are consolidated, then all other days land and the run is repeated."""
    events = _table(spark, sf_dir, "events")
    bars = _bars_of(events, F.col("event_type")).withColumn("_pos", F.monotonically_increasing_id())
    daily, yearly = scratch_path(spark, "daily"), scratch_path(spark, "yearly")
    early = F.col("date").between(F.lit(date(2024, 1, 11)), F.lit(date(2024, 1, 20)))
    append_daily(bars.where(early), daily)
    consolidate(spark, daily, yearly, mode)
    append_daily(bars.where(~early), daily)
    consolidate(spark, daily, yearly, mode, **options)
    return yearly


def _consolidated_files(spark, sf_dir, mode):
    return read_bars(spark, _two_runs(spark, sf_dir, mode)).select(
        "symbol",
        F.col("year").cast("int").alias("yr"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "unix_time",
        "open",
        "volume",
    )


def consolidate_files(spark, sf_dir):
    return _consolidated_files(spark, sf_dir, "hwm")


def consolidate_files_missing_days(spark, sf_dir):
    return _consolidated_files(spark, sf_dir, "missing_days")


def statistics_of_year_files(spark, sf_dir):
    """Rows, last day and days of each year after a run that added files to it."""
    known = year_statistics(spark, _two_runs(spark, sf_dir, "hwm", extend=True))
    n_days = F.size("days").cast("long").alias("n_days")
    return known.select("symbol", F.col("year").alias("yr"), "n_rows", "last_day", F.get("days", F.lit(0)).alias("first_day"), n_days)


def _days_of_three_years(spark, sf_dir) -> DataFrame:
    """Events as bars of their type; users with a remainder of 1 or 2 by three are one or two years earlier."""
    events = _table(spark, sf_dir, "events")
    moved = events.withColumn("ts", F.col("ts") - F.make_interval(F.col("user_id") % 3))
    bars = _bars_of(moved, F.col("event_type")).withColumn("_pos", F.monotonically_increasing_id())
    return bars.repartition("symbol", "date")  # one file of each day


def history_files(spark, sf_dir):
    """All past years of the symbols of a catalog that lacks one symbol."""
    daily, yearly = scratch_path(spark, "daily"), scratch_path(spark, "yearly")
    append_daily(_days_of_three_years(spark, sf_dir), daily)
    catalog = _table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol")).distinct()
    catalog = catalog.where("symbol <> 'error'")
    consolidate_history(spark, daily, yearly, limit=2023, catalog=catalog)
    return read_bars(spark, yearly).select(
        "symbol",
        F.col("year").cast("int").alias("yr"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "unix_time",
        "open",
        "volume",
    )


def year_files_with_bad_days(spark, sf_dir):
    """Result of a run over one of three years; all January 15ths of one symbol lack a column."""
    daily, yearly = scratch_path(spark, "daily"), scratch_path(spark, "yearly")
    bars = _days_of_three_years(spark, sf_dir)
    bad = (F.col("symbol") == "error") & (F.dayofmonth("date") == 15)
    append_daily(bars.where(~bad), daily)
    append_daily(bars.where(bad).drop("volume"), daily)
    results = consolidate(spark, daily, yearly, years=(2023, 2023), on_bad="skip")
    return results.withColumnRenamed("year", "yr")


def _spoil(spark, folder: str) -> None:
    """Put a file into a folder that is no Parquet, whatever its name says."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-cut-off.parquet")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(b"a file that was cut off"))
    out.close()


def year_files_with_unreadable_days(spark, sf_dir):
    """Result of a run over three years.  A file of one symbol's January 15th cannot be read, another symbol's
    January 16th has a column of another type; a third one's volumes are whole numbers, which is none."""
    daily, yearly = scratch_path(spark, "daily"), scratch_path(spark, "yearly")
    bars = _days_of_three_years(spark, sf_dir).withColumn("note", F.col("symbol"))
    day = lambda symbol, d: (F.col("symbol") == symbol) & (F.to_date("date") == F.lit(d))
    odd, cast = day("view", date(2023, 1, 16)), day("signup", date(2022, 1, 17))
    append_daily(bars.where(~odd & ~cast), daily)
    append_daily(bars.where(odd).withColumn("note", F.length("note")), daily)
    append_daily(bars.where(cast).withColumn("volume", F.round(F.col("volume") * 100).cast("long")), daily)
    _spoil(spark, f"{daily}/symbol=error/date=2023-01-15")
    return consolidate(spark, daily, yearly, on_bad="skip").withColumnRenamed("year", "yr")


def head_from_key_listing(spark, sf_dir):
    """Days before the first one of each symbol, by an exported listing of objects that is merged into an inventory.

    Every event has a key; those with an odd number name no day, or the day without padding.
    """
    prepare(spark)
    exported, inventory = scratch_path(spark, "keys"), scratch_path(spark, "inventory")
    events = _table(spark, sf_dir, "events")
    day = F.when(F.col("event_id") % 7 == 1, F.date_format("ts", "yyyy-M-d")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    symbol = _user_symbol("user_id")
    end = F.when(F.col("event_id") % 3 == 0, F.lit("/")).otherwise(F.concat(F.lit("/"), symbol, F.lit(".parquet")))
    bad = F.concat(F.lit("date=2024-13-"), F.dayofmonth("ts").cast("string"))
    day = F.when(F.col("event_id") % 5 == 1, bad).otherwise(F.concat(F.lit("date="), day))
    key = F.concat(F.lit("bars/1s/symbol="), symbol, F.lit("/"), day, end)
    events.select(key.alias("key"), F.col("event_id").alias("size")).write.json(exported)
    merge_listing(spark, inventory, read_key_days(spark, exported))
    return _as_plan(plan_head(_catalog(spark, sf_dir), known_days(spark, inventory), TODAY))


def inventory_nights(spark, sf_dir):
    """What two nights change in an inventory: all days but those of one symbol, then the days of one year."""
    prepare(spark)
    daily, inventory = scratch_path(spark, "daily"), scratch_path(spark, "inventory")
    bars = _days_of_three_years(spark, sf_dir)
    late = F.col("symbol") == "view"
    append_daily(bars.where(~late), daily)
    first = refresh_inventory(spark, inventory, daily)
    append_daily(bars.where(late), daily)
    second = refresh_inventory(spark, inventory, daily, (2023, 2023))
    nights = first.withColumn("night", F.lit(1)).unionByName(second.withColumn("night", F.lit(2)))
    known = known_days(spark, inventory).select("symbol", "date", F.lit(True).alias("known"))
    return nights.join(known, ["symbol", "date"], "left").select(
        "night", "symbol", F.col("date").alias("d"), "change", F.coalesce("known", F.lit(False)).alias("known")
    )


def _event_symbols(spark, sf_dir) -> DataFrame:
    """Event types as a symbol catalog whose ids are the types in lower case."""
    types = _table(spark, sf_dir, "events").select("event_type").distinct()
    return types.select(F.upper("event_type").alias("symbol"), F.lower("event_type").alias("id"))


def ingest_files(spark, sf_dir):
    """All events land as CSV days, one per event type and day, and are ingested."""
    events = _table(spark, sf_dir, "events")
    landing, daily = scratch_path(spark, "landing"), scratch_path(spark, "daily")
    price = F.col("value").cast("string")
    landed = events.select(
        F.date_format("ts", MINUTE_FORMAT).alias("timestamp"),
        *[price.alias(c) for c in ("open", "high", "low", "close", "volume")],
        F.col("user_id").cast("string").alias("user"),
        landed_name(F.lower("event_type"), F.to_date("ts")).alias("file"),
    )
    landed.write.partitionBy("file").option("header", True).csv(landing)
    ingest_days(spark, landing, _event_symbols(spark, sf_dir), daily)
    return read_bars(spark, daily).select(
        "symbol",
        F.to_date("date").alias("d"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "unix_time",
        "open",
        "volume",
        "user",
    )


def ingest_ledger(spark, sf_dir):
    """What becomes of days that land twice, in one run or in the next, and how many rows are stored of them.

    In the first run clicks lie in two folders with the same lines, views with other lines in each.  In the second
    run signups land again with other lines, purchases with the same in another order.
    """
    prepare(spark)
    landing, again, daily, ledger = (scratch_path(spark, name) for name in ("landing", "again", "daily", "ledger"))
    events = _table(spark, sf_dir, "events")
    price = F.col("value").cast("string")
    rows = events.select(
        F.date_format("ts", MINUTE_FORMAT).alias("timestamp"),
        *[price.alias(c) for c in ("open", "high", "low", "close", "volume")],
        "event_type", "event_id", landed_name(F.lower("event_type"), F.to_date("ts")).alias("file"),
    )
    one = lambda rows, order: rows.repartition("file").sortWithinPartitions("file", order).drop("event_type", "event_id")
    kind = F.col("event_type")
    put = lambda rows, path: rows.write.partitionBy("file").option("header", True).csv(path)
    put(one(rows, "event_id"), f"{landing}/one")
    put(one(rows.where(kind == "click"), F.desc("event_id")), f"{landing}/two")
    put(one(rows.where(kind == "view").withColumn("open", F.lit("0.5")), "event_id"), f"{landing}/two-more")
    put(one(rows.where(kind == "signup").withColumn("volume", F.lit("7")), "event_id"), f"{again}/one")
    put(one(rows.where(kind == "purchase"), F.desc("event_id")), f"{again}/two")
    catalog = _event_symbols(spark, sf_dir)
    runs = [ingest_days(spark, path, catalog, daily, ledger_path=ledger).withColumn("run", F.lit(i)) for i, path in enumerate((landing, again))]
    stored = read_bars(spark, daily).groupBy("symbol", F.to_date("date").alias("date")).agg(F.count("*").alias("n_rows"))
    found = runs[0].unionByName(runs[1]).join(stored, ["symbol", "date"], "left")
    return found.select("run", "symbol", F.col("date").alias("d"), "status", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def planned_files(spark, sf_dir):
    """Names of the CSV files that planned days land in, and the directories they go to."""
    plan = plan_head(_catalog(spark, sf_dir), _event_days(spark, sf_dir), TODAY)
    day = F.col("date")
    return plan.select(landed_name(F.col("id"), day).alias("file"), daily_key(F.col("symbol"), day).alias("folder"))


def years_of_keys(spark, sf_dir):
    """Available years by the keys of a listing, one key per line item."""
    lines = _table(spark, sf_dir, "lineitem")
    key = F.concat(F.lit("date="), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("/"))
    years = lines.select(F.col("l_suppkey").alias("symbol"), year_of_key(key).alias("year"))
    return D.available_years(years, LIMIT_YEAR).withColumnRenamed("year", "yr")


def assumed_latest(spark, sf_dir):
    """Latest day by the year alone, as for files without a date column."""
    newest = newest_years(D.available_years(_line_bars(spark, sf_dir)))
    return assumed_days(newest, day_literal(date(2001, 10, 15))).withColumnRenamed("year", "yr")


def _document_fields() -> list:
    field = lambda name, path, kind="string": F.try_variant_get("document", path, kind).alias(name)
    return [
        field("name", "$.name"),
        field("balance", "$.balance", "double"),
        field("earliest", "$.dataRange.earliest"),
        field("latest", "$.dataRange.latest"),
        field("yearly_latest", "$.dataRange.sources['1Ys'].latest"),
    ]


def patched_documents(spark, sf_dir):
    """Customers as instrument documents; those with events get a new latest day."""
    balance, name = F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name")
    data_range = F.struct(F.lit("2011-01-01").alias("earliest"), F.lit("2023-12-31").alias("latest"))
    document = F.struct(name, balance, data_range.alias("dataRange"))
    customer = _table(spark, sf_dir, "customer")
    instruments = customer.select(
        _user_symbol("c_custkey").alias("symbol"), F.parse_json(F.to_json(document)).alias("document")
    )
    newest = D.newest_day(_event_days(spark, sf_dir))
    latest = newest.select("symbol", F.col("newest_date").cast("string").alias("latest"))
    return patch_documents(instruments, latest, STAMP).select("symbol", *_document_fields())


def refresh_files(spark, sf_dir):
    """Nations and regions as instruments, refreshed from yearly files of the events of each nation."""
    prepare(spark)
    yearly, source, out = (scratch_path(spark, name) for name in ("yearly", "instruments", "refreshed"))
    customer, nation = (_table(spark, sf_dir, name) for name in ("customer", "nation"))
    home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    events = _table(spark, sf_dir, "events").join(home, F.col("user_id") == F.col("c_custkey"))
    bars = _bars_of(events, F.col("n_name")).withColumn("year", F.year("date")).drop("date")
    write_years(bars, yearly, spark.sparkContext.defaultParallelism)
    of_nations = nation.select(
        F.col("n_name").alias("symbol"), F.to_json(F.struct(F.col("n_name").alias("name"))).alias("text")
    )
    kept = F.struct(F.col("r_name").alias("name"), F.struct(F.lit("2023-12-31").alias("latest")).alias("dataRange"))
    of_regions = _table(spark, sf_dir, "region").select(F.col("r_name").alias("symbol"), F.to_json(kept).alias("text"))
    documents = of_nations.unionByName(of_regions).select("symbol", F.parse_json("text").alias("document"))
    write_document(documents, source)
    bounds = refresh_catalog(spark, source, yearly, TODAY, out, STAMP).withColumnRenamed("latest", "bound")
    instruments = read_instruments(spark, f"{out}/instruments").where(~F.col("symbol").startswith("_"))
    rows = instruments.join(bounds, "symbol", "left").select(
        "symbol", *_document_fields(), "bound", "latest_source", F.col("updated_at").cast("timestamp_ntz").alias("updated")
    )
    return rows.drop("balance", "earliest")


QUERIES = {
    "ingest_bars": ingest_bars,
    "day_listing": day_listing,
    "newest_date": newest_date,
    "earliest_date": earliest_date,
    "tail_gap": tail_gap,
    "head_backfill": head_backfill,
    "override_gap": override_gap,
    "missing_ranges": missing_ranges,
    "planned_landed": planned_landed,
    "work_status": work_status,
    "fetch_window": fetch_window,
    "run_summary": run_summary,
    "catalog_filter": catalog_filter,
    "request_list": request_list,
    "requested_known": requested_known,
    "requested_unknown": requested_unknown,
    "unknown_symbols": symbols_without_bars,
    "partition_key_parse": partition_key_parse,
    "json_key": json_key,
    "hwm_symbol_year": hwm_symbol_year,
    "historical_years": historical_years,
    "year_range": year_range,
    "distinct_bars": distinct_line_bars,
    "hwm_merge": hwm_merge,
    "hwm_merge_late": hwm_merge_late,
    "missing_days_merge": missing_days_merge,
    "shipped_merge": shipped_merge,
    "consolidation_summary": consolidation_summary,
    "latest_from_latest_year": latest_from_latest_year,
    "metadata_left_join": metadata_left_join,
    "consolidate_files": consolidate_files,
    "consolidate_files_missing_days": consolidate_files_missing_days,
    "statistics_of_year_files": statistics_of_year_files,
    "history_files": history_files,
    "year_files_with_bad_days": year_files_with_bad_days,
    "year_files_with_unreadable_days": year_files_with_unreadable_days,
    "head_from_key_listing": head_from_key_listing,
    "inventory_nights": inventory_nights,
    "ingest_files": ingest_files,
    "ingest_ledger": ingest_ledger,
    "planned_files": planned_files,
    "years_of_keys": years_of_keys,
    "assumed_latest": assumed_latest,
    "patched_documents": patched_documents,
    "refresh_files": refresh_files,
}
