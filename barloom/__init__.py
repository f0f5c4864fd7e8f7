"""Spark jobs over per-second OHLCV price bars.

Landed CSV day files become a Parquet table partitioned by symbol and day, days become de-duplicated
years, and an instrument catalog is kept current.  Every step is one DataFrame job over all symbols.
"""

from barloom.plans.consolidate import consolidate, consolidate_history, year_statistics
from barloom.plans.fetch import plan_head, plan_ranges, plan_tail
from barloom.plans.ingest import BadRows, ingest_days
from barloom.plans.refresh import refresh_catalog
from barloom.plans.summary import summary
from barloom.session import new_session, prepare
from barloom.sources.catalog import catalog_from_map, read_catalog
from barloom.sources.inventory import known_days, merge_listing, refresh_inventory
from barloom.sources.listings import day_listing, read_key_days, year_listing
from barloom.sources.tables import read_bars

__all__ = [
    "BadRows",
    "catalog_from_map",
    "consolidate",
    "consolidate_history",
    "day_listing",
    "ingest_days",
    "known_days",
    "merge_listing",
    "new_session",
    "plan_head",
    "plan_ranges",
    "plan_tail",
    "prepare",
    "read_bars",
    "read_catalog",
    "read_key_days",
    "refresh_catalog",
    "refresh_inventory",
    "summary",
    "year_listing",
    "year_statistics",
]
