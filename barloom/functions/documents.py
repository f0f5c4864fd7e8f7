"""Expressions on instrument documents held as variants."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_OBJECT = "map<string,variant>"


def _fields(value: Column) -> Column:
    """Fields of a variant object; no fields when it is absent or null."""
    return F.coalesce(value.cast(_OBJECT), F.create_map().cast(_OBJECT))


def _with_field(fields: Column, name: str, value: Column) -> Column:
    others = F.map_filter(fields, lambda key, _: key != name)
    return F.map_concat(others, F.create_map(F.lit(name), value))


def set_latest(document: Column, latest: Column) -> Column:
    """Set both ``latest`` fields of a document, creating the objects above them; keep all else."""
    top = _fields(document)
    data_range = _fields(F.try_element_at(top, F.lit("dataRange")))
    sources = _fields(F.try_element_at(data_range, F.lit("sources")))
    yearly = _fields(F.try_element_at(sources, F.lit("1Ys")))
    text = latest.cast("string").cast("variant")
    yearly = F.to_variant_object(_with_field(yearly, "latest", text))
    sources = F.to_variant_object(_with_field(sources, "1Ys", yearly))
    data_range = _with_field(_with_field(data_range, "latest", text), "sources", sources)
    return F.to_variant_object(_with_field(top, "dataRange", F.to_variant_object(data_range)))
