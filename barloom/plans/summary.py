"""Counts over the result table of a run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"))
