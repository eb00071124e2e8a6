"""Daily series that grow by upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows of both, the new one for a key that both have; among rows of one side the last in order."""
    rest = [c for c in old.columns if c != key]
    tie = [F.col(order)] if order else []
    tagged = lambda df, n: df.select(key, F.struct(F.lit(n).alias("v"), *tie, *rest).alias("_r"))
    return tagged(old, 0).unionByName(tagged(new, 1)).groupBy(key).agg(F.max("_r").alias("_r")).select(key, *[f"_r.{c}" for c in rest])


def totals(series: DataFrame, columns: list[str]) -> DataFrame:
    return series.agg(F.count(F.lit(1)).alias("days"), *[F.sum(c).cast("long").alias(f"total_{c}") for c in columns])
