"""Distinct counts and quantiles from sketches that are kept for each day and merged when they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the registers of a distinct-count sketch (error about 0.8 %), and the size of a quantile sketch (rank error about 1 %).
REGISTERS, SIZE = 14, 400


def daily_sketches(rows: DataFrame, keys: list[str], day: Column, counted: str, value: str) -> DataFrame:
    """(keys, day, n, counted, value): rows of each day, and sketches of one column's distinct values and of another's distribution.

    A day's row has a fixed size, however many rows the day has; both sketches are combined before the shuffle. Null values
    are in neither sketch.
    """
    return rows.groupBy(*keys, day.alias("day")).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(counted, F.lit(REGISTERS)).alias("counted"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SIZE)).alias("value"))


def merged(sketches: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """(keys, n, n_distinct, quantiles): of all days together; quantiles in the order of the shares asked for."""
    found = sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("counted")).alias("n_distinct"), F.kll_merge_agg_double("value", F.lit(SIZE)).alias("_v"))
    return found.select(*keys, "n", "n_distinct", F.kll_sketch_get_quantile_double("_v", F.array(*map(F.lit, shares))).alias("quantiles"))
