"""Aggregates that describe series and relations between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import tails


def extremes(rows: DataFrame, series: list[str], month: str, value: str) -> DataFrame:
    """First, last, peak and trough of each series; the earliest month of equal peaks."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*series).agg(
        F.min_by(value, month).alias("first_value"),
        F.max_by(value, month).alias("last_value"),
        F.max(value).alias("peak"),
        F.min_by(month, F.struct(-F.col(value), month)).alias("peak_month"),
        F.min_by(month, F.struct(value, month)).alias("trough_month"),
        ((F.max_by(value, month) / F.max(value) - 1) * 100).alias("from_peak_pct"),
    )


def concentration(rows: DataFrame, within: list[str], entity: str, value: str) -> DataFrame:
    """Rank, share and cumulative share of each entity within its group; equal values by name."""
    w = Window.partitionBy(*within).orderBy(F.desc(value), entity)
    total = F.sum(value).over(Window.partitionBy(*within))
    return rows.withColumns({"place": F.row_number().over(w), "share": F.col(value) / total, "cumulative": F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)) / total})


def correlation(a: str, b: str) -> Column:
    """Pearson's r as an aggregate; null where a side is constant."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_pop(F.when(F.col(a).isNotNull(), F.col(b))))


def lag_correlation(rows: DataFrame, series: list[str], month: str, a: str, b: str, lags: list[int], least: int = 10) -> DataFrame:
    """Pearson correlation of a with b some rows earlier, for each lag (fewer than `least` pairs: null)."""
    w = Window.partitionBy(*series).orderBy(month)
    wide = rows.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    wide = wide.withColumn("_l", F.array(*(F.struct(F.lit(k).alias("lag"), F.lag(b, k).over(w).alias("x")) for k in lags)))
    pairs = wide.select(*series, a, F.explode("_l").alias("_p")).select(*series, F.col("_p.lag").alias("lag"), F.col(a).alias("y"), F.col("_p.x").alias("x")).filter("x is not null")
    return pairs.groupBy(*series, "lag").agg(F.count(F.lit(1)).alias("n"), F.when(F.count(F.lit(1)) >= least, correlation("y", "x")).alias("r"))


def strongest_lags(lagged: DataFrame, series: list[str]) -> DataFrame:
    """The lag with the most negative correlation (null if none is negative) and that with the largest absolute one; of equals the shortest lag."""
    r = F.round("r", 9)
    negative = F.min(F.when(r < 0, F.struct(r.alias("_r"), "lag", "r")))
    largest = F.min(F.when(r.isNotNull(), F.struct((-F.abs(r)).alias("_r"), "lag", "r")))
    return lagged.groupBy(*series).agg(negative.alias("_n"), largest.alias("_a")).select(*series, F.col("_n.lag").alias("lag_negative"), F.col("_n.r").alias("r_negative"), F.col("_a.lag").alias("lag_strongest"), F.col("_a.r").alias("r_strongest"))


def spearman(rows: DataFrame, series: list[str], a: str, b: str) -> DataFrame:
    """Rank correlation with average ranks of equal values."""
    def rank(c: str):
        same = Window.partitionBy(*series, c)
        return F.rank().over(Window.partitionBy(*series).orderBy(c)) + (F.count(F.lit(1)).over(same) - 1) / 2

    ranked = rows.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumns({"_a": rank(a), "_b": rank(b)})
    return ranked.groupBy(*series).agg(F.count(F.lit(1)).alias("n"), correlation("_a", "_b").alias("rho"))


def lagged_spearman(rows: DataFrame, series: list[str], month: str, target: str, variables: list[str], lags: list[int], least: int = 10) -> DataFrame:
    """(series, variable, lag, n, rho, p): rank correlation of each variable some rows earlier with the target, and its p-value by the t distribution.

    Pairs of which fewer than `least` rows have both values are left out; a constant side gives nulls.
    """
    w = Window.partitionBy(*series).orderBy(month)
    wide = rows.withColumn("_l", F.array(*(F.struct(F.lit(v).alias("variable"), F.lit(k).alias("lag"), F.lag(F.col(v).cast("double"), k).over(w).alias("x")) for v in variables for k in lags)))
    long = wide.select(*series, F.col(target).alias("_y"), F.explode("_l").alias("_p")).select(*series, "_p.variable", "_p.lag", "_y", F.col("_p.x").alias("_x"))
    found = spearman(long, [*series, "variable", "lag"], "_y", "_x").filter(F.col("n") >= least)
    t = F.col("rho") * F.sqrt((F.col("n") - 2) / F.nullif(1 - F.col("rho") * F.col("rho"), F.lit(0.0)))
    return found.withColumn("p", F.when(F.abs("rho") >= 1, 0.0).otherwise(tails.t_tail(t, F.col("n") - 2)))


def spearman_summary(found: DataFrame, by: list[str], alpha: float = 0.05) -> DataFrame:
    """(by, n_series, median_rho, min_rho, max_rho, least_p, n_significant) over the series of each group."""
    return found.groupBy(*by).agg(
        F.count("rho").alias("n_series"),
        F.median("rho").alias("median_rho"),
        F.min("rho").alias("min_rho"),
        F.max("rho").alias("max_rho"),
        F.min("p").alias("least_p"),
        F.count_if(F.col("p") < alpha).alias("n_significant"),
    )


def residual_shape(rows: DataFrame, series: list[str], month: str, e: str) -> DataFrame:
    """Mean, deviation, bias-corrected skew and excess kurtosis, and the Durbin-Watson statistic."""
    w = Window.partitionBy(*series).orderBy(month)
    n = F.count(e).cast("double")
    out = rows.withColumn("_d", F.col(e) - F.lag(e).over(w)).groupBy(*series).agg(
        F.count(e).alias("n"),
        F.avg(e).alias("mean"),
        F.stddev(e).alias("std"),
        F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * F.skewness(e)).alias("skew"),
        F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(e) + 6)).alias("kurt"),
        (F.sum(F.col("_d") * F.col("_d")) / F.sum(F.col(e) * F.col(e))).alias("dw"),
    )
    return out
