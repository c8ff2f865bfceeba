"""Calendar spines, as-of values, lags and fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense(rows: DataFrame, series: list[str], month: str) -> DataFrame:
    """Every month between a series' first and last one; values of new months are null."""
    ends = rows.groupBy(*series).agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
    spine = ends.select(*series, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias(month))
    return spine.join(rows, [*series, month], "left")


def filled(rows: DataFrame, series: list[str], month: str, value: str, how: str, into: str | None = None) -> DataFrame:
    """Nulls filled by "zero", "ffill" (then back), "bfill" (then forward) or "linear" by row position (then ends outward)."""
    w = Window.partitionBy(*series).orderBy(month)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    prev, after = F.last(value, True).over(back), F.first(value, True).over(ahead)
    if how == "zero":
        out = F.coalesce(F.col(value), F.lit(0.0))
    elif how == "ffill":
        out = F.coalesce(prev, after)
    elif how == "bfill":
        out = F.coalesce(after, prev)
    else:
        n = F.row_number().over(w)
        rows = rows.withColumn("_n", n).withColumn("_known", F.when(F.col(value).isNotNull(), F.col("_n")))
        p, q = F.last("_known", True).over(back), F.first("_known", True).over(ahead)
        between = prev + (after - prev) * (F.col("_n") - p) / F.nullif(q - p, F.lit(0))
        out = F.coalesce(F.col(value), between, prev, after)
    return rows.withColumn(into or value, out).drop("_n", "_known")


#: Calendar units in which opening values are carried on, from the slices of time that are dealt out to the longest.
UNITS = ["MINUTE", "DAY", "MONTH"]


def as_of(spine: DataFrame, events: DataFrame, at: str, effective: str, value: str, keys: list[str] | None = None) -> DataFrame:
    """spine with the value of the latest event at or before each time; null before the first. Of events at one time the largest counts.

    Without keys time itself is dealt out, by minute: a minute's opening value is the last one of those before it. Events
    without a value count as not there.
    """
    if not keys:
        spine, events = (x.withColumn("_slice", F.date_trunc(UNITS[0], t)) for x, t in ((spine, at), (events, effective)))
        return as_of(spine, events.unionByName(openings(spine, events, effective, value), allowMissingColumns=True), at, effective, value, ["_slice"]).drop("_slice")
    e = events.groupBy(*keys, F.col(effective).alias("_t")).agg(F.max(value).alias(value)).withColumn("_kind", F.lit(0))
    s = spine.withColumns({"_t": F.col(at), value: F.lit(None).cast(events.schema[value].dataType), "_kind": F.lit(1)})
    both = e.unionByName(s, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last(value, True).over(w)).filter("_kind = 1").drop("_t", "_kind")


def openings(spine: DataFrame, events: DataFrame, effective: str, value: str) -> DataFrame:
    """(_slice, effective, value): for each slice of either table the last value of those before it, a moment before it begins."""
    last = events.filter(F.col(value).isNotNull()).groupBy("_slice").agg(F.max_by(value, F.struct(effective, value)).alias(value))
    slices = spine.select("_slice").unionByName(events.select("_slice")).filter("_slice is not null").distinct().join(last, "_slice", "left")
    out = carried(slices, value, UNITS[1:]).filter(F.col(value).isNotNull())
    return out.select("_slice", (F.col("_slice") - F.expr("interval 1 microsecond")).alias(effective), value)


def carried(slices: DataFrame, value: str, units: list[str]) -> DataFrame:
    """(_slice, value): of each slice of time the latest value of the slices before it.

    A window holds the slices of one unit; what a unit opens with is carried in the same way over the next longer units.
    """
    before = lambda w: F.last(value, True).over(w.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    if not units:
        return slices.select("_slice", before(Window.partitionBy()).alias(value))  # a row for each of the longest units
    within = slices.withColumn("_unit", F.date_trunc(units[0], "_slice"))
    upper = within.groupBy(F.col("_unit").alias("_slice")).agg(F.max_by(value, F.when(F.col(value).isNotNull(), within["_slice"])).alias(value))
    opening = carried(upper, value, units[1:]).select(F.col("_slice").alias("_unit"), F.col(value).alias("_opening"))
    out = within.withColumn("_within", before(Window.partitionBy("_unit"))).join(opening, "_unit")
    return out.select("_slice", F.coalesce("_within", "_opening").alias(value))


def changes(rows: DataFrame, series: list[str], month: str, value: str) -> DataFrame:
    """Lags, differences and rates of change by row of a dense series."""
    w = Window.partitionBy(*series).orderBy(month)
    lag = lambda k: F.lag(value, k).over(w)
    return rows.withColumns(
        {"lag1": lag(1), "lag3": lag(3), "diff1": F.col(value) - lag(1), "diff2": F.col(value) - 2 * lag(1) + lag(2), "mom": F.try_divide(F.col(value), lag(1)) - 1, "yoy": F.try_divide(F.col(value), lag(12)) - 1}
    )


def trailing(rows: DataFrame, series: list[str], month: str, value: str) -> DataFrame:
    """Mean of the last 12 rows, slope of the last 6 (fewer: 0) and growth over 12."""
    w = Window.partitionBy(*series).orderBy(month)
    rows = rows.withColumn("_n", F.row_number().over(w))
    six = w.rowsBetween(-5, 0)
    slope = F.when(F.count(value).over(six) >= 6, F.regr_slope(value, "_n").over(six)).otherwise(0.0)
    return rows.withColumns({"mean12": F.avg(value).over(w.rowsBetween(-11, 0)), "slope6": slope, "growth12": F.col(value) - F.lag(value, 12).over(w)}).drop("_n")
