"""De-duplication, imputation, coverage and checks of panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Order of sources of the same fact; a source that isn't named comes last.
PRIORITY = {"consolidated": 0, "monthly_xlsx": 1, "monthly_xls": 2}


def by_priority(rows: DataFrame, keys: list[str], source: str = "source", priority: dict[str, int] | None = None) -> DataFrame:
    """One row for each key, from the source that comes first. A minimum of structs, so that the map side reduces first."""
    order = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for p in (priority or PRIORITY).items() for x in p)), F.col(source)), F.lit(9))
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(order, *(F.col(c) for c in rest))).alias("_best"))
    return best.select(*keys, *(F.col(f"_best.{c}").alias(c) for c in rest))


def keep_one(rows: DataFrame, keys: list[str], order: list[str], last: bool = True) -> DataFrame:
    """The last (or first) row of each key in the given order, which has to be total."""
    rest = [c for c in rows.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    best = rows.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*keys, *(F.col(f"_best.{c}").alias(c) for c in rest))


def imputed(rows: DataFrame, series: list[str], month: str, value: str, wrong: Column) -> DataFrame:
    """Known wrong values replaced by the last value plus the mean difference of the three values before.

    The mean difference over n values is (last - first) / (n - 1); with fewer than two earlier values nothing changes.
    """
    w = Window.partitionBy(*series).orderBy(month).rowsBetween(-3, -1)
    last, first, n = F.last(value, True).over(w), F.first(value, True).over(w), F.count(value).over(w)
    return rows.withColumn("fixed", F.when(wrong & (n >= 2), last + (last - first) / (n - 1)).otherwise(F.col(value)))


def coverage_flag(rows: DataFrame, series: list[str], value: str, least: int = 12) -> DataFrame:
    """rows with low_coverage: the series has fewer than `least` values that aren't null."""
    counts = rows.groupBy(*series).agg((F.count(value) < least).alias("low_coverage"))
    return rows.join(counts, series)


def quality_report(rows: DataFrame, series: list[str], month: str, value: str, least_rows: int, null_share: float, gap_days: int = 35) -> DataFrame:
    """For each series: rows, share of nulls, largest gap in days, number of gaps over the limit, and whether all is well."""
    w = Window.partitionBy(*series).orderBy(month)
    gap = F.datediff(F.col(month), F.lag(month).over(w))
    out = rows.withColumn("_gap", gap).groupBy(*series).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(value).isNull().cast("double")).alias("null_share"), F.max("_gap").cast("long").alias("max_gap"), F.count_if(F.col("_gap") > gap_days).alias("n_gaps")
    )
    return out.withColumn("ok", (F.col("n_rows") >= least_rows) & (F.col("null_share") <= null_share) & (F.coalesce("max_gap", F.lit(0)) <= gap_days))


def spliced(rows: DataFrame, series: list[str], month: str, value: str, at: str) -> DataFrame:
    """Level splice: a line through the four months before the break and one through the three after give a shift, added before it.

    Series with fewer than three points on a side keep their level (shift null).
    """
    t = F.months_between(F.col(month), F.lit(at).cast("date"))
    before, after = t.between(-4, -1), t.between(0, 3)
    n1, n2 = F.count(F.when(before, F.col(value))), F.count(F.when(after, F.col(value)))
    line = lambda side: F.regr_intercept(F.when(side, F.col(value)), F.when(side, t))  # noqa: E731  the value at the break
    shifts = rows.groupBy(*series).agg(F.when((n1 >= 3) & (n2 >= 3), line(after) - line(before)).alias("shift"))
    moved = F.when(F.col(month) < F.lit(at).cast("date"), F.col(value) + F.coalesce("shift", F.lit(0.0))).otherwise(F.col(value))
    return rows.join(shifts, series).withColumn("spliced", moved)


def canonical_names(rows: DataFrame, name: str, aliases: list[tuple[str, str]]) -> DataFrame:
    """rows with `canonical`: the alias of the stripped name, else the trimmed name in title case."""
    from tallyloom.functions import parse

    listed = rows.sparkSession.createDataFrame(aliases, "_key string, _alias string")
    keyed = rows.withColumn("_key", parse.stripped_name(F.col(name))).join(F.broadcast(listed), "_key", "left")
    return keyed.withColumn("canonical", F.coalesce("_alias", parse.titled(F.col(name)))).drop("_key", "_alias")


def gaps(rows: DataFrame, series: list[str], month: str, days: int = 35) -> DataFrame:
    """(series, since, until, days): where two rows of a series that follow one another are further apart than `days`."""
    w = Window.partitionBy(*series).orderBy(month)
    pairs = rows.select(*series, F.lag(month).over(w).alias("since"), F.col(month).alias("until"))
    return pairs.withColumn("days", F.datediff("until", "since")).filter(F.col("days") > days)


def merged_records(old: DataFrame, new: DataFrame, keys: list[str], first: str) -> DataFrame:
    """old with new's records in place of those with equal keys; of a batch's records for a key the first in `first` counts. `kind` is kept, updated or new."""
    rest = [c for c in old.columns if c not in keys]
    batch = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(first, *rest)).alias("_n"))
    both = old.select(*keys, F.struct(*rest).alias("_o")).join(batch, keys, "full")
    kind = F.when(F.col("_n").isNull(), "kept").when(F.col("_o").isNull(), "new").otherwise("updated")
    return both.select(*keys, F.coalesce("_n", "_o").alias("_r"), kind.alias("kind")).select(*keys, "_r.*", "kind")


def split_by_type(rows: DataFrame, kind: str, kinds: list[str], optional: list[str]) -> dict[str, DataFrame]:
    """A table for each kind; an optional column stays where any of the kind's rows has a value. One pass counts them all."""
    counts = {r[kind]: r for r in rows.filter(F.col(kind).isin(kinds)).groupBy(kind).agg(*(F.count(c).alias(c) for c in optional)).collect()}  # a row for each kind
    return {k: rows.filter(F.col(kind) == k).drop(*(c for c in optional if k not in counts or not counts[k][c])) for k in kinds}


def structure_issues(rows: DataFrame, by: list[str], month: str, target: str, regressors: list[str], dummies: list[str], max_days: int = 35) -> DataFrame:
    """(by, column, issue, n, low, high) of a training frame: null regressors, null targets, dummies that are neither 0 nor 1 (with their range), gaps.

    n counts the rows; a group without issues has one row of issue "none". Null dummies are unexpected values too.
    """
    days = F.date_diff(month, F.lag(month).over(Window.partitionBy(*by).orderBy(month)))
    rows = rows.withColumn("_days", days)
    none = F.lit(None).cast("double")
    found = lambda column, issue, bad, low=none, high=none: F.struct(F.lit(column).alias("column"), F.lit(issue).alias("issue"), F.count_if(bad).alias("n"), low.alias("low"), high.alias("high"))
    checks = [found(c, "null", F.col(c).isNull()) for c in (target, *regressors)]
    for c in dummies:
        odd = F.coalesce(~F.col(c).isin(0.0, 1.0), F.lit(True))
        checks.append(found(c, "not 0 or 1", odd, F.min(F.when(odd, F.col(c))).cast("double"), F.max(F.when(odd, F.col(c))).cast("double")))
    gap = F.col("_days") > max_days
    checks.append(found(month, "gap", gap, F.min(F.when(gap, F.col("_days"))).cast("double"), F.max(F.when(gap, F.col("_days"))).cast("double")))
    clean = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit("none").alias("issue"), F.lit(0).cast("long").alias("n"), none.alias("low"), none.alias("high")))
    held = rows.groupBy(*by).agg(F.filter(F.array(*checks), lambda x: x["n"] > 0).alias("_i"))
    return held.select(*by, F.explode(F.when(F.size("_i") > 0, F.col("_i")).otherwise(clean)).alias("_x")).select(*by, "_x.*")
