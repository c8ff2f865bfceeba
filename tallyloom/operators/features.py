"""Event dummies, signal regressors and future frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_columns(rows: DataFrame, month: str, events: list[tuple[str, str, list[str]]]) -> DataFrame:
    """rows with event_<name>: "pulse" is 1 in the listed months, "step" from the listed month on; change points make no column."""
    out = {}
    for name, kind, dates in events:
        days = [F.lit(d).cast("date") for d in dates]
        if kind == "pulse":
            out[f"event_{name}"] = F.col(month).isin(*days).cast("double")
        elif kind == "step":
            out[f"event_{name}"] = (F.col(month) >= days[0]).cast("double")
    return rows.withColumns(out)


def change_points(rows: DataFrame, series: list[str], month: str, points: list[str]) -> DataFrame:
    """The change points strictly inside each series' time."""
    ends = rows.groupBy(*series).agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
    all_points = F.array(*(F.lit(p).cast("date") for p in points))
    return ends.select(*series, F.explode(F.filter(all_points, lambda p: (p > F.col("_a")) & (p < F.col("_b")))).alias("change_point"))


def signal_regressors(signals: DataFrame, rules: list[tuple[str, str, str, float]], magnitudes: dict[str, float], directions: dict[str, float], period: str = "day") -> DataFrame:
    """(period, column, value): findings summed to regressors by rules (signal type, prefix of the column, how, weight).

    Counts add weight times magnitude for each bank, directions add direction times magnitude over all banks, flags are 1
    where the last finding of the period isn't negative. Unknown types are left out.
    """
    spark: SparkSession = signals.sparkSession
    by_type = spark.createDataFrame(rules, "signal_type string, prefix string, how string, weight double")
    lookup = lambda m, c: F.element_at(F.create_map(*(F.lit(x) for p in m.items() for x in p)), F.col(c))
    rows = signals.join(F.broadcast(by_type), "signal_type").withColumns({"period": F.date_trunc(period, "discovered_at").cast("date"), "magnitude": lookup(magnitudes, "impact_magnitude"), "direction": lookup(directions, "impact_direction")})
    column = F.when(F.col("how") == "direction", F.col("prefix")).otherwise(F.concat("prefix", F.lit("_"), "bank_name"))
    amount = F.when(F.col("how") == "count", F.col("weight") * F.col("magnitude")).otherwise(F.col("direction") * F.col("magnitude"))
    grouped = rows.groupBy("period", column.alias("column"), "how").agg(F.sum(amount).alias("_sum"), F.max_by("direction", F.struct("discovered_at", "id")).alias("_last"))
    return grouped.select("period", "column", F.when(F.col("how") == "flag", (F.col("_last") >= 0).cast("double")).otherwise(F.col("_sum")).alias("value"))


def future_rows(rows: DataFrame, series: list[str], month: str, value: str, rule: str, horizon: int = 24) -> DataFrame:
    """The months after each series' end with a projected regressor: "flat" (last), "mean" (of the last 12), "slope" (of the last 6) or "decay".

    A falling series decays by its slope's share of the last value each month, by a half at most; others go on as with "slope".
    """
    from .align import trailing

    last = trailing(rows, series, month, value).groupBy(*series).agg(*(F.max_by(c, month).alias(c) for c in (value, "mean12", "slope6")), F.max(month).alias("_end"))
    steps = last.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_h"))
    line = F.col(value) + F.col("slope6") * F.col("_h")
    decayed = F.col(value) * F.pow(F.greatest(1 + F.col("slope6") / F.col(value), F.lit(0.5)), F.col("_h"))
    out = {"flat": F.col(value), "mean": F.col("mean12"), "slope": line, "decay": F.when((F.col("slope6") < 0) & (F.col(value) > 0), decayed).otherwise(line)}[rule]
    return steps.select(*series, F.add_months("_end", F.col("_h")).alias(month), F.greatest(F.lit(0.0), out).alias(value))


def future_events(rows: DataFrame, events: list[tuple[str, str, list[str]]]) -> DataFrame:
    """Rows of future months with event_<name>: a pulse doesn't come again (0), a step stays (1); change points make no column."""
    return rows.withColumns({f"event_{name}": F.lit({"pulse": 0.0, "step": 1.0}[kind]) for name, kind, _ in events if kind in ("pulse", "step")})


def with_extra_regressors(train: DataFrame, extra: DataFrame, series: list[str], month: str, columns: list[str]) -> DataFrame:
    """(series, month, name, value) of the extra regressors at the training rows: 0 where missing, and only those that aren't constant in a series."""
    rows = train.select(*series, month).join(extra, month, "left").unpivot([*series, month], columns, "name", "value").withColumn("value", F.coalesce("value", F.lit(0.0)))
    varied = rows.groupBy(*series, "name").agg(F.stddev("value").alias("_s")).filter("_s > 0").drop("_s")
    return rows.join(varied, [*series, "name"], "left_semi")
