"""Forecasts of very many series by recursions that run along one array of each series' values, as columns.

A series' array is as long as its calendar. The points of a parameter grid are rows beside it, the recursion is a fold over
the array with a small state, and only the state of each point goes on to the choice of the best one, which is a partial
minimum. So no array is shuffled after it was made, and no series needs a task of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.gram import NOTHING, eliminated

SEASON, DAMPING = 12, 0.98
#: Smoothing of level, trend and season that Holt-Winters tries.
SMOOTHING = [(a, b, g) for a in (0.1, 0.3, 0.5, 0.8) for b in (0.01, 0.1, 0.3) for g in (0.05, 0.2, 0.5)]
#: Bounds of both coefficients of ARIMA(1,1,1), and how far each round of its search goes about the best point, in 13 steps.
BOUND, WIDTHS = 0.97, (0.9, 0.15, 0.025)
#: Months after a series' first where its line may bend, yearly waves, and the weights of the penalty on both.
BENDS, WAVES, BEND_WEIGHT, WAVE_WEIGHT = (12, 24, 36, 48, 60), 3, 1.0, 0.1


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def series_arrays(rows: DataFrame, keys: list[str], month: str, y: str, logged: bool = True) -> DataFrame:
    """(keys, v): the values of each series in order of month as one array (null where one is missing), on the scale of log(1 + y) where asked for."""
    value = F.log1p(F.greatest(F.lit(0.0), F.col(y).cast("double"))) if logged else F.col(y).cast("double")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(F.col(month).alias("m"), F.when(F.col(y).isNotNull(), value).alias("v")))), lambda x: x["v"])
    made = rows.groupBy(*keys).agg(ordered.alias("v"))
    return made.withColumn("v", F.when(~F.exists("v", lambda x: x.isNull() | F.isnan(x)), F.col("v")))


def _steps(series: DataFrame, keys: list[str], found: DataFrame, horizon: int, yhat: Column) -> DataFrame:
    """(keys, step, yhat) of every series; null where nothing was found."""
    rows = series.select(*keys).join(found, keys, "left").withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return rows.select(*keys, "step", yhat.alias("yhat"))


def holt_winters(series: DataFrame, keys: list[str], horizon: int = 6) -> DataFrame:
    """(keys, step, yhat): additive level, damped trend and season; the smoothing with the least squared error of one step ahead. Under two seasons: null."""
    v, point = F.col("v"), F.col("_g")
    grid = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(g).alias("g")) for a, b, g in SMOOTHING))
    points = series.filter(F.size("v") >= 2 * SEASON).withColumn("_g", F.explode(grid))
    first, second = F.slice(v, 1, SEASON), F.slice(v, SEASON + 1, SEASON)
    level = _total(first) / SEASON
    points = points.withColumn("_level", level).withColumn("_trend", (_total(second) - _total(first)) / SEASON / SEASON)
    start = F.struct(F.col("_level").alias("level"), F.col("_trend").alias("trend"), F.transform(first, lambda x: x - F.col("_level")).alias("seasons"), F.lit(0.0).alias("sse"))

    def step(s: Column, x: Column) -> Column:
        front = F.element_at(s["seasons"], 1)
        e = x - (s["level"] + DAMPING * s["trend"] + front)
        return F.struct(
            (s["level"] + DAMPING * s["trend"] + point["a"] * e).alias("level"),
            (DAMPING * s["trend"] + point["a"] * point["b"] * e).alias("trend"),
            F.concat(F.slice(s["seasons"], 2, SEASON - 1), F.array(front + point["g"] * (1 - point["a"]) * e)).alias("seasons"),
            (s["sse"] + e * e).alias("sse"),
        )

    ended = points.select(*keys, "_g", F.aggregate(F.slice(v, F.lit(SEASON + 1), F.size("v") - SEASON), start, step).alias("_s"))
    best = ended.groupBy(*keys).agg(F.min(F.struct("_s.sse", "_g", "_s.level", "_s.trend", "_s.seasons")).alias("_b"))
    ahead = DAMPING * (1 - F.pow(F.lit(DAMPING), F.col("step"))) / (1 - DAMPING)
    return _steps(series, keys, best, horizon, F.col("_b.level") + F.col("_b.trend") * ahead + F.element_at("_b.seasons", (F.col("step") - 1) % SEASON + 1))


def arima111(series: DataFrame, keys: list[str], horizon: int = 6) -> DataFrame:
    """(keys, step, yhat): ARIMA(1,1,1) by conditional sum of squares, on a grid and then about its best point. Under 12 values: null."""
    z = series.filter(F.size("v") >= 12).withColumn("_d", F.zip_with(F.slice("v", F.lit(2), F.size("v") - 1), F.slice("v", F.lit(1), F.size("v") - 1), lambda a, b: a - b))
    z = z.withColumn("_mean", _total(F.col("_d")) / F.size("_d")).select(*keys, F.element_at("v", -1).alias("_last"), "_mean", F.transform("_d", lambda x: x - F.col("_mean")).alias("_z"))
    centres = z.select(*keys, F.lit(0.0).alias("phi"), F.lit(0.0).alias("theta"))
    for wide in WIDTHS:
        offsets = F.array(*(F.lit(wide * (i - 6) / 6.0) for i in range(13)))
        within = lambda c: F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), c))
        points = z.join(centres, keys).withColumn("_p", F.explode(offsets)).withColumn("_q", F.explode(offsets)).withColumns({"phi": within(F.col("phi") + F.col("_p")), "theta": within(F.col("theta") + F.col("_q"))})

        def step(s: Column, x: Column) -> Column:
            e = x - F.col("phi") * s["before"] - F.col("theta") * s["e"]
            return F.struct(x.alias("before"), e.alias("e"), (s["sse"] + e * e).alias("sse"))

        start = F.struct(F.element_at("_z", 1).alias("before"), F.lit(0.0).alias("e"), F.lit(0.0).alias("sse"))
        ended = points.select(*keys, "phi", "theta", "_last", "_mean", F.aggregate(F.slice("_z", F.lit(2), F.size("_z") - 1), start, step).alias("_s"))
        best = ended.groupBy(*keys).agg(F.min(F.struct("_s.sse", "phi", "theta", "_s.before", "_s.e", "_last", "_mean")).alias("_b"))
        centres = best.select(*keys, "_b.phi", "_b.theta")
    b = F.col("_b")
    first = b["phi"] * b["before"] + b["theta"] * b["e"]
    return _steps(series, keys, best, horizon, b["_last"] + b["_mean"] * F.col("step") + first * (1 - F.pow(b["phi"], F.col("step"))) / (1 - b["phi"]))


def basis(t: Column) -> list[Column]:
    """A line that may bend, and yearly waves, at a number of months from the first."""
    waves = [f(2 * math.pi * w * t / 12) for w in range(1, WAVES + 1) for f in (F.sin, F.cos)]
    return [F.lit(1.0), t / 12.0, *(F.greatest(t - b, F.lit(0.0)) / 12.0 for b in BENDS), *waves]


NAMES = ["constant", "slope", *(f"bend_{b}" for b in BENDS), *(f"{f}_{w}" for w in range(1, WAVES + 1) for f in ("sin", "cos"))]
PENALTY = [1e-6, 1e-6, *[BEND_WEIGHT] * len(BENDS), *[WAVE_WEIGHT] * (2 * WAVES)]


def structural(rows: DataFrame, keys: list[str], month: str, y: str, cuts: list[int] | None = None, step: int | None = None, least: int = 24, logged: bool = True) -> DataFrame:
    """(keys, cut, coefficients): penalised fits of the basis to each series' first `cut` rows, at least `least`; coefficients in the order of NAMES.

    Sums of products run along each series, so a fit at any cut takes the sums at that row, and no training rows are copied.
    cuts are numbers of rows; with `step` every so many rows from the first cut on; without either, the whole series. Null
    values are left out of the sums; a bend that no row has reached has the coefficient 0.
    """
    w = Window.partitionBy(*keys).orderBy(month)
    value = F.log1p(F.greatest(F.lit(0.0), F.col(y).cast("double"))) if logged else F.col(y).cast("double")
    k = len(NAMES) + 1
    rows = rows.filter(F.col(y).isNotNull()).select(*keys, month, F.row_number().over(w).alias("cut"), F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("_n"), value.alias("_y"))
    rows = rows.withColumns({f"_z{i}": c for i, c in enumerate([*basis(F.col("cut").cast("double") - 1), F.col("_y")])})
    sums = [F.sum(F.expr(f"_z{i} * _z{j}")).over(w).alias(f"_s{i}_{j}") for i in range(k) for j in range(i, k)]
    there = F.col("cut") >= least
    if cuts is None:
        there &= F.col("cut") == F.col("_n")
    elif step is None:
        there &= F.col("cut").isin(cuts)
    else:
        there &= (F.col("cut") >= cuts[0]) & ((F.col("cut") - cuts[0]) % step == 0)
    at = rows.select(*keys, "cut", "_n", *sums).filter(there)
    m = F.expr("array(" + ", ".join("array(" + ", ".join(f"_s{min(i, j)}_{max(i, j)}" + (f" + {PENALTY[i]}D" if i == j and i < k - 1 else "") for j in range(k)) + ")" for i in range(k)) + ")")
    solved = at.withColumn("_m", eliminated(m, k - 1, k, F.col("cut").cast("double"), both=True)["m"])
    coefficient = lambda i: F.get(F.get("_m", i), F.lit(k - 1)) / F.get(F.get("_m", i), i)
    return solved.select(*keys, "cut", F.transform(F.sequence(F.lit(0), F.lit(k - 2)), lambda i: F.when(F.get(F.get("_m", i), i) > NOTHING * F.col("cut"), coefficient(i)).otherwise(0.0)).alias("coefficients"))


def structural_forecast(fits: DataFrame, keys: list[str], horizon: int = 6) -> DataFrame:
    """(keys, cut, step, yhat): the fitted basis at the months after each cut."""
    rows = fits.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    t = (F.col("cut") + F.col("step") - 1).cast("double")
    yhat = F.lit(0.0)
    for i, c in enumerate(basis(t)):
        yhat = yhat + F.get("coefficients", F.lit(i)) * c
    return rows.select(*keys, "cut", "step", yhat.alias("yhat"))


def forecasts(rows: DataFrame, keys: list[str], month: str, y: str, horizon: int = 6) -> DataFrame:
    """(keys, model, step, yhat) of Holt-Winters (ets), ARIMA(1,1,1) and the structural regression, fitted to log(1 + y), never below zero; null where a fit isn't possible."""
    series = series_arrays(rows, keys, month, y)
    found = structural_forecast(structural(rows, keys, month, y), keys, horizon).drop("cut")
    every = series.select(*keys).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).join(found, [*keys, "step"], "left")
    parts = {"ets": holt_winters(series, keys, horizon), "arima": arima111(series, keys, horizon), "structural": every}
    out = None
    for name, part in parts.items():
        back = F.when(F.col("yhat").isNotNull() & ~F.isnan("yhat"), F.greatest(F.lit(0.0), F.expm1("yhat")))
        part = part.select(*keys, F.lit(name).alias("model"), "step", back.alias("yhat"))
        out = part if out is None else out.unionByName(part)
    return out


def cross_validated(rows: DataFrame, keys: list[str], month: str, y: str, initial: int = 36, horizon: int = 6, step: int = 6) -> DataFrame:
    """(keys, model, fold, step, y, yhat): walk-forward forecasts of the three models; folds that a model can't be fitted to have no rows."""
    series = series_arrays(rows, keys, month, y)
    cuts = series.withColumn("cut", F.explode(F.when(F.size("v") >= initial + horizon, F.sequence(F.lit(initial), F.size("v") - horizon, F.lit(step)))))
    parts = cuts.select(*keys, "cut", F.slice("v", F.lit(1), F.col("cut")).alias("v"))
    own = [*keys, "cut"]
    fits = structural(rows, keys, month, y, [initial], step)
    out = holt_winters(parts, own, horizon).withColumn("model", F.lit("ets")).unionByName(arima111(parts, own, horizon).withColumn("model", F.lit("arima"))).unionByName(structural_forecast(fits, keys, horizon).withColumn("model", F.lit("structural")))
    truth = cuts.select(*own, F.posexplode(F.slice("v", F.col("cut") + 1, horizon)).alias("_i", "_v")).select(*own, (F.col("_i") + 1).alias("step"), F.expm1("_v").alias("y"))
    out = out.filter("yhat is not null and not isnan(yhat)").join(truth, [*own, "step"])
    return out.select(*keys, "model", ((F.col("cut") - initial) / step).cast("int").alias("fold"), "step", "y", F.greatest(F.lit(0.0), F.expm1("yhat")).alias("yhat"))
